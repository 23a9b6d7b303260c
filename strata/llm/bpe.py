"""Operator 5: byte-level BPE encoding and decoding with padded numpy matrices.

``encode`` splits every text by the tokenizer's pattern, and merges all pieces
of a chunk of texts together: pieces go into matrices of one padded length
each, and in every round each row merges its leftmost pair of lowest rank.
Pair ranks come from an open-addressing hash table over (left id, right id)
held in two numpy arrays.  Rows without a mergeable pair leave the matrix and
columns that became empty are cut off, so later rounds work on less.  Results
of frequent pieces are remembered per Python worker (bounded).

Pieces over ``LONG`` bytes go through the same table one at a time, merging all
occurrences of the lowest pair in a round where that provably equals merging
them from left to right, one by one.

Defined results: a null or empty text has no ids and decodes to no bytes; a
repeated row gives a repeated result; a null id stays null; columns other than
the two named ones are not read.  Texts may be of any length: pieces are taken
from an iterator, so memory follows a chunk of pieces, not the text's token list.
Characters that have no UTF-8 form (lone surrogates cannot occur in a Spark
string) need no rule.
"""
from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

LONG = 512            # bytes; longer pieces are merged one at a time
CHUNK_CHARS = 1 << 20  # texts are worked on in groups of about so many characters
CHUNK_PIECES = 1 << 18
CACHE_PIECES = 200_000  # results remembered per Python worker
NONE = np.int32(2**31 - 1)
SHIFT = np.uint64(20)   # ids are below 2**20


class Coder:
    """Encoder and decoder for one rank file; plain numpy, no tokenizer library."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.vocab = {i: token for token, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self._build_pairs(ranks)
        self.cache: dict[str, tuple[bytes, int, bytes]] = {}

    # -- pair table -------------------------------------------------------
    def _build_pairs(self, ranks: dict[bytes, int]) -> None:
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = (np.array(left, dtype=np.uint64) << SHIFT) | np.array(right, dtype=np.uint64)
        merged = np.array(merged, dtype=np.int32)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.bits = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1), dtype=np.uint64)
        self.values = np.full(1 << bits, NONE, dtype=np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):  # everyone tries a slot; the first in a free slot stays, the others go one further
            free = self.keys[slot[todo]] == np.uint64(2**64 - 1)
            _, first = np.unique(slot[todo], return_index=True)
            wins = np.zeros(len(todo), dtype=bool)
            wins[first] = True
            wins &= free
            self.keys[slot[todo[wins]]] = keys[todo[wins]]
            self.values[slot[todo[wins]]] = merged[todo[wins]]
            todo = todo[~wins]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.bits).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank (= id of the merged token) of each pair; NONE where the pair does not merge.

        A negative right id stands for padding and never merges.
        """
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(len(left), NONE, dtype=np.int32)
        todo = np.nonzero((left >= 0) & (right >= 0))[0]
        keys = (left[todo].astype(np.uint64) << SHIFT) | right[todo].astype(np.uint64)
        slot = self._slot(keys)
        while len(todo):
            held = self.keys[slot]
            hit = held == keys
            out[todo[hit]] = self.values[slot[hit]]
            go = ~hit & (held != np.uint64(2**64 - 1))
            todo, keys, slot = todo[go], keys[go], (slot[go] + 1) & self.mask
        return out.reshape(shape)

    # -- merging ----------------------------------------------------------
    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece (bytes)."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        for i in np.nonzero(sizes > LONG)[0]:
            out[i] = self._merge_long(self.byte_ids[np.frombuffer(pieces[i], dtype=np.uint8)])
        small = np.nonzero(sizes <= LONG)[0]
        bucket = np.ceil(sizes[small] / 4).astype(np.int64)  # padded lengths are multiples of four bytes
        order = np.argsort(bucket, kind="stable")
        small, bucket = small[order], bucket[order]
        for at in np.split(np.arange(len(small)), np.nonzero(np.diff(bucket))[0] + 1):
            if len(at):
                self._merge_bucket([pieces[i] for i in small[at]], small[at], out)
        return out

    def _merge_bucket(self, pieces: list[bytes], at: np.ndarray, out: list[np.ndarray]) -> None:
        width = max(map(len, pieces))
        if not width:
            return
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(len(pieces), width)
        lens = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ids = self.byte_ids[raw]
        ids[np.arange(width) >= lens[:, None]] = -1
        rows = at
        while True:
            if ids.shape[1] == 1:
                break
            ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
            while True:
                pos = ranks.argmin(axis=1)  # leftmost minimum
                line = np.arange(len(ids))
                low = ranks[line, pos]
                live = low != NONE
                if not live.all():
                    for r in np.nonzero(~live)[0]:
                        out[rows[r]] = ids[r, :lens[r]].copy()
                    ids, ranks, rows, lens, pos, low = (x[live] for x in (ids, ranks, rows, lens, pos, low))
                    line = np.arange(len(ids))
                if not len(ids):
                    return
                # the merged id takes the left place, everything right of the pair moves one to the left
                cols = np.arange(ids.shape[1] - 1)
                move = cols[None, :] > pos[:, None]
                shifted = np.where(move, ids[:, 1:], ids[:, :-1])
                shifted[line, pos] = low
                ids = shifted
                lens = lens - 1
                if ids.shape[1] == 1:
                    break
                keep = ranks[:, :-1].copy()
                right = cols[None, :-1] > pos[:, None]
                keep[right] = ranks[:, 1:][right]
                ranks = keep
                inner = pos < ranks.shape[1]
                ranks[line[inner], pos[inner]] = self.pair_ranks(ids[line[inner], pos[inner]], ids[line[inner], pos[inner] + 1])
                before = pos > 0
                ranks[line[before], pos[before] - 1] = self.pair_ranks(ids[line[before], pos[before] - 1], ids[line[before], pos[before]])
                top = int(lens.max())
                if top < ids.shape[1]:  # compaction of columns
                    ids, ranks = ids[:, :top], ranks[:, : max(top - 1, 0)]
                    if top == 1:
                        break
            break
        for r in range(len(ids)):
            out[rows[r]] = ids[r, :lens[r]].copy()

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        while len(ids) > 1:
            ranks = self.pair_ranks(ids[:-1], ids[1:])
            low = ranks.min()
            if low == NONE:
                break
            hits = np.nonzero(ranks == low)[0]
            if len(hits) > 1:  # of a run of overlapping hits every other one counts, from the left
                start = np.concatenate([[True], np.diff(hits) > 1])
                offset = np.arange(len(hits)) - np.maximum.accumulate(np.where(start, np.arange(len(hits)), 0))
                hits = hits[offset % 2 == 0]
                merged = self._replace(ids, hits, low)
                spots = hits - np.arange(len(hits))
                before, after = spots[spots > 0], spots[spots < len(merged) - 1]
                fresh = [self.pair_ranks(merged[before - 1], merged[before]), self.pair_ranks(merged[after], merged[after + 1])]
                behind = hits[hits + 2 < len(ids)]  # seen for a moment, before the next hit is merged
                fresh.append(self.pair_ranks(np.full(len(behind), low, np.int32), ids[behind + 2]))
                if min((int(f.min()) for f in fresh if len(f)), default=int(NONE)) > low:
                    ids = merged
                    continue
            ids = self._replace(ids, hits[:1], low)
        return ids

    @staticmethod
    def _replace(ids: np.ndarray, hits: np.ndarray, merged: int) -> np.ndarray:
        out = ids.copy()
        out[hits] = merged
        return np.delete(out, hits + 1)

    # -- texts ------------------------------------------------------------
    def decode(self, ids) -> bytes:
        return b"".join([self.vocab[i] for i in ids])

    def _learn(self, pieces: set[str]) -> dict[str, tuple[bytes, int, bytes]]:
        """Results of the given pieces, all from the cache; misses are merged together."""
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        fresh = [p for p in pieces if p not in self.cache]
        for piece, ids in zip(fresh, self.merge([p.encode("utf-8") for p in fresh]), strict=True):
            ids = ids.tolist()
            self.cache[piece] = (",".join(map(str, ids)).encode("ascii"), len(ids), self.decode(ids))
        return self.cache

    def _chunks(self, text: str) -> Iterator[list[str]]:
        if len(text) <= CHUNK_CHARS:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, CHUNK_PIECES)):
            yield part

    def encode_texts(self, texts: list[str | None], with_ids: bool) -> list[tuple]:
        """(n_tokens, ids_sha256, decoded_sha256, ids or None) per text."""
        out, group, chars = [], [], 0
        for text in texts:
            group.append(text or "")
            chars += len(group[-1])
            if chars >= CHUNK_CHARS:
                out += self._encode_group(group, with_ids)
                group, chars = [], 0
        return out + self._encode_group(group, with_ids)

    def _encode_group(self, texts: list[str], with_ids: bool) -> list[tuple]:
        out = []
        ready = {i: self.pattern.findall(t) for i, t in enumerate(texts) if len(t) <= CHUNK_CHARS}
        known = self._learn({p for pieces in ready.values() for p in pieces})
        for i, text in enumerate(texts):
            ids_hash, back_hash, n, all_ids, first = hashlib.sha256(), hashlib.sha256(), 0, [], True
            for pieces in ([ready[i]] if i in ready else self._chunks(text)):
                if i not in ready:
                    known = self._learn(set(pieces))
                if not pieces:
                    continue
                found = [known[p] for p in pieces]
                joined = b",".join([f[0] for f in found])
                ids_hash.update(joined if first else b"," + joined)
                back_hash.update(b"".join([f[2] for f in found]))
                n += sum([f[1] for f in found])
                if with_ids:
                    all_ids.append(np.array(joined.split(b","), dtype=np.int32))
                first = False
            if i not in ready:  # a very long text may have emptied the cache
                known = self._learn({p for pieces in ready.values() for p in pieces})
            ids = (np.concatenate(all_ids) if all_ids else np.empty(0, np.int32)) if with_ids else None
            out.append((n, ids_hash.hexdigest(), back_hash.hexdigest(), ids))
        return out


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


_CODERS: dict[str, Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    """One coder per rank file and Python process."""
    if path not in _CODERS:
        _CODERS[path] = Coder(load_ranks(path), pattern)
    return _CODERS[path]


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]) for every row, whole texts.

    ``path`` names a rank file that every worker can open (a public vocabulary
    installed with the workers); its size is that of the vocabulary.
    """
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, ids_hash, back_hash, ids = zip(*own.encode_texts(part.column(1).to_pylist(), with_ids), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(back_hash)]
                    + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []),
                    names=["__id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    return rows.mapInArrow(run, f"__id {kind}, {fields}").withColumnRenamed("__id", id_col)
