"""The near-real-time views as Structured Streaming jobs.

* T1 ``parse_measurements`` types the JSON envelope of each message.
* T2 ``latest_per_key_stream`` keeps, per key, the row with the greatest event
  time over the whole history (late older events lose, late newer ones win).
  ``row_number`` is not allowed on a stream; a keyed ``max`` over a struct that
  starts with the ordering columns is the streaming equivalent and gives the
  same rows as the batch window.  No watermark: keys never expire, exactly like
  the view it replaces, so state grows with the number of keys (municipality x
  network x year — small).  The session default keeps state in RocksDB with
  changelog checkpointing, off the JVM heap.
* T4 the result is served from a table on shared storage: every micro-batch
  writes the keys it touched to ``<sink>/batch=<id>`` (overwrite, so a replayed
  batch replaces itself), and readers resolve the latest row per key again,
  which is idempotent.  The running query folds finished batches into published
  snapshots (``compact_latest``) and retires both, so reads and folders stay
  proportional to the keyspace, not to the history.
* T3 ``enriched`` joins the served rows to the dimension *at read time*, so a
  refreshed dimension is always seen, as with a view.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions import pad_id_unguarded
from strata.functions.casts import text_to_double, text_to_long
from strata.functions.jsonfields import text_to_timestamp, variant_scalar, with_variant
from strata.operators.star import enrich
from strata.sources import files
from strata.sources.publish import PublishConflict, current, publish, tag, versions

STATE_COL = "__latest"
COMPACT_EVERY = 20     # micro-batches between two snapshots


def parse_measurements(messages: DataFrame, value_col: str = "data",
                       arrival_col: str = "publish_time") -> DataFrame:
    """The typed measurement of each message plus its arrival time.

    Each message is parsed once, into a variant.  Scalar JSON semantics: an
    object where a scalar is expected gives NULL; malformed JSON gives NULLs;
    bad numbers or timestamps give NULL instead of failing the whole stream.
    ``_rejected`` marks messages that are no JSON, or whose event time or year
    is there but cannot be read, for a reject sink; absent values are NULL and
    stay.  The id is padded without trimming, as the original view did.
    """
    raw = F.col(f"`{value_col}`")
    fields = with_variant(messages.select(raw.alias("__data"), F.col(f"`{arrival_col}`").alias("_ingestao_stream")), "__data", "__json")
    names = ["evento_id", "event_timestamp", "tipo_evento", "ano", "id_municipio", "rede", "taxa_alfabetizacao", "media_portugues", "fonte"]
    texts = fields.select("__data", "__json", "_ingestao_stream", *[variant_scalar("__json", f"$.{n}").alias(n) for n in names])
    typed = texts.withColumns({"__when": text_to_timestamp(F.col("event_timestamp")), "__year": text_to_long("ano")})
    # an absent value is NULL and stays in the view; text that is there but cannot be read is rejected
    unread = ((F.col("event_timestamp").isNotNull() & F.col("__when").isNull()) | (F.col("ano").isNotNull() & F.col("__year").isNull())
              | (F.col("__data").isNotNull() & F.col("__json").isNull()))
    return typed.select(
        "evento_id",
        F.col("__when").alias("event_timestamp"),
        "tipo_evento",
        F.col("__year").alias("ano"),
        pad_id_unguarded("id_municipio", 7, trim=False).alias("id_municipio"),
        "rede",
        text_to_double("taxa_alfabetizacao").alias("taxa_alfabetizacao"),
        text_to_double("media_portugues").alias("media_portugues"),
        "fonte",
        "_ingestao_stream",
        unread.alias("_rejected"),
    )


def latest_per_key_stream(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, the row with the greatest ``order`` tuple (first column first).

    A NULL first ordering value loses against any non-NULL one, as with
    ``ORDER BY ... DESC NULLS LAST``.
    """
    payload = [c for c in events.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])
    return events.groupBy(*keys).agg(F.max(packed).alias(STATE_COL))


def unpack(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, f"{STATE_COL}.*")


def resolve_latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key of a batch DataFrame (same rule as the stream)."""
    return unpack(latest_per_key_stream(rows, keys, order), keys)


def start_latest_stream(source: DataFrame, keys: Sequence[str], order: Sequence[str], sink_path: str,
                        checkpoint: str, available_now: bool = True, query_name: str | None = None,
                        compact_every: int | None = COMPACT_EVERY):
    """T2 + T4: start the stateful query writing touched keys per micro-batch.

    Every ``compact_every`` batches the query folds the finished ones into a
    snapshot and retires what no reader needs any more, so the number of
    folders stays bounded however long it runs (None: never).
    """
    state = latest_per_key_stream(source, keys, order)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        unpack(batch, keys).write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            try:
                compact_latest(batch.sparkSession, sink_path, keys, order)
            except PublishConflict:   # someone else has just made a snapshot
                pass

    writer = (state.writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(write_batch))
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def _snapshot_root(sink_path: str) -> str:
    """A published table; each version is tagged with the last batch it holds."""
    return sink_path.rstrip("/") + "_snapshots"


def _batches(spark: SparkSession, sink_path: str) -> list[int]:
    return sorted(int(n[6:]) for n in files.names(spark, sink_path) if n.startswith("batch=") and n[6:].isdigit())


def _rows_after(spark: SparkSession, sink_path: str, snapshot: str | None, upto: int | None = None) -> DataFrame:
    """The snapshot's rows and those of the batches after it (up to ``upto``); retired folders are not even listed."""
    base = sink_path.rstrip("/")
    after = -1 if snapshot is None else tag(snapshot)
    folders = [f"{base}/batch={b}" for b in _batches(spark, base) if b > after and (upto is None or b <= upto)]
    if snapshot is None:
        return (spark.read.parquet(*folders) if folders else spark.read.parquet(base)).drop("batch")
    held = spark.read.parquet(snapshot)
    return held.unionByName(spark.read.schema(held.schema).parquet(*folders)) if folders else held


def read_latest(spark: SparkSession, sink_path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """T4: the served view — latest row per key over every batch written so far.

    Only the newest snapshot and the batches after it are read.  Both stay while one more snapshot is made, so a
    reader may take as long as that.
    """
    return resolve_latest(_rows_after(spark, sink_path, current(spark, _snapshot_root(sink_path))), keys, order)


def compact_latest(spark: SparkSession, sink_path: str, keys: Sequence[str], order: Sequence[str]) -> int | None:
    """Fold finished batches into a new snapshot; retire what the one before it made needless.

    Safe while the stream runs: the newest batch folder may still be in flight
    (or be replayed after a failure), so the snapshot ends one below it —
    micro-batches commit in order, so every batch below the newest is final.
    Readers switch when the snapshot is published.  Batches and snapshots go
    once two published snapshots are newer or hold them.  Returns the
    snapshot's last batch, or None when there is nothing final to fold.
    """
    batches = _batches(spark, sink_path)
    if len(batches) < 2 and (not batches or batches[0] < 1):
        return None
    root, upto = _snapshot_root(sink_path), batches[-1] - 1
    prior = current(spark, root)
    if prior is not None and tag(prior) >= upto:
        return tag(prior)
    publish(resolve_latest(_rows_after(spark, sink_path, prior, upto), keys, order), root, tagged=upto, expect=prior)
    oldest = tag(versions(spark, root)[0])
    if len(versions(spark, root)) > 1:      # readers of the older snapshot need the batches after it
        for batch in batches:
            if batch <= oldest:
                files.remove(spark, f"{sink_path.rstrip('/')}/batch={batch}")
    return upto


def enriched(latest: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join to the dimension at read time; unknown ids keep NULL names."""
    return enrich(latest, dim, on, "left")
