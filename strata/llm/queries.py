"""The registered queries of the training-data operators, over whole driver tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import bpe, collocations, covertree, html, licenses, lm, minhash, mixing, packing, quality, quotes, spelling, toxicity
from strata.llm.common import cut, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def public_vocabulary() -> tuple[str, str]:
    """Path and split pattern of the public vocabulary, as installed on this machine."""
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def held_out() -> F.Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity_grammar(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> toxicity.Grammar:
    """Learned from labelled rows that are not held out."""
    texts = toxicity.sample(docs.select("doc_id", "text"), labels.filter(~held_out()).select("doc_id", "toxic"))
    return toxicity.fit(cut(spark, texts, "toxicity-sample"))


@query
def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(spark, read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covertree.classes(spark, read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    grammar = toxicity_grammar(spark, docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, grammar).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_vocabulary()
    return bpe.encode(read(spark, sf_dir, "documents", "doc_id", "text"), path, pattern, with_ids=False)


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    sizes = cut(spark, mixing.sized(docs).select("__row.doc_id", "__key", "__source", "__size"), "mix-sizes")
    drawn = cut(spark, mixing.draw(spark, sizes), "mix-drawn")
    placed = mixing.shuffled(spark, mixing.split(spark, drawn))
    taken = placed.groupBy("__key").agg(F.count(F.lit(1)).alias("times"), F.sort_array(F.collect_list(F.struct("pass", "shard", "position"))).alias("copies"))
    plan = mixing.targets(spark, sizes)
    same = F.col("s.__source").eqNullSafe(F.col("p.__source"))
    return sizes.alias("s").join(taken.alias("t"), "__key", "left").join(cut(spark, plan, "mix-targets").alias("p"), same).select(
        "s.doc_id", F.col("s.__size").alias("size"), "p.source_size", "p.target",
        (F.col("s.__size") * F.coalesce("t.times", F.lit(0))).alias("taken"), F.coalesce("t.copies.shard", F.array().cast("array<int>")).alias("shards"),
        F.coalesce("t.copies.position", F.array().cast("array<bigint>")).alias("positions"))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.classes(spark, read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "class_id", F.lower(F.hex("root")).alias("class_key"), "kept")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_rows(spark, read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return judged.select("__row.doc_id", *[f"__quality.{c}" for c in quality.BASE], "__quality.base_failed", "__quality.kept", "__quality.distance")


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(spark, read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, spelling.corpus_words(read(spark, sf_dir, "documents", "doc_id", "text")))


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(spark, read(spark, sf_dir, "documents", "lang", "text"))


ORACLES["op12_phrases"] = r"""
WITH RECURSIVE pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')), '[^ 	]+') AS ws
  FROM documents),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
total AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)
  GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, j, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f) // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j, string_split(phrase, ' ') AS w FROM grams WHERE k > 1) c
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_phrases AS (
  SELECT g.lang, array_to_string(string_split(g.phrase, ' ')[s.i:s.i + s.k - 1], ' ') AS phrase, max(g.f) AS most
  FROM grams g JOIN (SELECT unnest([1, 2, 3, 1, 2]) AS i, unnest([2, 2, 2, 3, 3]) AS k) s ON s.i + s.k - 1 <= g.k AND s.k < g.k
  GROUP BY ALL),
ranked AS (
  SELECT least.*, row_number() OVER (PARTITION BY least.lang ORDER BY score DESC, a DESC, least.phrase) AS rank
  FROM least LEFT JOIN inner_phrases USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a),
edges AS (
  SELECT lang, phrase, array_to_string(string_split(phrase, ' ')[1:3], ' ') AS tail, array_to_string(string_split(phrase, ' ')[2:4], ' ') AS head,
    string_split(phrase, ' ')[4] AS last
  FROM grams WHERE k = 4),
links AS (
  SELECT o.lang, i.phrase AS before, o.phrase, o.last
  FROM (SELECT lang, head, min(phrase) AS phrase FROM edges GROUP BY ALL HAVING count(*) = 1) i
  JOIN (SELECT lang, tail, min(phrase) AS phrase, min(last) AS last FROM edges GROUP BY ALL HAVING count(*) = 1) o
  ON i.lang = o.lang AND i.head = o.tail WHERE i.phrase <> o.phrase),
walk AS (
  SELECT lang, phrase AS start, phrase, phrase AS path, 0 AS place FROM edges WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM links)
  UNION ALL
  SELECT w.lang, w.start, l.phrase, w.path || ' ' || l.last, w.place + 1 FROM walk w JOIN links l ON l.lang = w.lang AND l.before = w.phrase),
whole AS (SELECT lang, start, arg_max(path, place) AS path FROM walk GROUP BY ALL),
paths AS (
  SELECT e.lang, e.phrase, coalesce(whole.path, e.phrase) AS path
  FROM edges e LEFT JOIN walk USING (lang, phrase) LEFT JOIN whole ON whole.lang = walk.lang AND whole.start = walk.start)
SELECT r.lang, rank, r.phrase, a, l, r, n, score::BIGINT AS score, path
FROM ranked r JOIN total USING (lang) LEFT JOIN paths p ON p.lang = r.lang AND p.phrase = r.phrase
WHERE rank <= 2000"""


@query
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    pieces = packing.token_pieces(docs, public_tokenizers.path(TOKENIZER), with_ids=False)
    return packing.pack(spark, cut(spark, pieces, "packing-pieces"))
