"""Helpers shared by the training-data operators.

* ``read``: a driver table by folder, through Spark's readers only.
* ``pack`` / ``unpack``: carry a whole input row in one struct column, so that
  an operator's own column names can never clash with the input's.
* ``cut``: write a frame under the shared folder and read it back; a lost
  executor afterwards costs a reread of files, never a recomputation.  The copy
  goes when the driver ends, since a frame that reads it may live until then.
* ``drop_cut``: remove such a copy as soon as nothing reads it any more.
* ``batch_rows``: fewer rows at once between the JVM and Python, which Spark bounds by rows and not by bytes.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.session import shared_path
from strata.sources import files

ROW = "__row"
WORD = r"[^\x20\x09-\x0D]+"  # a run of characters that are not ASCII white space
GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return frame.select(*columns) if columns else frame


def pack(df: DataFrame, **needed: Column | str) -> DataFrame:
    """One struct column with the whole row, plus the named columns an operator works on."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW),
                     *[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in needed.items()])


def unpack(df: DataFrame, *extra: Column) -> DataFrame:
    return df.select(f"{ROW}.*", *extra)


def words(text: Column) -> Column:
    """The words of a text (null: no words) as an array."""
    tidy = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(tidy == "", F.array().cast("array<string>")).otherwise(F.split(tidy, GAP))


def cut(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` under the shared folder; the reread frame has no lineage before the files."""
    path = shared_path(spark, "llm", name, unique=True)
    df.write.parquet(path)
    files.remove_at_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def again(spark: SparkSession, frame: DataFrame) -> DataFrame:
    """A second reading of a copy made by ``cut``, for the other side of a self join."""
    out = spark.read.schema(frame.schema).parquet(frame._cut_path)
    out._cut_path = frame._cut_path
    return out


def drop_cut(spark: SparkSession, *frames: DataFrame) -> None:
    """Remove copies made by ``cut`` that nothing will read again."""
    for frame in frames:
        files.remove(spark, frame._cut_path)


@contextmanager
def batch_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs inside sends at most ``most`` rows in one Arrow batch; the session's own setting comes back afterwards."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(setting, before)
