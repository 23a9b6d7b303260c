"""The streaming view pair — typed measurements, latest per key, enriched.

``run_measurement_stream`` consumes landed messages (``data`` JSON +
``publish_time``) from any streaming DataFrame (Kafka, files), keeps the latest
measurement per (municipality, network, year) and serves it from
``<sink>``; ``serve`` joins the served rows to ``gold.dim_municipio`` at read time.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.streaming.measurements import enriched, parse_measurements, read_latest, start_latest_stream

MEASUREMENT_KEYS = ["id_municipio", "rede", "ano"]
# event time first; evento_id and arrival time make the choice total
MEASUREMENT_ORDER = ["event_timestamp", "evento_id", "_ingestao_stream"]
SERVED_COLUMNS = ["ano", "id_municipio", "nome_municipio", "sigla_uf", "nome_regiao", "rede",
                  "taxa_alfabetizacao", "media_portugues", "event_timestamp"]


def accepted(messages: DataFrame) -> DataFrame:
    return parse_measurements(messages).filter("NOT _rejected").drop("_rejected")


def rejected(messages: DataFrame) -> DataFrame:
    return parse_measurements(messages).filter("_rejected")


def run_measurement_stream(messages: DataFrame, sink_path: str, checkpoint: str, available_now: bool = True):
    """Start the stateful query (T1 -> T2 -> T4).

    Messages whose event time or year cannot be read are not part of the view
    (the original view failed as a whole on them); route ``rejected(messages)``
    to its own sink to keep them.
    """
    return start_latest_stream(accepted(messages), MEASUREMENT_KEYS, MEASUREMENT_ORDER, sink_path, checkpoint,
                               available_now)


def serve(spark: SparkSession, sink_path: str, dim_municipio: DataFrame) -> DataFrame:
    """T3 + T4: latest rows joined to the municipality dimension now."""
    latest = read_latest(spark, sink_path, MEASUREMENT_KEYS, MEASUREMENT_ORDER)
    return enriched(latest, dim_municipio.select("id_municipio", "nome_municipio", "sigla_uf", "nome_regiao"),
                    "id_municipio").select(*SERVED_COLUMNS)


def batch_view(messages: DataFrame, dim_municipio: DataFrame) -> DataFrame:
    """The same view computed in batch (row_number) — the reference shape."""
    from pyspark.sql import functions as F
    from strata.operators.dedup import latest_per_key
    rows = accepted(messages)
    latest = latest_per_key(rows, MEASUREMENT_KEYS, "event_timestamp",
                            tiebreak=[F.col("evento_id").desc_nulls_last(), F.col("_ingestao_stream").desc_nulls_last()])
    return latest.join(dim_municipio.select("id_municipio", "nome_municipio", "sigla_uf", "nome_regiao"),
                       "id_municipio", "left").select(*SERVED_COLUMNS)
