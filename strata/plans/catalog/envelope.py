"""Catalogue: the nine-field measurement envelope (T1), built from the events rows.

The residue of a row's id picks what its message looks like: complete, with
absent fields, with values that cannot be read, nested values, text that begins
with a bracket, times with, without and beside an offset, no JSON, no message.
The oracle states the typed values of each kind; it parses nothing.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from strata.plans.catalog.registry import register
from strata.sources import TableSet
from strata.streaming.measurements import parse_measurements

KINDS = 13
COMPLETE = {
    "event_timestamp": '"2024-01-05T10:00:00Z"', "ano": "2023", "rede": '"2"', "media_portugues": '"700.25"', "fonte": '"inep"',
}
# what the message of a kind has in place of the complete one's values; None: the field is absent
CHANGES: dict[int, dict[str, str | None]] = {
    1: {"event_timestamp": None}, 2: {"ano": None}, 3: {"ano": "3000000000"}, 4: {"fonte": '"[inep] x"'}, 5: {"rede": '{"a": 1}'},
    6: {"event_timestamp": '"bad"'}, 7: {"ano": '"20x"'}, 9: {"media_portugues": '"n/a"'},
    10: {"event_timestamp": '"2024-01-05T10:00:00+02:00"'}, 11: {"event_timestamp": '"2024-01-05T10:00:00"', "fonte": "null"},
}


def message() -> Column:
    """The JSON text of a row of events."""
    number = F.col("event_id").cast("string")
    share = F.concat((F.col("event_id") % 100).cast("string"), F.lit(".5"))
    kind = F.col("event_id") % KINDS
    out = F.when(kind == 8, F.lit("no json")).when(kind == 12, F.lit(None).cast("string"))
    for k in range(KINDS):
        if k in (8, 12):
            continue
        fields = {name: text for name, text in (COMPLETE | CHANGES.get(k, {})).items() if text is not None}
        rest = "".join(f', "{name}": {text}' for name, text in fields.items())
        out = out.when(kind == k, F.concat(
            F.lit('{"evento_id": "e'), number, F.lit('", "tipo_evento": "'), F.coalesce("event_type", F.lit("")), F.lit('", "id_municipio": "'), number,
            F.lit('", "taxa_alfabetizacao": '), share, F.lit(rest + "}")))
    return out


@register("measurement_parse", """
WITH e AS (SELECT *, event_id % 13 AS k, event_id % 13 NOT IN (8, 12) AS json FROM events)
SELECT CASE WHEN json THEN 'e' || CAST(event_id AS VARCHAR) END AS evento_id,
       CASE WHEN NOT json OR k IN (1, 6) THEN NULL
            WHEN k = 10 THEN epoch_us(TIMESTAMP '2024-01-05 08:00:00')
            ELSE epoch_us(TIMESTAMP '2024-01-05 10:00:00') END AS event_micros,
       CASE WHEN json THEN coalesce(event_type, '') END AS tipo_evento,
       CASE WHEN NOT json OR k IN (2, 7) THEN NULL WHEN k = 3 THEN CAST(3000000000 AS BIGINT) ELSE CAST(2023 AS BIGINT) END AS ano,
       CASE WHEN json THEN lpad(CAST(event_id AS VARCHAR), 7, '0') END AS id_municipio,
       CASE WHEN json AND k <> 5 THEN '2' END AS rede,
       CASE WHEN json THEN CAST(event_id % 100 AS DOUBLE) + 0.5 END AS taxa_alfabetizacao,
       CASE WHEN json AND k <> 9 THEN CAST(700.25 AS DOUBLE) END AS media_portugues,
       CASE WHEN NOT json OR k = 11 THEN NULL WHEN k = 4 THEN '[inep] x' ELSE 'inep' END AS fonte,
       ts AS _ingestao_stream,
       k IN (6, 7, 8) AS _rejected
FROM e
""")
def measurement_parse(spark, sf_dir):
    """T1 + C11: every field of the envelope, absent, unreadable and nested values included."""
    messages = TableSet(spark, sf_dir).events.select(message().alias("data"), F.col("ts").alias("publish_time"))
    parsed = parse_measurements(messages)
    return parsed.withColumn("event_timestamp", F.unix_micros("event_timestamp")).withColumnRenamed("event_timestamp", "event_micros")
