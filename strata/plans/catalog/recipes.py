"""Catalogue: the silver recipes (B1-B6), gold builders (G2-G9) and the live view
on bronze tables that are derived from the driver's.

An adapter is a list of (SQL expression, column) over one driver table, written
so that Spark and the oracle read it alike; it only makes delivered text (wrong
codes, blanks, padding, absent values, repeated keys) and the real builders of
``strata.plans`` do the rest.  The oracles state the recipes in SQL by hand.
Timestamps are compared as days, so no session time zone matters.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.functions.domains import LEVEL_COLUMNS, NETWORK_LABELS, STATES, TARGET_YEARS
from strata.operators.reshape import reconcile_summary
from strata.plans import gold, silver
from strata.plans.catalog.envelope import message
from strata.plans.catalog.registry import register
from strata.session import shared_path
from strata.sources import Layers, TableSet, files, read_layer, write_layer
from strata.streaming import views

STATE_LIST = "".join(STATES)
TARGETS = [f"meta_alfabetizacao_{y}" for y in TARGET_YEARS]

# -- adapters: delivered rows ------------------------------------------------
YEAR = "CASE o_orderkey % 101 WHEN 0 THEN ' 2020 ' WHEN 1 THEN 'x' WHEN 2 THEN '2021.5' ELSE CAST(year(o_orderdate) + 25 AS STRING) END"
PLACE = ("CASE o_custkey % 11 WHEN 0 THEN '' WHEN 1 THEN 'M' || CAST(o_custkey % 20 AS STRING) WHEN 2 THEN ' ' || CAST(o_custkey % 40 AS STRING) || ' ' "
         "WHEN 3 THEN '1234567890' ELSE CAST(o_custkey % 40 AS STRING) END")
UF = (f"CASE o_custkey % 31 WHEN 0 THEN 'XX' WHEN 1 THEN ' sp ' WHEN 2 THEN lower(substr('{STATE_LIST}', 1, 2)) "
      f"ELSE substr('{STATE_LIST}', CAST(1 + 2 * (o_custkey % 27) AS INT), 2) END")
CODE = "CASE o_orderkey % 29 WHEN 0 THEN '9' WHEN 1 THEN NULL WHEN 2 THEN ' 3 ' ELSE substr(o_orderpriority, 1, 1) END"
GRADE = "CASE o_orderkey % 31 WHEN 0 THEN '3' WHEN 1 THEN ' 2 ' ELSE '2' END"
STAMP = [("o_orderdate", "_ingestao_timestamp"), ("CASE o_orderkey % 43 WHEN 0 THEN '  ' ELSE ' fonte' END", "_fonte")]
TAXA = "CASE o_orderkey % 47 WHEN 0 THEN NULL WHEN 1 THEN 101.0 WHEN 2 THEN -1.0 ELSE CAST(o_orderkey % 1000 AS DOUBLE) / 10 END"
MEDIA = "CASE o_orderkey % 59 WHEN 0 THEN NULL ELSE CAST(o_orderkey % 700 AS DOUBLE) / 4 END"
LEVELS = [(f"CASE WHEN o_orderkey % {41 + i} = 0 THEN NULL ELSE CAST((o_orderkey + {i}) % 13 AS DOUBLE) END", c) for i, c in enumerate(LEVEL_COLUMNS)]

STUDENTS = [
    (YEAR, "ano"), (PLACE, "id_municipio"),
    ("CASE o_orderkey % 53 WHEN 0 THEN '123' ELSE CAST(10000000 + o_custkey % 50 AS STRING) END", "id_escola"),
    ("CASE o_orderkey % 211 WHEN 0 THEN NULL ELSE CAST(o_orderkey % 1500 AS STRING) END", "id_aluno"),
    ("CASE o_orderkey % 23 WHEN 0 THEN '43' WHEN 1 THEN ' 7 ' WHEN 2 THEN 'x9' ELSE CAST(1 + o_orderkey % 21 AS STRING) END", "caderno"),
    (GRADE, "serie"), (CODE, "rede"),
    ("CASE o_orderkey % 17 WHEN 0 THEN '2' WHEN 1 THEN NULL WHEN 2 THEN ' 1 ' WHEN 3 THEN '1.0' ELSE CAST(o_orderkey % 2 AS STRING) END", "presenca"),
    ("CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE '1' END", "preenchimento_caderno"),
    ("CASE o_custkey % 5 WHEN 0 THEN 'n' ELSE CAST(o_custkey % 2 AS STRING) END", "alfabetizado"),
    ("CASE o_orderkey % 37 WHEN 0 THEN NULL WHEN 1 THEN '-5.5' WHEN 2 THEN 'abc' ELSE CAST(o_orderkey % 1000 AS STRING) || '.25' END", "proficiencia"),
    ("CASE o_orderkey % 41 WHEN 0 THEN '0' WHEN 1 THEN NULL ELSE '1.5' END", "peso_aluno"), *STAMP]
MUNICIPALITY = [(YEAR, "ano"), (PLACE, "id_municipio"), (GRADE, "serie"), (CODE, "rede"), (TAXA, "taxa_alfabetizacao"), (MEDIA, "media_portugues"), *LEVELS]
STATE = [(YEAR, "ano"), (UF, "sigla_uf"), (GRADE, "serie"), (CODE, "rede"), (TAXA, "taxa_alfabetizacao"), (MEDIA, "media_portugues"), *LEVELS, *STAMP]
LABEL = ("CASE o_orderkey % 7 WHEN 0 THEN ' PUBLICA ' WHEN 1 THEN 'pública' WHEN 2 THEN 'ESTADUAL' WHEN 3 THEN ' municipal' WHEN 4 THEN '' "
         "WHEN 5 THEN 'Rede Do Futuro' ELSE 'Federal' END")
YEARLY = [(f"CASE WHEN o_orderkey % {19 + i} = 0 THEN NULL ELSE CAST((o_orderkey % 50) + {i} * (o_orderkey % 3) AS DOUBLE) - CASE WHEN o_orderkey % {31 + i} = 0 THEN 9.0 ELSE 0.0 END END", c)
          for i, c in enumerate(TARGETS)]
SHARE = "CASE o_orderkey % 61 WHEN 0 THEN NULL WHEN 1 THEN 100.5 ELSE CAST(o_orderkey % 400 AS DOUBLE) / 4 END"
PERCENTS = [(TAXA, "taxa_alfabetizacao"), *YEARLY, (SHARE, "percentual_participacao")]
COUNTRY_TARGETS = [(YEAR, "ano"), (LABEL, "rede"), *PERCENTS, *STAMP]
STATE_TARGETS = [(YEAR, "ano"), (UF, "sigla_uf"), (LABEL, "rede"), *PERCENTS, *STAMP]
MUNICIPALITY_TARGETS = [(YEAR, "ano"), (PLACE, "id_municipio"), (LABEL, "rede"), (TAXA, "taxa_alfabetizacao"), *YEARLY,
                        ("CASE o_orderkey % 13 WHEN 0 THEN ' 9 ' WHEN 1 THEN NULL ELSE CAST(o_orderkey % 6 AS STRING) END", "nivel_alfabetizacao"),
                        (SHARE, "percentual_participacao"), *STAMP]
DIRECTORY = [("lpad(CAST(c_custkey AS STRING), 7, '0')", "id_municipio"), ("c_name", "nome"),
             (f"substr('{STATE_LIST}', CAST(1 + 2 * (c_nationkey % 27) AS INT), 2)", "sigla_uf"),
             ("'UF ' || CAST(c_nationkey AS STRING)", "nome_uf"), ("'R' || CAST(c_nationkey % 5 AS STRING)", "nome_regiao")]
BRONZE = {"aluno": STUDENTS, "municipio": MUNICIPALITY, "uf": STATE, "meta_alfabetizacao_brasil": COUNTRY_TARGETS,
          "meta_alfabetizacao_uf": STATE_TARGETS, "meta_alfabetizacao_municipio": MUNICIPALITY_TARGETS}


def bronze(t: TableSet, table: str) -> DataFrame:
    return t.orders.selectExpr(*[f"{expr} AS {name}" for expr, name in BRONZE[table]])


def directory(t: TableSet) -> DataFrame:
    return t.customer.selectExpr(*[f"{expr} AS {name}" for expr, name in DIRECTORY])


def silver_rows(t: TableSet, table: str) -> DataFrame:
    return silver.build(silver.SILVER_SPECS[table], bronze(t, table))[1]


def by_day(df: DataFrame) -> DataFrame:
    """Without the run's own stamp; arrival times as days."""
    out = df.drop(silver.SILVER_TS)
    return out.withColumn("_ingestao_timestamp", F.col("_ingestao_timestamp").cast("date")) if "_ingestao_timestamp" in out.columns else out


# -- oracles -----------------------------------------------------------------
def _raw(name: str) -> str:
    return f"raw_{name} AS (SELECT " + ", ".join(f"{e} AS {n}" for e, n in BRONZE[name]) + " FROM orders)"


def _whole(text: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+([.][0-9]*)?') "
            f"THEN TRY_CAST(regexp_extract(trim({text}), '^[+-]?[0-9]+') AS INTEGER) END")


def _number(text: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+([.][0-9]*)?') THEN TRY_CAST(trim({text}) AS DOUBLE) END"


def _norm(text: str) -> str:
    return f"nullif(trim({text}), '')"


def _guarded(text: str) -> str:
    return f"CASE WHEN regexp_full_match({text}, '[0-9]{{1,7}}') THEN lpad({text}, 7, '0') ELSE {text} END"


def _decoded(code: str) -> str:
    return f"CASE {code} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NETWORK_LABELS.items()) + " END"


def _flag(code: str) -> str:
    return f"CASE {code} WHEN 1 THEN true WHEN 0 THEN false END"


_LABELLED = "CASE trim(rede) WHEN 'PUBLICA' THEN 'Pública' WHEN 'pública' THEN 'Pública' WHEN 'ESTADUAL' THEN 'Estadual' WHEN 'municipal' THEN 'Municipal' WHEN '' THEN NULL ELSE trim(rede) END"
_DAY = "CAST(_ingestao_timestamp AS DATE) AS _ingestao_timestamp"
_FLAGS = ("presenca", "preenchimento_caderno", "alfabetizado")
_CLEAN = {
    "aluno": [f"{_whole('ano')} AS ano", f"{_guarded(_norm('id_municipio'))} AS id_municipio", f"{_norm('id_escola')} AS id_escola", f"{_norm('id_aluno')} AS id_aluno",
              f"upper({_norm('caderno')}) AS caderno", f"{_whole('serie')} AS serie", f"upper({_norm('rede')}) AS rede_id",
              *[f"{_whole(f)} AS {f}_id" for f in _FLAGS], f"{_number('proficiencia')} AS proficiencia", f"{_number('peso_aluno')} AS peso_aluno",
              _DAY, f"{_norm('_fonte')} AS _fonte", f"{_decoded('upper(' + _norm('rede') + ')')} AS rede", *[f"{_flag(_whole(f))} AS {f}" for f in _FLAGS]],
    "municipio": [f"{_whole('ano')} AS ano", "lpad(trim(id_municipio), 7, '0') AS id_municipio", f"{_whole('serie')} AS serie", "trim(rede) AS rede_id",
                  "taxa_alfabetizacao", "media_portugues", *LEVEL_COLUMNS, f"{_decoded('trim(rede)')} AS rede"],
    "uf": [f"{_whole('ano')} AS ano", "upper(trim(sigla_uf)) AS sigla_uf", f"{_whole('serie')} AS serie", "trim(rede) AS rede_id",
           "taxa_alfabetizacao", "media_portugues", *LEVEL_COLUMNS, _DAY, "trim(_fonte) AS _fonte", f"{_decoded('trim(rede)')} AS rede"],
    "meta_alfabetizacao_brasil": [f"{_whole('ano')} AS ano", f"{_LABELLED} AS rede", "taxa_alfabetizacao", *TARGETS, "percentual_participacao", _DAY, "trim(_fonte) AS _fonte"],
    "meta_alfabetizacao_uf": [f"{_whole('ano')} AS ano", "upper(trim(sigla_uf)) AS sigla_uf", f"{_LABELLED} AS rede", "taxa_alfabetizacao", *TARGETS,
                              "percentual_participacao", _DAY, "trim(_fonte) AS _fonte"],
    "meta_alfabetizacao_municipio": [f"{_whole('ano')} AS ano", f"{_guarded('trim(id_municipio)')} AS id_municipio", f"{_LABELLED} AS rede", "taxa_alfabetizacao", *TARGETS,
                                     f"{_whole('nivel_alfabetizacao')} AS nivel_alfabetizacao", "percentual_participacao", _DAY, "trim(_fonte) AS _fonte"],
}


def _silver(name: str) -> str:
    """CTEs raw_, clean_ and silver_<name>: the recipe's rows, one per key, the first by all other columns."""
    keys = silver.SILVER_SPECS[name].keys
    columns = [c.rsplit(" AS ", 1)[-1] for c in _CLEAN[name]]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in columns if c not in keys)
    return (f"{_raw(name)}, clean_{name} AS (SELECT {', '.join(_CLEAN[name])} FROM raw_{name}), "
            f"silver_{name} AS (SELECT * FROM clean_{name} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1)")


_DIRECTORY_SQL = "directory AS (SELECT " + ", ".join(f"{e} AS {n}" for e, n in DIRECTORY) + " FROM customer)"
_DIM_REDE_SQL = ("dim_rede AS (SELECT DISTINCT rede_id, rede FROM (SELECT rede_id, rede FROM silver_municipio UNION ALL SELECT rede_id, rede FROM silver_aluno "
                 "UNION ALL SELECT rede_id, rede FROM silver_uf) WHERE rede_id IS NOT NULL)")
_DIM_MUNICIPIO_SQL = ("dim_municipio AS (SELECT u.id_municipio, nome AS nome_municipio, sigla_uf, nome_uf, nome_regiao FROM (SELECT id_municipio FROM silver_municipio "
                      "UNION SELECT id_municipio FROM silver_aluno UNION SELECT id_municipio FROM silver_meta_alfabetizacao_municipio) u LEFT JOIN directory d USING (id_municipio))")
_FATO_META_SQL = "fato_meta AS (SELECT m.*, rede_id FROM (" + " UNION ALL ".join(
    f"SELECT '{level}' AS nivel_geografico, CAST({place} AS VARCHAR) AS local_id, rede, ano AS ano_referencia, CAST({y} AS INTEGER) AS ano_meta, "
    f"meta_alfabetizacao_{y} AS valor_meta FROM silver_{table} WHERE meta_alfabetizacao_{y} IS NOT NULL"
    for level, place, table in (("brasil", "NULL", "meta_alfabetizacao_brasil"), ("uf", "sigla_uf", "meta_alfabetizacao_uf"),
                                ("municipio", "id_municipio", "meta_alfabetizacao_municipio")) for y in TARGET_YEARS
) + ") m LEFT JOIN dim_rede d ON m.rede = d.rede)"
_ALL_SILVER = ", ".join(_silver(n) for n in BRONZE)


def _silver_query(name: str) -> None:
    @register(f"silver_{name}", f"WITH {_silver(name)} SELECT * FROM silver_{name}")
    def run(spark, sf_dir, name=name):
        return by_day(silver_rows(TableSet(spark, sf_dir), name))

    run.__doc__ = f"The silver recipe of {name}: contract, cleaning, one row per key."


for _name in BRONZE:
    _silver_query(_name)


# -- reports -------------------------------------------------------------------
def _report(stage: str, source: str, checks: list[tuple[str, str | None, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{check}' AS check_name, {'NULL' if column is None else repr(column)} AS column_name, count(*) FILTER (WHERE {bad}) AS violations, "
        f"'{severity}' AS severity FROM {source}" for check, column, bad, severity in checks)


_STUDENT_PRE = [
    ("row_count", None, "true", "warn"),
    *[("raw_flag_domain", f, f"raw_{f} IS NOT NULL AND trim(raw_{f}) NOT IN ('0', '1')", "gate") for f in _FLAGS],
    ("domain", "caderno", "caderno NOT IN (SELECT CAST(unnest(range(1, 22)) AS VARCHAR) UNION ALL SELECT '43')", "gate"),
    ("domain", "serie", "serie <> 2", "gate"), ("domain", "rede_id", "rede_id NOT IN ('2', '3', '4')", "gate"),
    ("rare_code", "caderno", "caderno = '43'", "warn"),
    *[("undecoded", f"{f}_id", f"{f}_id IS NOT NULL AND {f} IS NULL", "gate") for f in _FLAGS]]
_STUDENT_POST = [
    ("row_count", None, "true", "warn"),
    ("format", "id_municipio", "NOT regexp_full_match(id_municipio, '[0-9]{7}')", "warn"), ("format", "id_escola", "NOT regexp_full_match(id_escola, '[0-9]{8}')", "warn"),
    *[("nulls", c, f"{c} IS NULL", "warn") for c in ("ano", "id_aluno", "serie", "rede_id", "presenca_id", "preenchimento_caderno_id", "alfabetizado_id",
                                                   "_ingestao_timestamp", "_fonte")],
    ("sign", "proficiencia", "proficiencia < 0", "warn"), ("sign", "peso_aluno", "peso_aluno <= 0", "warn"),
    ("required_when_filled", "proficiencia,peso_aluno", "preenchimento_caderno_id = 1 AND (proficiencia IS NULL OR peso_aluno IS NULL)", "warn"),
    ("absent_but_filled", "presenca_id,preenchimento_caderno_id", "presenca_id = 0 AND preenchimento_caderno_id = 1", "warn"),
    ("literate_not_filled", "alfabetizado_id,preenchimento_caderno_id", "alfabetizado_id = 1 AND preenchimento_caderno_id <> 1", "warn")]
_DROPS = " OR ".join(f"{b} < {a}" for a, b in zip(TARGETS, TARGETS[1:]))
_STATE_TARGET_POST = [
    ("row_count", None, "true", "warn"), ("domain", "sigla_uf", f"sigla_uf NOT IN ({', '.join(map(repr, STATES))})", "warn"),
    *[("nulls", c, f"{c} IS NULL", "warn") for c in ("ano", "sigla_uf", "rede", "taxa_alfabetizacao", *TARGETS, "percentual_participacao", "_ingestao_timestamp", "_fonte")],
    *[("range", c, f"{c} < 0 OR {c} > 100", "warn") for c in ("taxa_alfabetizacao", *TARGETS, "percentual_participacao")],
    ("decreasing", ",".join(TARGETS), _DROPS, "warn"),
    ("null_parity", "taxa_alfabetizacao,percentual_participacao", "(taxa_alfabetizacao IS NULL) <> (percentual_participacao IS NULL)", "warn")]


@register("student_reports", f"WITH {_silver('aluno')}, flagged AS (SELECT {', '.join(_CLEAN['aluno'])}, " + ", ".join(f"r.{f} AS raw_{f}" for f in _FLAGS)
          + " FROM raw_aluno r) " + _report("pre", "flagged", _STUDENT_PRE) + " UNION ALL " + _report("post", "silver_aluno", _STUDENT_POST))
def student_reports(spark, sf_dir):
    """B1's checks before (Q6-Q9) and after (Q4, Q5, Q12-Q14) the dedup; every one of them is hit."""
    spec = silver.SILVER_SPECS["aluno"]
    cleaned, rows = silver.build(spec, bronze(TableSet(spark, sf_dir), "aluno"))
    return silver.pre_report(spec, cleaned).unionByName(silver.post_report(spec, rows))


@register("state_target_reports", f"WITH {_silver('meta_alfabetizacao_uf')} " + _report("post", "silver_meta_alfabetizacao_uf", _STATE_TARGET_POST))
def state_target_reports(spark, sf_dir):
    """B5's checks: domains, absent values, ranges, falling targets (Q21) and lone results (Q22), each hit by some rows only."""
    return silver.post_report(silver.SILVER_SPECS["meta_alfabetizacao_uf"], silver_rows(TableSet(spark, sf_dir), "meta_alfabetizacao_uf"))


# -- gold ----------------------------------------------------------------------
def _dim_rede(t: TableSet) -> DataFrame:
    return gold.dim_rede(silver_rows(t, "municipio"), silver_rows(t, "aluno"), silver_rows(t, "uf"))


def _dim_municipio(t: TableSet) -> DataFrame:
    return gold.dim_municipio(silver_rows(t, "municipio"), silver_rows(t, "aluno"), silver_rows(t, "meta_alfabetizacao_municipio"), directory(t))


def _fato_meta(t: TableSet) -> DataFrame:
    return gold.fato_meta(silver_rows(t, "meta_alfabetizacao_brasil"), silver_rows(t, "meta_alfabetizacao_uf"), silver_rows(t, "meta_alfabetizacao_municipio"), _dim_rede(t))


_DIM_UF_SQL = (f"WITH {_silver('uf')}, {_DIRECTORY_SQL} SELECT u.sigla_uf, nome_uf, nome_regiao FROM (SELECT DISTINCT sigla_uf FROM silver_uf) u "
               "LEFT JOIN (SELECT DISTINCT sigla_uf, nome_uf, nome_regiao FROM directory) d USING (sigla_uf)")


@register("gold_dim_uf", _DIM_UF_SQL)
def gold_dim_uf(spark, sf_dir):
    """States with their names; unknown states keep NULL names."""
    t = TableSet(spark, sf_dir)
    return gold.dim_uf(silver_rows(t, "uf"), directory(t))


@register("gold_dim_municipio", f"WITH {_silver('municipio')}, {_silver('aluno')}, {_silver('meta_alfabetizacao_municipio')}, {_DIRECTORY_SQL}, {_DIM_MUNICIPIO_SQL} SELECT * FROM dim_municipio")
def gold_dim_municipio(spark, sf_dir):
    """Municipalities of three tables with their names."""
    return _dim_municipio(TableSet(spark, sf_dir))


@register("gold_dim_rede", f"WITH {_silver('municipio')}, {_silver('aluno')}, {_silver('uf')}, {_DIM_REDE_SQL} SELECT * FROM dim_rede")
def gold_dim_rede(spark, sf_dir):
    """Observed network codes and labels."""
    return _dim_rede(TableSet(spark, sf_dir))


@register("gold_fato_aluno", f"WITH {_silver('aluno')} SELECT {', '.join(gold.FATO_ALUNO_COLUMNS)} FROM silver_aluno")
def gold_fato_aluno(spark, sf_dir):
    """G5."""
    return gold.fato_aluno(silver_rows(TableSet(spark, sf_dir), "aluno"))


@register("gold_fato_indicador_municipio", f"WITH {_silver('municipio')} SELECT ano, id_municipio, {', '.join(gold.INDICATOR_COLUMNS)} FROM silver_municipio")
def gold_fato_indicador_municipio(spark, sf_dir):
    """G6."""
    return gold.fato_indicador_municipio(silver_rows(TableSet(spark, sf_dir), "municipio"))


@register("gold_fato_indicador_uf", f"WITH {_silver('uf')} SELECT ano, sigla_uf, {', '.join(gold.INDICATOR_COLUMNS)} FROM silver_uf")
def gold_fato_indicador_uf(spark, sf_dir):
    """G7."""
    return gold.fato_indicador_uf(silver_rows(TableSet(spark, sf_dir), "uf"))


@register("gold_fato_meta", f"WITH {_ALL_SILVER}, {_DIM_REDE_SQL}, {_FATO_META_SQL} SELECT * FROM fato_meta")
def gold_fato_meta(spark, sf_dir):
    """G8 (R1, U3, J3): targets of all levels as rows; labels without a code stay."""
    return _fato_meta(TableSet(spark, sf_dir))


@register("gold_fato_resultados", f"""WITH {_ALL_SILVER}, {_DIRECTORY_SQL}, {_DIM_REDE_SQL}, {_DIM_MUNICIPIO_SQL}, {_FATO_META_SQL},
latest AS (SELECT * FROM fato_meta WHERE nivel_geografico = 'municipio'
           QUALIFY row_number() OVER (PARTITION BY local_id, rede_id, ano_meta ORDER BY ano_referencia DESC NULLS LAST, rede ASC NULLS LAST, valor_meta ASC NULLS LAST) = 1)
SELECT i.ano, i.id_municipio, nome_municipio, sigla_uf, nome_uf, nome_regiao, i.rede_id, dr.rede, taxa_alfabetizacao, media_portugues,
       y.valor_meta AS meta_ano, round(taxa_alfabetizacao - y.valor_meta, 2) AS gap_meta_ano, taxa_alfabetizacao >= y.valor_meta AS atingiu_meta_ano,
       f.valor_meta AS meta_2030, round(f.valor_meta - taxa_alfabetizacao, 2) AS gap_ate_2030
FROM silver_municipio i LEFT JOIN dim_municipio dm ON i.id_municipio = dm.id_municipio LEFT JOIN dim_rede dr ON i.rede_id = dr.rede_id
LEFT JOIN latest y ON y.local_id = i.id_municipio AND y.rede_id = i.rede_id AND y.ano_meta = i.ano
LEFT JOIN latest f ON f.local_id = i.id_municipio AND f.rede_id = i.rede_id AND f.ano_meta = 2030""")
def gold_fato_resultados(spark, sf_dir):
    """The real builder; years of the derived data from 2024 on meet targets."""
    t = TableSet(spark, sf_dir)
    return gold.fato_resultados(_fato_meta(t), gold.fato_indicador_municipio(silver_rows(t, "municipio")), _dim_municipio(t), _dim_rede(t))


# -- routing ---------------------------------------------------------------------
@register("layer_routing", _DIM_UF_SQL)
def layer_routing(spark, sf_dir):
    """S5 + S7: bronze to gold through renamed layers, the directory an external table."""
    from strata.plans.medallion import run_all
    t, root = TableSet(spark, sf_dir), shared_path(spark, "layer_routing", unique=True)
    place = f"{root}/elsewhere/directory"
    layers = Layers(root=root, names={"bronze": "raw", "silver": "trial_silver", "gold": "trial_gold"}, external={"municipio": place})
    write_layer(bronze(t, "uf"), layers, "bronze", "uf")
    write_layer(directory(t), layers, "external", "municipio")
    run_all(spark, layers, ["silver_uf", "gold_dim_uf"])
    files.remove_at_exit(spark, root)
    return read_layer(spark, Layers(root=root, names={"gold": "trial_gold"}), "gold", "dim_uf")


# -- live view ---------------------------------------------------------------------
def _landed(t: TableSet) -> DataFrame:
    """Messages of a few municipalities each, so that keys repeat and late ones lose."""
    keyed = t.events.withColumn("place", F.col("user_id") % 40)
    day = F.lpad((F.col("event_id") % 28 + 1).cast("string"), 2, "0")
    when = F.concat(F.lit('"2024-01-'), day, F.lit('T10:00:00Z"'))
    data = F.regexp_replace(F.regexp_replace(message(), F.lit('"id_municipio": "[0-9]+"'), F.concat(F.lit('"id_municipio": "'), F.col("place").cast("string"), F.lit('"'))),
                            F.lit('"2024-01-05T10:00:00Z"'), when)
    return keyed.select(data.alias("data"), F.col("ts").cast("timestamp").alias("publish_time"))


def _run_view(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The landed table, the dimension (places 0 to 29 of 40), and the view that the stream serves."""
    t, run = TableSet(spark, sf_dir), shared_path(spark, "streams", "live_view", unique=True)
    _landed(t).write.parquet(f"{run}/landed")
    landed = spark.read.parquet(f"{run}/landed")
    stream = spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", 1000).parquet(f"{run}/landed")
    views.run_measurement_stream(stream, f"{run}/table", f"{run}/checkpoint").awaitTermination()
    files.remove_at_exit(spark, run)
    dim = directory(t).filter("id_municipio < '0000030'").withColumnRenamed("nome", "nome_municipio")
    return landed, dim, views.serve(spark, f"{run}/table", dim)


_LIVE_SQL = f"""
WITH {_DIRECTORY_SQL}, e AS (SELECT *, event_id % 13 AS k, event_id % 13 NOT IN (8, 12) AS json FROM events),
typed AS (
  SELECT CASE WHEN json THEN 'e' || CAST(event_id AS VARCHAR) END AS evento_id,
         CASE WHEN NOT json OR k = 1 THEN NULL WHEN k = 10 THEN TIMESTAMP '2024-01-05 08:00:00' WHEN k = 11 THEN TIMESTAMP '2024-01-05 10:00:00'
              ELSE TIMESTAMP '2024-01-01 10:00:00' + INTERVAL 1 DAY * (event_id % 28) END AS event_timestamp,
         CASE WHEN NOT json OR k = 2 THEN NULL WHEN k = 3 THEN CAST(3000000000 AS BIGINT) ELSE CAST(2023 AS BIGINT) END AS ano,
         CASE WHEN json THEN lpad(CAST(user_id % 40 AS VARCHAR), 7, '0') END AS id_municipio,
         CASE WHEN json AND k <> 5 THEN '2' END AS rede,
         CASE WHEN json THEN CAST(event_id % 100 AS DOUBLE) + 0.5 END AS taxa_alfabetizacao,
         CASE WHEN json AND k <> 9 THEN CAST(700.25 AS DOUBLE) END AS media_portugues, ts
  FROM e WHERE k NOT IN (6, 7, 8)),
latest AS (SELECT * FROM typed QUALIFY row_number() OVER (PARTITION BY id_municipio, rede, ano
             ORDER BY event_timestamp DESC NULLS LAST, evento_id DESC NULLS LAST, ts DESC NULLS LAST) = 1)
SELECT ano, id_municipio, nome AS nome_municipio, sigla_uf, nome_regiao, rede, taxa_alfabetizacao, media_portugues, epoch_us(event_timestamp) AS event_micros
FROM latest LEFT JOIN (SELECT * FROM directory WHERE id_municipio < '0000030') d USING (id_municipio)"""


@register("live_view", _LIVE_SQL)
def live_view(spark, sf_dir):
    """G11 (T1-T4, J5): the served view; places without a directory row keep NULL names."""
    served = _run_view(spark, sf_dir)[2]
    return served.withColumn("event_timestamp", F.unix_micros("event_timestamp")).withColumnRenamed("event_timestamp", "event_micros")


@register("live_view_reconciled", f"SELECT m.metric, CASE WHEN m.metric LIKE 'rows%' THEN n ELSE 0 END AS value FROM (SELECT count(*) AS n FROM ({_LIVE_SQL}) v) c, "
          "(SELECT unnest(['rows_a', 'rows_b', 'only_in_a', 'only_in_b']) AS metric) m")
def live_view_reconciled(spark, sf_dir):
    """G11 + U4: the streamed view and the batch view over one landed table, compared row by row."""
    landed, dim, served = _run_view(spark, sf_dir)
    return reconcile_summary(served, views.batch_view(landed, dim))


# -- plain casts -------------------------------------------------------------------
@register("number_text", """
SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN CAST(o_orderkey AS INTEGER) WHEN 3 THEN -CAST(o_orderkey AS INTEGER) WHEN 4 THEN NULL
  WHEN 5 THEN 0 WHEN 6 THEN NULL WHEN 7 THEN NULL ELSE CAST(o_orderkey AS INTEGER) END AS whole,
  CASE o_orderkey % 9 WHEN 0 THEN 0.5 WHEN 1 THEN -0.5 WHEN 2 THEN CAST(o_orderkey AS DOUBLE) WHEN 3 THEN -CAST(o_orderkey AS DOUBLE) - 0.75 WHEN 7 THEN 1000.0
  WHEN 8 THEN CAST(o_orderkey AS DOUBLE) END AS number
FROM orders
""")
def number_text(spark, sf_dir):
    """C8: '.5', '-.5', tabs, line ends, a lone point, other white space, exponents."""
    k = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 9
    delivered = {0: F.lit(".5"), 1: F.lit("\t-.5"), 2: F.concat(F.lit("\t"), k, F.lit("\r\n")), 3: F.concat(F.lit("-"), k, F.lit(".75 ")), 4: F.concat(F.lit(" "), k),
                 5: F.lit("."), 6: F.lit(""), 7: F.lit("1e3"), 8: F.concat(k, F.lit("."))}
    text = F.lit(None).cast("string")
    for number, value in delivered.items():
        text = F.when(kind == number, value).otherwise(text)
    from strata.functions import text_to_int
    from strata.functions.casts import text_to_double
    texts = TableSet(spark, sf_dir).orders.select("o_orderkey", text.alias("text"))
    return texts.select("o_orderkey", text_to_int("text").alias("whole"), text_to_double("text").alias("number"))
