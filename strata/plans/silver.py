"""Bronze -> silver promotions of the literacy-indicator tables.

Each table is a ``SilverSpec``: contract columns, key, a cleaning projection,
row checks before and after de-duplication, and grouped reports.  ``promote``
runs one with two eager passes over the data (the gate pass and the write; the
original ran one Spark action per printed number), every other report being a
lazy DataFrame that costs nothing until it is read:

1. read bronze; Q1 required columns; P1 contract projection
2. clean (column expressions only; raw flag copies ride along for the raw gates)
3. ONE aggregation pass over the cleaned, pre-dedup rows: every pre-stage check
   and every gate -> report; ``enforce`` raises before anything is written
4. deterministic dedup -> clustered overwrite of the silver table
5. the post-stage checks are observed during the write itself (no extra pass);
   the grouped reports (each one grouped job) read the written files
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.functions import (
    decode, flag_to_bool, normalize_label, normalized_text, pad_id_guarded, pad_id_unguarded,
    safe_cast, trimmed_text,
    text_to_int,
)
from strata.functions.domains import (
    KNOWN_NETWORK_LABELS, LEVEL_COLUMNS, LEVEL_SUM_TOLERANCE, PUBLIC_LABEL, RARE_BOOKLET, STATES,
    TARGET_YEARS, VALID_BOOKLETS, VALID_GRADES, VALID_LITERACY_LEVELS, VALID_STUDENT_NETWORKS,
)
from strata.operators import quality as Q
from strata.operators.dedup import keep_one_per_key
from strata.operators.profile import by_frequency, value_profile
from strata.sources import Layers, clustered, read_layer, write_layer

AUDIT = ["_ingestao_timestamp", "_fonte"]
SILVER_TS = "_silver_timestamp"
TARGET_COLUMNS = [f"meta_alfabetizacao_{y}" for y in TARGET_YEARS]
PERCENT_COLUMNS = ["taxa_alfabetizacao", *TARGET_COLUMNS, "percentual_participacao"]
MEASURE_COLUMNS = ["taxa_alfabetizacao", "media_portugues", *LEVEL_COLUMNS]
STUDENT_FLAGS = ["presenca", "preenchimento_caderno", "alfabetizado"]


@dataclass
class SilverSpec:
    table: str                                   # silver table name
    source: str                                  # bronze table name
    columns: list[str]                           # P1 contract (also Q1 unless check_schema=False)
    keys: list[str]                              # natural key of the cleaned rows
    clean: Callable[[DataFrame], DataFrame]      # cleaned, typed, pre-dedup (may carry __raw_* columns)
    pre_checks: Callable[[], list[Q.Check]]      # on the cleaned pre-dedup rows (gates live here)
    post_checks: Callable[[], list[Q.Check]]     # on the written silver rows
    grouped: Callable[[DataFrame], dict[str, DataFrame]] = lambda df: {}
    cluster_by: list[str] = field(default_factory=list)
    check_schema: bool = True
    profile_columns: list[str] = field(default_factory=list)  # Q25 on the raw contract columns


def _c(name: str) -> Column:
    return F.col(name)


def _drop_raw(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__raw_")])


def build(spec: SilverSpec, bronze: DataFrame, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Return ``(cleaned pre-dedup rows, silver rows)`` — both lazy."""
    if spec.check_schema:
        Q.require_columns(bronze, spec.columns)
    cleaned = spec.clean(bronze.select(*spec.columns))
    silver = keep_one_per_key(_drop_raw(cleaned), spec.keys)
    silver = silver.withColumn(SILVER_TS, at if at is not None else F.current_timestamp())
    return cleaned, silver


def pre_report(spec: SilverSpec, cleaned: DataFrame) -> DataFrame:
    return Q.run_checks(cleaned, [Q.row_count(), *spec.pre_checks()], "pre")


def post_report(spec: SilverSpec, silver: DataFrame) -> DataFrame:
    return Q.run_checks(silver, [Q.row_count(), *spec.post_checks()], "post")


@dataclass
class Promotion:
    table: str
    location: str
    pre: DataFrame
    post: DataFrame
    duplicates_before: DataFrame
    duplicates_after: DataFrame
    grouped: dict


def promote(spark: SparkSession, spec: SilverSpec, layers: Layers, at: Column | None = None) -> Promotion:
    """Run one promotion: gate, write, report (see module docstring)."""
    bronze = read_layer(spark, layers, "bronze", spec.source)
    cleaned, silver = build(spec, bronze, at)
    pre = pre_report(spec, cleaned)
    if spec.check_schema:
        pre = Q.contract_report(bronze, spec.columns).unionByName(pre)
    pre_rows = pre.collect()                      # one row per check
    pre = spark.createDataFrame(pre_rows, pre.schema)
    Q.enforce(pre)                                # Q26: stop before the write
    # post-stage checks ride on the write itself (Observation): no second pass.
    # They sit above the range exchange, so the range sampler never feeds them.
    laid_out = clustered(silver, spec.cluster_by) if spec.cluster_by else silver
    observed, post = Q.observe_checks(laid_out, [Q.row_count(), *spec.post_checks()], "post")
    loc = write_layer(observed, layers, "silver", spec.table)
    written = read_layer(spark, layers, "silver", spec.table)
    grouped = spec.grouped(written)
    if spec.profile_columns:
        grouped["domain_profile"] = domain_profile(bronze.select(*spec.columns), spec.profile_columns)
    return Promotion(
        table=spec.table, location=loc, pre=pre, post=post(spark),
        duplicates_before=Q.duplicate_summary(_drop_raw(cleaned), spec.keys),
        duplicates_after=Q.duplicate_summary(written, spec.keys),
        grouped=grouped,
    )


def domain_profile(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q25 + O1: value frequencies of raw columns, most frequent first, then value
    (NULLs first) — all columns in one job."""
    return by_frequency(value_profile(raw, columns, "count"), "count", ["column_name", "value"])


def _cast_all(df: DataFrame, names: Sequence[str], to: str) -> dict[str, Column]:
    return {c: safe_cast(df, c, to) for c in names}


# --- B1 students ---------------------------------------------------------------

STUDENT_COLUMNS = ["ano", "id_municipio", "id_escola", "id_aluno", "caderno", "serie", "rede", "presenca",
                   "preenchimento_caderno", "alfabetizado", "proficiencia", "peso_aluno", *AUDIT]


def clean_students(df: DataFrame) -> DataFrame:
    mun = normalized_text("id_municipio")
    flags = {f"{f}_id": safe_cast(df, f, "int") for f in STUDENT_FLAGS}
    out = df.select(
        safe_cast(df, "ano", "int").alias("ano"),
        pad_id_guarded(mun).alias("id_municipio"),
        normalized_text("id_escola").alias("id_escola"),
        normalized_text("id_aluno").alias("id_aluno"),
        F.upper(normalized_text("caderno")).alias("caderno"),
        text_to_int(normalized_text("serie")).alias("serie"),
        F.upper(normalized_text("rede")).alias("rede_id"),
        *[flags[f"{f}_id"].alias(f"{f}_id") for f in STUDENT_FLAGS],
        safe_cast(df, "proficiencia", "double").alias("proficiencia"),
        safe_cast(df, "peso_aluno", "double").alias("peso_aluno"),
        _c("_ingestao_timestamp").try_cast("timestamp").alias("_ingestao_timestamp"),
        normalized_text("_fonte").alias("_fonte"),
        *[_c(f).alias(f"__raw_{f}") for f in STUDENT_FLAGS],
    )
    return out.select(
        *[c for c in out.columns if not c.startswith("__raw_")],
        decode("rede_id").alias("rede"),
        *[flag_to_bool(f"{f}_id").alias(f) for f in STUDENT_FLAGS],
        *[c for c in out.columns if c.startswith("__raw_")],
    )


def student_pre_checks() -> list[Q.Check]:
    return [
        *[Q.Check("raw_flag_domain", f, Q.raw_flag_domain(f"__raw_{f}").violation, Q.GATE) for f in STUDENT_FLAGS],
        Q.outside_domain("caderno", VALID_BOOKLETS, severity=Q.GATE),
        Q.outside_domain("serie", VALID_GRADES, severity=Q.GATE),
        Q.outside_domain("rede_id", VALID_STUDENT_NETWORKS, severity=Q.GATE),
        Q.rule("rare_code", "caderno", _c("caderno") == RARE_BOOKLET),
        *[Q.undecoded(f"{f}_id", f, severity=Q.GATE) for f in STUDENT_FLAGS],
    ]


def student_post_checks() -> list[Q.Check]:
    return [
        Q.pattern_mismatch("id_municipio", "^[0-9]{7}$"),
        Q.pattern_mismatch("id_escola", "^[0-9]{8}$"),
        *Q.nulls("ano", "id_aluno", "serie", "rede_id", "presenca_id", "preenchimento_caderno_id",
                 "alfabetizado_id", *AUDIT),
        Q.out_of_range("proficiencia", 0.0, None, name="sign"),
        Q.out_of_range("peso_aluno", 0.0, None, name="sign", low_inclusive=False),
        Q.required_when("required_when_filled", _c("preenchimento_caderno_id") == 1, ["proficiencia", "peso_aluno"]),
        Q.rule("absent_but_filled", "presenca_id,preenchimento_caderno_id",
               (_c("presenca_id") == 0) & (_c("preenchimento_caderno_id") == 1)),
        Q.rule("literate_not_filled", "alfabetizado_id,preenchimento_caderno_id",
               (_c("alfabetizado_id") == 1) & (_c("preenchimento_caderno_id") != 1)),
    ]


def _by_key(df: DataFrame, *keys: str) -> DataFrame:
    """O2: small per-group reports in key order."""
    return df.orderBy(*keys)


def _by_count(df: DataFrame, count_col: str = "n") -> DataFrame:
    """O1 (frequency only): listings most frequent first."""
    return df.orderBy(F.col(count_col).desc())


def student_grouped(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "unmapped_networks": _by_count(Q.unmapped_codes(df, "rede_id", "rede")),
        "schools_in_many_municipalities": Q.functional_dependency(
            df, ["ano", "id_escola"], "id_municipio", skip_null=["id_escola"]),
    }


STUDENTS = SilverSpec("aluno", "alunos", STUDENT_COLUMNS, ["ano", "id_aluno"], clean_students,
                      student_pre_checks, student_post_checks, student_grouped,
                      ["ano", "id_municipio", "id_escola", "rede_id"],
                      profile_columns=["caderno", "serie", "rede", *STUDENT_FLAGS])


# --- B2 municipal indicators ---------------------------------------------------

MUNICIPALITY_COLUMNS = ["ano", "id_municipio", "serie", "rede", *MEASURE_COLUMNS]


def clean_municipality(df: DataFrame) -> DataFrame:
    """Unguarded padding, plain trim (keeps ''), measures left as delivered,
    audit columns not carried.  (The original stamped the layer timestamp before
    the dedup; it is one constant per run, so stamping after it is the same.)"""
    out = df.select(
        safe_cast(df, "ano", "int").alias("ano"),
        pad_id_unguarded("id_municipio").alias("id_municipio"),
        text_to_int(trimmed_text("serie")).alias("serie"),
        trimmed_text("rede").alias("rede_id"),
        *MEASURE_COLUMNS,
    )
    return out.select("*", decode("rede_id").alias("rede"))


def municipality_post_checks() -> list[Q.Check]:
    return [
        Q.pattern_mismatch("id_municipio", "^[0-9]{7}$", skip_null=False),
        Q.out_of_range("taxa_alfabetizacao", 0.0, 100.0, nan=False),
        *Q.nulls("ano", "id_municipio", "rede", "taxa_alfabetizacao", "media_portugues"),
    ]


def municipality_grouped(df: DataFrame) -> dict[str, DataFrame]:
    # distinct codes without a label, NULL code included (as listed originally)
    return {"unmapped_networks": df.filter(_c("rede").isNull()).select("rede_id").distinct()}


MUNICIPALITY = SilverSpec("municipio", "municipio", MUNICIPALITY_COLUMNS, ["ano", "id_municipio", "serie", "rede_id"],
                          clean_municipality, lambda: [], municipality_post_checks, municipality_grouped,
                          ["ano", "rede_id"], check_schema=False)


# --- B3 state indicators -------------------------------------------------------

STATE_COLUMNS = ["ano", "sigla_uf", "serie", "rede", *MEASURE_COLUMNS, *AUDIT]


def clean_state(df: DataFrame) -> DataFrame:
    measures = _cast_all(df, MEASURE_COLUMNS, "double")
    out = df.select(
        safe_cast(df, "ano", "int").alias("ano"),
        F.upper(trimmed_text("sigla_uf")).alias("sigla_uf"),
        text_to_int(trimmed_text("serie")).alias("serie"),
        trimmed_text("rede").alias("rede_id"),
        *[measures[c].alias(c) for c in MEASURE_COLUMNS],
        _c("_ingestao_timestamp").try_cast("timestamp").alias("_ingestao_timestamp"),
        trimmed_text("_fonte").alias("_fonte"),
    )
    return out.select("*", decode("rede_id").alias("rede"))


def state_post_checks() -> list[Q.Check]:
    lo, hi = LEVEL_SUM_TOLERANCE
    return [
        Q.outside_domain("sigla_uf", STATES),
        Q.outside_domain("serie", VALID_GRADES),
        *Q.nulls("ano", "sigla_uf", "serie", "rede_id", "taxa_alfabetizacao", "media_portugues", *AUDIT),
        Q.out_of_range("taxa_alfabetizacao", 0.0, 100.0),
        Q.out_of_range("media_portugues", 0.0, None, name="sign"),
        *[Q.out_of_range(c, 0.0, 100.0, only_filled=True) for c in LEVEL_COLUMNS],
        Q.partial_fill(LEVEL_COLUMNS),
        Q.sum_outside(LEVEL_COLUMNS, lo, hi),
    ]


def state_grouped(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "unmapped_networks": _by_count(Q.unmapped_codes(df, "rede_id", "rede")),
        "levels_filled_by_year": _by_key(
            Q.fill_distribution(df, ["ano"], LEVEL_COLUMNS, "qtd_niveis_preenchidos", "count"),
            "ano", "qtd_niveis_preenchidos"),
        "states_by_year": _by_key(Q.distinct_per_group(df, ["ano"], "sigla_uf", "qtd_ufs"), "ano"),
    }


STATE = SilverSpec("uf", "uf", STATE_COLUMNS, ["ano", "sigla_uf", "serie", "rede_id"], clean_state,
                   lambda: [], state_post_checks, state_grouped, ["ano", "sigla_uf", "rede_id"],
                   profile_columns=["ano", "sigla_uf", "serie", "rede"])


# --- B4-B6 literacy targets ------------------------------------------------------

def _clean_targets(df: DataFrame, place: str | None, extra: dict[str, Column] | None = None) -> DataFrame:
    percents = _cast_all(df, PERCENT_COLUMNS, "double")
    cols = {"ano": safe_cast(df, "ano", "int")}
    if place == "sigla_uf":
        cols["sigla_uf"] = F.upper(trimmed_text("sigla_uf"))
    elif place == "id_municipio":
        cols["id_municipio"] = pad_id_guarded(trimmed_text("id_municipio"))
    cols["rede"] = normalize_label("rede")
    cols.update(extra or {})
    cols.update({c: percents[c] for c in PERCENT_COLUMNS})
    cols["_ingestao_timestamp"] = _c("_ingestao_timestamp").try_cast("timestamp")
    cols["_fonte"] = trimmed_text("_fonte")
    return df.select(*[(cols[c] if c in cols else _c(c)).alias(c) for c in df.columns])


def _target_checks(columns: Sequence[str], only_filled: bool) -> list[Q.Check]:
    return [
        *Q.nulls(*columns),
        *[Q.out_of_range(c, 0.0, 100.0, only_filled=only_filled) for c in PERCENT_COLUMNS],
        Q.decreasing(TARGET_COLUMNS),
    ]


COUNTRY_TARGET_COLUMNS = ["ano", "rede", *PERCENT_COLUMNS, *AUDIT]
COUNTRY_TARGETS = SilverSpec(
    "meta_alfabetizacao_brasil", "meta_alfabetizacao_brasil", COUNTRY_TARGET_COLUMNS, ["ano", "rede"],
    lambda df: _clean_targets(df, None), lambda: [],
    lambda: _target_checks(COUNTRY_TARGET_COLUMNS, only_filled=False),
    lambda df: {"labels_other_than_public": _by_count(Q.unknown_labels(df, "rede", [PUBLIC_LABEL], "count"), "count")},
    ["ano", "rede"], profile_columns=["rede"])

STATE_TARGET_COLUMNS = ["ano", "sigla_uf", "rede", *PERCENT_COLUMNS, *AUDIT]
STATE_TARGETS = SilverSpec(
    "meta_alfabetizacao_uf", "meta_alfabetizacao_uf", STATE_TARGET_COLUMNS, ["ano", "sigla_uf", "rede"],
    lambda df: _clean_targets(df, "sigla_uf"), lambda: [],
    lambda: [Q.outside_domain("sigla_uf", STATES), *_target_checks(STATE_TARGET_COLUMNS, only_filled=True),
             Q.null_parity("taxa_alfabetizacao", "percentual_participacao")],
    lambda df: {
        "unknown_networks": _by_count(Q.unknown_labels(df, "rede", KNOWN_NETWORK_LABELS, "count"), "count"),
        "targets_filled_by_year": _by_key(
            Q.fill_distribution(df, ["ano"], TARGET_COLUMNS, "qtd_metas_preenchidas", "count"),
            "ano", "qtd_metas_preenchidas"),
        "states_by_year": _by_key(Q.distinct_per_group(df, ["ano"], "sigla_uf", "qtd_ufs"), "ano"),
    },
    ["ano", "sigla_uf", "rede"], profile_columns=["ano", "sigla_uf", "rede"])

MUNICIPALITY_TARGET_COLUMNS = ["ano", "id_municipio", "rede", "taxa_alfabetizacao", *TARGET_COLUMNS,
                               "nivel_alfabetizacao", "percentual_participacao", *AUDIT]
MUNICIPALITY_TARGETS = SilverSpec(
    "meta_alfabetizacao_municipio", "meta_alfabetizacao_municipio", MUNICIPALITY_TARGET_COLUMNS,
    ["ano", "id_municipio", "rede"],
    lambda df: _clean_targets(df, "id_municipio", {"nivel_alfabetizacao": safe_cast(df, "nivel_alfabetizacao", "int")}),
    lambda: [],
    lambda: [Q.pattern_mismatch("id_municipio", "^[0-9]{7}$"),
             Q.outside_domain("nivel_alfabetizacao", VALID_LITERACY_LEVELS),
             *_target_checks(MUNICIPALITY_TARGET_COLUMNS, only_filled=True),
             Q.partial_fill(["taxa_alfabetizacao", "nivel_alfabetizacao", "percentual_participacao"],
                            name="partial_result", count_nulls=True)],
    lambda df: {
        "unknown_networks": _by_count(Q.unknown_labels(df, "rede", KNOWN_NETWORK_LABELS, "count"), "count"),
        "target_nulls_by_year": _by_key(Q.nulls_per_group(df, ["ano"], TARGET_COLUMNS, "nulos_"), "ano"),
    },
    ["ano", "id_municipio", "rede"], profile_columns=["ano", "rede", "nivel_alfabetizacao"])

SILVER_SPECS = {s.table: s for s in (STUDENTS, MUNICIPALITY, STATE, COUNTRY_TARGETS, STATE_TARGETS,
                                     MUNICIPALITY_TARGETS)}
