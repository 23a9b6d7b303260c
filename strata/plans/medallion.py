"""The full batch run — bronze copies, silver promotions, gold in dependency order.

Every step is an entry of one registry (``STEPS``): what it writes, and how.
Bronze copies stamp raw tables (S4); they run when the run is told where those
are.  Silver tables are written once and every gold step reads the written tables
(the lineage is cut at each layer, so a lost executor never recomputes the
bronze cleaning).  Gold order: dimensions, projections, ``fato_meta`` (needs
``dim_rede``), ``fato_resultados`` last.  After gold, the integrity report of
the star (J6) is stored as ``gold.integrity`` and stops the run if a fact has
keys that its dimension lacks.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from strata.plans import gold
from strata.plans.silver import SILVER_SPECS, Promotion, promote
from strata.sources import Layers, ingest, layer_exists, read_layer, write_layer

# The raw tables and the data set they come from
BRONZE_TABLES = ["alunos", "dicionario", "meta_alfabetizacao_brasil", "meta_alfabetizacao_municipio",
                 "meta_alfabetizacao_uf", "municipio", "uf"]
RAW_DATASET = "basedosdados.br_inep_avaliacao_alfabetizacao"
DIRECTORY = "municipio"          # external reference table name in Layers.external
INTEGRITY = "integrity"          # gold table of the last integrity report

# gold table -> builder and the tables it takes, as (layer, table), in dependency order
GOLD_BUILDS: dict[str, tuple[Callable, list[tuple[str, str]]]] = {
    "dim_tempo": (gold.dim_tempo, []),
    "dim_uf": (gold.dim_uf, [("silver", "uf"), ("external", DIRECTORY)]),
    "dim_municipio": (gold.dim_municipio, [("silver", "municipio"), ("silver", "aluno"),
                                           ("silver", "meta_alfabetizacao_municipio"), ("external", DIRECTORY)]),
    "dim_rede": (gold.dim_rede, [("silver", "municipio"), ("silver", "aluno"), ("silver", "uf")]),
    "fato_aluno": (gold.fato_aluno, [("silver", "aluno")]),
    "fato_indicador_municipio": (gold.fato_indicador_municipio, [("silver", "municipio")]),
    "fato_indicador_uf": (gold.fato_indicador_uf, [("silver", "uf")]),
    "fato_meta": (gold.fato_meta, [("silver", "meta_alfabetizacao_brasil"), ("silver", "meta_alfabetizacao_uf"),
                                   ("silver", "meta_alfabetizacao_municipio"), ("gold", "dim_rede")]),
    "fato_resultados": (gold.fato_resultados, [("gold", "fato_meta"), ("gold", "fato_indicador_municipio"),
                                               ("gold", "dim_municipio"), ("gold", "dim_rede")]),
}
GOLD_STEPS = list(GOLD_BUILDS)
SILVER_STEPS = list(SILVER_SPECS)


@dataclass(frozen=True)
class Run:
    """What the steps of one run share."""
    spark: SparkSession
    layers: Layers
    raw: dict[str, str]          # raw table -> location; a table that is not there has no copy to make
    at: Column | None = None


def _bronze(table: str, run: Run) -> str:
    return ingest(run.spark, run.layers, run.raw[table], table, f"{RAW_DATASET}.{table}")


def _silver(table: str, run: Run) -> Promotion:
    return promote(run.spark, SILVER_SPECS[table], run.layers, run.at)


def _gold(table: str, run: Run) -> str:
    build, takes = GOLD_BUILDS[table]
    frames = [read_layer(run.spark, run.layers, layer, name) for layer, name in takes]
    return write_layer(build(*frames) if takes else build(run.spark), run.layers, "gold", table)


# step name -> what runs it, in dependency order
STEPS: dict[str, Callable[[Run], Promotion | str]] = {
    **{f"bronze_{t}": partial(_bronze, t) for t in BRONZE_TABLES},
    **{f"silver_{t}": partial(_silver, t) for t in SILVER_STEPS},
    **{f"gold_{t}": partial(_gold, t) for t in GOLD_STEPS},
}


def resolve_steps(only: Iterable[str] | None, bronze: bool = False) -> list[str]:
    """Steps to run, always in dependency order; 'bronze' / 'silver' / 'gold' select a layer.

    Without a choice, all of silver and gold, and bronze if ``bronze``.
    """
    if not only:
        only = ["bronze"] * bronze + ["silver", "gold"]
    wanted = set()
    for name in only:
        chosen = {s for s in STEPS if s.startswith(f"{name}_")} if name in ("bronze", "silver", "gold") else {name} & STEPS.keys()
        if not chosen:
            raise ValueError(f"unknown step {name!r}")
        wanted |= chosen
    return [s for s in STEPS if s in wanted]


def run_all(spark: SparkSession, layers: Layers, only: Iterable[str] | None = None, at: Column | None = None,
            raw: dict[str, str] | None = None, gate: bool = True) -> dict[str, Promotion | str | DataFrame]:
    """Run the selected steps; returns bronze and gold locations, silver promotion reports and the integrity report.

    ``raw`` says where raw tables are, and makes the bronze copies part of the
    run.  With ``gate`` the stored integrity report stops the run on orphans.
    """
    run = Run(spark, layers, raw or {}, at)
    steps = resolve_steps(only, bronze=bool(raw))
    missing = [s for s in steps if s.startswith("bronze_") and s[7:] not in run.raw]
    if missing:
        raise ValueError(f"no raw table for {', '.join(missing)}")
    out: dict[str, Promotion | str | DataFrame] = {step: STEPS[step](run) for step in steps}
    if any(s.startswith("gold_") for s in steps):
        write_layer(integrity_report(spark, layers), layers, "gold", INTEGRITY)
        out["gold_integrity"] = read_layer(spark, layers, "gold", INTEGRITY)
        if gate:
            gold.enforce_integrity(out["gold_integrity"])
    return out


def integrity_report(spark: SparkSession, layers: Layers) -> DataFrame:
    """J6 over whatever gold tables exist: (relationship, orphan_rows, orphan_keys)."""
    built = [t for t in GOLD_STEPS if layer_exists(spark, layers, "gold", t)]
    tables = {t: read_layer(spark, layers, "gold", t) for t in built}
    return gold.gold_integrity(tables)


def main(argv: list[str] | None = None) -> None:
    """``python -m strata.plans.medallion --root PATH [--raw PATH] [--directory PATH] [--only STEP ...]``"""
    import argparse

    from strata.session import build_session

    parser = argparse.ArgumentParser(description="bronze copies, silver promotions and gold builds")
    parser.add_argument("--root", required=True, help="folder holding the bronze/silver/gold layers")
    parser.add_argument("--raw", help="folder holding the raw tables, one parquet folder each; adds the bronze copies to the run")
    parser.add_argument("--directory", help="location of the external municipality directory")
    parser.add_argument("--only", nargs="+", help="'bronze', 'silver', 'gold' or step names such as silver_uf gold_dim_uf")
    parser.add_argument("--layer", nargs="+", default=[], metavar="LAYER=NAME",
                        help="rename a layer's folder, e.g. silver=silver_test (runs against test layers)")
    parser.add_argument("--catalog", action="store_true", help="layers are catalog schemas, not folders")
    parser.add_argument("--no-gate", action="store_true", help="store the integrity report, but do not stop on orphans")
    args = parser.parse_args(argv)
    names = {"bronze": "bronze", "silver": "silver", "gold": "gold"}
    for item in args.layer:
        layer, _, name = item.partition("=")
        if layer not in names or not name:
            parser.error(f"bad --layer {item!r}; expected bronze|silver|gold=NAME")
        names[layer] = name
    layers = Layers(root=args.root, catalog=args.catalog, names=names,
                    external={DIRECTORY: args.directory} if args.directory else {})
    raw = {t: f"{args.raw.rstrip('/')}/{t}" for t in BRONZE_TABLES} if args.raw else None
    started = SparkSession.getActiveSession() is None
    spark = build_session(app_name="strata-medallion")
    try:
        for step, result in run_all(spark, layers, args.only, raw=raw, gate=not args.no_gate).items():
            print(step, result if isinstance(result, str) else "stored" if isinstance(result, DataFrame) else result.location)
    finally:
        if started:
            spark.stop()


if __name__ == "__main__":
    main()
