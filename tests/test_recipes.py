"""Silver promotions and gold builders on the FIXTURES.md rows; expectations
written by hand from the rules."""
import math

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import QualityGateError
from strata.plans import gold
from strata.plans.medallion import resolve_steps, run_all
from strata.plans.silver import SILVER_SPECS, build, promote
from strata.sources import Layers, read_layer, stamp, write_layer
from tests import fixtures as fx


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layers"))
    lay = Layers(root=root, external={"municipio": f"{root}/external/municipio"})
    for name, df in fx.bronze_tables(spark).items():
        write_layer(df, lay, "bronze", name)
    spark.createDataFrame(fx.DIRECTORY, fx.DIRECTORY_SCHEMA).write.parquet(lay.external["municipio"])
    return lay


@pytest.fixture(scope="module")
def ran(spark, layers):
    return run_all(spark, layers, at=F.lit("2024-06-01 00:00:00").cast("timestamp"))


def report(promotion, stage="post"):
    df = promotion.pre if stage == "pre" else promotion.post
    return {(r.check_name, r.column_name): r.violations for r in df.collect()}


def test_student_columns_and_survivors(spark, layers, ran):
    s = read_layer(spark, layers, "silver", "aluno")
    assert s.columns == ["ano", "id_municipio", "id_escola", "id_aluno", "caderno", "serie", "rede_id",
                         "presenca_id", "preenchimento_caderno_id", "alfabetizado_id", "proficiencia", "peso_aluno",
                         "_ingestao_timestamp", "_fonte", "rede", "presenca", "preenchimento_caderno",
                         "alfabetizado", "_silver_timestamp"]
    rows = {(r.ano, r.id_aluno): r for r in s.collect()}
    assert len(rows) == 7
    assert rows[(2023, "A1")].proficiencia == 250.5          # deterministic survivor
    assert rows[(2023, "A1")].id_municipio == "0000012"
    assert rows[(2024, "A1")].id_municipio == "0012345"     # 5 digits padded
    assert rows[(2023, "A2")].id_municipio == "123456789"    # guarded: not truncated
    assert rows[(2023, "A3")].id_municipio == "ABCDE"
    assert rows[(2023, None)].id_municipio is None and rows[(2023, None)].proficiencia == 100.0
    assert rows[(2023, "A4")].rede is None and rows[(2023, "A4")].rede_id is None
    assert rows[(2023, "A1")].rede == "Municipal" and rows[(2023, "A1")].presenca is True
    assert math.isnan(rows[(2023, "A5")].proficiencia)


def test_student_reports(ran):
    p = ran["silver_aluno"]
    pre = report(p, "pre")
    assert pre[("row_count", None)] == 10 and pre[("rare_code", "caderno")] == 1
    assert all(v == 0 for (name, _), v in pre.items() if name not in ("row_count", "rare_code"))
    post = report(p)
    assert post[("row_count", None)] == 7
    assert post[("format", "id_municipio")] == 2 and post[("format", "id_escola")] == 1
    assert post[("nulls", "id_aluno")] == 1 and post[("nulls", "rede_id")] == 1
    assert post[("sign", "proficiencia")] == 2 and post[("sign", "peso_aluno")] == 1
    assert post[("required_when_filled", "proficiencia,peso_aluno")] == 1
    assert post[("absent_but_filled", "presenca_id,preenchimento_caderno_id")] == 1
    assert post[("literate_not_filled", "alfabetizado_id,preenchimento_caderno_id")] == 1
    d = p.duplicates_before.first()
    assert (d.dup_keys, d.dup_rows, d.surplus_rows) == (2, 5, 3)
    assert p.duplicates_after.first().dup_keys == 0
    fd = [tuple(r) for r in p.grouped["schools_in_many_municipalities"].collect()]
    assert fd == [(2023, "12345678", 3)]
    assert p.grouped["unmapped_networks"].count() == 0
    prof = [tuple(r) for r in p.grouped["domain_profile"].collect()]
    assert prof[0] == ("serie", "2", 10)                    # most frequent first
    assert ("rede", None, 1) in prof and ("caderno", "43", 1) in prof
    assert prof.index(("rede", None, 1)) < prof.index(("rede", "2", 1))   # NULL first among ties


@pytest.mark.parametrize("bad", [
    ("presenca", "2"),      # flag outside {0,1}
    ("rede", "9"),          # unknown network code
    ("caderno", "22"),      # booklet outside the domain
])
def test_student_gates_stop_before_write(spark, tmp_path, bad):
    col, value = bad
    lay = Layers(root=str(tmp_path))
    df = spark.createDataFrame(fx.STUDENTS, fx.STUDENT_SCHEMA).withColumn(col, F.lit(value))
    write_layer(df, lay, "bronze", "alunos")
    with pytest.raises(QualityGateError):
        promote(spark, SILVER_SPECS["aluno"], lay)
    assert not (tmp_path / "silver" / "aluno").exists()


def test_double_flag_fails_gate(spark, tmp_path):
    lay = Layers(root=str(tmp_path))
    df = spark.createDataFrame(fx.STUDENTS, fx.STUDENT_SCHEMA).withColumn("alfabetizado", F.lit(1.0))
    write_layer(df, lay, "bronze", "alunos")
    with pytest.raises(QualityGateError, match="raw_flag_domain"):
        promote(spark, SILVER_SPECS["aluno"], lay)


def test_empty_bronze_promotes_with_zero_counts(spark, tmp_path):
    lay = Layers(root=str(tmp_path))
    write_layer(spark.createDataFrame([], fx.STUDENT_SCHEMA), lay, "bronze", "alunos")
    p = promote(spark, SILVER_SPECS["aluno"], lay)
    assert report(p, "pre")[("row_count", None)] == 0 and report(p)[("row_count", None)] == 0


def test_missing_column_raises(spark):
    df = spark.createDataFrame(fx.STUDENTS, fx.STUDENT_SCHEMA).drop("peso_aluno")
    with pytest.raises(QualityGateError, match="peso_aluno"):
        build(SILVER_SPECS["aluno"], df)


def test_municipality(spark, layers, ran):
    s = read_layer(spark, layers, "silver", "municipio")
    assert "_ingestao_timestamp" not in s.columns and s.columns[-2:] == ["rede", "_silver_timestamp"]
    rows = sorted((tuple(r[:4]) + (r.taxa_alfabetizacao, r.rede) for r in s.collect()), key=str)
    assert rows == sorted([(2024, "0000012", 2, "3", 55.0, "Municipal"), (2024, "1234567", 2, "9", 101.0, None),
                           (2024, "7654321", 2, None, -1.0, None), (2023, "0000012", 2, "3", 50.0, "Municipal")], key=str)
    post = report(ran["silver_municipio"])
    assert post[("format", "id_municipio")] == 0 and post[("range", "taxa_alfabetizacao")] == 2
    assert post[("nulls", "rede")] == 2
    unmapped = {r.rede_id for r in ran["silver_municipio"].grouped["unmapped_networks"].collect()}
    assert unmapped == {"9", None}


def test_state(ran):
    p = ran["silver_uf"]
    post = report(p)
    assert post[("domain", "sigla_uf")] == 1 and post[("domain", "serie")] == 1
    assert post[("partial_fill", ",".join(fx.LEVEL_COLUMNS))] == 1
    assert post[("sum_tolerance", ",".join(fx.LEVEL_COLUMNS))] == 1
    dist = [tuple(r) for r in p.grouped["levels_filled_by_year"].collect()]
    assert dist == [(2024, 0, 1), (2024, 4, 1), (2024, 9, 2)]            # in key order (O2)
    assert [tuple(r) for r in p.grouped["states_by_year"].collect()] == [(2024, 4)]


def test_targets(spark, layers, ran):
    b = read_layer(spark, layers, "silver", "meta_alfabetizacao_brasil")
    assert sorted((r.ano, r.rede) for r in b.collect() if r.rede) == [(2023, "Municipal"), (2023, "Pública")]
    post = report(ran["silver_meta_alfabetizacao_brasil"])
    targets = ",".join(f"meta_alfabetizacao_{y}" for y in range(2024, 2031))
    assert post[("decreasing", targets)] == 1 and post[("nulls", "rede")] == 1
    listing = [tuple(r) for r in ran["silver_meta_alfabetizacao_brasil"].grouped["labels_other_than_public"].collect()]
    assert listing == [("Municipal", 1)]
    uf = report(ran["silver_meta_alfabetizacao_uf"])
    assert uf[("null_parity", "taxa_alfabetizacao,percentual_participacao")] == 1
    assert uf[("domain", "sigla_uf")] == 1
    m = report(ran["silver_meta_alfabetizacao_municipio"])
    assert m[("domain", "nivel_alfabetizacao")] == 1
    assert m[("decreasing", targets)] == 0          # the NULL hides the drop
    assert m[("partial_result", "taxa_alfabetizacao,nivel_alfabetizacao,percentual_participacao")] == 1
    unknown = {tuple(r) for r in ran["silver_meta_alfabetizacao_municipio"].grouped["unknown_networks"].collect()}
    assert unknown == {("Desconhecida", 1)}


def test_gold_dimensions(spark, layers, ran):
    g = lambda t: read_layer(spark, layers, "gold", t)
    assert [tuple(r) for r in g("dim_tempo").orderBy("ano").collect()][:3] == [
        (2023, "realizado"), (2024, "realizado"), (2025, "projetado")]
    assert g("dim_tempo").count() == 8
    rede = sorted((tuple(r) for r in g("dim_rede").collect()), key=str)
    assert rede == sorted([("2", "Estadual"), ("3", "Municipal"), ("4", "Privada"), ("9", None)], key=str)
    mun = g("dim_municipio")
    assert mun.filter(F.col("id_municipio") == "1234567").count() == 2       # directory fan-out kept
    assert mun.filter(F.col("id_municipio").isNull()).count() == 1           # NULL id kept
    assert mun.filter(F.col("id_municipio") == "7654321").first().nome_municipio is None
    assert g("dim_uf").count() == 4


def test_gold_facts(spark, layers, ran):
    g = lambda t: read_layer(spark, layers, "gold", t)
    meta = g("fato_meta")
    assert meta.columns == ["rede", "nivel_geografico", "local_id", "ano_referencia", "ano_meta", "valor_meta", "rede_id"]
    pub = meta.filter(F.col("rede") == "Pública")
    assert pub.count() > 0 and pub.filter(F.col("rede_id").isNotNull()).count() == 0   # label mismatch kept
    assert meta.filter(F.col("valor_meta").isNull()).count() == 0
    res = g("fato_resultados")
    assert res.columns == gold.RESULT_COLUMNS
    rows = res.collect()
    assert len(rows) == 5
    r24 = [r for r in rows if r.ano == 2024 and r.id_municipio == "0000012"][0]
    assert (r24.meta_ano, r24.gap_meta_ano, r24.atingiu_meta_ano, r24.meta_2030, r24.gap_ate_2030) == \
        (57.0, -2.0, False, 70.0, 15.0)
    r23 = [r for r in rows if r.ano == 2023 and r.id_municipio == "0000012"][0]
    assert r23.meta_ano is None and r23.gap_ate_2030 == 20.0 and r23.nome_municipio == "Cidade A"
    assert len([r for r in rows if r.id_municipio == "1234567"]) == 2


def test_null_code_partition_keeps_one(spark):
    meta = spark.createDataFrame(
        [("Pública", "municipio", "0000012", 2024, 2030, 70.0, None),
         ("Desconhecida", "municipio", "0000012", 2024, 2030, 72.0, None)],
        "rede string, nivel_geografico string, local_id string, ano_referencia int, ano_meta int, "
        "valor_meta double, rede_id string")
    from strata.operators.dedup import latest_per_key
    latest = latest_per_key(meta, ["nivel_geografico", "local_id", "rede_id", "ano_meta"], "ano_referencia")
    assert latest.count() == 1


def test_step_resolution():
    assert resolve_steps(["gold_fato_resultados", "silver_uf"]) == ["silver_uf", "gold_fato_resultados"]
    assert len(resolve_steps(["silver"])) == 6
    with pytest.raises(ValueError):
        resolve_steps(["nope"])


def test_bronze_stamp(spark):
    df = stamp(spark.createDataFrame([(1,)], "a int"), "src.table", at="2024-01-01 06:00:00")
    row = df.first()
    assert df.columns == ["a", "_ingestao_timestamp", "_fonte"] and row._fonte == "src.table"


def test_ingest_stamps_and_overwrites(spark, tmp_path):
    from strata.sources import ingest
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.parquet(src)
    lay = Layers(root=str(tmp_path))
    loc = ingest(spark, lay, src, "dicionario", "ref.dicionario", at="2024-01-01 00:00:00")
    back = spark.read.parquet(loc)
    assert back.columns == ["id", "v", "_ingestao_timestamp", "_fonte"] and back.count() == 2
    assert {r._fonte for r in back.collect()} == {"ref.dicionario"}
    ingest(spark, lay, src, "dicionario")            # overwrite, not append
    assert spark.read.parquet(loc).count() == 2


def test_observed_post_report_equals_a_separate_pass(spark, layers, ran):
    from strata.plans.silver import post_report
    for table, spec in SILVER_SPECS.items():
        written = read_layer(spark, layers, "silver", table)
        separate = sorted(map(tuple, post_report(spec, written).collect()), key=str)
        observed = sorted(map(tuple, ran[f"silver_{table}"].post.collect()), key=str)
        assert observed == separate, table


def test_gold_integrity(spark, layers, ran):
    report = {r.relationship: (r.orphan_rows, r.orphan_keys) for r in ran["gold_integrity"].collect()}
    assert len(report) == len(gold.RELATIONSHIPS)
    assert all(v == (0, 0) for v in report.values()), report
    g = lambda t: read_layer(spark, layers, "gold", t)
    broken = {"fato_aluno": g("fato_aluno"),
              "dim_municipio": g("dim_municipio").filter(F.col("id_municipio") != "0000012")}
    r = gold.gold_integrity(broken).collect()
    assert [(x.relationship, x.orphan_rows, x.orphan_keys) for x in r] == [
        ("fato_aluno.id_municipio -> dim_municipio.id_municipio", 1, 1)]


def test_catalog_layers_round_trip(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS strata_test_bronze")
    lay = Layers(catalog=True, names={"bronze": "strata_test_bronze"})
    assert lay.location("bronze", "uf") == "strata_test_bronze.uf"
    write_layer(spark.createDataFrame(fx.STATES, fx.STATE_SCHEMA), lay, "bronze", "uf",
                clustered_fields=["ano", "sigla_uf"])
    back = read_layer(spark, lay, "bronze", "uf")
    assert back.count() == len(fx.STATES) and "sigla_uf" in back.columns


def test_fixed_stamp_is_a_utc_instant(spark):
    import datetime as dt
    from strata.sources.bronze import instant
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            v = spark.range(1).select(F.unix_micros(instant("2024-01-01 06:00:00")).alias("u")).first().u
            assert v == int(dt.datetime(2024, 1, 1, 6, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_cli_runs_selected_steps_against_renamed_layers(spark, tmp_path):
    from strata.plans import medallion
    lay = Layers(root=str(tmp_path), names={"bronze": "bronze", "silver": "silver_test", "gold": "gold"})
    write_layer(spark.createDataFrame(fx.STATES, fx.STATE_SCHEMA), lay, "bronze", "uf")
    steps = medallion.run_all(spark, lay, ["silver_uf"])
    assert list(steps) == ["silver_uf"] and (tmp_path / "silver_test" / "uf").exists()
    import pytest as _pytest
    with _pytest.raises(SystemExit):
        medallion.main(["--root", str(tmp_path), "--layer", "nope=x"])


def _raw_tables(spark, root):
    """The fixture tables as delivered, without the columns that the bronze copy adds."""
    frames = {n: df.drop("_ingestao_timestamp", "_fonte") for n, df in fx.bronze_tables(spark).items()}
    frames["dicionario"] = spark.createDataFrame([("rede", "2", "Estadual")], "coluna string, chave string, valor string")
    for name, df in frames.items():
        df.write.parquet(f"{root}/raw/{name}")
    spark.createDataFrame(fx.DIRECTORY, fx.DIRECTORY_SCHEMA).write.parquet(f"{root}/directory")


def test_main_runs_from_raw_tables_to_gold_and_an_orphan_stops_it(spark, tmp_path, capsys):
    from strata.plans import medallion
    root = str(tmp_path)
    _raw_tables(spark, root)
    args = ["--root", f"{root}/lake", "--raw", f"{root}/raw", "--directory", f"{root}/directory"]
    medallion.main(args)
    printed = capsys.readouterr().out
    assert all(f"{step} " in printed for step in medallion.STEPS) and "gold_integrity stored" in printed
    lay = Layers(root=f"{root}/lake")
    copy = read_layer(spark, lay, "bronze", "dicionario")
    assert copy.columns == ["coluna", "chave", "valor", "_ingestao_timestamp", "_fonte"]
    assert copy.first()._fonte == "basedosdados.br_inep_avaliacao_alfabetizacao.dicionario"
    assert read_layer(spark, lay, "gold", "fato_resultados").count() > 0
    stored = read_layer(spark, lay, "gold", "integrity")
    assert stored.count() == len(gold.RELATIONSHIPS) and stored.filter("orphan_rows > 0").count() == 0
    # a dimension loses a row that facts refer to
    write_layer(read_layer(spark, lay, "gold", "dim_municipio").filter("id_municipio != '0000012'"), lay, "gold", "dim_municipio")
    with pytest.raises(gold.IntegrityError, match="fato_aluno.id_municipio"):
        medallion.main([*args, "--only", "gold_fato_aluno"])
    assert read_layer(spark, lay, "gold", "integrity").filter("orphan_rows > 0").count() > 0    # the report is there to read
    medallion.main([*args, "--only", "gold_fato_aluno", "--no-gate"])
    assert spark.range(1).count() == 1                      # the caller's session is left running


def test_bronze_steps_need_a_raw_table(spark, tmp_path):
    with pytest.raises(ValueError, match="bronze_uf"):
        run_all(spark, Layers(root=str(tmp_path)), ["bronze_uf"])
    assert len(resolve_steps(["bronze"])) == 7 and len(resolve_steps(None)) == 15 and len(resolve_steps(None, bronze=True)) == 22
