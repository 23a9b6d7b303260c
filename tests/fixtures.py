"""Bronze fixture rows for the silver/gold recipes (shapes from FIXTURES.md)."""
from strata.functions.domains import LEVEL_COLUMNS, TARGET_YEARS

TS = "2024-05-01 10:00:00"
SRC = "fixture"

STUDENT_SCHEMA = ", ".join(f"{c} string" for c in [
    "ano", "id_municipio", "id_escola", "id_aluno", "caderno", "serie", "rede", "presenca",
    "preenchimento_caderno", "alfabetizado", "proficiencia", "peso_aluno", "_ingestao_timestamp", "_fonte"])

S1 = ("2023", "12", "12345678", "A1", "5", "2", "3", "1", "1", "1", "250.5", "1.2")
STUDENTS = [
    S1, S1,                                                                               # exact duplicate
    ("2023", "12", "12345678", "A1", "5", "2", "3", "1", "1", "1", "260.0", "1.2"),         # same key, other payload
    ("2023", "123456789", "12345678", "A2", "43", "2", "2", "0", "1", "0", "200.0", "1.0"),  # absent but filled, 9 digits, booklet 43
    ("2023", "ABCDE", "87654321", "A3", "7", "2", "4", "1", "0", "1", None, None),         # literate not filled
    ("2023", "1234567", "12345678", "A4", "1", "2", None, "1", "1", "1", None, "1.0"),      # filled, NULL score; NULL network
    ("2023", "7654321", "1234567", "A5", "21", "2", "3", "1", "1", "0", "NaN", "0"),        # NaN score, zero weight
    ("2024", "12345", "12345678", "A1", "5", "2", "3", "1", "1", "1", "-5", "1.1"),         # 5 digits; negative score
    ("2023", " ", "12345678", " ", "5", "2", "3", "1", "1", "1", "100", "1"),              # ' ' ids
    ("2023", "", "12345678", "", "5", "2", "3", "1", "1", "1", "101", "1"),                # '' ids, same key
]
STUDENTS = [r + (TS, SRC) for r in STUDENTS]

LEVELS = ", ".join(f"{c} double" for c in LEVEL_COLUMNS)
MUNICIPALITY_SCHEMA = f"ano int, id_municipio string, serie string, rede string, taxa_alfabetizacao double, " \
                      f"media_portugues double, {LEVELS}"
L9 = (11.0,) * 9
MUNICIPALITIES = [
    (2024, "12", "2", " 3 ", 55.0, 700.0) + L9,
    (2024, "12", "2", "3", 60.0, 700.0) + L9,          # same key after trim
    (2024, "123456789", "2", "9", 101.0, 650.0) + L9,  # truncated id, unknown code
    (2024, "7654321", "2", None, -1.0, 600.0) + L9,    # NULL code
    (2023, "12", "2", "3", 50.0, 690.0) + L9,
]

STATE_SCHEMA = f"ano int, sigla_uf string, serie string, rede string, taxa_alfabetizacao double, " \
               f"media_portugues double, {LEVELS}, _ingestao_timestamp string, _fonte string"
STATES = [
    (2024, " sp ", "2", "3", 70.0, 650.0) + (11.0,) * 8 + (12.0,) + (TS, SRC),   # sums to 100
    (2024, "XX", "2", "3", 60.0, 600.0) + (10.0,) * 8 + (18.0,) + (TS, SRC),     # invalid state, sums to 98
    (2024, "RJ", "3", "2", 50.0, 500.0) + (None,) * 9 + (TS, SRC),              # grade 3, nothing filled
    (2024, "MG", "2", "2", 40.0, 480.0) + (25.0,) * 4 + (None,) * 5 + (TS, SRC),  # 4 of 9 filled
]

TARGETS = ", ".join(f"meta_alfabetizacao_{y} string" for y in TARGET_YEARS)
COUNTRY_SCHEMA = f"ano int, rede string, taxa_alfabetizacao string, {TARGETS}, percentual_participacao string, " \
                 f"_ingestao_timestamp string, _fonte string"


def _t(*vals):
    return tuple(None if v is None else str(v) for v in vals)


COUNTRY = [
    (2023, "pública", "50") + _t(55, 60, 65, 70, 75, 80, 85) + ("90", TS, SRC),
    (2023, "PUBLICA", "52") + _t(55, 60, 65, 70, 75, 80, 86) + ("91", TS, SRC),   # same key after normalising
    (2023, "Municipal", "40") + _t(50, 45, 55, 60, 65, 70, 75) + ("80", TS, SRC),  # decreasing
    (2024, "", "41") + _t(50, 55, 60, 65, 70, 75, 80) + ("80", TS, SRC),           # empty label -> NULL
]

STATE_TARGET_SCHEMA = f"ano int, sigla_uf string, rede string, taxa_alfabetizacao string, {TARGETS}, " \
                      f"percentual_participacao string, _ingestao_timestamp string, _fonte string"
STATE_TARGETS = [
    (2023, " sp ", "p�blica", "60") + _t(61, 62, 63, 64, 65, 66, 67) + (None, TS, SRC),  # parity violation
    (2023, "SP", "Estadual", None) + _t(61, 62, 63, 64, 65, 66, 67) + (None, TS, SRC),
    (2023, "XX", "pãºblica", "60") + _t(61, None, 63, 64, 65, 66, 67) + ("70", TS, SRC),  # invalid state
]

MUNICIPALITY_TARGET_SCHEMA = f"ano int, id_municipio string, rede string, taxa_alfabetizacao string, {TARGETS}, " \
                             f"nivel_alfabetizacao string, percentual_participacao string, " \
                             f"_ingestao_timestamp string, _fonte string"
MUNICIPALITY_TARGETS = [
    (2023, "12", "Municipal", "50") + _t(52, 54, 56, 58, 60, 62, 64) + ("2", "80", TS, SRC),
    (2024, "12", "Municipal", "55") + _t(57, 59, 61, 63, 65, 67, 70) + ("3", "85", TS, SRC),  # newer reference year
    (2024, "12", "pública", "55") + _t(58, 60, 62, 64, 66, 68, 71) + ("3", "85", TS, SRC),    # generic label
    (2024, "12", "Desconhecida", "55") + _t(59, 61, 63, 65, 67, 69, 72) + ("6", "85", TS, SRC),  # unmapped, level 6
    (2024, "7654321", "Municipal", "40") + _t(45, 50, None, 48, 52, 55, 60) + (None, "70", TS, SRC),  # NULL hides drop
]

DIRECTORY_SCHEMA = "id_municipio string, nome string, sigla_uf string, nome_uf string, nome_regiao string"
DIRECTORY = [
    ("0000012", "Cidade A", "SP", "São Paulo", "Sudeste"),
    ("1234567", "Cidade B", "RJ", "Rio de Janeiro", "Sudeste"),
    ("1234567", "Cidade B (dup)", "RJ", "Rio de Janeiro", "Sudeste"),   # duplicated -> fan-out
    ("9999999", "Cidade C", "MG", "Minas Gerais", "Sudeste"),
]   # 7654321 missing


def bronze_tables(spark):
    return {
        "alunos": spark.createDataFrame(STUDENTS, STUDENT_SCHEMA),
        "municipio": spark.createDataFrame(MUNICIPALITIES, MUNICIPALITY_SCHEMA),
        "uf": spark.createDataFrame(STATES, STATE_SCHEMA),
        "meta_alfabetizacao_brasil": spark.createDataFrame(COUNTRY, COUNTRY_SCHEMA),
        "meta_alfabetizacao_uf": spark.createDataFrame(STATE_TARGETS, STATE_TARGET_SCHEMA),
        "meta_alfabetizacao_municipio": spark.createDataFrame(MUNICIPALITY_TARGETS, MUNICIPALITY_TARGET_SCHEMA),
    }
