"""Fixed values of the literacy-indicator data model.

These are data, not logic: results only match the original recipes when the
lists below hold exactly these entries.  Keep them in this natural order.
"""

# --- Fixed values: network code -> descriptive label -------------------------
NETWORK_LABELS = {
    "0": "Total (Federal, Estadual, Municipal e Privada)",
    "1": "Federal",
    "2": "Estadual",
    "3": "Municipal",
    "4": "Privada",
    "5": "Pública (Estadual e Municipal)",
    "6": "Pública (Federal, Estadual e Municipal)",
}

# --- Fixed values: spellings of the "public" network label in target tables ---
PUBLIC_LABEL = "Pública"
PUBLIC_LABEL_VARIANTS = ["pública", "publica", "p�blica", "pãºblica"]

# --- Fixed values: domains checked by the silver recipes ---------------------
VALID_BOOKLETS = ["1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11",
                  "12", "13", "14", "15", "16", "17", "18", "19", "20", "21", "43"]
RARE_BOOKLET = "43"
VALID_GRADES = [2]
VALID_STUDENT_NETWORKS = ["2", "3", "4"]
KNOWN_NETWORK_LABELS = ["Federal", "Estadual", "Municipal", "Privada", "Pública"]
VALID_LITERACY_LEVELS = [0, 1, 2, 3, 4, 5]
STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO",
    "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI",
    "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]

# --- Fixed values: horizons ---------------------------------------------------
TARGET_YEARS = [2024, 2025, 2026, 2027, 2028, 2029, 2030]   # meta_alfabetizacao_<year>
FINAL_TARGET_YEAR = 2030
TIME_DIMENSION_YEARS = (2023, 2030)             # inclusive
LAST_OBSERVED_YEAR = 2024                       # <= realizado, > projetado
LEVEL_COLUMNS = [
    "proporcao_aluno_nivel_0", "proporcao_aluno_nivel_1", "proporcao_aluno_nivel_2",
    "proporcao_aluno_nivel_3", "proporcao_aluno_nivel_4", "proporcao_aluno_nivel_5",
    "proporcao_aluno_nivel_6", "proporcao_aluno_nivel_7", "proporcao_aluno_nivel_8",
]
LEVEL_SUM_TOLERANCE = (99.9, 100.1)
MUNICIPALITY_ID_WIDTH = 7
