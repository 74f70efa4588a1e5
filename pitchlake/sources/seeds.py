"""The four static seed dimensions, typed.

They are a few rows each, so they are built in-plan with
``createDataFrame`` and explicit schemas; joins against them are
broadcast because their size is fixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ----------------------------------------------------------------------------
# Fixed values that must equal the reference's seed files.
POSITIONS = (
    (1, "Goleiro", "GOL"),
    (2, "Lateral", "LAT"),
    (3, "Zagueiro", "ZAG"),
    (4, "Meia", "MEI"),
    (5, "Atacante", "ATA"),
    (6, "Técnico", "TEC"),
)
ATHLETE_STATUS = (
    (2, "Dúvida", False),
    (3, "Suspenso", False),
    (5, "Contundido", False),
    (6, "Nulo", True),
    (7, "Provável", True),
)
SCOUT_WEIGHTS = (
    ("G", "Gol", 8.0),
    ("A", "Assistência", 5.0),
    ("SG", "Saldo de Gol (não sofrer gol)", 5.0),
    ("DE", "Defesa", 3.0),
    ("DP", "Defesa de Pênalti", 7.0),
    ("DS", "Desarme", 1.5),
    ("FS", "Falta Sofrida", 0.5),
    ("FD", "Finalização Defendida", 1.0),
    ("FF", "Finalização para Fora", 0.8),
    ("FT", "Finalização na Trave", 3.0),
    ("PS", "Passe Decisivo", 0.8),
    ("PC", "Passe Completo", 0.3),
    ("PP", "Pré-Assistência", 0.3),
    ("V", "Vitória", 1.0),
    ("I", "Impedimento", -0.1),
    ("FC", "Falta Cometida", -0.5),
    ("CA", "Cartão Amarelo", -2.0),
    ("CV", "Cartão Vermelho", -5.0),
    ("GC", "Gol Contra", -5.0),
    ("GS", "Gol Sofrido", -2.0),
)
DERBIES = (
    (262, 264, "Fla-Flu", "Rio de Janeiro"),
    (262, 277, "Fla x Vasco", "Rio de Janeiro"),
    (264, 277, "Flu x Vasco", "Rio de Janeiro"),
    (262, 276, "Fla x Botafogo", "Rio de Janeiro"),
    (264, 276, "Flu x Botafogo", "Rio de Janeiro"),
    (277, 276, "Vasco x Botafogo", "Rio de Janeiro"),
    (273, 275, "Majestoso", "São Paulo"),
    (273, 284, "Derby Paulista", "São Paulo"),
    (275, 284, "Choque-Rei", "São Paulo"),
    (273, 277, "Clássico das Multidões", "Nacional"),
    (266, 293, "Atletiba", "Paraná"),
    (286, 290, "Ba-Vi", "Bahia"),
    (263, 292, "Grenal", "Rio Grande do Sul"),
)
# Per-position error tolerance of the coverage score (default 2.5).
COVERAGE_THRESHOLDS = {1: 2.0, 2: 2.5, 3: 2.5, 4: 3.0, 5: 3.5, 6: 2.0}
DEFAULT_THRESHOLD = 2.5
COVERAGE_MIN = 0.70
COVERAGE_WINDOW = 3
# ----------------------------------------------------------------------------

POSITIONS_SCHEMA = "posicao_id INT, nome STRING, abreviacao STRING"
STATUS_SCHEMA = "status_id INT, descricao STRING, disponivel BOOLEAN"
WEIGHTS_SCHEMA = "scout_codigo STRING, descricao STRING, pontuacao DOUBLE"
DERBIES_SCHEMA = "clube_id_a INT, clube_id_b INT, nome_classico STRING, regiao STRING"
THRESHOLDS_SCHEMA = "posicao_id INT, threshold DOUBLE"


def positions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(POSITIONS), POSITIONS_SCHEMA)


def athlete_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ATHLETE_STATUS), STATUS_SCHEMA)


def scout_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SCOUT_WEIGHTS), WEIGHTS_SCHEMA)


def derbies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DERBIES), DERBIES_SCHEMA)


def coverage_thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in COVERAGE_THRESHOLDS.items()],
                                 THRESHOLDS_SCHEMA)


def load_seeds(spark: SparkSession, path: str | None = None) -> dict[str, DataFrame]:
    """All seeds; with ``path`` the CSV files are read with explicit schemas."""
    if path:
        rd = spark.read.option("header", "true")
        return {
            "posicoes": rd.schema(POSITIONS_SCHEMA).csv(f"{path}/seed_posicoes.csv"),
            "status_atleta": rd.schema(STATUS_SCHEMA).csv(f"{path}/seed_status_atleta.csv"),
            "pontuacao_scouts": rd.schema(WEIGHTS_SCHEMA).csv(f"{path}/seed_pontuacao_scouts.csv"),
            "classicos": rd.schema(DERBIES_SCHEMA).csv(f"{path}/seed_classicos.csv"),
        }
    return {"posicoes": positions(spark), "status_atleta": athlete_status(spark),
            "pontuacao_scouts": scout_weights(spark), "classicos": derbies(spark)}
