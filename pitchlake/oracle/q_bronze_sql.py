"""Oracle SQL of the bronze tables, staging views and facts: the landed statements with renames."""

from pitchlake.oracle.queries_sql import ORACLE, oracle
from pitchlake.sources import seeds
from pitchlake.plans.silver import STAGING_COLUMNS, STAGING_RENAMES

_LANDED = {"atletas_mercado": "s02_land_athletes", "atletas_pontuados": "s03_land_scored", "clubes": "s05_land_clubs",
           "ligas": "s08_land_leagues", "mercado_status": "s01_land_market_status", "partidas": "s04_land_matches",
           "pos_rodada_destaques": "s07_land_highlights", "rodadas": "s06_land_rounds"}
_LINEAGE = "TIMESTAMP '2024-02-01 00:00:00' AS _ingestao_timestamp, 'b-0001' AS _batch_id"


def _bronze(source: str) -> str:
    return f"(SELECT *, {_LINEAGE} FROM ({ORACLE[_LANDED[source]]}) _l)"


def _staging(source: str, *without: str) -> str:
    old = {new: name for name, new in STAGING_RENAMES.get(source, {}).items()}
    cols = [f"{old[c]} AS {c}" if c in old and source != "atletas_pontuados" else c
            for c in STAGING_COLUMNS[source] if c not in without]
    return f"SELECT {', '.join(cols)} FROM {_bronze(source)} _b"


for _source in _LANDED:
    ORACLE[f"p01_stg_{_source}"] = _staging(_source)
    ORACLE[f"s20_contract_{_source}"] = (
        "SELECT CAST(NULL AS VARCHAR) AS coluna, CAST(NULL AS VARCHAR) AS problema, CAST(NULL AS VARCHAR) AS esperado, "
        "CAST(NULL AS VARCHAR) AS encontrado, CAST(NULL AS BIGINT) AS linhas_invalidas WHERE FALSE")

ORACLE["p01_fct_destaques_rodada"] = _staging("pos_rodada_destaques", "_batch_id")

ORACLE["j03_fct_mercado_status"] = f"""
SELECT rodada_atual, status_mercado,
       CASE status_mercado WHEN 1 THEN 'Aberto' WHEN 2 THEN 'Fechado' WHEN 4 THEN 'Em Manutenção'
                           WHEN 6 THEN 'Fim de Rodada' ELSE 'Desconhecido' END AS status_descricao,
       temporada, game_over, times_escalados, bola_rolando, mercado_pos_rodada,
       TIMESTAMP '1970-01-01 00:00:00' + to_seconds(fechamento_timestamp) AS fechamento_datetime,
       _ingestao_timestamp AS captura_timestamp
FROM ({_staging("mercado_status")}) _s"""

oracle("s02_rejected_payloads", """
SELECT rodada_id AS _rodada_captura, count(DISTINCT atleta_id // 100) AS paginas,
       CASE WHEN rodada_id % 7 = 0 THEN count(DISTINCT atleta_id // 100) ELSE 0 END AS rejeitados
FROM (SELECT atleta_id, _rodada_captura AS rodada_id FROM market) GROUP BY rodada_id""", "market")

ORACLE["m01_bronze_upsert"] = f"""
SELECT atleta_id, _rodada_captura, CASE WHEN _rodada_captura < 15 THEN CAST(-1 AS DOUBLE) ELSE pontos_num END AS pontos_num,
       preco_num, _batch_id
FROM {_bronze("atletas_mercado")} _b"""

_POSITIONS = ", ".join(f"({i}, '{code}')" for i, _, code in seeds.POSITIONS)
_STATUS = ", ".join(f"({i}, {free})" for i, _, free in seeds.ATHLETE_STATUS)
oracle("s12_seeds_from_csv", f"""
SELECT a.posicao_id, a.status_id, po.abreviacao, st.disponivel, a.atletas,
       CAST({len(seeds.SCOUT_WEIGHTS)} AS BIGINT) AS n_pontuacao_scouts, CAST({len(seeds.DERBIES)} AS BIGINT) AS n_classicos
FROM (SELECT posicao_id, status_id, count(*) AS atletas FROM market GROUP BY ALL) a
LEFT JOIN (VALUES {_POSITIONS}) po(posicao_id, abreviacao) USING (posicao_id)
LEFT JOIN (VALUES {_STATUS}) st(status_id, disponivel) USING (status_id)""", "market")
