"""Oracle SQL for pitchlake.plans.q_io: what each landed payload must flatten to."""

from pitchlake.oracle.model_sql import result_sql
from pitchlake.oracle.queries_sql import oracle

oracle("s01_land_market_status", """
SELECT r AS rodada_atual, CAST(r % 4 + 1 AS INTEGER) AS status_mercado, 2024 AS temporada,
       FALSE AS game_over, CAST(n AS INTEGER) AS times_escalados, r % 2 = 0 AS mercado_pos_rodada,
       FALSE AS bola_rolando, 'Rodada ' || CAST(r AS VARCHAR) AS nome_rodada, 38 AS rodada_final,
       CASE WHEN r % 2 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(100 AS DOUBLE) END AS cartoleta_inicial,
       4 AS esquema_default_id,
       CAST(dayofmonth(last) AS INTEGER) AS fechamento_dia, CAST(month(last) AS INTEGER) AS fechamento_mes,
       CAST(year(last) AS INTEGER) AS fechamento_ano, CAST(hour(last) AS INTEGER) AS fechamento_hora,
       CAST(minute(last) AS INTEGER) AS fechamento_minuto,
       CAST(floor(epoch(last)) AS BIGINT) AS fechamento_timestamp
FROM (SELECT CAST(dayofmonth(ts) AS INTEGER) AS r, max(ts) AS last, count(*) AS n
      FROM events GROUP BY CAST(dayofmonth(ts) AS INTEGER))""")

oracle("s02_land_athletes", """
SELECT atleta_id, nome, apelido, left(apelido, 4) AS apelido_abreviado, lower(apelido) AS slug, foto, clube_id, posicao_id, status_id, rodada_id, pontos_num, media_num,
       preco_num, variacao_num, jogos_num, entrou_em_campo, scout_json, _rodada_captura
FROM market""", "market", doubles=("pontos_num", "media_num", "preco_num", "variacao_num"))

oracle("s03_land_scored", "SELECT *, 'A' || CAST(atleta_id AS VARCHAR) AS apelido FROM scored", "scored", doubles=("pontuacao",))

oracle("s04_land_matches", f"""
SELECT partida_id, rodada_id, clube_casa_id, clube_visitante_id,
       CAST(NULL AS INTEGER) AS clube_casa_posicao, CAST(NULL AS INTEGER) AS clube_visitante_posicao,
       placar_oficial_mandante, placar_oficial_visitante,
       strftime(partida_data, '%Y-%m-%d %H:%M:%S') AS partida_data,
       CAST(floor(epoch(partida_data)) AS BIGINT) AS timestamp_partida,
       estadio AS local, partida_id % 2 = 0 AS valida, 26 AS campeonato_id,
       '["' || lower({result_sql('placar_oficial_mandante', 'placar_oficial_visitante')}) || '","'
            || lower({result_sql('placar_oficial_visitante', 'placar_oficial_mandante')}) || '"]'
           AS aproveitamento_mandante,
       '["' || lower({result_sql('placar_oficial_visitante', 'placar_oficial_mandante')}) || '","'
            || lower({result_sql('placar_oficial_mandante', 'placar_oficial_visitante')}) || '"]'
           AS aproveitamento_visitante
FROM pm""", "pm")

oracle("s05_land_clubs", """
SELECT clube_id, nome, abreviacao, slug, nome AS apelido, nome AS nome_fantasia,
       'https://clubes/' || slug AS url_editoria, escudo_60x60, escudo_45x45, escudo_30x30
FROM cl""", "cl")

oracle("s06_land_rounds", """
SELECT CAST(dayofmonth(ts) AS INTEGER) AS rodada_id,
       'Rodada ' || CAST(CAST(dayofmonth(ts) AS INTEGER) AS VARCHAR) AS nome_rodada,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS inicio, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS fim
FROM events GROUP BY CAST(dayofmonth(ts) AS INTEGER)""")

oracle("s07_land_highlights", """
SELECT rodada_id, best.atleta_id AS mito_time_id, best.nome AS mito_nome, best.apelido AS mito_nome_time,
       lower(best.apelido) AS mito_slug, best.clube_id AS mito_clube_id,
       CASE WHEN rodada_id % 2 = 0 THEN CAST(0 AS DOUBLE) ELSE mc END AS media_cartoletas, mp AS media_pontos
FROM (SELECT rodada_id,
             arg_max({'atleta_id': atleta_id, 'apelido': apelido, 'nome': nome, 'clube_id': clube_id},
                     (pontos_num, atleta_id)) AS best,
             round(sum(preco_num), 2) / count(preco_num) AS mc,
             round(sum(pontos_num), 2) / count(pontos_num) AS mp
      FROM market GROUP BY rodada_id)""", "market", doubles=("media_cartoletas", "media_pontos"))

oracle("s08_land_leagues", """
SELECT CAST(r_regionkey AS INTEGER) AS liga_id, lower(r_name) AS slug, r_name AS nome,
       'Liga ' || r_name AS descricao, 'F' AS tipo, CAST(NULL AS VARCHAR) AS imagem, '2024-01-01' AS criacao,
       CAST(k AS INTEGER) AS quantidade_times, CAST(100 - k AS INTEGER) AS vagas_restantes,
       r_regionkey % 2 = 1 AS mata_mata, r_regionkey % 2 = 0 AS sem_capitao
FROM region JOIN (SELECT n_regionkey, count(*) AS k FROM nation GROUP BY n_regionkey) ON r_regionkey = n_regionkey""")

oracle("s09_add_ingest_metadata", """
SELECT event_id, user_id, event_type,
       '{"event_id":' || CAST(event_id AS VARCHAR) || ',"user_id":' || CAST(user_id AS VARCHAR)
       || ',"event_type":"' || event_type || '"}' AS _raw_json,
       TIMESTAMP '2024-02-01 00:00:00' AS _ingestao_timestamp, 'b-0001' AS _batch_id, 'eventos' AS _source_system
FROM events""")

oracle("s10_batch_load", """
SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS _ingestao_timestamp, 'b-0001' AS _batch_id,
       'eventos' AS _source_system
FROM events""", doubles=("value",))

oracle("s16_evolve_schema", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS o_clerk,
       CAST(year(o_orderdate) AS INTEGER) AS o_ano
FROM orders""")

oracle("s17_migrate_types", """
SELECT CAST(l_orderkey AS DECIMAL(38,10)) AS l_orderkey, CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity,
       l_linenumber, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem""")

oracle("s20_enforce_contract", """
SELECT * FROM (VALUES
  ('apelido_abreviado', 'faltando', 'string', CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)),
  ('slug', 'faltando', 'string', NULL, NULL),
  ('_raw_json', 'faltando', 'string', NULL, NULL),
  ('_ingestao_timestamp', 'tipo_diferente', 'timestamp', 'timestamp_ntz',
   (SELECT count(*) FROM market WHERE _ingestao_timestamp IS NOT NULL
                                  AND TRY_CAST(_ingestao_timestamp AS TIMESTAMP) IS NULL)))
  t(coluna, problema, esperado, encontrado, linhas_invalidas)""", "market")

_EV = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
oracle("s11_stream_load", _EV, doubles=("value",))
oracle("s13_append_sink", _EV, doubles=("value",))
oracle("s14_overwrite_sink", "SELECT * FROM orders", doubles=("o_totalprice",))
oracle("s15_replace_partitions", "SELECT atleta_id, rodada_id, pontos_num, preco_num FROM fct", "fct",
       doubles=("pontos_num", "preco_num"))
oracle("s18_bucketed_write", """
SELECT o_custkey, o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey""",
       doubles=("o_totalprice",))
oracle("s19_batched_copy", """
SELECT count(*) AS linhas_origem, count(*) AS linhas_copia, TRUE AS colunas_iguais, TRUE AS contagem_igual,
       TRUE AS conteudo_igual FROM orders""")
