"""Independent DuckDB SQL for every registered query.

Written from the job's stated meaning, not from any engine's plan, and
deliberately by other means than the Spark code where that is natural: the
per-key maxima come from a grouped subquery, entries meet exits by a self-join.
Ordinals are ``row_number`` here as in the window form.
The adapters repeat FIXTURES.md §2 in DuckDB's dialect.  Output casts match
the Spark side: dates as ISO text, money as double, ordinals as INTEGER.
"""

from __future__ import annotations

# Fixture parameters (FIXTURES.md §2), as SQL literals.
RUN_DAY = 20240115
CLIENT_FLOOR = 20240115
CANCEL_FLOOR = 20231001
AS_OF = "2024-01-15"
MONTHS = 10
EXCLUDED = "'0000_0000000', '0000_0000005', '0001_0000025'"
TO_OUTROS = "'0002_0000041', '0002_0000042', '0004_0000081'"
TO_ONBOARDING = "'0003_0000061', '0003_0000062'"

DAY_OF = "CAST({t}ano || lpad({t}mes, 2, '0') || lpad({t}dia, 2, '0') AS INTEGER)"
DAY = DAY_OF.format(t="")

# ---- adapters over the shared tables (FIXTURES.md §2) ----------------------

S_PDV = """s_pdv AS (
    SELECT o_custkey AS num_pdv,
           CAST((o_custkey - o_custkey % 10) * 1000000 + 191 AS BIGINT) AS num_cad_grl_ctri_estb,
           ' ' || CAST(o_custkey % 50 AS VARCHAR) || ' ' AS cod_cnae,
           CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS cod_mot_can,
           CAST(o_custkey % 7 AS INTEGER) AS cod_ram_atvd,
           CAST(o_custkey % 3 AS INTEGER) AS cod_gru_ram,
           CAST(CAST(o_orderdate AS DATE) + 7000 AS VARCHAR) AS dat_cdst_pdv,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 = 0
                     THEN CAST(CAST(o_orderdate AS DATE) + 8400 AS VARCHAR)
                WHEN o_orderstatus = 'P' THEN '' END AS dat_can_pdv,
           CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0
                     THEN CAST(CAST(o_orderdate AS DATE) + 8430 AS VARCHAR) END AS dat_rtvc_pdv,
           CAST(year(CAST(o_orderdate AS DATE) + 8400) AS VARCHAR) AS ano,
           CAST(month(CAST(o_orderdate AS DATE) + 8400) AS VARCHAR) AS mes,
           CAST(day(CAST(o_orderdate AS DATE) + 8400) AS VARCHAR) AS dia,
           o_orderkey AS seq
    FROM orders)"""

S_ESTB = """s_estb AS (
    SELECT CAST((c.c_custkey - c.c_custkey % 10) * 1000000 + 191
                + CASE WHEN (c.c_custkey - c.c_custkey % 10) % 70 = 0 THEN 1 ELSE 0 END
                AS BIGINT) AS num_cad_grl_ctri_estb,
           n.n_name AS cod_sgl_uf,
           ' ' || c.c_name || ' ' AS nom_cid_estb,
           lpad(CAST(c.c_nationkey * 1000 + c.c_custkey % 1000 AS VARCHAR), 8, '0') AS cod_cep_estb,
           CAST(year(CAST(o.o_orderdate AS DATE) + 8400) AS VARCHAR) AS ano,
           CAST(month(CAST(o.o_orderdate AS DATE) + 8400) AS VARCHAR) AS mes,
           CAST(day(CAST(o.o_orderdate AS DATE) + 8400) AS VARCHAR) AS dia,
           o.o_orderkey AS seq
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

CLI = """cli AS (
    SELECT lpad(CAST(user_id * 10 * 1000000 + 191 AS VARCHAR), 14, '0') AS cnpj,
           user_id AS id_cnpj_eq3,
           lpad(CAST(user_id % 37 AS VARCHAR), 4, '0') AS numero_agencia,
           lpad(CAST(user_id * 20 + event_id % 20 AS VARCHAR), 7, '0') AS numero_conta,
           CASE WHEN event_type = 'error' THEN 'resseg out'
                WHEN event_type = 'signup' THEN 'resseg in'
                WHEN event_type = 'click' THEN 'onboarding'
                WHEN event_type = 'view' THEN 'outros'
                WHEN event_type = 'purchase' AND user_id % 15 <> 0 THEN 'outro' END AS canal,
           CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS data_aceite_ressegmentacao,
           CAST(ts AS DATE) - 100 AS data_abertura_conta,
           CASE WHEN user_id % 3 = 0 THEN DATE '9999-12-31'
                WHEN user_id % 3 = 1 THEN CAST(ts AS DATE) + 30 END AS data_encerramento_conta,
           CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS anomesdia
    FROM events)"""

TX = """tx AS (
    SELECT l_suppkey AS numero_ponto_venda,
           CAST(year(CAST(l_shipdate AS DATE) + 8400) * 10000
                + month(CAST(l_shipdate AS DATE) + 8400) * 100
                + day(CAST(l_shipdate AS DATE) + 8400) AS INTEGER) AS anomesdia,
           CAST(l_extendedprice AS DECIMAL(18, 2)) AS valor_transacao
    FROM lineitem)"""

# ---- point of sale ----------------------------------------------------------

HIST = f"""hist AS (
    SELECT num_pdv,
           CAST(lpad(trim(CAST(num_cad_grl_ctri_estb AS VARCHAR)), 14, '0') AS BIGINT) AS cnpj14,
           CAST(left(lpad(trim(CAST(num_cad_grl_ctri_estb AS VARCHAR)), 14, '0'), 8) AS INTEGER) AS cnpjbas,
           trim(cod_cnae) AS cod_cnae,
           CAST(num_cad_grl_ctri_estb AS VARCHAR) AS num_cad_grl_ctri_estb,
           cod_mot_can, cod_ram_atvd, cod_gru_ram,
           dat_cdst_pdv,
           coalesce(TRY_CAST(replace(left(dat_can_pdv, 10), '-', '') AS INTEGER), 0) AS dat_can_pdv,
           coalesce(TRY_CAST(replace(left(dat_rtvc_pdv, 10), '-', '') AS INTEGER), 0) AS dat_rtvc_pdv,
           {DAY} AS dat_updt,
           {RUN_DAY} AS anomesdia,
           seq
    FROM s_pdv
    WHERE {DAY} <= {RUN_DAY})"""

# Per-key maxima by a grouped subquery; the index counts the rows of the same
# point of sale that are more recent (by day, then by seq).
NORM = """pdv_maxima AS (
    SELECT num_pdv, max(dat_can_pdv) AS max_can, max(dat_rtvc_pdv) AS max_rtvc
    FROM hist WHERE num_pdv IS NOT NULL GROUP BY num_pdv),
norm AS (
    SELECT h.num_pdv, h.cnpj14, h.cnpjbas, h.cod_mot_can, h.cod_ram_atvd, h.cod_cnae, h.cod_gru_ram,
           m.max_can AS dat_can_pdv, m.max_rtvc AS dat_rtvc_pdv, h.dat_cdst_pdv, h.dat_updt,
           CAST(1 + (SELECT count(*) FROM hist x
                     WHERE x.num_pdv = h.num_pdv
                       AND (x.dat_updt > h.dat_updt OR (x.dat_updt = h.dat_updt AND x.seq > h.seq)))
                AS INTEGER) AS index_num,
           h.anomesdia
    FROM hist h JOIN pdv_maxima m ON m.num_pdv = h.num_pdv)"""

NORM_COLS = ("num_pdv, cnpj14, cnpjbas, cod_mot_can, cod_ram_atvd, cod_cnae, cod_gru_ram, "
             "dat_can_pdv, dat_rtvc_pdv, dat_cdst_pdv, dat_updt, anomesdia")

# Latest establishment: the row no other row of its tax id is more recent than.
ESTAB = f"""estab_rows AS (
    SELECT num_cad_grl_ctri_estb AS cnpj14, cod_sgl_uf AS uf, trim(nom_cid_estb) AS cidade,
           cod_cep_estb, {DAY} AS snap_day, seq
    FROM s_estb),
estab_latest AS (
    SELECT cnpj14, uf, cidade, CAST(cod_cep_estb AS INTEGER) AS cod_cep
    FROM estab_rows e
    WHERE NOT EXISTS (SELECT 1 FROM estab_rows f
                      WHERE f.cnpj14 IS NOT DISTINCT FROM e.cnpj14
                        AND (f.snap_day > e.snap_day OR (f.snap_day = e.snap_day AND f.seq > e.seq))))"""

# ---- client accounts ----------------------------------------------------------

ACCT_ROWS = """acct_rows AS (
    SELECT *, numero_agencia || '_' || numero_conta AS acct FROM cli)"""

SNAP = f"""snap AS (
    SELECT cnpj AS numero_cnpj_completo, id_cnpj_eq3 AS numero_unico_cliente, acct AS agencia_conta,
           canal, data_aceite_ressegmentacao,
           data_abertura_conta AS data_inicio_relacionamento_bancario, data_encerramento_conta
    FROM acct_rows
    WHERE anomesdia = {RUN_DAY} AND acct IS NOT NULL AND acct NOT IN ({EXCLUDED}))"""

LEAVERS = f"""leavers AS (
    SELECT DISTINCT acct AS agencia_conta
    FROM acct_rows
    WHERE canal = 'resseg out' AND acct IS NOT NULL AND acct NOT IN ({EXCLUDED}))"""

EVENTS = """leaver_events AS (
    SELECT DISTINCT cnpj AS numero_cnpj_completo, id_cnpj_eq3 AS numero_unico_cliente,
           acct AS agencia_conta, canal,
           CASE WHEN canal = 'resseg in' OR canal = 'resseg out' THEN data_aceite_ressegmentacao
                ELSE data_abertura_conta END AS data_aceite_ressegmentacao,
           data_abertura_conta AS data_inicio_relacionamento_bancario
    FROM acct_rows
    WHERE acct IN (SELECT agencia_conta FROM leavers))"""

RANKED = """ranked AS (
    SELECT *, CAST(row_number() OVER (
               PARTITION BY agencia_conta, coalesce(canal = 'resseg out', false)
               ORDER BY data_aceite_ressegmentacao NULLS LAST, data_inicio_relacionamento_bancario NULLS LAST,
                        canal NULLS LAST, numero_cnpj_completo NULLS LAST, numero_unico_cliente NULLS LAST)
           AS INTEGER) AS rank_cli
    FROM leaver_events)"""

NEVER_LEFT = """never_left AS (
    SELECT * FROM snap WHERE agencia_conta NOT IN (SELECT agencia_conta FROM leavers))"""

LIFECYCLE = """lifecycle AS (
    SELECT e.numero_cnpj_completo, e.numero_unico_cliente, e.agencia_conta, e.canal,
           e.data_aceite_ressegmentacao, e.data_inicio_relacionamento_bancario,
           x.data_aceite_ressegmentacao AS data_encerramento_conta
    FROM ranked e
    LEFT JOIN ranked x
      ON x.canal = 'resseg out' AND x.agencia_conta = e.agencia_conta AND x.rank_cli = e.rank_cli
    WHERE e.canal <> 'resseg out'
    UNION ALL
    SELECT numero_cnpj_completo, numero_unico_cliente, agencia_conta, canal,
           data_aceite_ressegmentacao, data_inicio_relacionamento_bancario, data_encerramento_conta
    FROM never_left)"""

JOURNEYS = f"""journeys AS (
    SELECT numero_cnpj_completo, numero_unico_cliente, agencia_conta,
           CASE WHEN agencia_conta IN ({TO_OUTROS}) THEN 'outros'
                WHEN agencia_conta IN ({TO_ONBOARDING}) THEN 'onboarding'
                ELSE canal END AS jornada,
           data_aceite_ressegmentacao, data_inicio_relacionamento_bancario, data_encerramento_conta
    FROM lifecycle)"""

ACCOUNTS = """accounts AS (
    SELECT DISTINCT numero_cnpj_completo, numero_unico_cliente, agencia_conta,
           CASE jornada WHEN 'resseg in' THEN 'ressegmentacao'
                        WHEN 'outros' THEN 'one_itau'
                        WHEN 'outro' THEN 'one_itau'
                        ELSE jornada END AS jornada,
           CASE WHEN jornada = 'resseg in' THEN data_aceite_ressegmentacao
                ELSE data_inicio_relacionamento_bancario END AS data_abertura_conta_emps,
           data_encerramento_conta AS data_encerramento_conta_emps,
           coalesce(data_encerramento_conta = DATE '9999-12-31', true) AS flag_conta_ativa
    FROM journeys)"""

# ---- flagship ---------------------------------------------------------------

PDV_ACCOUNTS = """pdv_accounts AS (
    SELECT n.num_pdv, a.numero_unico_cliente, CAST(a.numero_cnpj_completo AS BIGINT) AS cnpj14,
           n.cnpjbas, left(a.agencia_conta, 4) AS numero_agencia,
           substring(a.agencia_conta, 6, 7) AS numero_conta,
           n.cod_mot_can, n.cod_gru_ram, n.cod_ram_atvd, n.cod_cnae, e.cod_cep, e.uf, e.cidade,
           n.dat_can_pdv, n.dat_cdst_pdv, n.dat_rtvc_pdv, n.dat_updt, n.anomesdia
    FROM norm n
    JOIN accounts a ON a.flag_conta_ativa AND CAST(a.numero_cnpj_completo AS BIGINT) = n.cnpj14
    LEFT JOIN estab_latest e ON e.cnpj14 = n.cnpj14
    WHERE n.index_num = 1)"""

PUBLISHED = f"""SELECT num_pdv AS numero_ponto_venda, numero_unico_cliente,
       cnpj14 AS numero_cnpj14, cnpjbas AS numero_cnpj_base, numero_agencia, numero_conta,
       cod_mot_can AS codigo_motivo_cancelamento, cod_gru_ram AS codigo_grupo_ramo,
       cod_ram_atvd AS codigo_ramo_atividade, cod_cnae AS codigo_cnae,
       CAST(cod_cep AS DOUBLE) AS codigo_cep,
       uf AS sigla_unidade_federativa, cidade AS nome_cidade_estabelecimento,
       dat_can_pdv AS data_cancelamento_ponto_venda, dat_cdst_pdv AS data_cadastro_ponto_venda,
       dat_rtvc_pdv AS data_reativacao_ponto_venda, dat_updt AS data_atualizacao_ponto_venda,
       anomesdia
FROM pdv_accounts
WHERE dat_can_pdv IS NULL OR dat_can_pdv = 0 OR dat_can_pdv >= {CANCEL_FLOOR} OR dat_rtvc_pdv >= dat_can_pdv"""

# ---- revenue ----------------------------------------------------------------

MONTHLY = """monthly AS (
    SELECT numero_ponto_venda, left(CAST(anomesdia AS VARCHAR), 6) AS anomes,
           sum(valor_transacao) AS faturamento
    FROM tx GROUP BY ALL)"""

MATRIX = ("SELECT numero_ponto_venda,\n" + ",\n".join(
    f"       CAST(max(CASE WHEN anomes = strftime(DATE '{AS_OF}' - INTERVAL ({i}) MONTH, '%Y%m') "
    f"THEN faturamento ELSE 0 END) AS DOUBLE) AS mes_{i}"
    for i in range(MONTHS)) + "\nFROM monthly GROUP BY numero_ponto_venda")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _text(c: str) -> str:
    return f"CAST({c} AS VARCHAR) AS {c}"


PDV_CTES = (HIST, NORM)
CLIENT_CTES = (ACCT_ROWS, SNAP, LEAVERS, EVENTS, RANKED, NEVER_LEFT, LIFECYCLE, JOURNEYS, ACCOUNTS)
CLI_COLS = ("cnpj, id_cnpj_eq3, numero_agencia, numero_conta, canal, "
            + ", ".join(_text(c) for c in ("data_aceite_ressegmentacao", "data_abertura_conta",
                                           "data_encerramento_conta")) + ", anomesdia")
LIFE_DATES = ", ".join(_text(c) for c in ("data_aceite_ressegmentacao",
                                          "data_inicio_relacionamento_bancario",
                                          "data_encerramento_conta"))
ACCOUNTS_SELECT = ("SELECT numero_cnpj_completo, numero_unico_cliente, agencia_conta, jornada, "
                   + _text("data_abertura_conta_emps") + ", " + _text("data_encerramento_conta_emps")
                   + ", flag_conta_ativa FROM accounts")
EVENT_COLS = ("numero_cnpj_completo, numero_unico_cliente, agencia_conta, canal, "
              + _text("data_aceite_ressegmentacao") + ", " + _text("data_inicio_relacionamento_bancario"))
EXTRACT_DAY = "make_date(CAST(ano AS INTEGER), CAST(mes AS INTEGER), CAST(dia AS INTEGER))"

ORACLE: dict[str, str] = {
    "scan_upto": with_(S_PDV) + f"SELECT * FROM s_pdv WHERE {DAY} <= {RUN_DAY}",
    "scan_snapshot": with_(CLI) + f"SELECT {CLI_COLS} FROM cli WHERE anomesdia = {RUN_DAY}",
    "scan_since": with_(CLI) + f"SELECT {CLI_COLS} FROM cli WHERE anomesdia >= {CLIENT_FLOOR}",
    "extract_predicate": with_(S_PDV)
    + "SELECT num_pdv, num_cad_grl_ctri_estb, trim(cod_cnae) AS cod_cnae, "
      "coalesce(TRY_CAST(replace(left(dat_can_pdv, 10), '-', '') AS INTEGER), 0) AS dat_can_pdv, "
      f"CAST({EXTRACT_DAY} AS VARCHAR) AS snapshot_date FROM s_pdv "
      f"WHERE {EXTRACT_DAY} <= DATE '{AS_OF}'",
    "pdv_history": with_(S_PDV, HIST) + "SELECT * EXCLUDE (seq) FROM hist",
    "pdv_status": with_(S_PDV, HIST)
    + f"SELECT num_pdv, max(dat_can_pdv) AS dat_can_pdv, max(dat_rtvc_pdv) AS dat_rtvc_pdv, "
      f"{RUN_DAY} AS anomesdia FROM hist GROUP BY num_pdv",
    "pdv_normalised": with_(S_PDV, *PDV_CTES) + "SELECT * FROM norm",
    "latest_pdv": with_(S_PDV, *PDV_CTES) + f"SELECT {NORM_COLS} FROM norm WHERE index_num = 1",
    "latest_estab": with_(S_ESTB, ESTAB) + "SELECT * FROM estab_latest",
    "monthly_revenue": with_(TX, MONTHLY)
    + "SELECT numero_ponto_venda, anomes, CAST(faturamento AS DOUBLE) AS faturamento FROM monthly",
    "revenue_matrix": with_(TX, MONTHLY) + MATRIX,
    "client_snapshot": with_(CLI, ACCT_ROWS, SNAP)
    + f"SELECT numero_cnpj_completo, numero_unico_cliente, agencia_conta, canal, {LIFE_DATES} FROM snap",
    "exit_accounts": with_(CLI, ACCT_ROWS, LEAVERS) + "SELECT * FROM leavers",
    "exit_history": with_(CLI, ACCT_ROWS, LEAVERS, EVENTS) + f"SELECT {EVENT_COLS} FROM leaver_events",
    "exit_ranks": with_(CLI, ACCT_ROWS, LEAVERS, EVENTS, RANKED)
    + f"SELECT {EVENT_COLS}, rank_cli FROM ranked",
    "never_left_accounts": with_(CLI, ACCT_ROWS, SNAP, LEAVERS, NEVER_LEFT)
    + f"SELECT numero_cnpj_completo, numero_unico_cliente, agencia_conta, canal, {LIFE_DATES} FROM never_left",
    "account_lifecycle": with_(CLI, *CLIENT_CTES[:7])
    + f"SELECT numero_cnpj_completo, numero_unico_cliente, agencia_conta, canal, {LIFE_DATES} FROM lifecycle",
    "journey_adjusted": with_(CLI, *CLIENT_CTES[:8])
    + f"SELECT numero_cnpj_completo, numero_unico_cliente, agencia_conta, jornada, {LIFE_DATES} FROM journeys",
    "client_accounts": with_(CLI, *CLIENT_CTES) + ACCOUNTS_SELECT,
    "pdv_clients": with_(S_PDV, *PDV_CTES, S_ESTB, ESTAB, CLI, *CLIENT_CTES, PDV_ACCOUNTS)
    + "SELECT * REPLACE (CAST(cod_cep AS DOUBLE) AS cod_cep) FROM pdv_accounts",
    "pdv_emps": with_(S_PDV, *PDV_CTES, S_ESTB, ESTAB, CLI, *CLIENT_CTES, PDV_ACCOUNTS) + PUBLISHED,
}
# Other physical strategies of the same relation: same oracle.
for _alt, _base in (("pdv_normalised_window", "pdv_normalised"),
                    ("pdv_normalised_join", "pdv_normalised"),
                    ("pdv_normalised_split", "pdv_normalised"),
                    ("latest_pdv_window", "latest_pdv"),
                    ("latest_estab_window", "latest_estab"),
                    ("exit_ranks_split", "exit_ranks"),
                    ("pdv_normalised_sorted", "pdv_normalised"),
                    ("revenue_matrix_two_step", "revenue_matrix"),
                    ("exit_ranks_window", "exit_ranks"),
                    ("exit_ranks_sorted", "exit_ranks"),
                    ("pdv_normalised_cut", "pdv_normalised"),
                    ("exit_ranks_cut", "exit_ranks"),
                    ("latest_pdv_state", "latest_pdv"),
                    ("pdv_status_state", "pdv_status"),
                    ("exit_history_store", "exit_history"),
                    ("client_accounts_store", "client_accounts"),
                    ("revenue_matrix_months", "revenue_matrix"),
                    ("revenue_matrix_table", "revenue_matrix"),
                    ("pdv_clients_shares", "pdv_clients"),
                    ("pdv_emps_reduced", "pdv_emps"),
                    ("pdv_emps_colocated", "pdv_emps"),
                    ("pdv_emps_incremental", "pdv_emps")):
    ORACLE[_alt] = ORACLE[_base]
