"""SQL that says what the queries of the catalogue must return, for an independent engine.

Rates and means are rounded half up in whole numbers (``//`` is integer division), so
that no floating-point rounding enters the comparison.
"""

from __future__ import annotations

MET, BELOW, NO_TARGET, NO_DATA = "'Atingida'", "'Abaixo'", "'Sem meta'", "'Sem dado'"


def percent(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} > 0 THEN CAST((20000 * CAST({part} AS HUGEINT) + {whole}) "
        f"// (2 * CAST({whole} AS HUGEINT)) AS DOUBLE) / 100 END"
    )


def quotient(units: str, whole: str, scale: int) -> str:
    """``units / whole`` rounded half up, where ``scale`` units make one."""
    return (
        f"CASE WHEN {whole} > 0 THEN CAST((2 * CAST({units} AS HUGEINT) + {whole}) "
        f"// (2 * CAST({whole} AS HUGEINT)) AS DOUBLE) / {scale} END"
    )


def mean2(column: str) -> str:
    """Mean of two-decimal values."""
    return quotient(f"sum(CAST(round({column} * 100) AS HUGEINT))", f"count({column})", 100)


def mean4(column: str) -> str:
    """Mean, to two decimals, of four-decimal values."""
    total = f"sum(CAST(round({column} * 10000) AS HUGEINT))"
    return (
        f"CASE WHEN count({column}) > 0 THEN CAST(({total} + 50 * count({column})) "
        f"// (100 * count({column})) AS DOUBLE) / 100 END"
    )


def status(value: str, target: str) -> str:
    return (
        f"CASE WHEN {target} IS NULL THEN {NO_TARGET} WHEN {value} IS NULL THEN {NO_DATA} "
        f"WHEN {value} >= {target} THEN {MET} ELSE {BELOW} END"
    )


FACT = """
fact AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(l_suppkey AS VARCHAR) AS id_municipio,
         l_linestatus AS serie, l_returnflag AS rede,
         CASE WHEN l_linenumber <= 6 THEN 1 ELSE 0 END AS presenca,
         CASE WHEN l_linenumber <= 6 AND l_quantity >= 25 THEN 1 ELSE 0 END AS alfabetizado,
         CASE WHEN l_linenumber <= 6 THEN CAST(round(l_extendedprice * 100) AS HUGEINT) END
           AS cents,
         CASE WHEN l_linenumber <= 6 THEN CAST(round(l_quantity) AS HUGEINT) END AS peso,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem)"""

# The record that survives deduplication: the greatest by all columns, in order, as text.
DEDUPED = """
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY ano, l_orderkey, l_linenumber
      ORDER BY id_municipio DESC, CAST(l_partkey AS VARCHAR) DESC, serie DESC, rede DESC,
               presenca DESC, alfabetizado DESC, cents DESC NULLS LAST, peso DESC NULLS LAST) AS rn
    FROM fact) WHERE rn = 1)"""

MEMBER = """
member(base, code) AS (VALUES ('A','A'), ('N','N'), ('R','R'), ('A','P'), ('N','P'),
                              ('A','T'), ('N','T'), ('R','T'))"""

PLACE = """
place AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id_municipio, s_name AS nome_municipio,
         'N' || CAST(n_nationkey AS VARCHAR) AS sigla_uf, n_name AS nome_uf,
         r_name AS nome_regiao, n_nationkey AS number
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""


def sums(source: str) -> str:
    """Student sums for the networks and their composites."""
    return f"""
sums AS (
  SELECT ano, id_municipio, serie, code AS rede,
         count(*) AS alunos_total,
         CAST(sum(presenca) AS BIGINT) AS alunos_presentes,
         CAST(sum(CASE WHEN presenca = 1 THEN alfabetizado ELSE 0 END) AS BIGINT)
           AS alunos_alfabetizados,
         sum(cents) AS cents, count(cents) AS n_cents, sum(cents * peso) AS cents_peso,
         sum(CASE WHEN cents IS NOT NULL THEN peso END) AS peso
  FROM {source} JOIN member ON rede = base
  GROUP BY ano, id_municipio, serie, code)"""


STUDENT_METRICS = f"""
metrics AS (
  SELECT ano, id_municipio, serie, rede, alunos_total, alunos_presentes, alunos_alfabetizados,
         {percent("alunos_presentes", "alunos_total")} AS proporcao_presenca,
         {percent("alunos_alfabetizados", "alunos_presentes")} AS taxa_alfabetizacao_observada,
         {quotient("cents", "n_cents", 100)} AS proficiencia_media,
         {quotient("cents_peso", "peso", 100)} AS proficiencia_media_ponderada,
         CAST(cents_peso AS DOUBLE) / 100 AS soma_proficiencia_peso,
         CAST(peso AS DOUBLE) AS soma_peso
  FROM sums)"""


def result(name: str, place: str) -> str:
    """Published rate and mean per place, grade and network."""
    return f"""
{name} AS (
  SELECT ano, {place}, serie, code AS rede,
         CASE WHEN any_value(number) % 13 <> 0
              THEN {percent("sum(high)", "count(*)")} END AS taxa_alfabetizacao,
         {quotient("100 * sum(price)", "count(*)", 10000)} AS media_portugues
  FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, p.*, l_linestatus AS serie,
               l_returnflag AS base, CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS high,
               CAST(round(l_extendedprice * 100) AS HUGEINT) AS price
        FROM lineitem JOIN place p ON id_municipio = CAST(l_suppkey AS VARCHAR))
  JOIN member USING (base)
  GROUP BY ano, {place}, serie, code)"""


def targets(name: str, place: str, scale: str, base: int, cycle: int) -> str:
    """Target of the row's year, and the expected participation."""
    number = "any_value(number)" if place else "1"
    target = (
        f"CASE WHEN {number} % {cycle} <> 0 AND ano BETWEEN 1996 AND 1998 "
        f"THEN CAST({number} % {cycle} + {base} + ano - 1996 AS DOUBLE) END"
    )
    part = f"CASE WHEN {number} % 6 <> 0 THEN CAST({number} % 5 + 83 AS DOUBLE) END"
    keys = f"ano, {place}" if place else "ano"
    return f"""
{name} AS (
  SELECT {keys}, {target} AS meta_alfabetizacao_{scale},
         {part} AS percentual_participacao_{scale},
         {percent("sum(high)", "count(*)")} AS taxa_oficial
  FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, p.*,
               CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS high
        FROM lineitem JOIN place p ON id_municipio = CAST(l_suppkey AS VARCHAR))
  GROUP BY {keys})"""


MUNICIPAL = result("municipal", "id_municipio")
STATE = result("state", "sigla_uf")
MUNICIPAL_TARGET = targets("municipal_target", "id_municipio", "municipio", 49, 7)
STATE_TARGET = targets("state_target", "sigla_uf", "uf", 50, 4)
NATIONAL_TARGET = targets("national_target", "", "brasil", 50, 2)

NATIONAL_MEAN = f"""
national_mean AS (
  SELECT ano, serie, rede, {mean2("taxa_alfabetizacao")} AS taxa_alfabetizacao_brasil,
         {mean4("media_portugues")} AS media_portugues_brasil
  FROM state GROUP BY ano, serie, rede)"""

SERIE_NOME = "CASE m.serie WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Final' ELSE m.serie END"
REDE_NOME = (
    "CASE m.rede WHEN 'A' THEN 'Accepted' WHEN 'R' THEN 'Returned' "
    "WHEN 'P' THEN 'Accepted or N' WHEN 'T' THEN 'Total' ELSE m.rede END"
)

JOINED = f"""
joined AS (
  SELECT m.ano, m.id_municipio, nome_municipio, p.sigla_uf, nome_uf, nome_regiao, m.serie,
         {SERIE_NOME} AS serie_nome, m.rede, {REDE_NOME} AS rede_nome,
         alunos_total, alunos_presentes, alunos_alfabetizados, proporcao_presenca,
         taxa_alfabetizacao_observada, proficiencia_media, proficiencia_media_ponderada,
         soma_proficiencia_peso, soma_peso,
         m.taxa_alfabetizacao AS taxa_alfabetizacao_municipio,
         m.media_portugues AS media_portugues_municipio,
         meta_alfabetizacao_municipio, percentual_participacao_municipio,
         s.taxa_alfabetizacao AS taxa_alfabetizacao_uf, s.media_portugues AS media_portugues_uf,
         meta_alfabetizacao_uf, percentual_participacao_uf,
         taxa_alfabetizacao_brasil, media_portugues_brasil,
         nt.taxa_oficial AS taxa_alfabetizacao_brasil_oficial,
         meta_alfabetizacao_brasil, percentual_participacao_brasil
  FROM municipal m
  LEFT JOIN place p ON p.id_municipio = m.id_municipio
  LEFT JOIN metrics k ON k.ano = m.ano AND k.id_municipio = m.id_municipio
                     AND k.serie = m.serie AND k.rede = m.rede
  LEFT JOIN state s ON s.ano = m.ano AND s.sigla_uf = p.sigla_uf
                   AND s.serie = m.serie AND s.rede = m.rede
  LEFT JOIN national_mean b ON b.ano = m.ano AND b.serie = m.serie AND b.rede = m.rede
  LEFT JOIN municipal_target mt ON mt.ano = m.ano AND mt.id_municipio = m.id_municipio
  LEFT JOIN state_target st ON st.ano = m.ano AND st.sigla_uf = p.sigla_uf
  LEFT JOIN national_target nt ON nt.ano = m.ano)"""

GOLD = f"""
gold AS (
  SELECT *,
    {status("taxa_alfabetizacao_municipio", "meta_alfabetizacao_municipio")}
      AS meta_atingida_municipio,
    {status("proporcao_presenca", "percentual_participacao_municipio")}
      AS meta_atingida_presenca_municipio,
    {status("taxa_alfabetizacao_uf", "meta_alfabetizacao_uf")} AS meta_atingida_uf,
    {status("proporcao_presenca", "percentual_participacao_uf")} AS meta_atingida_presenca_uf,
    {status("taxa_alfabetizacao_brasil_oficial", "meta_alfabetizacao_brasil")}
      AS meta_atingida_brasil,
    {status("proporcao_presenca", "percentual_participacao_brasil")}
      AS meta_atingida_presenca_brasil
  FROM joined)"""


def gold(select: str, students: str = "fact") -> str:
    """A query on the analytical table, built from the given tables in the same statement."""
    parts = [FACT, *([DEDUPED] if students == "deduped" else []), MEMBER, PLACE, sums(students),
             STUDENT_METRICS, MUNICIPAL, STATE, MUNICIPAL_TARGET, STATE_TARGET, NATIONAL_TARGET,
             NATIONAL_MEAN, JOINED, GOLD]
    return "WITH " + ",".join(parts) + "\n" + select


def on_metrics(select: str) -> str:
    return "WITH " + ",".join([FACT, MEMBER, sums("fact"), STUDENT_METRICS]) + "\n" + select


def on_municipal(select: str) -> str:
    return "WITH " + ",".join([MEMBER, PLACE, MUNICIPAL, MUNICIPAL_TARGET]) + "\n" + select


SLICE_MEAN = quotient(
    "sum(CAST(round(soma_proficiencia_peso * 100) AS HUGEINT))",
    "sum(CAST(round(soma_peso) AS HUGEINT))",
    100,
)
YEARLY_SCORES = "WITH " + ",".join([FACT, MEMBER]) + """
SELECT ano, code AS rede, {} AS {} FROM fact JOIN member ON rede = base GROUP BY ano, code"""
SLICE = "ano = 1997 AND rede = 'T'"
ASIA = SLICE + " AND nome_regiao = 'ASIA'"


def kpis(where: str) -> str:
    met = f"count_if(meta_atingida_municipio = {MET})"
    below = f"count_if(meta_atingida_municipio = {BELOW})"
    return gold(
        f"""
SELECT count(DISTINCT id_municipio) AS municipios,
       {mean2("taxa_alfabetizacao_municipio")} AS taxa_media,
       CAST({met} AS BIGINT) AS atingiram, CAST({below} AS BIGINT) AS abaixo,
       CAST(count_if(meta_atingida_municipio = {NO_TARGET}) AS BIGINT) AS sem_meta,
       CAST(count_if(meta_atingida_municipio = {NO_DATA}) AS BIGINT) AS sem_dado,
       CAST({met} + {below} AS BIGINT) AS com_meta,
       CASE WHEN {met} + {below} > 0
            THEN CAST({met} AS DOUBLE) / CAST({met} + {below} AS DOUBLE) * 100 END AS pct_atingiu
FROM gold WHERE {where}"""
    )


def extremes(where: str, direction: str) -> str:
    return gold(
        f"""
SELECT nome_municipio, sigla_uf, taxa_alfabetizacao_municipio AS taxa,
       meta_alfabetizacao_municipio AS meta, meta_atingida_municipio AS status_meta,
       nome_municipio || ' (' || sigla_uf || ')' AS rotulo
FROM gold WHERE {where} AND taxa_alfabetizacao_municipio IS NOT NULL
ORDER BY taxa_alfabetizacao_municipio {direction}, id_municipio LIMIT 10"""
    )


DETAIL = """
SELECT id_municipio, nome_municipio, sigla_uf, nome_regiao, rede_nome,
       taxa_alfabetizacao_municipio, meta_alfabetizacao_municipio, meta_atingida_municipio,
       media_portugues_municipio, percentual_participacao_municipio, taxa_alfabetizacao_uf,
       taxa_alfabetizacao_brasil_oficial
FROM gold WHERE {where}
ORDER BY taxa_alfabetizacao_municipio DESC NULLS LAST, id_municipio, ano, serie, rede"""

GRAIN = "ano, id_municipio, serie, rede"
ORDER_YEAR = "CAST(year(o_orderdate) AS INTEGER)"
EVENT_K = "CAST(json_extract(props, '$.k') AS INTEGER)"
EVENT_VALUE = "CASE WHEN event_type <> 'error' THEN value END"
EVENT_FIELDS = (
    "CAST(year(ts) AS INTEGER) AS ano, CAST(event_id AS VARCHAR) AS event_id, "
    f"CAST(user_id AS VARCHAR) AS user_id, event_type, {EVENT_VALUE} AS value, {EVENT_K} AS k"
)
SURVIVOR = (
    "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, "
    "l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"
)

ORACLE: dict[str, str] = {
    "ingest_csv_contract": "SELECT *, 'customer' AS entity FROM customer",
    "ingest_audit_columns": """
SELECT o_orderkey, o_orderstatus, '2026-01-02' AS _ingestion_date,
       '20260102_030405' AS _ingestion_timestamp, 'arquivos/orders.csv' AS _source_path,
       'orders.csv' AS _source_entity, '2026-01-02' AS _silver_processing_date,
       '20260102_030405' AS _silver_processing_timestamp, 'orders' AS _silver_source_entity,
       'bronze' AS _source_layer, '2026-01-02' AS _gold_processing_date,
       '20260102_030405' AS _gold_processing_timestamp, 'root' AS _gold_source_bucket,
       'gold' AS _pipeline_stage
FROM orders""",
    "ingest_quarantine": """
SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
       c_mktsegment, CASE WHEN c_acctbal >= 0 THEN 'valid' ELSE 'rejected' END AS record_status
FROM customer""",
    "store_partition_overwrite": f"""
SELECT o_orderkey, CASE WHEN {ORDER_YEAR} = 1997 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, {ORDER_YEAR} AS ano FROM orders""",
    "store_unpartitioned": "SELECT * FROM customer",
    "store_file_control": f"""
SELECT {ORDER_YEAR} AS ano, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS sum_orderkey,
       true AS few_files FROM orders GROUP BY 1""",
    "store_catalog": f"""
SELECT {ORDER_YEAR} AS ano, count(*) AS n,
       'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority,ano'
         AS listed_columns
FROM orders GROUP BY 1""",
    "store_optional_inputs": gold(
        """
SELECT ano, id_municipio, nome_municipio, sigla_uf, nome_uf, nome_regiao, serie, serie_nome,
       rede, rede_nome, taxa_alfabetizacao_municipio, media_portugues_municipio,
       taxa_alfabetizacao_uf, media_portugues_uf, taxa_alfabetizacao_brasil,
       media_portugues_brasil FROM gold"""
    ),
    "export_csv": gold(
        "SELECT id_municipio, serie, rede_nome, taxa_alfabetizacao_municipio "
        "FROM gold WHERE ano = 1997"
    ),
    "clean_names": """
SELECT c_custkey AS codigo_do_cliente, c_name AS nome, c_nationkey AS nacao_chave,
       c_acctbal AS saldo_r, c_mktsegment AS _segmento_tecnico FROM customer""",
    "clean_empty_to_null": """
SELECT p_partkey, p_name, CASE WHEN p_size >= 10 THEN p_type END AS p_type,
       ' ' || p_brand AS _p_brand FROM part""",
    "clean_cast_contract": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id_pedido, {ORDER_YEAR} AS ano, o_totalprice AS total,
       TRY_CAST(regexp_replace(o_orderpriority, '-.*(H|W)$', '') AS DOUBLE)
         AS meta_alfabetizacao_2024,
       CAST(o_custkey AS VARCHAR) AS id_cliente FROM orders""",
    "clean_guarded_cast": f"""
SELECT event_id, CAST(year(ts) AS INTEGER) AS ano, {EVENT_VALUE} AS value,
       CASE WHEN event_type <> 'error' THEN {EVENT_K} END AS k FROM events""",
    "decode_codes": """
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' ELSE o_orderstatus END
         AS status_name FROM orders""",
    "json_payload": f"SELECT {EVENT_FIELDS}, 'valid' AS record_status FROM events",
    "dedup_by_key": f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SURVIVOR}) AS rn
  FROM lineitem) WHERE rn = 1""",
    "dedup_audit": """
SELECT count(*) AS rows_before, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_after,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS rows_removed,
       count(*) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL) AS rows_without_key
FROM lineitem""",
    "dedup_null_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS copies, max(l_shipdate) AS l_shipdate,
       (SELECT count(*) FROM lineitem WHERE l_orderkey % 10 = 0) AS rows_without_key
FROM lineitem WHERE l_orderkey % 10 <> 0 GROUP BY l_orderkey, l_linenumber""",
    "dim_load": """
SELECT CAST(c_custkey AS VARCHAR) AS id_cliente, c_name AS nome, c_mktsegment AS segmento
FROM customer""",
    "enrich_state": """
SELECT c.*, n_name, n_regionkey FROM customer c LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "enrich_hierarchy": "WITH " + PLACE + """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(l_suppkey AS VARCHAR) AS id_municipio,
       CAST(l_orderkey AS VARCHAR) AS id_aluno, CAST(l_linenumber AS VARCHAR) AS id_escola,
       CASE WHEN l_linenumber <= 6 AND l_quantity >= 25 THEN 1 ELSE 0 END AS alfabetizado,
       nome_municipio, sigla_uf, nome_uf, nome_regiao, number
FROM lineitem LEFT JOIN place ON id_municipio = CAST(l_suppkey AS VARCHAR)""",
    "join_coverage": """
SELECT count(*) AS total_rows,
       CAST(count_if(c_custkey IN (SELECT user_id FROM events)) AS BIGINT) AS matched_rows,
       CAST(count_if(c_custkey NOT IN (SELECT user_id FROM events)) AS BIGINT) AS orphan_rows,
       CAST(count_if(c_custkey NOT IN (SELECT user_id FROM events)) AS BIGINT) AS orphan_keys
FROM customer""",
    "join_orphans": """
SELECT c_custkey, count(*) AS fact_rows FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1""",
    "metrics_by_group": "WITH " + FACT + """
SELECT ano, id_municipio, serie, rede, count(*) AS alunos_total,
       CAST(sum(presenca) AS BIGINT) AS alunos_presentes,
       CAST(sum(alfabetizado) AS BIGINT) AS alunos_alfabetizados,
       CAST(sum(cents) AS DOUBLE) / 100 AS soma_proficiencia, count(cents) AS n_proficiencia,
       CAST(sum(cents * peso) AS DOUBLE) / 100 AS soma_proficiencia_peso,
       CAST(sum(peso) AS DOUBLE) AS soma_peso
FROM fact GROUP BY ano, id_municipio, serie, rede""",
    "metrics_composite": "WITH " + ",".join([FACT, MEMBER, sums("fact")]) + """
SELECT ano, id_municipio, serie, rede, alunos_total, alunos_presentes, alunos_alfabetizados,
       CAST(cents AS DOUBLE) / 100 AS soma_proficiencia, n_cents AS n_proficiencia,
       CAST(cents_peso AS DOUBLE) / 100 AS soma_proficiencia_peso,
       CAST(peso AS DOUBLE) AS soma_peso FROM sums""",
    "metrics_ratios": on_metrics(
        f"SELECT {GRAIN}, proporcao_presenca, taxa_alfabetizacao_observada FROM metrics"
    ),
    "metrics_mean": on_metrics(f"SELECT {GRAIN}, proficiencia_media FROM metrics"),
    "metrics_weighted": on_metrics(f"SELECT {GRAIN}, proficiencia_media_ponderada FROM metrics"),
    "metrics_weighted_small": YEARLY_SCORES.format(
        quotient("sum(cents * peso)", "sum(CASE WHEN cents IS NOT NULL THEN peso END)", 100),
        "proficiencia_media_ponderada",
    ),
    "metrics_mean_large": YEARLY_SCORES.format(
        quotient("sum(cents)", "count(cents)", 100), "mean_in_billions"
    ),
    "target_of_year": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, s_nationkey AS n_nationkey, count(*) AS n,
       CASE WHEN s_nationkey % 7 <> 0 AND year(l_shipdate) BETWEEN 1996 AND 1998
            THEN CAST(s_nationkey % 7 + 49 + year(l_shipdate) - 1996 AS DOUBLE) END AS target
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
GROUP BY year(l_shipdate), s_nationkey""",
    "target_status": on_municipal(
        f"""
SELECT m.ano, m.id_municipio, serie, rede, taxa_alfabetizacao, meta_alfabetizacao_municipio,
       percentual_participacao_municipio,
       {status("taxa_alfabetizacao", "meta_alfabetizacao_municipio")} AS status
FROM municipal m LEFT JOIN municipal_target t
  ON t.ano = m.ano AND t.id_municipio = m.id_municipio"""
    ),
    "target_gap": on_municipal(
        """
SELECT m.ano, m.id_municipio, serie, rede,
       taxa_alfabetizacao - meta_alfabetizacao_municipio AS gap
FROM municipal m LEFT JOIN municipal_target t
  ON t.ano = m.ano AND t.id_municipio = m.id_municipio"""
    ),
    "unified_table": gold("SELECT * FROM gold"),
    "layered_run": gold("SELECT * FROM gold", students="deduped"),
    "report_years_networks": gold("SELECT DISTINCT ano, rede, rede_nome FROM gold"),
    "report_territories": gold("SELECT DISTINCT nome_regiao, sigla_uf, nome_uf FROM gold"),
    "report_territories_of_region": gold(
        "SELECT DISTINCT nome_regiao, sigla_uf, nome_uf FROM gold WHERE nome_regiao = 'ASIA'"
    ),
    "report_country_by_year": gold(
        """
SELECT ano, max(taxa_alfabetizacao_brasil_oficial) AS taxa_oficial,
       max(meta_alfabetizacao_brasil) AS meta_nacional,
       max(percentual_participacao_brasil) AS participacao
FROM gold GROUP BY ano"""
    ),
    "report_yoy": gold(
        """
, country AS (
  SELECT ano, max(taxa_alfabetizacao_brasil_oficial) AS taxa_oficial,
         max(meta_alfabetizacao_brasil) AS meta_nacional,
         max(percentual_participacao_brasil) AS participacao
  FROM gold GROUP BY ano)
SELECT a.*, a.taxa_oficial - b.taxa_oficial AS delta, a.taxa_oficial - a.meta_nacional AS gap
FROM country a LEFT JOIN country b ON b.ano = a.ano - 1"""
    ),
    "report_kpis": kpis(SLICE),
    "report_kpis_region": kpis(ASIA),
    "report_state_ranking": gold(
        f"""
SELECT sigla_uf, max(nome_uf) AS nome_uf, max(taxa_alfabetizacao_uf) AS taxa_uf,
       max(meta_alfabetizacao_uf) AS meta_uf, max(meta_atingida_uf) AS status_meta
FROM gold WHERE {SLICE} AND taxa_alfabetizacao_uf IS NOT NULL GROUP BY sigla_uf"""
    ),
    "report_histogram": gold(
        f"""
SELECT CAST(floor(taxa_alfabetizacao_municipio / 5) * 5 AS INTEGER) AS faixa,
       count(*) AS municipios,
       CAST(floor(taxa_alfabetizacao_municipio / 5) * 5 + 5 AS INTEGER) AS faixa_fim
FROM gold WHERE {SLICE} AND taxa_alfabetizacao_municipio IS NOT NULL GROUP BY 1, 3"""
    ),
    "report_status_by_region": gold(
        f"""
SELECT nome_regiao, meta_atingida_municipio AS status_meta, count(*) AS municipios,
       CAST(count(*) AS DOUBLE)
         / CAST(sum(count(*)) OVER (PARTITION BY nome_regiao) AS DOUBLE) * 100 AS pct
FROM gold WHERE {SLICE} GROUP BY nome_regiao, meta_atingida_municipio"""
    ),
    "report_top_n": extremes(SLICE, "DESC"),
    "report_bottom_n": extremes(ASIA, "ASC"),
    "report_top_results": "WITH " + ",".join([MEMBER, PLACE, STATE]) + """
SELECT ano, sigla_uf, rede, taxa_alfabetizacao, media_portugues FROM state WHERE ano = 1997
ORDER BY taxa_alfabetizacao DESC NULLS LAST, sigla_uf, serie, rede LIMIT 10""",
    "report_student_kpis": gold(
        f"""
SELECT *, proficiencia_media - 743.0::DOUBLE AS vs_corte FROM (
  SELECT CAST(sum(alunos_total) AS BIGINT) AS alunos_total,
         CAST(sum(alunos_presentes) AS BIGINT) AS alunos_presentes,
         CAST(sum(alunos_alfabetizados) AS BIGINT) AS alunos_alfabetizados,
         {percent("sum(alunos_presentes)", "sum(alunos_total)")} AS presenca_media,
         {percent("sum(alunos_alfabetizados)", "sum(alunos_presentes)")} AS taxa_observada,
         {mean2("proficiencia_media_ponderada")} AS proficiencia_media,
         {SLICE_MEAN} AS proficiencia_media_ponderada
  FROM gold WHERE {SLICE})"""
    ),
    "report_scatter": gold(
        f"""
SELECT nome_municipio, sigla_uf, proporcao_presenca, taxa_alfabetizacao_observada,
       meta_atingida_municipio AS status_meta,
       meta_atingida_presenca_municipio AS status_presenca
FROM gold WHERE {SLICE} AND proporcao_presenca IS NOT NULL"""
    ),
    "report_crosstab": gold(
        f"""
SELECT meta_atingida_municipio AS status_meta,
       meta_atingida_presenca_municipio AS status_presenca, count(*) AS municipios
FROM gold WHERE {SLICE} GROUP BY 1, 2"""
    ),
    "report_diagnosis": gold(
        f"""
, cause AS (
  SELECT CASE meta_atingida_presenca_municipio WHEN {MET} THEN 1 WHEN {BELOW} THEN 2 ELSE 3 END c
  FROM gold WHERE {SLICE} AND meta_atingida_municipio = {BELOW})
SELECT diagnostico, (SELECT count(*) FROM cause WHERE cause.c = label.c) AS municipios
FROM (VALUES (1, 'Aprendizagem (presença OK)'), (2, 'Participação + aprendizagem'),
             (3, 'Sem referência de presença')) label(c, diagnostico)"""
    ),
    "report_detail": gold(DETAIL.format(where=SLICE)),
    "report_detail_search": gold(
        DETAIL.format(where=SLICE + " AND contains(lower(nome_municipio), 'pplier#00000001')")
    ),
    "mean_of_groups": f"""
WITH nations AS (
  SELECT n_regionkey, n_nationkey, c_mktsegment,
         sign(sum(CAST(round(c_acctbal * 100) AS HUGEINT)))
           * ((2 * abs(sum(CAST(round(c_acctbal * 100) AS HUGEINT))) + count(*))
              // (2 * count(*))) AS cents
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_regionkey, n_nationkey, c_mktsegment)
SELECT n_regionkey, c_mktsegment,
       CAST(sign(sum(cents)) * ((2 * abs(CAST(sum(cents) AS HUGEINT)) + count(*))
            // (2 * count(*))) AS DOUBLE) / 100 AS mean_of_nations
FROM nations GROUP BY n_regionkey, c_mktsegment""",
    "quality_report": f"""
WITH e AS (SELECT event_id, CAST(year(ts) AS INTEGER) AS ano, event_type = 'error' AS gone
           FROM events),
line AS (
  SELECT 'rows' AS metric, CAST(NULL AS VARCHAR) AS subject, count(*) AS n FROM e
  UNION ALL SELECT 'year', CAST(ano AS VARCHAR), count(*) FROM e GROUP BY ano
  UNION ALL SELECT 'nulls', 'event_id', 0
  UNION ALL SELECT 'nulls', unnest(['value', 'k']), CAST(count_if(gone) AS BIGINT) FROM e)
SELECT 'events' AS entity, metric, subject, n,
       CASE WHEN metric = 'nulls' THEN {percent("n", "(SELECT count(*) FROM e)")} END AS pct,
       metric = 'nulls' AND n > 0 AS warning
FROM line""",
    "quality_report_targets": on_municipal(
        f"""
, line AS (
  SELECT 'rows' AS metric, CAST(NULL AS VARCHAR) AS subject, count(*) AS n FROM municipal
  UNION ALL SELECT 'year', CAST(ano AS VARCHAR), count(*) FROM municipal GROUP BY ano
  UNION ALL SELECT 'nulls', 'ano', count(*) - count(ano) FROM municipal
  UNION ALL SELECT 'nulls', 'taxa_alfabetizacao', count(*) - count(taxa_alfabetizacao)
            FROM municipal
  UNION ALL SELECT 'nulls', 'media_portugues', count(*) - count(media_portugues) FROM municipal)
SELECT 'municipal' AS entity, metric, subject, n,
       CASE WHEN metric = 'nulls' THEN {percent("n", "(SELECT count(*) FROM municipal)")} END
         AS pct,
       metric = 'nulls' AND n > 0 AS warning
FROM line"""
    ),
    "quality_null_count": (
        "SELECT CAST(count_if(event_type = 'error') AS BIGINT) AS nulls FROM events"
    ),
    "quality_duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "quality_rows_vs_ids": (
        "SELECT count(*) AS registros, count(DISTINCT l_orderkey) AS ids_distintos FROM lineitem"
    ),
    "quality_code_pairs": """
SELECT DISTINCT o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' ELSE o_orderstatus END
         AS status_name FROM orders""",
    "quality_status_distribution": gold(
        "SELECT meta_atingida_municipio, count(*) AS qtd FROM gold GROUP BY 1"
    ),
    "quality_status_by_year": gold(
        "SELECT ano, meta_atingida_municipio, count(*) AS qtd FROM gold GROUP BY 1, 2"
    ),
    "quality_row_counts": """
SELECT 'lineitem' AS entity, count(*) AS rows FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'events', count(*) FROM events""",
    "quality_checks": """
WITH k AS (SELECT year(l_shipdate) AS y, l_orderkey, l_linenumber, count(*) AS n
           FROM lineitem GROUP BY ALL)
SELECT 'avaliacao_alfabetizacao_aluno' AS entity, "check",
       CASE WHEN "check" LIKE 'nulls%' THEN 'warning' ELSE 'error' END AS level,
       found, passed FROM (
  SELECT 'has rows' AS "check", count(*) AS found, count(*) > 0 AS passed FROM lineitem
  UNION ALL SELECT 'repeated keys', CAST(count_if(n > 1) AS BIGINT), count_if(n > 1) = 0 FROM k
  UNION ALL SELECT 'rows without municipio', count(*), count(*) = 0
            FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
            WHERE s_nationkey IS NULL OR s_nationkey >= 20
  UNION ALL SELECT unnest(['nulls in ano', 'nulls in id_aluno', 'nulls in alfabetizado']),
                   0, true)""",
    "quality_checks_absent": on_municipal(
        """
SELECT * FROM (
  SELECT 'silver' AS layer, 'avaliacao_alfabetizacao_municipio' AS entity, 'has rows' AS "check",
         'error' AS level, count(*) AS found, count(*) > 0 AS passed FROM municipal
  UNION ALL SELECT 'silver', 'avaliacao_alfabetizacao_uf', 'present', 'error', 0, false
  UNION ALL SELECT 'silver', 'avaliacao_alfabetizacao_aluno', 'present', 'warning', 0, false
  UNION ALL SELECT 'gold', 'alfabetizacao_analise_output', 'present', 'error', 0, false)"""
    ),
    "store_required_input": on_municipal(
        """
SELECT count(*) AS rows_present,
       'silver tables missing: avaliacao_alfabetizacao_uf' AS message FROM municipal"""
    ),
    "stream_quarantine": f"""
WITH e AS (SELECT {EVENT_FIELDS}, event_id AS number FROM events),
marked AS (
  SELECT *, number % 10 = 0 AND value IS NOT NULL AS no_value, number % 25 = 1 AS no_year FROM e)
SELECT CASE WHEN NOT no_year THEN ano END AS ano, event_id,
       CASE WHEN NOT no_value THEN value END AS value,
       CASE WHEN no_value OR no_year THEN 'rejected' ELSE 'valid' END AS record_status,
       CASE WHEN no_value OR no_year THEN event_id END AS raw_event_id
FROM marked""",
    "stream_empty_batch": """
SELECT CAST(year(ts) AS INTEGER) AS ano, count(*) AS n, false AS empty_written
FROM events GROUP BY 1""",
    "stream_lifecycle": """
SELECT CAST(year(ts) AS INTEGER) AS ano, count(*) AS n, true AS active_before,
       false AS active_after FROM events GROUP BY 1""",
    "report_detail_limit": gold(DETAIL.format(where=SLICE) + " LIMIT 5"),
    "report_scatter_limit": gold(
        """
SELECT nome_municipio, sigla_uf, proporcao_presenca, taxa_alfabetizacao_observada,
       meta_atingida_municipio AS status_meta,
       meta_atingida_presenca_municipio AS status_presenca
FROM gold WHERE ano = 1997 AND proporcao_presenca IS NOT NULL
ORDER BY id_municipio, serie, rede LIMIT 7"""
    ),
    "report_student_section": gold(
        f"""
, s AS (SELECT * FROM gold WHERE {SLICE})
SELECT entity, rows, 0 AS sections_without FROM (
  SELECT 'student_kpis' AS entity, CAST(1 AS BIGINT) AS rows
  UNION ALL SELECT 'attendance_and_rate', count(proporcao_presenca) FROM s
  UNION ALL SELECT 'status_crosstab', count(*) FROM (
    SELECT DISTINCT meta_atingida_municipio, meta_atingida_presenca_municipio FROM s)
  UNION ALL SELECT 'below_target_diagnosis', 3)"""
    ),
    "stream_ingest": f"""
SELECT {EVENT_FIELDS}, '20260102_030405' AS _ingestion_timestamp, 'events' AS _source_entity
FROM events""",
    "stream_replay": f"SELECT {EVENT_FIELDS}, CAST(2 AS BIGINT) AS copies FROM events",
}
