"""Independent SQL statements of every registered analysis.

Each statement says, relationally and directly on the supplied tables, what
the Spark pipeline computes through raw text: the well-formedness rules of
the mirror become plain predicates, wei amounts are cents x 10^16 summed as
HUGEINT. Written for DuckDB (views named after the tables).
"""

from __future__ import annotations

WEI = "10000000000000000"

TX = f"""
tx AS (
  SELECT CASE WHEN l_linenumber = 6 AND cast(round(l_tax * 100) AS INTEGER) = 5 THEN -1 ELSE l_suppkey END AS k,
         cast(round(l_extendedprice * 100) AS BIGINT) AS c,
         cast(l_quantity AS BIGINT) AS q,
         strftime(l_shipdate, '%m-%Y') AS month,
         strftime(l_shipdate, '%Y-%m') AS ym
  FROM lineitem
  WHERE cast(round(l_discount * 100) AS INTEGER) <> 10
    AND NOT (l_returnflag = 'R' AND l_linestatus = 'O')
    AND cast(round(l_tax * 100) AS INTEGER) <> 8
)"""

CON = """
con AS (
  SELECT s_suppkey AS k FROM supplier
  WHERE s_acctbal >= 0 AND s_nationkey NOT IN (10, 11)
  UNION ALL
  SELECT s_suppkey AS k FROM supplier
  WHERE s_acctbal > 9000 AND s_nationkey NOT IN (10, 11)
)"""

BLOCK_OK = """
  NOT (o_orderpriority = '2-HIGH' AND o_orderstatus = 'F')
  AND o_orderpriority <> '1-URGENT'
  AND NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'O')"""

BLK = f"""
blk AS (
  SELECT o_orderkey AS number,
         '0x' || lpad(cast(o_custkey AS VARCHAR), 40, '0') AS miner,
         cast(round(o_totalprice * 100) AS BIGINT) // 100 AS size,
         o_orderstatus
  FROM orders
  WHERE {BLOCK_OK}
)"""

REG = """
scam AS (
  SELECT s.s_suppkey AS id, s.s_acctbal AS bal,
         CASE r.r_name WHEN 'AFRICA' THEN 'Phishing' WHEN 'AMERICA' THEN 'Scamming'
                       WHEN 'ASIA' THEN 'Fake ICO' WHEN 'EUROPE' THEN ''
                       WHEN 'MIDDLE EAST' THEN 'Phishing' ELSE '' END AS category,
         CASE WHEN s.s_acctbal < 1000 THEN 'Offline' ELSE 'Active' END AS status
  FROM supplier s
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE s.s_acctbal < 2500
),
reg AS (
  SELECT id, category, status, id AS k FROM scam WHERE bal >= 0
  UNION ALL
  SELECT id, category, status, id + 1 AS k FROM scam WHERE bal >= 0
)"""

TOTALS = f"""
totals AS (
  SELECT k, sum(cast(c AS HUGEINT)) AS s FROM tx GROUP BY k
),
top AS (
  SELECT '0x' || lpad(cast(totals.k AS VARCHAR), 40, '0') AS address, totals.k AS k, totals.s AS s
  FROM totals JOIN con ON totals.k = con.k
  ORDER BY totals.s DESC, address ASC
  LIMIT 10
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _wei_text(expr: str) -> str:
    return f"cast(({expr}) * {WEI} AS VARCHAR)"


SUM_WEI = "sum(cast(c AS HUGEINT))"

ORACLE: dict[str, str] = {
    "monthly_transaction_count": _with(TX) + "SELECT month, count(*) AS n FROM tx GROUP BY month",
    "monthly_total_value": _with(TX)
    + f"SELECT month, {_wei_text(SUM_WEI)} AS total FROM tx GROUP BY month",
    "monthly_average_value": _with(TX)
    + f"SELECT month, cast({SUM_WEI} * {WEI} AS DOUBLE) / count(*) AS avg FROM tx GROUP BY month",
    "top_contracts_by_value": _with(TX, CON, TOTALS)
    + f"SELECT address, {_wei_text('s')} AS total FROM top",
    "top_miners_by_block_size": _with(BLK)
    + "SELECT miner, cast(sum(size) AS BIGINT) AS total_size FROM blk GROUP BY miner "
    "ORDER BY total_size DESC, miner ASC LIMIT 10",
    "monthly_average_gas_price": _with(TX)
    + "SELECT month, cast(sum(cast((c // q) * 100000 AS HUGEINT)) AS DOUBLE) / count(*) AS avg "
    "FROM tx GROUP BY month",
    "monthly_contract_gas": _with(TX, CON)
    + "SELECT month, cast(sum(q * 21000) AS BIGINT) AS gas FROM tx JOIN con ON tx.k = con.k "
    "GROUP BY month",
    "average_contract_gas": _with(TX, CON)
    + "SELECT 'Avg gas used' AS label, cast(sum(q * 21000) AS DOUBLE) / count(*) AS avg "
    "FROM tx JOIN con ON tx.k = con.k HAVING count(*) > 0",
    "gas_of_top_contracts": _with(TX, CON, TOTALS)
    + "SELECT top.address AS address, cast(sum(q * 21000) AS DOUBLE) AS gas "
    "FROM tx JOIN top ON tx.k = top.k GROUP BY top.address",
    "gas_of_popular_contracts": _with(TX, CON, TOTALS)
    + "SELECT top.address AS address, cast(sum(q * 21000) AS DOUBLE) AS gas "
    "FROM tx JOIN top ON tx.k = top.k GROUP BY top.address",
    "text_monthly_value_stats": _with(TX)
    + f"SELECT month, count(*) AS n, {_wei_text(SUM_WEI)} AS total, "
    f"cast({SUM_WEI} * {WEI} AS DOUBLE) / count(*) AS avg FROM tx GROUP BY month",
    "streaming_monthly_value_stats": _with(TX)
    + f"SELECT month, count(*) AS n, {_wei_text(SUM_WEI)} AS total, "
    f"cast({SUM_WEI} * {WEI} AS DOUBLE) / count(*) AS avg FROM tx GROUP BY month",
    "block_column_overhead": _with(BLK)
    + "SELECT 'Total unnecessary data consumed: ' AS label, "
    "cast(sum(CASE WHEN o_orderstatus = 'P' THEN 319 ELSE 384 END) AS DOUBLE) AS bytes "
    "FROM blk HAVING count(*) > 0",
    "most_lucrative_scam": _with(TX, REG)
    + f"SELECT id, {_wei_text(SUM_WEI)} AS total FROM tx JOIN reg ON tx.k = reg.k "
    f"GROUP BY id ORDER BY {SUM_WEI} DESC, id ASC LIMIT 1",
    "scam_value_by_category_month": _with(TX, REG)
    + f"SELECT category, month, {_wei_text(SUM_WEI)} AS total FROM tx JOIN reg ON tx.k = reg.k "
    "WHERE category <> '' GROUP BY category, month",
    "chronological_series": _with(TX) + "SELECT ym, count(*) AS n FROM tx GROUP BY ym ORDER BY ym",
    "series_head": _with(TX) + "SELECT ym, count(*) AS n FROM tx GROUP BY ym ORDER BY ym ASC LIMIT 10",
    **{
        f"{key}_series_head": _with(TX, REG)
        + f"SELECT ym, {_wei_text(SUM_WEI)} AS total FROM tx JOIN reg ON tx.k = reg.k "
        f"WHERE replace(category, ' ', '') = '{category}' GROUP BY ym ORDER BY ym ASC LIMIT {n}"
        for key, category, n in (("fake_ico", "FakeICO", 5), ("phishing", "Phishing", 10), ("scamming", "Scamming", 5))
    },
    "average_value_series_head": _with(TX)
    + f"SELECT ym, cast({SUM_WEI} * {WEI} AS DOUBLE) / count(*) AS avg FROM tx GROUP BY ym ORDER BY ym ASC LIMIT 5",
    "gas_price_series_tail": _with(TX)
    + "SELECT * FROM (SELECT ym, cast(sum(cast((c // q) * 100000 AS HUGEINT)) AS DOUBLE) / count(*) AS avg "
    "FROM tx GROUP BY ym ORDER BY ym DESC LIMIT 5) ORDER BY ym",
    "contract_gas_series_tail": _with(TX, CON)
    + "SELECT * FROM (SELECT ym, cast(sum(q * 21000) AS BIGINT) AS gas FROM tx JOIN con ON tx.k = con.k "
    "GROUP BY ym ORDER BY ym DESC LIMIT 5) ORDER BY ym",
    "scam_values_without_excluded": _with(TX, REG)
    + f"SELECT category, month, {_wei_text(SUM_WEI)} AS total FROM tx JOIN reg ON tx.k = reg.k "
    "WHERE category NOT IN ('', 'Scamming') GROUP BY category, month",
    "stored_monthly_total": _with(TX) + f"SELECT month, {_wei_text(SUM_WEI)} AS total FROM tx GROUP BY month",
    "stored_scam_values": _with(TX, REG)
    + f"SELECT category, month, {_wei_text(SUM_WEI)} AS total FROM tx JOIN reg ON tx.k = reg.k "
    "WHERE category <> '' GROUP BY category, month",
    "series_tail": _with(TX)
    + "SELECT * FROM (SELECT ym, count(*) AS n FROM tx GROUP BY ym ORDER BY ym DESC LIMIT 5) ORDER BY ym",
    "series_total": _with(TX) + "SELECT count(*) AS total FROM tx HAVING count(*) > 0",
    "average_value_series": _with(TX)
    + f"SELECT ym, cast({SUM_WEI} * {WEI} AS DOUBLE) / count(*) AS avg FROM tx GROUP BY ym",
    "gas_price_series": _with(TX)
    + "SELECT ym, cast(sum(cast((c // q) * 100000 AS HUGEINT)) AS DOUBLE) / count(*) AS avg "
    "FROM tx GROUP BY ym",
    "contract_gas_series": _with(TX, CON)
    + "SELECT ym, cast(sum(q * 21000) AS BIGINT) AS gas FROM tx JOIN con ON tx.k = con.k GROUP BY ym",
    "scam_series_pivot": _with(TX, REG)
    + "SELECT ym, "
    + ", ".join(
        f"{_wei_text(f'{SUM_WEI} FILTER (WHERE replace(category, $$ $$, $$$$) = $${c}$$)')} AS \"{c}\""
        for c in ("FakeICO", "Phishing", "Scamming")
    ).replace("$$", "'")
    + " FROM tx JOIN reg ON tx.k = reg.k "
    "WHERE replace(category, ' ', '') IN ('FakeICO', 'Phishing', 'Scamming') GROUP BY ym ORDER BY ym",
    "transaction_validity": """
SELECT count(*) + 1 AS lines,
       count(*) FILTER (WHERE cast(round(l_discount * 100) AS INTEGER) <> 10
                          AND NOT (l_returnflag = 'R' AND l_linestatus = 'O')
                          AND cast(round(l_tax * 100) AS INTEGER) <> 8) AS valid,
       count(*) + 1 - count(*) FILTER (WHERE cast(round(l_discount * 100) AS INTEGER) <> 10
                          AND NOT (l_returnflag = 'R' AND l_linestatus = 'O')
                          AND cast(round(l_tax * 100) AS INTEGER) <> 8) AS dropped
FROM lineitem""",
    "contract_validity": """
SELECT count(*) + count(*) FILTER (WHERE s_acctbal > 9000) + 1 AS lines,
       count(*) FILTER (WHERE s_acctbal >= 0 AND s_nationkey NOT IN (10, 11))
         + count(*) FILTER (WHERE s_acctbal > 9000 AND s_nationkey NOT IN (10, 11)) AS valid,
       count(*) + count(*) FILTER (WHERE s_acctbal > 9000) + 1
         - count(*) FILTER (WHERE s_acctbal >= 0 AND s_nationkey NOT IN (10, 11))
         - count(*) FILTER (WHERE s_acctbal > 9000 AND s_nationkey NOT IN (10, 11)) AS dropped
FROM supplier""",
    "block_validity": f"""
SELECT count(*) + 1 AS lines,
       count(*) FILTER (WHERE {BLOCK_OK}) AS valid,
       count(*) + 1 - count(*) FILTER (WHERE {BLOCK_OK}) AS dropped
FROM orders""",
    "registry_addresses": _with(REG)
    + "SELECT '0x' || lpad(cast(k AS VARCHAR), 40, '0') AS address, id, category, status FROM reg",
    "block_bytes": _with(BLK)
    + "SELECT number, CASE WHEN o_orderstatus = 'P' THEN CAST(319 AS DOUBLE) ELSE CAST(384 AS DOUBLE) END AS bytes FROM blk",
    "contract_value_totals": _with(TX, CON)
    + f"SELECT '0x' || lpad(cast(t.k AS VARCHAR), 40, '0') AS address, {_wei_text('t.s')} AS total "
    "FROM (SELECT k, sum(cast(c AS HUGEINT)) AS s FROM tx GROUP BY k) t JOIN con ON t.k = con.k",
    "scam_value_by_id": _with(TX, REG)
    + f"SELECT id, {_wei_text(SUM_WEI)} AS total FROM tx JOIN reg ON tx.k = reg.k GROUP BY id",
}

# The same questions, answered from the summary that grows file by file.
ORACLE["summary_monthly_value_stats"] = ORACLE["text_monthly_value_stats"]
for _name in (
    "monthly_average_gas_price", "top_contracts_by_value", "monthly_contract_gas", "average_contract_gas",
    "gas_of_top_contracts", "most_lucrative_scam", "scam_value_by_category_month",
):
    ORACLE[f"summary_{_name}"] = ORACLE[_name]

# Versions behind a pointer, and what the reading pass counts and rejects.
ORACLE["versioned_contract_values"] = ORACLE["contract_value_totals"]
ORACLE["versioned_scam_values"] = ORACLE["scam_value_by_category_month"]
ORACLE["sorted_contract_gas"] = ORACLE["monthly_contract_gas"]
REJECTED = """
lines AS (
  SELECT 'transactions' AS kind, '0x' || lower(to_hex(l_orderkey)) || '0' || cast(l_linenumber AS VARCHAR) AS hash,
         CASE WHEN cast(round(l_tax * 100) AS INTEGER) = 8 OR (l_returnflag = 'R' AND l_linestatus = 'O') THEN 'fields'
              WHEN cast(round(l_discount * 100) AS INTEGER) = 10 THEN 'probe' ELSE 'kept' END AS outcome
  FROM lineitem
  UNION ALL
  SELECT 'contracts', NULL, CASE WHEN s_acctbal < 0 THEN 'fields' WHEN s_nationkey IN (10, 11) THEN 'probe' ELSE 'kept' END
  FROM supplier, (VALUES (1), (2)) AS listed(n) WHERE n = 1 OR s_acctbal > 9000
  UNION ALL
  SELECT 'blocks', NULL,
         CASE WHEN o_orderpriority = '1-URGENT' OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'O') THEN 'fields'
              WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN 'probe' ELSE 'kept' END
  FROM orders
  UNION ALL SELECT 'transactions', 'hash', 'probe'
  UNION ALL SELECT 'contracts', 'address', 'probe'
  UNION ALL SELECT 'blocks', 'number', 'probe'
)"""
_COUNTED = """count(*) AS lines, count(*) FILTER (WHERE outcome = 'kept') AS valid,
       count(*) FILTER (WHERE outcome = 'fields') AS wrong_fields, count(*) FILTER (WHERE outcome = 'probe') AS wrong_probe"""
ORACLE["sorted_validity"] = _with(REJECTED) + f"SELECT kind, {_COUNTED} FROM lines GROUP BY kind"
ORACLE["observed_validity"] = _with(REJECTED, TX) + f"SELECT {_COUNTED}, (SELECT count(*) FROM tx) AS n FROM lines WHERE kind = 'transactions'"
ORACLE["rejected_transactions"] = _with(REJECTED) + "SELECT hash, outcome AS reason FROM lines WHERE kind = 'transactions' AND outcome <> 'kept'"

# Sums and list stored in buckets of the address.
for _name in ("top_contracts_by_value", "monthly_contract_gas", "average_contract_gas", "gas_of_top_contracts"):
    ORACLE[f"colocated_{_name}"] = ORACLE[_name]
ORACLE["large_registry_addresses"] = ORACLE["registry_addresses"]
