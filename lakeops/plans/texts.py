"""The workload tables of ``sources.views`` as SQL, for the comparison queries."""

LOAN = """loan AS (
  SELECT c_custkey AS loan_id, concat('S', CAST(c_nationkey AS VARCHAR)) AS addr_state,
         CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS loan_status
  FROM customer)"""

LOAN_BY_STATE = LOAN + """,
loan_by_state AS (SELECT addr_state, count(*) AS cnt FROM loan GROUP BY addr_state)"""

MERGE_SRC = """merge_src AS (
  SELECT * FROM (VALUES ('S7', CAST(1000000 AS BIGINT)), ('S3', CAST(25 AS BIGINT)),
    ('S20', CAST(NULL AS BIGINT)), ('ZZ', CAST(9 AS BIGINT))) AS t(addr_state, cnt))"""

FLIGHTS = """flights AS (
  SELECT CAST(month(l_shipdate) AS BIGINT) AS month, CAST(isodow(l_shipdate) AS BIGINT) AS dow,
         l_suppkey % 25 AS origin
  FROM lineitem)"""

PRICE = """price AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
         l_quantity AS qty, l_extendedprice/1000 AS ext, l_discount AS disc, l_tax AS tax,
         l_extendedprice*(1-l_discount)*(1+l_tax)/1000 AS price
  FROM lineitem)"""

SCORE = "CAST(0.5 AS DOUBLE) + CAST(0.99 AS DOUBLE)*ext - 53*disc + 51*tax"

PRED = PRICE + """,
pred AS (
  SELECT b.batch, p.price,
         CAST(0.5 AS DOUBLE)
         + CAST(0.99 AS DOUBLE)*(CASE WHEN b.batch >= 3 THEN 0.0 ELSE p.ext END)
         - 53*(CASE WHEN b.batch >= 2 THEN 0.0 ELSE p.disc END)
         + 51*(CASE WHEN b.batch >= 4 THEN 0.0 ELSE p.tax END) AS prediction
  FROM price p CROSS JOIN (SELECT unnest(range(5)) AS batch) AS b)"""

IS_TEST = "(l_orderkey*31 + l_linenumber*17 + l_partkey*7 + l_suppkey) % 4 = 0"

# The table after each version of the scenario, as common table expressions.
SCENARIO = LOAN_BY_STATE + ",\n" + MERGE_SRC + """,
v0 AS (SELECT * FROM loan_by_state),
v6 AS (SELECT * FROM v0 UNION ALL SELECT 'S7', CAST(4500 AS BIGINT) FROM range(6)),
v7 AS (SELECT * FROM v6 WHERE addr_state <> 'S7'),
v8 AS (SELECT addr_state, CASE WHEN addr_state = 'S12' THEN CAST(27000 AS BIGINT) ELSE cnt END AS cnt FROM v7),
v9 AS (SELECT d.addr_state, CASE WHEN m.addr_state IS NULL THEN d.cnt ELSE m.cnt END AS cnt
       FROM v8 d LEFT JOIN merge_src m ON d.addr_state = m.addr_state
       UNION ALL
       SELECT m.addr_state, m.cnt FROM merge_src m
       WHERE NOT EXISTS (SELECT 1 FROM v8 d WHERE d.addr_state = m.addr_state)),
v10 AS (SELECT addr_state, cnt, CAST(NULL AS DOUBLE) AS amount FROM v9
        UNION ALL
        SELECT addr_state, CAST(trunc(CAST(cnt AS DOUBLE) * 0.5) AS BIGINT), CAST(cnt AS DOUBLE) * 5000 FROM v9)"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select
