"""The same fixture in DuckDB SQL, for the oracle queries.

It is written relationally (joins and UNNEST of plain lists, no nested
structs), so the oracle checks the Spark nested-array path against an
independent derivation:

* ``tx``       one row per transaction with the scalar raw columns, ``k`` the
               order key and ``day``;
* ``tx_in_e``  ``(k, idx, addr)`` one row per non-NULL input address slot;
* ``tx_out_e`` the same for outputs;
* ``tx_in_a`` / ``tx_out_a``  distinct ``(k, addr)``.
"""

TX_CTES = """
tx_b AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_orderdate AS od, o_totalprice AS tp,
         o_orderkey % 50 = 0 AS cb,
         date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS bn,
         CASE WHEN o_orderkey % 211 = 0 THEN NULL
              ELSE CAST(ROUND(o_totalprice * 100) AS BIGINT) * 250 END AS ov
  FROM orders
),
tx_n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
tx_c AS (
  SELECT b.*, CAST(CASE WHEN b.cb THEN 0 ELSE coalesce(tx_n.n, 0) END AS BIGINT) AS input_count,
         CAST(coalesce(tx_n.n, 0) AS BIGINT) AS output_count
  FROM tx_b b LEFT JOIN tx_n ON b.k = tx_n.l_orderkey
),
tx AS (
  SELECT k,
         sha256(CAST(k AS VARCHAR)) AS hash,
         CAST(bn AS BIGINT) AS block_number,
         od + to_seconds((k * 37) % 86400) AS block_timestamp,
         CAST(date_trunc('month', od) AS DATE) AS block_timestamp_month,
         CAST(od + to_seconds((k * 37) % 86400) AS DATE) AS day,
         CAST(10 + 148 * input_count + 34 * output_count AS BIGINT) AS size,
         CAST(10 + 148 * input_count + 34 * output_count AS BIGINT) AS virtual_size,
         CAST(1 + k % 2 AS BIGINT) AS version,
         input_count, output_count,
         CAST(CASE WHEN cb THEN 0 ELSE 200 + k % 800 END AS BIGINT) AS fee,
         cb AS is_coinbase,
         CASE WHEN cb THEN NULL ELSE coalesce(ov, 0) + 200 + k % 800 END AS input_value,
         ov AS output_value
  FROM tx_c
),
tx_in_e AS (
  SELECT b.k, l.l_linenumber AS idx, u.addr
  FROM tx_b b JOIN lineitem l ON l.l_orderkey = b.k,
       UNNEST(['A' || CAST(l.l_suppkey AS VARCHAR), 'A' || CAST(b.ck AS VARCHAR)]) AS u(addr)
  WHERE NOT b.cb AND b.bn % 97 <> 0
),
tx_out_e AS (
  SELECT b.k, l.l_linenumber AS idx, 'A' || CAST(l.l_partkey AS VARCHAR) AS addr
  FROM tx_b b JOIN lineitem l ON l.l_orderkey = b.k
  WHERE l.l_linenumber NOT IN (6, 7) AND b.bn % 97 <> 0
),
tx_in_a AS (SELECT DISTINCT k, addr FROM tx_in_e),
tx_out_a AS (SELECT DISTINCT k, addr FROM tx_out_e)
"""


def with_tx(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the fixture CTEs (plus optional extra CTEs)."""
    ctes = TX_CTES.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"
