"""DuckDB twins of the fixture tables, used as CTEs by every oracle query.

``members`` mirrors ``plans.members.observe``; ``planted`` and ``scores``
mirror ``with_planted`` / ``scores``. Arithmetic is written in DOUBLE and in
the same operation order as the Spark side so the values agree bit for bit
before rounding.
"""

MEMBERS = """
m_obs AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-02-01'),
m_oa AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS start_date, count(*) AS visits,
                avg(o_totalprice) AS avg_value,
                CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS urgent
         FROM m_obs GROUP BY o_custkey),
m_la AS (SELECT o_custkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returns,
                count(DISTINCT l_partkey) AS parts,
                avg(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS wait_days
         FROM m_obs JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey),
m_ec AS (SELECT user_id, event_type, count(*) AS k FROM events
         WHERE event_type IN ('click', 'view', 'purchase') GROUP BY user_id, event_type),
m_ev AS (SELECT user_id, event_type AS pref FROM (SELECT *, row_number() OVER
         (PARTITION BY user_id ORDER BY k DESC, event_type) AS rn FROM m_ec) t WHERE rn = 1),
m_oc AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-02-01'),
members AS (
  SELECT c_custkey AS member_id, c_mktsegment AS segment, r_name AS region, c_acctbal AS fee,
         start_date, CAST(coalesce(visits, 0) AS BIGINT) AS visits, avg_value,
         CAST(coalesce(urgent, 0) AS BIGINT) AS urgent, returns, parts, wait_days, pref,
         CAST(CASE WHEN m_oc.o_custkey IS NULL THEN 1 ELSE 0 END AS INTEGER) AS churn
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  LEFT JOIN m_oa ON m_oa.o_custkey = c_custkey LEFT JOIN m_la ON m_la.o_custkey = c_custkey
  LEFT JOIN m_ev ON m_ev.user_id = c_custkey LEFT JOIN m_oc ON m_oc.o_custkey = c_custkey),
m_z AS (
  SELECT *,
    (-0.2::DOUBLE * (visits - 9) + 0.3::DOUBLE * (CASE WHEN pref IS NULL THEN 1 ELSE 0 END)) AS z0,
    (-0.2::DOUBLE * (visits - 9) + 0.3::DOUBLE * (CASE WHEN pref IS NULL THEN 1 ELSE 0 END))
      + 0.25::DOUBLE * (coalesce(returns, 0) - 12) AS z,
    CAST(('0x' || substr(md5(CAST(member_id AS VARCHAR) || '|label'), 1, 8)) AS BIGINT)::DOUBLE
      / 4294967296.0::DOUBLE AS u
  FROM members),
planted AS (
  SELECT member_id, segment, region, fee, start_date, visits, avg_value, urgent, returns, parts,
         wait_days, pref, churn,
         round(1.0::DOUBLE / (1.0::DOUBLE + exp(-z)), 6) AS score,
         CAST(CASE WHEN u < 1.0::DOUBLE / (1.0::DOUBLE + exp(-z)) THEN 1 ELSE 0 END AS INTEGER) AS planted,
         z, z0
  FROM m_z),
scores AS (
  SELECT member_id, 'rule_full' AS model_key, planted AS y_true,
         round(1.0::DOUBLE / (1.0::DOUBLE + exp(-z)), 6) AS y_score FROM planted
  UNION ALL
  SELECT member_id, 'rule_50', planted,
         round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(z + 0.00002::DOUBLE * fee))), 6) FROM planted
  UNION ALL
  SELECT member_id, 'rule_full_without_returns', planted,
         round(1.0::DOUBLE / (1.0::DOUBLE + exp(-z0)), 6) FROM planted)
"""


def with_fixtures(body: str) -> str:
    """Prefix a query with the fixture CTEs. ``body`` may start with more CTEs
    (``name AS (...), ...`` followed by SELECT) or be a plain SELECT."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {MEMBERS.strip()}\n{body}"
    return f"WITH {MEMBERS.strip()},\n{body}"
