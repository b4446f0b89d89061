"""Checks for mirrored tables."""

from tidemill.checks.harness import check, declare
from tidemill.plans import mirrors as m

_DOC = """'{{"order_id": ' || CASE WHEN o_orderkey % 2 = 0 THEN '{{"$numberLong": "' || o_orderkey || '"}}' ELSE '' || o_orderkey END || ', "customer_id": ' || o_custkey ||
   ', "items_total": ' || CAST(floor(o_totalprice) AS BIGINT) || ', "currency": "USD", "channel": "' || CASE WHEN o_custkey % 2 = 0 THEN 'web' ELSE 'app' END || '", "status": "' || {0} ||
   '", "is_expedited": ' || CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END || '}}'"""
declare(
    order_feed=f"""SELECT 'c' AS op, o_orderkey AS seq, '' || o_orderkey AS _id, o_orderdate AS commit_ts, {_DOC.replace('{0}', "'pending'")} AS payload FROM {{orders}}
       UNION ALL SELECT 'u', 100000000 + o_orderkey, '' || o_orderkey, o_orderdate + INTERVAL '1' DAY, {_DOC.replace('{0}', "o_orderstatus")} FROM {{orders}} WHERE o_orderkey % 4 > 0
       UNION ALL SELECT 'd', 200000000 + o_orderkey, '' || o_orderkey, o_orderdate + INTERVAL '2' DAY, CAST(NULL AS STRING) FROM {{orders}} WHERE o_orderkey % 9 = 0""",
    trip_feed="""SELECT 'c' AS op, o_orderkey AS seq, o_orderkey AS trip_id, o_custkey AS rider_id, 'requested' AS trip_status, o_orderkey % 2 AS is_surge, o_orderdate AS request_ts,
         CAST(NULL AS TIMESTAMP) AS pickup_ts, o_orderdate AS commit_ts FROM {orders}
       UNION ALL SELECT 'u', 100000000 + o_orderkey, o_orderkey, o_custkey, 'accepted', o_orderkey % 2, o_orderdate, CAST(NULL AS TIMESTAMP), o_orderdate + INTERVAL '1' HOUR FROM {orders} WHERE o_orderstatus <> 'P'
       UNION ALL SELECT 'u', 200000000 + o_orderkey, o_orderkey, o_custkey, 'picked_up', o_orderkey % 2, o_orderdate, o_orderdate + INTERVAL '5' MINUTE, o_orderdate + INTERVAL '2' HOUR FROM {orders} WHERE o_orderstatus = 'F'
       UNION ALL SELECT 'd', 300000000 + o_orderkey, o_orderkey, o_custkey, 'picked_up', 0, o_orderdate, CAST(NULL AS TIMESTAMP), o_orderdate + INTERVAL '3' HOUR FROM {orders} WHERE o_orderkey % 50 = 0""",
    card_feed="""SELECT 'c' AS op, o_orderkey AS seq, o_orderkey AS transaction_id, o_custkey AS account_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         'pending' AS tran_status, false AS is_fraud_suspect FROM {orders}
       UNION ALL SELECT 'u', 1000000000 + o_orderkey, o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)),
         CASE WHEN o_orderstatus = 'F' THEN 'reversed' ELSE 'posted' END, o_orderstatus = 'F' FROM {orders} WHERE o_orderstatus <> 'P'""",
    accounts="SELECT c_custkey AS account_id, c_mktsegment AS account_type, CAST(c_acctbal AS DECIMAL(18,2)) AS balance, 'active' AS account_status, TIMESTAMP '2025-08-01 00:00:00' AS updated_at FROM {customer}",
    account_updates="""SELECT c_custkey + 500 AS account_id, c_mktsegment AS account_type, CAST(c_acctbal AS DECIMAL(18,2)) AS balance, 'frozen' AS account_status,
        TIMESTAMP '2025-08-02 00:00:00' AS updated_at FROM {customer}
      UNION ALL SELECT c_custkey + 500, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) + 1, 'closed', TIMESTAMP '2025-08-02 01:00:00' FROM {customer} WHERE c_custkey % 2 = 0""",
)

check("q105_order_documents", "order_feed", oracle="""
    WITH l AS (SELECT _id, arg_max(op, seq) AS op, max(commit_ts) AS commit_ts, max_by(coalesce(payload, '{}'), seq) AS p FROM order_feed GROUP BY _id)
    SELECT _id::BIGINT AS order_id, (p->>'customer_id')::BIGINT AS customer_id, (p->>'items_total')::DOUBLE AS items_total, p->>'currency' AS currency, NULL::VARCHAR AS payment_method,
      p->>'channel' AS channel, NULL::VARCHAR AS shipping_city, NULL::VARCHAR AS shipping_state, NULL::VARCHAR AS shipping_country, p->>'status' AS status,
      (p->>'is_expedited')::BOOLEAN AS is_expedited, commit_ts FROM l WHERE op <> 'd'""")(m.order_documents)
check("q106_trips", "trip_feed", oracle="""
    SELECT * EXCLUDE (op, seq) REPLACE (is_surge = 1 AS is_surge) FROM trip_feed QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY seq DESC) = 1 AND op <> 'd'""")(m.trips)
check("q107_card_transactions", "card_feed", oracle="""
    SELECT * EXCLUDE (op, seq) REPLACE (amount::DOUBLE AS amount) FROM card_feed QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY seq DESC) = 1""")(m.card_transactions)
check("q108_bank_accounts", "accounts", "account_updates", oracle="""
    SELECT DISTINCT ON (account_id) * REPLACE (balance::DOUBLE AS balance) FROM (SELECT * FROM accounts UNION ALL SELECT * FROM account_updates) ORDER BY account_id, updated_at DESC""")(m.bank_accounts)
