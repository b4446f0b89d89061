"""Checks for chain transactions."""

from tidemill.checks.harness import check, declare
from tidemill.plans import ledger as g

_ONE = """'{{"slot": "' || (user_id % 40 + {0}) || '", "blockTime": "' || CAST(ts + INTERVAL '{0}' SECOND AS STRING) || '", "tx_type": "' ||
   CASE (event_id + {0}) % 3 WHEN 0 THEN 'SOL Transfer' WHEN 1 THEN 'SPL-Token Transfer' ELSE 'Vote' END || '", "signature": "sig' || event_id || '-{0}", "sender": "a' || user_id ||
   '", "receiver": "b' || event_id % 9 || '", "amount": "' || (event_id % 1000 + {0}) || '", "fee": "5000"}}'"""
declare(tx_batches=f"""SELECT CASE WHEN event_id % 10 = 0 THEN '[]' WHEN event_id % 10 < 5 THEN '[' || {_ONE.replace('{0}', '1')} || ']'
    ELSE '[' || {_ONE.replace('{0}', '2')} || ', ' || {_ONE.replace('{0}', '3')} || ']' END AS transactions FROM {{events}}""")

_TX = """SELECT e->>'slot' AS slot, (e->>'blockTime')::TIMESTAMP AS blockTime, e->>'tx_type' AS tx_type, e->>'signature' AS signature, e->>'sender' AS sender,
   e->>'receiver' AS receiver, (e->>'amount')::DOUBLE AS amount, e->>'fee' AS fee FROM (SELECT unnest(from_json(transactions, '["JSON"]')) AS e FROM tx_batches)"""
_STATS = ", ".join(f"""count(*) FILTER (tx_type = '{k}') AS {p}_tx_count, coalesce(sum(amount) FILTER (tx_type = '{k}'), 0) AS {p}_total_amount,
   round(avg(amount) FILTER (tx_type = '{k}')) AS {p}_avg_amount, coalesce(max(amount) FILTER (tx_type = '{k}'), 0) AS {p}_max_amount,
   coalesce(min(amount) FILTER (tx_type = '{k}'), 0) AS {p}_min_amount""" for p, k in g.TRANSFER_TYPES.items())
_HOP = f"""SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, {_STATS} FROM
   (SELECT *, time_bucket(INTERVAL '1 hour', blockTime) - k * INTERVAL 1 HOUR AS window_start FROM ({_TX}), range(2) t(k)) GROUP BY window_start"""

check("q72_transactions", "tx_batches", oracle=_TX)(g.transactions)
check("q73_block_stats", "tx_batches", oracle=f"SELECT slot, {_STATS} FROM ({_TX}) GROUP BY slot")(lambda b: g.block_stats(g.transactions(b)))
check("q74_window_stats", "tx_batches", oracle=_HOP)(lambda b: g.window_stats(g.transactions(b), "1 hour", "2 hours"))
check("q74_last_closed_window", "tx_batches", oracle=f"SELECT * FROM ({_HOP}) WHERE window_end < TIMESTAMP '2024-01-20 10:30:00' ORDER BY window_end DESC LIMIT 1")(
    lambda b: g.last_closed_window(g.window_stats(g.transactions(b), "1 hour", "2 hours"), "2024-01-20 10:30:00"))
_5S = f"SELECT time_bucket(INTERVAL '10 minutes', blockTime) AS window_start, count(*) AS tx_count FROM ({_TX}) GROUP BY 1"
check("q75_counts_per_window", "tx_batches", oracle=_5S)(lambda b: g.counts_per_window(g.transactions(b), "10 minutes"))
check("q75_recent_counts", "tx_batches", oracle=f"SELECT * FROM ({_5S}) WHERE window_start >= TIMESTAMP '2024-01-29'")(
    lambda b: g.recent_counts(g.counts_per_window(g.transactions(b), "10 minutes"), "2024-01-30 00:00:00", "1 day"))
check("q75_lookup_by_slot", "tx_batches", oracle=f"SELECT * FROM ({_TX}) WHERE slot = '12'")(lambda b: g.lookup(g.transactions(b), "slot", "12"))
check("q75_lookup_by_signature", "tx_batches", oracle=f"SELECT * FROM ({_TX}) WHERE signature = 'sig77-2'")(
    lambda b: g.lookup(g.transactions(b), "signature", "sig77-2"))
