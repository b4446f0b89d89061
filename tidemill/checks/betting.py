"""Checks for betting."""

from tidemill.checks.harness import check, declare
from tidemill.plans import betting as b

declare(
    positions="""SELECT p_partkey AS position_id, p_brand AS league, p_name AS position_name, 1.0E0 * p_size AS stake_amount,
                   200.0E0 * p_size AS max_risk, CAST(floor(p_retailprice) AS DOUBLE) AS fair_value FROM {part}""",
    odds="""SELECT l_partkey AS position_id, 'b' || l_suppkey % 5 AS bookmaker, CAST(floor(l_extendedprice / 40) AS DOUBLE) AS market_price,
              l_linenumber AS volume, l_shipdate AS timestamp FROM {lineitem}""",
    bettors="""SELECT c_custkey AS user_id, c_name AS username, c_mktsegment AS risk_tolerance, CAST(floor(c_acctbal) AS DOUBLE) AS avg_bet_size FROM {customer}""",
    bets="""SELECT o_custkey AS user_id, o_orderkey AS position_id, CASE o_orderstatus WHEN 'F' THEN 'Win' WHEN 'O' THEN 'Loss' ELSE 'Open' END AS result,
              CAST(floor(o_totalprice / 1000) - 260 AS DOUBLE) AS profit_loss FROM {orders}""",
    stakes="""SELECT o_custkey AS user_id, CAST(floor(o_totalprice / 100) AS DOUBLE) AS stake_amount FROM {orders}""",
)

_OVERVIEW = """SELECT position_id, position_name, league, stake_amount, max_risk, fair_value, market_price,
     (market_price - fair_value) * stake_amount AS profit_loss, last_update,
     CASE WHEN profit_loss > max_risk THEN 'High' WHEN profit_loss >= max_risk / 2 THEN 'Medium' ELSE 'Low' END AS risk_level
   FROM positions JOIN (SELECT position_id, max_by(market_price, (timestamp, market_price)) AS market_price, max(timestamp) AS last_update
     FROM odds GROUP BY 1) USING (position_id)"""
check("q20_position_overview", "positions", "odds", oracle=_OVERVIEW)(b.position_overview)
check("q21_risk_summary", "positions", "odds", oracle=f"SELECT risk_level, count(*) AS position_count FROM ({_OVERVIEW}) GROUP BY 1")(
    lambda p, o: b.risk_summary(b.position_overview(p, o)))
check("q22_market_summary", "positions", "odds", oracle="""
    SELECT position_id, position_name, league, bookmaker, market_price, last_update FROM positions JOIN (
      SELECT position_id, bookmaker, max_by(market_price, (timestamp, market_price)) AS market_price, max(timestamp) AS last_update
      FROM odds GROUP BY ALL) USING (position_id)""")(b.market_summary)

_PATTERNS = """SELECT user_id, count(*) AS total_bets, count(*) FILTER (result = 'Win') AS wins, count(*) FILTER (result = 'Loss') AS losses,
    avg(profit_loss) AS avg_profit_loss, sum(profit_loss) AS total_profit_loss FROM bets GROUP BY 1"""
_EXPOSURE = "SELECT user_id, sum(stake_amount) AS total_exposure, count(*) AS active_positions FROM stakes GROUP BY 1"
check("q23_betting_patterns", "bets", oracle=_PATTERNS)(b.betting_patterns)
check("q24_user_exposure", "stakes", oracle=_EXPOSURE)(b.user_exposure)
check("q25_high_risk_users", "bettors", "stakes", "bets", oracle=f"""
    SELECT user_id, username, risk_tolerance, total_exposure, total_bets, avg_profit_loss, total_profit_loss
    FROM bettors JOIN ({_EXPOSURE}) USING (user_id) JOIN ({_PATTERNS}) USING (user_id)
    WHERE total_exposure > avg_bet_size * 5 AND avg_profit_loss < 0""")(b.high_risk_users)
