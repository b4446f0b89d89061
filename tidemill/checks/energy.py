"""Checks for household energy."""

from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.plans import energy as e

declare(
    consumption="SELECT user_id + CASE WHEN event_type = 'view' THEN 1000000000 ELSE 0 END AS meter_id, ts AS consumption_time, CAST(floor(value) AS DOUBLE) AS energy_consumed FROM {events}",
    production="SELECT user_id + CASE WHEN event_type IN ('view', 'click') THEN 0 ELSE 2000000000 END AS meter_id, ts AS production_time, CAST(event_id % 9 AS DOUBLE) AS energy_produced FROM {events}",
    households="SELECT c_custkey AS customer_id, c_custkey AS meter_id, CASE WHEN c_custkey % 2 = 0 THEN 'tier' ELSE 'time of use' END AS price_plan FROM {customer}",
)

_HOUSE = """SELECT * EXCLUDE (a, b), a AS energy_consumed, b AS energy_produced, a - b AS total_energy
  FROM (SELECT meter_id, time_bucket(INTERVAL '6 hours', consumption_time) + INTERVAL 6 HOUR AS window_end, sum(energy_consumed) AS a FROM consumption GROUP BY ALL)
  JOIN (SELECT meter_id, time_bucket(INTERVAL '6 hours', production_time) + INTERVAL 6 HOUR AS window_end, sum(energy_produced) AS b FROM production GROUP BY ALL)
  USING (meter_id, window_end)"""
_CTE = f"""house AS ({_HOUSE}), plan AS (SELECT meter_id, total_energy, window_end, price_plan, date_trunc('month', window_end) AS month,
    date_trunc('year', window_end) AS year FROM house JOIN households USING (meter_id)),
  closed AS (SELECT * FROM plan WHERE date_trunc('day', window_end) < (SELECT date_trunc('day', max(window_end)) FROM house))"""
_COST = "total_energy * if(hour(window_end) BETWEEN 16 AND 20, 0.4::DOUBLE, 0.2::DOUBLE)"


def _tier(x: str) -> str:
    return f"if({x} <= 200, {x} * 0.2::DOUBLE, 40 + ({x} - 200) * 0.4::DOUBLE)"


def _house(c, p):
    return e.energy_per_house(c, p, "6 hours")


def _on(plan, c, p, h):
    return e.meters_on_plan(_house(c, p), h, plan)


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


check("q40_energy_per_house", "consumption", "production", oracle=_HOUSE)(_house)
check("q41_energy_per_month", "consumption", "production", oracle=f"""SELECT meter_id, date_trunc('month', window_end) AS month,
    date_trunc('year', window_end) AS year, sum(total_energy) AS total_energy FROM ({_HOUSE}) GROUP BY ALL""")(
    lambda c, p: e.energy_per_month(_house(c, p)))
for _plan, _name in (("tier", "q42_tier_meters"), ("time of use", "q42_time_of_use_meters")):
    check(_name, "consumption", "production", "households", oracle=f"""WITH {_CTE}
        SELECT meter_id, total_energy, window_end FROM plan WHERE price_plan = '{_plan}'""")(
        lambda c, p, h, plan=_plan: _on(plan, c, p, h))
check("q43_tiered_bill", "consumption", "production", "households", oracle=f"""WITH {_CTE}
    SELECT meter_id, month, year, {_tier('sum(total_energy)')} AS current_bill FROM plan WHERE price_plan = 'tier' GROUP BY meter_id, month, year""")(
    lambda c, p, h: e.tiered_bill(_on("tier", c, p, h)))
check("q44_projected_tiered_bill", "consumption", "production", "households", oracle=f"""WITH {_CTE},
    x AS (SELECT meter_id, month, sum(total_energy) / day(max(window_end)) * day(last_day(month)) AS t FROM closed WHERE price_plan = 'tier' GROUP BY meter_id, month)
    SELECT meter_id, month, round(t, 6) AS estimated_total_energy, round({_tier('t')}, 6) AS estimated_total_bill FROM x""")(
    lambda c, p, h: _rounded(e.projected_tiered_bill(_on("tier", c, p, h), _house(c, p)), "estimated_total_energy", "estimated_total_bill"))
check("q45_time_of_use_bill", "consumption", "production", "households", oracle=f"""WITH {_CTE}
    SELECT meter_id, month, year, round(sum({_COST}), 6) AS monthly_cost FROM plan WHERE price_plan = 'time of use' GROUP BY ALL""")(
    lambda c, p, h: _rounded(e.time_of_use_bill(_on("time of use", c, p, h)), "monthly_cost"))
check("q46_projected_time_of_use_bill", "consumption", "production", "households", oracle=f"""WITH {_CTE}
    SELECT meter_id, month, round(sum({_COST}) / max(day(window_end)) * day(last_day(month)), 6) AS estimated_monthly_bill,
      round(sum(total_energy) / max(day(window_end)) * day(last_day(month)), 6) AS estimated_total_energy
    FROM closed WHERE price_plan = 'time of use' GROUP BY meter_id, month""")(
    lambda c, p, h: _rounded(e.projected_time_of_use_bill(_on("time of use", c, p, h), _house(c, p)),
                             "estimated_monthly_bill", "estimated_total_energy"))
