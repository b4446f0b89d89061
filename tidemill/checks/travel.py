"""Checks for airlines and flights."""

from tidemill.checks.harness import check, declare
from tidemill.plans import travel as t

declare(
    passengers="""SELECT 'f' || o_custkey AS flight_id, 'p' || o_orderkey AS passenger_ref_number, 'n' || o_custkey AS flight_number,
        'c' || o_custkey % 9 AS carrier_code, o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS departure_time,
        o_orderstatus <> 'P' AS opted_in, o_orderpriority AS contact_info FROM {orders}""",
    checkins="""SELECT 'f' || l_partkey AS flight_id, 'n' || l_partkey AS flight_number, 'p' || l_orderkey AS passenger_ref_number,
        l_returnflag AS class FROM {lineitem}""",
    meals="""SELECT 'f' || p_partkey AS flight_id, CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'R' END AS class, CAST(p_size AS BIGINT) AS available_meals FROM {part}""",
    flights="""SELECT CASE WHEN l_suppkey % 12 > 0 THEN 'air' || l_suppkey % 12 END AS airline_name, 'ap' || l_partkey % 40 AS arrival_airport,
        'ap' || l_suppkey % 30 AS departure_airport, 'tz' || l_partkey % 5 AS arrival_timezone, 'tz' || l_suppkey % 6 AS departure_timezone,
        l_shipdate + (l_orderkey % 24) * INTERVAL '1' HOUR AS arrival_scheduled FROM {lineitem}""",
)

_SHOW = "flight_id, passenger_ref_number, flight_number, carrier_code, departure_time, contact_info"
check("q26_checkin_open", "passengers", oracle=f"""SELECT {_SHOW} FROM passengers WHERE opted_in
    AND departure_time - TIMESTAMP '2000-01-01' >= INTERVAL 48 HOUR AND departure_time - TIMESTAMP '2000-01-01' < INTERVAL 72 HOUR""")(
    lambda p: t.checkin_open(p, "2000-01-01 00:00:00"))
check("q26_checkin_departed", "passengers", oracle=f"""SELECT {_SHOW} FROM passengers WHERE opted_in
    AND TIMESTAMP '2000-01-01' - departure_time >= INTERVAL 48 HOUR AND TIMESTAMP '2000-01-01' - departure_time < INTERVAL 72 HOUR""")(
    lambda p: t.checkin_open(p, "2000-01-01 00:00:00", ahead=False))
_MEALS = """SELECT c.flight_id, c.flight_number, c.class, count(*) AS checked_in_passengers, available_meals,
    if(count(*) * 0.95 > available_meals, 'Meal Shortage', 'Sufficient Meals') AS meal_status
    FROM checkins c LEFT JOIN meals m ON m.flight_id = c.flight_id AND m.class = c.class GROUP BY 1, 2, 3, available_meals"""
check("q27_meal_status", "checkins", "meals", oracle=_MEALS)(t.meal_status)
check("q28_meal_shortages", "checkins", "meals", oracle=f"SELECT * FROM ({_MEALS}) WHERE meal_status = 'Meal Shortage'")(t.meal_shortages)

_W = "time_bucket(INTERVAL '1 day', arrival_scheduled) AS window_start, window_start + INTERVAL 1 DAY AS window_end"
check("q47_airline_flights", "flights", oracle=f"SELECT airline_name, count(airline_name) AS total_flights, {_W} FROM flights GROUP BY ALL")(
    lambda f: t.airline_flights(f, "1 day"))


def _traffic(by: str) -> str:
    return f"""SELECT * FROM (SELECT arrival_{by}, count(*) AS total_flights_arrival, {_W} FROM flights GROUP BY ALL)
      JOIN (SELECT departure_{by}, departure_{by} AS arrival_{by}, count(*) AS total_flights_departure,
            time_bucket(INTERVAL '1 day', arrival_scheduled) AS window_start FROM flights GROUP BY ALL) USING (arrival_{by}, window_start)"""


check("q48_airport_traffic", "flights", oracle=_traffic("airport"))(lambda f: t.airport_traffic(f, "1 day"))
check("q49_timezone_traffic", "flights", oracle=_traffic("timezone"))(lambda f: t.timezone_traffic(f, "1 day"))
