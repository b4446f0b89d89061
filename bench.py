"""Time the headline queries, then every other batch view; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

``value`` is the total over the headline queries, each the median of
``BENCH_REPEATS`` runs (3; one run if it takes 3 seconds or more); the other
views (``others``) run once.
``rows_per_sec`` gives input rows by seconds for the streaming replays.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemill.checks import load_all, run  # noqa: E402
from tidemill.checks.harness import load  # noqa: E402
from tidemill.session import local_session  # noqa: E402

# One query per shape of work; streaming replays are timed end to end.
HEADLINE = (
    "q1_page_visits", "q5_actions_per_window", "q6_price_and_spread", "q7_volatility", "q8_enriched_ticks",
    "q11_price_spike", "q13_campaign_performance", "q20_position_overview", "q27_meal_status", "q29_stock_status",
    "q31_sales_at_price", "q33_demand_elasticity", "q39_customer_segments", "q46_projected_time_of_use_bill",
    "q48_airport_traffic", "q52_unified_alerts", "q55_machine_anomalies", "q61_enriched_prices", "q66_fleet_assignments",
    "q67_fleet_overview", "q70_order_eta", "q73_block_stats", "q76_spoofing_alerts", "q79_impact_leaders",
    "q80_spikes", "q88_user_request_metrics", "q91_status_distribution", "q97_nearest_documents", "q98_net_purchases",
    "q100_enriched_clicks", "q101_session_figures", "q106_trips", "q111_headline_signals", "q112_conversion_funnel",
    "j5_band_join", "j7_asof_left_join", "j11_multiway_join", "w4_running_total", "a8_exact_median",
    "st1_tumble", "st6_view_on_view", "st12_latest_state",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    known = load_all()

    def timed(name: str, times: int) -> float:
        took: list[float] = []
        while len(took) < times and (not took or took[0] < 3):
            start = time.perf_counter()
            run(spark, sf_dir, name).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        return round(statistics.median(took), 3)

    # Start the JVM, the Python workers and the code paths every query shares.
    for name in ("q1_page_visits", "q111_headline_signals", "q7_volatility"):
        timed(name, 1)
    chosen = sys.argv[1:] or [n for n in HEADLINE if n in known]
    seconds = {name: timed(name, repeats) for name in chosen}
    rest = [] if sys.argv[1:] else [n for n in known if re.match(r"q\d", n) and n not in seconds]
    others = {name: timed(name, 1) for name in rest}
    replays = [n for n in seconds if n.startswith("st")]
    rates = {n: round(sum(load(spark, sf_dir, i).count() for i in known[n].inputs) / seconds[n]) for n in replays}
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "others": others,
                      "rows_per_sec": rates}))
    spark.stop()


if __name__ == "__main__":
    main()
