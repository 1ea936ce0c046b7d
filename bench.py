"""Time the headline queries and print one JSON line.

Each query is run once to warm the JVM and then timed as the best of two runs into the no-op sink, which
computes every row and column. BENCH_SF_DIR names the tables, BENCH_CPUS the number of threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from zonalis.queries import queries  # noqa: E402
from zonalis.session import build_session  # noqa: E402

HEADLINE = (
    "elections_2019_long elections_2019_wide elections_2015_wide census_table areal_interpolate ratio_percent "
    "join_role_playing win_total agg_two_level reshape_pivot reshape_unpivot fn_paste src_html_links sink_semicolon_csv "
    "geo_overlay_boxes geo_overlay_polygons geo_overlay_share geo_point_in_polygon geo_section_match geo_full_lookup "
    "geo_validate stat_corr_matrix stat_ols_facet ml_forward_select ml_cv_results "
    "final_circuit_table correlation_report stepwise_models chart_lines"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs[1:]), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
