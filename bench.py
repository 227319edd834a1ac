"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the local cores. A small query warms the JVM; then each query is timed
once, from building its plan to the last row.
"""

from __future__ import annotations

import json
import os
import time

from jobstrata.catalog import REGISTRY
from jobstrata.session import local_session

HEADLINE = """funnel_steps build_statistics panel_rows extract_comparison state_cascade pay_annual
list_parse missing_values repeat_counts repeat_rows_hot company_spellings default_detector
priority_frequency customer_frequency quartiles price_histogram median_by_nation role_table
item_premium item_composition token_counts top_tokens skill_demand_by_role gap_summary
role_shortfalls top_per_candidate collapsed_nations split_rows majority_scores
model_coefficients""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["display_labels"].run(spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
