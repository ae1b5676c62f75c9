"""Times the headline queries and prints one JSON line.

Every query is run to the end over its whole tables (the rows go to Spark's ``noop``
sink). Progress goes to standard error.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from checks.compare import session  # noqa: E402
from checks.spark_queries import QUERIES  # noqa: E402

HEADLINE = (
    "stage_listings", "validate_rows", "flag_duplicates", "dedup_keep_first", "merge_demography",
    "grid_neighbor_join", "nearest_within_radius", "knn_within_radius", "city_median", "city_mode",
    "idw_impute", "impute_building", "impute_amenities", "surrogate_key", "dim_unit", "price_deviation",
    "location_premium", "rent_to_wage", "fact_offers",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = session(cpus)
    QUERIES["location_premium"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
