"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from longitab.session import builder
from queries import QUERIES

HEADLINE = [
    "timepoint_assembly", "coalesce_by_column", "fill_downup", "fill_mixed", "resolve_with_fallback",
    "cohort_semi_join", "baseline_merge", "score_longitudinal", "final_table", "monitoring_table",
    "adherence_summary", "earliest_per_group", "supplement_merge", "incidence_table", "extract_long",
    "extract_wide", "side_relative", "unpivot_split_name", "subscale_score", "filter_group_size",
    "missing_pairs", "explode_delimited", "normalise_list_text", "token_frequency", "patients_per_token",
    "per_id_token_profile", "instrument_extremes", "path_metadata", "point_in_area", "left_join",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
        .master(f"local[{cpus}]").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["distinct_keys"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
