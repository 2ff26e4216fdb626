"""Time the headline queries and print one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from newsalpha.catalog import QUERIES  # noqa: E402
from newsalpha.session import local_session  # noqa: E402

HEADLINE = [
    "filter_headline_length",
    "utc_to_eastern",
    "attach_permno",
    "single_firm_join",
    "constituent_spells",
    "opening_window_shift",
    "funnel_stage_counts",
    "filtering_funnel",
    "compute_return_window",
    "build_labeled_dataset",
    "merge_sector",
    "synthetic_sector_returns",
    "sector_panel",
    "sector_correlations",
    "forward_fill",
    "monthly_market",
    "text_length_stats",
    "return_histogram",
    "sample_n",
    "embed_headlines",
    "chunk_embed_average",
    "mean_pool",
    "pairwise_cosine",
    "top_n_nearest",
    "window_split_counts",
    "rolling_oos",
    "quintile_portfolio",
    "sector_score_lagged",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "rows_per_group", folder)  # starts the session's own machinery
    seconds = {name: run(spark, name, folder) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
