"""Time the headline queries: one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of cores. Each query runs to
the end with its rows discarded; the time includes planning.
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from checks.archives import built_packages  # noqa: E402
from checks.queries import queries  # noqa: E402
from kelpline.session import builder  # noqa: E402

HEADLINE = [
    "publish",
    "add_locations",
    "restrict",
    "enrich",
    "add_position_sweref99tm",
    "publish_targets",
    "unmatched_codes",
    "replace_latest",
    "summarize_log",
    "publish_archives",
    "publish_log",
    "update_stores",
    "add_locations_dense",
    "add_locations_clustered",
    "write_table_files",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = queries()
    chosen = sys.argv[1:] or HEADLINE
    # start the session's machinery outside the first measurement, on the least tables
    least = str(pathlib.Path(sf_dir).parent / "sf0.001")
    for name in ("publish", "summarize_log"):
        found[name](spark, least if os.path.isdir(least) else sf_dir).write.format("noop").mode("overwrite").save()
    if {"publish_archives", "publish_log", "update_stores"} & {*chosen}:
        # the archives are its input
        built_packages(spark, sf_dir)
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    sf = pathlib.Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
