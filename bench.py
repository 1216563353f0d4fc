"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``store_*`` are the steps that read texts or join the whole catalog; the other
queries start from what these wrote, as reports on a stored catalog do. ``tree_*``
scan a real folder of files made from the documents table.
"""

import itertools
import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

REPO = Path(__file__).resolve().parent
sys.path.insert(0, str(REPO))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
TREE_FILES = int(os.environ.get("BENCH_TREE_FILES", "5000"))

HEADLINES = (
    "path_parts", "classify_formats", "corpus_hint", "census_excluded", "census_limit",
    "content_hash", "hash_plan", "change_report", "catalog_merge", "prune_missing",
    "files_by_category", "files_by_corpus_hint", "duplicate_groups", "duplicate_groups_top",
    "duplicate_members", "catalog_summary", "run_counters", "scan_result", "moved_files",
    "csv_rows",
)


def run(df):
    df.write.format("noop").mode("overwrite").save()


def timed(action):
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def make_tree(spark, base: Path):
    """Real files of real sizes: the first documents' texts, in the folders of their paths."""
    from shelfmark.sources import tables

    docs = tables.table(spark, SF_DIR, "documents").selectExpr(
        f"{tables.FILES_OF['documents'][1]} AS path", "text"
    )
    for row in docs.limit(TREE_FILES).toLocalIterator():
        place = base / row["path"].removeprefix("/lib/")
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text(row["text"])


def main():
    from pyspark.sql import SparkSession

    scratch = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("shelfmark-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from shelfmark.plans import queries
    from shelfmark.plans.rescan import rescan
    from shelfmark.sources import tables

    def median(action):
        """Of REPEATS runs after one that is not timed."""
        action()
        return statistics.median(timed(action) for _ in range(REPEATS))

    def store_catalog():
        queries._STORED.clear()
        queries._files(spark, SF_DIR)

    seconds = {
        "store_contents": median(lambda: run(tables.contents(spark, SF_DIR))),
        "store_catalog": median(store_catalog),
    }
    for name in HEADLINES:
        seconds[name] = median(lambda: run(queries.QUERIES[name](spark, SF_DIR)))

    make_tree(spark, scratch / "lib")
    catalogs = itertools.count()

    def scan(catalog):
        rescan(spark, str(scratch / catalog), [str(scratch / "lib")], log=lambda *_: None)

    seconds["tree_first_scan"] = median(lambda: scan(f"catalog{next(catalogs)}"))
    seconds["tree_unchanged_rescan"] = median(lambda: scan("catalog0"))
    spark.stop()
    print(json.dumps({
        "metric": "sum of median seconds per query",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
        "tree_files": TREE_FILES,
    }))


if __name__ == "__main__":
    main()
