"""A whole scan: list storage, join the prior snapshot, hash, write, report."""

import math
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schema as S
from shelfmark.operators import ids, merge, reports, visits
from shelfmark.sources import content, tree
from shelfmark.sources.journal import Journal, resumed
from shelfmark.sources.staging import staging_dir, written
from shelfmark.sources.store import Catalog, buckets_for, export_csv, require_unique_paths


#: Bytes hashed before their results are stored for good; what a scan that dies may lose.
WAVE_BYTES = 256 << 30


def new_run_id(now: datetime) -> str:
    return now.strftime("inv-%Y%m%dT%H%M%S-%fZ")


def summary_record(files: DataFrame) -> dict:
    """The summary report as one nested dict (a few dozen figures at most)."""
    record = {"by_category": {}, "by_corpus_hint": {}}
    for metric, key, value in reports.summary(files).collect():
        if metric in ("by_category", "by_corpus_hint"):
            record[metric][key] = value
        else:
            record[metric] = value
    return record


def _with_hashes(
    plan: DataFrame, todo, journal: Journal, scan: str, staging: str, task_bytes: int, wave_bytes: int
) -> DataFrame:
    """Only rows that need it go through the file readers, in waves that the journal keeps."""
    done = plan.where("action IS DISTINCT FROM 'hash'").selectExpr(
        "*", "string(NULL) AS new_sha256", "string(NULL) AS hash_error"
    )
    if not todo["to_hash"]:
        return done
    cost = todo["hash_bytes"] + todo["to_hash"] * content.OPEN_COST
    waves = math.ceil(cost / wave_bytes)
    waiting = plan.where("action = 'hash'")
    if waves > 1:
        # a seed of its own, since tasks of a wave go by xxhash64 of the path alone
        waiting = waiting.withColumn("wave", F.expr(f"int(pmod(xxhash64('wave', path), {waves}))"))
        target = f"{staging}/waiting"
        waiting.hint("rebalance", "wave").write.partitionBy("wave").parquet(target)
        waiting = plan.sparkSession.read.schema(waiting.schema).parquet(target)
    for wave in range(waves):
        part = waiting.where(F.col("wave") == wave).drop("wave") if waves > 1 else waiting
        done = done.unionByName(journal.append(content.with_file_hashes(part, task_bytes), scan, wave))
    return done


def rescan(
    spark: SparkSession,
    catalog: str,
    roots,
    *,
    exclude=S.DEFAULT_EXCLUDES,
    follow_links: bool = False,
    hashing: bool = True,
    rehash: bool = False,
    max_hash_bytes: int = 0,
    prune: bool = False,
    limit: int | None = None,
    csv: str | None = None,
    corpus_policy: str = "preserve",
    no_hash_policy: str = "keep",
    hint_scope: str = "path",
    run_id: str | None = None,
    now: datetime | None = None,
    listing_budget: int = 20_000,
    task_bytes: int = content.TASK_BYTES,
    wave_bytes: int = WAVE_BYTES,
    log=print,
) -> dict:
    """Bring the catalog up to date with the files below ``roots``; returns the result record.

    Rows of files not met are flagged, or deleted with ``prune``; a ``limit``
    turns both off. Pruning is also refused when folders could not be listed,
    since their files would all look gone. Hashes are journaled in waves of about
    ``wave_bytes``; those of a scan that died are taken over where size and mtime are
    the same, unless ``rehash`` asks for every content to be read.
    """
    began = time.monotonic()
    now = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    run_id = run_id or new_run_id(now)
    scanned = tree.resolve_roots(roots, warn=log)
    store = Catalog(spark, catalog)
    # Unique, since catalogs that share the staging folder may run at the same time.
    name = f"scan-{run_id}-{uuid.uuid4().hex[:8]}"
    staging = staging_dir(spark, name, fallback=f"{store.folder}/staging")

    found = tree.census(
        spark, scanned, f"{staging}/census", exclude, follow_links, listing_budget
    )
    unlisted = found.unlisted_count
    if unlisted:
        log(f"{unlisted} folders could not be listed; see {staging}/census")
    if prune and unlisted:
        log("prune is refused: files of unlisted folders would look deleted")
    elif prune and limit is not None:
        log("prune is ignored: a limit makes the scan partial")
    run = merge.Run(
        run_id=run_id, now=now, roots=tuple(scanned), hashing=hashing, rehash=rehash,
        hash_cap=max_hash_bytes, prune=prune and not unlisted and limit is None,
        partial=limit is not None, corpus_policy=corpus_policy,
        no_hash_policy=no_hash_policy, hint_scope=hint_scope,
    )

    entries = found.entries
    if limit is not None:
        entries = visits.first_visits(entries, limit)
    listing = visits.one_row_per_path(entries, visits.roots_overlap(scanned))
    last = store.latest()
    last_id = last["last_id"] if last else 0
    seq = (last["seq"] if last else 0) + 1
    journal = Journal(spark, store.folder, seq)
    plan = merge.planned(merge.matched(listing, store.prior()), run)
    if hashing and not rehash and (known := journal.known()) is not None:
        plan = resumed(plan, known)
    plan = written(plan, f"{staging}/plan")
    require_unique_paths(plan)
    todo = merge.work_counts(plan).first()
    if todo["without_id"]:
        new = ids.numbered(plan.where("id IS NULL"), F.lit(last_id))
        plan = plan.where("id IS NOT NULL").unionByName(written(new, f"{staging}/new"))
    hashed = _with_hashes(plan, todo, journal, name, staging, task_bytes, wave_bytes)
    files = merge.merged(hashed, run)
    buckets = buckets_for(spark, todo["rows"], (last["buckets"] if last else 0) or 0)
    store.write_snapshot(files, run_id, buckets)

    counters = merge.run_counters(store.snapshot(run_id, marks=True), run).first().asDict()
    store.commit({
        "run_id": run_id, "started_at": now, "finished_at": datetime.now(timezone.utc),
        "roots": scanned, **counters, "seq": seq, "buckets": buckets, "staging": staging,
        "last_id": last_id + todo["without_id"],
    })

    current = store.snapshot(run_id)
    record = summary_record(current) | {
        "run_id": run_id,
        "missing": todo["missing"],
        "newly_missing": todo["newly_missing"],
        "pruned": todo["missing"] if run.prune else 0,
        "files_hashed_this_run": counters["files_hashed"],
        "hashes_resumed": todo["resumed"],
        "files_seen": counters["files_seen"],
        "errors": counters["errors"],
        "unlisted_folders": unlisted,
    }
    if csv:
        record["csv_rows"] = export_csv(current, csv)
        record["csv_path"] = csv
    record["elapsed_sec"] = round(time.monotonic() - began, 1)
    return record
