"""One rescan of a catalog as one full outer join of listing and prior snapshot.

``matched`` joins. ``planned`` projects each pair to its next catalog row, with all
that is known before contents are read, and says whether its content must be.
``merged`` adds the hashes. Everything a rescan reports (changes, missing rows,
counters) follows from the planned rows, so a run joins once and stores no column
twice. Paths are unique on both sides, so the join key has no hot values.
"""

import re
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import schema as S
from shelfmark.functions import names

SEEN = "visits IS NOT NULL"
KNOWN = "old_known IS NOT NULL"
# NULL on either side is never the same signature.
SAME_SIGNATURE = "coalesce(size_bytes = old_size_bytes AND mtime = old_mtime, false)"
# What reading a content yields: its hash, or an error text.
HASH_COLUMNS = ("new_sha256", "hash_error")


@dataclass(frozen=True)
class Run:
    """Settings of one scan. ``roots`` are the resolved roots that were scanned.

    ``partial`` marks a scan cut off by a limit: it neither flags nor prunes.
    ``corpus_policy`` is ``preserve`` (an assigned corpus survives a rescan) or
    ``reset``. ``no_hash_policy`` applies when ``hashing`` is off: ``keep`` the
    stored hash of files with unchanged size and mtime, or ``erase`` all.
    """

    run_id: str
    now: datetime
    roots: tuple[str, ...]
    hashing: bool = True
    rehash: bool = False
    hash_cap: int | None = None
    prune: bool = False
    partial: bool = False
    corpus_policy: str = "preserve"
    no_hash_policy: str = "keep"
    hint_scope: str = "path"

    def __post_init__(self):
        # It names a folder, and stands in SQL texts.
        if not re.fullmatch(r"[A-Za-z0-9._-]+", self.run_id):
            raise ValueError(f"run_id: {self.run_id!r}")
        if self.corpus_policy not in ("preserve", "reset"):
            raise ValueError(f"corpus_policy: {self.corpus_policy!r}")
        if self.no_hash_policy not in ("keep", "erase"):
            raise ValueError(f"no_hash_policy: {self.no_hash_policy!r}")

    @property
    def timestamp(self) -> str:
        instant = self.now if self.now.tzinfo else self.now.replace(tzinfo=timezone.utc)
        return f"timestamp_seconds({int(instant.timestamp())})"


def matched(listing: DataFrame, prior: DataFrame) -> DataFrame:
    """Full outer join on path; prior columns carry the prefix ``old_``.

    Columns that follow from the path are derived after the join, so the
    listing side shuffles only path, root, size, mtime and error. Paths share long
    beginnings, which makes them slow to sort; sorting by a hash first decides nearly
    every comparison on one number. A prior snapshot that brings this hash and is bucketed by
    both (see ``store.Catalog.prior``) is not shuffled.
    """
    path_hash = "xxhash64(path) AS path_hash"
    old = prior.selectExpr(
        "path_hash" if "path_hash" in prior.columns else path_hash, "path", "true AS old_known",
        *[f"{c} AS old_{c}" for c in S.FILE_COLUMNS if c != "path"],
    )
    both = listing.selectExpr("*", path_hash).join(old, ["path_hash", "path"], "full_outer")
    return both.drop("path_hash")


def is_stale(run: Run) -> Column:
    """Known rows under a scanned root that this run did not see.

    Roots compare by equality, and a row without run id is never stale.
    """
    if run.partial or not run.roots:
        return F.lit(False)
    stale = (
        F.col("visits").isNull()
        & F.col("old_root").isin(*run.roots)
        & (F.col("old_run_id") != run.run_id)
    )
    return F.coalesce(stale, F.lit(False))


def hash_action(run: Run) -> str:
    """``hash`` (read the content), ``reuse`` (take the stored hash) or ``skip``.

    The stored hash wins over the size cap: a cap set later does not drop it.
    """
    cases = ["WHEN visits IS NULL THEN NULL"]
    if not run.hashing:
        cases.append("WHEN true THEN 'skip'")
    cases.append(f"WHEN error IS NOT NULL OR category = '{S.METADATA_CATEGORY}' THEN 'skip'")
    if not run.rehash:
        cases.append(f"WHEN {SAME_SIGNATURE} AND old_sha256 IS NOT NULL THEN 'reuse'")
    if run.hash_cap and run.hash_cap > 0:
        cases.append(f"WHEN size_bytes > {run.hash_cap} THEN 'skip'")
    return f"CASE {' '.join(cases)} ELSE 'hash' END"


CHANGE = f"""
    CASE WHEN stale THEN 'missing' WHEN visits IS NULL THEN 'carried'
         WHEN old_known IS NULL THEN 'new'
         WHEN size_bytes <=> old_size_bytes AND mtime <=> old_mtime THEN 'unchanged'
         ELSE 'changed' END"""


def planned(rows: DataFrame, run: Run) -> DataFrame:
    """Next catalog rows as far as known without reading contents.

    Beside the catalog columns: ``visits`` (NULL for rows not seen), ``action``,
    ``change``, ``stale``, ``was_missing``, and the columns ``new_sha256`` and
    ``hash_error`` where the listing came with them. Stale rows are still there,
    and rows not known before have no id yet (see ``ids.numbered``).
    """
    kept_hash = "NULL"
    if not run.hashing and run.no_hash_policy == "keep":
        kept_hash = (
            f"IF(error IS NULL AND category <> '{S.METADATA_CATEGORY}' AND {SAME_SIGNATURE},"
            " old_sha256, NULL)"
        )
    kept_corpus = "old_corpus" if run.corpus_policy == "preserve" else "NULL"
    values = {c: f"IF({SEEN}, {c}, old_{c})" for c in S.FILE_COLUMNS if c not in ("id", "path")}
    values |= {
        "id": "old_id",
        "path": "path",
        "sha256": f"""
            CASE WHEN visits IS NULL OR action = 'reuse' THEN old_sha256
                 WHEN action = 'skip' THEN {kept_hash} END""",
        "corpus": f"IF({SEEN}, coalesce({kept_corpus}, '{S.UNASSIGNED}'), old_corpus)",
        "run_id": f"IF({SEEN}, '{run.run_id}', old_run_id)",
        "first_seen": f"IF({KNOWN}, old_first_seen, {run.timestamp})",
        "last_seen": f"IF({SEEN}, {run.timestamp}, old_last_seen)",
        "missing_since": f"""
            CASE WHEN stale THEN coalesce(old_missing_since, {run.timestamp})
                 WHEN visits IS NULL THEN old_missing_since END""",
    }
    decided = names.described(rows.withColumn("stale", is_stale(run)), run.hint_scope).selectExpr(
        "*", f"{hash_action(run)} AS action", f"{CHANGE} AS change"
    )
    return decided.selectExpr(
        *[f"CAST({values[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in S.FILES],
        "visits", "action", "change", "stale", "old_missing_since IS NOT NULL AS was_missing",
        *[c for c in HASH_COLUMNS if c in rows.columns],
    )


def merged(plan: DataFrame, run: Run) -> DataFrame:
    """The next snapshot with scan marks, from a plan with ``HASH_COLUMNS``."""
    if run.prune:
        plan = plan.where("NOT stale")
    values = {
        "sha256": "IF(action = 'hash', new_sha256, sha256)",
        "error": "IF(action = 'hash', hash_error, error)",
    }
    return plan.selectExpr(
        *[f"{values.get(c, c)} AS {c}" for c in S.FILE_COLUMNS],
        "coalesce(visits, 0L) AS visits",
        "coalesce(action = 'hash' AND new_sha256 IS NOT NULL, false) AS hashed_now",
    )


def missing_counts(plan: DataFrame) -> DataFrame:
    """One row: stale rows, and those among them that no earlier run had flagged."""
    return work_counts(plan).select("missing", "newly_missing")


def work_counts(plan: DataFrame) -> DataFrame:
    """One row: all rows, missing counts, rows without id, files whose content must be read, their
    bytes, and files whose hash comes from the journal."""
    return plan.selectExpr(
        "count(*) AS rows",
        "count_if(stale) AS missing",
        "count_if(stale AND NOT was_missing) AS newly_missing",
        "count_if(id IS NULL) AS without_id",
        "count_if(action = 'hash') AS to_hash",
        "coalesce(sum(size_bytes) FILTER (WHERE action = 'hash'), 0L) AS hash_bytes",
        "count_if(action = 'resume') AS resumed",
    )


def run_counters(files: DataFrame, run: Run) -> DataFrame:
    """One row of counters over the rows this run touched (``visits`` > 0).

    A repeated visit finds the hash the first visit stored, so it hashes again
    only under ``rehash``.
    """
    times = "visits" if run.rehash else "1L"
    return files.where("visits > 0").selectExpr(
        "coalesce(sum(visits), 0L) AS files_seen",
        f"coalesce(sum({times}) FILTER (WHERE hashed_now), 0L) AS files_hashed",
        "coalesce(sum(size_bytes * visits), 0L) AS bytes_total",
        "coalesce(sum(visits) FILTER (WHERE error IS NOT NULL), 0L) AS errors",
    )
