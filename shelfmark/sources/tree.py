"""Census of storage trees: every file below the given roots, listed by tasks.

A tree cannot be split before it is known, and one folder may hold a third of
it. So the scan goes in rounds. Each round is one Spark job over work items, a
work item being a folder to list or a single file to look up. A task lists its
folders breadth first until its entry budget is spent; what it has not reached
(folders, and the files of a folder too big for one task) becomes work items,
which the next round spreads over the cluster. Rounds end when none are left.
Nothing is dropped by the budget, and a small tree takes one round.

Every round is a written table, so a lost executor only repeats its own tasks,
and a later round never lists again what an earlier one has.
"""

import fnmatch
import os
import re
from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schema as S

ENTRY, FOLDER, FILE, UNLISTED = "entry", "folder", "file", "unlisted"

# ``place`` is the raw path: names need not be valid UTF-8.
ROUND = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("place", T.BinaryType())]
    + S.ENTRIES.fields
)
WORK = ["kind", "place", "root_ordinal", "root"]


@dataclass(frozen=True)
class Census:
    """``entries`` are the files; ``unlisted`` the folders that could not be read."""

    entries: DataFrame
    unlisted: DataFrame
    unlisted_count: int
    rounds: int


def resolve_roots(roots, warn=print) -> list[str]:
    """Absolute roots with links resolved; absent ones are reported and left out."""
    found = []
    for root in roots:
        place = os.path.expanduser(root)
        if os.path.exists(place):
            found.append(os.path.realpath(place))
        else:
            warn(f"root does not exist, skipping: {place}")
    if not found:
        raise ValueError("none of the given roots exists")
    return found


def _lister(exclude, follow_links: bool, budget: int, batch_rows: int = 4096):
    """The function a scanning task runs; self-contained, so executors need no package."""
    excluded = re.compile("|".join(fnmatch.translate(g) for g in exclude) or r"(?!)").match
    names = ROUND.fieldNames()
    arrow = pa.schema([
        ("kind", pa.string()), ("place", pa.binary()), ("root_ordinal", pa.int32()),
        ("root", pa.string()), ("path", pa.string()), ("size_bytes", pa.int64()),
        ("mtime", pa.float64()), ("error", pa.string()),
    ])
    entry, folder, file, unlisted = ENTRY, FOLDER, FILE, UNLISTED

    def shown(place: bytes) -> str:
        try:
            return place.decode("utf-8")
        except UnicodeDecodeError:
            # no two names look alike: backslashes are doubled, and a NUL, which no name
            # holds, sets escaped names apart from others
            return place.replace(b"\\", b"\\\\").decode("utf-8", "backslashreplace") + "\0"

    def looked_up(place: bytes, ordinal, root):
        size = mtime = error = None
        try:
            found = os.stat(place)
            size, mtime = found.st_size, found.st_mtime
        except OSError as problem:
            error = f"stat: {problem}"
        try:
            place.decode("utf-8")
        except UnicodeDecodeError:
            error = error or "stat: name is not valid UTF-8"
        return (entry, None, ordinal, root, shown(place), size, mtime, error)

    def listed(place: bytes, ordinal, root, room):
        """Rows and subfolders of one folder; beyond ``room`` files wait for a lookup."""
        try:
            with os.scandir(place) as found:
                for item in found:
                    if excluded(os.fsdecode(item.name)):
                        continue
                    try:
                        is_folder = item.is_dir()
                    except OSError:
                        is_folder = False
                    if is_folder:
                        if follow_links or not item.is_symlink():
                            yield (folder, item.path, ordinal, root) + (None,) * 4
                    elif room > 0:
                        room -= 1
                        yield looked_up(item.path, ordinal, root)
                    else:
                        yield (file, item.path, ordinal, root) + (None,) * 4
        except OSError as problem:
            yield (unlisted, None, ordinal, root, shown(place), None, None, f"list: {problem}")

    def rows(batches):
        spent = 0
        for batch in batches:
            todo = deque()
            for item in batch.to_pylist():
                if item["kind"] == file:
                    yield looked_up(item["place"], item["root_ordinal"], item["root"])
                else:
                    todo.append((item["place"], item["root_ordinal"], item["root"]))
            must_list = len(todo)
            while todo:
                place, ordinal, root = todo.popleft()
                if must_list <= 0 and spent >= budget:
                    yield (folder, place, ordinal, root) + (None,) * 4
                    continue
                must_list -= 1
                for row in listed(place, ordinal, root, max(budget - spent, 1)):
                    spent += 1
                    if row[0] == folder and spent < budget:
                        todo.append(row[1:4])
                    else:
                        yield row

    def run(batches):
        full = []
        for row in rows(batches):
            full.append(row)
            if len(full) == batch_rows:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in full], arrow)
                full = []
        if full:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in full], arrow)

    return run


def census(
    spark: SparkSession,
    roots: list[str],
    staging: str,
    exclude=S.DEFAULT_EXCLUDES,
    follow_links: bool = False,
    budget: int = 20_000,
    items_per_task: int = 16,
) -> Census:
    """Scan resolved ``roots`` (see ``resolve_roots``); rounds are kept under ``staging``.

    Links to files are files. Links to folders are neither rows nor entered
    unless ``follow_links``. Excluded folders are not entered.
    """
    width = 4 * spark.sparkContext.defaultParallelism
    first = [(FOLDER, bytearray(os.fsencode(r)), i, r) for i, r in enumerate(roots)]
    work = spark.createDataFrame(first, T.StructType([ROUND[c] for c in WORK]))
    waiting, unlisted, done = len(first), 0, 0
    while waiting:
        tasks = min(width, -(-waiting // items_per_task)) if done else waiting
        # The first round has few tasks, so it stops early to let others share the work.
        run = _lister(list(exclude), follow_links, budget if done else max(budget // 4, 1))
        target = f"{staging}/round={done}"
        (
            work.repartition(tasks, "place")
            .mapInArrow(run, ROUND)
            .write.mode("overwrite").partitionBy("kind").parquet(target)
        )
        done += 1
        written = spark.read.schema(ROUND).parquet(target)
        counts = dict(written.groupBy("kind").count().collect())
        waiting = counts.get(FOLDER, 0) + counts.get(FILE, 0)
        unlisted += counts.get(UNLISTED, 0)
        work = written.where(F.col("kind").isin(FOLDER, FILE)).select(*WORK)
    everything = spark.read.schema(ROUND).option("basePath", staging).parquet(
        *[f"{staging}/round={i}" for i in range(done)]
    )
    return Census(
        everything.where(F.col("kind") == ENTRY).select(*S.ENTRIES.fieldNames()),
        everything.where(F.col("kind") == UNLISTED).select("root", "path", "error"),
        unlisted,
        done,
    )
