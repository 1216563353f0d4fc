"""The catalog on storage: one Parquet snapshot per run, and a ledger of runs.

A run writes its snapshot to a folder of its own and then appends one row to the
ledger. That append is the commit: readers take the snapshot the ledger names
last, so a run that dies earlier leaves the catalog as it was.

Snapshots are bucketed by path, so that the next scan joins them where they lie: only its
listing is shuffled. Tables of the session that say so exist for a moment, under names of
their own; what lasts are the files and the number of buckets in the ledger.
"""

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schema as S
from shelfmark.operators import duplicates
from shelfmark.sources import folders


#: A bucket is joined by one task.
ROWS_PER_BUCKET = 1_000_000
BUCKETED_BY = ["path_hash", "path"]


def buckets_for(spark: SparkSession, rows: int, before: int = 0) -> int:
    """At least as many as a shuffle has partitions, since Spark would shuffle fewer; never less than before."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), before, -(-rows // ROWS_PER_BUCKET))


def with_files_schema(stored: DataFrame) -> DataFrame:
    """Catalog columns of a stored snapshot; columns an older version lacks are NULL."""
    return stored.selectExpr(*[
        f"CAST({f.name if f.name in stored.columns else 'NULL'} AS {f.dataType.simpleString()})"
        f" AS {f.name}"
        for f in S.FILES
    ])


def require_unique_paths(files: DataFrame) -> None:
    """Raise unless ``path`` is a key: the merge join rests on it, and would multiply rows.

    Counts are added up before the shuffle; the driver sees one path at most.
    """
    twice = files.groupBy("path").agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"path is in {twice[0]['n']} rows: {twice[0]['path']!r}")


class Catalog:
    """Snapshots and ledger below one folder that every executor can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _ledger(self) -> DataFrame:
        place = f"{self.folder}/runs/*"  # a folder per commit; files of older catalogs
        try:
            return self.spark.read.schema(S.RUNS).parquet(place)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], S.RUNS)

    def runs(self) -> DataFrame:
        return self._ledger().select(*S.RUN_COLUMNS)

    def latest(self):
        """Ledger row of the last committed run, or None.

        Of two rows with one number, which older catalogs may hold, the run that finished
        first counts, so readers always agree and go on.
        """
        order = F.desc("seq"), F.asc_nulls_last("finished_at"), F.asc("run_id")
        last = self._ledger().orderBy(*order).limit(1).collect()
        return last[0] if last else None

    def snapshot_path(self, run_id: str) -> str:
        return f"{self.folder}/files/{run_id}"

    def snapshot(self, run_id: str | None, marks: bool = False) -> DataFrame:
        """A run's snapshot, committed or not; without run, an empty one.

        ``marks`` adds what the scan noted about each row.
        """
        if run_id is None:
            return self.spark.createDataFrame([], S.FILES)
        # A given schema reads columns that an older snapshot lacks as NULL.
        wanted = S.FILES.fields + (S.SCAN_MARKS.fields if marks else [])
        return self.spark.read.schema(T.StructType(wanted)).parquet(self.snapshot_path(run_id))

    def files(self) -> DataFrame:
        """The current snapshot."""
        last = self.latest()
        return self.snapshot(last["run_id"] if last else None)

    def rows(self) -> DataFrame:
        """The current snapshot in path order."""
        return self.files().orderBy("path")

    def prior(self) -> DataFrame:
        """The current snapshot as the next scan joins it: with ``path_hash``, bucketed by it and
        the path, unless an older version wrote it."""
        last = self.latest()
        if not last or not last["buckets"]:
            return self.snapshot(last["run_id"] if last else None)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.FILES)
        place = self.snapshot_path(last["run_id"]).replace("'", "\\'")
        name = f"shelfmark_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, path_hash bigint) USING parquet OPTIONS (path '{place}')"
            f" CLUSTERED BY ({', '.join(BUCKETED_BY)}) INTO {last['buckets']} BUCKETS"
        )
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def write_snapshot(self, files: DataFrame, run_id: str, buckets: int = 0) -> int:
        """Write once, a file per bucket; returns the number of buckets for the ledger."""
        buckets = buckets or buckets_for(self.spark, 0)
        name = f"shelfmark_{uuid.uuid4().hex}"
        spread = files.withColumn("path_hash", F.xxhash64("path")).repartition(buckets, *BUCKETED_BY)
        target = self.snapshot_path(run_id)
        try:
            spread.write.mode("errorifexists").bucketBy(buckets, *BUCKETED_BY).option(
                "path", target
            ).saveAsTable(name)
        except AnalysisException as problem:
            if "non-empty directory" not in str(problem):
                raise
            raise FileExistsError(f"snapshot already exists: {target}") from problem
        self.spark.sql(f"DROP TABLE {name}")
        return buckets

    def commit(self, run: dict) -> None:
        """Write one ledger row; the run is the current one from then on.

        Each number has a folder that only one writer can make: a run that overlapped with
        another fails here, and the catalog stays as the other left it.
        """
        values = run | {"schema_version": S.SCHEMA_VERSION}
        row = self.spark.range(1).coalesce(1).select(*[
            F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in S.RUNS
        ])
        place = f"{self.folder}/runs/{values['seq']:012d}"
        try:
            row.write.mode("errorifexists").parquet(place)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            # A folder without a row is what a writer left that died while committing.
            if not self._ledger().where(F.col("seq") == values["seq"]).count():
                row.write.mode("append").parquet(place)
        current = self.latest()
        if current["run_id"] != values["run_id"]:
            raise RuntimeError(f"run {current['run_id']} committed first; {values['run_id']} does not count")

    def adopt(self, stored: DataFrame, run_id: str) -> None:
        """Take over an existing files table, of this or an older schema, as a snapshot."""
        last = self.latest()
        files = with_files_schema(stored)
        buckets = buckets_for(self.spark, files.count(), (last["buckets"] if last else 0) or 0)
        self.write_snapshot(files, run_id, buckets)
        require_unique_paths(self.snapshot(run_id))
        top = self.snapshot(run_id).agg(F.max("id")).first()[0] or 0
        now = datetime.now(timezone.utc)
        self.commit({
            "run_id": run_id, "started_at": now, "finished_at": now, "note": "adopted",
            "seq": (last["seq"] if last else 0) + 1, "last_id": top, "buckets": buckets,
        })

    def expire(self, keep: int) -> list[str]:
        """Remove what no reader of the last ``keep`` runs needs; returns the runs that lost theirs.

        That is the snapshots and staging folders of committed runs before these, and hash waves
        towards commits that happened. The ledger keeps every row. Folders of runs that did not
        commit stay: they may be of one that is at work.
        """
        if keep < 1:
            raise ValueError(f"keep: {keep}")
        rows = self._ledger().select("seq", "run_id", "staging").collect()  # one row per run
        current = self.latest()
        order = sorted({r["seq"] for r in rows}, reverse=True)
        kept = {r["run_id"] for r in rows if r["seq"] in order[:keep]}
        there = set(folders.names_in(self.spark, f"{self.folder}/files"))
        gone = []
        for row in sorted(rows, key=lambda r: r["seq"]):
            if row["run_id"] in kept:
                continue
            if row["staging"]:
                folders.remove(self.spark, row["staging"])
            if row["run_id"] in there and folders.remove(self.spark, self.snapshot_path(row["run_id"])):
                gone.append(row["run_id"])
        for wave in folders.names_in(self.spark, f"{self.folder}/hashes"):
            if current and int(wave) <= current["seq"]:
                folders.remove(self.spark, f"{self.folder}/hashes/{wave}")
        return gone

    def create_views(self) -> None:
        """Temporary views ``files``, ``runs``, ``duplicate_groups`` (one row per hash) and
        ``duplicate_members`` (one row per file in a group) for SQL."""
        files = self.files()
        files.createOrReplaceTempView("files")
        self.runs().createOrReplaceTempView("runs")
        duplicates.group_sizes(files).createOrReplaceTempView("duplicate_groups")
        duplicates.members(files).createOrReplaceTempView("duplicate_members")


def iso_utc(ts: str) -> str:
    """ISO-8601 text in UTC at second precision, whatever the session's time zone."""
    utc = f"to_utc_timestamp({ts}, current_timezone())"
    return f"concat(date_format({utc}, \"yyyy-MM-dd'T'HH:mm:ss\"), '+00:00')"


def decimal_text(number: str) -> str:
    """A double as shortest plain decimal text (1733000000.5), never with an exponent."""
    exact = f"string(CAST(string({number}) AS decimal(38, 12)))"
    return f"regexp_replace(regexp_replace({exact}, '0+$', ''), '[.]$', '.0')"


def csv_fields(files: DataFrame) -> DataFrame:
    """Catalog columns as the text a CSV export holds."""
    shown = {"mtime": decimal_text("mtime")}
    shown |= {c: iso_utc(c) for c in ("first_seen", "last_seen", "missing_since")}
    return files.selectExpr(*[f"{shown.get(c, f'string({c})')} AS {c}" for c in S.FILE_COLUMNS])


def export_csv(files: DataFrame, target: str) -> int:
    """Write CSV part files in path order, each with a header; returns the row count.

    NULL and empty text are both empty fields; quotes inside fields are doubled.
    """
    (
        csv_fields(files).orderBy("path").write.mode("overwrite")
        .options(
            header=True, nullValue="", emptyValue="", quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        .csv(target)
    )
    return files.count()
