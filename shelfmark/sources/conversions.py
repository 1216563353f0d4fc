"""What became of conversions: an append-only log of outcomes, the last of which counts.

Each batch is a folder that is written once. A content's state is its latest outcome over all
batches, so a batch that repeats what others say changes nothing. That is all compaction does:
it writes the states as one more batch, and only then removes those it read. A job that dies
anywhere in between leaves states as they were.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import curation
from shelfmark.sources import folders

ROWS = "content string, at timestamp, attempts long, status string, error string, run_id string"
CONVERTED, FAILED = "converted", "failed"
#: Of outcomes at one time the one with more attempts counts, then a success.
_ORDER = "struct(at, attempts, status = 'converted' AS good, status, error, run_id)"


def _content(files: DataFrame) -> DataFrame:
    """Outcomes belong to contents, so a copy or a moved file is not converted again; a file
    without a hash stands for itself."""
    return files.withColumn("content", F.expr("coalesce(sha256, path)"))


class ConversionLog:
    """The log below one folder that every executor can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.place = f"{folder.rstrip('/')}/conversions"

    def _rows(self, batches: list[str] | None = None) -> DataFrame:
        try:
            return self.spark.read.schema(ROWS).parquet(*[
                f"{self.place}/{b}" for b in (["*"] if batches is None else batches)
            ])
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ROWS)

    def _write(self, rows: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex}"
        rows.write.mode("errorifexists").parquet(f"{self.place}/{name}")
        return name

    def append(self, outcomes: DataFrame, run_id: str) -> str:
        """Add a batch of (path, sha256, status, error, at); returns its name.

        Status is converted or failed, anything else an error. A content in several rows is one
        outcome, the latest, after as many attempts as there are rows. A hot content is counted
        before it is shuffled. Rows without path and hash, or without a time, are an error too.
        """
        checked = _content(outcomes).withColumn("status", F.expr(
            f"""if(status IN ('{CONVERTED}', '{FAILED}') AND content IS NOT NULL AND at IS NOT NULL, status,
                raise_error(concat('not an outcome: ', coalesce(status, 'NULL'), ' of ', coalesce(path, 'NULL'))))"""
        ))
        last = checked.groupBy("content").agg(
            F.max(F.expr(f"struct(at, status = '{CONVERTED}' AS good, status, error)")).alias("o"),
            F.count("*").alias("tries"),
        )
        before = self.states().selectExpr("content", "attempts AS before")
        return self._write(last.join(before, "content", "left").selectExpr(
            "content", "o.at", "tries + coalesce(before, 0L) AS attempts", "o.status",
            f"if(o.status = '{FAILED}', o.error, NULL) AS error", f"'{run_id}' AS run_id",
        ), "batch")

    def _states(self, batches: list[str] | None) -> DataFrame:
        last = self._rows(batches).groupBy("content").agg(F.max(F.expr(_ORDER)).alias("o"))
        return last.select("content", "o.at", "o.attempts", "o.status", "o.error", "o.run_id")

    def states(self) -> DataFrame:
        """One row per content that was ever tried: its latest outcome and all attempts."""
        return self._states(None)

    def compact(self) -> int:
        """Bring all batches there are now into one; returns how many there were.

        Batches that are added meanwhile stay. A reader that has listed a batch before it was
        removed fails, and finds the same states when it starts again.
        """
        found = folders.names_in(self.spark, self.place)
        # not those that a batch is being written to, or was when its job died
        batches = [b for b in found if folders.is_complete(self.spark, f"{self.place}/{b}")]
        if len(batches) > 1:
            self._write(self._states(batches), "states")
            for batch in batches:
                folders.remove(self.spark, f"{self.place}/{batch}")
        return len(batches)

    def converted(self) -> DataFrame:
        """(sha256) of converted contents, as ``curation.to_convert`` takes them."""
        return self.states().where(f"status = '{CONVERTED}'").selectExpr("content AS sha256")


def status(files: DataFrame, states: DataFrame, library: str) -> DataFrame:
    """(path, sha256, fmt, status, attempts, error, target) of decided files to be converted.

    These are kept, eligible and no EPUB. A file that was never tried is ``pending``. ``target`` is
    where a converted content's EPUB lies: below ``library`` under the content's own name, so no
    source is ever overwritten.
    """
    wanted = _content(files.where(f"{curation.LIVE} AND decision = 'keep' AND fmt <> 'epub'"))
    known = states.selectExpr("content", "status", "attempts", "error")
    return wanted.select("path", "sha256", "fmt", "content").join(
        known.hint("rebalance"), "content", "left"
    ).selectExpr(
        "path", "sha256", "fmt", "coalesce(status, 'pending') AS status",
        "coalesce(attempts, 0L) AS attempts", "error",
        f"""if(status = '{CONVERTED}', concat('{library}/_converted/',
            coalesce(sha256, sha2(path, 256)), '.epub'), NULL) AS target""",
    )


def to_retry(rows: DataFrame, most: int) -> DataFrame:
    """Rows of ``status`` that failed, and not yet ``most`` times."""
    return rows.where(f"status = '{FAILED}' AND attempts < {int(most)}")
