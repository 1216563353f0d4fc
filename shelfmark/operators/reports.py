"""Reports over a catalog snapshot, all of them plain aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import schema as S
from shelfmark.operators import duplicates


def present(files: DataFrame) -> DataFrame:
    return files.where("missing_since IS NULL")


def eligible_files(files: DataFrame) -> DataFrame:
    return files.where("rag_eligible = 1")


def count_by(files: DataFrame, column: str) -> DataFrame:
    return files.groupBy(column).agg(F.count("*").alias("n"))


def long_form(row: DataFrame) -> DataFrame:
    """A row of figures as rows (metric, key, value) with an empty key."""
    figures = ", ".join(f"'{c}', '', bigint({c})" for c in row.columns)
    return row.selectExpr(f"stack({len(row.columns)}, {figures}) AS (metric, key, value)")


def summary(files: DataFrame, present_only: bool = False) -> DataFrame:
    """(metric, key, value): totals, counts by category and by hint, duplicates.

    The catalog is reduced once to the few combinations of category, hint and
    eligibility, and every figure but the duplicates is a sum over those rows.
    Missing files count unless ``present_only``.
    """
    if present_only:
        files = present(files)
    cells = files.groupBy("category", "corpus_hint", "rag_eligible").agg(
        F.count("*").alias("n"), F.sum("size_bytes").alias("bytes")
    )
    from_cells = cells.selectExpr("""stack(5,
        'total_files', '', n,
        'rag_eligible', '', IF(rag_eligible = 1, n, 0L),
        'total_bytes', '', bytes,
        'by_category', category, n,
        'by_corpus_hint', corpus_hint, n) AS (metric, key, value)""")
    # Totals of an empty catalog are zero, not absent.
    zeros = files.sparkSession.sql("""
        VALUES ('total_files', '', 0L), ('rag_eligible', '', 0L), ('total_bytes', '', 0L)
        AS t(metric, key, value)""")
    return (
        from_cells.unionByName(zeros)
        .groupBy("metric", "key")
        .agg(F.expr("coalesce(sum(value), 0L) AS value"))
        .unionByName(long_form(duplicates.totals(files)))
    )


def folder_callout(files: DataFrame, folders=S.CALLOUT_FOLDERS) -> DataFrame:
    """Files and bytes in the named top folders."""
    return (
        files.where(F.col("top_folder").isin(*folders))
        .groupBy("top_folder")
        .agg(F.count("*").alias("files"), F.expr("coalesce(sum(size_bytes), 0L) AS bytes"))
    )
