"""Files that are probably the same book: nearly the same name, about the same size.

Names of files are reduced to one row per name, corpus and size band, so the many files of one
name are never compared. Names meet by deletion neighbourhoods: two names within an edit
distance of k have a text in common that lacks at most k characters of each. So each name is
posted under all its texts with up to k characters left out, and equal postings meet; a
posting can only be shared by names that differ in k characters, however many files there are.
Numbers in a name tell volumes apart and must agree.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.components import components
from shelfmark.operators.curation import LIVE
from shelfmark.sources.staging import staging_dir, written

EDITS = 1
#: Shorter names differ too easily.
LETTERS = 5


def nodes(files: DataFrame) -> DataFrame:
    """One row per (shelf, name, band) of titled, eligible files that are there and no copies:
    node (the first path), digits, files. A band is a power of two of bytes."""
    named = files.where(LIVE).selectExpr(
        "shelf", "trim(concat(author_key, ' ', title_key)) AS name",
        "length(bin(coalesce(size_bytes, 0L))) AS band", "path",
    )
    return named.groupBy("shelf", "name", "band").agg(
        F.min("path").alias("node"), F.count("*").alias("files")
    ).withColumn("digits", F.expr("array_join(regexp_extract_all(name, '[0-9]+', 0), ' ')"))


def _shortened(postings: DataFrame) -> DataFrame:
    """All texts with one character less."""
    at = postings.where("length(left_over) > 0").select(
        "*", F.explode(F.expr("sequence(1, length(left_over))")).alias("at")
    )
    return at.selectExpr("node", "concat(left(left_over, at - 1), substr(left_over, at + 1)) AS left_over")


def links(found: DataFrame, edits: int = EDITS) -> DataFrame:
    """(a, b) of nodes of one corpus in the same band or the next, with the same numbers, and
    names within ``edits``; each pair once."""
    own = found.selectExpr("node", "name AS left_over")
    postings, last = own, own
    for _ in range(edits):
        last = _shortened(last).distinct()
        postings = postings.unionByName(last)
    posted = postings.distinct().join(
        found.select("node", "shelf", "name", "band", "digits"), "node"
    ).withColumn("key", F.xxhash64("shelf", "digits", "left_over"))
    a = posted.selectExpr("key", "node AS a", "shelf AS shelf_a", "name AS name_a", "band AS band_a", "digits AS digits_a")
    b = posted.selectExpr("key", "node AS b", "shelf AS shelf_b", "name AS name_b", "band AS band_b", "digits AS digits_b")
    return a.join(b, "key").where(
        f"""a < b AND shelf_a = shelf_b AND digits_a = digits_b AND abs(band_a - band_b) <= 1
        AND (name_a = name_b OR (least(length(name_a), length(name_b)) >= {LETTERS}
             AND levenshtein(name_a, name_b, {edits}) >= 0))"""
    ).select("a", "b").distinct()


def near_duplicates(files: DataFrame, name: str, edits: int = EDITS) -> DataFrame:
    """(path, keeper, files, links) of files that resemble another one, for review.

    ``files`` are titled and have keepers. Files of one node are alike, and so are linked nodes
    and what these are linked to; keeper is the first path of the whole group, files its size,
    links the number of nodes linked to the file's own.
    """
    spark = files.sparkSession
    found = written(nodes(files), staging_dir(spark, f"{name}/nodes"))
    pairs = written(links(found, edits), staging_dir(spark, f"{name}/links"))
    roots = components(pairs, name)
    both = pairs.select("a").union(pairs.select("b")).groupBy("a").agg(F.count("*").alias("links"))
    grouped = found.join(roots, found["node"] == roots["node"], "left").select(
        found["*"], F.coalesce(roots["root"], found["node"]).alias("keeper")
    ).join(both.withColumnRenamed("a", "node"), "node", "left")
    sizes = grouped.groupBy("keeper").agg(F.sum("files").alias("in_group")).where("in_group > 1")
    members = grouped.join(sizes, "keeper").selectExpr(
        "shelf", "name", "band", "keeper", "in_group AS files", "coalesce(links, 0L) AS links"
    )
    named = files.where(LIVE).selectExpr(
        "shelf", "trim(concat(author_key, ' ', title_key)) AS name",
        "length(bin(coalesce(size_bytes, 0L))) AS band", "path",
    )
    # a node may have any number of files: AQE splits it
    return named.join(members.hint("rebalance"), ["shelf", "name", "band"]).select(
        "path", "keeper", "files", "links"
    )
