"""Moves that depend on each other: a file may go where another one lies that goes away itself.

Each move points to the move of the file at its target. No target is claimed twice (those are
conflicts), so moves form chains and rings. A chain can go if nothing lies at its last target, and
goes from its end; a ring goes after one of its files was put aside under a name of its own.
Chains and rings are found as connected components, and steps are counted by pointer doubling, so
a chain of n moves takes log n joins; no chain is ever gathered.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.components import components
from shelfmark.sources.staging import staging_dir, written

#: Where the first file of a ring waits. The hash is of its whole path, so that no file has the name.
ASIDE = "concat(path, '.aside-', sha2(path, 256))"


def _steps(pointers: DataFrame, staged) -> DataFrame:
    """(path, step): how many moves come before that of ``path``, from (path, ahead), where ``ahead``
    is the move right before it, or null. There must be no ring."""
    state = staged(pointers.selectExpr("path", "ahead", "if(ahead IS NULL, 0L, 1L) AS step"), "steps-0")
    turn = 0
    while not state.where("ahead IS NOT NULL").isEmpty():
        turn += 1
        far = state.selectExpr("path AS ahead", "ahead AS further", "step AS more")
        state = staged(state.join(far, "ahead", "left").selectExpr(
            "path", "further AS ahead", "step + coalesce(more, 0L) AS step"
        ), f"steps-{turn}")
    return state.select("path", "step")


def ordered(wanted: DataFrame, present: DataFrame, name: str) -> DataFrame:
    """(path, src, dst, step, last_step, action) of what has to be done, in order of ``step``.

    ``wanted`` (path, target; a path once) says where files shall lie, ``present`` (path) where any
    lie now, wanted or not. Rows without path or target, and paths where nothing lies, take no part.
    Moves of one step do not depend on each other, and need only those of earlier steps whose
    last_step is the same chain's. Action is ``move``, ``aside`` and ``back`` for the file of a ring
    that makes place first (the smallest path), ``stay``, ``claimed`` if another file wants the same
    target, or ``occupied`` if the file there, or one further along, does not go away; the last three
    have src and no dst or step. Tables are below ``name`` in the staging folder.
    """
    spark = wanted.sparkSession

    def staged(df, step):
        return written(df, staging_dir(spark, f"{name}/{step}"))

    there = present.select("path").where("path IS NOT NULL").distinct()
    rows = wanted.select("path", "target").where("target IS NOT NULL").join(there, "path", "left_semi")
    # a file that stays claims its place as any other
    claims = rows.groupBy("target").agg(F.count("*").alias("claims"))
    told = rows.join(claims.hint("rebalance"), "target").selectExpr(
        "path", "target", "CASE WHEN path = target THEN 'stay' WHEN claims > 1 THEN 'claimed' ELSE 'move' END AS action"
    )
    told = staged(told, "told")
    going = told.where("action = 'move'").select("path", "target")
    # what lies at the target, and whether it goes
    occupied = there.withColumnRenamed("path", "target").withColumn("taken", F.lit(True))
    leaving = going.select(F.col("path").alias("target"), F.lit(True).alias("leaves"))
    moves = staged(going.join(occupied, "target", "left").join(leaving, "target", "left").selectExpr(
        "path", "target", "coalesce(leaves, false) AS waits", "taken IS NOT NULL AND leaves IS NULL AS blocked"
    ), "moves")

    links = moves.where("waits").selectExpr("path AS a", "target AS b")
    roots = components(links, f"{name}/chains").selectExpr("node AS path", "root")
    chained = moves.join(roots, "path", "left").withColumn("root", F.expr("coalesce(root, path)"))
    chains = chained.groupBy("root").agg(
        F.expr("bool_and(waits)").alias("ring"), F.expr("bool_or(blocked)").alias("stuck"),
        F.count("*").alias("length"),
    )
    judged = staged(chained.join(chains.hint("rebalance"), "root"), "judged")
    free = judged.where("NOT stuck").withColumn("first", F.expr("ring AND path = root"))
    steps = _steps(free.selectExpr("path", "if(waits AND NOT first, target, NULL) AS ahead"), staged)
    parts = "array(struct(path AS src, target AS dst, step, 'move' AS action))"
    around = f"""array(struct(path AS src, {ASIDE} AS dst, step, 'aside' AS action),
                      struct({ASIDE} AS src, target AS dst, length AS step, 'back' AS action))"""
    done = free.join(steps, "path").selectExpr(
        "path", "if(ring, length, length - 1) AS last_step", f"inline(if(first, {around}, {parts}))"
    )
    stuck = judged.where("stuck").selectExpr("path", "'occupied' AS action")
    stays = told.where("action <> 'move'").select("path", "action").union(stuck)
    return done.select("path", "src", "dst", "step", "last_step", "action").union(stays.selectExpr(
        "path", "path AS src", "string(NULL) AS dst", "bigint(NULL) AS step", "bigint(NULL) AS last_step", "action"
    ))


def inverse(steps: DataFrame) -> DataFrame:
    """What takes the moves of ``ordered`` back: from the last step to the first. ``path`` is where
    the file lies meanwhile."""
    done = steps.where("dst IS NOT NULL")
    ends = done.where("action <> 'aside'").selectExpr("path", "dst AS lies")
    swapped = "CASE action WHEN 'aside' THEN 'back' WHEN 'back' THEN 'aside' ELSE action END AS action"
    return done.join(ends, "path").selectExpr(
        "lies AS path", "dst AS src", "src AS dst", "last_step - step AS step", "last_step", swapped
    )


def net(steps: DataFrame) -> DataFrame:
    """(src, dst) of files that lie elsewhere in the end."""
    return steps.where("action IN ('move', 'back')").selectExpr("path AS src", "dst")
