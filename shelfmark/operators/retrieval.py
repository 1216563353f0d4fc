"""The nearest passages of each corpus for a set of query vectors.

Vectors are whole numbers (``SCALE`` times the given ones), so products are exact and results
do not depend on how the work is dealt. The index puts every vector into the cell of its
nearest centre; a search looks at the cells whose centres are nearest to a query, or at all
of them, which is the exact scan. A task holds a block of a cell of a corpus (of a corpus, in
the exact scan) and a block of the queries that look there, and gives its best few; these are
ranked by query and corpus.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 10_000
#: Vectors that centres are fitted on, at most: those whose ids come first by a hash.
SAMPLE = 20_000
ROUNDS = 10
#: Vectors and queries of one task.
VECTORS, QUERIES = 20_000, 20_000


def whole(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors`` with ``vector`` in whole numbers; null vectors, and those with a null, go."""
    known = vectors.where(F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull()))
    return known.withColumn(
        vector, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE + 0.5).cast("int"))
    )


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def fit_centres(vectors: DataFrame, cells: int, id: str = "vec_id", vector: str = "embedding") -> np.ndarray:
    """Centres of at most ``cells`` cells, by k-means on at most SAMPLE vectors on the driver."""
    order = [F.xxhash64(id), F.col(id)]
    rows = vectors.select(id, vector).orderBy(*order).limit(SAMPLE).toArrow()
    if not len(rows):
        return np.zeros((0, 0))
    points = _matrix(rows[vector])
    centres = np.unique(points[:cells], axis=0)
    for _ in range(ROUNDS):
        near = _nearest(points, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centres))
        held = counts > 0
        moved = centres.copy()
        moved[held] = np.rint(sums[held] / counts[held, None])
        if (moved == centres).all():
            break
        centres = moved
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each point, nearest first, ties by their order."""
    away = (centres * centres).sum(1) - 2 * points @ centres.T
    return np.argsort(away, axis=1, kind="stable")[:, :n]


def _celled(batches, centres, probes):
    """Rows with a vector in the last column; adds ``cells``, the nearest ones."""
    for batch in batches:
        near = _nearest(_matrix(batch.column(batch.num_columns - 1)), centres, probes)
        cells = pa.array([r.tolist() for r in near], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[*batch.schema.names, "cells"])


def _with_cells(df: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(partial(_celled, centres=centres, probes=probes), f"{kinds}, cells array<int>")


def index(vectors: DataFrame, centres: np.ndarray, id="vec_id", vector="embedding", corpus="corpus") -> DataFrame:
    """(id, corpus, vector, cell) of every vector."""
    named = vectors.select(F.col(id).alias("id"), F.col(corpus).alias("corpus"), F.col(vector).alias("vector"))
    return _with_cells(named, centres, 1).selectExpr("id", "corpus", "vector", "cells[0] AS cell")


def write_index(found: DataFrame, folder: str) -> None:
    """A folder per corpus and cell, so a search reads what it looks at."""
    found.hint("rebalance", "corpus", "cell").write.partitionBy("corpus", "cell").parquet(folder)


def _best(table: pa.Table, k: int) -> pa.Table:
    asked = table["asked"].to_numpy(zero_copy_only=False).astype(bool)
    held, queries = table.filter(pa.array(~asked)), table.filter(pa.array(asked))
    ids, out = held["id"].to_numpy(), []
    if len(held) and len(queries):
        points = _matrix(held["vector"])
        for low in range(0, len(queries), 256):
            part = queries.slice(low, 256)
            scores = _matrix(part["vector"]) @ points.T
            n = min(k, len(points))
            least = np.partition(scores, len(points) - n, axis=1)[:, len(points) - n]
            row, at = np.nonzero(scores >= least[:, None])
            order = np.lexsort((ids[at], -scores[row, at], row))
            row, at = row[order], at[order]
            first = np.searchsorted(row, np.arange(len(part)))
            best = np.arange(len(row)) - first[row] < n  # of ties the smaller ids
            row, at = row[best], at[best]
            out.append((part["id"].to_numpy()[row], ids[at], scores[row, at].astype(np.int64)))
    columns = [np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else [()] * 3)]
    corpus = table["corpus"][0].as_py()
    return pa.table({
        "query_id": columns[0].astype(np.int64), "corpus": pa.array([corpus] * len(columns[0]), pa.string()),
        "id": columns[1].astype(np.int64), "score": columns[2].astype(np.int64),
    })


def search(found: DataFrame, queries: DataFrame, centres: np.ndarray, k: int, probes: int | None = None) -> DataFrame:
    """(query_id, corpus, rank, id, score): the ``k`` best of each corpus for each query.

    ``found`` is an ``index``, ``queries`` (id, vector). ``probes`` cells are looked at, by
    default all: then the result is exact. Score is the product of the whole vectors; ties go
    to smaller ids. A corpus with fewer vectors than ``k`` gives them all.
    """
    probes = min(probes or len(centres), len(centres))
    if not probes:
        return found.where("false").selectExpr("id AS query_id", "corpus", "1 AS rank", "id", "0L AS score")
    if probes == len(centres):
        # all is looked at: cells would only cut the blocks small; one cell, by a key that joins can go by
        one = F.expr("int(pmod(xxhash64(id), 1))")
        found, asked = found.withColumn("cell", one), queries.select("id", "vector", one.alias("cell"))
    else:
        asked = _with_cells(queries.select("id", "vector"), centres, probes).select(
            "id", "vector", F.explode("cells").alias("cell")
        )
    # one row for each cell of a corpus, and one for each cell that is looked at
    held = found.groupBy("corpus", "cell").agg(F.count("*").alias("n")).selectExpr(
        "corpus", "cell", f"int(ceil(n / {VECTORS})) AS parts"
    )
    looked = asked.groupBy("cell").agg(F.count("*").alias("n")).selectExpr(
        "cell", f"int(ceil(n / {QUERIES})) AS turns"
    )
    dealt = held.join(looked, "cell")
    vectors = found.join(dealt, ["corpus", "cell"]).selectExpr(
        "corpus", "cell", "int(pmod(xxhash64(id), parts)) AS part",
        "explode(sequence(0, turns - 1)) AS turn", "false AS asked", "id", "vector",
    )
    visitors = asked.join(dealt, "cell").selectExpr(
        "corpus", "cell", "explode(sequence(0, parts - 1)) AS part",
        "int(pmod(xxhash64(id), turns)) AS turn", "true AS asked", "id", "vector",
    )

    def best(table: pa.Table) -> pa.Table:
        return _best(table, k)

    few = vectors.unionByName(visitors).groupBy("corpus", "cell", "part", "turn").applyInArrow(
        best, "query_id long, corpus string, id long, score long"
    )
    rank = F.row_number().over(
        Window.partitionBy("query_id", "corpus").orderBy(F.desc("score"), F.col("id"))
    )
    return few.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "corpus", "rank", "id", "score"
    )
