"""Nearest vectors: exact against numpy, indexed by recall, small blocks, awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import retrieval


def brute(ids, corpora, points, queries, k):
    out = {}
    for q in queries:
        scores = points @ points[list(ids).index(q)]
        for c in set(corpora):
            own = [i for i in range(len(ids)) if corpora[i] == c]
            best = sorted(own, key=lambda i: (-scores[i], ids[i]))[:k]
            out[q, c] = [(ids[i], int(scores[i])) for i in best]
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(400, 8)).round(2)
    points[50:60] = points[40]  # ties
    corpora = ["hot" if i % 3 else "rare" for i in range(399)] + ["single"]
    rows = [(i, corpora[i], [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(900, "hot", None), (901, "hot", [None] * 8)]
    return spark.createDataFrame(rows, "vec_id long, corpus string, embedding array<float>").repartition(5)


@pytest.mark.parametrize("block", [20_000, 7])
def test_exact_search(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(retrieval, "VECTORS", block)
    monkeypatch.setattr(retrieval, "QUERIES", block)
    known = retrieval.whole(vectors)
    rows = known.orderBy("vec_id").collect()
    assert len(rows) == 400
    centres = retrieval.fit_centres(known, 9)
    found = retrieval.index(known, centres)
    assert found.count() == 400 and found.select("cell").distinct().count() > 4
    queries = known.where("vec_id % 50 = 0").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    got = {}
    for r in retrieval.search(found, queries, centres, 5).orderBy("rank").collect():
        got.setdefault((r.query_id, r.corpus), []).append((r.id, r.score))
    points = np.array([r.embedding for r in rows], np.int64)
    assert got == brute(
        [r.vec_id for r in rows], [r.corpus for r in rows], points, range(0, 400, 50), 5
    )


def test_empty(spark, vectors):
    none = retrieval.whole(vectors.where("false"))
    centres = retrieval.fit_centres(none, 4)
    found = retrieval.search(
        none.selectExpr("vec_id AS id", "corpus", "embedding AS vector", "0 AS cell"),
        none.selectExpr("vec_id AS id", "embedding AS vector"), centres, 3,
    )
    assert found.columns == ["query_id", "corpus", "rank", "id", "score"] and found.count() == 0


def test_recall_of_the_index_and_pruned_folders(spark, tmp_path):
    """All vectors are indexed; half of the cells find at least nine of ten neighbours."""
    docs = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    known = retrieval.whole(docs).withColumn("corpus", F.when(F.col("vec_id") % 2 == 0, "even").otherwise("odd"))
    centres = retrieval.fit_centres(known, 64)
    retrieval.write_index(retrieval.index(known, centres), str(tmp_path / "index"))
    stored = spark.read.schema("id long, vector array<int>, corpus string, cell int").parquet(str(tmp_path / "index"))
    assert stored.count() == known.count()
    queries = known.where("vec_id % 50 = 0").selectExpr("vec_id AS id", "embedding AS vector")
    exact, quick = (
        {(r.query_id, r.corpus, r.id) for r in retrieval.search(stored, queries, centres, 5, n).collect()}
        for n in (None, 32)
    )
    recall = len(exact & quick) / len(exact)
    print("recall", recall)
    assert recall >= 0.9
    assert "PartitionFilters" in stored.where("corpus = 'odd'")._jdf.queryExecution().toString()


def test_exact_search_is_few_large_blocks(spark, vectors):
    """A query meets as many blocks of a corpus as its vectors fill, not one for each cell."""
    known = retrieval.whole(vectors)
    centres = retrieval.fit_centres(known, 9)
    found = retrieval.index(known, centres)
    queries = known.where("vec_id % 50 = 0").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    blocks = spark.sparkContext.accumulator(0)
    plain = retrieval._best

    def counted(table, k):
        blocks.add(1)
        return plain(table, k)

    retrieval._best = counted
    try:
        assert retrieval.search(found, queries, centres, 5).count() == 8 * (5 + 5 + 1)
    finally:
        retrieval._best = plain
    assert blocks.value == 3
