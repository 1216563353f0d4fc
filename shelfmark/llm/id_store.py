"""Token ids as binary blocks, each document compressed by itself with a shared dictionary.

A store is a folder with two tables: ``dictionary`` (hash, data) and ``blocks``, whose
rows hold about ``BLOCK`` bytes: the documents' ids, token counts, the offset index into
the payload, the payload of zstandard frames, and the dictionary's hash. Blocks are
numbered within shards, shards hold ascending ranges of document ids. One document is read
by its block's range of ids and its offsets, without decompressing others. Spark writes the
tables, so any store it reaches will do and repeated tasks leave no trace.
"""

import hashlib
import json
import re
import uuid
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import texts
from shelfmark.llm.chunks import Encoder, bounds
from shelfmark.llm.tables import small, staged
from shelfmark.sources.staging import staging_dir

END_ID = 0
LEVEL = 3
BLOCK = 1 << 20
SHARD = 64 << 20
#: The dictionary's size, and its training sample: so many documents, by the hash of their
#: id, of at most so many bytes of ids each. It only affects how small frames become.
DICTIONARY = 64 << 10
SAMPLE = 500
SAMPLE_BYTES = 32 << 10
SLICE = 4 << 20
#: Chunks in one call of the tokenizer, whose results are large objects.
CALL = 8192

_OPEN: dict = {}


def _cuts(model: str):
    """``bounds``, but never within an added token, which is a chunk of its own; a row that
    holds one is a chunk as a whole where the tokenizer looks at what surrounds them."""
    held = json.loads(model)
    added = [t for t in held["added_tokens"] if t["content"]]
    if not added:
        return bounds
    plain = not held.get("normalizer") and len({t["normalized"] for t in added}) == 1 and not any(
        t[k] for t in added for k in ("single_word", "lstrip", "rstrip")
    )
    contents = sorted((t["content"].encode() for t in added), key=len, reverse=True)
    found = re.compile(b"|".join(map(re.escape, contents)))

    def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts, text = bounds(data, offsets), data.tobytes()
        if not found.search(text):
            return starts
        hits = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            own = [m.span() for m in found.finditer(text, a, b)]
            hits += own if plain or not own else [(a, b)]
        if not hits:
            return starts
        begins, ends = np.array(hits, np.int64).T
        at = np.searchsorted(begins, starts) - 1  # of the last hit that begins before
        outside = (at < 0) | (starts >= ends[at])
        new = np.concatenate([starts[outside], begins, ends])
        return np.unique(new[new < len(data)])

    return cuts


def _encoder(model: str, added: bool):
    """One tokenizer and memo for each worker process. ``added``: strings of added tokens
    are those tokens, as the tokenizer's file has it; else they are text."""
    if (model, added) not in _OPEN:
        _OPEN.clear()
        tokenizer = Tokenizer.from_str(model)
        tokenizer.encode_special_tokens = not added
        _OPEN[model, added] = Encoder(lambda chunks: [
            e.ids
            for i in range(0, len(chunks), CALL)
            for e in tokenizer.encode_batch_fast(chunks[i : i + CALL], add_special_tokens=False)
        ], _cuts(model) if added else bounds)
    return _OPEN[model, added]


def _ids(batches, model: str, added: bool):
    """(rows of the batch's other columns, ids of each row with the end id, little-endian)."""
    encoder = _encoder(model, added)
    for batch in batches:
        for low, high in texts.slices(batch.column(1), SLICE):
            ids, rows = encoder(batch.column(1).slice(low, high - low))
            own = [
                np.append(ids[a:b], np.uint32(END_ID)).astype("<u4")
                for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())
            ]
            yield batch.column(0).slice(low, high - low), own


def _serialized(batches, model, added):
    for id, own in _ids(batches, model.value, added):
        yield pa.RecordBatch.from_arrays(
            [id, pa.array([x.tobytes() for x in own], pa.binary())], names=["id", "data"]
        )


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def _frames(batches, model, dictionary, added):
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary.value))
    for id, own in _ids(batches, model.value, added):
        yield pa.RecordBatch.from_arrays(
            [
                id, pa.array([len(x) for x in own], pa.int64()),
                pa.array([press.compress(x.tobytes()) for x in own], pa.binary()),
            ],
            names=["id", "n", "frame"],
        )


def train(samples: list[bytes]) -> bytes:
    """A dictionary; if the samples are too few to train on, they are the dictionary."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        held = b"".join(samples)[-DICTIONARY:]
        return held if len(held) >= 8 else b""


_BLOCK = "shard int, block long, first {0}, last {0}, ids array<{0}>, counts array<long>, offsets array<long>, payload binary, tokens long, dictionary string"


def _pack(batches, dictionary: str):
    """Rows come in order of id; one block is held at a time."""
    shard, number = TaskContext.get().partitionId(), 0
    ids, counts, frames, held = [], [], [], 0

    def block():
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()), pa.array([number], pa.int64()),
                pa.array([ids[0]], kind), pa.array([ids[-1]], kind), pa.array([ids], pa.list_(kind)),
                pa.array([counts], pa.list_(pa.int64())), pa.array([offsets], pa.list_(pa.int64())),
                pa.array([b"".join(frames)], pa.binary()), pa.array([sum(counts)], pa.int64()),
                pa.array([dictionary], pa.string()),
            ],
            names=["shard", "block", "first", "last", "ids", "counts", "offsets", "payload", "tokens", "dictionary"],
        )

    for batch in batches:
        kind = batch.column(0).type
        for id, n, frame in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and held + len(frame) > BLOCK:
                yield block()
                number, ids, counts, frames, held = number + 1, [], [], [], 0
            ids.append(id)
            counts.append(n)
            frames.append(frame)
            held += len(frame)
    if ids:
        yield block()


def write(
    docs: DataFrame, target: str, tokenizer_path: str, id: str = "doc_id", text: str = "text",
    added: bool = False,
):
    """Encode every whole text, with END_ID after it, and write a store to ``target``.

    ``added``: the string of an added token in a text (<|endoftext|>) is that token, as by
    the tokenizer's file with add_special_tokens=False; else it is text like other text.

    A null text counts as empty. Documents are in ascending order of id, nulls first;
    those with one id stay together, by their frames. Further columns are not looked at.
    An empty table gives a store without blocks.
    """
    spark = docs.sparkSession
    with open(tokenizer_path) as f:
        model = spark.sparkContext.broadcast(f.read())
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    every = max(1, source.count() // SAMPLE)
    sample = source.where(F.expr(f"pmod(xxhash64(id), {every}) = 0")).mapInArrow(
        partial(_serialized, model=model, added=added), f"id {kind}, data binary"
    ).where(f"length(data) <= {SAMPLE_BYTES}").orderBy(F.xxhash64("id"), "data").limit(SAMPLE)
    data = train([bytes(r["data"]) for r in sample.collect()])
    name = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(name, bytearray(data))], "hash string, data binary").write.mode(
        "overwrite"
    ).parquet(f"{target}/dictionary")

    dictionary = spark.sparkContext.broadcast(data)
    frames = staged(
        source.mapInArrow(
            partial(_frames, model=model, dictionary=dictionary, added=added), f"id {kind}, n long, frame binary"
        ),
        "frames",
    )
    total = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD))
    blocks = frames.repartitionByRange(shards, "id").sortWithinPartitions("id", "frame").mapInArrow(
        partial(_pack, dictionary=name), _BLOCK.format(kind)
    )
    blocks.write.mode("overwrite").parquet(f"{target}/blocks")


def _unpack(batches, dictionary):
    press = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary.value))
    for batch in batches:
        for ids, counts, offsets, payload, start in zip(*(c.to_pylist() for c in batch.columns)):
            own = [
                press.decompress(payload[a:b], max_output_size=4 * n)
                for a, b, n in zip(offsets[:-1], offsets[1:], counts)
            ]
            starts = start + np.cumsum([0, *counts[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, batch.column(0).type.value_type), pa.array(starts, pa.int64()),
                    pa.array([len(x) // 4 for x in own], pa.int64()),
                    pa.array([zlib.crc32(x) for x in own], pa.int64()),
                    pa.array(own, pa.binary()),
                ],
                names=["id", "start", "n_tokens", "ids_crc32", "data"],
            )


def _open(spark: SparkSession, path: str):
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(row["data"]).hexdigest() != row["hash"]:
        raise ValueError("the dictionary is damaged")
    blocks = spark.read.parquet(f"{path}/blocks")
    if blocks.where(F.col("dictionary") != row["hash"]).limit(1).count():
        raise ValueError("a block was written with another dictionary")
    return blocks, spark.sparkContext.broadcast(bytes(row["data"]))


def _placed(spark: SparkSession, blocks: DataFrame) -> DataFrame:
    """(shard, block, start): tokens before each block. One row per shard meets in one task."""
    sizes = blocks.select("shard", "block", "tokens")
    shards = sizes.groupBy("shard").agg(F.sum("tokens").alias("all"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("all").over(order), F.lit(0)).alias("base"))
    order = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = sizes.withColumn("inner", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
    return staged(
        within.join(shards, "shard").selectExpr("shard", "block", "base + inner AS start"), "starts"
    )


def read(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """Every document of a store: id, start (tokens before it), n_tokens, ids_crc32, data."""
    blocks, dictionary = _open(spark, path)
    kind = blocks.schema["first"].dataType.simpleString()
    placed = blocks.join(small(_placed(spark, blocks)), ["shard", "block"])
    found = placed.select("ids", "counts", "offsets", "payload", "start").mapInArrow(
        partial(_unpack, dictionary=dictionary),
        f"id {kind}, start long, n_tokens long, ids_crc32 long, data binary",
    )
    return found.withColumnRenamed("id", id)


def fetch(spark: SparkSession, path: str, wanted: list, id: str = "doc_id") -> DataFrame:
    """Documents by id: (id, data). Only blocks whose range holds an id are read, and only
    the wanted frames are decompressed."""
    blocks, dictionary = _open(spark, path)
    ids = sorted(set(wanted))
    held = blocks.where(
        F.exists(F.array(*map(F.lit, ids)), lambda x: F.col("first").isNull() | x.between(F.col("first"), F.col("last")))
        if ids else F.lit(False)
    ).select(F.explode(F.arrays_zip("ids", "counts", F.slice("offsets", 1, F.size("ids")).alias("a"),
                                    F.slice("offsets", 2, F.size("ids")).alias("b"))).alias("d"), "payload")
    one = held.where(F.col("d.ids").isin(ids)).select(
        F.array("d.ids").alias("ids"), F.array("d.counts").alias("counts"),
        F.expr("array(0L, d.b - d.a)").alias("offsets"),
        F.expr("substring(payload, d.a + 1, d.b - d.a)").alias("payload"), F.lit(0).cast("long").alias("start"),
    )
    kind = blocks.schema["first"].dataType.simpleString()
    found = one.mapInArrow(
        partial(_unpack, dictionary=dictionary),
        f"id {kind}, start long, n_tokens long, ids_crc32 long, data binary",
    )
    return found.selectExpr(f"id AS `{id}`", "data")


def write_and_read(docs: DataFrame, tokenizer_path: str, id="doc_id", text="text") -> DataFrame:
    """Write a store below spark.checkpoint.dir, by the tokenizer's file as it is, and read it back."""
    spark = docs.sparkSession
    target = staging_dir(spark, f"llm/store-{uuid.uuid4().hex}")
    write(docs, target, tokenizer_path, id, text, added=True)
    return read(spark, target, id)
