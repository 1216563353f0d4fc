"""WARC archives and a two-level capture index.

``write`` makes uncompressed WARC 1.1 files of at most ``ARCHIVE`` bytes (more only where one
record has more), each a warcinfo and then HTTP responses, or revisits where another record
has the same payload. ``index`` reads the archives and sorts their captures by reversed host and path;
runs of ``LINES`` captures are compressed blocks, and a sparse directory has the first key of each,
cut to ``KEY_CHARS``. ``lookup`` goes by the index: urls to keys, keys to blocks by binary search of the
directory, lines of those blocks to keys, then range reads of single records, file by file.
The directory has at most ``BLOCKS`` rows and is broadcast; with more captures, blocks are longer.
"""

import bisect
import hashlib
import json
import re
import uuid
import zlib
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.tables import small, staged
from shelfmark.sources.staging import staging_dir

ARCHIVE = 16 << 20
LEAST_REVISIT = 1000
LINES = 1000
BLOCKS, KEY_CHARS = 100_000, 256
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n"
_BETWEEN = b"\r\n\r\n"
_FORMAT = b"software: shelfmark\r\nformat: WARC File Format 1.1\r\n"


def _record(type: Column, id: Column, url: Column, digest: Column, size: Column, refers: Column, body: Column) -> Column:
    http = F.concat(
        F.lit(_END.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])),
        size.cast("string"), F.lit(_END + _END), body,
    )
    line = F.regexp_replace(url, r"[\x00-\x20\x7f]", "%20")
    head = F.concat_ws(
        _END,
        F.concat(F.lit("WARC/1.1" + _END + "WARC-Type: "), type),
        F.concat(F.lit("WARC-Record-ID: <urn:x-page:"), id.cast("string"), F.lit(">")),
        F.when(id.isNull(), F.concat(
            F.lit("WARC-Record-ID: <urn:x-payload:"), F.sha1(F.concat_ws(" ", url, digest)), F.lit(">"))),
        F.concat(F.lit("WARC-Target-URI: "), line),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
        F.when(type == "revisit", F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + _END
                  + "WARC-Refers-To: <urn:x-page:"), refers.cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(http).cast("string")),
    )
    return F.concat(head, F.lit(_END + _END), http)


def write(pages: DataFrame, target: str, id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """One record per row of ``pages`` in WARC files below ``target``.

    The payload is the html in UTF-8, a null one empty. Of rows with equal payloads of at
    least LEAST_REVISIT bytes, those with the largest id are responses, the others revisits
    of it; all smaller ones are responses. A row with a null id stays a response, whose
    Record-ID is of its url and payload; one with a null url has no Target-URI. Rows that share an
    id share the Record-ID. Repeated rows are repeated records.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    source = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), body.alias("body"))
    source = source.withColumn("size", F.octet_length("body").cast("long"))
    keys = staged(
        source.select("id", "size", F.when(F.col("size") >= LEAST_REVISIT, F.sha2("body", 256)).alias("key")),
        "payloads",
    )
    heads = keys.where("key IS NOT NULL").groupBy("key").agg(
        F.max("id").alias("first"), F.count("*").alias("n")
    ).where("n > 1 AND first IS NOT NULL").select("key", "first")
    heads = small(staged(heads, "heads"))
    joined = source.withColumn(
        "key", F.when(F.col("size") >= LEAST_REVISIT, F.sha2("body", 256))
    ).join(heads, "key", "left")
    revisit = F.coalesce(F.col("first") != F.col("id"), F.lit(False))
    record = _record(
        F.when(revisit, "revisit").otherwise("response"), F.col("id"), F.col("url"), F.sha1("body"),
        F.col("size"), F.col("first"), F.when(revisit, "").otherwise(F.col("body")),
    )
    # a row is a file: the writer of text commits it with its task
    joined.select(record.alias("value")).mapInArrow(partial(_archives, most=ARCHIVE), "value string").write.mode("overwrite").option(
        "lineSep", _END + _END
    ).option("maxRecordsPerFile", 1).text(target)


def _archives(batches, most: int):
    """Records put together up to ``most`` bytes, after a warcinfo of their own."""
    held, size = [], 0

    def out():
        name = hashlib.sha1(held[0]).hexdigest()
        info = _END.join([
            "WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:x-file:{name}>", f"WARC-Date: {DATE}",
            "Content-Type: application/warc-fields", f"Content-Length: {len(_FORMAT)}",
        ]).encode()
        data = pa.py_buffer(_BETWEEN.join([info, _FORMAT, *held]))
        ends = pa.array([0, data.size], pa.int32()).buffers()[1]
        return pa.RecordBatch.from_arrays([pa.StringArray.from_buffers(1, ends, data)], names=["value"])

    for batch in batches:
        for value in batch.column(0):
            data = value.as_buffer()
            if held and size + data.size + 1000 > most:
                yield out()
                held, size = [], 0
            held.append(data)
            size += data.size + len(_BETWEEN)
    if held:
        yield out()


def parsed(record: bytes) -> dict:
    """Fields of one record; its payload is checked against the digest."""
    head, _, block = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?mi)^content-length: *(\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"a damaged record: {fields.get('WARC-Record-ID')}")
    return {
        "id": _number(fields.get("WARC-Record-ID")), "url": fields.get("WARC-Target-URI"),
        "size": size, "digest": digest, "type": kind,
        "refers_to": _number(fields.get("WARC-Refers-To")), "payload": payload,
    }


def _number(name: str | None) -> str | None:
    return name[len("<urn:x-page:") : -1] if name and name.startswith("<urn:x-page:") else None


def surt(url: str | None) -> str:
    """The sort key of a url as it stands in a record: host labels reversed, then port, path and query."""
    rest = re.sub(r"[\x00-\x20\x7f]", "%20", url or "").partition("://")[2]
    host, path = re.match(r"([^/?#]*)([^#]*)", rest, re.S).groups()
    name, colon, port = host.lower().partition(":")
    return ",".join(reversed(name.split("."))) + ")" + colon + port + path


def _scanned(batches):
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            whole, at, out = data.as_buffer().to_pybytes(), 0, []
            while at < len(whole):
                end = whole.index(b"\r\n\r\n", at) + 4
                size = int(re.search(rb"\r\nContent-Length: (\d+)", whole[at:end])[1])
                if whole[end + size : end + size + 4] != _BETWEEN:
                    raise ValueError(f"{path}: no record ends at {end + size}")
                if b"\r\nWARC-Type: warcinfo\r\n" not in whole[at:end]:
                    record = parsed(whole[at : end + size])
                    out.append((surt(record["url"]), record["id"], path, at, end + size - at))
                at = end + size + 4
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                names=["key", "id", "file", "at", "size"],
            )


def _blocks(batches, lines: int):
    shard, number, held = TaskContext.get().partitionId(), 0, []

    def block():
        data = zlib.compress("\n".join(json.dumps(x) for x in held).encode())
        return pa.RecordBatch.from_pylist(
            [{"shard": shard, "block": number, "first": held[0][0], "data": data}],
            pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("first", pa.string()), ("data", pa.binary())]),
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(row)
            if len(held) == lines:
                yield block()
                number, held = number + 1, []
    if held:
        yield block()


def index(spark: SparkSession, archives: str, target: str) -> None:
    """Build the index of the WARC files below ``archives``. A file is read by one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(archives)
    found = staged(
        files.select("path", "content").mapInArrow(
            _scanned, "key string, id string, file string, at long, size long"
        ),
        "captures",
    )
    count = found.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), count // (100 * LINES))
    # each shard may end with a block that is not full
    lines = max(LINES, -(-count // max(1, BLOCKS - shards)))
    found.repartitionByRange(shards, "key", "id").sortWithinPartitions("key", "id", "file", "at").mapInArrow(
        partial(_blocks, lines=lines), "shard int, block long, first string, data binary"
    ).write.mode("overwrite").parquet(f"{target}/blocks")
    spark.read.parquet(f"{target}/blocks").select(
        F.substring("first", 1, KEY_CHARS).alias("first"), "shard", "block"
    ).write.mode("overwrite").parquet(f"{target}/directory")


def _opened(path: str):
    """The file system and path of a file's uri; only local and remote stores pyarrow knows."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


_CAPTURE = pa.schema([
    ("id", pa.string()), ("url", pa.string()), ("size", pa.int64()), ("digest", pa.string()),
    ("type", pa.string()), ("refers_to", pa.string()), ("payload", pa.string()),
])
_CAPTURE_SQL = "id string, url string, size long, digest string, type string, refers_to string, payload string"


def _range_read(batches, payloads: bool):
    """Records of index lines, which come file by file in order of place."""
    opened, file, out, held = None, None, [], 0
    for batch in batches:
        for path, at, size in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size"))):
            if path != opened:
                store, place = _opened(path)
                file, opened = store.open_input_file(path=place), path
            record = parsed(file.read_at(size, at))
            held += size if payloads else 200
            out.append(record | {"payload": record["payload"].decode() if payloads else None})
            if held > ARCHIVE:
                yield pa.RecordBatch.from_pylist(out, _CAPTURE)
                out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, _CAPTURE)


def _keys(batches):
    for batch in batches:
        found = sorted({surt(u) for u in batch.column(0).to_pylist()})
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["key"])


def places(firsts: list[str], key: str) -> range:
    """The blocks that may hold a key, by binary search: ``firsts`` are the blocks' first keys in
    order, each cut to KEY_CHARS. A block's last key is at most the next one's first."""
    low = bisect.bisect_left(firsts, key[:KEY_CHARS]) - 1
    return range(max(low, 0), bisect.bisect_right(firsts, key))


def _resolved(batches, directory):
    firsts, blocks = directory.value
    for batch in batches:
        found = sorted({i for key in batch.column(0).to_pylist() for i in places(firsts, key)})
        yield pa.RecordBatch.from_arrays(
            [pa.array([blocks[i][0] for i in found], pa.int32()), pa.array([blocks[i][1] for i in found], pa.int64())],
            names=["shard", "block"],
        )


def _lines(batches):
    """Keys and places of the captures of each block."""
    for batch in batches:
        for data in batch.column(0).to_pylist():
            key, _, file, at, size = zip(*map(json.loads, zlib.decompress(data).decode().split("\n")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.string()), pa.array(file, pa.string()), pa.array(at, pa.int64()),
                 pa.array(size, pa.int64())], names=["key", "file", "at", "size"],
            )


def lookup(spark: SparkSession, target: str, urls: DataFrame | list, payloads: bool = True) -> DataFrame:
    """Captures whose url has the key of one of ``urls`` (a list, or a table's only column), each once
    however often its key is asked for. A null url has the key of records without one.
    """
    if isinstance(urls, list):
        urls = spark.createDataFrame([(u,) for u in urls], "url string")
    keys = staged(urls.distinct().mapInArrow(_keys, "key string").distinct(), "keys")
    listed = sorted(tuple(r) for r in spark.read.parquet(f"{target}/directory").collect())  # at most BLOCKS
    directory = spark.sparkContext.broadcast(([r[0] for r in listed], [r[1:] for r in listed]))
    wanted = keys.mapInArrow(partial(_resolved, directory=directory), "shard int, block long").distinct()
    blocks = spark.read.parquet(f"{target}/blocks").join(small(staged(wanted, "blocks")), ["shard", "block"], "left_semi")
    lines = blocks.select("data").mapInArrow(_lines, "key string, file string, at long, size long")
    found = lines.join(small(keys), "key", "left_semi").select("file", "at", "size")
    placed = found.repartition("file").sortWithinPartitions("file", "at")
    return placed.mapInArrow(partial(_range_read, payloads=payloads), _CAPTURE_SQL)


def round_trip(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write archives and index below spark.checkpoint.dir and look every page's url up."""
    spark = pages.sparkSession
    target = staging_dir(spark, f"llm/warc-{uuid.uuid4().hex}")
    write(pages, f"{target}/archives", id, url, html)
    index(spark, f"{target}/archives", f"{target}/index")
    kind = pages.schema[id].dataType.simpleString()
    return lookup(spark, f"{target}/index", pages.select(url), payloads=False).select(
        F.col("id").cast(kind).alias(id), F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
