"""Token-id output: documents compressed one by one with a shared zstandard dictionary.

``write`` encodes every document, trains one dictionary on serialized id
arrays, compresses each document apart (so that a short one can be read alone
and still compresses well), and writes shards in ascending order of doc_id.

A shard is one row of a Parquet table, so any store that Spark can write holds
it and a lost executor costs only a task's redo:

    part, shard int     its number: range of doc_id, and shard in that range
    first, last long    least and greatest doc_id in it (Parquet skips shards by them)
    dict_hash   string  sha256 of the dictionary its frames need
    n_docs      int
    n_ids       long    ids of its documents
    offsets     binary  index: for each document doc_id i64, start in the shard i64, n_tokens i64, offset u64, size u64
    frames      binary  zstandard frames, one for each document, in the index's order

``bases`` (part, shard, base) has the ids before each shard, and ``dictionary``
one row (dict_hash, dictionary). A frame holds ids as little-endian unsigned
16-bit integers. A document's ``start`` counts the ids of all documents before.

Edge cases: a null text counts as empty, and an empty document still holds the
end id. Documents with a null doc_id come first; documents of one doc_id stay
next to each other, by length and then bytes. A document larger than
``shard_bytes`` is a shard of its own. An empty table gives no shard. Other
columns are not written.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from typing import NamedTuple

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.llm.common import map_arrow, stage, staged_path
from chartloom.llm.tokens import encoder

_ENTRY = "<qqqQQ"
_NO_ID = -(1 << 63)


class TokenFiles(NamedTuple):
    shards: str
    bases: str
    dictionary: str


def train_dictionary(samples: list[bytes], size: int = 64 << 10, level: int = 3) -> bytes:
    """A dictionary from serialized id arrays; empty (none) if there are too few to train on."""
    import zstandard

    samples = [s for s in samples if len(s) >= 8]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8 + 1024), samples, level=level).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes, level: int):
    import zstandard

    extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstandard.ZstdCompressor(level=level, write_checksum=False, **extra)


def _decompressor(dictionary: bytes):
    import zstandard

    extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstandard.ZstdDecompressor(**extra)


def encoded(docs: DataFrame, vocabulary: str, end_id: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids): every document's ids with the end id, 16-bit."""

    def make():
        enc, end = encoder(vocabulary), struct.pack("<H", end_id)

        def f(batch):
            ids = enc.encode([t or "" for t in batch.column(1).to_pylist()])
            return {"doc_id": batch.column(0), "ids": [x + end for x in ids]}

        return f

    return map_arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string")), "doc_id long, ids binary", make)


def write(
    docs: DataFrame,
    vocabulary: str = public_tokenizers.path("word_bpe_49k.json"),
    end_id: int = 2,
    sample_docs: int = 1000,
    sample_bytes: int = 8 << 10,
    shard_bytes: int = 4 << 20,
    level: int = 3,
) -> TokenFiles:
    """Writes the shards and their dictionary.

    The dictionary (only it) is trained on a bounded sample: the first
    ``sample_bytes`` of the ids of ``sample_docs`` documents, those of the
    least hash of doc_id.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    sample = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    picked = docs.join(F.broadcast(sample.dropDuplicates()), "doc_id", "left_semi")
    short = encoded(picked, vocabulary, end_id).select(F.substring("ids", 1, sample_bytes).alias("ids")).orderBy("ids").limit(sample_docs)
    dictionary = train_dictionary([bytes(r.ids) for r in short.collect()])
    dict_hash = hashlib.sha256(dictionary).hexdigest()

    def make():
        enc, end, zip_ = encoder(vocabulary), struct.pack("<H", end_id), _compressor(dictionary, level)

        def f(batch):
            ids = [x + end for x in enc.encode([t or "" for t in batch.column(1).to_pylist()])]
            return {"doc_id": batch.column(0), "n_tokens": [len(x) // 2 for x in ids], "frame": [zip_.compress(x) for x in ids]}

        return f

    frames = stage(map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id long, n_tokens long, frame binary", make), "frames")

    # A range of doc_id goes to one task, in order; it cuts the shards as it goes.
    total = frames.agg(F.sum(F.length("frame"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), F.col("n_tokens").asc(), F.col("frame").asc()]
    ranged = frames.repartitionByRange(int(max(1, -(-total // (4 * shard_bytes)))), order[0]).sortWithinPartitions(*order)
    schema = "part int, shard int, first long, last long, dict_hash string, n_docs int, n_ids long, before long, offsets binary, frames binary"

    def cut(batches):
        import pyarrow as pa

        names, number = [f.split()[0] for f in schema.split(", ")], 0
        entries, frames_, size, ids, part, before = [], [], 0, 0, 0, 0

        def shard():
            row = (part, number, entries[0][0], entries[-1][0], dict_hash, len(entries), ids, before, b"".join(struct.pack(_ENTRY, *e) for e in entries), b"".join(frames_))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for doc, n, frame, p in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame", "part")), strict=True):
                if entries and size + len(frame) > shard_bytes:
                    yield shard()
                    entries, frames_, size, ids, number, before = [], [], 0, 0, number + 1, before + ids
                entries.append((_NO_ID if doc is None else doc, ids, n, size, len(frame)))
                frames_.append(frame)
                size, ids, part = size + len(frame), ids + n, p
        if entries:
            yield shard()

    out = TokenFiles(*(staged_path(spark, f"token-{x}") for x in ("shards", "bases", "dictionary")))
    ranged.withColumn("part", F.spark_partition_id()).mapInArrow(cut, schema).write.option("compression", "none").parquet(out.shards)
    # A shard knows the ids before it in its part; parts, one for some 16 MB of frames, add up to what is before them.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = spark.read.parquet(out.shards).groupBy("part").agg(F.sum("n_ids").alias("n"))
    sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).coalesce(1).write.parquet(out.bases)
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(out.dictionary)
    return out


def read(spark: SparkSession, files: TokenFiles, only: list[int] | None = None, finish=None, schema: str = "ids binary") -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents, or of those asked for.

    For single documents only the shards whose range holds one of them are
    read, and only their frames are decompressed. finish(ids) -> tuple gives
    other columns than the ids, named in schema.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    held = spark.read.parquet(files.dictionary).first()
    dict_hash, dictionary = held.dict_hash, bytes(held.dictionary)
    # 12 bytes for each 16 MB of frames, so frames stay where they are
    shards = spark.read.parquet(files.shards).join(F.broadcast(spark.read.parquet(files.bases)), "part").withColumn("base", F.col("base") + F.col("before"))
    if only is not None:
        hit = F.lit(False)
        for i in only:
            hit = hit | ((F.col("first") <= i) & (F.col("last") >= i))
        shards = shards.filter(hit)
    wanted = None if only is None else set(only)
    schema = "doc_id long, start long, n_tokens long, " + schema
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        import pyarrow as pa

        unzip = _decompressor(dictionary)
        for batch in batches:
            for r in range(batch.num_rows):
                if batch.column("dict_hash")[r].as_py() != dict_hash:
                    raise ValueError("a shard was written with another dictionary")
                index, frames, base = batch.column("offsets")[r].as_py(), memoryview(batch.column("frames")[r].as_buffer()), batch.column("base")[r].as_py()
                entries = [e for e in struct.iter_unpack(_ENTRY, index) if wanted is None or e[0] in wanted]
                for at in range(0, len(entries), 512):
                    rows = []
                    for doc, start, n, offset, size in entries[at : at + 512]:
                        ids = unzip.decompress(frames[offset : offset + size])
                        rows.append((None if doc == _NO_ID else doc, base + start, n, *((ids,) if finish is None else finish(ids))))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return shards.select("dict_hash", "base", "offsets", "frames").mapInArrow(run, schema)


def crc32(ids: bytes) -> tuple[int]:
    """Unsigned CRC-32 of the ids as 32-bit integers."""
    import numpy as np

    return (zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4")),)


def query(spark, sf_dir: str) -> DataFrame:
    from chartloom.llm.common import table

    return read(spark, write(table(spark, sf_dir, "documents")), finish=crc32, schema="ids_crc32 long")
