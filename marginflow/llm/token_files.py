"""Token-id files with a shared zstandard dictionary.

A dictionary is trained on a bounded, hash-chosen sample of serialized id
arrays.  Every document's ids are compressed on their own with it, and the
frames of consecutive documents (ascending id) make a shard:

    magic 8 bytes | SHA-256 of the dictionary 32 bytes | id width u8, 7 zeros
    frames
    index: per document id i64, has-id u8, frame offset u64, ids u64
    documents u64 | index offset u64 | magic 8 bytes        (little-endian)

so one short document is read with the index and one frame.  Beside the
shards lie the dictionary and a manifest with each shard's first position in
the corpus.  Tasks write shards through Arrow's file systems under names that
depend only on the data, in place of a temporary name, so a task that is run
again replaces its own files.  Spark's binaryFile source reads them back.

Edge cases: a null text is an empty one (the end id only); null ids sort
first; repeated rows are written as often as they occur; an empty table gives
no shards and an empty result; other columns are not carried.  Document ids
are integers.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginflow.llm.common import range_buckets, text_slices
from marginflow.llm.tokens import WordEncoder, vocabulary_path

MAGIC = b"MFTOKID1"
SUFFIX = ".mftok"
#: Bounds of the dictionary's training sample, and its size in bytes.
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 2000, 1024, 64 * 1024
LEVEL = 3
#: Compressed bytes of a shard, about.
SHARD_BYTES = 8 << 20
ROWS_PER_BUCKET = 4096
#: Shards whose manifest rows are broadcast to the reading tasks.
BROADCAST_SHARDS = 500_000
_INDEX = "<qBQQ"


def _uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def _put(path: str, data: bytes, attempt: str) -> None:
    """Write a file in one move (object stores do so by themselves)."""
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(_uri(path))
    folder, _, base = name.rpartition("/")
    store.create_dir(folder, recursive=True)
    draft = f"{folder}/.{base}.{attempt}"
    with store.open_output_stream(draft) as out:
        out.write(data)
    store.move(draft, name)


class Shard:
    """A shard's bytes: its documents, and any one of them by position."""

    def __init__(self, raw: bytes, dictionary: bytes):
        import zstandard
        if raw[:8] != MAGIC or raw[-8:] != MAGIC:
            raise ValueError("not a token-id shard")
        if raw[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        self.raw, self.width = raw, raw[40]
        _, at = struct.unpack("<QQ", raw[-24:-8])
        self.index = list(struct.iter_unpack(_INDEX, raw[at:-24]))
        self.stops = [e[2] for e in self.index[1:]] + [at]
        self.zstd = zstandard.ZstdDecompressor(
            **({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))

    def ids(self, i: int):
        """Ids of the i-th document as little-endian uint32."""
        import numpy as np
        plain = self.zstd.decompress(self.raw[self.index[i][2]:self.stops[i]])
        return np.frombuffer(plain, f"<u{self.width}").astype("<u4")


def _train(sample: list[bytes]) -> bytes:
    import zstandard
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:  # too little to train on: the sample itself
        return b"".join(sample)[:DICTIONARY_BYTES]


def write_token_files(docs: DataFrame, path: str, end_id: int = 2, vocabulary: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every document and write the shards, dictionary and manifest."""
    spark = docs.sparkSession
    vocabulary = vocabulary or vocabulary_path()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def sample_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = WordEncoder(vocabulary)
        for batch in batches:
            ids = [raw[:SAMPLE_IDS * enc.width] for raw in enc.encode_batch(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    share = min(1.0, SAMPLE_DOCS / max(1, rows.count()))
    rank = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)) / float(1 << 40)
    sample = sorted(r["ids"] for r in rows.filter(rank < share).select("text")
                    .mapInArrow(sample_ids, "ids binary").collect())
    dictionary = _train([s for s in sample if s])
    _put(f"{path}/dictionary", dictionary, "draft")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import zstandard
        from pyspark import TaskContext
        attempt = str(TaskContext.get().taskAttemptId())
        enc = WordEncoder(vocabulary)
        options = {}
        if dictionary:
            options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
            options["dict_data"].precompute_compress(level=LEVEL)  # once, not for every document
        zstd = zstandard.ZstdCompressor(level=LEVEL, **options)
        head = MAGIC + hashlib.sha256(dictionary).digest() + bytes([enc.width]) + bytes(7)
        end = np.asarray([end_id], enc.dtype).tobytes()
        bucket, part, frames, size, index, ids = None, 0, [], 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal part, frames, size, index, ids
            name = f"{bucket:08d}-{part:06d}{SUFFIX}"
            at = len(head) + size
            tail = b"".join(struct.pack(_INDEX, *e) for e in index) + struct.pack("<QQ", len(index), at) + MAGIC
            _put(f"{path}/shards/{name}", b"".join([head, *frames, tail]), attempt)
            row = pa.RecordBatch.from_arrays([
                pa.array([name]), pa.array([bucket], pa.int32()), pa.array([part], pa.int32()),
                pa.array([len(index)], pa.int64()), pa.array([ids], pa.int64())],
                names=["name", "bucket", "part", "docs", "ids"])
            part, frames, size, index, ids = part + 1, [], 0, [], 0
            return row

        for batch in batches:
            keys, buckets = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for lo, hi, texts in text_slices(batch.column(1)):
                for key, raw, b in zip(keys[lo:hi], enc.encode_batch(texts), buckets[lo:hi]):
                    if index and (b != bucket or size >= SHARD_BYTES):
                        yield close()
                    if b != bucket:
                        bucket, part = b, 0
                    raw += end
                    frame = zstd.compress(raw)
                    index.append((key or 0, key is not None, len(head) + size, len(raw) // enc.width))
                    frames.append(frame)
                    size += len(frame)
                    ids += len(raw) // enc.width
        if index:
            yield close()

    bucket, n = range_buckets(rows, "id", ROWS_PER_BUCKET)
    manifest = (rows.withColumn("bucket", bucket).repartition(n, "bucket")
                .sortWithinPartitions("bucket", F.col("id").asc_nulls_first(), F.xxhash64("text"))
                .mapInArrow(write, "name string, bucket int, part int, docs long, ids long"))
    manifest.write.parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids as little-endian uint32 bytes) from the files."""
    manifest = spark.read.parquet(f"{path}/manifest")
    shards = manifest.count()
    if not shards:
        return spark.createDataFrame([], f"`{id_col}` long, start long, n_tokens long, ids binary")
    dictionary = bytes(spark.read.format("binaryFile").load(f"{path}/dictionary").first()["content"])

    # positions: totals of whole buckets (one row each), then shards within one
    buckets = manifest.groupBy("bucket").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("bucket", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("bucket", "name", F.coalesce(F.sum("ids").over(within), F.lit(0)).alias("inside")) \
        .join(buckets, "bucket").select("name", (F.col("first") + F.col("inside")).alias("first"))
    if shards <= BROADCAST_SHARDS:
        starts = F.broadcast(starts)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(f"{path}/shards") \
        .select(F.substring_index("path", "/", -1).alias("name"), "content")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, at = Shard(batch.column(0)[k].as_py(), dictionary), batch.column(1)[k].as_py()
                for lo in range(0, len(shard.index), 1000):
                    part, key, start, ids = shard.index[lo:lo + 1000], [], [], []
                    for i, (doc, known, _, n) in enumerate(part, lo):
                        key.append(doc if known else None)
                        start.append(at)
                        ids.append(shard.ids(i).tobytes())
                        at += n
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key, pa.int64()), pa.array(start, pa.int64()),
                        pa.array([e[3] for e in part], pa.int64()), pa.array(ids, pa.binary())],
                        names=[id_col, "start", "n_tokens", "ids"])

    return files.join(starts, "name").select("content", "first").mapInArrow(
        decode, f"`{id_col}` long, start long, n_tokens long, ids binary")
