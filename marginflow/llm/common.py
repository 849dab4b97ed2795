"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back.

    Cuts the lineage: what follows re-reads files that survive lost
    executors, instead of recomputing everything before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with the caller's columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def process_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker process.

    Task closures are shipped by value, so a module global would be rebuilt
    for every task; workers are reused, so this one stays warm.
    """
    key = "_marginflow_process_cache"
    holder = sys.modules.setdefault(key, types.ModuleType(key))
    return holder.__dict__.setdefault(name, {})


def share(spark: SparkSession, value):
    """Broadcast a value; returns a function that gives it in a task.

    Its classes travel by value, like the tasks' functions, so executors need
    not have this package installed."""
    import pickle

    from pyspark import cloudpickle
    raw = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(raw.value)


def sha256_joined(arr) -> F.Column:
    """Lowercase hex SHA-256 of an array of strings joined by commas."""
    return F.sha2(F.concat_ws(",", arr), 256)


def text_slices(column, limit: int = 4_000_000):
    """(start, stop, texts) parts of an Arrow text column: at most ``limit``
    bytes of text at a time as Python strings, or one row."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if i > start and size + n > limit:
            yield start, i, column.slice(start, i - start).to_pylist()
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes), column.slice(start).to_pylist()


def map_texts(docs: DataFrame, text_col: str, keep: list[str], new_fields, make,
              limit: int = 4_000_000) -> DataFrame:
    """The ``keep`` columns of every row plus columns computed from its text.

    ``make()`` runs once per task and returns a function from a list of texts
    to one Arrow array per new field.  A kept column with the name of a new
    one gives way to it, as with ``withColumn``.  A narrow Arrow map: no
    shuffle, and rows travel in slices of at most ``limit`` bytes of text.
    Columns are renamed by position on the way, so any names will do.
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    names = {f.name.lower() for f in new_fields}
    keep = [c for c in keep if c.lower() not in names]
    result = [docs.schema[c] for c in keep] + list(new_fields)
    schema = T.StructType([T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(result)])
    out_names = schema.names

    def run(batches):
        f = make()
        for batch in batches:
            for lo, hi, texts in text_slices(batch.column(len(keep)), limit):
                old = [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(old + list(f(texts)), names=out_names)

    given = docs.select(*[column(c).alias(f"c{i}") for i, c in enumerate(keep)],
                        column(text_col).alias(f"c{len(keep)}"))
    return given.mapInArrow(run, schema).toDF(*[f.name for f in result])


def column(name: str) -> F.Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def range_buckets(df: DataFrame, col: str, rows: int, most: int = 20_000) -> tuple[F.Column, int]:
    """A bucket number that rises with an integer column, and how many there are.

    About ``rows`` rows to a bucket (more if that would need over ``most``
    buckets), from approximate quantiles of the whole column: one aggregate
    that reads only that column.  Nulls are in bucket 0.
    """
    import json
    import math

    n = df.filter(F.col(col).isNotNull()).count()
    k = min(most, -(-n // rows))
    if k <= 1:
        return F.lit(0), 1
    cuts = df.select(F.percentile_approx(col, [i / k for i in range(1, k)], max(10_000, 10 * k))).first()[0]
    cuts = sorted(set(cuts))
    width = math.isqrt(len(cuts)) + 1
    blocks = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    heads = F.from_json(F.lit(json.dumps([b[0] for b in blocks])), "array<bigint>")
    table = F.from_json(F.lit(json.dumps(blocks)), "array<array<bigint>>")
    key = F.col(col)
    block = F.size(F.filter(heads, lambda h: h <= key)) - 1
    inside = F.size(F.filter(F.get(table, block), lambda c: c <= key))
    return F.when(block < 0, 0).otherwise(block * width + inside), len(cuts) + 1
