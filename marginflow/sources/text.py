"""Delimited text input: data lines, the name file and the type file.

The reference reads comma-separated lines whose fields all parse as double,
with no quoting, plus a name file (one column name per line, position = index)
and a type file (one line per column; the first integer is the code, 1 =
classification, anything else = regression).  Malformed input must fail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.session import one_row

# fixed values: task names chosen by the type code (1 = classification)
CLASSIFICATION = "Classification"
REGRESSION = "Regression"
CLASSIFICATION_CODE = 1


def read_delimited(spark: SparkSession, path: str, names: Sequence[str],
                   header: bool = True) -> DataFrame:
    """Scan comma-separated files into typed DOUBLE columns.

    Explicit schema, no inference, FAILFAST: a field that does not parse or
    a row with the wrong field count aborts the job instead of becoming NULL.
    """
    schema = T.StructType([T.StructField(n, T.DoubleType(), True) for n in names])
    return (spark.read.schema(schema)
            .option("header", header)
            .option("mode", "FAILFAST")
            .option("quote", "")
            .csv(path))


def write_delimited(df: DataFrame, path: str) -> None:
    """Columns as comma-separated files with a header line each."""
    df.write.option("header", True).csv(path)


def split_fields(line: Column | str, n_fields: int) -> Column:
    """``line.split(',').map(_.toDouble)`` as an ARRAY<DOUBLE> column.

    The cast is ANSI (throws on a bad number); a row with a different field
    count raises instead of being padded or cut.  Each field is cast by
    position (no lambda), so the projection stays in generated code.
    """
    col = F.col(line) if isinstance(line, str) else line
    parts = F.split(col, ",")
    values = F.array(*[F.trim(parts[i]).cast("double") for i in range(n_fields)])
    return F.when(F.size(parts) == n_fields, values).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {n_fields} fields, got: "), col)))


def parse_lines(lines: DataFrame, names: Sequence[str], value_col: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """Text lines -> one DOUBLE column per name (S6 applied to a DataFrame)."""
    vals = split_fields(value_col, len(names))
    arr = lines.select(*keep, vals.alias("_v"))
    return arr.select(*keep, *[F.col("_v")[i].alias(n) for i, n in enumerate(names)])


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    # The name and type files hold one line per column, so reading each file
    # whole keeps line order without a global sort; their size is bounded by
    # the column count, not by the data.
    whole = spark.read.text(path, wholetext=True)
    return (whole.select(F.posexplode(F.split(F.col("value"), r"\r?\n")).alias("pos", "line"))
            .filter(F.trim("line") != ""))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """Name file -> (pos INT, name STRING) (S3)."""
    return _numbered_lines(spark, path).select(
        F.col("pos").cast("int").alias("pos"), F.trim("line").alias("name"))


def read_types(spark: SparkSession, path: str) -> DataFrame:
    """Type file -> (pos INT, code INT): first integer of each line."""
    return _numbered_lines(spark, path).select(
        F.col("pos").cast("int").alias("pos"),
        F.trim(F.split(F.col("line"), ",")[0]).cast("int").alias("code"))


def task_type(names: DataFrame, types: DataFrame, target: str) -> DataFrame:
    """Target lookup and task choice (S4 + S5).

    Returns one row (target, pos, code, task).  A target missing from the
    name file raises instead of silently using index -1.
    """
    want = one_row(names.sparkSession).select(F.lit(target).alias("name"))
    hit = want.join(names, "name", "left").join(types, "pos", "left")
    return hit.select(
        F.col("name").alias("target"),
        F.when(F.col("pos").isNull(),
               F.raise_error(F.lit(f"target {target!r} is not in the name file")))
        .otherwise(F.col("pos")).cast("int").alias("pos"),
        "code",
        F.when(F.col("code") == CLASSIFICATION_CODE, F.lit(CLASSIFICATION))
        .otherwise(F.lit(REGRESSION)).alias("task"))
