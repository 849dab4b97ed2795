"""Sample tables built from the driver's parquet tables (FIXTURES.md F1-F8).

Every builder reads whole tables; projections are explicit so the parquet
scan reads only the needed columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.session import one_row
from marginflow.sources.text import write_delimited

# fixed values of the planted model F7 and the planted ring label F3
PLANTED_C = 10.0
PLANTED_B = 0.05      # of the linear model only; the RBF one is centred on its rows
PLANTED_GAMMA = 0.5
PLANTED_ALPHA_MOD = 11
RING_RADIUS_SQ = 0.12
# lineitem rows shipped before this date are the training part, the rest held out
SPLIT_DATE = "1999-01-01"
# orders placed before this date form the training part of the priors fixtures
ORDERS_SPLIT_DATE = "1998-01-01"

LINEITEM_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
# type codes of F8 (1 = classification), as a user would write the type file
F8_TYPES = [2, 2, 2, 2, 1]
F2_NAMES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
F8_NAMES = F2_NAMES + ["in_ring"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# F1 ----------------------------------------------------------------------

def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, x ARRAY<DOUBLE>, label INT): 64-dim unit vectors."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("x"),
        F.col("label"))


def embeddings_y(label: Column | str = "label") -> Column:
    col = F.col(label) if isinstance(label, str) else label
    return F.when(col < 5, F.lit(1.0)).otherwise(F.lit(-1.0))


# F7 ----------------------------------------------------------------------

def planted_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embeddings row with planted multipliers: (id, x, label, y, alpha).

    alpha = C * (id % 11) / 10 covers alpha = 0, 0 < alpha < C and
    alpha = C, so every bound case appears.
    """
    return embeddings(spark, sf_dir).select(
        "id", "x", "label", embeddings_y().alias("y"),
        (F.lit(PLANTED_C) * (F.col("id") % PLANTED_ALPHA_MOD) / F.lit(10.0)).alias("alpha"))


def planted_support(rows: DataFrame) -> DataFrame:
    """Support of the planted model: of each class the row with the least id,
    with alpha = C * (label + 1) / 10 (free rows, and one at C).

    One aggregate with map-side partial results; the support size is the
    class count, so scoring every row against it is linear in the table."""
    first = rows.groupBy("label").agg(F.min(F.struct("id", "x")).alias("r"))
    return first.select("label", "r.id", "r.x", embeddings_y().alias("y"), planted_alpha().alias("alpha"))


def planted_alpha() -> Column:
    return F.lit(PLANTED_C) * (F.col("label") + F.lit(1)) / F.lit(10.0)


def holdout_flag() -> Column:
    """Every fifth id is held out (the reference's rows n..N); ids need not be
    dense."""
    return F.pmod(F.col("id"), F.lit(5)) == 4


# F2 / F3 / F8 ------------------------------------------------------------

def lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key columns + the four numeric columns, -0.0 normalised (F2)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *LINEITEM_KEY, "l_shipdate", "l_returnflag",
        F.col("l_quantity"), F.col("l_extendedprice"),
        (F.col("l_discount") + F.lit(0.0)).alias("l_discount"),
        (F.col("l_tax") + F.lit(0.0)).alias("l_tax"))


def ring_coordinates(df: DataFrame) -> DataFrame:
    """q = (l_quantity - 1) / 49 and d = l_discount / 0.1, both in [0, 1]."""
    return df.withColumn("q", (F.col("l_quantity") - F.lit(1.0)) / F.lit(49.0)) \
             .withColumn("d", F.col("l_discount") / F.lit(0.1) + F.lit(0.0))


def ring_label() -> Column:
    return F.when(
        (F.col("q") - F.lit(0.5)) * (F.col("q") - F.lit(0.5))
        + (F.col("d") - F.lit(0.5)) * (F.col("d") - F.lit(0.5)) < F.lit(RING_RADIUS_SQ),
        F.lit(1.0)).otherwise(F.lit(0.0))


def ring_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(keys, l_shipdate, x = [q, d], label 0/1); RBF-separable ring."""
    base = ring_coordinates(lineitem_features(spark, sf_dir))
    return base.select(*LINEITEM_KEY, "l_shipdate",
                       F.array("q", "d").alias("x"), ring_label().alias("label"))


def f8_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """F8 as files under ``path``: ``data`` (comma-separated with headers, keys
    first), ``names`` and ``types`` (one line per value column)."""
    base = ring_coordinates(lineitem_features(spark, sf_dir))
    write_delimited(base.select(*LINEITEM_KEY, *F2_NAMES, ring_label().alias("in_ring")), f"{path}/data")
    name_and_type_files(spark, path)


def name_and_type_files(spark: SparkSession, path: str) -> None:
    for name, lines in (("names", F8_NAMES), ("types", map(str, F8_TYPES))):
        one_row(spark).select(F.lit("\n".join(lines)).alias("value")).write.text(f"{path}/{name}")


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: F2 columns and the ring label joined by commas, keys kept aside."""
    base = ring_coordinates(lineitem_features(spark, sf_dir))
    vals = [F.col(c).cast("string") for c in F2_NAMES] + [ring_label().cast("string")]
    return base.select(*LINEITEM_KEY, "l_shipdate",
                       F.concat_ws(",", *vals).alias("value"))


def price_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, x = [price / max price + label], label): orders above the
    mean price are positive and shifted by 1, so the classes are separable by
    one threshold, and every distinct price is a distinct point."""
    orders = table(spark, sf_dir, "orders")
    st = orders.agg(F.struct(F.avg("o_totalprice").alias("mean"), F.max("o_totalprice").alias("top")).alias("s")) \
               .scalar()
    label = F.when(F.col("o_totalprice") > st["mean"], 1.0).otherwise(0.0)
    return orders.select("o_orderkey", label.alias("label"), (F.col("o_totalprice") / st["top"]).alias("v")) \
                 .select("o_orderkey", F.array(F.col("v") + F.col("label")).alias("x"), "label")


def status_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, cls, x, label): every order at the point of its status,
    O at 0 (positive), F and P at -m and m, where m is the mean price over the
    highest: three distinct points, an RBF fit with a closed form."""
    orders = table(spark, sf_dir, "orders")
    m = orders.agg((F.avg("o_totalprice") / F.max("o_totalprice")).alias("m")).scalar()
    cls = F.col("o_orderstatus")
    at = F.when(cls == "O", 0.0).when(cls == "F", -m).otherwise(m)
    return orders.select("o_orderkey", cls.alias("cls"), F.array(at).alias("x"),
                         F.when(cls == "O", 1.0).otherwise(0.0).alias("label"))


def price_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(keys, x = [q, d], label): a ring over quantity and price, both in
    [0, 1]; nearly every row is a distinct point."""
    li = table(spark, sf_dir, "lineitem").select(
        *LINEITEM_KEY, ((F.col("l_quantity") - 1.0) / 49.0).alias("q"), F.col("l_extendedprice").alias("price"))
    st = li.agg(F.struct(F.min("price").alias("lo"), F.max("price").alias("hi")).alias("s")).scalar()
    rows = li.withColumn("d", (F.col("price") - st["lo"]) / (st["hi"] - st["lo"]))
    return rows.select(*LINEITEM_KEY, F.array("q", "d").alias("x"), ring_label().alias("label"))


# F5 / F6 -----------------------------------------------------------------

def order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_orderdate, cls): three classes."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("cls"))


def regression_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_orderdate, label = o_totalprice, prediction = sum of
    the order's l_extendedprice).  Lineitem is pre-aggregated per order
    before the join, so the join shuffles one row per order."""
    per_order = (table(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey")
                 .agg(F.sum("l_extendedprice").alias("prediction")))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").alias("label"))
    return orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "inner") \
                 .select("o_orderkey", "o_orderdate", "label", "prediction")


def unit_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_orderdate, price, label = mean tax / 0.08, prediction =
    mean discount / 0.1): normalised values in [0, 1] and the raw price whose
    training range takes them back."""
    per_order = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
                 .agg((F.avg("l_tax") / F.lit(0.08)).alias("label"),
                      (F.avg("l_discount") / F.lit(0.1)).alias("prediction")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").alias("price"))
    return orders.join(per_order, orders.o_orderkey == per_order.l_orderkey).drop("l_orderkey")
