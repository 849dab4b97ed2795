"""A training corpus from ``documents``: language ID, SimHash near-duplicates,
benchmark decontamination, personal data, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet to the shared checkpoint folder and
read again for the next.  All but the last return the columns of documents.
A stage renames the columns by position while an operator works on them, so
that no column of the documents can clash with a result.

Edge cases: rows without text or letters go with the language stage; of each
group of near-duplicate texts one row stays, whatever ids are null or
repeated; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.llm.common import read_table, scratch_path, write_table
from marginflow.llm.decontamination import decontaminate
from marginflow.llm.language_id import fit_languages, held_out, identify_languages
from marginflow.llm.packing import pack
from marginflow.llm.pii import find_pii, redact
from marginflow.llm.simhash import surplus_rows

#: Dropped row numbers that are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def _positional(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(new).alias(old) for old, new in names.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: no other scripts, no junk without
    letters.  Where no row has a label, all texts with letters stay."""
    own, n = _positional(docs)
    model = fit_languages(own.filter(~held_out(F.col(n["doc_id"]))), n["text"], n["lang"], n["doc_id"])
    return _named(identify_languages(own, model, text_col=n["text"]).filter("not rejected"), n)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the least id (nulls last;
    ties by a hash of the row).  Rows are told apart by a written row number."""
    own, n = _positional(docs)
    plain = [f.name for f in own.schema if isinstance(f.dataType, T.AtomicType)]
    rows = write_table(own.withColumns({"row": F.monotonically_increasing_id(), "hash": F.xxhash64(*plain)}), "rows")
    dropped = write_table(surplus_rows(rows, "row", [n["doc_id"], "hash"], text_col=n["text"]), "surplus")
    if dropped.count() <= BROADCAST_IDS:
        dropped = F.broadcast(dropped)
    return _named(rows.join(dropped, "row", "left_anti"), n)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    own, n = _positional(docs)
    found = decontaminate(own, read_table(spark, sf_dir, "benchmark"), text_col=n["text"])
    return _named(found.filter("not contaminated"), n)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows."""
    own, n = _positional(docs)
    found = find_pii(own, text_col=n["text"])
    found = found.withColumn(n["text"], redact(F.col(n["text"]), F.col("pii")))
    if "n_chars" in n:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn(n["n_chars"], F.when(F.size("pii") > 0, F.length(n["text"]).cast(kind))
                                 .otherwise(F.col(n["n_chars"])))
    return _named(found, n)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece with its ids and its place."""
    return pack(docs)


STAGES = [("language_id", language_id), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontamination), ("pii", personal_data),
          ("best_fit_packing", packing)]

#: The language, fingerprint and packing stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
