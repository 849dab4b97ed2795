"""The thin ``opN_<name>`` queries over the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm.byte_bpe import round_trip
from marginflow.llm.collocations import collocations
from marginflow.llm.common import read_table, scratch_path, sha256_joined, write_table
from marginflow.llm.decontamination import decontaminate
from marginflow.llm.language_id import fit_languages, held_out, identify_languages
from marginflow.llm import order_minhash as omh
from marginflow.llm.packing import pack
from marginflow.llm.pii import find_pii
from marginflow.llm.quality import fit_quality, score_quality
from marginflow.llm.secrets import find_secrets
from marginflow.llm.simhash import near_duplicates
from marginflow.llm.token_alignment import align_corpus
from marginflow.llm.token_files import read_token_files, write_token_files
from marginflow.llm.url_filter import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(read_table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "sequence_id", "offset")


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                          keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        sha256_joined("item_ids").alias("items_sha256"), "contaminated")


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def span_digests(spans, base_kinds: dict[str, str]):
    """Digest columns of an array of (kind, start, stop, base) in order."""
    def joined(arr):
        return F.transform(arr, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    base = F.filter(spans, lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [count(kind).alias(name) for name, kind in base_kinds.items()]
    return [*counts, sha256_joined(joined(base)).alias("base_sha256"),
            F.concat_ws(",", joined(spans)).alias("spans")]


#: fixed values: the rules of the contract
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS r(host, path, verdict)")
    return judge_urls(read_table(spark, sf_dir, "pages"), rules, keep=["page_id"])


@query
def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"), keep=["doc_id"], base_bits=False)
    return found.select("doc_id", *span_digests(F.col("secrets"), {
        "n_assign": "assign", "n_access": "access", "n_hex": "hex"}))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_languages(docs.filter(~held_out(F.col("doc_id"))))
    found = identify_languages(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = omh.with_next(omh.texts_of(read_table(spark, sf_dir, "documents")), "id", ["text"], "tie")
    rows = omh.with_next(write_table(omh.sketch_with_edit(texts), "sketches"), "id", ["sigs"], "tie")
    return rows.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_chars"), "edited_sha256",
        omh.fingerprint(F.col("sigs")).alias("fingerprint"),
        omh.fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        omh.likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        omh.likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", *span_digests(F.col("pii"), {
        "n_email": "email", "n_ip": "ip", "n_card": "card", "n_phone": "phone"}))


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = score_quality(docs.select("doc_id", "text", "source", "lang"), model, keep=["doc_id"])
    return scored.withColumns({"held_out": held_out(F.col("doc_id")), "keep": F.col("quality") >= 0.5})


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"), keep=["doc_id"])


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align_corpus(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.withColumnRenamed("groups", "groups_sha256")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))
