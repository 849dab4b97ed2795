"""The corpus pipeline and the registry of the training-data queries."""

import corpus_pipeline as cp
from __spark_entry__ import oracle_sql, queries
from marginflow.llm.common import scratch_path
from marginflow.llm.pii import redact
from tests.llm.helpers import SF, docs, texts_of
from tests.llm.test_learned_and_benchmark import brute_hits
from tests.llm.test_near_and_prints import brute_components, brute_print


def test_registry():
    names = queries()
    assert [n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()] .__len__() == 13
    assert "pipeline" in names and {"op3_benchmark_decontamination", "op7_url_filters",
                                    "op11_collocations"} <= set(oracle_sql())
    assert [n for n, _ in cp.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "pii",
                                         "best_fit_packing"]


def stages(spark, df, sf_dir=SF):
    """The result of each stage, written and read as run() does."""
    out = []
    for name, f in cp.STAGES:
        path = scratch_path(spark, name)
        f(spark, df, sf_dir).write.parquet(path)
        df = spark.read.parquet(path)
        out.append(df)
    return out


def test_stages_against_brute_force(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    lang, near, clean, private, packed = stages(spark, base)
    assert lang.columns == near.columns == clean.columns == private.columns == base.columns
    texts = texts_of(spark)
    kept = sorted(r["doc_id"] for r in lang.collect())
    assert len(kept) == len(texts)  # every document here has a known language
    one = sorted(set(brute_components(kept, [brute_print(texts[i]) for i in kept])))
    assert sorted(r["doc_id"] for r in near.collect()) == one
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    free = [i for i in one if not brute_hits(texts[i], items)[1]]
    assert sorted(r["doc_id"] for r in clean.collect()) == free and 0 < len(free) < len(one)
    for r in private.collect():
        assert r["n_chars"] == len(r["text"])
        if r["text"] != texts[r["doc_id"]]:
            assert "[" in r["text"]
    assert sorted({r["doc_id"] for r in packed.collect()}) == free
    assert redact is not None


def test_pipeline_keeps_odd_rows_whole(spark):
    text = "The heon thre of and in that was. " * 20
    rows = docs(spark, [None, "", "1234", text, text, text + "mail a@b.co", "Der heon und die " * 30, text],
                [1, 2, 3, 5, 5, None, 7, 8])
    df = rows.selectExpr("*", "1 AS score", "2 AS fp", "3 AS rejected", "4 AS c1", "5 AS pii", "6 AS n_hit")
    lang, near, clean, private, packed = stages(spark, df)
    assert private.columns == df.columns
    assert sorted(r["doc_id"] or 0 for r in lang.collect()) == [0, 5, 5, 7, 8]
    assert sorted(r["doc_id"] for r in near.collect()) == [5, 7]
    assert {r["doc_id"] for r in packed.collect()} == {5, 7}
    for out in stages(spark, df.limit(0)):
        assert out.count() == 0


def test_near_dedup_with_null_and_repeated_ids(spark):
    texts = [" ".join(f"{w}{i}" for i in range(60)) for w in "abcdefg"]
    a, b, c, d, e, f, g = texts
    rows = [(None, a), (None, b), (None, c), (None, d), (9, d), (5, e), (5, f), (3, e), (5, f), (None, g), (None, g)]
    near = cp.near_dedup(spark, docs(spark, [t for _, t in rows], [i for i, _ in rows]), SF)
    assert {(r["doc_id"], r["text"]) for r in near.collect()} == {
        (None, a), (None, b), (None, c), (9, d), (3, e), (5, f), (None, g)}
    assert near.count() == 7 and near.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_without_labels_texts_with_letters_stay(spark):
    rows = docs(spark, ["some prose without a label", None, "12 34", "汉字"], lang=None)
    kept = cp.language_id(spark, rows, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3] and kept.columns == rows.columns
