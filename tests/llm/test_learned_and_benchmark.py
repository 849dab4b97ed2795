"""Benchmark decontamination (op 3), quality (op 5), language ID (op 9)."""

import random
import re

import numpy as np
import pytest

from marginflow.llm import quality
from marginflow.llm.decontamination import decontaminate
from marginflow.llm.language_id import fit_languages, identify_languages, ngram_counts
from marginflow.llm.queries import QUERIES
from tests.llm.helpers import SF, docs

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute_hits(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else ()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block_chars", [10**6, 150])
def test_decontamination_against_brute_force(spark, block_chars):
    rng = random.Random(6)
    vocab = ["the", "of", "é", "ÑA", "b1", "zz", "Q"]

    def say(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 2, 4, 9, 10, 11, 25]))) for i in range(25)] + [(25, None), (26, "...")]
    items.append((27, items[7][1]))
    texts = [None, "", "...", *[say(rng.randint(1, 60)) for _ in range(40)],
             *[say(30) + " " + items[i][1] + "-" + say(5) for i in range(25)]]
    texts += texts[-3:]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_words int")
    got = decontaminate(docs(spark, texts).selectExpr("*", "1 AS n_hit"), bench, block_chars=block_chars)
    for r in got.collect():
        n, hit, found = brute_hits(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == (n, hit, found)
        assert r["n_items"] == len(found) and r["contaminated"] == (hit > 0)
        assert sum(s["stop"] - s["start"] for s in r["hit_spans"]) == hit
    assert decontaminate(docs(spark, texts), bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate(docs(spark, texts).limit(0), bench).count() == 0


def test_short_item_and_long_document(spark):
    bench = spark.createDataFrame([(1, "needle"), (2, "two words")], "item_id long, text string")
    text = "hay " * 100_000 + "Needle, TWO\nwords " + "hay " * 10
    r = decontaminate(docs(spark, [text]), bench).first()
    assert (r["n_words"], r["n_hit"], r["item_ids"]) == (100_013, 3, ["1", "2"])


LANGS = {"en": "the of and to in that was for with his they are this have from one had word but not what",
         "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden",
         "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont été à"}


def lang_docs(spark, n=120):
    rng, rows = random.Random(8), []
    for i in range(n):
        lang = list(LANGS)[i % 3]
        rows.append((i, " ".join(rng.choices(LANGS[lang].split(), k=rng.randint(20, 80))), lang))
    return rows


def test_languages_on_a_small_table(spark):
    rows = lang_docs(spark)
    schema = "doc_id long, text string, lang string"
    train = spark.createDataFrame(rows[:90] + [(900, None, "en"), (901, "und so weiter", None), (902, "123", "fr")], schema)
    model = fit_languages(train)
    assert sorted(model.languages) == ["de", "en", "fr"] and model.centroids.shape[1] <= 9
    test = rows[90:] + [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 ²", "en"), (1003, "汉字汉语" * 30, "zh"),
                        (1004, "the", "en"), (1005, "the of and " * 50_000, "en"), (1005, "the of and ", "en")]
    df = spark.createDataFrame(test, schema).selectExpr("*", "1 AS score")
    got = {r["doc_id"]: r for r in identify_languages(df, model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[90:])
    assert not any(got[i]["rejected"] for i, _, _ in rows[90:])
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all((got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True) for i in (1000, 1001, 1002))
    assert got[1003]["rejected"] and got[1003]["lang_pred"] in LANGS
    assert got[1004]["lang_pred"] == "en" and got[1005]["lang_pred"] == "en"
    assert fit_languages(train.limit(0)) is None
    assert {r["lang_pred"] for r in identify_languages(df, None).collect()} == {"und"}


def test_every_label_is_learned_however_many(spark, monkeypatch):
    """300 labels, a third of the rows with one of them; sums passed on early."""
    from marginflow.llm import language_id
    monkeypatch.setattr(language_id, "HELD_CENTROIDS", 7)
    rng, rows = random.Random(4), []
    for k in range(300):
        alphabet = [chr(rng.choice([97, 0x3b1, 0x430, 0x561]) + rng.randrange(22)) for _ in range(5)]
        words = ["".join(rng.choices(alphabet, k=rng.randint(3, 7))) for _ in range(12)]
        for _ in range(4 if k else 600):
            rows.append((len(rows), " ".join(rng.choices(words, k=25)), f"l.{k}'\""))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    model = fit_languages(df, rows_per_language=50)
    assert len(model.languages) == 300
    got = {r["doc_id"]: r["lang_pred"] for r in identify_languages(df, model, ["doc_id"]).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) > 0.98 * len(rows)
    assert len(set(got.values())) > 295


def test_the_nearest_centroid_wins(spark):
    """Every prediction against a loop over dense vectors and all centroids."""
    rows = lang_docs(spark, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_languages(df.filter("doc_id < 45"))
    for r in identify_languages(df, model).collect():
        counts = ngram_counts(r["text"])
        v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0) * model.idf
        cos = [float(v @ c / np.linalg.norm(v) / np.linalg.norm(c)) for c in model.centroids.T]
        best = int(np.argmax(cos))
        assert r["lang_pred"] == model.languages[model.owner[best]]
        assert r["score"] == pytest.approx(cos[best], abs=1e-5)
        assert r["rejected"] == (r["score"] < model.reject_below)


def test_ngram_counts_in_pieces(monkeypatch):
    from marginflow.llm import language_id
    text = "Straße und Ñandú, " * 50
    whole = ngram_counts(text)
    for size in (3, 7, 64, 900):
        monkeypatch.setattr(language_id, "_CHUNK", size)
        assert np.array_equal(ngram_counts(text), whole)


def test_language_query_on_held_out_rows(spark):
    got = QUERIES["op9_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 200 and len(held) > 40
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.97


def test_quality_query_on_held_out_labels(spark):
    got = QUERIES["op5_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed(
        "quality", "label"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["keep"] == (r["label"] == 1) for r in held]) >= 0.9


def test_views_teach_each_other():
    """The page view alone has too few labels; pseudo-labels of the text view help it."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 3000).astype(float)
    text = np.column_stack([y * 4 + rng.normal(size=3000), rng.normal(size=3000)])
    page = np.column_stack([y * 2 + rng.normal(size=3000), *rng.normal(size=(12, 3000))])
    few = 24
    alone = quality.co_train(text[:few], page[:few], y[:few], text[few:few], page[few:few])
    taught = quality.co_train(text[:few], page[:few], y[:few], text[few:2000], page[few:2000])

    def right(model):
        return np.mean((model.page.logit(page[2000:]) >= 0) == (y[2000:] == 1))
    assert right(taught) > right(alone) and right(taught) > 0.8


def test_quality_edges(spark):
    texts = [None, "", "the cat sat on the mat\n" * 3, "x" * 100_000, "a b c", "a b c"]
    df = docs(spark, texts, [0, 1, 2, 3, 4, 4]).selectExpr("*", "0 AS quality")
    labels = spark.createDataFrame([(0, 1), (2, None), (None, 0), (4, 1), (4, 1)], "doc_id long, quality int")
    model = quality.fit_quality(df.drop("quality"), labels)
    assert model.text is None and model.prior == 1.0
    assert {r["quality"] for r in quality.score_quality(df, model).collect()} == {1.0}
    none = quality.fit_quality(df.drop("quality").limit(0), labels.limit(0))
    assert none.prior == 0.5 and quality.score_quality(df.limit(0), none).count() == 0
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    many = docs(spark, ["Good words here. " * 5 if i % 2 else "#$%& " * 9 for i in range(40)])
    scored = quality.score_quality(many, quality.fit_quality(many, labels)).collect()
    assert all((r["quality"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in scored)
