"""Language identification by nearest centroids.

A text is a vector of hashed 1- to 3-letter n-grams (letters lowered, other
characters as word ends), weighted by sublinear term frequency and inverse
document frequency and scaled to unit length.  Each language has several
centroids, found by spherical k-means over labelled rows; a text gets the
language of the centroid with the largest cosine, and is rejected if that
cosine is lower than any labelled text of a known language would have.

The model is fitted on a bounded, hash-chosen sample of labelled rows
(``rows_per_language``), spread over tasks; each k-means step is a Spark job
that returns sums per centroid.  All rows are then judged in one narrow map.

Edge cases: a null text, or one without letters, is ``und`` with score 0 and
is rejected; rows with a null label are not learned from, every other label
is learned, however many there are; without any
labelled row every text is ``und``, and only texts without letters are
rejected; repeated rows each get a row; a kept column named like a result
gives way to it.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.llm.common import map_texts, share, write_table

#: Bound of the fit: labelled rows per language.
ROWS_PER_LANGUAGE = 3000
CENTROIDS = 3
ROUNDS = 6
#: A centroid with a smaller share of its language's rows is dropped.
MIN_SHARE = 0.05
#: A cosine is too low below this part of the 0.1 % quantile of labelled rows
#: (short texts have low cosines, but not as low as other scripts).
REJECT_PART, REJECT_QUANTILE = 0.25, 0.001
#: Centroids whose sums a task holds before it passes them on (64 MB).
HELD_CENTROIDS = 2048
_BITS = 13
DIMS = 1 << _BITS
_CHUNK = 1 << 20
_WORDS = re.compile(r"[^\W\d_]+")


def ngram_counts(text: str | None):
    """Counts of the text's hashed n-grams; None without a letter."""
    import numpy as np
    words = _WORDS.findall(text.lower()) if text else []
    if not any(c.isalpha() for w in words for c in w):
        return None
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), "<u4")
    counts = np.zeros(DIMS, np.int64)
    mix, shift = np.uint32(0x9E3779B1), np.uint32(32 - _BITS)
    for at in range(0, len(codes), _CHUNK):
        c = codes[at:at + _CHUNK + 2]
        last = at + _CHUNK >= len(codes)
        h = c * np.uint32(0x85EBCA6B)
        for n in range(1, 4):
            own = h[:len(h) if last else min(len(h), _CHUNK)]
            counts += np.bincount((own * mix) >> shift, minlength=DIMS)
            if len(c) > n:
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0xC2B2AE35) + c[n:]
            else:
                break
    return counts


@dataclass
class LanguageModel:
    languages: list[str]
    owner: object       # per centroid, the place of its language
    centroids: object   # (DIMS, number of centroids), unit columns
    idf: object         # (DIMS,)
    reject_below: float

    def weigh(self, counts):
        """Non-zero places and unit TF-IDF weights of n-gram counts."""
        import numpy as np
        at = np.flatnonzero(counts)
        w = (1 + np.log(counts[at])) * self.idf[at]
        return at, (w / np.sqrt(w @ w)).astype(np.float32)


def _sample(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, rows: int) -> DataFrame:
    """(lang, text, rank) of about ``rows`` rows of each language.

    The share taken of each language is a constant map in the plan: as large
    as the model's list of languages."""
    known = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")) \
        .withColumn(lang_col, F.col(lang_col).cast("string"))
    sizes = known.groupBy(F.col(lang_col).alias("lang")).count().collect()
    table = json.dumps({r["lang"]: min(1.0, rows / r["count"]) for r in sizes})
    rank = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 40)) / float(1 << 40)
    share = F.element_at(F.from_json(F.lit(table), "map<string,double>"), F.col(lang_col))
    return known.filter(rank < share).select(F.col(lang_col).alias("lang"),
                                             F.col(text_col).alias("text"), rank.alias("rank"))


def fit_languages(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
                  rows_per_language: int = ROWS_PER_LANGUAGE, centroids: int = CENTROIDS,
                  rounds: int = ROUNDS) -> LanguageModel | None:
    """Fit on a bounded sample of the labelled rows; None without any."""
    import numpy as np

    def features():
        import pyarrow as pa

        def run(texts):
            at, tf = [], []
            for t in texts:
                c = ngram_counts(t)
                k = np.flatnonzero(c) if c is not None else np.empty(0, np.int64)
                at.append(k.astype("<u2").tobytes())
                tf.append(c[k].astype("<i4").tobytes() if len(k) else b"")
            return [pa.array(at, pa.binary()), pa.array(tf, pa.binary())]
        return run

    sample = _sample(labelled, text_col, lang_col, id_col, rows_per_language)
    grams = write_table(map_texts(sample, "text", ["lang", "rank"], [
        T.StructField("at", T.BinaryType()), T.StructField("n", T.BinaryType())], features)
        .filter("length(at) > 0"), "language-sample").coalesce(16)

    def gather(job, schema: str):
        return grams.mapInArrow(job, schema).collect()

    def count_job(batches):
        import pyarrow as pa
        df, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for raw in b.column("at").to_pylist():
                df[np.frombuffer(raw, "<u2")] += 1
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([df.tobytes()], pa.binary())], names=["n", "df"])

    counted = gather(count_job, "n long, df binary")
    rows = sum(r["n"] for r in counted)
    if not rows:
        return None
    df = sum(np.frombuffer(r["df"], np.int64) for r in counted)
    idf = np.log((1 + rows) / (1 + df)) + 1

    def vector(r) -> object:
        v = np.zeros(DIMS, np.float32)
        at = np.frombuffer(r["at"], "<u2")
        w = (1 + np.log(np.frombuffer(r["n"], "<i4"))) * idf[at]
        v[at] = w / np.sqrt(w @ w)
        return v

    from pyspark.sql import Window
    seeds = grams.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "at"))) \
                 .filter(F.col("k") <= centroids).orderBy("lang", "k").collect()
    languages = sorted({r["lang"] for r in seeds})
    owner = np.array([languages.index(r["lang"]) for r in seeds])
    model = LanguageModel(languages, owner, np.stack([vector(r) for r in seeds], axis=1), idf, 0.0)
    spark = labelled.sparkSession

    def step_job(shared, last: bool):
        def run(batches):
            import pyarrow as pa
            m = shared()
            place = {lang: i for i, lang in enumerate(m.languages)}
            sums: dict[int, object] = {}
            size, best = np.zeros(len(m.owner), np.int64), []

            def passed():
                out = pa.RecordBatch.from_arrays([
                    pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary()),
                    pa.array([int(size[k]) for k in sums], pa.int64())], names=["centroid", "sum", "size"])
                sums.clear()
                size[:] = 0
                return out
            for b in batches:
                for lang, at, n in zip(b.column("lang").to_pylist(), b.column("at").to_pylist(),
                                       b.column("n").to_pylist()):
                    at = np.frombuffer(at, "<u2")
                    w = (1 + np.log(np.frombuffer(n, "<i4"))) * m.idf[at]
                    w = (w / np.sqrt(w @ w)).astype(np.float32)
                    cos = w @ m.centroids[at]
                    if last:
                        best.append(float(cos.max()))
                    k = int(np.argmax(np.where(m.owner == place[lang], cos, -1)))
                    size[k] += 1
                    if not last:
                        sums.setdefault(k, np.zeros(DIMS, np.float32))[at] += w
                    if len(sums) >= HELD_CENTROIDS:
                        yield passed()
            if last:
                sums[0] = np.asarray(best, np.float32)
            yield passed()
        return run

    def add(table):
        """One row per centroid: the driver gets the model's size, not a part of it per task."""
        import pyarrow as pa
        total = sum(np.frombuffer(v, np.float32) for v in table.column("sum").to_pylist())
        return pa.table({"centroid": table.column("centroid")[:1], "sum": pa.array([total.tobytes()], pa.binary()),
                         "size": pa.array([sum(table.column("size").to_pylist())], pa.int64())})

    schema = "centroid int, sum binary, size long"
    for step in range(rounds):
        counted = grams.mapInArrow(step_job(share(spark, model), False), schema)
        got = counted.groupBy("centroid").applyInArrow(add, schema).collect()
        size, sums = np.zeros(len(model.owner), np.int64), np.zeros((DIMS, len(model.owner)), np.float32)
        for r in got:
            size[r["centroid"]], sums[:, r["centroid"]] = r["size"], np.frombuffer(r["sum"], np.float32)
        of_language = np.bincount(model.owner, weights=size, minlength=len(languages))
        kept = size >= (MIN_SHARE if step == rounds - 1 else 0) * of_language[model.owner]
        kept &= size > 0
        norm = np.sqrt((sums[:, kept] ** 2).sum(axis=0))
        model = LanguageModel(languages, model.owner[kept], (sums[:, kept] / norm).astype(np.float32), idf, 0.0)
    best = np.concatenate([np.frombuffer(r["sum"], np.float32)
                           for r in gather(step_job(share(spark, model), True), schema)])
    model.reject_below = REJECT_PART * float(np.quantile(best, REJECT_QUANTILE))
    return model


def identify_languages(docs: DataFrame, model: LanguageModel | None, keep: list[str] | None = None,
                       text_col: str = "text") -> DataFrame:
    """Kept columns (default: all) and lang_pred, score (the largest cosine,
    0 to 1) and rejected."""
    shared = share(docs.sparkSession, model)

    def make():
        import numpy as np
        import pyarrow as pa
        m = shared()

        def one(text):
            counts = ngram_counts(text)
            if counts is None or m is None:
                return "und", 0.0, counts is None
            at, w = m.weigh(counts)
            cos = w @ m.centroids[at]
            k = int(np.argmax(cos))
            score = min(1.0, max(0.0, float(cos[k])))
            return m.languages[m.owner[k]], score, score < m.reject_below

        def run(texts):
            found = [one(t) for t in texts]
            return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.bool_())]
        return run

    return map_texts(docs, text_col, docs.columns if keep is None else keep, [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())], make)


def held_out(id_col: Column) -> Column:
    """The documents never learned from: crc32 of the id's text is 1 modulo 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))
