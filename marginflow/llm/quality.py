"""Quality classifier by co-training two views of a document.

The text view sees the words and characters; the page view sees metadata
(source and language, hashed), size and layout (lines, their lengths and
repeats).  Both are ridge-penalised logistic models.  Rounds: each is fitted
on the labelled rows and the pseudo-labels it was given, calibrated on
labelled rows kept apart, and hands the unlabelled rows it is most sure of to
the other.  A last logistic model combines the calibrated views, and one
narrow map scores every document.

Fitting uses bounded, hash-chosen samples (``LABELLED`` labelled and ``POOL``
unlabelled rows, ``MOVED`` pseudo-labels of a class a round), only their
features reach the driver; features and scores of all documents are computed
in tasks.

Edge cases: null and empty texts have features of zero length and are scored
like others; null labels are dropped, repeated ones of an id averaged; with
fewer than two classes labelled every score is the share of that class (0.5
without any); repeated rows each get a row; kept columns named like a result
give way to it.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.llm.common import map_texts, share

LABELLED, POOL, MOVED = 20_000, 20_000, 1_000
ROUNDS = 4
#: Calibrated probability from which a view hands a row to the other.
CONFIDENT = 0.95
HASHED = 32
_TEXT, _LAYOUT = 13, 6


def _classes():
    """Byte -> class: letter, digit, blank, sentence mark, other ASCII mark, upper, UTF-8 part."""
    import numpy as np
    out = np.full(256, 6, np.uint8)
    for b in range(128):
        c = chr(b)
        out[b] = (5 if c.isupper() else 0 if c.isalpha() else 1 if c.isdigit() else 2 if c.isspace()
                  else 3 if c in ".,;:!?'\"-()" else 4)
    return out


def text_features(text: str, classes) -> list[float]:
    import numpy as np
    raw = np.frombuffer(text.encode(), np.uint8)
    share = np.bincount(classes[raw], minlength=7) / max(1, len(raw))
    words = text.split()
    n = max(1, len(words))
    distinct = set(words)
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    return [*share.tolist(), float(np.log1p(n)), float(sizes.mean()), float(sizes.max() ** 0.5),
            len(distinct) / n, float((sizes <= 3).mean()), sum(w.isupper() for w in distinct) / max(1, len(distinct))]


def layout_features(text: str) -> list[float]:
    import math
    lines = text.split("\n")
    filled = [x for x in lines if x.strip()]
    sizes = list(map(len, filled)) or [0]
    return [math.log1p(len(text)), math.log1p(len(lines)), math.log1p(sum(sizes) / len(sizes)), math.log1p(max(sizes)),
            1 - len(set(filled)) / max(1, len(filled)), 1 - len(filled) / max(1, len(lines))]


@dataclass
class View:
    """A standardised logistic model with its calibration."""
    mean: object
    scale: object
    weights: object
    calibration: tuple[float, float] = (1.0, 0.0)

    def logit(self, x):
        import numpy as np
        z = ((x - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]
        return np.clip(self.calibration[0] * z + self.calibration[1], -30, 30)


@dataclass
class QualityModel:
    text: View | None
    page: View | None
    combine: object
    prior: float


def _logistic(x, y, ridge: float = 1e-2, steps: int = 25):
    """Newton steps for logistic weights, the intercept first."""
    import numpy as np
    x = np.column_stack([np.ones(len(x)), x])
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * len(x))
    keep[0] = 1e-6 * len(x)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + keep * w
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _fit_view(x, y, xc, yc) -> View:
    """Fit on (x, y), calibrate on (xc, yc)."""
    import numpy as np
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    view = View(mean, scale, _logistic((x - mean) / scale, y))
    if len(set(yc)) == 2:
        b, a = _logistic(view.logit(xc)[:, None], yc, 1e-3)
        view.calibration = (float(a), float(b))
    return view


def _sigmoid(z):
    import numpy as np
    return 1 / (1 + np.exp(-z))


def co_train(xt, xp, y, ut, up, rounds: int = ROUNDS, moved: int = MOVED, confident: float = CONFIDENT) -> QualityModel:
    """Models from labelled (text and page features, labels) and unlabelled rows."""
    import numpy as np
    prior = float(y.mean()) if len(y) else 0.5
    if len(y) < 6 or len(set(y.tolist())) < 2:
        return QualityModel(None, None, None, prior)
    apart = np.arange(len(y)) % 3 == 0  # rows come in hash order
    if len(set(y[~apart].tolist())) < 2:
        apart[:] = False
    xs, us = (xt, xp), (ut, up)
    given = ({}, {})  # per view: unlabelled row -> pseudo-label
    cal = apart if apart.any() else ~apart
    for step in range(rounds + 1):
        views = []
        for v in (0, 1):
            rows = np.fromiter(given[v], np.int64, len(given[v]))
            views.append(_fit_view(np.vstack([xs[v][~apart], us[v][rows]]),
                                   np.concatenate([y[~apart], np.fromiter(given[v].values(), np.float64, len(rows))]),
                                   xs[v][cal], y[cal]))
        if step == rounds or not len(ut):
            break
        for v in (0, 1):
            p, other = _sigmoid(views[v].logit(us[v])), given[1 - v]
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                order = np.argsort(-sure, kind="stable")
                new = [i for i in order[sure[order] >= confident].tolist() if i not in other][:moved]
                other.update(dict.fromkeys(new, label))
    both = np.column_stack([views[v].logit(xs[v][cal]) for v in (0, 1)])
    return QualityModel(*views, _logistic(both, y[cal], 1e-3), prior)


def _features(docs: DataFrame, keep: list[str], text_col: str, meta_cols: list[str], name: str) -> DataFrame:
    """Adds an array of text features, layout features and hashed metadata."""
    places = [F.pmod(F.xxhash64(F.lit(c), F.col(f"`{c}`").cast("string")), F.lit(HASHED)) for c in meta_cols]
    rows = docs.withColumn("__meta", F.array(*places) if places else F.array().cast("array<bigint>"))

    def make():
        import numpy as np
        import pyarrow as pa
        classes = _classes()

        def run(texts):
            out = [text_features(t or "", classes) + layout_features(t or "") for t in texts]
            flat = np.asarray(out, np.float64).reshape(len(texts), _TEXT + _LAYOUT)
            return [pa.array(list(flat), pa.list_(pa.float64()))]
        return run

    return map_texts(rows, text_col, [*keep, "__meta"], [T.StructField(name, T.ArrayType(T.DoubleType()))], make)


def _split(features, meta):
    """Arrays of the two views from feature and metadata rows."""
    import numpy as np
    x = np.asarray(features, np.float64).reshape(-1, _TEXT + _LAYOUT)
    hashed = np.zeros((len(x), HASHED))
    for row, places in enumerate(meta):
        hashed[row, list(places)] = 1
    return x[:, :_TEXT], np.column_stack([x[:, _TEXT:], hashed])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", meta_cols: tuple[str, ...] = ("source", "lang"),
                labelled: int = LABELLED, pool: int = POOL) -> QualityModel:
    import numpy as np
    meta = [c for c in meta_cols if c in docs.columns]
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.round(F.avg(label_col)).alias("label"))

    def rank(*cols):
        return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)
    chosen = known.filter(rank(F.lit("l"), id_col) < min(1.0, labelled / max(1, known.count())))
    rows = docs.select(id_col, text_col, *meta)
    pooled = rows.filter(rank(F.lit("u"), id_col, text_col) < min(1.0, pool / max(1, docs.count())))
    # about ``labelled`` rows of 16 bytes, by their choice above
    with_label = rows.join(F.broadcast(chosen), id_col)
    got = _features(with_label, [id_col, "label"], text_col, meta, "features").collect()
    free = _features(pooled.join(known, id_col, "left_anti"), [id_col], text_col, meta, "features").collect()
    for part in (got, free):  # an order that does not depend on the tasks
        part.sort(key=lambda r: (zlib.crc32(str(r[id_col]).encode()), r["features"]))
    xt, xp = _split([r["features"] for r in got], [r["__meta"] for r in got])
    ut, up = _split([r["features"] for r in free], [r["__meta"] for r in free])
    return co_train(xt, xp, np.asarray([r["label"] for r in got], np.float64), ut, up)


def score_quality(docs: DataFrame, model: QualityModel, keep: list[str] | None = None, text_col: str = "text",
                  meta_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Kept columns (default: all) and text_score, page_score, quality (the
    combined score; each 0 to 1)."""
    names = ("text_score", "page_score", "quality")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    rows = _features(docs, keep, text_col, [c for c in meta_cols if c in docs.columns], "__features")
    shared = share(docs.sparkSession, model)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, T.DoubleType()) for n in names])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        m = shared()
        for batch in batches:
            n = batch.num_rows
            if m.text is None or not n:
                scores = [np.full(n, m.prior)] * 3
            else:
                xt, xp = _split(batch.column(len(keep) + 1).flatten().to_numpy(), batch.column(len(keep)).to_pylist())
                a, b = m.text.logit(xt), m.page.logit(xp)
                z = m.combine[0] + m.combine[1] * a + m.combine[2] * b
                scores = [_sigmoid(a), _sigmoid(b), _sigmoid(np.clip(z, -30, 30))]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))]
                                             + [pa.array(s, pa.float64()) for s in scores],
                                             names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)
