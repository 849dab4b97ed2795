"""Fixtures and brute-force versions for the training-data operators."""

from __future__ import annotations

import hashlib
import re

SF = "/root/testdata/sf0.001"

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None, lang="en"):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, lang, "s", len(t or "")) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOC)


def texts_of(spark, sf=SF):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


# the contract's formats as they are written there
PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
SECRETS = {"assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
           "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def _valid(kind, m):
    d = re.sub("[^0-9]", "", m.group())
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
            "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15,
            "assign": lambda: len(m[2]) >= 6, "access": lambda: len(m.group()) >= 20,
            "hex": lambda: len(m.group()) >= 24}[kind]()


def brute_spans(text, patterns):
    kinds = list(patterns)
    out = [(m.start(), kinds.index(k), m.end()) for k, p in patterns.items()
           for m in re.finditer(p, text) if _valid(k, m)]
    return [f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(out)]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()
