"""Personal data by weak supervision, DataFrame functions only.

Fixed formats (``base`` spans) are always kept.  Looser candidates - spelled
e-mail signs, IPv6 whole or with ``::``, numbers like cards with a wrong check
digit, phone numbers without a country code, bank account numbers (``iban``)
and national ids (``id``) - are kept if a span classifier says so:

1. labelers vote on every candidate (1, -1 or 0 for no opinion): the format
   with its checks, a gazetteer (top-level domains, address ranges, card
   issuers, country and area codes), cue words before the span (in a list of
   spans: before the list), and the characters around it;
2. expectation-maximisation over the counts of vote patterns estimates each
   labeler's reliability and each pattern's probability;
3. a logistic classifier over votes and span features is trained on those
   probabilities, and applied to all candidates as one SQL expression.

The candidates are found once and written; the driver sees only pattern
counts, whose number is bounded by the votes and features, not by the data.
Positions come from the gaps between matches (``split`` and
``regexp_extract_all`` find the same ones), summed in blocks.

Edge cases: a null text is an empty one; repeated rows each get a row; an
empty table, or one without candidates, gives an empty result and an unused
classifier; kept columns named ``pii`` give way to the result.  Matches that
start at the same place are ordered by kind.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import write_table

KINDS = ("email", "ip", "card", "phone", "iban", "id")
#: Least probability of a looser candidate.
MIN_PROBABILITY = 0.9
EM_ROUNDS, FIT_ROUNDS = 50, 500
#: Reliability a labeler is thought to have before any vote, and its weight.
PRIOR_RIGHT, PRIOR_WRONG = 8.0, 2.0

# fixed values: the four formats, in a form that the matcher runs through once
# (runs are taken whole, and a run that fails is not tried again from inside)
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+"
             r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![\p{L}\p{N}_:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
          r"|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}+)?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}+)?)(?![\p{L}\p{N}_:])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,}+",
    "phone": r"(?<![0-9+])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# a text without these has no match
HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# gazetteers
DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|co|me|de|fr|es|it|uk|us|ca|nl|be|ch|at|se|no|dk|fi|pl|pt|ru|jp|cn|in|br|mx|au|eu"
RESERVED = r"^0*(?:0|10|127|22[4-9]|2[3-5][0-9])\.|^0*192\.0*168\.|^0*172\.0*(?:1[6-9]|2[0-9]|3[01])\.|^0*169\.0*254\."
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[4-8]|6011|65)"
AREAS = r"^\(?[2-9][0-8][0-9]\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$"
IPV6 = r"(?i)^(?:[23][0-9a-f]{3}:|fe[89ab][0-9a-f]:|f[cd][0-9a-f]{2}:|64:ff9b:|::ffff:|::1$)"
IBAN_LANDS = "AD|AE|AL|AT|BA|BE|BG|BH|BR|CH|CR|CY|CZ|DE|DK|DO|EE|ES|FI|FO|FR|GB|GE|GI|GL|GR|HR|HU|IE|IL|IS|IT|JO|KW|KZ|LB|LI|LT|LU|LV|MC|MD|ME|MK|MT|NL|NO|PK|PL|PS|PT|QA|RO|RS|SA|SE|SI|SK|SM|TN|TR|UA|XK"
#: what may stand between the members of a list
LISTED = r"(?i)^[\s,;/&|]*(?:(?:and|or|und|oder|et|ou|y|o)\s+)?$"
COUNTRIES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CUES = {
    "email": (r"e-?mails?|mail(?:to)?|contact|write|reach|address|adresse|correo|courriel", r"example|npm|version"),
    "ip": (r"\bip\b|ipv[46]|\bhost|server|address|adresse|login from|client", r"version|\bv|release|section|chapter"),
    "card": (r"card|visa|master|amex|credit|debit|payment|pay|karte|tarjeta|carte", r"isbn|order|invoice|tracking|serial"),
    "iban": (r"iban|konto|account|bank|bic|swift|compte|cuenta", r"order|serial|tracking|part"),
    "id": (r"\bssn|social security|national id|identity|tax id|\btin\b|passport", r"isbn|order|invoice|serial|part|item"),
    "phone": (r"\btel|phone|call|fax|mobil|cell|contact|whatsapp|sms|ruf|llam|appel", r"isbn|order|invoice|version|serial"),
}
VOTES = ("regex", "gazetteer", "context", "shape")
FEATURES = (*VOTES, "long", "plain")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_SPANS = "array<struct<start:int,stop:int,m:string,cue:string,around:string>>"
_FIRSTS = "array<struct<at:int,cue:string>>"
_BLOCK = 64


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: code point positions, the match, up
    to 40 characters between the previous match and it (if only a list's comma
    or "and" is there, those of the previous match), and the characters on
    either side.  All comes from the matches and the texts between them, so
    the work is linear in the text."""
    none = F.array().cast(_SPANS)

    def spans_of(lens: Column) -> Column:
        blocks = in_blocks(lens)

        def fold(part: Column, first: Column) -> Column:
            return F.aggregate(
                part, F.struct(first["at"].alias("at"), first["cue"].alias("cue"), none.alias("out")),
                lambda acc, x: let(F.when(x["listed"], acc["cue"]).otherwise(x["cue"]), lambda cue: F.struct(
                    (acc["at"] + x["gap"] + x["n"]).alias("at"), cue.alias("cue"),
                    F.array_append(acc["out"], F.struct(
                        (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["n"]).alias("stop"),
                        x["m"].alias("m"), cue.alias("cue"), x["around"].alias("around"))).alias("out"))),
                lambda acc: acc["out"])

        def firsts(parts: Column) -> Column:
            """Position and cue before each block."""
            ends = F.transform(parts, lambda p: F.struct(
                F.aggregate(p, F.lit(0), lambda s, x: s + x["gap"] + x["n"]).alias("n"),
                F.aggregate(p, F.lit(None).cast("string"),
                            lambda c, x: F.when(x["listed"], c).otherwise(x["cue"])).alias("cue")))
            return F.aggregate(ends, F.struct(F.lit(0).alias("at"), F.lit("").alias("cue"), F.array().cast(_FIRSTS).alias("out")),
                               lambda acc, e: F.struct(
                                   (acc["at"] + e["n"]).alias("at"), F.coalesce(e["cue"], acc["cue"]).alias("cue"),
                                   F.array_append(acc["out"], F.struct(acc["at"].alias("at"), acc["cue"].alias("cue"))).alias("out")),
                               lambda acc: acc["out"])
        return let(blocks, lambda parts: F.flatten(F.zip_with(parts, firsts(parts), fold)))

    def lens(found: Column, gaps: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            gap, after = F.get(gaps, i), F.get(gaps, i + 1)
            left = F.when(gap != "", F.substring(gap, -1, 1)).otherwise(F.substring(F.get(found, i - 1), -1, 1))
            right = F.when(after != "", F.substring(after, 1, 1)).otherwise(F.substring(F.get(found, i + 1), 1, 1))
            return F.struct(F.length(gap).alias("gap"), F.length(m).alias("n"), m.alias("m"),
                            F.lower(F.substring(gap, -40, 40)).alias("cue"),
                            ((i > 0) & (F.length(gap) < 40) & gap.rlike(LISTED)).alias("listed"),
                            F.concat_ws("\n", left, right).alias("around"))
        return F.transform(found, one)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.size(found) == 0, none).otherwise(
            let(F.split(text, pattern, -1), lambda gaps: let(lens(found, gaps), spans_of))))


def in_blocks(items: Column) -> Column:
    """An array as an array of blocks, so that folds stay short."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(items) / _BLOCK).cast("int"), F.lit(1)) - 1),
                       lambda b: F.slice(items, b * _BLOCK + 1, _BLOCK))


def overlaps(spans: Column, s: Column) -> Column:
    """Some of ``spans`` (in order, apart from each other) overlaps ``s``: if
    any does, the last that starts before the end of ``s`` does.  Found by
    halving."""
    steps = F.array(*[F.lit(1 << k) for k in range(24, -1, -1)])
    last = F.aggregate(steps, F.lit(-1), lambda i, p: F.when(
        (i + p < F.size(spans)) & (F.get(spans, i + p)["start"] < s["stop"]), i + p).otherwise(i))
    return F.coalesce(let(last, lambda i: F.get(spans, i)["stop"]) > s["start"], F.lit(False))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check digit is right."""
    def total(d: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda acc, i: acc + let(
            F.substring(d, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
            lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return total(F.reverse(digits)) % 10 == 0


def mod97(m: Column) -> Column:
    """A bank account number's check: the first four characters moved to the
    end, letters as 10 to 35, leave 1 modulo 97."""
    bare = F.regexp_replace(m, r"\x20", "")
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))
    return F.aggregate(F.regexp_extract_all(turned, F.lit("."), F.lit(0)), F.lit(0), lambda acc, c: let(
        F.ascii(c), lambda a: F.when(a < 65, (acc * 10 + a - 48) % 97).otherwise((acc * 100 + a - 55) % 97).cast("int"))) == 1


def valid(kind: str, m: Column) -> Column:
    """The fixed format's own check."""
    n = F.length(_digits(m))
    return {
        "email": F.lit(True),
        "ip": F.forall(F.split(m, r"\."), lambda p: p.cast("double") <= 255),
        "card": F.when(n.between(14, 19), luhn(_digits(m))).otherwise(F.lit(False)),
        "phone": n.between(10, 15),
    }[kind]


def _sign(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return out.otherwise(-1) if no is None else out.when(no, -1).otherwise(0)


def _candidate(kind: str, base: bool, c: Column) -> Column:
    m, before = c["m"], c["cue"]
    digits = _digits(m)
    gazetteer = {
        "email": _sign(F.lower(m).rlike(rf"(?:\.|\(dot\)\x20?|\[dot\]\x20?)(?:{DOMAINS})$")),
        "ip": _sign(~m.rlike(RESERVED)) if base else _sign(m.rlike(IPV6)),
        "card": _sign(digits.rlike(ISSUERS)),
        "phone": _sign(m.rlike(COUNTRIES), m.startswith("+")) if base else _sign(m.rlike(AREAS), F.lit(False)),
        "iban": _sign(m.rlike(f"^(?:{IBAN_LANDS})")),
        "id": _sign(~m.rlike(r"^(?:000|666|9)|-00-|-0000$")),
    }[kind]
    good, bad = CUES[kind]
    # of a looser format: a check that fails, or one that hardly any other string passes
    regex = F.lit(1) if base else {"card": F.when(~luhn(digits), -1).otherwise(0),
                                   "iban": F.when(mod97(m), 1).otherwise(-1)}.get(kind, F.lit(0))
    return F.struct(
        c["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), c["stop"].alias("stop"),
        F.lit(base).alias("base"), regex.alias("regex"), gazetteer.alias("gazetteer"),
        _sign(before.rlike(good), before.rlike(bad)).alias("context"),
        _sign(~c["around"].rlike(r"[\p{L}\p{N}_]")).alias("shape"),
        F.when(F.length(m) > 20, 1).otherwise(0).alias("long"),
        F.when(m.rlike(r"^[\p{L}\p{N}]+$"), 1).otherwise(0).alias("plain"))


def candidates(text: Column) -> Column:
    """All base spans, and looser ones that overlap none of them, with votes."""
    t = F.coalesce(text, F.lit(""))
    has_digit = t.rlike("[0-9]")

    def of(kind: str, base: bool, hint: Column) -> Column:
        empty = F.array().cast(_SPANS)
        found = F.when(hint, matches(t, (BASE if base else LOOSE)[kind])).otherwise(empty)
        checks = {"card": lambda c: F.length(_digits(c["m"])).between(13, 19),
                  # "::" stands for at least one group, and leaves a colon at neither end
                  "ip": lambda c: ~c["m"].contains("::") | (F.size(F.filter(
                      F.split(c["m"], ":"), lambda g: g != "")).between(1, 7) & c["m"].rlike("[0-9]"))}
        ok = (lambda c: valid(kind, c["m"])) if base else checks.get(kind, lambda c: F.lit(True))
        return F.transform(F.filter(found, ok), lambda c: _candidate(kind, base, c))

    digits = {"email": F.lit(True), "ip": has_digit, "card": has_digit, "phone": has_digit}
    base = F.array(*[of(k, True, digits[k] & (t.contains(HINT[k]) if HINT[k] else F.lit(True))) for k in BASE])
    spelled = {"email": t.contains("(at)") | t.contains("[at]"), "ip": has_digit & t.contains(":"),
               "card": has_digit, "phone": has_digit, "iban": has_digit, "id": has_digit & t.contains("-")}
    loose = {k: of(k, False, spelled[k]) for k in LOOSE}
    # an account number's or an id's digits are no card or phone number
    strict = F.array(loose.pop("iban"), loose.pop("id"))

    def apart(b: Column, kinds: Column) -> Column:
        return F.filter(kinds, lambda s: ~F.exists(b, lambda spans: overlaps(spans, s)))

    def whole(b: Column) -> Column:
        return let(F.transform(strict, lambda k: apart(b, k)), lambda k: F.array_sort(F.concat(
            F.flatten(b), F.flatten(k), apart(F.concat(b, k), F.concat(*loose.values())))))
    return let(base, whole)


def estimate(patterns: list[tuple[int, tuple[int, ...], int]]) -> list[float]:
    """Probability of each (kind, votes, count) pattern, by EM over two
    classes with labelers independent given the class.  Candidates whose
    format says yes (the fixed ones, and account numbers whose check holds)
    are taken as given."""
    p = [1.0 if v[0] > 0 else 0.9 if sum(v) >= 2 else 0.1 for _, v, _ in patterns]
    for _ in range(EM_ROUNDS):
        right = {}  # (labeler, class): probability of a vote of 1 among votes given
        for j in range(len(VOTES)):
            for y in (0, 1):
                up, all_ = (PRIOR_RIGHT if y else PRIOR_WRONG), PRIOR_RIGHT + PRIOR_WRONG
                for (_, v, n), q in zip(patterns, p):
                    w = n * (q if y else 1 - q)
                    if v[j]:
                        all_ += w
                        up += w * (v[j] > 0)
                right[j, y] = up / all_
        new = []
        for _, v, _ in patterns:
            if v[0] > 0:
                new.append(1.0)
                continue
            log = 0.0  # both classes are taken as equally likely beforehand
            for j, vote in enumerate(v):
                if vote:
                    a, b = right[j, 1], right[j, 0]
                    log += math.log(a / b) if vote > 0 else math.log((1 - a) / (1 - b))
            new.append(1 / (1 + math.exp(-log)))
        p = new
    return p


def fit_classifier(rows: list[tuple[list[float], float, float]]) -> list[float]:
    """Logistic weights of (features, probability, count) rows: gradient
    steps on the mean loss with a small ridge."""
    if not rows:
        return []
    d, total = len(rows[0][0]), sum(n for _, _, n in rows)
    w = [0.0] * d
    for _ in range(FIT_ROUNDS):
        grad = [1e-4 * x for x in w]
        for x, p, n in rows:
            q = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
            for j in range(d):
                grad[j] += (q - p) * x[j] * n / total
        w = [a - 2.0 * g for a, g in zip(w, grad)]
    return w


def find_pii(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text",
             min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """Kept columns (default: all) and ``pii``: an array of (kind, start, stop,
    base, probability) by start, then kind; positions are code points."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != "pii"]
    rows = write_table(docs.select(*[F.col(f"`{c}`") for c in keep], candidates(F.col(f"`{text_col}`")).alias("pii")),
                       "pii-candidates")
    counted = rows.select(F.explode("pii").alias("c")).groupBy(
        "c.kind", *[f"c.{f}" for f in FEATURES]).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy("kind", *FEATURES).collect()
    votes: dict[tuple, int] = {}
    for r in counted:
        key = (r["kind"], tuple(r[v] for v in VOTES))
        votes[key] = votes.get(key, 0) + r["n"]
    p = dict(zip(votes, estimate([(*key, n) for key, n in votes.items()])))

    def features(r) -> list[float]:
        return [float(r["kind"] == k) for k in range(len(KINDS))] + [float(r[f]) for f in FEATURES]
    # the log weight keeps the common fixed formats from drowning the rest
    weights = fit_classifier([(features(r), p[r["kind"], tuple(r[v] for v in VOTES)], math.log1p(r["n"]))
                              for r in counted]) or [0.0] * (len(KINDS) + len(FEATURES))

    def probability(c: Column) -> Column:
        x = F.get(F.array(*[F.lit(w) for w in weights[:len(KINDS)]]), c["kind"])
        for f, w in zip(FEATURES, weights[len(KINDS):]):
            x = x + c[f] * w
        return 1 / (1 + F.exp(-x))

    judged = F.transform("pii", lambda c: F.struct(
        F.get(F.array(*[F.lit(k) for k in KINDS]), c["kind"]).alias("kind"), c["start"].alias("start"),
        c["stop"].alias("stop"), c["base"].alias("base"), probability(c).alias("probability")))
    return rows.withColumn("pii", F.filter(judged, lambda c: c["base"] | (c["probability"] >= min_probability)))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span (sorted by start) replaced by its kind in
    brackets; spans that overlap become one, named after the first.  The text
    is cut block by block of spans."""
    def part(block: Column, begin: Column) -> Column:
        """The text from ``begin`` (where earlier spans end) to the block's end."""
        end = F.greatest(begin, F.array_max(F.transform(block, lambda s: s["stop"])))
        own = F.substring(text, begin + 1, end - begin)

        def fold(piece: Column) -> Column:
            def cut(acc: Column, s: Column) -> Column:
                return F.when(s["start"] >= acc["at"], F.struct(
                    s["stop"].alias("at"),
                    F.concat(acc["out"], F.array(
                        F.substring(piece, acc["at"] - begin + 1, s["start"] - acc["at"]),
                        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out"))) \
                    .otherwise(F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out")))
            return F.aggregate(block, F.struct(begin.alias("at"), F.array().cast("array<string>").alias("out")),
                               cut, lambda acc: F.concat_ws("", acc["out"]))
        return let(own, fold)

    def whole(blocks: Column) -> Column:
        begins = F.aggregate(
            F.transform(blocks, lambda b: F.array_max(F.transform(b, lambda s: s["stop"]))),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, stop: F.struct(F.greatest(acc["at"], stop).alias("at"),
                                       F.array_append(acc["out"], acc["at"]).alias("out")))
        return let(begins, lambda g: F.concat(F.concat_ws("", F.zip_with(blocks, g["out"], part)),
                                              F.substring(text, g["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(let(in_blocks(spans), whole))
