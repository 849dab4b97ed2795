"""Secret scan: fixed formats, and credential values that are hard to guess.

Fixed formats (kinds ``assign``, ``access``, ``hex``) are matched as they
stand.  Beyond them, values in a credential context that the fixed formats
miss (other key words, separators and characters; ``Authorization: Bearer``;
the password of ``scheme://user:password@host``) are kept, as kind ``guess``,
if their guess cost is high: the least number of bits over all segmentations
of the value into known words, dates, repeats, keyboard walks and brute-force
spans, found by dynamic programming.  A value is 6 or more printable
characters, two of them ASCII, and ends at white space or a control character,
or where a fixed format begins.

The minimum is exact and takes n log n steps: a walk's cost rises evenly, so
one running minimum a walk serves all its beginnings and ends; a repeat's cost
depends on its length and unit only, so each stretch keeps the few beginnings
that no earlier one beats for every end (``GuessCost.bits``).

Known words are ``WORDS`` and the words of all documents that at least
``MIN_DOCS`` of them have outside credential contexts, however many there
are: a word costs log2 of (all occurrences / its own).  They are not
broadcast: values that ``WORDS`` alone does not clear are brought together
with the words inside them by joins (a bitmap of ``FILTER_BITS`` bits finds
which of a value's substrings can be words), and costed again.

Edge cases: a null text is an empty one; repeated rows each get a row, equal
values one verdict; an empty table gives an empty result; a kept column with
the name of a result column gives way to it.  Values of any length are costed
whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.llm.bitmaps import Bitmap
from marginflow.llm.common import column, map_texts, share, text_slices, write_table

#: Least guess cost, in bits, of a value that counts as a secret.
MIN_BITS = 36.0
#: Documents that must have a word; letters of a word.
MIN_DOCS, LETTERS = 10, 24
#: Bits of the bitmap of known words (a power of two; 8 MB).
FILTER_BITS = 26
#: Rows of found values that are broadcast (about 100 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 200_000

# fixed values: the three formats
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

# other credential contexts: key word (those of the fixed format anywhere in a
# word, the others after no letter or digit), separator; then the value
_MAIN = "password|passwd|secret|token|api_?key"
_OTHER = ("pwd|pass|passphrase|passcode|pin|auth|authorization|bearer|credentials?|login|private_?key|access_?key|"
          "session_?id")
_PRINTED = r"[^\s\x00-\x1f\x7f]"
CONTEXT = re.compile(rf"""(?:(?:{_MAIN}|(?<![A-Za-z0-9])(?:{_OTHER}))["']?[\x20\t]*"""
                     rf"""(?:->|=>|[:=]|\b(?:is|was)\b)[\x20\t]*(?:\r?\n[\x20\t]*)?["']?"""
                     rf"""|(?<![A-Za-z0-9])bearer[\x20\t]+)(?={_PRINTED}{{6}})""", re.IGNORECASE | re.ASCII)
_KEY_WORD = re.compile(rf"(?:{_MAIN}|{_OTHER})[:=]?", re.IGNORECASE | re.ASCII)
_CONTEXT_HINT = re.compile(r"pwd|pass|pin|auth|bearer|credential|login|_?key|secret|token|session",
                           re.IGNORECASE | re.ASCII)
URL_VALUE = re.compile(r"://[^\s/?#:@]*:([^\s/?#@\x00-\x1f\x7f]{6,})@")
_VALUE_END = re.compile(r"[\s\x00-\x1f\x7f]|\Z")
_ASSIGN_HINT = re.compile(r"passw|secret|token|key", re.IGNORECASE | re.ASCII)

# fixed values: common words of passwords, most common first
WORDS = ("password pass admin user login welcome secret dragon master monkey letmein qwerty football baseball "
         "shadow sunshine princess superman batman trustno hello freedom whatever ninja mustang access flower "
         "starwars killer soccer hockey ranger jordan hunter buster thomas robert daniel andrew joshua pepper "
         "ginger summer winter spring autumn monday friday january february march april june july august "
         "september october november december love money test guest root default changeme example sample "
         "demo temp public private server system service account company office computer internet github "
         "google apple orange banana cookie cheese coffee the and for you with this that from "
         "required available documentation invalid incorrect expired missing optional disabled enabled "
         "successful successfully failed provided unavailable necessary needed always stored encrypted hidden "
         "protected correct accepted rejected valid different unknown forgotten allowed information application "
         "please contact support important everything something").split()
# fixed values: rows of the keyboard
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")


class GuessCost:
    """Least-cost segmentation of a value, in bits."""

    def __init__(self, words=WORDS):
        from math import log2
        self.rank = {w: log2(i + 2) for i, w in enumerate(words)}
        self.next_to = {(a, b) for row in KEYBOARD for a, b in zip(row, row[1:])}
        self.next_to |= {(b, a) for a, b in self.next_to}
        self.log2 = log2

    @staticmethod
    def _charset(c: str) -> int:
        return 10 if c.isdigit() else 26 if c.islower() or c.isupper() else 33

    def _dates(self, v: str) -> list[tuple[int, int, float]]:
        out = []
        for m in re.finditer(r"(?=((?:19|20)\d\d)([-/.]?)(0[1-9]|1[0-2])\2(0[1-9]|[12]\d|3[01]))", v):
            out.append((m.start(), m.end(4), self.log2(200 * 366) + (2 if m[2] else 0)))
        for m in re.finditer(r"(?=(0[1-9]|[12]\d|3[01])([-/.]?)(0[1-9]|1[0-2])\2((?:19|20)\d\d))", v):
            out.append((m.start(), m.end(4), self.log2(200 * 366) + (2 if m[2] else 0)))
        for m in re.finditer(r"(?=((?:19|20)\d\d))", v):
            out.append((m.start(), m.start() + 4, self.log2(200)))
        return out

    def _words(self, v: str, more: dict[str, float]) -> list[tuple[int, int, float]]:
        """Known words in the value; capitals cost a bit if all or the first, else one a letter."""
        out, low = [], lowered(v)
        begins = {w[:3] for w in self.rank} | {w[:3] for w in more}
        longest = max(map(len, [*self.rank, *more]), default=0)
        for i in range(len(v) - 2):
            if low[i:i + 3] not in begins:
                continue
            for j in range(i + 3, min(len(v), i + longest) + 1):
                word = low[i:j]
                cost = min(self.rank.get(word, 1e9), more.get(word, 1e9))
                if cost < 1e9:
                    part = v[i:j]
                    out.append((i, j, cost + (0 if part.islower() else 1 if part.isupper() or part.istitle() else j - i)))
        return out

    def bits(self, value: str, more: dict[str, float] | None = None) -> float:
        """The least cost; ``more`` are further words with their costs."""
        n, log2 = len(value), self.log2
        ends: dict[int, list[tuple[int, float]]] = {}
        for i, j, cost in [*self._words(value, more or {}), *self._dates(value)]:
            ends.setdefault(j, []).append((i, cost))
        starting: dict[int, list[list]] = {}
        for i, j, unit in repeats(value):
            if j - i >= 3:
                starting.setdefault(i + 2 * unit, []).append([j, unit, i + unit, []])
        spell = {c: log2(self._charset(c)) for c in set(value)}
        near, low = self.next_to, lowered(value)
        best = [0.0] * (n + 1)
        active: list[list] = []
        walk_from, walk_least = 0, 1e18    # of the walk that goes on: its start, least best[i] - i
        for j in range(1, n + 1):
            least = best[j - 1] + spell[value[j - 1]]
            for i, cost in ends.get(j, ()):
                least = min(least, best[i] + cost + 1)  # one bit for the change of kind
            # a walk: where it starts, and one of two turns at each step
            if j > 1 and (low[j - 2], low[j - 1]) in near:
                if j - 3 >= walk_from:
                    walk_least = min(walk_least, best[j - 3] - (j - 3))
                    least = min(least, walk_least + log2(47) + j)
            else:
                walk_from, walk_least = j - 1, 1e18
            # repeats: what follows the first unit costs log2(unit) for its
            # length and log2(length / unit + 1) for how often it comes
            if j in starting:
                active += starting[j]
            if active:
                for run in active:
                    _, unit, first, begins = run
                    i = j - unit
                    b = best[i]
                    if i >= first and all(b < c + log2((i - k + 2 * unit) / (2 * unit)) for k, c in begins):
                        begins[:] = [x for x in begins if x[1] < b]
                        begins.append((i, b))
                    for k, c in begins:
                        least = min(least, c + log2(j - k + unit) + 1)
                active = [run for run in active if run[0] > j]
            best[j] = least
        return best[-1]


def lowered(v: str) -> str:
    """Lower case, letter by letter: as long as the value."""
    low = v.lower()
    return low if len(low) == len(v) else "".join(c.lower() if len(c.lower()) == 1 else c for c in v)


def repeats(v: str) -> list[tuple[int, int, int]]:
    """(start, stop, unit) of every longest stretch of two or more units (the
    last one may be cut short), with its least unit.

    A stretch of unit u holds two neighbouring multiples of u, p and p + u,
    from which the text agrees for at least u characters backwards and
    forwards taken together.  There are n log n such places; equal hashes of
    prefixes give the agreement of many places at once by halving, and every
    stretch found is compared character by character."""
    import numpy as np
    n = len(v)
    if n < 2:
        return []
    text = np.frombuffer(v.encode("utf-32-le", "surrogatepass"), np.uint32)
    power = np.full(n + 1, 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power[:n],
                                                               dtype=np.uint64)])

    def equal(p, u, size):
        """Whether the text is the same for ``size`` characters from p and from p + u."""
        return (prefix[p + size] - prefix[p]) * power[u] == prefix[p + u + size] - prefix[p + u]

    def agree(p, u, back, most):
        """How far the text agrees from p and p + u, at most ``most``."""
        size = np.zeros(len(p), np.int64)
        step = 1 << max(0, int(most.max()).bit_length() - 1) if len(p) else 0
        while step:
            more = np.minimum(size + step, most)
            same = equal(p - more if back else p, u, more)
            size = np.where(same, more, size)
            step >>= 1
        return size

    found: dict[tuple[int, int], int] = {}
    covered, by = np.zeros(n + 1, np.int64), np.ones(n + 1, np.int64)   # end of a stretch from here, and its unit
    lo = 1
    while lo <= n // 2:
        hi, total = lo, 0
        while hi <= n // 2 and (total == 0 or total + n // hi <= 1_000_000) and (hi == lo or hi < 2 * lo):
            total += n // hi
            hi += 1
        units = np.arange(lo, hi)
        counts = (n - 1) // units                      # places p = k * u with p + u < n
        u = np.repeat(units, counts)
        p = (np.arange(len(u)) - np.repeat(np.cumsum(counts) - counts, counts)) * u
        # stretches of a divisor of u are those of that unit
        new = ~((covered[p] >= np.minimum(p + 2 * u, n)) & (u % by[p] == 0))
        p, u = p[new], u[new]
        half = (u + 1) // 2
        ahead = equal(p, u, np.minimum(half, n - p - u)) & (p + u + half <= n)
        behind = (p >= half) & equal(np.maximum(p - half, 0), u, np.minimum(half, p))
        p, u = p[ahead | behind], u[ahead | behind]
        front = agree(p, u, False, n - p - u)
        tail = agree(p, u, True, p)
        long = front + tail >= u
        stretches = np.unique(np.stack([(p - tail)[long], (p + u + front)[long], u[long]], 1), axis=0)
        for i, j, unit in sorted(stretches.tolist(), key=lambda r: r[2]):
            if not (text[i:j - unit] == text[i + unit:j]).all():
                raise AssertionError("unequal texts of equal hash")
            if (i, j) not in found:
                found[i, j] = unit
                if j - i >= 4 * unit:
                    part = covered[i:j] < j
                    covered[i:j][part], by[i:j][part] = j, unit
        lo = hi
    return [(i, j, unit) for (i, j), unit in found.items()]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Matches of the fixed formats, by start, then kind."""
    out = []
    if _ASSIGN_HINT.search(text):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def context_values(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """(start, stop) of the values in credential contexts, outside the base."""
    found: list[tuple[int, int]] = []
    starts = [s for s, _, _ in base]
    stops: list[int] = []
    for _, e, _ in base:  # the furthest end of the spans so far
        stops.append(max(e, stops[-1] if stops else 0))

    def take(start: int, run_end: int) -> int:
        """File the value, up to the next base span; returns where to go on."""
        after = bisect_right(starts, start)  # the first base span behind the value's start
        if after and stops[after - 1] > start:
            return stops[after - 1]
        stop = min(run_end, starts[after]) if after < len(starts) else run_end
        value = text[start:stop].rstrip("\"'.,;:!?)]}")
        if _KEY_WORD.fullmatch(value):
            return start                     # "Authorization: Bearer v": the value is the next context
        if len(value) >= 6 and sum(map(str.isascii, value)) >= 2:
            found.append((start, start + len(value)))
        return max(start, stop)

    at = run_end = 0
    if "://" in text:
        for m in URL_VALUE.finditer(text):
            take(m.start(1), m.end(1))
    in_urls = sorted(found)
    if _CONTEXT_HINT.search(text):
        while m := CONTEXT.search(text, at):
            start = m.end()
            if start >= run_end:
                run_end = _VALUE_END.search(text, start).start()
            k = bisect_right(in_urls, (start, len(text)))
            if k and in_urls[k - 1][1] > start:
                at = in_urls[k - 1][1]
                continue
            at = max(start, take(start, min([run_end, *[s for s, _ in in_urls[k:k + 1]]])))
    return sorted(found)


_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: ASCII bytes that part words: all but letters and digits
_PARTS = bytes.maketrans(bytes(b for b in range(128) if not chr(b).isalnum()),
                         b" " * sum(not chr(b).isalnum() for b in range(128)))


def document_words(text: str) -> set[bytes]:
    """The document's words of letters outside credential contexts."""
    if _CONTEXT_HINT.search(text):
        out, at = [], 0
        while m := CONTEXT.search(text, at):
            out.append(text[at:m.start()])
            at = max(m.end(), _VALUE_END.search(text, m.end()).start())
        text = " ".join([*out, text[at:]])
    return set(text.encode().translate(_LOWER).translate(_PARTS).split(b" "))


def count_words(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(word, n): the words of ``min_docs`` and more documents, with their number."""
    def run(batches):
        import pyarrow as pa
        from collections import Counter
        n: Counter = Counter()

        def passed():
            words = {w.decode(): k for w, k in n.items()}
            words = {w: k for w, k in words.items() if 3 <= len(w) <= LETTERS and w.isalpha()}
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())],
                                              names=["word", "n"])
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                for t in texts:
                    if t:
                        n.update(document_words(t))
                if len(n) > 500_000:
                    yield passed()
                    n.clear()
        yield passed()

    return docs.select(column(text_col).alias("t")).mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs)


def word_bitmap(words: DataFrame, bits: int = FILTER_BITS) -> Bitmap:
    """Bitmap of the words' hashes: at most 2^bits / 64 rows reach the driver."""
    import numpy as np
    cell = F.crc32("word").bitwiseAND((1 << bits) - 1)
    got = words.select(cell.alias("c")).groupBy(F.shiftright("c", 6).alias("at")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, int(c & 63))")).alias("set")).toArrow()
    out = Bitmap(bits)
    out.words[got.column("at").to_numpy()] = got.column("set").to_numpy().view(np.uint64)
    return out


def cost_with_words(values: DataFrame, words: DataFrame, total: int, min_bits: float) -> DataFrame:
    """(value, bits) of the values that stay hard to guess when the words of
    ``words`` (word, n; of ``total`` occurrences) are known too."""
    spark = values.sparkSession
    bitmap, mask = share(spark, word_bitmap(words)), (1 << FILTER_BITS) - 1

    def parts(batches):
        import pyarrow as pa
        import zlib
        known = bitmap().words

        def is_word(w):
            c = zlib.crc32(w.encode()) & mask
            return int(known[c >> 6]) >> (c & 63) & 1
        for batch in batches:
            at, out = [], []
            for row, v in enumerate(batch.column(0).to_pylist()):
                low, seen = lowered(v), set()
                for m in re.finditer(r"[^\W\d_]{3,}", low):
                    run = m.group()
                    for i in range(len(run) - 2):
                        seen.update(run[i:j] for j in range(i + 3, min(len(run), i + LETTERS) + 1))
                some = [w for w in seen if is_word(w)]
                at += [row] * len(some)
                out += some
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(out, pa.string())],
                                             names=["value", "word"])

    inside = values.select("value").mapInArrow(parts, "value string, word string").join(words, "word") \
        .groupBy("value").agg(F.collect_list(F.struct("word", "n")).alias("words"))

    def judge(batches):
        import pyarrow as pa
        from math import log2
        cost = GuessCost()
        for batch in batches:
            keep, out = [], []
            for row, (v, ws) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                b = cost.bits(v, {w["word"]: log2(max(2.0, total / w["n"])) for w in ws or ()})
                if b >= min_bits:
                    keep.append(row)
                    out.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(out, pa.float64())],
                                             names=["value", "bits"])

    return values.select("value").join(inside, "value", "left").mapInArrow(judge, "value string, bits double")


_SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("stop", T.LongType()), T.StructField("base", T.BooleanType()),
    T.StructField("bits", T.DoubleType()), T.StructField("text", T.StringType())])


def find_secrets(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text",
                 min_bits: float = MIN_BITS, words: DataFrame | None = None, base_bits: bool = True) -> DataFrame:
    """Kept columns (default: all) and ``secrets``: an array of (kind, start,
    stop, base, bits, text) by start, then kind; positions are code points,
    ``base`` marks the fixed formats, ``bits`` is the guess cost of an added
    value, and of a base match's value by ``WORDS`` alone (null without ``base_bits``).
    ``words`` (word, n) are by default those of the documents.

    Three passes over texts: one files base spans and values that ``WORDS``
    does not clear; one counts words, if there is any such value; values and
    the words inside them meet by joins, and their verdicts go back to the
    rows by row number."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != "secrets"]
    own = [f"k{i}" for i in range(len(keep))]

    def make():
        import pyarrow as pa
        cost = GuessCost()
        seen: dict[str, float] = {}
        base_t = pa.list_(pa.struct([(f.name, {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(),
                                               "double": pa.float64()}[f.dataType.simpleString()]) for f in _SPAN]))

        def bits(value):
            if value not in seen:
                if len(seen) > 100_000:
                    seen.clear()
                seen[value] = cost.bits(value)
            return seen[value]

        def span(t, kind, start, stop, is_base, b):
            return {"kind": kind, "start": start, "stop": stop, "base": is_base, "bits": b, "text": t[start:stop]}

        def run(texts):
            sure, maybe = [], []
            for t in texts:
                base = base_spans(t) if t else []
                sure.append([span(t, k, s, e, True, bits(_value(t[s:e])) if base_bits else None) for s, e, k in base])
                values = [(s, e, bits(t[s:e])) for s, e in context_values(t, base)] if t else []
                maybe.append([span(t, "guess", s, e, False, b) for s, e, b in values if b >= min_bits])
            return [pa.array(sure, base_t), pa.array(maybe, base_t)]
        return run

    named = docs.select(*[column(c).alias(k) for c, k in zip(keep, own)], column(text_col).alias("t"))
    spans = T.ArrayType(_SPAN)
    rows = map_texts(named, "t", own, [T.StructField("sure", spans), T.StructField("maybe", spans)], make)
    rows = write_table(rows.withColumn("row", F.monotonically_increasing_id()), "secret-rows")
    open_values = rows.filter(F.size("maybe") > 0).select("row", F.explode("maybe").alias("s")) \
        .withColumn("value", F.col("s.text"))
    values = write_table(open_values.select("value").distinct(), "secret-values")
    if values.isEmpty():
        secrets = F.col("sure")
    else:
        table = write_table(count_words(docs, text_col), "words") if words is None else words
        total = table.agg(F.sum("n")).first()[0] or 0
        hard = write_table(cost_with_words(values, table, total, min_bits), "secret-verdicts")
        found = open_values.join(hard, "value").groupBy("row").agg(F.collect_list(F.struct(
            *[F.col(f"s.{f.name}") if f.name != "bits" else F.col("bits") for f in _SPAN])).alias("more"))
        found = write_table(found, "secret-found")
        if found.count() <= BROADCAST_ROWS:
            found = F.broadcast(found)
        rows = rows.join(found, "row", "left")
        # by start, then kind: a base span before an added one
        order = F.array_sort(F.transform(F.concat("sure", F.coalesce("more", F.array().cast(spans))), lambda s: F.struct(
            s["start"].alias("at"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s.alias("s"))))
        secrets = F.transform(order, lambda o: o["s"])
    return rows.select(*own, secrets.alias("secrets")).toDF(*keep, "secrets")


def _value(match: str) -> str:
    """The value of a base match (an assignment's is its last group)."""
    m = ASSIGN.fullmatch(match)
    return m[1] if m else match
