"""Alignment of two tokenizers' ids over the same bytes.

Method: both tokenizers cut the same bytes, so each text is two rising lists
of token ends.  Where both lists hold the same offset a group closes.  The
lists are compared at the current index shift (how many tokens one list is
ahead): exponential probing compares stretches of 1, 2, 4, ... ends at once
and halves the stretch after a difference, so runs of one-to-one tokens are
jumped; at a difference the group is resolved locally, end by end, and the
shift updated.  A task aligns many texts as one sequence, as every text's
last ends agree.

Corpus-wide counts of linked id pairs: two tokens that end together are a
suffix of one another, so the number of different pairs has a bound that
depends on the two vocabularies alone (``pair_bound``; 324,300 for the
default ones), whatever the corpus.  Counts are summed per task, shuffled
(at most that many rows a task), and broadcast within that bound.

Edge cases: null and empty texts, and texts that a tokenizer does not give
back byte for byte (one holding U+2581, say), have no tokens: zeros and an
empty digest; repeated rows and ids count as often as they occur; an empty
table gives an empty result; kept columns may have any names.
"""

from __future__ import annotations

import json
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.llm.byte_bpe import ByteTokens, Decimals, spread
from marginflow.llm.common import column, map_texts, process_cache, write_table
from marginflow.llm.known_words import KnownWords
from marginflow.llm.tokens import vocabulary_path

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
#: Words whose ids a worker remembers.
CACHE_WORDS = 400_000
#: Ends compared by a first probe.
FIRST = 16


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for the 256 bytes:
    printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if i not in special}
        entries = [b""] * (max(*ranks.values(), *special) + 1)
        for token, i in ranks.items():
            entries[i] = token
        self.tokens = ByteTokens(entries)
        # the file's merges are in the order of their ids, so ids are ranks
        self.encoding = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    def encode_batch(self, texts: list[str]):
        import numpy as np
        cut = [self.encoding.encode_to_numpy(" " + t) for t in texts]
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        return np.concatenate(cut).astype(np.int64), n


class Pieces:
    """Tokenizer B: a sentencepiece model, which writes a space before the text.

    If no piece holds a space after another letter, no merge crosses the start
    of a word, so a text's ids are those of its words and the library need
    only see new words.  Texts with other spaces than single ones between
    words, or with the library's mark for a space, go to it whole."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        self.tokens = ByteTokens([
            bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i)
            else m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.get_piece_size())])
        self.by_word = not any(b" " in t.lstrip(b" ") for t in self.tokens.entries)
        self.words = KnownWords(self._library, CACHE_WORDS)

    def _library(self, texts: list[str]):
        import numpy as np
        cut = self.model.encode(texts, num_threads=1)
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        return np.fromiter(chain.from_iterable(cut), np.int64, int(n.sum())), n

    def encode_batch(self, texts: list[str]):
        import numpy as np
        plain = [self.by_word and "  " not in t and "▁" not in t and t[0] != " " and t[-1] != " " for t in texts]
        ids, n = self.words.ids_of([t.split(" ") for t, p in zip(texts, plain) if p])
        if all(plain):
            return ids, n
        at = np.flatnonzero(np.array(plain))
        other = np.flatnonzero(~np.array(plain))
        ids_o, n_o = self._library([texts[i] for i in other.tolist()])
        count = np.zeros(len(texts), np.int64)
        count[at], count[other] = n, n_o
        start = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int64)
        out[spread(start[at], n)] = ids
        out[spread(start[other], n_o)] = ids_o
        return out, count


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """How many id pairs can end together: one is a suffix of the other."""
    def suffixes(of, known):
        return sum(known.get(t[i:], 0) for t in of for i in range(len(t)))

    def counted(entries):
        n: dict[bytes, int] = {}
        for t in entries:
            n[t] = n.get(t, 0) + 1
        return n
    in_a, in_b = counted(a), counted(b)
    equal = sum(k * in_b.get(t, 0) for t, k in in_a.items() if t)
    return suffixes(a, in_b) + suffixes(b, in_a) - equal


def common_ends(ends_a, ends_b):
    """Indexes (in a, in b) of the tokens with which both lists end a group.

    Both are rising int32 arrays with the same last value."""
    import numpy as np
    a, b = ends_a.tobytes(), ends_b.tobytes()
    at_a, at_b = memoryview(a).cast("i"), memoryview(b).cast("i")
    n, m, number = len(at_a), len(at_b), int.from_bytes
    runs_a, runs_b, runs_n = [], [], []
    i = j = 0
    while i < n and j < m:
        # local: to the next common end, and with it to a new shift
        x, y = at_a[i], at_b[j]
        while x != y:
            if x < y:
                i += 1
                x = at_a[i]
            else:
                j += 1
                y = at_b[j]
        # probing at this shift: twice as many ends each time, up to the first that differ
        run, step = 0, FIRST
        while True:
            left, right = a[4 * (i + run):4 * (i + run + step)], b[4 * (j + run):4 * (j + run + step)]
            if left != right:
                size = min(len(left), len(right))
                odd = number(left[:size], "little") ^ number(right[:size], "little")
                run += ((odd & -odd).bit_length() - 1) // 32 if odd else size // 4
                break
            run += len(left) // 4
            if len(left) < 4 * step:
                break
            step *= 2
        runs_a.append(i)
        runs_b.append(j)
        runs_n.append(run)
        i += run
        j += run
    size = np.array(runs_n, np.int64)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(np.array(runs_a, np.int64), size) + inside, np.repeat(np.array(runs_b, np.int64), size) + inside


class Aligner:
    """Both tokenizers and the alignment of a list of texts."""

    def __init__(self, path_a: str, path_b: str):
        held = process_cache("token-alignment")
        if (path_a, path_b) not in held:
            a, b = ByteLevel(path_a), Pieces(path_b)
            held[path_a, path_b] = (a, b, Decimals(len(a.tokens.entries), b",|"),
                                    Decimals(len(b.tokens.entries), b",;"))
        self.a, self.b, self.text_a, self.text_b = held[path_a, path_b]
        #: a pair (a, b) is written as a * 2^16 + b in 4 bytes, or a * 2^32 + b in 8
        small = max(len(self.a.tokens.entries), len(self.b.tokens.entries)) <= 1 << 16
        self.bits, self.dtype = (16, "<u4") if small else (32, "<u8")

    def __call__(self, texts: list[str | None], whole: bool):
        """Per text (n_a, n_b, n_groups, groups or their digest, links)."""
        import hashlib

        import numpy as np
        out = [(0, 0, 0, "", b"")] * len(texts)
        rows = [i for i, t in enumerate(texts) if t]
        if not rows:
            return out
        some = [texts[i] for i in rows]
        (ids_a, n_a), (ids_b, n_b) = self.a.encode_batch(some), self.b.encode_batch(some)
        ok = self._given_back(some, ids_a, n_a, ids_b, n_b)
        if not ok.all():
            ids_a, ids_b = ids_a[np.repeat(ok, n_a)], ids_b[np.repeat(ok, n_b)]
            rows = [i for i, good in zip(rows, ok.tolist()) if good]
            n_a, n_b = n_a[ok], n_b[ok]
        if not rows:
            return out
        last_a, last_b = common_ends(np.cumsum(self.a.tokens.length[ids_a], dtype=np.int32),
                                     np.cumsum(self.b.tokens.length[ids_b], dtype=np.int32))
        links = (ids_a[last_a] << self.bits | ids_b[last_b]).astype(self.dtype).tobytes()
        # the groups as text: every token's place among those of both sides
        size_a, size_b = (np.diff(x, prepend=-1) for x in (last_a, last_b))
        mark_a, mark_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        mark_a[last_a] = mark_b[last_b] = 1
        place_a = np.arange(len(ids_a)) + np.repeat(last_b + 1 - size_b, size_a)
        place_b = np.arange(len(ids_b)) + np.repeat(last_a + 1, size_b)
        cells = np.empty(len(ids_a) + len(ids_b), max(self.text_a.cells.dtype, self.text_b.cells.dtype))
        cells[place_a] = self.text_a.cells[ids_a + self.text_a.n * mark_a]
        cells[place_b] = self.text_b.cells[ids_b + self.text_b.n * mark_b]
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        stop_g = np.searchsorted(last_a, stop_a)
        width = np.dtype(self.dtype).itemsize
        before = g0 = 0
        for i, na, nb, stop, g in zip(rows, n_a.tolist(), n_b.tolist(), (stop_a + stop_b).tolist(), stop_g.tolist()):
            text = cells[before:stop].tobytes().translate(None, b"\0")[:-1]
            out[i] = (na, nb, g - g0, text.decode() if whole else hashlib.sha256(text).hexdigest(),
                      links[width * g0:width * g])
            before, g0 = stop, g
        return out

    def _given_back(self, texts, ids_a, n_a, ids_b, n_b):
        """Which texts both tokenizers give back byte for byte."""
        import numpy as np
        raw = [b" " + t.encode() for t in texts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        ok = np.ones(len(texts), bool)
        for tokens, ids, n in ((self.a.tokens, ids_a, n_a), (self.b.tokens, ids_b, n_b)):
            joined = tokens.decode(ids)
            ends = np.concatenate([[0], np.cumsum(tokens.length[ids])])[np.cumsum(n)]
            got = np.diff(ends, prepend=0)
            if joined == b"".join(raw) and (got == size).all():
                continue
            lo = (ends - got).tolist()
            ok &= np.fromiter((joined[a:b] == r for a, b, r in zip(lo, ends.tolist(), raw)), bool, len(raw))
        return ok


_ALIGNED = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("groups", T.StringType()),
            ("links", T.BinaryType())]


def align(docs: DataFrame, keep: list[str], text_col: str = "text", byte_vocabulary: str | None = None,
          piece_vocabulary: str | None = None, whole_groups: bool = False) -> DataFrame:
    """The ``keep`` columns and, per text, its ids by both tokenizers, the
    number of groups, ``groups`` (``a1,a2|b1;a3|b2,b3``, or the SHA-256 of it
    unless ``whole_groups``) and ``links``: the id pair that closes each
    group, a * 2^16 + b as little-endian 32 bits (64 for wider vocabularies).
    A narrow map: no shuffle."""
    path_a = byte_vocabulary or vocabulary_path(BYTE_VOCABULARY)
    path_b = piece_vocabulary or vocabulary_path(PIECE_VOCABULARY)

    def make():
        import pyarrow as pa
        aligner = Aligner(path_a, path_b)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

        def run(texts):
            return [pa.array(c, k) for c, k in zip(zip(*aligner(texts, whole_groups)), kinds)]
        return run

    return map_texts(docs, text_col, keep, [T.StructField(*f) for f in _ALIGNED], make)


def link_counts(aligned: DataFrame, wide: bool = False) -> DataFrame:
    """(pair, n): how many links of the whole table hold each id pair."""
    dtype = "<u8" if wide else "<u4"

    def count(batches):
        import numpy as np
        import pyarrow as pa
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            flat = np.concatenate([np.zeros(0, dtype), *(np.frombuffer(x, dtype) for x in batch.column(0).to_pylist())])
            k, n = np.unique(flat, return_counts=True)
            keys, where = np.unique(np.concatenate([keys, k.astype(np.int64)]), return_inverse=True)
            sums = np.bincount(where, np.concatenate([sums, n]), len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["pair", "n"])

    return aligned.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def weigh_links(aligned: DataFrame, counts: DataFrame, keep: list[str], wide: bool = False) -> DataFrame:
    """The ``keep`` columns, ``n_links``, ``n_best`` (links whose count is
    their B id's highest) and ``count_sum``, from a table of ``align`` and the
    counts of ``link_counts``, which go to every task (see ``pair_bound``)."""
    import numpy as np
    dtype, bits = ("<u8", 32) if wide else ("<u4", 16)
    got = counts.toArrow()
    pair, n = (got.column(c).to_numpy().astype(np.int64) for c in ("pair", "n"))
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    b = pair & ((1 << bits) - 1)
    top = np.zeros(int(b.max()) + 1 if len(b) else 1, np.int64)
    np.maximum.at(top, b, n)
    table = aligned.sparkSession.sparkContext.broadcast((pair, n, n == top[b]))

    def make():
        import pyarrow as pa
        pair, n, best = table.value

        def run(rows):
            parts = [np.frombuffer(r or b"", dtype) for r in rows]
            size = np.fromiter(map(len, parts), np.int64, len(parts))
            at = np.searchsorted(pair, np.concatenate([np.zeros(0, dtype), *parts]).astype(np.int64))
            ends = np.cumsum(size)
            sums = [np.concatenate([[0], np.cumsum(v[at])]) for v in (best, n)]
            return [pa.array(size, pa.int64()), *(pa.array((s[ends] - s[ends - size]).astype(np.int64), pa.int64())
                                                 for s in sums)]
        return run

    return map_texts(aligned, "links", keep, [T.StructField(c, T.LongType()) for c in ("n_links", "n_best", "count_sum")],
                     make)


def align_corpus(docs: DataFrame, keep: list[str], text_col: str = "text", **settings) -> DataFrame:
    """Align every text, write the table, count the links of all of it and
    weigh every text's links: the ``keep`` columns, n_a, n_b, n_groups,
    n_links, n_best, count_sum and groups."""
    path_a = settings.get("byte_vocabulary") or vocabulary_path(BYTE_VOCABULARY)
    path_b = settings.get("piece_vocabulary") or vocabulary_path(PIECE_VOCABULARY)
    wide = Aligner(path_a, path_b).bits == 32
    named = docs.select(*[column(c).alias(f"k{i}") for i, c in enumerate(keep)], column(text_col).alias("t"))
    k = [f"k{i}" for i in range(len(keep))]
    aligned = write_table(align(named, k, "t", **settings), "aligned")
    out = weigh_links(aligned, link_counts(aligned, wide), [*k, "n_a", "n_b", "n_groups", "groups"], wide)
    return out.toDF(*keep, "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum")
