"""Byte-level BPE by corpus-level merge replay, and its decoder.

Method: instead of merging word by word, the distinct words of a block of
texts are laid end to end as one sequence of byte tokens, and an inverted
index lists the positions of every adjacent token pair under the rank the
pair merges to.  Merges are then replayed in rank order over the whole block:
each rank takes its positions from the index, merges them all at once, and
only the two touched neighbours of each merge are looked up and filed again.
A word that already is a token takes its id directly, as the format demands.

A block is what a task reads at a time (``BLOCK_CHARS`` of text, or one
longer text), so the index is bounded by it and nothing is shuffled; words
met before keep their ids in the worker (``CACHE_WORDS`` of them).  Should a
merge create a pair of a lower rank than its own (no trained vocabulary does,
a hand-made one may), that word is redone by itself with a heap, which is the
order of the format by definition; the result never depends on the path.

Edge cases: a null text is an empty one, without ids; very long words (one
letter a million times) are merged like the rest, a whole rank at a time;
repeated rows give equal ids; an empty table gives an empty result; kept
columns may have any names (a new column replaces one of its name).
"""

from __future__ import annotations

import base64
import heapq
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marginflow.llm.common import map_texts, process_cache
from marginflow.llm.tokens import vocabulary_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Characters of text whose new words are merged together.
BLOCK_CHARS = 8_000_000
#: Words whose ids a worker remembers.
CACHE_WORDS = 400_000
NONE = 2 ** 31 - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank of a vocabulary file (one base64 token and its rank a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteTokens:
    """A vocabulary's bytes as flat arrays: decoding and token lengths."""

    def __init__(self, entries: list[bytes]):
        import numpy as np
        self.entries = entries
        self.length = np.fromiter(map(len, entries), np.int64, len(entries))
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def decode(self, ids) -> bytes:
        """The bytes of a sequence of ids."""
        return self.flat[spread(self.start[ids], self.length[ids])].tobytes()


def spread(start, length):
    """Indexes start, start + 1, ... of every (start, length), one after the other."""
    import numpy as np
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


class MergeReplay:
    """Encodes words with the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np
        self.ranks = ranks
        entries = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            entries[rank] = token
        self.tokens = ByteTokens(entries)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.width = len(entries)
        pairs = [(ranks[t[:i]] * self.width + ranks[t[i:]], rank) for t, rank in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.pair_key = np.concatenate([table[:, 0], [NONE * 2 ** 16]])
        self.pair_rank = np.concatenate([table[:, 1], [NONE]]).astype(np.int32)

    def rank_of(self, left, right):
        """The rank that adjacent tokens merge to, NONE if they do not."""
        import numpy as np
        key = left * np.int64(self.width) + right
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], np.int32(NONE))

    def encode_words(self, words: list[bytes]):
        """(ids of all words one after the other, number of ids of each)."""
        import numpy as np
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.concatenate([[0], np.cumsum(size)])
        n = int(first[-1])
        if not n:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        token = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        right = np.arange(1, n + 1, dtype=np.int32)
        left = np.arange(-1, n - 1, dtype=np.int32)
        filled = size > 0
        right[first[1:][filled] - 1] = -1
        left[first[:-1][filled]] = -1
        rank = np.full(n, NONE, np.int32)
        at = np.flatnonzero(right >= 0).astype(np.int32)
        rank[at] = self.rank_of(token[at], token[right[at]])
        alive, merged = np.ones(n, bool), np.zeros(n, bool)
        odd: set[int] = set()
        index: dict[int, list] = {}
        heap: list[int] = []

        def file(at):
            """Add positions to the index under the rank of their pair."""
            r = rank[at]
            found = r < NONE
            at, r = at[found], r[found]
            if not len(at):
                return
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            starts = [0, *cuts.tolist(), len(r)]
            for value, lo, hi in zip(r[starts[:-1]].tolist(), starts, starts[1:]):
                if value in index:
                    index[value].append(at[lo:hi])
                else:
                    index[value] = [at[lo:hi]]
                    heapq.heappush(heap, value)

        file(at)
        while heap:
            now = heapq.heappop(heap)
            filed = index.pop(now)
            at = filed[0] if len(filed) == 1 else np.concatenate(filed)
            at = np.sort(at[rank[at] == now])
            if not len(at):
                continue
            if len(at) > 1:
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
                # of pairs that share a token the leftmost merges: every other one of a chain
                chained = np.concatenate([[False], right[at[:-1]] == at[1:]])
                if chained.any():
                    k = np.arange(len(at))
                    at = at[(k - np.maximum.accumulate(np.where(chained, 0, k))) % 2 == 0]
            gone = right[at]
            after = right[gone]
            merged[at] = True
            # of two merges side by side the left one meets the right one's first token
            beside = after[(after >= 0) & merged[after]]
            if len(beside):
                beside = beside[self.rank_of(np.full(len(beside), now), token[beside]) < now]
                odd.update(word[beside].tolist())
            token[at] = now
            alive[gone] = False
            rank[gone] = NONE
            right[at] = after
            kept = after >= 0
            left[after[kept]] = at[kept]
            before = left[at]
            before = before[before >= 0]
            touched = np.concatenate([at, before[~merged[before]]])
            merged[at] = False
            follow = right[touched]
            fresh = np.where(follow >= 0, self.rank_of(token[touched], token[follow]), np.int32(NONE))
            rank[touched] = fresh
            if fresh.min() < now:
                odd.update(word[touched[fresh < now]].tolist())
            file(touched)

        ids, count = token[alive], np.bincount(word[alive], minlength=len(words))
        if odd:
            cut = np.split(ids, np.cumsum(count)[:-1])
            for w in odd:
                cut[w] = np.array(self.merge_alone(words[w]), np.int64)
            ids, count = np.concatenate(cut), np.fromiter(map(len, cut), np.int64, len(cut))
        return ids, count

    def merge_alone(self, word: bytes) -> list[int]:
        """One word: always the lowest rank, leftmost first."""
        part: list[bytes | None] = [word[i:i + 1] for i in range(len(word))]
        right = list(range(1, len(part))) + [-1]
        left = list(range(-1, len(part) - 1))
        heap: list[tuple[int, int, bytes]] = []

        def offer(i):
            if i >= 0 and right[i] >= 0:
                both = part[i] + part[right[i]]
                if both in self.ranks:
                    heapq.heappush(heap, (self.ranks[both], i, both))

        for i in range(len(part)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if part[i] is None or right[i] < 0 or part[right[i]] is None or part[i] + part[right[i]] != both:
                continue
            j = right[i]
            part[i], part[j], right[i] = both, None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i])
            offer(i)
        return [self.ranks[p] for p in part if p is not None]


class ByteBPE:
    """Texts to ids: the words of a split pattern, each merged by itself."""

    def __init__(self, path: str, pattern: str | None = None):
        import numpy as np
        import public_tokenizers
        import regex
        held = process_cache("byte-bpe")
        if path not in held:
            held[path] = MergeReplay(read_ranks(path))
        self.replay = held[path]
        self.tokens = self.replay.tokens
        self.pattern = regex.compile(pattern or public_tokenizers.PATTERN)
        self.np = np
        self._forget()

    def _forget(self):
        self.number: dict[str, int] = {}
        self.ids = [self.np.zeros(0, self.np.int64)]
        self.count = [self.np.zeros(0, self.np.int64)]

    def _learn(self, words: list[str]) -> None:
        np = self.np
        raw = [w.encode() for w in words]
        whole = np.fromiter((self.replay.ranks.get(w, -1) for w in raw), np.int64, len(raw))
        rest = np.flatnonzero(whole < 0)
        ids, count = self.replay.encode_words([raw[i] for i in rest.tolist()])
        n = np.ones(len(raw), np.int64)
        n[rest] = count
        out = np.empty(int(n.sum()), np.int64)
        starts = np.cumsum(n) - n
        out[starts[whole >= 0]] = whole[whole >= 0]
        out[spread(starts[rest], count)] = ids
        base = len(self.number)
        self.number.update(zip(words, range(base, base + len(words))))
        self.ids = [np.concatenate([*self.ids, out])]
        self.count = [np.concatenate([*self.count, n])]

    def encode_batch(self, texts: list[str]):
        """(ids of all texts one after the other, number of ids of each)."""
        np = self.np
        if len(self.number) > CACHE_WORDS:
            self._forget()
        cut = [self.pattern.findall(t) for t in texts]
        new = set(chain.from_iterable(cut)).difference(self.number)
        if new:
            self._learn(list(new))
        n_words = np.fromiter(map(len, cut), np.int64, len(cut))
        words = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, int(n_words.sum()))
        count = self.count[0]
        start = np.cumsum(count) - count
        ids = self.ids[0][spread(start[words], count[words])]
        ends = np.concatenate([[0], np.cumsum(count[words])])
        edges = ends[np.concatenate([[0], np.cumsum(n_words)])]
        return ids, np.diff(edges)

    def decode(self, ids) -> bytes:
        return self.tokens.decode(ids)


def _fields(*kinds):
    return [T.StructField(name, kind) for name, kind in kinds]


def encode_texts(docs: DataFrame, keep: list[str], text_col: str = "text", vocabulary: str | None = None,
                 pattern: str | None = None) -> DataFrame:
    """The ``keep`` columns, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    path = vocabulary or vocabulary_path(VOCABULARY)

    def make():
        import numpy as np
        import pyarrow as pa
        bpe = ByteBPE(path, pattern)

        def run(texts):
            ids, n = bpe.encode_batch([t or "" for t in texts])
            raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(n)).tolist()
            return pa.array(n, pa.int64()), pa.array([raw[a:b] for a, b in zip([0, *ends], ends)], pa.binary())
        return run

    return map_texts(docs, text_col, keep, _fields(("n_tokens", T.LongType()), ("ids", T.BinaryType())), make,
                     BLOCK_CHARS)


def decode_ids(rows: DataFrame, keep: list[str], ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """The ``keep`` columns and ``decoded``: the bytes of the ids (null: none)."""
    path = vocabulary or vocabulary_path(VOCABULARY)

    def make():
        import numpy as np
        import pyarrow as pa
        held = process_cache("byte-bpe")
        if path not in held:
            held[path] = MergeReplay(read_ranks(path))
        tokens = held[path].tokens

        def run(rows):
            return [pa.array([tokens.decode(np.frombuffer(r or b"", "<u4")) for r in rows], pa.binary())]
        return run

    return map_texts(rows, ids_col, keep, _fields(("decoded", T.BinaryType())), make)


def round_trip(docs: DataFrame, keep: list[str], text_col: str = "text", vocabulary: str | None = None,
               pattern: str | None = None) -> DataFrame:
    """Encode, decode the ids again, and digest both in the same task: the
    ``keep`` columns, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined
    by commas) and ``decoded_sha256`` (of the decoded bytes)."""
    path = vocabulary or vocabulary_path(VOCABULARY)

    def make():
        import hashlib

        import numpy as np
        import pyarrow as pa
        bpe = ByteBPE(path, pattern)
        text_of = Decimals(bpe.replay.width, b",")

        def run(texts):
            ids, n = bpe.encode_batch([t or "" for t in texts])
            ends = np.cumsum(n).tolist()
            coded, decoded = [], []
            for a, b in zip([0, *ends], ends):
                coded.append(hashlib.sha256(text_of(ids[a:b])[:-1]).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids[a:b])).hexdigest())
            return pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())
        return run

    return map_texts(docs, text_col, keep, _fields(
        ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())), make,
        BLOCK_CHARS)


class Decimals:
    """Numbers below ``n`` as decimal text, each followed by one of ``marks``."""

    def __init__(self, n: int, marks: bytes):
        import numpy as np
        wide = len(str(n)) + 1
        self.n = n
        cells = [b"%d%c" % (i, m) for m in marks for i in range(n)]
        self.cells = np.array(cells, f"S{wide}")

    def __call__(self, ids, mark=0) -> bytes:
        return self.cells[ids + self.n * mark].tobytes().translate(None, b"\0")
