"""Token ids of texts with a tokenizers-library file, inside Arrow tasks."""

from __future__ import annotations

import json
import os

from marginflow.llm.common import process_cache

#: Entries kept in a worker's table of pieces already encoded.
CACHE_ENTRIES = 500_000


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _split_pattern(spec: dict) -> str | None:
    """The pre-tokenizer's pattern if pieces are independent and marked at
    their end (split pattern with white space removed, then word-end BPE)."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    kinds = [s.get("type") for s in steps]
    if (kinds != ["Split", "ByteLevel"] or steps[0].get("behavior") != "Removed"
            or not steps[0].get("invert") or steps[1].get("use_regex")
            or steps[1].get("add_prefix_space")
            or spec["model"].get("end_of_word_suffix") != "</w>"
            or "Lowercase" not in json.dumps(spec.get("normalizer"))):
        return None
    return steps[0]["pattern"].get("Regex")


def _latin_pattern(pattern: str):
    """The same pattern for the standard library's faster matcher, its classes
    written out over Latin-1, where both libraries agree."""
    import re

    import regex
    latin = [chr(i) for i in range(256)]
    for cls in (r"\p{L}", r"\p{N}", r"\s"):
        pattern = pattern.replace(cls, "".join(re.escape(c) for c in latin if regex.match(cls, c)))
    return re.compile(pattern)


def _bare(tok):
    """The file's model for pieces already lowered and cut, one per blank."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit
    bare = Tokenizer(tok.model)
    bare.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
    return bare


class WordEncoder:
    """Encodes whole texts; remembers the ids of pieces already encoded.

    With a vocabulary such as ``word_bpe_49k.json`` a text's ids are those of
    its pre-tokenizer pieces one after the other.  Pieces not seen before are
    encoded by the library many at a time and told apart by the word-end mark
    of their last token.  Words outside printable Latin-1 are encoded by the
    library one by one; a text that spells a special token, or any text of
    another kind of vocabulary, in one piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        held = process_cache("tokenizers")
        if path not in held:
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)
            with open(path, encoding="utf-8") as f:
                pattern = _split_pattern(json.load(f))
            ends = np.zeros(tok.get_vocab_size(with_added_tokens=True), bool)
            for token, i in tok.get_vocab(with_added_tokens=True).items():
                ends[i] = token.endswith("</w>")
            held[path] = (tok, pattern and _latin_pattern(pattern), ends, {}, _bare(tok))
        self.tok, self.pattern, self.ends, self.pieces, self.bare = held[path]
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.width = 2 if len(self.ends) <= 0x10000 else 4
        self.dtype = f"<u{self.width}"

    def _whole(self, texts: list[str]) -> list[bytes]:
        import numpy as np
        return [np.asarray(e.ids, self.dtype).tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        import numpy as np
        for at in range(0, len(new), 2000):
            part = new[at:at + 2000]
            ids = np.asarray(self.bare.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids,
                             self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                raw, start = ids.tobytes(), 0
                for p, stop in zip(part, (stops * self.width).tolist()):
                    self.pieces[p] = raw[start:stop]
                    start = stop
            else:
                self.pieces.update(zip(part, self._whole(part)))

    def _cut(self, text: str) -> list[str]:
        """Pieces of the text, learning the odd words on the way."""
        flat = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        try:
            flat.encode("latin-1")
            if flat.isprintable():
                return self.pattern.findall(flat.lower())
        except UnicodeEncodeError:
            pass
        out: list[str] = []
        for w in flat.split(" "):
            if w.isprintable() and (w.isascii() or max(w) < "Ā"):
                out += self.pattern.findall(w.lower())
            else:
                if w not in self.pieces:
                    self.pieces[w] = self._whole([w])[0]
                out.append(w)
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Per text, its ids as little-endian unsigned ints of ``width`` bytes."""
        whole = [t for t in texts if self.pattern is None or any(s in t for s in self.special)]
        known = dict(zip(whole, self._whole(whole))) if whole else {}
        if len(self.pieces) > CACHE_ENTRIES:
            self.pieces.clear()
        cut = [None if t in known else self._cut(t) for t in texts]
        new: set[str] = set()
        for ps in cut:
            new.update(set(ps or ()).difference(self.pieces))
        self._learn(list(new))
        get = self.pieces.__getitem__
        return [known[t] if ps is None else b"".join(map(get, ps)) for t, ps in zip(texts, cut)]
