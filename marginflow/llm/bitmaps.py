"""Bitmaps of a fixed number of bits that travel to tasks."""

from __future__ import annotations


class Bitmap:
    """``2^bits`` bits; few set ones travel in little room."""

    def __init__(self, bits: int, words=None):
        import numpy as np
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), np.uint64) if words is None else words

    def __getstate__(self):
        import zstandard
        return self.bits, zstandard.ZstdCompressor(level=1).compress(self.words.tobytes())

    def __setstate__(self, state):
        import numpy as np
        import zstandard
        self.bits = state[0]
        self.words = np.frombuffer(zstandard.ZstdDecompressor().decompress(state[1]), np.uint64)

    def __or__(self, other: "Bitmap") -> "Bitmap":
        return Bitmap(self.bits, self.words | other.words)

    def __eq__(self, other) -> bool:
        return self.bits == other.bits and bool((self.words == other.words).all())

    def has(self, cell):
        """Whether the bits of an int64 array of places are set."""
        import numpy as np
        return (self.words[cell >> 6] >> (cell & 63).astype(np.uint64)) & np.uint64(1) == 1
