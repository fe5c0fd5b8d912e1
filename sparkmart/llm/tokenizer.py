"""Byte-pair encoding with a public vocabulary, for use inside tasks.

The vocabulary file (``base64 rank`` per line) is a parameter; the driver reads it and broadcasts its
bytes (under 1 MB, fixed).  Texts are encoded exactly as the tokenizer does on the whole text; words
after a single space are looked up in a bounded cache, since no token spans such a border.
"""

from __future__ import annotations

import base64
import re

import numpy as np

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Split pattern of this vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_WORDS = 200_000
_TWO_SPACES = re.compile(r"\s\s")
_HELD: dict[int, "Encoder"] = {}


def load_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class _Words(dict):
    """Token bytes of ' word', kept for the first ``CACHE_WORDS`` words met."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word):
        out = self.encode(" " + word)
        if len(self) < CACHE_WORDS:
            self[word] = out
        return out


class Encoder:
    def __init__(self, vocabulary: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.encoding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.eos = max(ranks.values()) + 1  # the first free id ends a document
        self.dtype = np.dtype("<u2") if self.eos < 1 << 16 else np.dtype("<u4")
        self.lengths = np.zeros(self.eos + 1, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        self.words = _Words(self._direct)

    def _direct(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype=self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian bytes of ``dtype``."""
        if not text:
            return b""
        if _TWO_SPACES.search(text):
            return self._direct(text)
        head, *rest = text.split(" ")
        return (self._direct(head) if head else b"") + b"".join(map(self.words.__getitem__, rest))

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), dtype=self.dtype)


def encoder(vocabulary) -> Encoder:
    """The worker's encoder of a broadcast vocabulary (kept for the life of the worker)."""
    if vocabulary.value.__hash__() not in _HELD:
        _HELD.clear()
        _HELD[vocabulary.value.__hash__()] = Encoder(vocabulary.value)
    return _HELD[vocabulary.value.__hash__()]
