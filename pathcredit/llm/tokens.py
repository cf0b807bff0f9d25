"""Byte-level BPE ids of whole texts from a public vocabulary file.

Ids are those of the ``tokenizers`` library for the same vocabulary.  The
vocabulary's special text has an id of its own wherever it stands.  Texts are
encoded whole, nothing of one is kept for the next: where many words are rare,
looking words up in a table of those seen costs more than their merges.  A long
text is cut before single spaces, where no pre-token reaches across, so the
lists of ids that stand at a time are bounded.
"""

from __future__ import annotations

import base64
import re

import numpy as np

VOCABULARY = "byte_bpe_50k"
# Fixed value: the vocabulary's special text; its id follows those of all pieces.
SPECIAL = "<|endoftext|>"
_LONG = 1 << 20
_SINGLE = re.compile(r"\S \S")
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    def __init__(self, name: str):
        import public_tokenizers as public
        import tiktoken

        with open(public.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._bpe = tiktoken.Encoding("public", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._special = np.array([len(ranks)], "<u4").tobytes()

    def _ids(self, text: str) -> bytes:
        return np.array(self._bpe.encode_ordinary(text), "<u4").tobytes()

    def _whole(self, text: str) -> bytes:
        """The ids of a text without the special text."""
        if len(text) <= _LONG:
            return self._ids(text)
        parts, start = [], 0
        while cut := _SINGLE.search(text, start + _LONG):
            parts.append(self._ids(text[start : cut.start() + 1]))
            start = cut.start() + 1
        return b"".join([*parts, self._ids(text[start:])])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as little-endian unsigned 32-bit integers."""
        return [self._special.join([self._whole(x) for x in t.split(SPECIAL)]) for t in texts]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def encoder(name: str = VOCABULARY) -> Encoder:
    """One encoder a worker process."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]
