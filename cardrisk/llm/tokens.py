"""Token ids as packed bytes, for the operators that count or pack tokens.

Byte-level BPE merges inside pre-tokens only, so a text's ids are those of its pre-tokens in a row. Pre-tokens are found
by the vocabulary's published pattern; the model of ``tokenizers`` encodes each distinct one once, and a worker
remembers them. Tests hold this against encoding whole texts. A text that spells an added token, or has one of the
control characters on which pattern engines differ, goes through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import regex

#: Pre-tokens remembered by one Python worker before its table starts anew.
CACHE = 600_000
#: Longer pre-tokens are encoded each time, so that the table stays small.
CACHE_CHARS = 64

#: Control characters that some engines count as white space.
_ODD = regex.compile(r"[\x1c-\x1f\x85᠎]")


def byte_alphabet() -> str:
    """The character that stands for each byte: itself where it can be seen, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in seen else chr(next(spare)) for b in range(256))


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, without special tokens added.

    With ``special`` off, a text that spells a special token is plain text like any other.
    """

    def __init__(self, path: str, special: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not special
        shape = json.loads(self._tokenizer.to_str())
        before, model = shape["pre_tokenizer"] or {}, shape["model"]
        self._by_parts = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and model["type"] == "BPE" \
            and not shape["normalizer"]
        self._model = self._tokenizer.model
        self._added = [x["content"] for x in shape["added_tokens"] if special or not x["special"]]
        self._split = regex.compile(public_tokenizers.PATTERN).findall
        self._bytes = {i: c for i, c in enumerate(byte_alphabet())}
        self._known: dict[str, bytes] = {}

    def vocabulary(self) -> dict[str, int]:
        """Tokens, as the file spells them, and their ids; added ones apart."""
        return self._tokenizer.get_vocab(with_added_tokens=False)

    def whole(self, text: str) -> bytes:
        return np.asarray(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, part: str) -> bytes:
        tokens = self._model.tokenize(part.encode().decode("latin-1").translate(self._bytes))
        ids = b"".join([t.id.to_bytes(4, "little") for t in tokens])
        if len(part) <= CACHE_CHARS:
            if len(self._known) >= CACHE:
                self._known.clear()
            self._known[part] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self._by_parts or _ODD.search(text) or any(x in text for x in self._added):
            return self.whole(text)
        known, learn = self._known.get, self._learn
        return b"".join([known(part) or learn(part) for part in self._split(text)])


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    return Encoder(path)


def forget() -> None:
    """Frees the encoders and what they remember. Python workers serve one operator after the other; those that need the memory call it."""
    encoder.cache_clear()


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the same on every machine with the package."""
    import public_tokenizers

    return public_tokenizers.path(name)
