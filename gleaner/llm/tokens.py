"""Token ids of whole texts, with public vocabularies.

The ids are those of the ``tokenizers`` file. Texts of code points below U+0250 are encoded by ``tiktoken`` from the ranks of
the same vocabulary, which gives the same ids several times faster; every other text by ``tokenizers`` itself, since
the two libraries may hold Unicode tables of different age.
"""

from __future__ import annotations

import base64
import json
import re
from typing import NamedTuple

import numpy as np


def _installed(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary(NamedTuple):
    """Paths of a vocabulary; they have to exist on every executor."""

    file: str
    ranks: str | None
    pattern: str | None

    @staticmethod
    def byte_bpe_50k() -> Vocabulary:
        import public_tokenizers

        return Vocabulary(_installed("byte_bpe_50k.json"), _installed("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


#: A document ends with this id.
END = 0
_OTHER = re.compile("[^\x00-ɏ]")
_encoders: dict[Vocabulary, Encoder] = {}


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary.file)
        self.size = self.exact.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.fast = None
        if vocabulary.ranks:
            import tiktoken

            with open(vocabulary.ranks, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            with open(vocabulary.file, encoding="utf-8") as file:
                special = {x["content"]: x["id"] for x in json.load(file)["added_tokens"] if x["special"]}
            self.fast = tiktoken.Encoding("fast", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str | None) -> np.ndarray:
        """The ids of a text and the closing id; null is empty."""
        text = text or ""
        if self.fast is not None and (text.isascii() or not _OTHER.search(text)):
            found = self.fast.encode_to_numpy(text, allowed_special="all")
        else:
            found = np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        out = np.empty(len(found) + 1, self.kind)
        out[:-1] = found
        out[-1] = END
        return out


def encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per worker process."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]
