"""Token ids of whole texts by a byte-level vocabulary."""

from __future__ import annotations

import base64
from functools import cached_property, lru_cache

import numpy as np


class Tokens:
    """Ids as the tokenizers library gives them for ``json_path``, special tokens in a text read as such.

    The same vocabulary's ranks file is read by tiktoken, in a quarter of the time. Its pattern engine gives up on some
    texts, such as a million blanks in a row; those are encoded by the tokenizers library itself.
    """

    def __init__(self, ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...], json_path: str | None = None):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.quick = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))
        self.json_path = json_path

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.json_path)

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.quick.encode_to_numpy(text, allowed_special="all").astype("<u4")
        except ValueError:
            if self.json_path is None:
                raise
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=2)
def tokens(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...], json_path: str | None = None) -> Tokens:
    """One of each in a Python worker."""
    return Tokens(ranks_path, pattern, special, json_path)
