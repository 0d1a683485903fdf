"""Token ids of texts by a byte-level BPE vocabulary file of the tokenizers library."""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
import tiktoken.registry

# Fixed value: how texts are split before the byte pairs are merged.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of() -> dict[str, int]:
    """Which byte each letter of the vocabulary stands for.

    Printable bytes stand for themselves; the others follow, in order, from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = _byte_of()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in spec["model"]["vocab"].items() if token not in special
    }
    return tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


# Blanks as the split takes them, in runs too long for its look-ahead.
_LONG_RUN = re.compile(
    "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


class Tokenizer:
    """The ids the tokenizers library gives for ``path``, without special tokens added.

    The file's vocabulary is numbered in the order of its merges, so it is run as ranks, which
    is several times as fast. A special token written out in a text is taken as that token.
    The tasks of a Python worker share one encoding of a file.
    """

    def __init__(self, path: str) -> None:
        known = tiktoken.registry.ENCODINGS
        if path not in known:
            known[path] = _encoding(path)
        self.encoding = known[path]

    def __call__(self, text: str) -> np.ndarray:
        """Ids of a text of any length.

        The split cannot look past a very long run of blanks, which are one pre-token: all of
        them before a special token or the end, else all but the last, which goes with what
        follows. Such runs are merged by themselves.
        """
        special = tuple(self.encoding.special_tokens_set)
        parts, at = [], 0
        for run in _LONG_RUN.finditer(text):
            end = run.end()
            if end < len(text) and not text.startswith(special, end):
                end -= 1
            parts.append(self._plain(text[at: run.start()]))
            parts.append(np.array(self.encoding._encode_single_piece(text[run.start(): end]), np.uint32))
            at = end
        return np.concatenate([*parts, self._plain(text[at:])]) if parts else self._plain(text)

    def _plain(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all")
