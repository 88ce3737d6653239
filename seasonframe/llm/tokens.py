"""Readers of public tokenizer files. The files stay where they are; only their paths are given."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import tiktoken

#: White space that the split pattern is spared.
LONG_RUN = 2000
#: How byte-level vocabularies split a text before their merges (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes get, in order, the
    characters from U+0100 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def byte_encoder(path: str, long_run: int = LONG_RUN) -> Callable[[str], np.ndarray]:
    """An encoder for a byte-level BPE file: text to ids, special tokens in the text included.

    The merges are those of the file; they must be in the order of their ids, as in files whose
    ranks are ids, otherwise this raises. White space of ``long_run`` characters or more is cut out
    first, since the split pattern goes back over it character by character.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    byte_of = {char: byte for byte, char in byte_alphabet().items()}
    vocab = described["model"]["vocab"]
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in described["model"]["merges"]]
    if merged != sorted(merged) or described["pre_tokenizer"].get("add_prefix_space") or described["normalizer"]:
        raise ValueError(f"{path}: not a plain byte-level BPE file with ids in merge order")
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    encoding = tiktoken.Encoding("from-file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    one_piece = tiktoken.Encoding("one-piece", pat_str=r"[\s\S]++", mergeable_ranks=ranks, special_tokens={})
    blank = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{long_run},}}")

    def encode(text: str) -> np.ndarray:
        runs = [m.span() for m in blank.finditer(text)]
        if not runs:
            return encoding.encode_to_numpy(text, allowed_special="all")
        parts, at = [], 0
        for start, end in runs:
            # a run is one word, but for its last character if a word follows
            followed = end < len(text) and not any(text.startswith(token, end) for token in special)
            stop = end - 1 if followed else end
            parts.append(encoding.encode_to_numpy(text[at:start], allowed_special="all"))
            parts.append(one_piece.encode_to_numpy(text[start:stop]))
            at = stop
        parts.append(encoding.encode_to_numpy(text[at:], allowed_special="all"))
        return np.concatenate(parts)

    return encode
