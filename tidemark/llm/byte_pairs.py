"""Byte-level BPE ids of whole texts, from a tokenizer file of the tokenizers library.

Where the file's ids are in the order of its merges, a text can be encoded by rank alone,
which takes a fifth of the library's time and no memory of words. Texts for which the two
could differ are left to the library: those that hold a special token's name, or letters of
scripts on whose classes regex engines might not agree.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# The vocabulary's own rule of splitting (a fixed value): parts never merge with each other.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Scripts on whose letters and spaces all regex engines agree.
_SETTLED = re.compile("[\t\n\r\x20-\x7e\xa0-ɏͰ-ϿЀ-ӿ‐-‧‰-⁞₠-₿]*").fullmatch


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable characters stand for themselves; the other bytes, in turn, for U+0100 and on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BytePairs:
    """Encoder for one tokenizer file; ``special_as_text`` makes names of special tokens plain text."""

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        alphabet = byte_alphabet()
        #: The bytes of each token.
        self.bytes_of = {i: bytes(alphabet[c] for c in token) for token, i in model["vocab"].items() if set(token) <= alphabet.keys()}
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        names = "|".join(map(re.escape, special)) if special and not special_as_text else r"(?!)"
        self.special = re.compile(names).search
        merged = [model["vocab"]["".join(pair)] for pair in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        ranks = {raw: i for i, raw in self.bytes_of.items()}
        by_rank = merged == sorted(merged) and len(ranks) == len(model["vocab"]) == 256 + len(merged)
        self.by_rank = tiktoken.Encoding("byte pairs", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}) if by_rank else None

    def ids(self, text: str) -> np.ndarray:
        if self.by_rank is None or not _SETTLED(text) or self.special(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.by_rank.encode_ordinary(text), np.uint32)


@lru_cache(maxsize=2)
def byte_pairs(path: str, special_as_text: bool = False) -> BytePairs:
    """The encoder of a file, once per worker."""
    return BytePairs(path, special_as_text)
