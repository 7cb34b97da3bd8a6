"""SentencePiece BPE by backtracking: longest matches, pair checks, failed positions.

A token sequence is the BPE encoding of a text exactly if every two neighbours
are what merging *their* joint text gives. So no merging of whole texts is
needed: an Aho-Corasick automaton names the tokens that start at each position,
the longest is tried first, a token that doesn't agree with the one before it is
replaced by the next shorter one, and a position from which nothing fits is
marked in a bitfield and never tried again. Each prefix has one encoding, so a
mark holds for every way of getting there, and the work is linear in the text.

The model must be of type BPE, with byte fallback and the identity normaliser
(white space becomes ``▁``, one ``▁`` is put before the text).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import ahocorasick
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from tidemark.llm.common import id_and_text, kept, map_rows

SPACE = "▁"
#: Distinct words kept with their tokens in a worker; then the memory starts anew.
REMEMBERED = 500_000


class Codec:
    """Encoder and decoder for one model file."""

    def __init__(self, model: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered  # words; token pairs twice as many
        table = SentencePieceProcessor(model_file=model)
        self.end_id = table.eos_id()
        self.unknown_id = table.unk_id()
        self.pieces: list[str] = []
        self.bytes_of: dict[int, int] = {}
        self.silent: set[int] = set()
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.finder = ahocorasick.Automaton()
        for i in range(table.get_piece_size()):
            piece = table.id_to_piece(i)
            self.pieces.append(piece)
            if table.is_byte(i):
                self.bytes_of[i] = int(piece[3:5], 16)
                self.byte_id[self.bytes_of[i]] = i
            elif table.is_control(i):
                self.silent.add(i)
            elif not table.is_unknown(i):
                self.score[piece] = table.get_score(i)
                self.id_of[piece] = i
                self.finder.add_word(piece, (i, len(piece) - 1))
        self.finder.make_automaton()
        self.lengths = [len(piece) for piece in self.pieces]
        #: The longest token that a token starts with, itself apart; -1: none.
        self.shorter = [
            next((self.id_of[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.id_of), -1)
            for p in self.pieces
        ]
        if any(SPACE in piece.lstrip(SPACE) for piece in self.id_of):
            raise ValueError("a piece reaches over the start of a word: texts can't be cut into words")
        # Characters that can be part of a longer token; any other stands alone.
        self.joined = {c for piece in self.id_of if len(piece) > 1 for c in piece}
        alone = "".join(re.escape(c) for c in "\n\t" if c not in self.joined)
        self.cut = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]", re.DOTALL).findall
        self.agrees: dict[tuple[int, int], bool] = {}
        #: Of each remembered part: how many ids it has, these as text, and its decoded text.
        self.words: dict[str, tuple[int, str, str]] = {}

    def merged(self, text: str) -> list[str]:
        """BPE by merging, best score first, then leftmost. For the text of a pair or so."""
        symbols = list(text)
        score = self.score.get
        offers = [score(a + b) for a, b in zip(symbols, symbols[1:])]
        while found := [x for x in offers if x is not None]:
            at = offers.index(max(found))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del offers[at]
            if at:
                offers[at - 1] = score(symbols[at - 1] + symbols[at])
            if at < len(offers):
                offers[at] = score(symbols[at] + symbols[at + 1])
        return symbols

    def fits(self, left: int, right: int) -> bool:
        """Whether re-merging the two tokens' text gives the two (left -1: the start)."""
        pair = [self.pieces[right]] if left < 0 else [self.pieces[left], self.pieces[right]]
        if len(self.agrees) >= 2 * self.remembered:
            self.agrees.clear()
        known = self.agrees[left, right] = self.merged("".join(pair)) == pair
        return known

    def encode_part(self, part: str) -> list[int]:
        """Ids of a part that no token crosses."""
        if self.joined.issuperset(part):
            return self._backtrack(part)
        ids: list[int] = []
        for joined, run in groupby(part, self.joined.__contains__):
            if joined:
                ids += self._backtrack("".join(run))
            else:
                for c in run:
                    ids += [self.id_of[c]] if c in self.id_of else [self.byte_id[b] for b in c.encode()]
        return ids

    def _backtrack(self, part: str) -> list[int]:
        end = len(part)
        longest = [-1] * (end + 1)  # at each start; the automaton reports longer matches later
        for last, (token, before) in self.finder.iter(part):
            longest[last - before] = token
        failed = bytearray(end // 8 + 1)
        lengths, shorter, agrees = self.lengths, self.shorter, self.agrees
        found: list[int] = []
        left, at, token = -1, 0, longest[0]
        while at < end:
            while token >= 0:
                to = at + lengths[token]
                if not failed[to >> 3] >> (to & 7) & 1:
                    known = agrees.get((left, token))
                    if known or known is None and self.fits(left, token):
                        break
                token = shorter[token]
            if token >= 0:
                found.append(token)
                left, at, token = token, to, longest[to]
            elif found:
                failed[at >> 3] |= 1 << (at & 7)
                at -= lengths[left]
                token = shorter[found.pop()]
                left = found[-1] if found else -1
            else:  # a character of longer tokens that is no token itself
                return self._by_merging(part)
        return found

    def _by_merging(self, part: str) -> list[int]:
        ids: list[int] = []
        for symbol in self.merged(part):
            ids += [self.id_of[symbol]] if symbol in self.id_of else [self.byte_id[b] for b in symbol.encode()]
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``: bytes in a row are UTF-8, end ids are silent, the first ▁ goes."""
        out: list[str] = []
        run = bytearray()
        started = False
        for i in [*ids, -1]:
            if i in self.bytes_of:
                run.append(self.bytes_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
                started = True
            if i < 0 or i in self.silent:
                continue
            piece = " ⁇ " if i == self.unknown_id else self.pieces[i].replace(SPACE, " ")
            out.append(piece[1:] if not started and self.pieces[i].startswith(SPACE) else piece)
            started = True
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        """All ids of a text, without an end id."""
        ids: list[int] = []
        for part in self.parts_of(text):
            ids += self.encode_part(part)
        return ids

    def parts_of(self, text: str) -> list[str]:
        return self.cut(SPACE + text.replace(" ", SPACE)) if text else []

    def inside(self, part: str, ids: list[int]) -> str:
        """Decoded text of a part's ids behind other text, where its first ▁ is a space."""
        plain = "".join([self.pieces[i] for i in ids])
        if plain == part:  # no bytes, no unknown id: the pieces are the text
            return plain.replace(SPACE, " ")
        return self.decode([self.byte_id[ord("x")], *ids])[1:]

    def known(self, parts: list[str]) -> list[tuple[int, str, str]]:
        """Of each part: the number of its ids, these as text, and its decoded text with the ▁ in front."""
        words = self.words
        out = list(map(words.get, parts))
        if None in out:
            missing = {part for part, entry in zip(parts, out) if entry is None}
            if len(words) + len(missing) > self.remembered:
                words.clear()
            new = {}
            for part in missing:
                ids = self.encode_part(part)
                new[part] = len(ids), " ".join(map(str, ids)), self.inside(part, ids)
            words.update(new)
            out = [entry or new[part] for part, entry in zip(parts, out)]
        return out


def _utf8(run: bytes) -> str:
    """Each byte that isn't part of a whole character becomes U+FFFD."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


def codec(model: str, remembered: int = REMEMBERED) -> Codec:
    """The codec of a model file, once per worker."""
    return kept(("codec", model, remembered), lambda: Codec(model, remembered))


#: What a run can return of each document, by column: type and how it is made.
COLUMNS = {
    "n_tokens": "long",
    "token_ids": "array<int>",
    "decoded": "string",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


def encode_and_decode(
    docs: DataFrame,
    model: str,
    columns: tuple[str, ...] = ("n_tokens", "token_ids", "decoded"),
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Encode each text with an end id, decode the ids again; one row per row of ``docs``.

    ``columns`` picks from COLUMNS; digests are lowercase hex, of the ids in
    decimal joined by one space, and of the decoded text in UTF-8. ``model`` is a
    file every worker can open, which keeps the tokens of ``remembered`` words at most. No
    shuffle: a row depends on its text alone.

    A null text is empty: the end id alone, decoded as "". A null id stays null.
    Repeated rows give repeated results; an empty table gives an empty one; other columns
    don't matter.
    """
    schema = ", ".join(["doc_id long", *(f"{name} {COLUMNS[name]}" for name in columns)])

    def make():
        with_model = codec(model, remembered)
        end = with_model.end_id

        def one(doc_id: int | None, text: str) -> Iterator[tuple]:
            counts, ids, decoded = zip(*with_model.known(with_model.parts_of(text)), (1, str(end), ""))
            ids_text, decoded = " ".join(ids), "".join(decoded)[1:]
            values: list = [doc_id]
            for name in columns:
                if name == "n_tokens":
                    values.append(sum(counts))
                elif name == "token_ids":
                    values.append(list(map(int, ids_text.split())))
                elif name == "ids_sha256":
                    values.append(hashlib.sha256(ids_text.encode()).hexdigest())
                else:
                    digest = hashlib.sha256(decoded.encode()).hexdigest
                    values.append(decoded if name == "decoded" else digest())
            yield tuple(values)

        return one

    return map_rows(id_and_text(docs, id_col, text_col), make, schema, rows=200)
