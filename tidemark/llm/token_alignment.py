"""Alignment of two tokenizers' tokens over the bytes of the same text.

A byte-level BPE (side A, of a space and the text) and a SentencePiece model (side B, which
puts that space itself) cut the same bytes at different places. Per batch of documents, two
as-of merges by pandas, keyed by document, name for each token's start the token of the
other side that covers it. Together they give all overlapping pairs: of two tokens that
overlap, the later one starts inside the other. Places where both sides start a token cut
the text into groups, the least stretches that both sides hold whole.

Counts of id pairs are corpus-wide. A chunk of ``CHUNK`` characters in batches is summed up
to its distinct pairs before anything is shuffled; these are counted by pair, compared by B id,
and handed back to the chunks that hold them, whose documents then add them up. A pair in
every document costs a row per chunk, and nothing grows with the vocabulary in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tidemark.llm.byte_pairs import byte_pairs
from tidemark.llm.common import arrow_schema, id_and_text
from tidemark.llm.components import stored

#: Characters of the texts aligned together, or one longer text.
BATCH = 250_000
#: Characters of a chunk, to the end of its last batch.
CHUNK = 4_000_000


class Side:
    """One tokenizer: bytes of each id, their lengths, and the ids' decimals."""

    def __init__(self, bytes_of: dict[int, bytes]) -> None:
        size = max(bytes_of) + 1
        self.bytes_of = [bytes_of.get(i, b"") for i in range(size)]
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.size = size


class Aligner:
    """Both tokenizers, from their files."""

    def __init__(self, byte_pairs_file: str, pieces_file: str) -> None:
        self.first = byte_pairs(byte_pairs_file, special_as_text=True)
        self.second = SentencePieceProcessor(model_file=pieces_file)
        self.a = Side(self.first.bytes_of)
        table = self.second
        self.b = Side(
            {
                i: bytes([int(table.id_to_piece(i)[3:5], 16)]) if table.is_byte(i) else table.id_to_piece(i).replace("▁", " ").encode()
                for i in range(table.get_piece_size())
            }
        )
        # Decimals with what stands behind them: in a run; at its end, before the other side's or the next group's.
        self.shown = [
            *(f"{i}{end}" for end in ",|" for i in range(self.a.size)),
            *(f"{i}{end}" for end in ",;" for i in range(self.b.size)),
        ]

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Ids of both sides; none where a side's bytes aren't those of a space and the text."""
        ids_a, ids_b = [], self.second.encode(texts, num_threads=1)
        for i, text in enumerate(texts):
            whole = b" " + text.encode()
            found = self.first.ids(" " + text) if text else ()
            same = all(
                b"".join(map(side.bytes_of.__getitem__, ids)) == whole
                for side, ids in ((self.a, list(found)), (self.b, ids_b[i]))
            )
            ids_a.append(found if text and same else ())
            if not text or not same:
                ids_b[i] = []
        return ids_a, ids_b


@lru_cache(maxsize=1)
def aligner(byte_pairs_file: str, pieces_file: str) -> Aligner:
    """The tokenizers of two files, once per worker."""
    return Aligner(byte_pairs_file, pieces_file)


class Alignment:
    """Tokens, links and groups of a batch of texts.

    ``ids``, ``doc`` and ``begins`` (whether a token starts a group) by side; ``links`` are
    token numbers of both sides, by document, ascending.
    """

    def __init__(self, tokenizers: Aligner, texts: list[str]) -> None:
        self.tokenizers = tokenizers
        self.n = len(texts)
        self.ids, self.doc, frames = [], [], []
        for side, ids in zip((tokenizers.a, tokenizers.b), tokenizers.encode(texts)):
            sizes = [len(x) for x in ids]
            flat = np.concatenate([np.asarray(x, np.int64) for x in ids]) if ids else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(self.n), sizes)
            ends = np.cumsum(side.lengths[flat])  # documents head to tail, alike on both sides
            frames.append(pd.DataFrame({"start": ends - side.lengths[flat], "doc": doc, "token": np.arange(len(flat))}))
            self.ids.append(flat)
            self.doc.append(doc)
        a, b = frames
        over_a, over_b = _covering(a, b), _covering(b, a)
        start_a, start_b = a["start"].to_numpy(), b["start"].to_numpy()
        self.begins = [start_b[over_a] == start_a, start_a[over_b] == start_b]
        inside = np.flatnonzero(~self.begins[1])  # the others are found from the A side already
        links = np.concatenate([np.stack([np.arange(len(a)), over_a]), np.stack([over_b[inside], inside])], axis=1)
        self.links = links[:, np.lexsort((links[1], links[0]))]
        self.link_doc = self.doc[0][self.links[0]]

    def counts(self) -> dict[str, np.ndarray]:
        """Of each document: tokens of both sides, groups, links."""
        of = {"n_a": self.doc[0], "n_b": self.doc[1], "n_groups": self.doc[0][self.begins[0]], "n_links": self.link_doc}
        return {name: np.bincount(doc, minlength=self.n) for name, doc in of.items()}

    def pairs(self) -> np.ndarray:
        """The id pair of each link, as one number."""
        return self.ids[0][self.links[0]] * self.tokenizers.b.size + self.ids[1][self.links[1]]

    def groups(self) -> Iterator[str]:
        """Of each document: its groups' ids in order, as ``a1,a2|b1;a3|b2,b3``."""
        sizes = [self.tokenizers.a.size, self.tokenizers.b.size]
        group = [np.cumsum(begins) - 1 for begins in self.begins]
        total = int(group[0][-1]) + 1 if len(group[0]) else 0
        upto = [np.append(0, np.cumsum(np.bincount(g, minlength=total))) for g in group]
        codes = np.zeros(len(self.ids[0]) + len(self.ids[1]), np.int64)
        for side in (0, 1):
            last = np.append(self.begins[side][1:], True)[: len(self.ids[side])]
            place = np.arange(len(self.ids[side])) + upto[1 - side][group[side] + side]
            codes[place] = self.ids[side] + sizes[side] * last + (2 * sizes[0] if side else 0)
        shown = list(map(self.tokenizers.shown.__getitem__, codes.tolist()))
        edges = np.append(0, np.cumsum(np.bincount(np.concatenate(self.doc), minlength=self.n))).tolist()
        for low, high in zip(edges, edges[1:]):
            yield "".join(shown[low:high])[:-1]


def _covering(tokens: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
    """Of each token, the other side's token that covers its start."""
    found = pd.merge_asof(tokens[["start", "doc"]], others, on="start", by="doc")
    return found["token"].to_numpy(np.int64)


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of documents with about ``BATCH`` characters together."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if size and size + len(text) > BATCH:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if ids:
        yield ids, texts


def _split(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list of the next ``sizes`` values in each row."""
    edges = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(values, kind))


_KINDS = {
    "n_a": "long",
    "n_b": "long",
    "n_groups": "long",
    "n_links": "long",
    "a_ids": "array<int>",
    "b_ids": "array<int>",
    "links": "array<int>",
    "groups": "string",
    "groups_sha256": "string",
}


def _columns(found: Alignment, columns: tuple[str, ...]) -> dict[str, pa.Array]:
    counts = found.counts()
    values: dict[str, pa.Array] = {name: pa.array(n, pa.int64()) for name, n in counts.items()}
    for name, ids in zip(("a_ids", "b_ids"), found.ids):
        if name in columns:
            values[name] = _split(ids, counts[f"n_{name[0]}"], pa.int32())
    if "links" in columns:
        first = [np.append(0, np.cumsum(counts[n])[:-1])[found.link_doc] for n in ("n_a", "n_b")] if found.n else [0, 0]
        values["links"] = _split((found.links - np.stack(first)).T.ravel(), 2 * counts["n_links"], pa.int32())
    if "groups" in columns or "groups_sha256" in columns:
        shown = list(found.groups())
        values["groups"] = pa.array(shown)
        values["groups_sha256"] = pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in shown])
    return {name: values[name] for name in columns}


def align(
    docs: DataFrame,
    byte_pairs_file: str,
    pieces_file: str,
    columns: tuple[str, ...] = ("n_a", "n_b", "a_ids", "b_ids", "links", "groups"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each text's tokens on both sides and how they overlap; one row per row of ``docs``.

    ``links`` has the numbers of the A and the B token of each overlapping pair in turn, in
    order; ``groups`` the ids of the groups, as ``a1,a2|b1;a3|b2,b3``. The files are opened
    by every worker; names of special tokens inside texts are plain text.

    Null and empty texts, and those whose tokens on either side don't spell a space and the
    text, have no tokens: zeros, empty lists, "" as ``groups`` and as its digest. A null id
    stays null; repeated rows give repeated results; a very long text is a chunk of its own;
    an empty table gives an empty one; other columns don't matter. No shuffle.
    """
    schema = ", ".join(["doc_id long", *(f"{c} {_KINDS[c]}" for c in columns)])
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = aligner(byte_pairs_file, pieces_file)
        for ids, texts in _batches(batches):
            values = _columns(Alignment(tokenizers, texts), columns)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *values.values()], schema=arrow)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def _summed_chunks(docs: DataFrame, byte_pairs_file: str, pieces_file: str, columns: tuple[str, ...]) -> DataFrame:
    """Rows of documents, and for each chunk a row with its distinct id pairs and their counts.

    ``places`` and ``times`` of a document are numbers of its distinct pairs among those of
    its chunk, and how often it has them. Chunks without pairs have no such row.
    """
    schema = ", ".join(
        [
            "chunk long, doc_id long, places array<int>, times array<int>, pairs array<long>, counts array<long>",
            *(f"{c} {_KINDS[c]}" for c in columns),
        ]
    )
    arrow = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = aligner(byte_pairs_file, pieces_file)
        chunk = TaskContext.get().partitionId() << 32
        place_of: dict[int, int] = {}
        counts = np.zeros(0, np.int64)
        size = 0

        def as_batch(row: dict, n: int) -> pa.RecordBatch:
            row["chunk"] = pa.array([chunk] * n, pa.int64())
            return pa.RecordBatch.from_arrays([row.get(f.name, pa.nulls(n, f.type)) for f in arrow], schema=arrow)

        def summed() -> pa.RecordBatch:
            return as_batch({"pairs": pa.array([list(place_of)]), "counts": pa.array([counts])}, 1)

        for ids, texts in _batches(batches):
            found = Alignment(tokenizers, texts)
            pairs, own, amounts = np.unique(found.pairs(), return_inverse=True, return_counts=True)
            places = np.array([place_of.setdefault(pair, len(place_of)) for pair in pairs.tolist()], np.int64)
            counts = np.append(counts, np.zeros(len(place_of) - len(counts), np.int64))
            counts[places] += amounts
            own, times = np.unique(found.link_doc * max(1, len(pairs)) + own, return_counts=True)
            doc, own = np.divmod(own, max(1, len(pairs)))
            sizes = np.bincount(doc, minlength=found.n)
            rows = {
                "doc_id": pa.array(ids, pa.int64()),
                "places": _split(places[own], sizes, pa.int32()),
                "times": _split(times, sizes, pa.int32()),
            }
            yield as_batch(rows | _columns(found, columns), found.n)
            size += sum(map(len, texts))
            if size >= CHUNK:
                yield summed()
                place_of, counts, size = {}, counts[:0], 0
                chunk += 1
        if place_of:
            yield summed()

    return stored(docs.mapInArrow(run, schema))


def link_counts(pairs: DataFrame) -> DataFrame:
    """Corpus-wide count of each (a, b) in ``pairs`` (a, b, n), and whether it is b's highest (ties included)."""
    counted = pairs.groupBy("b", "a").agg(F.sum("n").alias("count"))
    highest = F.max("count").over(Window.partitionBy("b"))  # at most one row for each A id
    return counted.select("a", "b", "count", (F.col("count") == highest).alias("best"))


def align_and_rate(
    docs: DataFrame,
    byte_pairs_file: str,
    pieces_file: str,
    columns: tuple[str, ...] = ("n_a", "n_b", "n_groups", "n_links", "groups"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """As ``align``, with ``n_best`` and ``count_sum`` of each document's links.

    The count of an id pair is how many links of all documents hold it. ``count_sum`` adds
    the counts of a document's links; ``n_best`` is how many have their B id's highest
    count. Cases are those of ``align``; repeated rows count repeatedly. Runs a job when
    called, which stores the chunks in the shared folder.
    """
    chunks = _summed_chunks(id_and_text(docs, id_col, text_col), byte_pairs_file, pieces_file, columns)
    size = SentencePieceProcessor(model_file=pieces_file).get_piece_size()
    held = chunks.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "x"))
    b = (F.col("x.pairs") % size).cast("int")
    held = held.select("chunk", "place", ((F.col("x.pairs") - b) / size).cast("int").alias("a"), b.alias("b"), F.col("x.counts").alias("n"))
    rated = held.drop("n").join(link_counts(held.select("a", "b", "n")), ["a", "b"]).select(F.col("chunk").alias("of"), "place", "count", "best")
    own = chunks.where("pairs is null").drop("pairs", "counts")
    schema = ", ".join(["doc_id long", *(f"{c} {_KINDS[c]}" for c in columns), "n_best long", "count_sum long"])
    arrow = arrow_schema(schema)

    def add_up(mine: pa.Table, pairs: pa.Table) -> pa.Table:
        """Of one chunk: its documents and its pairs."""
        place = pairs["place"].to_numpy()
        rating = np.zeros((2, int(place.max(initial=-1)) + 1), np.int64)
        rating[:, place] = pairs["best"].to_numpy(), pairs["count"].to_numpy()
        places, times = (mine[c].combine_chunks() for c in ("places", "times"))
        edges = np.append(0, np.cumsum(places.value_lengths().to_numpy()))
        sums = np.zeros((2, len(places.flatten()) + 1), np.int64)
        np.cumsum(rating[:, places.flatten().to_numpy()] * times.flatten().to_numpy(), axis=1, out=sums[:, 1:])
        n_best, count_sum = sums[:, edges[1:]] - sums[:, edges[:-1]]
        values = [mine["doc_id"], *(mine[c] for c in columns), pa.array(n_best), pa.array(count_sum)]
        return pa.Table.from_arrays(values, schema=arrow)

    return own.groupBy("chunk").cogroup(rated.groupBy("of")).applyInArrow(add_up, schema)
