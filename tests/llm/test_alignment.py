"""Alignment of two tokenizers: brute force over bytes, corpus counts, awkward rows."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import queries, token_alignment

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.json")
FIRST = Tokenizer.from_file(BYTE_PAIRS)
FIRST.encode_special_tokens = True
SECOND = SentencePieceProcessor(model_file=PIECES)
#: The byte-level alphabet, by encoding each byte's place in it: printable ones stand for themselves.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


def tokens_of(text):
    """(id, bytes) on both sides, or none."""
    if not text:
        return [], []
    a = [(i, bytes(BYTE[c] for c in FIRST.id_to_token(i))) for i in FIRST.encode(" " + text, add_special_tokens=False).ids]
    piece = lambda i: bytes([int(SECOND.id_to_piece(i)[1:-1], 16)]) if SECOND.is_byte(i) else SECOND.id_to_piece(i).replace("▁", " ").encode()
    b = [(i, piece(i)) for i in SECOND.encode(text)]
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((at, at + len(raw), i))
        at += len(raw)
    return out


def expected_rows(rows):
    """The contract's rows, each pair of tokens compared."""
    found = []
    for doc_id, text in rows:
        a, b = map(spans, tokens_of(text))
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in a} & {y[1] for y in b})
        parts = []
        for low, high in zip([0, *cuts], cuts):
            side = lambda t: ",".join(str(x[2]) for x in t if low <= x[0] < high)  # noqa: B023, E731
            parts.append(f"{side(a)}|{side(b)}")
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""
        found.append((doc_id, len(a), len(b), len(cuts), len(links), digest, links))
    counts = Counter(pair for row in found for pair in row[-1])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (*row, sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links)) for *row, links in found
    ]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
ODD = [
    (20, "ñandú  中文 é😀 \x00 \t\n  a"),
    (21, "hi <|endoftext|> there <s> </s> <0x41>"),
    (22, "with ▁ in it"),
    (23, " leading  and trailing  "),
    (24, "unbelievable unbelievables"),
    (25, "\U0001f9d1‍\U0001f680 é"),
]


@pytest.mark.parametrize("batch, chunk", [(token_alignment.BATCH, token_alignment.CHUNK), (300, 1000), (1, 1)])
def test_as_brute_force(spark, docs, corpus, monkeypatch, batch, chunk):
    monkeypatch.setattr(token_alignment, "BATCH", batch)
    monkeypatch.setattr(token_alignment, "CHUNK", chunk)
    rows = [*corpus, *ODD]
    table = docs.union(spark.createDataFrame(ODD, "doc_id long, text string"))
    found = token_alignment.align_and_rate(table, BYTE_PAIRS, PIECES, COLUMNS)
    assert found.columns == ["doc_id", *COLUMNS, "n_best", "count_sum"]
    assert in_order(found.collect()) == in_order(expected_rows(rows))


def test_query_over_its_table(spark):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op13_token_alignment(spark, folder).collect()}
    assert len(rows) == table.count()
    short = [(r.doc_id, r.text) for r in table.where("length(text) < 900").collect()]
    expected = expected_rows(short)
    assert short and all(tuple(rows[r[0]])[1:6] == r[1:6] for r in expected)
    assert all(r.n_best <= r.n_links <= r.count_sum for r in rows.values())


def test_tokens_links_and_groups(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    for row in token_alignment.align(docs, BYTE_PAIRS, PIECES).collect():
        a, b = map(spans, tokens_of(dict(ODD)[row.doc_id]))
        assert (row.a_ids, row.b_ids) == ([x[2] for x in a], [y[2] for y in b])
        assert (row.n_a, row.n_b) == (len(a), len(b)) and (row.doc_id == 22) == (not a)
        links = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] < y[1] and y[0] < x[1]]
        assert list(zip(row.links[::2], row.links[1::2])) == links
        sides = [part.split("|") for part in row.groups.split(";")] if row.groups else []
        assert [int(i) for s in sides for i in s[0].split(",")] == row.a_ids


def test_awkward_rows(spark, awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.where("length(text) < 1000 or text is null").collect()]
    table = awkward.where("length(text) < 1000 or text is null")
    found = token_alignment.align_and_rate(table, BYTE_PAIRS, PIECES, COLUMNS).collect()
    assert in_order(found) == in_order(expected_rows(rows))
    assert token_alignment.align_and_rate(awkward, BYTE_PAIRS, PIECES).count() == 16
    assert token_alignment.align_and_rate(empty, BYTE_PAIRS, PIECES).collect() == []
    assert token_alignment.align(empty, BYTE_PAIRS, PIECES).collect() == []
