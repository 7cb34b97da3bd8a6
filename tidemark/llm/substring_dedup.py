"""Substring dedup by seeds: winnowed anchors, extended both ways to whole windows.

A window is ``window`` consecutive words. Its anchor is the run of ``seed`` words in it
with the least hash, so equal windows have equal anchors, and neighbouring windows mostly
share one: about one anchor in eight words.

1. Exact copies of a text are found by its hash; only the first is looked at further.
2. Seeds: anchors that stand in two documents or more, by one grouping of hashes.
3. Extension: around each seed, left and right, lie the windows whose anchor it is. They
   are hashed and grouped; those that an earlier document has too are repeats.
4. Back in its document, overlapping repeats merge into maximal ones, and their words go.

Groups are pre-summed before the shuffle and never gathered; no pair is ever made.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, least_of_runs, map_arrays, map_rows, rolling_hashes, word_hashes

WINDOW = 20
SEED = 6
#: Texts without an id are ranked behind all ids.
_NO_ID = 1 << 62


def _anchors(hashes: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Of each window of a text: its anchor's hash."""
    return least_of_runs(rolling_hashes(hashes, seed), window - seed + 1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    seed: int = SEED,
    columns: tuple[str, ...] = ("n_words", "n_removed", "spans", "kept"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each document without the words of windows that also start earlier.

    Words are runs of other characters than space and \\t to \\r. Earlier is a smaller id,
    or an earlier start in the same document; windows are judged on the input. ``spans``
    has the starts and ends (in words, end excluded) of the removed maximal repeats in
    turn, ``kept`` the remaining words joined by one space, ``kept_sha256`` its digest.

    Null and empty texts have no words. Texts without an id come last, in the order of
    their hash, and keep a null id. Rows with the same id and text are one document and
    get the same result each; different texts under one id aren't earlier than each other. An
    empty table gives an empty one; other columns don't matter. Windows are compared by 96
    bits of hash, whole texts by 128: a wrong match is expected once in some 10^14 windows.
    Within one text 64 bits decide: of a million windows, two meet once in 10^7 texts.
    """
    table = id_and_text(docs, id_col, text_col)
    # All three columns go along each time, so that the joins by key share one shuffle of texts.
    key = ["rank", "mark"]
    ranked = table.select(
        F.coalesce("doc_id", F.xxhash64("text").bitwiseAND(F.lit(_NO_ID - 1)) + _NO_ID).alias("rank"),
        F.xxhash64("text").alias("mark"),
        "doc_id",
        "text",
    )
    named = ranked.select("rank", "mark", F.col("mark").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    firsts = named.groupBy("t1", "t2").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    copies = (
        named.join(firsts.where("first < last"), ["t1", "t2"])
        .where("rank > first")
        .select("rank", "mark", F.lit(True).alias("copy"))
        .distinct()
    )

    def anchors_of(rank: int, mark: int, _: int | None, text: str) -> tuple:
        found = np.unique(_anchors(word_hashes(text.encode().split()), window, seed))
        return _signed(found), np.full(len(found), rank), np.full(len(found), mark)

    anchors = map_arrays(
        ranked.join(copies, key, "left_anti"),
        lambda: anchors_of,
        "seed long, rank long, mark long",
    )
    shared = anchors.groupBy("seed").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    seeds = (
        anchors.join(shared.where("first < last").select("seed"), "seed")
        .groupBy(*key)
        .agg(F.collect_set("seed").alias("seeds"))
    )

    def windows_of(rank: int, mark: int, _: int | None, text: str, found: list[int]) -> tuple:
        hashes = word_hashes(text.encode().split())
        least = _anchors(hashes, window, seed)
        at = np.flatnonzero(np.isin(_signed(least), np.array(found, np.int64)))
        wide = rolling_hashes(hashes, window, 1)[at]
        wide, first = np.unique(wide, return_index=True)
        at = at[first]
        check = (least[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return _signed(wide), check, np.full(len(at), rank), np.full(len(at), mark), at.astype(np.int32)

    windows = map_arrays(
        ranked.join(seeds, key),
        lambda: windows_of,
        "wide long, check int, rank long, mark long, at int",
    )
    least = windows.groupBy("wide", "check").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    repeats = (
        windows.join(least.where("first < last").select("wide", "check", "first"), ["wide", "check"])
        .where("rank > first")
        .groupBy(*key)
        .agg(F.collect_set("at").alias("starts"))
    )

    def cut(_: int, __: int, doc_id: int | None, text: str, copy: bool | None, starts: list[int] | None):
        words = text.encode().split()
        n = len(words)
        gone = np.zeros(n, bool)
        if copy:
            gone[:] = n >= window
        elif n >= window:
            steps = np.zeros(n + 1, np.int32)
            wide = rolling_hashes(word_hashes(words), window, 1)
            first = np.unique(wide, return_index=True)[1]
            again = np.ones(len(wide), bool)
            again[first] = False  # the document has no earlier window like it
            again[starts or []] = True
            at = np.flatnonzero(again)
            steps[at] += 1
            steps[at + window] -= 1  # starts differ, so no index stands twice
            gone = np.cumsum(steps)[:n] > 0
        kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if gone.any() else b" ".join(words)
        values: list = [doc_id]
        for name in columns:
            if name == "n_words":
                values.append(n)
            elif name == "n_removed":
                values.append(int(gone.sum()))
            elif name == "spans":
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                values.append(edges.tolist())
            else:
                values.append(kept.decode() if name == "kept" else hashlib.sha256(kept).hexdigest())
        yield tuple(values)

    kinds = {"n_words": "long", "n_removed": "long", "spans": "array<long>", "kept": "string", "kept_sha256": "string"}
    return map_rows(
        ranked.join(copies, key, "left").join(repeats, key, "left"),
        lambda: cut,
        ", ".join(["doc_id long", *(f"{name} {kinds[name]}" for name in columns)]),
        rows=500,
    )
