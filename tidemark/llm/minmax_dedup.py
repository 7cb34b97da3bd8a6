"""Near-duplicate groups by min-max hashing, confirmed on full shingle sets.

Each permutation of the shingles gives two signature values, its least and its greatest
image, so half as many hash evaluations fill a signature. Four values make a band; with
64 permutations there are 32 bands, and two sets of similarity 0.8 miss each other in all
of them once in 10^7.

No pairs are made within a band's group. Each member is compared with the group's leader
(its least vertex) on full sets, which gives links and, for each member, what it differs
in. Where a leader's group has fallen into more than one component, the members outside
the main one are compared with all others in bounded blocks, from those differences
alone: that is exact, and only links between components leave a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, id_and_text, map_rows, mix, run_hashes, word_hashes
from tidemark.llm.components import components, stored

PERMUTATIONS = 64
BAND = 4
#: Members outside the main component, and members in all, of one block.
BLOCK_OUTSIDE, BLOCK_ALL = 256, 1024
#: Texts without an id are ranked behind all ids.
_NO_ID = 1 << 62

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RNG = np.random.default_rng(7)
_FACTORS = _RNG.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; fewer words are one shingle."""
    hashes = word_hashes(text.encode().translate(_LOWER).split())
    if not len(hashes):
        return np.zeros(0, np.uint64)
    short = len(hashes) < shingle
    return np.unique(run_hashes(hashes, len(hashes) if short else shingle, 3 if short else 2))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """Hashes of the bands of a min-max signature; the band's number is part of its hash."""
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    most = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 4096):  # bounded memory for very long texts
        images = shingles[at : at + 4096, None] * _FACTORS + _SHIFTS
        least, most = np.minimum(least, images.min(axis=0)), np.maximum(most, images.max(axis=0))
    bands = run_hashes(np.concatenate([least, most]), BAND, 4)[::BAND]
    return mix(bands + np.arange(len(bands), dtype=np.uint64))


def _signed(x: np.ndarray) -> list[int]:
    return x.view(np.int64).tolist()


def _ranked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    no_id = F.xxhash64("text").bitwiseAND(F.lit(_NO_ID - 1)) + _NO_ID
    return id_and_text(docs, id_col, text_col).select(F.coalesce("doc_id", no_id).alias("rank"), "text")


def _compare(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Each (leader, vertex) with the leader's set size, whether they are linked, and how they differ."""

    def one(leader: int, vertex: int, leader_text: str, text: str) -> Iterator[tuple]:
        base, other = shingle_set(leader_text, shingle), shingle_set(text, shingle)
        delta = np.setxor1d(base, other, assume_unique=True)
        common = (len(base) + len(other) - len(delta)) // 2
        linked = 100 * common >= percent * (common + len(delta))
        yield leader, vertex, len(base), len(base) - common, linked, _signed(delta)

    # A merge at every size: how many take part grows with the input, so they are never broadcast.
    ids = pairs.select(F.col("leader").alias("rank")).union(pairs.select("vertex")).distinct()
    involved = texts.join(ids.hint("merge"), "rank", "left_semi")
    return map_rows(
        pairs.hint("merge")
        .join(involved.withColumnsRenamed({"rank": "leader", "text": "leader_text"}), "leader")
        .join(involved.withColumnRenamed("rank", "vertex").hint("merge"), "vertex")
        .select("leader", "vertex", "leader_text", "text"),
        lambda: one,
        "leader long, vertex long, n_leader long, n_minus long, linked boolean, delta array<long>",
        rows=200,
    )


def _blocks(compared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of leaders' groups that are in several components, dealt out to blocks."""
    members = compared.select("leader", "vertex", "n_leader", "n_minus", "delta").unionByName(
        compared.select("leader", "n_leader")
        .distinct()
        .select(
            "leader",
            F.col("leader").alias("vertex"),
            "n_leader",
            F.lit(0).cast("long").alias("n_minus"),
            F.array().cast("array<bigint>").alias("delta"),
        )
    )
    named = members.join(labels, "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))
    sizes = named.groupBy("leader", "label").agg(F.count("*").alias("n"))
    groups = (
        sizes.groupBy("leader")
        .agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
        .where(F.col("all") > F.col("most"))
        .withColumn("rows", F.ceil((F.col("all") - F.col("most")) / BLOCK_OUTSIDE).cast("int"))
        .withColumn("cols", F.ceil(F.col("all") / BLOCK_ALL).cast("int"))
    )
    dealt = named.join(groups, "leader")
    own = F.xxhash64("vertex")
    fields = ["leader", "vertex", "n_leader", "n_minus", "delta", "label"]
    outside = dealt.where("label <> main").select(
        *fields,
        F.lit(True).alias("outside"),
        F.pmod(own, F.col("rows")).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("col"),
    )
    everyone = dealt.select(
        *fields,
        F.lit(False).alias("outside"),
        F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"),
        F.pmod(own, F.col("cols")).cast("int").alias("col"),
    )
    return outside.union(everyone)


def _links_between(percent: int):
    """Links of a block between different components, one for each member and component.

    With a leader of n shingles, and sets x, y that lack mx, my of them and differ from it
    in dx, dy altogether, x and y share n - mx - my + |dx & dy| shingles.
    """

    def link(block: pd.DataFrame) -> pd.DataFrame:
        x = block[block["outside"]]
        y = block[~block["outside"]]
        found: list[tuple[int, int]] = []
        if len(x) and len(y):
            n = int(block["n_leader"].iloc[0])
            tokens = np.concatenate([np.asarray(d, np.int64) for d in y["delta"]] + [np.zeros(0, np.int64)])
            vocabulary, ids = np.unique(tokens, return_inverse=True)
            lengths = np.array([len(d) for d in y["delta"]])
            owner = np.repeat(np.arange(len(y)), lengths)
            minus, labels = y["n_minus"].to_numpy(), y["label"].to_numpy()
            sizes = n - 2 * minus + lengths
            for delta, m, label in zip(x["delta"], x["n_minus"], x["label"]):
                mine = np.zeros(len(vocabulary), bool)
                mine[np.searchsorted(vocabulary, np.intersect1d(np.asarray(delta, np.int64), vocabulary))] = True
                shared = np.bincount(owner[mine[ids]], minlength=len(y)) if len(ids) else np.zeros(len(y), int)
                common = n - m - minus + shared
                union = (n - 2 * m + len(delta)) + sizes - common
                linked = (100 * common >= percent * union) & (labels != label)
                found += [(int(label), int(other)) for other in np.unique(labels[linked])]
        return pd.DataFrame({"a": [a for a, _ in found], "b": [b for _, b in found]}, dtype="int64")

    return link


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs``.

    Words are lower-cased (A-Z) runs of other characters than space and \\t to \\r; a text's
    set is its distinct ``shingle``-word shingles, or all of a shorter text as one. Texts are
    linked if 100 * intersection >= ``percent`` * union; a component is all that links reach,
    named by its least id, which is the one kept. Equal sets are one vertex from the start.

    Null and empty texts, or texts without words, are linked with nothing. Texts without an
    id come after all ids, in the order of their hash; a component of such texts only has a null id. Rows
    of one id are one document: they share their links. Other columns don't matter. Runs jobs
    when called, and stores intermediate tables in the shared folder.
    """
    ranked = _components(docs, shingle, percent, id_col, text_col)

    def as_id(name: str):
        return F.when(F.col(name) < _NO_ID, F.col(name))

    return ranked.select(
        as_id("rank").alias("doc_id"),
        "n_shingles",
        as_id("component").alias("component_id"),
        (F.col("rank") == F.col("component")).alias("kept"),
    )


def _components(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """rank, n_shingles and the component's least rank of each row."""
    texts = _ranked(docs, id_col, text_col)

    def signature(rank: int, text: str) -> Iterator[tuple]:
        found = shingle_set(text, shingle)
        digest = xxhash.xxh3_128_intdigest(found.tobytes())
        halves = np.array([digest >> 64, digest & (1 << 64) - 1], np.uint64).view(np.int64)
        bands = _signed(band_keys(found)) if len(found) else []
        yield rank, len(found), int(halves[0]), int(halves[1]), bands

    sets = stored(
        map_rows(texts, lambda: signature, "rank long, n_shingles long, s1 long, s2 long, bands array<long>")
    )
    filled = sets.where("n_shingles > 0")
    classes = filled.groupBy("s1", "s2").agg(F.min("rank").alias("vertex"))
    bands = (
        filled.join(classes, ["s1", "s2"])
        .where("rank = vertex")
        .select("vertex", F.explode("bands").alias("band"))
    )
    led = bands.groupBy("band").agg(F.min("vertex").alias("leader"), F.max("vertex").alias("last"))
    pairs = stored(
        bands.join(led.where("leader < last").select("band", "leader"), "band")
        .where("vertex > leader")
        .select("leader", "vertex")
        .distinct()
    )
    compared = stored(_compare(pairs, texts, shingle, percent))
    labels = components(compared.where("linked").select(F.col("leader").alias("a"), F.col("vertex").alias("b")))
    links = _blocks(compared, labels).groupBy("leader", "row", "col")
    joined = components(stored(links.applyInPandas(_links_between(percent), "a long, b long")))
    named = (
        classes.join(labels, "vertex", "left")
        .withColumn("label", F.coalesce("label", "vertex"))
        .join(joined.select(F.col("vertex").alias("label"), F.col("label").alias("component")), "label", "left")
        .select("s1", "s2", F.coalesce("component", "label").alias("component"))
    )
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "rank")).otherwise(F.col("rank"))
    return sets.join(named, ["s1", "s2"], "left").select("rank", "n_shingles", component.alias("component"))


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, whole, that ``near_duplicates`` keeps: one of each component.

    Rows with the kept id and the same text are one document, of which one row stays.
    """
    rank, mark = fresh(docs, "rank", "mark")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    no_id = F.xxhash64(text).bitwiseAND(F.lit(_NO_ID - 1)) + _NO_ID
    ranked = docs.withColumns({rank: F.coalesce(F.col(f"`{id_col}`").cast("long"), no_id), mark: F.xxhash64(text)})
    found = _components(docs, shingle, percent, id_col, text_col)
    kept = found.where("rank = component").select(F.col("rank").alias(rank)).distinct()
    return ranked.join(kept, rank, "left_semi").dropDuplicates([rank, mark]).select(*(f"`{c}`" for c in docs.columns))
