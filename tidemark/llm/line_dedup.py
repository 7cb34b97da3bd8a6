"""Line dedup: repeated windows of three lines, found globally, removed but for the first.

Built-in functions only. A window is three consecutive lines of one text. Windows are
hashed inside the row, grouped by hash with map-side sums, and the starts of later
occurrences return to their documents, where the positions they cover are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, let

#: Lines of a window.
LINES = 3


def _windows(lines: Column) -> Column:
    """Structs (h1, h2, at, again) of the windows that hold a word.

    ``again``: an equal window starts earlier in these lines. Sorted by hash and
    position, equal windows are neighbours.
    """

    def hashed(i: Column) -> Column:
        parts = [lines[i + k] for k in range(LINES)]
        return F.struct(
            F.xxhash64(*parts).alias("h1"),
            F.xxhash64(F.lit(LINES), *parts).alias("h2"),
            i.alias("at"),
            (F.concat(*parts).rlike(r"[^\x20\x09-\x0D]")).alias("said"),
        )

    starts = F.when(F.size(lines) >= LINES, F.sequence(F.lit(0), F.size(lines) - LINES))

    def marked(windows: Column) -> Column:
        def flag(x: Column, k: Column) -> Column:
            last = F.get(windows, k - 1)
            again = F.coalesce((last["h1"] == x["h1"]) & (last["h2"] == x["h2"]), F.lit(False))
            return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["at"].alias("at"), again.alias("again"))

        return F.transform(windows, flag)

    return let(F.sort_array(F.filter(F.transform(starts, hashed), lambda x: x["said"])), marked)


def remove_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lines_col: str | None = None,
    removed_col: str | None = None,
) -> DataFrame:
    """``docs`` without the lines covered by a window that also starts earlier.

    Earlier is a smaller id, or an earlier line of the same document; windows are judged
    on the input. Kept lines are joined by \\n again. ``lines_col`` and ``removed_col``
    name added counts, if given.

    Windows without a word don't count. Null texts stay null (no lines), an empty
    text is one empty line. Null ids come last. Rows with the same id and text are one document and
    get the same result; different texts under one id aren't earlier than each other.
    Windows are compared by 128 bits of hash. Texts meet their cuts in one shuffle;
    otherwise only hashes and positions travel.
    """
    rank, mark, h1, h2, at, again, first, last, cuts = fresh(
        docs, "rank", "mark", "h1", "h2", "at", "again", "first", "last", "cuts"
    )
    out = docs.columns
    text = F.col(f"`{text_col}`")
    lines = F.split(text, "\n")
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1))
    keyed = docs.withColumns({rank: order, mark: F.xxhash64(text)})
    windows = keyed.select(rank, mark, F.inline(let(lines, _windows)).alias(h1, h2, at, again))
    repeated = (
        windows.groupBy(h1, h2)
        .agg(F.min(rank).alias(first), F.max(rank).alias(last))
        .where(F.col(first) < F.col(last))
        .drop(last)
    )
    starts = (
        windows.join(repeated, [h1, h2], "left")
        .where(F.col(again) | (F.col(rank) > F.col(first)))
        .groupBy(rank, mark)
        .agg(F.collect_set(at).alias(cuts))
    )
    covered = F.flatten(F.transform(cuts, lambda i: F.array(*(i + k for k in range(LINES)))))

    def without(parts: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(parts) - 1)
        return F.transform(F.array_except(places, covered), lambda i: parts[i])

    joined = keyed.join(starts, [rank, mark], "left")
    cleaned = F.when(F.col(cuts).isNull(), text).otherwise(F.array_join(let(lines, without), "\n"))
    added = {}
    if lines_col:
        added[lines_col] = F.coalesce(F.size(F.when(text.isNotNull(), lines)), F.lit(0)).cast("long")
    if removed_col:
        added[removed_col] = F.when(F.col(cuts).isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(covered))).cast("long")
    return joined.select(
        *(cleaned.alias(c) if c == text_col else F.col(f"`{c}`") for c in out),
        *(value.alias(name) for name, value in added.items()),
    )
