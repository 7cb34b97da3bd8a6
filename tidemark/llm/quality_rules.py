"""Quality rules: a threshold table compiled into one projection of built-in functions.

``FACTS`` are counted once per text, in one expression; ``RULES`` is the table of
ratios of those counts with the least and the most each may be. ``judge`` turns the
table into columns. No shuffle, no user function: a row depends on its text alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANK, id_and_text, let

#: A repeated passage is this many words long.
WINDOW = 5

SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"

#: Frequent words of English, French, German and Spanish.
STOP_WORDS = sorted(
    set(
        "the of and to in that is for with as was be by this an are on or from at it a not he which"
        " le la les de des du et un une en que qui dans pour sur par est au pas ne ce il"
        " der die das und in von zu mit ist ein eine für nicht sich den dem auf auch als"
        " el los las y por con para una se del al lo como su no es".split()
    )
)


@dataclass(frozen=True)
class Rule:
    """A ratio of two facts and its bounds, both allowed; ``over`` None: the fact itself."""

    name: str
    fact: str
    over: str | None
    least: float
    most: float

    def value(self) -> Column:
        fact = F.col(self.fact).cast("double")
        return fact if self.over is None else fact / F.greatest(F.col(self.over), F.lit(1))

    def passes(self) -> Column:
        return self.value().between(self.least, self.most)


RULES = (
    Rule("words", "n_words", None, 10, 1_000_000),
    Rule("mean_word_length", "word_chars", "n_words", 2, 15),
    Rule("symbols_per_word", "n_symbols", "n_words", 0, 0.25),
    Rule("stop_word_share", "n_stop_words", "n_words", 0.01, 1),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", 0, 0.4),
    Rule("bullet_line_share", "n_bullet_lines", "n_lines", 0, 0.9),
    Rule("ellipsis_line_share", "n_ellipsis_lines", "n_lines", 0, 0.4),
    Rule("letter_share", "n_letters", "word_chars", 0.4, 1),
)


def _count(items: Column, keep: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(items, keep)).cast("long")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated_starts(words: Column) -> Column:
    """Starts, ascending, of the windows that stand twice or more in ``words``.

    Windows are compared by a 64-bit hash: sorted by it, equal ones are neighbours.
    """

    def hashed(i: Column) -> Column:
        return F.struct(F.xxhash64(*(words[i + k] for k in range(WINDOW))).alias("h"), i.alias("i"))

    starts = F.when(
        F.size(words) > WINDOW, F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), hashed)
    )

    def has_equal(windows: Column) -> Column:
        def at(k: Column) -> Column:
            return F.get(windows, k)["h"]

        return F.filter(
            windows, lambda x, k: x["h"].eqNullSafe(at(k - 1)) | x["h"].eqNullSafe(at(k + 1))
        )

    repeated = let(F.sort_array(starts), has_equal)
    return F.sort_array(F.transform(repeated, lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Number of words that windows at these ascending starts cover together."""
    steps = F.transform(
        starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW)))
    )
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")


def _facts(text: Column) -> Column:
    """All counts of a text, as one struct."""
    has_word = f"[^{BLANK[1:]}"

    def of_parts(words: Column, lines: Column, bare: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(bare).cast("long").alias("word_chars"),
            (F.length(bare) - F.length(_without(bare, SYMBOLS))).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            let(_repeated_starts(words), _covered).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            _count(words, lambda w: F.lower(w).isin(STOP_WORDS)).alias("n_stop_words"),
            _count(lines, lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•")).alias("n_bullet_lines"),
            _count(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")).alias(
                "n_ellipsis_lines"
            ),
            F.length(F.regexp_replace(bare, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        )

    words = F.array_remove(F.split(text, f"{BLANK}+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(has_word))
    bare = _without(text, _BLANKS)
    return let(words, lambda w: let(lines, lambda x: let(bare, lambda b: of_parts(w, x, b))))


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Facts, ``base_failed``, ``failed_rules`` and ``kept`` of each row of ``docs``.

    Words are runs of other characters than space and \\t to \\r; lines are parted by
    \\n and count if they hold a word. A document fails the base with fewer than 10
    words, or if over 20 in 100 words are in repeated five-word windows; it is kept
    if it passes the base and every rule of the table.

    A null or empty text has no words and fails. A null id stays null; repeated rows
    are judged one by one; other columns don't matter. Window equality is by 64-bit
    hash within one text: a wrong match is expected once in 10^15 texts of 200 words,
    or 10^11 of 20,000.
    """
    facts = F.transform(F.array(F.col("text")), _facts)
    table = id_and_text(docs, id_col, text_col).select("doc_id", F.inline(facts))
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    failed = F.array_compact(F.array(*(F.when(~rule.passes(), F.lit(rule.name)) for rule in rules)))
    return (
        table.withColumn("base_failed", base_failed)
        .withColumn("failed_rules", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )
