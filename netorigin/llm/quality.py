"""Quality rules: a threshold table compiled into one projection.

Every measure is a count of the text, every rule compares two counts with a percentage, so no float decides.  The plan is
one scan and one projection; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netorigin.llm.columns import SPACES, grams, let, text_or_empty, words

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
MIN_WORDS = 20

#: Common words of the four languages, lower case.
STOP_WORDS = (
    "the of and to in is that for on with as by at an this be are was it or not from have has which "
    "de la le les des du et un une en que qui pour dans par sur au est ce il ne se pas plus "
    "el los las y del con una lo como su es al más no "
    "der die das und zu den von mit ist im ein eine nicht dem auf für als auch sich werden").split()


@dataclass(frozen=True)
class Rule:
    """Reject when 100 * over > percent * under (`most`) or 100 * over < percent * under (`least`), in texts of `min_words` or more."""

    name: str
    over: str
    under: str
    most: int | None = None
    least: int | None = None
    min_words: int = 0

    def fails(self, of: Callable[[str], Column]) -> Column:
        over, under = 100 * of(self.over), of(self.under)
        bad = F.lit(False)
        if self.most is not None:
            bad = bad | (over > self.most * under)
        if self.least is not None:
            bad = bad | (over < self.least * under)
        return bad & (of("n_words") >= self.min_words)


#: The threshold table.
RULES = [
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("shouting", "n_capitals", "word_chars", most=30),
    Rule("stutter", "n_stutter_words", "n_words", most=30),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=60),
    Rule("word_length", "word_chars", "n_words", least=200, most=2000),
    Rule("stop_words", "n_stop_words", "n_words", least=2, min_words=100),
]

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_stutter_words", "n_stop_words"]


def repeat_words(w: Column, window: Column) -> Column:
    """Words inside `WINDOW`-word windows that occur twice or more; `window` holds the hash of the window at each place.

    Only texts with a repeated window sort their windows; the others stop at the distinct count.
    """
    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.arrays_zip(h.alias("h"), F.sequence(F.lit(0), F.size(h) - 1).alias("p")))
        n = F.size(h)
        return let(pairs, lambda s: let(
            F.array_sort(F.filter(F.transform(s, lambda x, i: F.when(
                (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["p"])), lambda p: p.isNotNull())),
            lambda at: F.aggregate(
                F.sequence(F.lit(0), F.size(at) - 1), F.lit(0),
                lambda total, i: total + F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1), n + 2 * WINDOW) - F.get(at, i)))))

    return let(window, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def measures(text: Column) -> Column:
    """Struct of all counts of a text, each from one split of it."""
    t = text_or_empty(text)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    stop = sorted({form for x in STOP_WORDS for form in (x, x.capitalize())})

    def of(w: Column, ln: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.translate(t, SPACES, "")).cast("bigint").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            (F.size(ln) - F.size(F.array_distinct(ln))).cast("bigint").alias("n_dup_lines"),
            repeat_words(w, grams(w, WINDOW)).cast("bigint").alias("n_repeat_words"),
            F.size(ln).cast("bigint").alias("n_lines"),
            (F.length(t) - F.length(F.translate(t, CAPITALS, ""))).cast("bigint").alias("n_capitals"),
            F.size(F.filter(w, lambda x, i: F.get(w, i - 1) == x)).cast("bigint").alias("n_stutter_words"),
            F.size(F.filter(w, lambda x: x.isin(stop))).cast("bigint").alias("n_stop_words"),
        )

    return let(words(t), lambda w: let(lines, lambda ln: of(w, ln)))


def base_fails(of: Callable[[str], Column]) -> Column:
    return (of("n_words") < MIN_WORDS) | (100 * of("n_repeat_words") > 30 * of("n_words"))


def quality(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """All columns of `docs`, then the measures, `base_failed`, `failed_rules` and `kept`.

    A null or blank text has no words and is base-failed.  Input columns whose names clash with a result column give way
    to it.  Rows are judged one by one: ties, repeated rows and empty tables need no rule.  Windows are compared by
    64-bit hashes inside one text.
    """
    given = [c for c in docs.columns if c not in {*MEASURES, "base_failed", "failed_rules", "kept", "_m"}]
    d = docs.withColumn("_m", measures(F.col(text))).select(*given, "_m.*")
    d = d.withColumn("base_failed", base_fails(F.col))
    failed = F.filter(F.array(*[F.when(r.fails(F.col), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return d.withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that pass, with the columns they came with.

    The verdict is one expression, so the filter computes the measures of a row once.
    """
    def good(m: Column) -> Column:
        bad = base_fails(m.getField)
        for r in RULES:
            bad = bad | r.fails(m.getField)
        return ~bad

    return docs.filter(let(measures(F.col(text)), good))
