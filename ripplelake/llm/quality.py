"""Quality rules as a short-circuit cascade of native expressions.

Each rule is a Boolean column that is true where a text is rejected.  Its cost (seconds a row) and its
selectivity (share rejected) are measured on a bounded sample; the cascade then tries the rule with the most
rejections per cost first and stops at the first that rejects.  The order changes the time, never the verdict.

Nulls: a null text has no word, so it fails ``too_few_words``; a null in any other column is carried along.  An empty table
gives no row.  Repeated rows are judged one by one, alike.  A text of any length is judged whole: its words, their hashes and those
of its windows are held for one row at a time; only where a window repeats are the windows themselves (eight times the text).  Columns of
the input keep their names: ``with_cascade`` adds columns under the names given and picks spare names for its own work.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelake.llm.common import SEPARATORS, WORD, spare_name, stored

WINDOW = 8
SYMBOLS = "#*$%&|<>"


class Features:
    """The columns a rule may use; words, their hashes and those of 8-word windows are computed once a row."""

    def __init__(self, text: Column, words: Column, hashes: Column, windows: Column):
        self.text, self.words, self.hashes, self.windows = F.coalesce(text, F.lit("")), words, hashes, windows
        self.n = F.size(words)


@dataclass(frozen=True)
class Rule:
    """``rejects`` makes the Boolean column from the features."""

    name: str
    rejects: Callable[[Features], Column]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def count_of(text: Column, characters: str) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{characters}]+", "")).cast("long")


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(WORD))


def dup_lines(text: Column) -> Column:
    lines = lines_of(text)
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _joined(hashes: Column, apart: int) -> Column:
    """Hashes of windows twice as wide: each with the one ``apart`` places on."""
    n = F.greatest(F.size(hashes) - apart, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, 1 + apart, n), lambda a, b: F.xxhash64(a, b))


def repeat_words(words: Column, windows: Column) -> Column:
    """Words inside 8-word windows found twice or more.

    Most texts repeat no window: for those, distinct hashes prove it.  Only the others sort their windows (as
    text, so the count is exact) and add up the words that the repeated ones cover.
    """
    last = F.greatest(F.size(words) - (WINDOW - 1), F.lit(1))
    spots = F.sort_array(
        F.transform(
            F.sequence(F.lit(1), last),
            lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("i")),
        )
    )
    nothing = F.array(F.lit(None).cast("struct<w:string,i:int>"))
    around = F.arrays_zip(
        spots.alias("here"),
        F.concat(nothing, F.slice(spots, 1, last - 1)).alias("before"),
        F.concat(F.slice(spots, 2, last), nothing).alias("after"),
    )
    again = F.filter(
        around, lambda z: z["here"]["w"].eqNullSafe(z["before"]["w"]) | z["here"]["w"].eqNullSafe(z["after"]["w"])
    )
    covered = F.aggregate(
        F.sort_array(F.transform(again, lambda z: z["here"]["i"])),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["end"])).cast("long").alias("n"), (i + WINDOW).alias("end")
        ),
        lambda a: a["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(covered)


def _stutter(f: Features) -> Column:
    """Words equal to the one before."""
    return F.size(F.filter(F.slice(f.hashes, 2, f.n), lambda h, i: h == F.get(f.hashes, i)))


def _upper(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))


def _letters(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, r"[^\p{L}]+", ""))


TOO_FEW = Rule("too_few_words", lambda f: f.n < 20)
REPEATS = Rule("repeated_windows", lambda f: 100 * repeat_words(f.words, f.windows) > 30 * f.n)

#: The rules beside the two base ones.  All are shares, so they hold for texts of any length.
RULES = (
    Rule("symbols", lambda f: 10 * count_of(f.text, SYMBOLS) > f.n),
    Rule("exclamations", lambda f: 5 * count_of(f.text, "!") > f.n),
    Rule("word_length", lambda f: (word_chars(f.words) < 2 * f.n) | (word_chars(f.words) > 15 * f.n)),
    Rule("capitals", lambda f: 2 * _upper(f.text) > _letters(f.text)),
    Rule("few_letters", lambda f: 2 * _letters(f.text) < word_chars(f.words)),
    Rule("stutter", lambda f: 10 * _stutter(f) > 3 * f.n),
    Rule("dup_lines", lambda f: 100 * dup_lines(f.text) > 70 * F.size(lines_of(f.text))),
)
ALL_RULES = (TOO_FEW, REPEATS, *RULES)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    rejected: float
    seconds: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


WORK = ("words", "hashes", "windows")
#: The sample is small at any size of the table; it is stored in so many files.
SAMPLE_FILES = 8


def _ready(docs: DataFrame, names: tuple[str, ...] = WORK) -> DataFrame:
    """Adds the shared features.  Each width is a column of its own: nested in one expression, the inner ones
    would be evaluated again for every mention."""
    words, hashes, windows = names
    out = docs.withColumn(words, words_of(F.col("text")))
    out = out.withColumn(hashes, F.transform(F.col(words), lambda w: F.xxhash64(w)))
    for apart in (1, 2, 4):
        out = out.withColumn(windows, _joined(F.col(hashes if apart == 1 else windows), apart))
    return out


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> list[Measured]:
    """The rules in the order in which the cascade tries them, with what was measured.

    The sample only sets the order.  Each row has the same chance to be drawn, so that about ``sample_rows`` are (all of a smaller
    table); the texts drawn are stored before any feature is made of them, then their features.  Each rule runs over these
    twice, the second run is timed; reading what the rule needs is part of its cost.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))
    drawn = stored(docs.select("text").sample(share, seed=7).repartition(SAMPLE_FILES), "sample")
    sample = stored(_ready(drawn), "sample-features")
    features = Features(F.col("text"), *map(F.col, WORK))
    rows = max(sample.count(), 1)
    found = []
    for rule in rules:
        probe = sample.agg(F.count_if(rule.rejects(features)).alias("n"))
        probe.first()
        began = time.perf_counter()
        n = probe.first()[0]
        found.append(Measured(rule, n / rows, (time.perf_counter() - began) / rows))
    return sorted(found, key=lambda m: (-m.worth, m.seconds, m.rule.name))


def first_failed(order: list[Measured], features: Features) -> Column:
    """The name of the first rule that rejects, else null; later rules are not evaluated."""
    out = F.lit(None).cast("string")
    for m in reversed(order):
        out = F.when(m.rule.rejects(features), m.rule.name).otherwise(out)
    return out


def with_cascade(docs: DataFrame, rules: tuple[Rule, ...] = ALL_RULES, failed: str = "failed_rule") -> DataFrame:
    """The table with the first failed rule (null: kept) under the name given."""
    names = tuple(spare_name(docs, name) for name in WORK)
    order, features = plan(docs, rules), Features(F.col("text"), *map(F.col, names))
    return _ready(docs, names).withColumn(failed, first_failed(order, features)).drop(*names)


def kept(docs: DataFrame, rules: tuple[Rule, ...] = ALL_RULES) -> DataFrame:
    """The rows that no rule rejects, columns as they were."""
    name, one = spare_name(docs, "failed_rule"), spare_name(docs, "one")
    # A generator instead of a filter: a filter would be pushed below and evaluate every feature again.
    keep = F.explode(F.when(F.col(name).isNull(), F.array(F.lit(True))))
    return with_cascade(docs, rules, name).select(*docs.columns, keep.alias(one)).drop(one)


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: the base figures, and the verdict of the base rules and the cascade."""
    order = plan(docs, rules)
    text, words, n = F.col("text"), F.col("words"), F.col("n_words")
    figures = _ready(docs.select("doc_id", "text")).select(
        "doc_id", "text", *WORK,
        F.size("words").cast("long").alias("n_words"),
        word_chars(words).alias("word_chars"),
        count_of(text, SYMBOLS).alias("n_symbols"),
        dup_lines(text).alias("n_dup_lines"),
        repeat_words(words, F.col("windows")).alias("n_repeat_words"),
    )
    base = figures.withColumn("base_failed", (n < 20) | (100 * F.col("n_repeat_words") > 30 * n))
    passed = first_failed(order, Features(text, *map(F.col, WORK))).isNull()
    return base.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), False).otherwise(passed).alias("kept"),
    )
