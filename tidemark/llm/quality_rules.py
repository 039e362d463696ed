"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over the words and lines of one document, every rule
a range of one measure, and the verdict the conjunction of all ranges. There is no user
function, no shuffle and no state, so cost follows the text and any executor can redo any part.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import SPACES, let, texts

#: Frequent function words of the languages handled.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "on", "with", "as", "was", "it", "be", "by", "are", "this",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "ist", "im", "dem", "nicht", "ein", "eine",
    "de", "la", "que", "el", "en", "los", "se", "del", "las", "un", "por", "con", "una", "su", "para", "es",
    "le", "les", "et", "du", "une", "est", "pour", "qui", "dans", "par", "sur", "au",
)


@dataclass(frozen=True)
class Rule:
    """A document passes when ``low <= measure <= high``; None leaves a side open."""

    measure: str
    low: float | None = None
    high: float | None = None


#: Base rules are the contract's; the others are the method's verdict.
BASE = (Rule("n_words", low=50), Rule("repeat_word_ratio", high=0.5))
RULES = (
    Rule("mean_word_chars", 1.5, 20.0),
    Rule("symbol_ratio", high=0.3),
    Rule("shout_ratio", high=0.5),
    Rule("stop_word_ratio", low=0.01),
    Rule("dup_line_ratio", high=0.5),
    Rule("bullet_line_ratio", high=0.9),
    Rule("ellipsis_line_ratio", high=0.5),
)


def repeated_words(words: Column, size: int = 3) -> Column:
    """How many words lie in a window of ``size`` words that occurs twice or more in the text.

    Windows are sorted by hash with their places, so equal ones become neighbours: n log n for
    any text, also one that repeats a single word.
    """
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (size - 1), F.lit(0))),
        lambda word, i: F.struct(
            F.xxhash64(word, *[F.get(words, i + k) for k in range(1, size)]).alias("h"), i.alias("i")))
    twice = let(F.sort_array(windows), lambda s: F.filter(
        s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    return F.aggregate(
        places, F.struct(F.lit(-size).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(i - acc["last"], F.lit(size))).alias("n")),
        lambda acc: acc["n"])


def measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Counts of one document, from its text, its words and its lines with a word."""
    def count(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    def lines_like(pattern: str) -> Column:
        return F.size(F.filter(lines, lambda line: line.rlike(pattern)))

    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(text, f"[{SPACES}]+", "")).cast("long"),
        "n_symbols": count("[#*$%&|<>]").cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_words(words),
        "n_lines": F.size(lines),
        "n_shout": F.size(F.filter(words, lambda w: w.endswith("!!"))),
        "n_stop": F.size(F.filter(words, lambda w: F.lower(F.regexp_replace(w, "[.,;:!?]+$", "")).isin(*STOP_WORDS))),
        "n_bullets": lines_like(f"^[{SPACES}]*[-*•‣▪●]"),
        "n_ellipses": lines_like(f"(\\.\\.\\.|…)[{SPACES}]*$"),
    }


#: Ratio -> (counted, out of).
RATIOS = {
    "repeat_word_ratio": ("n_repeat_words", "n_words"),
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "shout_ratio": ("n_shout", "n_words"),
    "stop_word_ratio": ("n_stop", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "bullet_line_ratio": ("n_bullets", "n_lines"),
    "ellipsis_line_ratio": ("n_ellipses", "n_lines"),
}


def compiled(rules: tuple[Rule, ...], measure: Callable[[str], Column] = F.col) -> Column:
    """One boolean expression: all rules hold. Ratios compare by multiplication, so no division by zero."""
    verdict = F.lit(True)
    for rule in rules:
        part, whole = RATIOS.get(rule.measure, (rule.measure, None))
        of = measure(whole) if whole else F.lit(1)
        if rule.low is not None:
            verdict = verdict & (measure(part) >= F.lit(rule.low) * of)
        if rule.high is not None:
            verdict = verdict & (measure(part) <= F.lit(rule.high) * of)
    return verdict


def measured(text: Column) -> Column:
    """All measures of a text as one struct. Words and lines are bound once: the optimiser may
    move this expression into a filter, and must not split the text for each use."""
    split = F.struct(
        text.alias("text"), F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACES}]")).alias("lines"))
    return let(split, lambda x: F.struct(*[c.alias(n) for n, c in measures(x["text"], x["words"], x["lines"]).items()]))


def judge(docs: DataFrame, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: the measures, ``base_failed`` and ``kept``.

    A null text counts as empty: no words, so it fails the base. Repeated rows each get their
    row; extra columns are left out; an empty table gives an empty result.
    """
    counted = texts(docs).select("doc_id", measured(F.col("text")).alias("m")).select("doc_id", "m.*")
    return counted.withColumn("base_failed", ~compiled(base)).withColumn("kept", ~F.col("base_failed") & compiled(rules))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = BASE + RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns: one filter, no join."""
    return docs.where(let(measured(F.coalesce(docs["text"], F.lit(""))), lambda m: compiled(rules, lambda name: m[name])))
