"""Quality rules: a threshold table compiled into one projection.

Each rule is a ratio of two text measures with an allowed range. The table is compiled to a single
``select`` of built-in functions: no shuffle, no user function, one pass over the text.

Defined cases: a null or blank text has no words and fails the base; a text is measured whole at any
length; repeated rows are measured one by one; other columns of the input are ignored.
Three-word windows are compared by a 64-bit hash within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.text import blank_words, let, lower_ascii

SYMBOLS = "#*$%&|<>"
#: Very common words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was on are as with be at by this "
    "der die das und in den von zu mit ist nicht ein eine "
    "le la les de des et un une que qui dans en du pour "
    "el los las y a por con una se del no"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``, in whole percent; an open end is None.

    A text whose denominator is 0 passes.
    """

    name: str
    numerator: str
    denominator: str
    low_percent: int | None = None
    high_percent: int | None = None

    def holds(self) -> Column:
        top, bottom = 100 * F.col(self.numerator), F.col(self.denominator)
        ok = F.lit(True)
        if self.low_percent is not None:
            ok = ok & (top >= self.low_percent * bottom)
        if self.high_percent is not None:
            ok = ok & (top <= self.high_percent * bottom)
        return ok


BASE = (
    Rule("length", "n_words", "one", low_percent=100 * 50),
    Rule("repetition", "n_repeat_words", "n_words", high_percent=50),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", low_percent=200, high_percent=1500),
    Rule("symbols", "n_symbols", "n_words", high_percent=50),
    Rule("stop_words", "n_stop_words", "one", low_percent=200),
    Rule("line_repeats", "n_dup_lines", "n_full_lines", high_percent=30),
)


def repeated_words(words: Column) -> Column:
    """How many words lie in a three-word window that occurs at least twice.

    Window hashes are sorted with their positions, so equal windows are neighbours; the union of
    the repeated windows is measured in position order.
    """
    count = F.size(words)
    windows = F.when(
        count >= 3,
        F.transform(
            F.sequence(F.lit(0), count - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")
            ),
        ),
    )
    repeated = let(
        F.sort_array(windows),
        lambda s: F.filter(
            F.transform(
                s,
                lambda x, i: F.when(
                    (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["p"]
                ),
            ),
            lambda p: p.isNotNull(),
        ),
    )
    start = F.struct(F.lit(0).alias("covered"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        F.sort_array(repeated),
        start,
        lambda a, p: F.struct(
            (a["covered"] + F.least(F.lit(3), p - a["last"])).alias("covered"), p.alias("last")
        ),
    )["covered"]
    return F.coalesce(covered, F.lit(0))


def measures(text: Column) -> Column:
    """One struct of all measures of a text."""
    whole = F.coalesce(text, F.lit(""))
    stops = F.array(*[F.lit(w) for w in sorted(set(STOP_WORDS))])
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(
        blank_words(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.regexp_replace(whole, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda full: (F.size(full) - F.size(F.array_distinct(full))).cast("long")).alias("n_dup_lines"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_full_lines"),
            F.size(F.array_intersect(F.transform(words, lower_ascii), stops)).cast("long").alias("n_stop_words"),
            F.lit(1).cast("long").alias("one"),
        ),
    )


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Measures, ``base_failed``, ``kept`` and the names of the broken rules of every document."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_full_lines", "n_stop_words")
    measured = docs.select("doc_id", measures(F.col("text")).alias("m")).select(
        "doc_id", *[F.col("m")[n].alias(n) for n in names], F.col("m")["one"].alias("one")
    )
    base_ok, method_ok = F.lit(True), F.lit(True)
    for rule in base:
        base_ok = base_ok & rule.holds()
    for rule in rules:
        method_ok = method_ok & rule.holds()
    broken = F.filter(
        F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in (*base, *rules)]), lambda x: x.isNotNull()
    )
    return measured.select(
        "doc_id",
        *names,
        (~base_ok).alias("base_failed"),
        (base_ok & method_ok).alias("kept"),
        broken.alias("broken_rules"),
    )
