"""Quality rules: a threshold table compiled into one projection, without user functions.

A null or empty text has no words; its counts are zero, it fails the base rules and is not
kept. Rows are judged one by one, so ties, repeats and extra columns change nothing; the
measures come back in one struct, whose name the caller chooses.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.text import SPACES, count_of, text_of, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from has he in is it its of on or that the this to was were"
    " will with "
    "aber als am an auch auf aus bei das dem den der des die ein eine einen er es für im in ist"
    " mit nicht sich sie sind und von zu "
    "au aux ce dans de des du elle en est et il la le les mais ne ou par pas pour qui que sur un"
    " une "
    "al como con de del el en es la las lo los más no o para pero por que se su un una y"
)


@dataclass(frozen=True)
class Rule:
    """A measure must lie between two bounds, both inclusive."""

    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("n_words", low=50, high=100_000),
    Rule("mean_word_chars", low=2.5, high=12),
    Rule("symbols_per_word", high=0.1),
    Rule("shouts_per_word", high=0.15),
    Rule("stop_word_share", low=0.04),
    Rule("duplicate_line_share", high=0.3),
    Rule("bullet_line_share", high=0.9),
    Rule("ellipsis_line_share", high=0.3),
)


SPARE_BITS = 0  # of the first, coarse comparison, beyond those that places need


def measured(text: Column, frame: DataFrame, name: str = "quality") -> DataFrame:
    """``frame`` with a struct column of base counts and of the measures the rules use."""
    outer = [F.col(f"`{column}`") for column in frame.columns]
    kept = [F.col(f"__row.`{column}`").alias(column) for column in frame.columns]
    staged = frame.select(F.struct(*outer).alias("__row"), text.alias("__text")).select(
        "__row", "__text", words_of(F.col("__text")).alias("__words")
    )
    words, n = F.col("__words"), F.size("__words")
    windows = F.when(
        n > 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    staged = staged.withColumns({"__windows": windows, "__bits": F.length(F.bin(n)) + SPARE_BITS})
    # the low bits of each hash give way to the window's place: one sort of plain longs finds
    # all windows that can be repeated
    placed = F.expr(
        "sort_array(transform(__windows, (h, i) ->"
        " shiftleft(shiftright(h, __bits), __bits) | cast(i AS bigint)))"
    )
    staged = staged.withColumn("__placed", placed)
    again = F.expr(
        "filter(__placed, (p, k) ->"
        " (k > 0 AND shiftright(p, __bits) = shiftright(get(__placed, k - 1), __bits))"
        " OR (k < size(__placed) - 1"
        " AND shiftright(p, __bits) = shiftright(get(__placed, k + 1), __bits)))"
    )
    # of these few the whole hashes decide
    whole = F.expr(
        "sort_array(transform(transform(__again, p -> p & (shiftleft(1L, __bits) - 1)),"
        " i -> named_struct('h', get(__windows, cast(i AS int)), 'i', i)))"
    )
    staged = staged.withColumn("__again", again).withColumn("__whole", whole)
    repeated = F.expr(
        "filter(__whole, (w, k) -> (k > 0 AND w.h = get(__whole, k - 1).h)"
        " OR (k < size(__whole) - 1 AND w.h = get(__whole, k + 1).h))"
    )
    staged = staged.withColumn("__repeated", repeated)
    covered = F.expr(
        "aggregate(sort_array(transform(__repeated, w -> w.i)),"
        " named_struct('end', 0L, 'n', 0L),"
        " (acc, i) -> named_struct('end', i + 3, 'n', acc.n + i + 3 - greatest(acc.end, i)),"
        " acc -> acc.n)"
    )
    t = F.col("__text")
    lines = F.filter(F.split(t, "\n", -1), lambda line: F.trim(line, F.lit(SPACES)) != "")
    stops = sorted(set(STOP_WORDS.split()))
    staged = staged.withColumns(
        {
            "__lines": lines,
            "__repeat": covered,
            "__stops": F.size(F.filter(words, lambda w: F.lower(w).isin(stops))),
        }
    )
    n_lines = F.size("__lines")

    def share(count: Column, of: Column) -> Column:
        return F.when(of > 0, count / of).otherwise(0.0)

    def lines_like(pattern: str) -> Column:
        return F.size(F.filter("__lines", lambda line: line.rlike(pattern)))

    counts = {
        "n_words": n.cast("long"),
        "word_chars": F.length(t).cast("long") - count_of(t, SPACES),
        "n_symbols": count_of(t, SYMBOLS).cast("long"),
        "n_dup_lines": (n_lines - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.col("__repeat"),
    }
    ratios = {
        "mean_word_chars": share(counts["word_chars"], n),
        "symbols_per_word": share(counts["n_symbols"], n),
        "shouts_per_word": share(count_of(t, "!"), n),
        "stop_word_share": share(F.col("__stops"), n),
        "duplicate_line_share": share(counts["n_dup_lines"], n_lines),
        "bullet_line_share": share(lines_like(r"^\s*[-*•]"), n_lines),
        "ellipsis_line_share": share(lines_like(r"(\.\.\.|…)\s*$"), n_lines),
    }
    quality = F.struct(*(value.alias(key) for key, value in (counts | ratios).items()))
    return staged.select(*kept, quality.alias(name))


def base_failed(quality: Column) -> Column:
    return (quality["n_words"] < MIN_WORDS) | (
        100 * quality["n_repeat_words"] > MAX_REPEAT_PERCENT * quality["n_words"]
    )


def failed_rules(quality: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The measures outside their bounds: the table compiled into one array expression."""

    def outside(rule: Rule) -> Column:
        value = quality[rule.measure]
        bounds = [value < rule.low] if rule.low is not None else []
        bounds += [value > rule.high] if rule.high is not None else []
        broken = bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]
        return F.when(broken, F.lit(rule.measure))

    return F.array_compact(F.array(*map(outside, rules)))


def judge(
    frame: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, name: str = "quality"
) -> DataFrame:
    """``frame`` with ``name``: counts, ratios, ``base_failed``, ``failed_rules``, ``kept``."""
    out = measured(text_of(text), frame, name)
    quality = F.col(f"`{name}`")
    failed = failed_rules(quality, rules)
    base = base_failed(quality)
    return out.withColumn(
        name,
        quality.withField("base_failed", base)
        .withField("failed_rules", failed)
        .withField("kept", ~base & (F.size(failed) == 0)),
    )
