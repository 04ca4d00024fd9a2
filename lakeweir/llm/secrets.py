"""Secret scans: fixed patterns, and character Markov models that add what looks random.

Two first-order models over characters, one of random strings and one of ordinary
identifiers, are fitted from labelled samples that all documents give. What base patterns leave
of a long run of key-like characters is searched for the stretch, between separators, whose
log-likelihood ratio favours the random model most; a long one that it favours enough is a
secret. So a key is found beside an access key or behind a path. Everything runs as column
expressions; positions come from splitting a text at the matches.

A null text is empty. Each text is judged alone, so ties, repeats and extra columns change
nothing. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.text import text_of, words_of

MARKOV = "markov"
# The base kinds in their order, their patterns and least lengths.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA and more, 20 characters at least
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
SEPARATORS = ("/", "_", "=", "-")
LEAST_KEY = 20
KINDS = ("assign", "access", "hex", MARKOV)
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
WIDTH = len(ALPHABET) + 1  # place 0 is any other character

LEAST_WORD = 4
DIGESTS = 4096  # made for the random model, beside what the documents hold
SMOOTHING = 0.5
MARGIN = 12.0  # nats in favour of the random model


# -- spans of a pattern ----------------------------------------------------------------


def spans(text: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, rank, end, kind, value).

    ``value`` is the given group. Texts without a match skip the bookkeeping.
    """
    kind_type = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    steps = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"), whole.alias("whole"), value.alias("value")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind_type).alias("found"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["before"])
        end = begin + F.length(part["whole"])
        span = F.struct(
            begin.alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            part["value"].alias("value"),
        )
        # the last part is what follows the last match
        found = F.when(part["whole"].isNull(), state["found"]).otherwise(
            F.concat(state["found"], F.array(span))
        )
        return F.struct(F.coalesce(end, begin).alias("at"), found.cast(kind_type).alias("found"))

    found = F.aggregate(steps, start, step, lambda state: state["found"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(kind_type))


def joined(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


# -- the models ------------------------------------------------------------------------


@dataclass(frozen=True)
class MarkovRatio:
    """Log-likelihood ratio of each pair of characters, random over ordinary, row by row."""

    ratios: tuple[float, ...]

    def column(self) -> Column:
        """The table as one folded literal."""
        return F.split(F.lit(",".join(f"{r:.6f}" for r in self.ratios)), ",").cast("array<double>")


def fit(pairs: Mapping[tuple[int, int, bool], int]) -> MarkovRatio:
    """Ratios from counts of (first place, second place, is random)."""

    def model(random: bool) -> list[float]:
        out = []
        for first in range(WIDTH):
            row = [pairs.get((first, second, random), 0) + SMOOTHING for second in range(WIDTH)]
            total = sum(row)
            out += [log(count / total) for count in row]
        return out

    return MarkovRatio(tuple(r - o for r, o in zip(model(True), model(False), strict=True)))


def _place(character: Column) -> Column:
    return F.instr(F.lit(ALPHABET), character)


def labelled_samples(
    documents: DataFrame, text: str = "text", digests: int = DIGESTS
) -> DataFrame:
    """``word`` and ``random`` from all documents.

    Random: the values that base patterns find, and some digests, which are random by
    construction. Ordinary: the words outside of base matches.
    """
    picked = documents.select(text_of(text).alias("text"))
    digest = F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256))
    made = documents.sparkSession.range(digests).select(
        F.explode(F.array(F.base64(digest), F.lower(F.hex(digest)), F.hex(digest))).alias("word"),
        F.lit(True).alias("random"),
    )
    secrets = F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    rest = F.regexp_replace("text", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    random = picked.select(F.explode(secrets).alias("word"), F.lit(True).alias("random"))
    plain = picked.select(F.explode(words_of(rest)).alias("word"), F.lit(False).alias("random"))
    return random.unionByName(made).unionByName(plain.where(F.length("word") >= LEAST_WORD))


def train(samples: DataFrame) -> MarkovRatio:
    """Count pairs of characters, each word's once for all its places; at most ``WIDTH`` squared
    counts per model reach the driver."""
    words = samples.where(F.length("word") > 1).groupBy("word", "random").agg(
        F.count(F.lit(1)).alias("n")
    )
    pairs = words.select(
        "random",
        "n",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("word") - 1),
                lambda i: F.struct(
                    _place(F.substring("word", i, F.lit(1))).alias("first"),
                    _place(F.substring("word", i + 1, F.lit(1))).alias("second"),
                ),
            )
        ).alias("pair"),
    )
    counted = pairs.groupBy("pair.first", "pair.second", "random").agg(F.sum("n").alias("n"))
    return fit({(r["first"], r["second"], r["random"]): r["n"] for r in counted.collect()})


def likeliest_key(word: Column, model: MarkovRatio) -> Column:
    """The stretch of ``word`` between two separators or ends, without separators at its own ends,
    with the greatest sum of log-likelihood ratios over its neighbouring other characters:
    ``ratio``, and the places ``first`` and ``last`` of its characters, from 1."""
    table = model.column()
    size = F.length(word)

    def step(seen: Column, i: Column) -> Column:
        here, following = F.substring(word, i, F.lit(1)), F.substring(word, i + 1, F.lit(1))
        apart = here.isin(*SEPARATORS)
        stops = ~apart & ((i == size) | following.isin(*SEPARATORS))
        better = stops & (seen["ratio"] > seen["best"])
        # a separator says nothing: ordinary words seldom hold one, paths and keys do
        inside = (i < size) & ~apart & ~following.isin(*SEPARATORS)
        pair = F.when(inside, F.get(table, _place(here) * WIDTH + _place(following)))
        onward = seen["ratio"] + F.coalesce(pair, F.lit(0.0))
        restart = apart & ((onward <= 0) | (seen["begin"] == i))
        return F.struct(
            F.when(restart, 0.0).otherwise(onward).alias("ratio"),
            F.when(restart, i + 1).otherwise(seen["begin"]).alias("begin"),
            F.when(better, seen["ratio"]).otherwise(seen["best"]).alias("best"),
            F.when(better, seen["begin"]).otherwise(seen["first"]).alias("first"),
            F.when(better, i).otherwise(seen["last"]).alias("last"),
        )

    start = F.struct(
        F.lit(0.0).alias("ratio"),
        F.lit(1).alias("begin"),
        F.lit(float("-inf")).alias("best"),
        F.lit(1).alias("first"),
        F.lit(0).alias("last"),
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(size, F.lit(1))),
        start,
        step,
        lambda seen: F.struct(seen["best"].alias("ratio"), seen["first"], seen["last"]),
    )


# -- the scan --------------------------------------------------------------------------


def scan(
    documents: DataFrame,
    model: MarkovRatio,
    text: str = "text",
    name: str = "secrets",
    margin: float = MARGIN,
) -> DataFrame:
    """``documents`` with the struct ``name``: the spans of each kind, ``base`` and ``all``
    (base and markov) in order of start, then kind."""
    t = F.col("__text")
    out = documents.withColumn("__text", text_of(text)).withColumns(
        {
            "__assign": F.filter(
                spans(t, "assign", ASSIGN, 2), lambda s: F.length(s["value"]) >= 6
            ),
            "__access": spans(t, "access", ACCESS),
            "__hex": spans(t, "hex", HEX),
            "__candidates": spans(t, MARKOV, CANDIDATE),
        }
    )
    out = out.withColumn("__base", F.sort_array(F.concat("__assign", "__access", "__hex")))

    def left_of(run: Column) -> Column:
        """The parts of a run outside of base spans, as (start, end)."""
        none = F.array().cast("array<struct<start:int,end:int>>")

        def part(start: Column, end: Column) -> Column:
            return F.array(F.struct(start.alias("start"), end.alias("end")))

        def step(seen: Column, base: Column) -> Column:
            gap = F.when(base["start"] > seen["at"], part(seen["at"], base["start"]))
            return F.struct(
                F.greatest(seen["at"], base["end"]).alias("at"),
                F.concat(seen["parts"], F.coalesce(gap, none)).alias("parts"),
            )

        inside = F.filter(
            "__base", lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])
        )
        start = F.struct(run["start"].alias("at"), none.alias("parts"))
        parts = F.aggregate(
            inside, start, step, lambda seen: F.concat(seen["parts"], part(seen["at"], run["end"]))
        )
        return F.filter(parts, lambda p: p["end"] - p["start"] >= LEAST_KEY)

    parts = F.transform(
        F.flatten(F.transform("__candidates", left_of)),
        lambda p: F.struct(
            p["start"].alias("start"),
            likeliest_key(
                F.substring(t, p["start"] + 1, p["end"] - p["start"]), model
            ).alias("key"),
        ),
    )
    out = out.withColumn("__parts", parts)
    keys = F.filter(
        "__parts",
        lambda p: (p["key"]["ratio"] > margin)
        & (p["key"]["last"] - p["key"]["first"] + 1 >= LEAST_KEY),
    )

    def span(p: Column) -> Column:
        first, last = p["key"]["first"], p["key"]["last"]
        return F.struct(
            (p["start"] + first - 1).alias("start"),
            F.lit(KINDS.index(MARKOV)).alias("rank"),
            (p["start"] + last).alias("end"),
            F.lit(MARKOV).alias("kind"),
            F.substring(t, p["start"] + first, last - first + 1).alias("value"),
        )

    markov = F.transform(keys, span)
    out = out.withColumn("__markov", markov)
    found = F.struct(
        F.col("__assign").alias("assign"),
        F.col("__access").alias("access"),
        F.col("__hex").alias("hex"),
        F.col("__markov").alias("markov"),
        F.col("__base").alias("base"),
        F.sort_array(F.concat("__base", "__markov")).alias("all"),
    )
    return out.select(*(F.col(f"`{c}`") for c in documents.columns if c != name), found.alias(name))
