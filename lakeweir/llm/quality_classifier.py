"""Quality classifier by hierarchical empirical Bayes.

A logistic model over counted text features gives each document its own evidence, as log
odds against the average document. Sites form a hierarchy: all documents, a host, a path on
the host. The mean quality of a site is shrunk towards its parent's with a strength estimated
from the spread between sites (method of moments), so sparse sites follow their parent and
large ones speak for themselves. A document's score adds its evidence to the log odds of its
path, both rates taken over the other documents only: its own evidence counts once.

The model is fitted on a bounded number of labelled documents. Site statistics cover all
documents and are grouped aggregates: combined before the shuffle, so a host with a third of
all rows costs no more than another.

Null and empty texts have zero features and a score like any other. A null host or path is a
site of its own. Rows are scored one by one; an empty table gives an empty one. Without
labelled rows of both classes no text carries evidence, and every score is one half.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.text import SPACES, count_of, text_of
from lakeweir.sources.scratch import written

TRAIN_ROWS = 20_000
KEEP_AT = 0.5
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6
EDGE = 1e-4  # rates stay this far from zero and one
SYMBOLS = "#*$%&|<>"


def features(text: Column) -> dict[str, Column]:
    """Bounded measures of a text, by name."""
    chars = F.length(text).cast("double")
    spaces = count_of(text, SPACES)
    letters = F.greatest(chars - spaces, F.lit(1.0))
    words = F.greatest(spaces.cast("double") + 1, F.lit(1.0))
    lines = F.split(text, "\n", -1)
    n_lines = F.greatest(F.size(lines).cast("double"), F.lit(1.0))
    upper = F.length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    digits = F.length(F.regexp_replace(text, r"[^0-9]+", ""))
    return {
        "log_chars": F.log1p(chars) / 10,
        "symbols": F.least(count_of(text, SYMBOLS) / words, F.lit(1.0)),
        "shouts": F.least(count_of(text, "!?") / words, F.lit(1.0)),
        "stops": F.least(count_of(text, ".") / words, F.lit(1.0)),
        "upper": F.least(upper / letters, F.lit(1.0)),
        "digits": F.least(digits / letters, F.lit(1.0)),
        "word_length": F.least(letters / words / 10, F.lit(2.0)),
        "repeated_lines": 1 - F.size(F.array_distinct(lines)) / n_lines,
    }


@dataclass(frozen=True)
class Model:
    """Weights of the features, with the log odds of the average training document."""

    names: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    prior: float

    def log_odds(self, values: dict[str, Column]) -> Column:
        total = F.lit(self.bias)
        for name, weight in zip(self.names, self.weights, strict=True):
            total = total + values[name] * weight
        return total


def fit(names: Sequence[str], rows, labels, ridge: float = 1e-3, steps: int = 50) -> Model:
    """Logistic regression by Newton steps on standardised features."""
    import numpy as np

    x, y = np.asarray(rows, dtype=float), np.asarray(labels, dtype=float)
    if not 0 < y.sum() < len(y):
        return Model(tuple(names), (0.0,) * len(names), 0.0, 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = ridge * len(x) * np.eye(z.shape[1])
    penalty[-1, -1] = 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty @ w
        hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + penalty + 1e-6 * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    weights = w[:-1] / scale
    rate = y.mean()
    return Model(
        tuple(names),
        tuple(weights.tolist()),
        float(w[-1] - weights @ mean),
        float(np.log(rate / (1 - rate))),
    )


def train(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most: int = TRAIN_ROWS,
) -> Model:
    """Fit on at most ``most`` labelled documents, chosen by a hash of their key."""
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .select(F.col(key).alias("__key"), F.col(label).cast("double").alias("__label"))
        .orderBy(F.xxhash64("__key"), "__key", "__label")
        .limit(most)
    )
    rows = documents.select(F.col(key).alias("__id"), text_of(text).alias("__text"))
    # at most ``most`` rows of two numbers
    rows = rows.join(F.broadcast(chosen), F.col("__id") == F.col("__key"))
    values = features(F.col("__text"))
    sample = rows.select(*values.values(), "__label").collect()
    ordered = sorted(tuple(row) for row in sample)
    return fit(list(values), [row[:-1] for row in ordered], [row[-1] for row in ordered])


def _log_odds(rate: Column) -> Column:
    safe = F.least(F.greatest(rate, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(safe / (1 - safe))


def _strength(sites: DataFrame, parent: str) -> float:
    """How many documents a site's parent is worth: within-site over between-site spread."""
    n, mean = F.col("n"), F.col("total") / F.col("n")
    within = F.col("squares") - F.col("total") * F.col("total") / F.col("n")
    row = sites.agg(
        F.count(F.lit(1)).alias("sites"),
        F.sum(n).alias("n"),
        F.sum(n * n).alias("nn"),
        F.sum(within).alias("within"),
        F.sum(n * (mean - F.col(parent)) * (mean - F.col(parent))).alias("between"),
    ).first()
    if not row["sites"] or row["sites"] < 2 or row["n"] <= row["sites"]:
        return MOST_STRENGTH
    inside = max(row["within"], 0.0) / (row["n"] - row["sites"])
    # expected: (sites - 1) * inside + spread * (n - sum of squares over n)
    weight = row["n"] - row["nn"] / row["n"]
    spread = (row["between"] - (row["sites"] - 1) * inside) / weight if weight > 0 else 0.0
    if spread <= 0:
        return MOST_STRENGTH
    return min(max(inside / spread, LEAST_STRENGTH), MOST_STRENGTH)


def _shrunk(
    strength: Column, parent: Column, total: Column, n: Column, own: Column | None = None
) -> Column:
    """A site's rate; ``own`` is the probability of a document to be left out."""
    if own is not None:
        total, n = total - own, n - 1
    return (total + strength * parent) / (n + strength)


def site_posteriors(scored: DataFrame) -> DataFrame:
    """Posterior mean quality of each (host, path): columns host, path, n, total, host_n,
    host_total, host_rate, path_rate, and the same on every row, whole_n, whole_total,
    host_strength, path_strength.

    ``scored`` has host, path and p, the document probability.
    """
    paths = written(
        scored.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("p").alias("total"),
            F.sum(F.col("p") * F.col("p")).alias("squares"),
        ),
        "paths",
    )
    whole_n, whole_total = paths.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0.0))
    ).first()
    whole = whole_total / whole_n if whole_n else 0.0
    hosts = paths.groupBy("host").agg(
        *(F.sum(name).alias(name) for name in ("n", "total", "squares"))
    )
    overall = F.lit(whole)
    host_strength = F.lit(_strength(hosts.withColumn("parent", overall), "parent"))
    rates = hosts.select(
        "host",
        F.col("n").alias("host_n"),
        F.col("total").alias("host_total"),
        _shrunk(host_strength, overall, F.col("total"), F.col("n")).alias("host_rate"),
    )
    with_host = (
        paths.alias("p")
        .join(rates.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host")))
        .select("p.*", "host_n", "host_total", "host_rate")
    )
    path_strength = F.lit(_strength(with_host, "host_rate"))
    rate = _shrunk(path_strength, F.col("host_rate"), F.col("total"), F.col("n"))
    return with_host.select(
        "host", "path", "n", "total", "host_n", "host_total", "host_rate", rate.alias("path_rate"),
        F.lit(whole_n).alias("whole_n"),
        F.lit(whole_total).alias("whole_total"),
        host_strength.alias("host_strength"),
        path_strength.alias("path_strength"),
    )


def rates_without(p: Column) -> tuple[Column, Column]:
    """Host and path rate over all documents but one with probability ``p``; a document alone in
    the table has a host rate drawn to one half."""
    rest = F.when(F.col("whole_n") > 1, (F.col("whole_total") - p) / (F.col("whole_n") - 1))
    overall = F.coalesce(rest, F.lit(0.5))
    host = _shrunk(
        F.col("host_strength"), overall, F.col("host_total"), F.col("host_n"), p
    )
    return host, _shrunk(F.col("path_strength"), host, F.col("total"), F.col("n"), p)


def classify(
    documents: DataFrame,
    model: Model,
    host: Column,
    path: Column,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per document: doc_id, host, path, evidence (log odds over the average), document_rate,
    host_rate and path_rate (both without the document itself), score and kept."""
    staged = documents.select(
        F.col(key).alias("doc_id"), host.alias("host"), path.alias("path"),
        text_of(text).alias("__text"),
    )
    odds = model.log_odds(features(F.col("__text")))
    scored = written(
        staged.select("doc_id", "host", "path", odds.alias("odds")).withColumn(
            "p", 1 / (1 + F.exp(-F.col("odds")))
        ),
        "evidence",
    )
    sites = site_posteriors(scored)
    matched = F.col("d.host").eqNullSafe(F.col("s.host")) & F.col("d.path").eqNullSafe(
        F.col("s.path")
    )
    evidence = F.col("odds") - model.prior
    host_rate, path_rate = rates_without(F.col("p"))
    total = F.col("evidence") + _log_odds(F.col("path_rate"))
    return (
        scored.alias("d")
        .join(sites.alias("s"), matched)
        .select(
            "doc_id",
            "d.host",
            "d.path",
            evidence.alias("evidence"),
            F.col("p").alias("document_rate"),
            host_rate.alias("host_rate"),
            path_rate.alias("path_rate"),
        )
        .select("*", (1 / (1 + F.exp(-total))).alias("score"))
        .withColumn("kept", F.col("score") >= KEEP_AT)
    )
