"""Toxicity and the quality classifier: kernels by definition, accuracy on held-out rows."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweir.llm import quality_classifier, toxicity
from lakeweir.llm.queries import QUERIES
from lakeweir.llm.text import text_of

BASE = "/root/testdata/sf0.1"


def collect(frame):
    return [row.asDict(recursive=True) for row in frame.collect()]


def auc(scores, labels):
    scores, labels = np.asarray(scores), np.asarray(labels)
    order = scores.argsort(kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    for value in np.unique(scores):
        ranks[scores == value] = ranks[scores == value].mean()
    n1 = labels.sum()
    return (ranks[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(labels) - n1))


# -- kernel ----------------------------------------------------------------------------


def brute_kernel(s, t, order=3, decay=0.7):
    def weights(word):
        out = {}
        for places in itertools.combinations(range(len(word)), order):
            key = tuple(word[p] for p in places)
            out[key] = out.get(key, 0) + decay ** (places[-1] - places[0] + 1)
        return out

    a, b = weights(s), weights(t)
    return sum(a[k] * b[k] for k in a.keys() & b.keys())


WORDS = [b"idiot", b"i-d.iot", b"idioot", b"moron", b"onoromo", b"ab", b"", b"abcabc", b"xxidiotxx"]


def test_kernel_is_the_sum_over_subsequences():
    pairs = list(itertools.product(WORDS, WORDS))
    left = toxicity._codes([a for a, _ in pairs])
    right = toxicity._codes([b for _, b in pairs])
    got = toxicity.kernel(left, right)
    want = [brute_kernel(a, b) for a, b in pairs]
    assert np.allclose(got, want, rtol=1e-4, atol=1e-6)


def test_gapped_and_padded_insults_stay_near():
    marks = [b"^idiot", b"^worthless"]
    words = [b"^idiot", b"^idi0ot", b"^idiot!!", b"^worth-less", b"^tree", b"##idiot"]
    near = toxicity.similarities(words, marks)
    assert near[0, 0] == pytest.approx(1, abs=1e-5)
    assert near[2, 0] == pytest.approx(1, abs=1e-5)
    assert near[1, 0] > 0.1
    assert near[3, 1] > 0.3
    assert near[5, 0] > 0.1
    assert not near[4].any()


def test_long_tokens_are_read_whole():
    text = b"q" * 95 + b"idiot" + b"q" * 95
    assert toxicity.text_features([text], [b"idiot"])[0, 0] > 0.9
    assert toxicity.text_features([b"", b" \n"], [b"idiot"]).tolist() == [[0, 0], [0, 0]]


def test_features_are_the_nearest_words():
    marks = [b"^idiot", b"^clown"]
    text = b"idiots idiot! id-iot tree clown"
    first, second, three, one = toxicity.text_features([b"tree", text], marks)[1]
    values = toxicity.similarities([b"^idiots", b"^idiot!", b"^id-iot"], [b"^idiot"])[:, 0]
    assert first == pytest.approx(max(values))
    assert three == pytest.approx(values.sum() / toxicity.NEAREST)
    assert (second, one) == (pytest.approx(1), pytest.approx(1 / toxicity.NEAREST))


def brute_score(text, machine, order=3, decay=0.7):
    """The probability of a text from the landmarks and weights, with kernels by definition."""

    def weights(word):
        out = {}
        for places in itertools.combinations(range(len(word)), order):
            key = bytes(word[p] for p in places)
            out[key] = out.get(key, 0) + decay ** (places[-1] - places[0] + 1)
        return out

    tokens = set()
    for word in text.encode().lower().split():
        tokens.add(b"^" + word[:20])
        tokens |= {word[at : at + 20] for at in range(10, len(word) - 10, 10)}
    parts = {token: weights(token) for token in tokens}
    best, near = [], []
    for mark in machine.landmarks:
        own = weights(mark)
        whole = sum(v * v for v in own.values())
        wanted = {c & 31 for c in mark}
        values = []
        for token, found in parts.items():
            if len(wanted & {c & 31 for c in token}) >= np.ceil(0.7 * len(wanted)):
                shared = sum(found[k] * own[k] for k in found.keys() & own.keys())
                values.append(min(shared / whole, 1) ** 4)
        values = sorted(values, reverse=True)[:4]
        best.append(values[0] if values else 0.0)
        near.append(sum(values) / 4)
    margin = np.dot([*best, *near], machine.weights) + machine.bias
    return 1 / (1 + np.exp(-np.clip(machine.slope * margin + machine.shift, -30, 30)))


def test_scores_by_definition(spark, sf_dir, docs):
    """Scores of whole and odd texts recomputed from the machine that the query trains."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    machine = toxicity.train(toxicity.labelled_sample(rows, labels))
    assert len(machine.landmarks) > 5
    marks = [mark.decode(errors="ignore").strip("^") for mark in machine.landmarks]
    texts = [text[:400] for _, text in docs[:25]]
    texts += ["", " \n", "x" * 75, " ".join(marks), f"such an {'.'.join(marks[0])} and {marks[1]}s!"]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    got = collect(frame.select("text", toxicity.score(text_of(), machine).alias("s")))
    for r in got:
        assert r["s"] == pytest.approx(brute_score(r["text"], machine), abs=2e-4)
    assert max(r["s"] for r in got) > 0.5 > min(r["s"] for r in got)


# -- toxicity on held-out rows ---------------------------------------------------------


def test_toxicity_of_held_out_rows(spark):
    rows = collect(QUERIES["op10_toxicity"](spark, BASE))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{BASE}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{BASE}/documents.parquet").count()
    assert all(r["held_out"] is (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    truth = np.array([labels[r["doc_id"]] for r in held])
    predicted = np.array([r["predicted"] for r in held])
    print("auc", auc([r["score"] for r in held], truth), "recall", predicted[truth == 1].mean(),
          "false", predicted[truth == 0].mean())
    assert auc([r["score"] for r in held], truth) > 0.95
    assert predicted[truth == 1].mean() > 0.85
    assert predicted[truth == 0].mean() < 0.03


def test_toxicity_edges(spark, edge_frame, empty_frame):
    bad = [(i, f"you are an idiot and a moron number {i}", 1) for i in range(10)]
    good = [(i, f"the tree by the river is number {i}", 0) for i in range(20, 40)]
    odd = [(50, None, 0), (51, "", 1), (52, "idiot", None), (None, "moron", 1)]
    frame = spark.createDataFrame(bad + good + odd, "doc_id long, text string, toxic int")
    sample = toxicity.labelled_sample(frame, frame.select("doc_id", "toxic"))
    assert sample.count() == 32
    machine = toxicity.train(sample)
    scored = collect(edge_frame.select("*", toxicity.score(text_of(), machine).alias("s")))
    assert len(scored) == 11
    assert all(0 <= r["s"] <= 1 for r in scored)
    plain = spark.createDataFrame([("such an i.d.i.o.t!",), ("a tree",)], "text string")
    scored = collect(plain.select(toxicity.score(text_of(), machine).alias("s")))
    insult, calm = (r["s"] for r in scored)
    assert insult > 0.3 > calm
    assert collect(empty_frame.select(toxicity.score(text_of(), machine).alias("s"))) == []
    for nothing in (sample.where("label = 0"), sample.limit(0), sample.limit(2)):
        untaught = toxicity.train(nothing)
        rows = collect(edge_frame.select(toxicity.score(text_of(), untaught).alias("s")))
        assert {r["s"] for r in rows} == {0.0}


# -- quality classifier ----------------------------------------------------------------


def test_quality_of_held_out_rows(spark):
    rows = spark.read.parquet(f"{BASE}/documents.parquet")
    labels = spark.read.parquet(f"{BASE}/labels.parquet")
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = quality_classifier.train(rows, labels.where(~odd))
    scored = quality_classifier.classify(rows, model, F.col("source"), F.col("lang"))
    held = collect(scored.join(labels.where(odd), "doc_id"))
    truth = np.array([r["quality"] for r in held])
    kept = np.array([r["kept"] for r in held])
    assert auc([r["score"] for r in held], truth) > 0.9
    assert kept[truth == 1].mean() > 0.97


def brute_sites(rows):
    """rows: (host, path, p). Moments by their definition, for hosts and then paths."""

    def strength(groups, parents):
        sizes = {k: len(v) for k, v in groups.items()}
        n, k = sum(sizes.values()), len(groups)
        if k < 2 or n <= k:
            return quality_classifier.MOST_STRENGTH
        within = sum(sum((x - np.mean(v)) ** 2 for x in v) for v in groups.values()) / (n - k)
        between = sum(len(v) * (np.mean(v) - parents[g]) ** 2 for g, v in groups.items())
        spread = (between - (k - 1) * within) / (n - sum(s * s for s in sizes.values()) / n)
        if spread <= 0:
            return quality_classifier.MOST_STRENGTH
        return min(max(within / spread, 1.0), 1e6)

    def shrink(groups, parents):
        a = strength(groups, parents)
        return {g: (sum(v) + a * parents[g]) / (len(v) + a) for g, v in groups.items()}

    hosts, paths = {}, {}
    for host, path, p in rows:
        hosts.setdefault(host, []).append(p)
        paths.setdefault((host, path), []).append(p)
    overall = np.mean([p for *_, p in rows])
    host_rate = shrink(hosts, {h: overall for h in hosts})
    path_rate = shrink(paths, {k: host_rate[k[0]] for k in paths})
    return host_rate, path_rate


def test_sites_shrink_by_moments(spark):
    rng = np.random.default_rng(5)
    rows = [
        (host, f"p{path}", float(np.clip(rng.normal(0.2 + 0.1 * i + 0.05 * path, 0.1), 0, 1)))
        for i, host in enumerate(["a", "b", "c", None])
        for path in range(3)
        for _ in range(2 + 30 * (path == 0))
    ]
    frame = spark.createDataFrame(rows, "host string, path string, p double")
    host_rate, path_rate = brute_sites(rows)
    got = collect(quality_classifier.site_posteriors(frame))
    assert len(got) == len(path_rate)
    for r in got:
        assert r["host_rate"] == pytest.approx(host_rate[r["host"]])
        assert r["path_rate"] == pytest.approx(path_rate[r["host"], r["path"]])


def test_a_document_counts_once(spark):
    """Scores recomputed from the evidence, each document left out of its own site's rates."""
    rng = np.random.default_rng(7)
    rows = [
        (i, "".join(rng.choice(list("ab!#. 7\n"), 60)), rng.choice(["a", "b", "c"]), f"p{i % 2}")
        for i in range(60)
    ] + [(100, "one of its own", "d", "p")]
    schema = "doc_id long, text string, h string, p string"
    frame = spark.createDataFrame([(int(i), t, str(h), p) for i, t, h, p in rows], schema)
    names = tuple(quality_classifier.features(text_of()))
    weights = (0.9, 3.0, 2.0, -2.0, 1.0, 4.0, 0.5, 1.0)
    model = quality_classifier.Model(names, weights, -1.0, 0.4)
    got = collect(quality_classifier.classify(frame, model, F.col("h"), F.col("p")))
    sites = collect(
        quality_classifier.site_posteriors(
            spark.createDataFrame(
                [(r["host"], r["path"], r["document_rate"]) for r in got],
                "host string, path string, p double",
            )
        )
    )
    strengths = sites[0]["host_strength"], sites[0]["path_strength"]
    for r in got:
        others = [o for o in got if o["doc_id"] != r["doc_id"]]
        host = [o["document_rate"] for o in others if o["host"] == r["host"]]
        path = [
            o["document_rate"] for o in others
            if (o["host"], o["path"]) == (r["host"], r["path"])
        ]
        overall = np.mean([o["document_rate"] for o in others])
        host_rate = (sum(host) + strengths[0] * overall) / (len(host) + strengths[0])
        path_rate = (sum(path) + strengths[1] * host_rate) / (len(path) + strengths[1])
        odds = r["evidence"] + np.log(path_rate / (1 - path_rate))
        assert r["host_rate"] == pytest.approx(host_rate)
        assert r["path_rate"] == pytest.approx(path_rate)
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-odds)))


def test_quality_query_and_edges(spark, sf_dir, edge_frame, empty_frame):
    rows = collect(QUERIES["op5_quality_classifier"](spark, sf_dir))
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    names = list(quality_classifier.features(text_of()))
    model = quality_classifier.Model(tuple(names), (0.1,) * len(names), 0.2, 0.0)
    host = F.when(F.col("doc_id") > 5, "h")
    out = collect(quality_classifier.classify(edge_frame, model, host, F.lit("p")))
    assert len(out) == 11
    assert all(0 < r["score"] < 1 for r in out)
    assert collect(quality_classifier.classify(empty_frame, model, host, F.lit("p"))) == []
    for labels in ([1, 1], []):
        untaught = quality_classifier.fit(names, [[1.0] * len(names)] * len(labels), labels)
        out = collect(quality_classifier.classify(edge_frame, untaught, host, F.lit("p")))
        assert {round(r["score"], 9) for r in out} == {0.5}
