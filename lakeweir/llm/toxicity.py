"""Toxicity by a support vector machine over a subsequence string kernel.

Words are compared by the gap-weighted subsequence kernel, which counts common subsequences
of three characters and discounts gaps, so an insult with inserted or dropped characters
stays close to its plain form. Values are scaled by the landmark's own, so that what is
attached to an insult takes nothing from it: a word holding the whole landmark reaches one,
the most that counts; a power of the values makes near words stand out. A sentence, and so a
text, is described by its nearest word to each landmark and by its ``NEAREST`` nearest
together; Nyström's map (the inverse square root of the kernel among landmarks) turns those
into features of a linear machine, whose margin a fitted sigmoid makes a probability.

Landmarks and machine are learned from labelled sentences of a bounded number of texts.
Landmarks are words and word beginnings, so that an insult in all its endings is one.
Tokens are runs other than white space, lower-cased, with a mark for their beginning; long
ones are read in overlapping pieces, so that whole texts count.

Null and empty texts score like any text without a word near a landmark. Rows are scored one
by one, so repeats and ties change nothing; extra columns stay. Where there is nothing to
learn from (no labelled rows of both classes, or no word that tells them apart), every text
scores zero; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.text import slices, text_of, words_of
from lakeweir.sources.scratch import written

ORDER = 3  # characters in a common subsequence
DECAY = 0.7
PIECE = 20  # longest token compared at once
STEP = 10
COVER = 0.7  # share of a landmark's bytes a word needs for a kernel value above zero
NEAREST = 4
POWER = 4  # of a kernel value: what is near a landmark stands out
LANDMARKS = 40
STEMS = (3, 4, 5, 6)  # characters of a word beginning
STEM_WORDS = 2  # words with a beginning that make it count for a text
TRAIN_TEXTS = 8000
LEAST_TEXTS = 5
LEAST_GAIN = 0.05  # of the best landmark's
BEGINNING = b"^"
TEXTS_AT_ONCE, BYTES_AT_ONCE = 2000, 8 << 20
PREDICT_AT = 0.3


# -- the kernel ------------------------------------------------------------------------


def _codes(words: Sequence[bytes]):
    import numpy as np

    width = max(map(len, words), default=1) or 1
    padded = np.array([w.ljust(width, b"\0") for w in words], dtype=f"S{width}")
    return padded.view(np.uint8).reshape(len(words), width)


def kernel(left, right, order: int = ORDER, decay: float = DECAY):
    """Kernel of paired words: ``left`` and ``right`` are byte matrices padded with zeros.

    The usual recursion over prefixes, one vector operation for all pairs at once.
    """
    import numpy as np

    n, width = left.shape
    target = right.shape[1]
    # before[q][j]: weight of common subsequences of q characters in the prefixes so far
    before = np.zeros((order, target + 1, n), dtype=np.float32)
    before[0] = 1
    total = np.zeros(n, dtype=np.float32)
    for i in range(width):
        same = [(left[:, i] == right[:, j]) & (left[:, i] != 0) for j in range(target)]
        for j in range(target):
            total += same[j] * before[order - 1][j]
        for q in range(order - 1, 0, -1):
            run = np.zeros(n, dtype=np.float32)
            for j in range(target):
                run = decay * run + decay * decay * same[j] * before[q - 1][j]
                before[q][j + 1] = decay * before[q][j + 1] + run
    return total * np.float32(decay * decay)


def _present(codes):
    """A bit for each byte of the word, folded into 32."""
    import numpy as np

    bits = np.left_shift(np.uint32(1), codes.astype(np.uint32) & 31)
    return np.bitwise_or.reduce(np.where(codes > 0, bits, 0).astype(np.uint32), axis=1)


def similarities(words: Sequence[bytes], landmarks: Sequence[bytes]):
    """Matrix of scaled kernel values, to the ``POWER``; zero where too few bytes are shared."""
    import numpy as np

    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    codes, marks = _codes(words), _codes(landmarks)
    have, want = _present(codes), _present(marks)
    own_mark = kernel(marks, marks)
    need = np.ceil(COVER * np.bitwise_count(want))
    near = np.bitwise_count(have[:, None] & want[None, :]) >= need[None, :]
    row, column = np.nonzero(near)
    for at in range(0, len(row), 100_000):
        r, c = row[at : at + 100_000], column[at : at + 100_000]
        out[r, c] = np.minimum(kernel(codes[r], marks[c]) / own_mark[c], 1) ** POWER
    return out


def tokens(text: bytes) -> set[bytes]:
    out = set()
    for token in set(text.lower().split()):
        out.add(BEGINNING + token[:PIECE])
        out.update(token[at : at + PIECE] for at in range(STEP, len(token) - STEP, STEP))
    return out


def text_features(texts: Sequence[bytes], landmarks: Sequence[bytes]):
    """Per text and landmark the greatest kernel value of any of its words, then, again per
    landmark, the mean of the ``NEAREST`` greatest."""
    import numpy as np

    place: dict[bytes, int] = {}
    owners, members = [], []
    for number, text in enumerate(texts):
        own = [place.setdefault(token, len(place)) for token in tokens(text)]
        owners.append(np.full(len(own), number))
        members.append(np.array(own, dtype=np.int64))
    n = len(texts)
    first = np.zeros((n, len(landmarks)), dtype=np.float32)
    total = np.zeros((n, len(landmarks)), dtype=np.float32)
    if place:
        values = similarities(list(place), landmarks)
        member, owner = np.concatenate(members), np.concatenate(owners)
        for mark in range(len(landmarks)):
            own = values[:, mark][member]
            hit = np.nonzero(own)[0]
            # by text, greatest first; the rank within the text tells the nearest ones
            order = hit[np.lexsort((-own[hit], owner[hit]))]
            text, value = owner[order], own[order]
            starts = np.searchsorted(text, text)
            rank = np.arange(len(text)) - starts
            first[text[rank == 0], mark] = value[rank == 0]
            near = rank < NEAREST
            np.add.at(total[:, mark], text[near], value[near] / NEAREST)
    return np.hstack([first, total])


# -- the machine -----------------------------------------------------------------------


@dataclass(frozen=True)
class Machine:
    """Landmarks, the Nyström map folded into the weights, and the sigmoid."""

    landmarks: tuple[bytes, ...]
    weights: tuple[float, ...]
    bias: float
    slope: float
    shift: float

    def probabilities(self, features):
        import numpy as np

        margin = features @ np.array(self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def fit_machine(
    landmarks: Sequence[bytes], features, labels, ridge: float = 1e-4, steps: int = 100
) -> Machine:
    """Squared-hinge linear machine on Nyström features, then Platt's sigmoid."""
    import numpy as np

    marks = _codes(landmarks)
    m = len(landmarks)
    among = kernel(np.repeat(marks, m, axis=0), np.tile(marks, (m, 1))).reshape(m, m)
    among = (among / np.outer(np.diag(among), np.diag(among)) ** 0.5) ** POWER
    values, vectors = np.linalg.eigh(among.astype(np.float64))
    half = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T
    root = np.kron(np.eye(2), half)
    x = features.astype(np.float64) @ root
    y = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    share = (y > 0).mean()
    # both classes weigh the same
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / len(y)
    # Newton's method on the primal: only texts inside the margin have a slope
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(2 * m + 1)
    penalty = np.diag(np.append(np.full(2 * m, ridge), 1e-9))

    def loss(w):
        slack = np.maximum(0, 1 - y * (z @ w))
        return w @ penalty @ w / 2 + (weight * slack * slack).sum()

    for _ in range(steps):
        inside = y * (z @ w) < 1
        near, force = z[inside], weight[inside]
        gradient = penalty @ w - 2 * near.T @ (force * (y[inside] - near @ w))
        curve = penalty + 2 * (near * force[:, None]).T @ near + 1e-9 * np.eye(len(w))
        move = np.linalg.solve(curve, gradient)
        size = 1.0
        while size > 1e-4 and loss(w - size * move) > loss(w):
            size /= 2
        w = w - size * move
        if np.abs(size * move).max() < 1e-7:
            break
    w, b = w[:-1], float(w[-1])
    margin = x @ w + b
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        error, curve = p - (y > 0), p * (1 - p) + 1e-9
        gradient = np.array([(error * margin).sum(), error.sum()])
        hessian = np.array(
            [
                [(curve * margin * margin).sum() + 1e-3, (curve * margin).sum()],
                [(curve * margin).sum(), curve.sum() + 1e-3],
            ]
        )
        move = np.linalg.solve(hessian, gradient)
        slope, shift = slope - move[0], shift - move[1]
    folded = root @ w
    return Machine(tuple(landmarks), tuple(folded.tolist()), float(b), float(slope), float(shift))


def pick_landmarks(
    sample: DataFrame, count: int = LANDMARKS, least_texts: int = LEAST_TEXTS
) -> list[bytes]:
    """The words and word beginnings whose presence tells the classes apart best.

    One counts from ``least_texts`` toxic texts on, as a word of fewer may be there by chance;
    with few labels, or many toxic texts each in words of its own, ask for less. A beginning counts for a text that has ``STEM_WORDS`` different words with it. Only the
    best few hundred reach the driver; of related ones the best is taken.
    """
    totals = sample.groupBy("label").count().collect()
    sizes = {row["label"]: row["count"] for row in totals}
    if len(sizes) < 2:
        return []
    bare = F.regexp_replace(F.lower("text"), r"[^\p{L}\x20\x09-\x0D]+", "")
    words = sample.select(
        "label",
        F.xxhash64("text").alias("id"),
        F.explode(F.array_distinct(words_of(bare))).alias("word"),
    ).where(F.length("word").between(ORDER, PIECE))
    stems = F.array(*(F.substring("word", 1, size) for size in STEMS))
    many = (
        words.where(F.length("word") > min(STEMS))
        .select("label", "id", "word", F.explode(F.array_distinct(stems)).alias("mark"))
        .groupBy("label", "id", "mark")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= STEM_WORDS)
    )
    marks = words.select("label", "word").toDF("label", "mark").withColumn("stem", F.lit(False))
    marks = marks.unionByName(many.select("label", "mark", F.lit(True).alias("stem")))
    counted = marks.groupBy("mark", "stem").agg(
        F.sum(F.col("label").cast("long")).alias("bad"),
        F.sum(1 - F.col("label").cast("long")).alias("good"),
    )
    bad, good = F.col("bad"), F.col("good")
    expected = (bad + good) * (sizes[1] / (sizes[0] + sizes[1]))
    best = (
        counted.where((bad >= least_texts) & (bad > 2 * expected))
        .select("mark", (bad * F.log((bad + 0.5) / expected)).alias("gain"))
        .orderBy(F.desc("gain"), "mark")
        .limit(10 * count)
        .collect()
    )
    chosen: list[str] = []
    for row in best:
        mark = row["mark"]
        related = any(mark.startswith(c) or c.startswith(mark) for c in chosen)
        if not related and len(chosen) < count and row["gain"] >= LEAST_GAIN * best[0]["gain"]:
            chosen.append(mark)
    return [BEGINNING + mark.encode() for mark in chosen]


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most: int = TRAIN_TEXTS,
) -> DataFrame:
    """``text`` and ``label`` of at most ``most`` labelled texts, chosen by a hash of the key."""
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .select(F.col(key).alias("__key"), F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("__key"), "__key", "label")
        .limit(most)
    )
    rows = documents.select(F.col(key).alias("__id"), text_of(text).alias("text"))
    # the sample has at most ``most`` rows of two numbers
    return rows.join(F.broadcast(chosen), F.col("__id") == F.col("__key")).select("text", "label")


def train(sample: DataFrame, least_texts: int = LEAST_TEXTS) -> Machine:
    # copies of a text would make its own words look like a mark of its class
    sample = written(sample.dropDuplicates(["text", "label"]), "toxic-sample")
    landmarks = pick_landmarks(sample, least_texts=least_texts)
    if not landmarks:
        return Machine((), (), 0.0, 0.0, 0.0)

    def describe(batches):
        import pyarrow as pa

        for batch in batches:
            for rows in slices(batch, 0, TEXTS_AT_ONCE, BYTES_AT_ONCE):
                values = text_features(rows.column(0).to_pylist(), landmarks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.tolist(), pa.list_(pa.float32())), rows.column(1)],
                    names=["features", "label"],
                )

    described = sample.select(F.col("text").cast("binary"), "label").mapInArrow(
        describe, "features array<float>, label int"
    )
    import numpy as np

    rows = described.collect()  # as many rows as the sample, a few numbers each
    features = np.array([row["features"] for row in rows], dtype=np.float32)
    order = np.lexsort((*features.T, np.array([row["label"] for row in rows])))
    labels = np.array([row["label"] for row in rows])
    return fit_machine(landmarks, features[order], labels[order])


def score(text: Column, machine: Machine) -> Column:
    """Probability that a text is toxic, as a double column."""
    if not machine.landmarks:
        return F.lit(0.0)

    @F.arrow_udf("double")
    def of(texts):
        import numpy as np
        import pyarrow as pa

        out = []
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        for rows in slices(batch, 0, TEXTS_AT_ONCE, BYTES_AT_ONCE):
            part = rows.column(0).to_pylist()
            out.append(machine.probabilities(text_features(part, machine.landmarks)))
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    return of(text.cast("binary"))
