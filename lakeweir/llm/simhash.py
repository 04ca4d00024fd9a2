"""SimHash near-duplicates found with vantage-point trees.

Fingerprints are 64-bit majority votes over the XXH64 hashes of three-word shingles. Two
fingerprints link when they differ in few bits; documents reachable over links form a
component.

Distinct fingerprints are partitioned by a vantage-point tree: each inner node sends a
fingerprint nearer to its vantage point than the node's radius inward and the others outward;
an inner fingerprint whose ball reaches over the boundary also visits the outer side, so both
ends of a link meet in the outer end's leaf. The shape of the tree comes from a bounded
sample, its depth from the number of fingerprints. A leaf searches exactly: a tree of its own,
pruned by triangle bounds, emits one link from each fingerprint to a representative it
reaches, so that a dense cluster costs as many links as members.

Null and empty texts have the fingerprint zero. Repeated rows share one. An empty table gives
an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.text import text_of
from lakeweir.sources.scratch import written

SEED = 42
SHINGLE = 3
RADIUS = 2
LEAF = 4096
SAMPLE = 20_000
BLOCK = 256


# -- fingerprints ----------------------------------------------------------------------


def fingerprint_of_bytes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint as a signed 64-bit number."""
    import numpy as np
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), seed)]
    else:
        shifted = (words[i:] for i in range(shingle))
        hashes = [digest(s, seed) for s in map(b" ".join, zip(*shifted, strict=False))]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = np.array(hashes[at : at + 4096], dtype=">u8").view(np.uint8)
        ones += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """Fingerprint of a text column as a long. Bytes are lower-cased and split as ASCII."""

    @F.arrow_udf("long")
    def of(texts):
        import pyarrow as pa

        return pa.array(
            [fingerprint_of_bytes(t.as_py(), shingle, seed) for t in texts], pa.int64()
        )

    return of(text.cast("binary"))


# -- the tree over shards --------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Vantage points and radii in heap order: the children of node i are 2i + 1, 2i + 2."""

    points: tuple[int, ...]
    radii: tuple[int, ...]
    depth: int


def plant(sample: Sequence[int], depth: int, seed: int = SEED) -> Tree:
    """A tree of ``depth`` levels with median radii over ``sample`` (signed longs)."""
    import numpy as np

    rng = np.random.default_rng(seed)
    points, radii = [], []
    level = [np.array(sorted(sample), dtype=np.int64).view(np.uint64)]
    for _ in range(depth):
        below = []
        for part in level:
            # an empty part can take any point: nothing of the sample reaches it
            point = part[rng.integers(len(part))] if len(part) else np.uint64(rng.integers(2**63))
            distance = np.bitwise_count(part ^ point)
            radius = int(np.median(distance)) if len(part) else 32
            points.append(int(np.array(point, dtype=np.uint64).view(np.int64)))
            radii.append(radius)
            below += [part[distance <= radius], part[distance > radius]]
        level = below
    return Tree(tuple(points), tuple(radii), depth)


def route(tree: Tree, values, reach: int):
    """Leaves of each value: arrays (index, leaf, home). Only one leaf of a value is home."""
    import numpy as np

    values = values.view(np.uint64)
    index = np.arange(len(values))
    node = np.zeros(len(values), dtype=np.int64)
    home = np.ones(len(values), dtype=bool)
    points = np.array(tree.points, dtype=np.int64).view(np.uint64)
    radii = np.array(tree.radii, dtype=np.int64)
    for _ in range(tree.depth):
        distance = np.bitwise_count(values[index] ^ points[node]).astype(np.int64)
        inner = distance <= radii[node]
        over = inner & (distance + reach > radii[node])
        down = np.where(inner, 2 * node + 1, 2 * node + 2)
        index = np.concatenate([index, index[over]])
        node = np.concatenate([down, 2 * node[over] + 2])
        home = np.concatenate([home, np.zeros(int(over.sum()), dtype=bool)])
    return index, node, home


# -- exact search in a leaf ------------------------------------------------------------


class _Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, a: int) -> int:
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def leaf_links(values, reach: int):
    """Component representative (an index) of each of ``values`` under links within ``reach``.

    A tree over the leaf: inner values whose ball crosses a boundary are searched on the
    outer side as well; parts under a block's size are compared in full.
    """
    import numpy as np

    values = values.view(np.uint64)
    union = _Union(len(values))
    rng = np.random.default_rng(SEED)

    def compare(left, right) -> None:
        for at in range(0, len(left), BLOCK):
            rows = left[at : at + BLOCK]
            near = np.bitwise_count(values[rows][:, None] ^ values[right][None, :]) <= reach
            a, b = np.nonzero(near)
            for i, j in zip(rows[a].tolist(), right[b].tolist(), strict=True):
                if i < j:
                    union.join(i, j)
                elif j < i:
                    union.join(j, i)

    def search(own, visiting) -> None:
        """Link pairs among ``own``, and between ``visiting`` and ``own``."""
        stack = [(own, visiting)]
        while stack:
            own, visiting = stack.pop()
            if not len(own):
                continue
            if len(own) > BLOCK:
                point = values[own[rng.integers(len(own))]]
                d_own = np.bitwise_count(values[own] ^ point).astype(np.int64)
                radius = int(np.median(d_own))
                if (d_own <= radius).all():
                    radius -= 1
                inner = d_own <= radius
                if inner.any() and not inner.all():
                    d_visit = np.bitwise_count(values[visiting] ^ point).astype(np.int64)
                    crossing = own[inner & (d_own + reach > radius)]
                    stack.append((own[inner], visiting[d_visit - reach <= radius]))
                    outward = visiting[d_visit + reach > radius]
                    stack.append((own[~inner], np.concatenate([outward, crossing])))
                    continue
            compare(own, np.concatenate([own, visiting]))

    search(np.arange(len(values)), np.arange(0))
    return [union.find(i) for i in range(len(values))]


# -- components ------------------------------------------------------------------------


def _routed(tree: Tree, reach: int):
    def send(batches):
        import pyarrow as pa

        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            index, leaf, _ = route(tree, values, reach)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf), pa.array(values[index])], names=["leaf", "value"]
            )

    return send


def _linked(reach: int):
    def link(table):
        import numpy as np
        import pyarrow as pa

        values = np.sort(table.column("value").to_numpy())
        roots = np.array(leaf_links(values, reach), dtype=np.int64)
        other = roots != np.arange(len(values))
        return pa.table({"a": values[other], "b": values[roots[other]]})

    return link


def links(values: DataFrame, reach: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) that connect the distinct ``value`` rows within ``reach`` bits."""
    n = values.count()
    depth = max(0, (max(n, 1) - 1) // leaf).bit_length()
    sample = [row[0] for row in values.orderBy(F.xxhash64("value")).limit(SAMPLE).collect()]
    tree = plant(sample, depth)
    routed = values.mapInArrow(_routed(tree, reach), "leaf long, value long")
    return routed.groupBy("leaf").applyInArrow(_linked(reach), "a long, b long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (its smallest reachable node) for every node of an edge table.

    Large and small stars in turn; each round is written, so lost executors cost one round.
    """
    pairs = written(
        edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .where(F.col("node") != F.col("root"))
        .distinct(),
        "links",
    )
    for _ in range(max_rounds):
        both = pairs.select("node", "root").unionByName(
            pairs.select(F.col("root").alias("node"), F.col("node").alias("root"))
        )
        # large star: larger neighbours move to the smallest neighbour
        least = both.groupBy("node").agg(F.min("root").alias("low"))
        least = least.select("node", F.least("node", "low").alias("low"))
        large = (
            both.join(least, "node")
            .where(F.col("root") > F.col("node"))
            .select(F.col("root").alias("node"), F.col("low").alias("root"))
            .distinct()
        )
        # small star: a node and its smaller neighbours move to the smallest of them
        lowest = large.groupBy("node").agg(F.min("root").alias("low"))
        small = (
            large.join(lowest, "node")
            .select(F.col("root").alias("node"), F.col("low").alias("root"))
            .unionByName(lowest.select("node", F.col("low").alias("root")))
            .where(F.col("node") != F.col("root"))
            .distinct()
        )
        moved = written(small, "links")
        # both steps keep components, so equal sums of hashes mean a fixed point
        if _digest(moved) == _digest(pairs):
            return moved
        pairs = moved
    raise RuntimeError("components did not settle")


def _digest(pairs: DataFrame):
    hashed = F.xxhash64("node", "root").cast("decimal(38,0)")
    return pairs.agg(F.count(F.lit(1)), F.sum(hashed)).first()


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", reach: int = RADIUS
) -> DataFrame:
    """Per document: ``doc_id``, ``fingerprint`` (long) and ``component_id``, the smallest
    key of its component."""
    prints = written(
        documents.select(
            F.col(key).alias("doc_id"), fingerprint(text_of(text)).alias("fingerprint")
        ),
        "fingerprints",
    )
    classes = written(
        prints.groupBy(F.col("fingerprint").alias("value")).agg(F.min("doc_id").alias("first")),
        "classes",
    )
    roots = components(links(classes.select("value"), reach))
    named = classes.join(roots, F.col("value") == F.col("node"), "left").select(
        "value", "first", F.coalesce("root", "value").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = written(named.join(smallest, "root").select("value", "component_id"), "labels")
    return prints.join(labels, F.col("fingerprint") == F.col("value")).select(
        "doc_id", "fingerprint", "component_id"
    )
