"""A trie of conversations: what turn sequences share, node by node.

A conversation is a sequence of turns (role, text). Each distinct sequence of the first d turns of
some conversation is a node of depth d, from the textless root on; conversations that start with it
are its members.

Turns become 128-bit ids, hashes of their depth, role and text, in two longs. Conversations are cut
into segments of ``WIDTH`` turns, so that a long one is many rows; a segment knows the node it
hangs from, as the exclusive or of all ids before it. Segments are range-partitioned by that node,
their first ids and their conversation, and each task works through its range in chunks of bounded
size. A chunk is a padded matrix of turn ids: a lexicographic sort brings equal prefixes together,
masks of changes between neighbouring rows, accumulated by OR over the columns, mark where nodes
start, and reductions over the marked runs aggregate every depth.

Nodes that may have members in other chunks are open: those that share the leading ids of a
chunk's first or last row, and those above a cut between segments. A chunk gives what it knows of
an open node, what is below it already counted, and parts of one node meet in a grouping. Sums over
subtrees of open nodes follow the rows of their smallest members: each open node adds what is its
own to the nodes above it on that conversation's path, so no path is walked step by step.

A null role or text is empty; turns go by number, null first, turns of one number by their hashes.
Rows without a conversation id are left out. Repeated rows are turns of their own. An empty table
has no node. Other columns are not carried. The turns of one conversation are numbered by one
task, which keeps them on disk; the conversations that end at one node are hashed in a row, as
SHA-256 demands, in one task that streams them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeweir.sources.scratch import written

WIDTH = 64
LEAD = 8  # ids of a segment that take part in its range
CHUNK = 1 << 15  # segments
SHARED_TURNS = 6
FAMILY = 100
NODES = (
    "depth long, k1 long, k2 long, p1 long, p2 long, parent long, conv_id long, n_convs long, "
    "chars long, n_children long, n_leaves long, saved_tokens long, open boolean, "
    "first_end long, ends string"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()
_SALT = 7


# -- rebuilding ------------------------------------------------------------------------


def head_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED_TURNS


def numbered_turns(
    table: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Turns in order: ``conv_id``, ``place`` from 1, the hashes ``t1`` and ``t2`` of role and
    text, and ``chars``, the code points of the text. Texts are not carried further."""
    said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = table.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(*said).alias("t1"),
        F.xxhash64(F.lit(_SALT), *said).alias("t2"),
        F.char_length(said[1]).cast("long").alias("chars"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "t1", "t2")
    return rows.withColumn("place", F.row_number().over(order).cast("long")).drop("turn")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations with the head of their family's first one in place of their own: rows
    ``conv_id``, ``depth``, ``t1``, ``t2``, ``chars``, and one of depth 0 per conversation."""
    turns = written(turns, "turns")
    head = F.struct(F.col("place").alias("depth"), "t1", "t2", "chars")
    heads = (
        turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED_TURNS))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(head)).alias("head"))
    )
    wanted = head_turns(F.col("conv_id")).cast("int")
    none = F.slice("taken", 1, 0)
    zero = F.lit(0).cast("long")
    marker = F.array(F.struct(*(zero.alias(name) for name in ("depth", "t1", "t2", "chars"))))
    depth = (F.col("place") - F.col("wanted") + F.size("taken")).alias("depth")
    own = F.array(F.struct(depth, "t1", "t2", "chars"))
    # a head has up to five turns; the first own turn of a conversation brings them along
    given = F.when(F.col("place") == 1, F.concat(marker, "taken")).otherwise(none)
    kept = F.when(F.col("place") > F.col("wanted"), own).otherwise(none)
    return (
        turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(heads, "base", "left")
        .withColumn("wanted", wanted)
        .withColumn("taken", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("wanted")))
        .select("conv_id", F.explode(F.concat(given, kept)).alias("turn"))
        .select("conv_id", "turn.*")
    )


def segments_of(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """``conv_id``, ``band`` (the number of the segment), ``p1`` and ``p2`` (the node before it),
    arrays ``v1``, ``v2``, ``chars`` of at most ``width`` turns, and ``more``, whether the
    conversation goes on after it."""
    band = F.when(F.col("depth") == 0, 0).otherwise(F.floor((F.col("depth") - 1) / width))
    first = F.xxhash64("depth", "t1", "t2")
    turn = F.struct(
        "depth",
        F.when(first == 0, 1).otherwise(first).alias("v1"),  # zero stands for no turn
        F.xxhash64(F.lit(_SALT), "t2", "t1", "depth").alias("v2"),
        "chars",
    )
    cut = rows.groupBy("conv_id", band.cast("long").alias("band")).agg(
        F.sort_array(F.collect_list(F.when(F.col("depth") > 0, turn))).alias("turns")
    )

    def mixed(name: str) -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate(F.col(f"turns.{name}"), zero, lambda a, b: a.bitwiseXOR(b))

    along = Window.partitionBy("conv_id").orderBy("band")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.select("*", mixed("v1").alias("m1"), mixed("v2").alias("m2"))
    return cut.select(
        "conv_id",
        "band",
        F.coalesce(F.bit_xor("m1").over(before), F.lit(0)).alias("p1"),
        F.coalesce(F.bit_xor("m2").over(before), F.lit(0)).alias("p2"),
        F.col("turns.v1").alias("v1"),
        F.col("turns.v2").alias("v2"),
        F.col("turns.chars").alias("chars"),
        F.lead("band").over(along).isNotNull().alias("more"),
    )


# -- one chunk -------------------------------------------------------------------------


def _padded(column, lengths, width: int):
    """A list column as a matrix, zero where a row is shorter."""
    import numpy as np

    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def chunk_nodes(table, width: int = WIDTH, lead: int = LEAD):
    """The nodes of a chunk of segments (an Arrow table in the order of the ranges)."""
    import numpy as np
    import pyarrow as pa

    table = table.combine_chunks()
    conv, band, p1, p2 = (
        table.column(name).to_numpy().astype(np.int64) for name in ("conv_id", "band", "p1", "p2")
    )
    more = table.column("more").to_numpy(zero_copy_only=False).astype(bool)
    lists = {name: table.column(name).combine_chunks() for name in ("v1", "v2", "chars")}
    lengths = lists["v1"].value_lengths().to_numpy().astype(np.int64)
    columns = int(lengths.max(initial=0))
    v1, v2, chars = (_padded(lists[name], lengths, columns) for name in ("v1", "v2", "chars"))

    edges = [(band[at], p1[at], p2[at], v1[at].copy()) for at in (0, len(conv) - 1)]
    keys = [conv]
    for j in reversed(range(columns)):
        keys += [v2[:, j], v1[:, j]]
    order = np.lexsort([*keys, p2, p1, band])
    conv, band, p1, p2, more, lengths = (a[order] for a in (conv, band, p1, p2, more, lengths))
    v1, v2, chars = v1[order], v2[order], chars[order]
    n = len(conv)

    # column 0 stands for the node that segments hang from, column j for their j-th turn
    change = np.zeros((n, columns + 1), dtype=bool)
    change[0] = True
    for a in (band, p1, p2):
        change[1:, 0] |= a[1:] != a[:-1]
    change[1:, 1:] = (v1[1:] != v1[:-1]) | (v2[1:] != v2[:-1])
    change = np.logical_or.accumulate(change, axis=1)
    k1 = np.bitwise_xor.accumulate(np.column_stack([p1, v1]), axis=1)
    k2 = np.bitwise_xor.accumulate(np.column_stack([p2, v2]), axis=1)

    # rows like the first or the last one as far as the range looks
    edge = np.zeros((n, columns + 1), dtype=bool)
    for at_band, at_p1, at_p2, ids in edges:
        like = np.zeros((n, columns + 1), dtype=bool)
        like[:, 0] = (band == at_band) & (p1 == at_p1) & (p2 == at_p2)
        like[:, 1:] = v1 == ids
        like[:, lead + 1 :] = True
        edge |= np.logical_and.accumulate(like, axis=1)

    # from the root on: where nodes start, their smallest member, and whether they are open
    starts, lowest, opens = [], [], []
    for j in range(columns + 1):
        runs = np.flatnonzero(change[:, j])
        starts.append(runs)
        lowest.append(np.minimum.reduceat(conv, runs))
        # what hangs from a root, and what has longer conversations, is known only all together
        opens.append(edge[runs, j] | (j == 0) | np.logical_or.reduceat(more, runs))

    # from the leaves up: sums over closed nodes, kept at the start of their parent's run
    leaves = np.zeros(n, dtype=np.int64)
    saved = np.zeros(n, dtype=np.int64)
    closed_starts = np.zeros(n, dtype=np.int64)
    texts = conv.astype(str)
    kinds = [*[pa.int64()] * 12, pa.bool_(), pa.int64(), pa.string()]
    out = []
    for j in reversed(range(columns + 1)):
        runs, is_open = starts[j], opens[j]
        stops = np.append(runs[1:], n)
        here = lengths[runs] >= j  # else these conversations have ended before
        ending = (lengths == j) & ~more
        count = np.add.reduceat((lengths >= j).astype(np.int64), runs)
        children = np.add.reduceat(closed_starts, runs)
        n_leaves = np.add.reduceat(leaves, runs)
        n_saved = np.add.reduceat(saved, runs)
        own = chars[runs, j - 1] if j else np.zeros(len(runs), dtype=np.int64)
        closed = here & ~is_open
        n_leaves[closed & (children == 0)] = 1
        n_saved += np.where(closed, (count - 1) * own, 0)
        for sums, values in ((leaves, n_leaves), (saved, n_saved), (closed_starts, closed)):
            sums[:] = 0
            sums[runs] = np.where(is_open, 0, values)  # an open node keeps what is below it

        # the node that later segments hang from belongs to the segment before
        hanging = (j == 0) & (band[runs] > 0)
        has_end = (np.add.reduceat(ending.astype(np.int64), runs) > 0) & here
        first_end = np.zeros(len(runs), dtype=np.int64)
        ends = np.where(is_open, None, NO_ENDS).astype(object)
        for i in np.flatnonzero(has_end).tolist():
            rows = slice(int(runs[i]), int(stops[i]))
            listed = ",".join(texts[rows][ending[rows]].tolist())
            first_end[i] = conv[rows][ending[rows]][0]
            ends[i] = listed if is_open[i] else hashlib.sha256(listed.encode()).hexdigest()
        before = max(j - 1, 0)
        above = np.searchsorted(starts[before], runs, side="right") - 1
        no_parent = np.full(len(runs), j == 0)
        columns_out = (
            (band[runs] * width + j, None),
            (k1[runs, j], None),
            (k2[runs, j], None),
            (k1[runs, before], no_parent),
            (k2[runs, before], no_parent),
            (lowest[before][above], no_parent | opens[before][above]),
            (lowest[j], hanging),
            (np.where(hanging, 0, count), None),
            (own, hanging),
            (children, None),
            (n_leaves, None),
            (n_saved, None),
            (is_open, None),
            (first_end, ~(has_end & is_open)),
            (ends, None),
        )
        out.append(
            [
                pa.array(values[here], kind, mask=None if mask is None else mask[here])
                for (values, mask), kind in zip(columns_out, kinds, strict=True)
            ]
        )
    arrays = [pa.concat_arrays(parts) for parts in zip(*out, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[x.split(" ")[0] for x in NODES.split(", ")])


def _chunks(width: int, lead: int, chunk: int):
    def run(batches):
        import pyarrow as pa

        held: list = []
        n = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, chunk - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == chunk:
                    yield chunk_nodes(pa.Table.from_batches(held), width, lead)
                    held, n = [], 0
        if n:
            yield chunk_nodes(pa.Table.from_batches(held), width, lead)

    return run


# -- over a table ----------------------------------------------------------------------


def _hashed_ends(batches):
    """SHA-256 of the ends of each node; rows come sorted by node and place."""
    import pyarrow as pa

    names = ["depth", "k1", "k2"]
    node, digest = None, None

    def result(node, digest):
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip((*node, digest.hexdigest()), types, strict=True)],
            names=[*names, "ends"],
        )

    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[name] for name in names)
            if own != node:
                if node is not None:
                    yield result(node, digest)
                node, digest = own, hashlib.sha256(row["ends"].encode())
            else:
                digest.update(b"," + row["ends"].encode())
    if node is not None:
        yield result(node, digest)


def trie(
    rows: DataFrame, width: int = WIDTH, lead: int = LEAD, chunk: int = CHUNK
) -> DataFrame:
    """The nodes of conversations given as rows ``conv_id``, ``depth``, ``t1``, ``t2``, ``chars``
    with one row of depth 0 each: ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``."""
    node = ["depth", "k1", "k2"]
    segments = written(segments_of(rows, width), "segments")
    ranged = ["band", "p1", "p2", "lead", "conv_id"]
    placed = (
        segments.withColumn("lead", F.slice("v1", 1, lead))
        .repartitionByRange(*ranged)
        .sortWithinPartitions(*ranged)
        .drop("lead")
    )
    nodes = written(placed.mapInArrow(_chunks(width, lead, chunk), NODES), "nodes")

    parts = nodes.where("open")
    merged = written(
        parts.groupBy(*node).agg(
            F.max("p1").alias("p1"),
            F.max("p2").alias("p2"),
            F.min("conv_id").alias("conv_id"),
            F.max("chars").alias("chars"),
            *(
                F.sum(name).alias(name)
                for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")
            ),
        ),
        "open-nodes",
    )
    children = merged.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count(F.lit(1)).alias("open_children"))
    n_children = F.col("n_children") + F.coalesce("open_children", F.lit(0))
    valued = written(
        merged.join(children, node, "left")
        .withColumn("n_children", n_children)
        .drop("open_children")
        .withColumn("own_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
        .withColumn(
            "own_saved",
            F.col("saved_tokens") + (F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0)),
        ),
        "valued-nodes",
    )

    # every smallest member of an open node, along all of its path
    paths = _paths(segments, valued.select("conv_id").distinct(), width)
    own = valued.select(*node, F.col("conv_id").alias("owner"), "own_leaves", "own_saved")
    added = (
        F.when(F.col("owner") == F.col("conv_id"), F.col(name)).otherwise(0)
        for name in ("own_leaves", "own_saved")
    )
    # only open nodes matter; a conversation's are the first ones of its path
    stepped = paths.join(own, node).select("conv_id", *node, *(
        value.alias(name) for value, name in zip(added, ("a_leaves", "a_saved"), strict=True)
    ))
    upward = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sums = (
        stepped.select(
            *node,
            F.sum("a_leaves").over(upward).alias("s_leaves"),
            F.sum("a_saved").over(upward).alias("s_saved"),
        )
        .groupBy(*node)
        .agg(F.sum("s_leaves").alias("t_leaves"), F.sum("s_saved").alias("t_saved"))
    )
    listed = (
        parts.where("first_end IS NOT NULL")
        .select(*node, "first_end", "ends")
        .repartition(*node)
        .sortWithinPartitions(*node, "first_end")
        .drop("first_end")
    )
    hashed = listed.mapInArrow(
        _hashed_ends, "depth long, k1 long, k2 long, ends string"
    )
    opened = written(
        valued.join(sums, node)
        .join(hashed, node, "left")
        .select(
            *node, "p1", "p2", "conv_id", "n_convs", "n_children",
            F.col("t_leaves").alias("n_leaves"),
            F.col("t_saved").alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"),
        ),
        "opened",
    )
    # only open parents are unknown to a chunk
    closed = nodes.where("NOT open")
    waiting = opened.unionByName(closed.where("parent IS NULL").select(*opened.columns))
    parents = opened.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent"),
    )
    upper = waiting.where("depth > 0").join(parents, ["depth", "p1", "p2"])
    root = opened.where("depth = 0").withColumn("parent", F.lit(None).cast("long"))
    known = closed.where("parent IS NOT NULL").select(*root.columns)
    return upper.unionByName(root).unionByName(known).select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.col("ends").alias("ends_sha256"),
    )


def _paths(segments: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """``conv_id``, ``depth``, ``k1``, ``k2`` of every node on the paths of ``chosen``."""

    def along(name: str, start: str) -> Column:
        """The node before a segment and the one after each of its turns."""
        return F.aggregate(
            F.col(name),
            F.array(F.col(start)),
            lambda seen, v: F.concat(seen, F.array(F.element_at(seen, -1).bitwiseXOR(v))),
        )

    rows = segments.join(chosen, "conv_id", "left_semi")
    both = F.arrays_zip(along("v1", "p1").alias("k1"), along("v2", "p2").alias("k2"))
    steps = rows.select("conv_id", "band", F.posexplode(both).alias("step", "node"))
    # the node that a later segment hangs from is on the path of the one before
    steps = steps.where((F.col("step") > 0) | (F.col("band") == 0))
    return steps.select(
        "conv_id",
        (F.col("band") * width + F.col("step")).alias("depth"),
        F.col("node.k1").alias("k1"),
        F.col("node.k2").alias("k2"),
    )
