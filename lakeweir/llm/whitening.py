"""Embedding whitening with distributed block matrices.

Entries become whole numbers x = floor(scale * entry). Each distinct x-vector counts once for the
fit. Its centred rows get dense numbers and become a BlockMatrix; the transpose times the matrix is
the scatter, summed block by block over many tasks. The scatter is as large as the dimension is
wide, so its eigenvectors are found locally; divided by the roots of their eigenvalues they are the
whitening matrix, and the BlockMatrix of all centred rows times that matrix projects the rows.
Rows stay in the JVM all the way: vectors are made and taken apart by column functions.

Rows whose vector is null or holds null, NaN or infinite entries are dropped, and so are rows whose
vector has another length than the most frequent one (the longer of two as frequent).
Repeated vectors are projected each. A component whose eigenvalue is no more than rounding error
has a null ``whitened``; a dimension under ``components`` has as many rows as it has entries. An
empty table gives an empty one. Columns but key and vector are not carried.

The multiplication keeps the list of block numbers on the driver: one number for each
``BLOCK_BYTES`` of centred rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeweir.sources.scratch import written

SCALE = 256
COMPONENTS = 4
BLOCK_BYTES = 1 << 20
BLOCKS_A_TASK = 8
_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


@dataclass(frozen=True)
class Whitener:
    """What the fit found; arrays of the dimension, numbers in the order of falling variance."""

    n: int
    sums: tuple[int, ...]
    vectors: tuple[tuple[float, ...], ...]  # a column of the whitening matrix per component
    explained: tuple[float, ...]
    sound: tuple[bool, ...]
    identity_error: float


def whole_entries(vector: Column, scale: int = SCALE) -> Column:
    """The entries as whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite."""

    def broken(c: Column) -> Column:
        wide = c.cast("double")
        return c.isNull() | F.isnan(wide) | (F.abs(wide) == float("inf"))

    return vector.isNotNull() & ~F.exists(F.coalesce(vector, F.array()), broken)


def numbered(rows: DataFrame, name: str, index: str = "index") -> DataFrame:
    """``rows`` written, with the dense number of each from 0 on."""
    stored = written(rows.withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", _POSITION_BITS).alias("__part")
    sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    starts = sizes.select("__part", before.alias("__before"))
    place = F.col("__at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # as many rows as the table was written by tasks
    return (
        stored.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .withColumn(index, F.col("__before") + place)
        .drop("__at", "__part", "__before")
    )


def block_matrix(rows: DataFrame, n: int, width: int, block_bytes: int = BLOCK_BYTES):
    """A BlockMatrix of ``rows``: ``index`` and ``values``, an array of ``width`` doubles."""
    vectors = rows.select("index", array_to_vector("values").alias("vector"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    matrix = IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", vectors, n, width))
    return matrix.toBlockMatrix(max(1, block_bytes // (8 * width)), width)


def product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """``left`` times ``right``; the sum over the inner dimension is cut into ``splits`` tasks."""
    wrapped = left._java_matrix_wrapper.call(
        "multiply", right._java_matrix_wrapper._java_model, splits
    )
    return BlockMatrix(wrapped, left.rowsPerBlock, right.colsPerBlock)


def scatter(matrix: BlockMatrix):
    """Transpose times matrix as a local array."""
    splits = -(-matrix.numRowBlocks // BLOCKS_A_TASK)
    return product(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()


def _local(spark, array) -> BlockMatrix:
    """A small local array as a BlockMatrix of one block."""
    rows, columns = array.shape
    dense = Matrices.dense(rows, columns, array.T.ravel().tolist())
    return BlockMatrix(spark.sparkContext.parallelize([((0, 0), dense)], 1), rows, columns)


def _centred(sums: tuple[int, ...], n: int) -> Column:
    means = F.array(*(F.lit(s / n) for s in sums))
    return F.zip_with("x", means, lambda entry, mean: entry - mean)


def fit(rows: DataFrame, components: int | None = COMPONENTS) -> Whitener | None:
    """Fit on the distinct arrays ``x`` of ``rows``, all of one length; None without any."""
    import numpy as np

    spark = rows.sparkSession
    # equal vectors meet after each task has made them one
    distinct = numbered(rows.select("x").distinct(), "distinct-vectors")
    width = distinct.select(F.size("x")).first()
    if width is None or not width[0]:
        return None
    width = width[0]
    totals = distinct.agg(
        F.count(F.lit(1)), F.array(*(F.sum(F.get("x", F.lit(i))) for i in range(width)))
    ).first()
    n, sums = totals[0], tuple(totals[1])
    matrix = block_matrix(
        distinct.select("index", _centred(sums, n).alias("values")), n, width
    )
    values, vectors = np.linalg.eigh(scatter(matrix) / n)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    kept = min(width, components or width)
    sound = values[:kept] > max(values[0], 0.0) * width * np.finfo(float).eps
    roots = np.sqrt(np.where(sound, values[:kept], 1.0))
    # either sign is right; the largest entry is made positive, so that a second fit agrees
    largest = np.take_along_axis(
        vectors[:, :kept], np.abs(vectors[:, :kept]).argmax(axis=0)[None, :], axis=0
    )
    whitening = vectors[:, :kept] * np.sign(largest) / roots
    total = values.sum()
    whitened = product(matrix, _local(spark, whitening))
    covariance = scatter(whitened) / n
    error = np.abs(covariance - np.eye(kept))[np.ix_(sound, sound)]
    return Whitener(
        n,
        sums,
        tuple(map(tuple, whitening.T.tolist())),
        tuple((values[:kept] / total if total > 0 else np.zeros(kept)).tolist()),
        tuple(sound.tolist()),
        float(error.max()) if error.size else 0.0,
    )


def deviation(x: Column, whitener: Whitener) -> Column:
    """Sum over the dimensions of (n * x - S) squared, exact; null beyond a long."""
    sums = F.array(*(F.lit(s) for s in whitener.sums))
    wide = "decimal(38,0)"

    def total(values: Column) -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate(values, zero, lambda a, b: F.try_add(a, b)).cast(wide)

    squares = total(F.transform(x, lambda a: F.try_multiply(a, a)))
    mixed = total(F.zip_with(x, sums, lambda a, s: F.try_multiply(a, s)))
    n = F.lit(whitener.n).cast(wide)
    fixed = F.lit(sum(s * s for s in whitener.sums)).cast(wide)
    whole = F.try_subtract(
        F.try_add(F.try_multiply(F.try_multiply(n, n).cast(wide), squares).cast(wide), fixed),
        F.try_multiply(F.lit(2).cast(wide), F.try_multiply(n, mixed).cast(wide)).cast(wide),
    )
    return whole.try_cast("long")


def whiten(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int | None = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """Per remaining row: ``key``, ``n``, ``deviation``, ``whitened`` and ``explained`` (arrays, one
    entry per component) and ``identity_error``."""
    own = F.col(vector)
    rows = written(
        table.where(finite(own)).select(
            F.col(key).alias(key), whole_entries(own, scale).alias("x")
        ),
        "whole-vectors",
    )
    # a row per length
    lengths = rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    schema = rows.select(
        F.col(key),
        F.lit(0).cast("long").alias("n"),
        F.lit(0).cast("long").alias("deviation"),
        F.array().cast("array<double>").alias("whitened"),
        F.array().cast("array<double>").alias("explained"),
        F.lit(0.0).alias("identity_error"),
    )
    if usual is None or not usual["width"]:
        return schema.limit(0)
    rows = rows.where(F.size("x") == usual["width"])
    whitener = fit(rows, components)
    placed = written(numbered(rows, "numbered-vectors"), "placed-vectors")
    n_rows = placed.count()
    matrix = block_matrix(
        placed.select("index", _centred(whitener.sums, whitener.n).alias("values")),
        n_rows,
        usual["width"],
    )
    import numpy as np

    projected = product(matrix, _local(table.sparkSession, np.array(whitener.vectors).T))
    indexed = callMLlibFunc(
        "getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model
    )
    found = indexed.toDF("index", "vector").select(
        "index", vector_to_array("vector").alias("found")
    )
    sound = F.array(*map(F.lit, whitener.sound))
    measured = placed.select(key, "index", deviation(F.col("x"), whitener).alias("deviation"))
    # a merge join at every size: both sides grow with the rows
    return measured.join(found.hint("merge"), "index").select(
        key,
        F.lit(whitener.n).cast("long").alias("n"),
        "deviation",
        F.zip_with("found", sound, lambda value, good: F.when(good, value)).alias("whitened"),
        F.array(*map(F.lit, whitener.explained)).alias("explained"),
        F.lit(whitener.identity_error).alias("identity_error"),
    )
