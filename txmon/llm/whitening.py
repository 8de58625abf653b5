"""Embedding whitening with MLlib's BlockMatrix.

Centred rows are indexed into a distributed matrix of blocks; the transpose times the matrix is the
scatter of the vectors, a small matrix whose eigenvectors are found on the driver; a last block product
with the whitening matrix projects every row.  Entries are whole numbers, so counts, sums and deviations
are exact, and a row is centred as ``(n * x - S) / n``: the difference is taken before any rounding.

Only matrices of dimension x dimension are on the driver, their size is checked; rows stay in blocks.
The products split their inner dimension, so the scatter is summed by many tasks, not by one.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import read, staged

COMPONENTS = 16
SCALE, SHIFT = 64.0, 1_000_000
#: Rows and columns of a block (8 MB at most), and how many row blocks one task multiplies.
ROWS, COLS, BLOCKS_A_TASK = 1024, 1024, 4
#: A matrix of so many rows and columns (128 MB) may be on the driver.
MAX_DIM = 4096
_BOUND = 1 << 60  # entries beyond are taken as this


def lattice(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array<bigint>): the rows that take part, entries as floor(64 * c) + 1,000,000.

    Null and empty vectors and those with null or non-finite entries take no part, nor do vectors that
    differ in length from the commonest length (the smaller of equals).
    """
    ok = vectors.where("embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, "
                       "c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))").select("vec_id", "embedding")
    dims = ok.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    whole = lambda c: F.greatest(F.least(F.floor(c.cast("double") * SCALE), F.lit(_BOUND)), F.lit(-_BOUND))
    return ok.where(F.size("embedding") == (dims[0]["d"] if dims else 0)).select(
        "vec_id", F.transform("embedding", lambda c: whole(c) + F.lit(SHIFT)).alias("x"))


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` with a gapless number ``at`` from 0, and how many rows there are.

    Numbers are written with the rows, so a recomputed task cannot deal them anew; of each partition
    only its first number is on the driver.
    """
    rows = staged(df.withColumn("_m", F.monotonically_increasing_id()), name)
    part = F.shiftright("_m", 33).cast("int")
    counts = sorted((r["p"], r["count"]) for r in rows.groupBy(part.alias("p")).count().collect())  # a row a partition
    starts, n = [], 0
    for p, count in counts:
        starts.append((p, n))
        n += count
    table = df.sparkSession.createDataFrame(starts, "_p int, _start bigint")
    return rows.join(F.broadcast(table), part == F.col("_p")).withColumn(
        "at", F.col("_start") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m", "_p", "_start"), n


class Moments:
    """n, the sums and the extremes of every dimension, as exact whole numbers."""

    def __init__(self, fit: DataFrame, n: int):
        each = fit.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(
            F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.min("v").alias("low"), F.max("v").alias("high"))
        rows = sorted(each.collect(), key=lambda r: r["d"])  # a row a dimension
        self.n, self.sums = n, [int(r["s"]) for r in rows]
        far = [max(abs(n * r["low"] - s), abs(n * r["high"] - s)) for r, s in zip(rows, self.sums, strict=True)]
        size = [max(abs(n * r["low"]), abs(n * r["high"]), abs(s)) for r, s in zip(rows, self.sums, strict=True)]
        self.exact_in_long = max(size, default=0) < 1 << 62
        self.squares_in_long = self.exact_in_long and sum(f * f for f in far) < 1 << 63

    def apart(self, x: str = "x") -> Column:
        """n * x - S by dimension."""
        kind = "bigint" if self.exact_in_long else "decimal(38,0)"
        sums = F.array(*[F.lit(str(s)).cast(kind) for s in self.sums])
        return F.zip_with(x, sums, lambda v, s: v.cast("bigint" if self.exact_in_long else "decimal(19,0)")
                          * F.lit(str(self.n)).cast("bigint" if self.exact_in_long else "decimal(18,0)") - s)

    def deviation(self, apart: str) -> Column:
        """The sum of squares as a long; null where it doesn't fit into one."""
        kind = "bigint" if self.squares_in_long else "decimal(38,0)"
        square = lambda a, v: (a + v.cast(kind) * v.cast(kind)).cast(kind)
        return F.aggregate(apart, F.lit(0).cast(kind), square).try_cast("bigint")


def block_matrix(df: DataFrame, column: str, n: int, dim: int) -> BlockMatrix:
    """The rows (at, ``column``: array<double>) as blocks; stays inside the JVM."""
    rows = df.select("at", array_to_vector(F.col(column)).alias("v"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v"), n, dim).toBlockMatrix(ROWS, COLS)


def scatter(m: BlockMatrix) -> np.ndarray:
    """The transpose of ``m`` times ``m``, its inner dimension dealt over many tasks."""
    splits = max(1, -(-m.numRows() // (ROWS * BLOCKS_A_TASK)))
    model = lambda x: x._java_matrix_wrapper._java_model  # noqa: E731  the product with splits has no Python form
    product = BlockMatrix(model(m.transpose()).multiply(model(m), int(splits)), m.colsPerBlock, m.colsPerBlock)
    return product.toLocalMatrix().toArray()


def projected(m: BlockMatrix, w: np.ndarray, spark: SparkSession) -> BlockMatrix:
    """``m`` times the whitening matrix ``w``."""
    blocks = [((i, 0), Matrices.dense(*part.shape, part.ravel("F").tolist()))
              for i, part in enumerate(w[s:s + m.colsPerBlock] for s in range(0, len(w), m.colsPerBlock))]
    right = BlockMatrix(spark.sparkContext.parallelize(blocks, len(blocks)), m.colsPerBlock, w.shape[1], *w.shape)
    return m.multiply(right)


def rows_of(m: BlockMatrix) -> DataFrame:
    """at, y (array<double>) of a matrix one block wide, read off its blocks (the row matrix of MLlib
    would number rows in 32 bits)."""
    blocks = callMLlibFunc("getMatrixBlocks", m._java_matrix_wrapper._java_model).select(
        F.col("_1._1").cast("bigint").alias("i"), F.unwrap_udt("_2").alias("m"))
    width = m.numCols()
    value = lambda p, j: F.get("m.values", F.when(F.col("m.isTransposed"), p * width + j).otherwise(
        j * F.col("m.numRows") + p))
    rows = F.transform(F.sequence(F.lit(0), F.col("m.numRows") - 1), lambda p: F.struct(
        (F.col("i") * m.rowsPerBlock + p).alias("at"),
        F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: value(p, j)).alias("y")))
    return blocks.select(F.explode(rows).alias("r")).select("r.*")


RESULT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """RESULT for every row that takes part (see ``lattice``) and every component.

    The fit uses each different vector once; repeated rows and rows with a null vec_id are projected
    like all others.  Components without variance (an eigenvalue within rounding of zero) have no
    whitened value and are left out, so a single different vector, or an empty table, gives an empty
    result.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    all_rows, n_rows = numbered(lattice(vectors), "whiten_rows")
    fit, n = numbered(all_rows.select("x").distinct(), "whiten_fit")
    nothing = spark.createDataFrame([], RESULT)
    if not n:
        return nothing
    m = Moments(fit, n)
    dim = len(m.sums)
    if dim > MAX_DIM:
        raise ValueError(f"{dim} dimensions; the scatter matrix on the driver may have {MAX_DIM}")
    centred = lambda df: df.withColumn("apart", m.apart()).withColumn(
        "c", F.transform("apart", lambda v: v.cast("double") / F.lit(float(n))))
    fit_matrix = block_matrix(centred(fit), "c", n, dim)
    v = scatter(fit_matrix) / n
    e, vectors_ = np.linalg.eigh((v + v.T) / 2)
    e, vectors_ = e[::-1], vectors_[:, ::-1]
    some = int((e[:components] > max(e[0], 0) * dim * np.finfo(float).eps).sum())
    if not some:
        return nothing
    signs = np.sign(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(dim)])
    w = (vectors_ * signs)[:, :some] / np.sqrt(e[:some])

    # the whitened fit list has mean 0: its centred rows sum to n * S - S * n
    identity = scatter(projected(fit_matrix, w, spark)) / n
    error = float(np.abs(identity - np.eye(some)).max())
    rows = centred(all_rows)
    y = staged(rows_of(projected(block_matrix(rows, "c", n_rows, dim), w, spark)), "whitened")
    explained = F.array(*[F.lit(float(x)) for x in e[:some] / np.trace(v)])
    return rows.select("at", "vec_id", m.deviation("apart").alias("deviation")).join(y, "at").select(
        "vec_id", "deviation", F.posexplode("y").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, "k").alias("explained"), F.lit(error).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on up to 16 components; edge rows as in ``whiten``."""
    return whiten(read(spark, sf_dir, "embeddings"))
