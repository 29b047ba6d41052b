"""Exact top-k search by inner product: norm-sorted vectors, rotated partial sums, Cauchy-Schwarz bounds.

Components become floor(256 x).  An orthogonal rotation (right singular vectors of a bounded
sample) moves most of a vector's length into its first coordinates.  Vectors lie in ranges by
descending length; a query's k best among the ``HEAD`` longest vectors give it a first threshold,
and it visits only ranges whose greatest length can still reach that.  In a range the longest
vectors come first: partial inner products over a few rotated coordinates plus the product of
the residual lengths bound the rest, and pairs whose bound is below the threshold are dropped.
The survivors are scored exactly in integers, so rotation and rounding never decide a result: bounds
allow for the rounding of doubles, and what is not a number is never dropped.  A score beyond the range
of a long counts as the nearest end of that range.

Ranges are cut by length and id, so equal vectors of any number spread over them, and queries are
dealt in blocks of ``QUERIES``.  Null vectors and vectors with null or non-finite components, rows
without an id and empty vectors take no part; a shorter vector has zeros at its end; of rows that
repeat an id the smallest vector counts.  Ties go to the smaller id.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmament.llm.common import keep, partitions
from firmament.llm.vectors import EVERY, TopLists, matrix, usable

K = 5
SCALE = 256.0
SAMPLE = 5_000  # vectors that the rotation is fitted to
HEAD = 2_048  # longest vectors, which give first thresholds
QUERIES = 4_096  # queries of a block
CHUNK = 512  # vectors looked at in one step
STEPS = (8, 24)  # rotated coordinates after which bounds are tested
NOTHING = -(2**63)  # threshold of a query that has none
SAFE = 2.0**62  # product of lengths below which 64-bit sums are exact
ROUNDING = 1e-9  # share of a product of lengths that covers the rounding of doubles


def _whole(x: Column) -> Column:
    """The floor as a double, also beyond the range of a long, and within that of a double."""
    largest = F.lit(float(np.finfo(np.float64).max))
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(F.greatest(F.least(x, largest), -largest))


def rotation(sample: np.ndarray) -> np.ndarray:
    """Orthogonal matrix whose first columns carry most of the sample's length."""
    if not len(sample):
        return np.eye(sample.shape[1])
    sample = sample / max(1.0, np.abs(sample).max())
    return np.linalg.svd(sample, full_matrices=True)[2].T if len(sample) >= sample.shape[1] else np.linalg.svd(
        np.vstack([sample, np.zeros((sample.shape[1], sample.shape[1]))]), full_matrices=False)[2].T


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two matrices, cut to the range of a long."""
    with np.errstate(all="ignore"):
        product = (a.astype(np.int64) * b.astype(np.int64)).sum(axis=1)
        bound = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    for k in np.flatnonzero(~(bound < SAFE)):  # sums that may leave 64 bits
        whole = sum(int(x) * int(y) for x, y in zip(a[k], b[k], strict=True))
        product[k] = min(max(whole, NOTHING), -NOTHING - 1)
    return product


def scan(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
         turn: np.ndarray, k: int) -> tuple[TopLists, int]:
    """The k best vectors of every query that reach its ``floor``, and how many pairs were scored exactly."""
    with np.errstate(all="ignore"):
        return _scan(queries, query_ids, floor, vectors, ids, turn, k)


def _scan(queries, query_ids, floor, vectors, ids, turn, k) -> tuple[TopLists, int]:
    order = np.lexsort((ids, -(vectors * vectors).sum(axis=1)))
    vectors, ids = vectors[order], ids[order]
    length = np.sqrt((vectors * vectors).sum(axis=1))
    q_length = np.sqrt((queries * queries).sum(axis=1))
    turned, q_turned = vectors @ turn, queries @ turn
    steps = [s for s in STEPS if s < vectors.shape[1]]
    rest = [np.sqrt(np.maximum((turned[:, s:] ** 2).sum(axis=1), 0)) for s in steps]
    q_rest = [np.sqrt(np.maximum((q_turned[:, s:] ** 2).sum(axis=1), 0)) for s in steps]
    lists, scored = TopLists(len(queries), k, np.int64), 0
    for first in range(0, len(vectors), CHUNK):
        part = slice(first, first + CHUNK)
        worst = np.maximum(lists.worst, floor)
        least = np.where(worst == NOTHING, -np.inf, worst.astype(np.float64))
        least = least - (0.5 + ROUNDING * (q_length * length[first] + np.abs(worst.astype(np.float64))))
        open_queries = np.flatnonzero(~(q_length * length[first] < least))
        if not len(open_queries):
            break
        partial, alive, done = 0.0, None, 0
        for s, r, qr in zip(steps, rest, q_rest, strict=True):
            partial = partial + q_turned[open_queries, done:s] @ turned[part, done:s].T
            reach = partial + qr[open_queries][:, None] * r[part][None, :]
            alive = ~(reach < least[open_queries][:, None])
            done = s
        if alive is None:
            alive = np.ones((len(open_queries), len(ids[part])), bool)
        a, b = np.nonzero(alive & (query_ids[open_queries][:, None] != ids[part][None, :]))
        a, b = open_queries[a], b + first
        for at in range(0, len(a), 1 << 16):
            qa, vb = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            value = scores(queries[qa], vectors[vb])
            good = value >= np.maximum(lists.worst, floor)[qa]
            lists.add(qa[good], value[good], ids[vb[good]])
        scored += len(a)
    return lists, scored


def search(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the ids that ``every`` divides, against all others."""
    spark = table.sparkSession
    parts = partitions(spark)
    result = "query_id bigint, vec_id bigint, score bigint"
    rows = usable(table, vec_id, vector)
    whole = keep(rows.select("vec_id", F.transform("v", lambda x: _whole(x * F.lit(SCALE))).alias("v")), "topk-vectors")
    width = whole.agg(F.max(F.size("v")).alias("w")).head()["w"]
    if width is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    turn = rotation(matrix(sample.column("v"), width))
    lengths = whole.select("vec_id", "v", norm.alias("norm"))
    top = lengths.orderBy(F.desc("norm"), "vec_id").limit(HEAD).toArrow()  # HEAD vectors
    shared = spark.sparkContext.broadcast((turn, matrix(top.column("v"), width), top.column("vec_id").to_numpy()))

    def first_thresholds(batches):
        own, head, head_ids = shared.value
        for batch in batches:
            queries, ids = matrix(batch.column(1), width), np.asarray(batch.column(0))
            lists, _ = scan(queries, ids, np.full(len(ids), NOTHING), head, head_ids, own, k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists.worst)], names=["vec_id", "v", "norm", "floor"])

    asked = keep(
        lengths.filter(F.col("vec_id") % every == 0).mapInArrow(first_thresholds, "vec_id bigint, v array<double>, norm double, floor bigint"),
        "topk-queries",
    )
    blocks = max(1, -(-asked.count() // QUERIES))
    ranged = keep(
        lengths.repartitionByRange(parts, F.desc("norm"), F.col("vec_id")).withColumn("part", F.spark_partition_id()), "topk-ranges"
    )
    ranges = ranged.groupBy(F.col("part").alias("range")).agg(F.max("norm").alias("longest"))  # a row per partition
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    bound = F.col("norm") * F.col("longest") * (1 + ROUNDING) + 1 + ROUNDING * F.abs(F.col("floor").cast("double"))
    visits = asked.join(F.broadcast(ranges), (F.col("floor") == NOTHING) | (bound >= F.col("floor"))).select(
        F.col("range").alias("part"), block.alias("block"), "vec_id", "v", "floor"
    )
    met = keep(visits.select("part", "block").distinct(), "topk-visits")  # a range goes only to blocks with a query that visits it
    copies = ranged.join(met, "part").select("part", "block", "vec_id", "v")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        own = shared.value[0]
        lists = TopLists(0, k, np.int64)
        query_ids = right.column("vec_id").to_numpy() if right.num_rows else np.empty(0, np.int64)
        if left.num_rows and right.num_rows:
            lists, _ = scan(matrix(right.column("v"), width), query_ids, right.column("floor").to_numpy(),
                            matrix(left.column("v"), width), left.column("vec_id").to_numpy(), own, k)
        return pa.table({"query_id": query_ids[lists.query], "vec_id": lists.vec, "score": lists.score})

    found = copies.groupBy("part", "block").cogroup(visits.groupBy("part", "block")).applyInArrow(compare, result)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
