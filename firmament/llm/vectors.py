"""Vector columns as matrices, and top lists of scored pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import unpack

EVERY = 50  # rows whose id it divides are the queries


def usable(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, v``: one row per id, vectors as doubles, without nulls and non-finite components.

    Of rows that repeat an id the smallest vector counts; rows without an id take no part.
    """
    value = F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = table.select(F.col(vec_id).cast("bigint").alias("vec_id"), value.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.coalesce((F.size("v") > 0) & finite, F.lit(False))
    )
    return good.groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(array: pa.Array, width: int) -> np.ndarray:
    """Rows of a list-of-doubles column, zeros beyond the end of shorter ones."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    out = np.zeros((len(array), width))
    if not len(array):
        return out
    offsets = np.asarray(array.offsets).astype(np.int64)
    values = np.asarray(array.values)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    if (size == width).all():
        return values.reshape(len(array), width).astype(np.float64)
    row = np.repeat(np.arange(len(array)), size)
    out[row, np.arange(len(values)) - offsets[row]] = values
    return out


def doubles(column: pa.Array, width: int) -> np.ndarray:
    """Rows of packed doubles."""
    data, _ = unpack(column)
    return np.frombuffer(data.tobytes(), np.float64).reshape(-1, width)


class TopLists:
    """The ``k`` best candidates of every query: highest score, then smallest id.

    Scores keep their type, so whole numbers are compared and returned as such.
    """

    def __init__(self, queries: int, k: int, kind: type = np.float64):
        self.k = k
        self.query = np.empty(0, np.int64)
        self.score = np.empty(0, kind)
        self.vec = np.empty(0, np.int64)
        self.least = -np.inf if self.score.dtype.kind == "f" else np.iinfo(kind).min
        self.worst = np.full(queries, self.least, kind)  # score of the k-th, the least there is while there are fewer
        self.full = np.zeros(queries, bool)

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        if not len(query):
            return
        self.query = np.concatenate([self.query, query])
        self.score = np.concatenate([self.score, score])
        self.vec = np.concatenate([self.vec, vec])
        down = -self.score if self.score.dtype.kind == "f" else ~self.score  # ~ has no overflow
        order = np.lexsort((self.vec, down, self.query))
        q = self.query[order]
        first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        order, nth = order[nth < self.k], nth[nth < self.k]
        self.query, self.score, self.vec = self.query[order], self.score[order], self.vec[order]
        full = nth == self.k - 1
        self.worst[self.query[full]] = self.score[full]
        self.full[self.query[full]] = True
