"""Approximate nearest neighbours by cosine: inverted lists and an adaptive dimension scan.

Unit vectors are rotated by a random orthogonal matrix and fall into lists by their nearest
centroid; centroids are fitted to a bounded sample, every row is indexed.  A query probes its
nearest lists, as many as a trial on the sample needs for ``TARGET`` of its true neighbours, and
goes on until they hold k vectors besides itself or no list is left.  In a list the rotated vectors are read in blocks of columns.  After each block the squared distance
so far, scaled up to all columns, is an estimate of the whole, and a hypothesis test drops
candidates that are farther than the query's k-th best with near certainty.  Survivors get the
exact cosine of the original vectors in double precision, each first scaled by a power of two, which
changes no digit and keeps tiny and huge components in range.

Lists of any size are dealt in blocks of ``LIST_ROWS`` vectors and ``QUERY_ROWS`` queries.  Null,
zero and empty vectors and vectors with null or non-finite components take no part, nor do
rows without an id; a shorter vector has zeros at its end; of rows that repeat an id the smallest
vector counts.  Ties go to the smaller id.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmament.llm.common import keep
from firmament.llm.vectors import EVERY, TopLists, matrix, usable

K = 5
SAMPLE = 20_000  # vectors that centroids and the number of probes are fitted to
LISTS = 1_024  # at most
TRIALS = 256  # sampled queries of the trial
TARGET = 0.985  # share of true neighbours in the probed lists of the trial
ROUNDS = 12
LIST_ROWS, QUERY_ROWS = 8_192, 4_096
COLUMNS = 16  # of a block
DOUBT = 2.1  # width of the test: larger keeps more candidates
CHUNK = 1_024


def rotation(width: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(29).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means of unit vectors; distinct rows start it, empty lists keep their centre."""
    distinct = np.unique(sample, axis=0)
    rng = np.random.default_rng(31)
    centre = distinct[rng.permutation(len(distinct))[: min(lists, len(distinct))]]
    for _ in range(ROUNDS):
        own = (sample @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, sample)
        size = np.sqrt((total * total).sum(axis=1))
        centre = np.where(size[:, None] > 1e-12, total / np.maximum(size, 1e-12)[:, None], centre)
    return centre


def probes(sample: np.ndarray, centre: np.ndarray, k: int) -> int:
    """Lists that a query has to probe for ``TARGET`` of its neighbours within the sample."""
    chosen = np.arange(0, len(sample), max(1, len(sample) // TRIALS))[:TRIALS]
    trial = sample[chosen]
    near = sample @ trial.T
    near[chosen, np.arange(len(chosen))] = -np.inf  # a row is no neighbour of its own
    own = (sample @ centre.T).argmax(axis=1)
    place = np.argsort(np.argsort(-(trial @ centre.T), axis=1), axis=1)
    ranks = []
    for i in range(len(trial)):
        best = np.argsort(-near[:, i], kind="stable")[: min(k, len(sample) - 1)]
        ranks.append(place[i, own[best]])
    ranks = np.sort(np.concatenate(ranks)) if ranks else np.zeros(1, int)
    if not len(ranks):
        return len(centre)
    return min(len(centre), 2 + int(ranks[min(len(ranks) - 1, int(np.ceil(TARGET * len(ranks))))]))


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to 1/2 to 1: exact, and squares stay in range."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two scaled matrices, every row summed in the same order."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _unit(v: np.ndarray) -> np.ndarray:
    scale = np.abs(v).max(axis=1, keepdims=True)
    v = v / scale
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def scan(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, turn: np.ndarray, k: int) -> tuple[TopLists, int]:
    """The k nearest vectors of every query in one list, and the column blocks that pairs were read for."""
    turned, q_turned = _unit(vectors) @ turn, _unit(queries) @ turn
    vectors, queries = scaled(vectors), scaled(queries)
    width = vectors.shape[1]
    lists, read = TopLists(len(queries), k), 0
    for first in range(0, len(vectors), CHUNK):
        part = turned[first : first + CHUNK]
        worst = np.maximum(2 - 2 * lists.worst, 0) + 1e-9  # squared distance of the k-th best
        distance = np.zeros((len(queries), len(part)))
        alive = query_ids[:, None] != ids[first : first + CHUNK][None, :]
        a, b = np.nonzero(alive)
        for done in range(0, width, COLUMNS):
            block = slice(done, min(done + COLUMNS, width))
            seen = block.stop
            if len(a) > alive.size // 8:  # most pairs are open: all of them at once
                q, v = q_turned[:, block], part[:, block]
                distance += (q * q).sum(axis=1)[:, None] + (v * v).sum(axis=1)[None, :] - 2 * (q @ v.T)
                here = distance[a, b]
            else:
                here = distance[a, b] + ((q_turned[a, block] - part[b, block]) ** 2).sum(axis=1)
                distance[a, b] = here
            read += len(a)
            limit = worst[a] * (1.0 if seen == width else (1 + DOUBT / np.sqrt(seen)) ** 2)
            stays = here * (width / seen) <= limit + 1e-9
            a, b = a[stays], b[stays]
            if not len(a):
                break
        for at in range(0, len(a), 1 << 16):
            qa, vb = a[at : at + (1 << 16)], b[at : at + (1 << 16)] + first
            value = cosine(queries[qa], vectors[vb])
            good = value >= lists.worst[qa]
            lists.add(qa[good], value[good], ids[vb[good]])
    return lists, read


def search(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the ids that ``every`` divides, against all others."""
    spark = table.sparkSession
    rows = keep(usable(table, vec_id, vector).filter(F.exists("v", lambda x: x != 0)), "ann-vectors")
    counted = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("w")).head()
    if not counted["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    width = counted["w"]
    sample = _unit(matrix(rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow().column(0), width))
    centre = centroids(sample, int(min(LISTS, max(1, round(counted["n"] ** 0.5)))))
    probed = probes(sample, centre, k)
    shared = spark.sparkContext.broadcast((rotation(width), centre))  # at most (width + LISTS) x width numbers

    def listed(count: int, held: np.ndarray | None = None):
        """The ``count`` nearest lists, and further ones until they hold k + 1 vectors."""
        def run(batches):
            middle = shared.value[1]
            for batch in batches:
                ids = np.asarray(batch.column(0))
                near = -(_unit(matrix(batch.column(1), width)) @ middle.T)
                if held is None:
                    lists = [[int(x)] for x in near.argmin(axis=1)]
                else:
                    order = np.argsort(near, axis=1, kind="stable")
                    enough = (np.cumsum(held[order], axis=1) < k + 1).sum(axis=1) + 1
                    lists = [own[: max(count, n)].tolist() for own, n in zip(order, enough.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], names=["vec_id", "v", "lists"])

        return run

    schema = "vec_id bigint, v array<double>, lists array<int>"
    indexed = keep(rows.mapInArrow(listed(1), schema).select("vec_id", "v", F.col("lists")[0].alias("list")), "ann-lists")
    held = np.zeros(len(centre), np.int64)
    for row in indexed.groupBy("list").count().collect():  # a row per list
        held[row["list"]] = row["count"]
    asked = rows.filter(F.col("vec_id") % every == 0).mapInArrow(listed(probed, held), schema).select(
        "vec_id", "v", F.explode("lists").alias("list")
    )
    asked = keep(asked, "ann-probes")
    sizes = indexed.groupBy("list").agg(F.ceil(F.count("*") / LIST_ROWS).cast("int").alias("rows"))
    loads = asked.groupBy("list").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("loads"))
    shape = keep(sizes.join(loads, "list"), "ann-shape")  # a row per list
    spread = F.pmod(F.xxhash64("vec_id"), F.col("rows")).cast("int")
    dealt = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("loads")).cast("int")
    left = indexed.join(F.broadcast(shape), "list").select(
        "list", spread.alias("x"), F.explode(F.sequence(F.lit(0), F.col("loads") - 1)).alias("y"), "vec_id", "v"
    )
    right = asked.join(F.broadcast(shape), "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("x"), dealt.alias("y"), "vec_id", "v"
    )

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        lists = TopLists(0, k)
        query_ids = b.column("vec_id").to_numpy() if b.num_rows else np.empty(0, np.int64)
        if a.num_rows and b.num_rows:
            order = np.argsort(a.column("vec_id").to_numpy(), kind="stable")
            lists, _ = scan(matrix(b.column("v"), width), query_ids, matrix(a.column("v"), width)[order],
                            a.column("vec_id").to_numpy()[order], shared.value[0], k)
        return pa.table({"query_id": query_ids[lists.query], "vec_id": lists.vec, "score": lists.score})

    keys = ["list", "x", "y"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
