"""Best-fit packing in a tree: nearly full sequences leave at once, the others go up as items.

A document's ids, closed by an end token, are one piece, or pieces of CAPACITY and a rest if there
are more.  Every partition of documents packs its own pieces, longest first, each into the sequence
that it fills best.  Sequences with less than ``NEAR`` places left are done.  The others are items of
their own: each round brings those of ``FAN`` groups together and packs them best fit again, as wholes,
until one group is left.  Only names, sizes and members of unfinished sequences travel.

Bounds: a group holds ``PIECES`` pieces (a partition with more has several groups), and hands at most
``CARRY`` sequences up, those with the most room; further ones are done as they are, which costs some
padding and loses nothing.  So no round brings more than FAN * CARRY items to a task.

Null and empty texts are one end token.  Repeated rows are packed once each; a null doc_id is kept as
it is.  Other columns are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import keep
from firmament.llm.wordbpe import default_path, word_encoder

CAPACITY = 2048
END = 0
NEAR = 1  # a sequence with fewer places left is done
FAN = 8
CARRY = 50_000
PIECES = 1_000_000
GROUPS = 1 << 20  # groups of one partition at most
ROWS = 4096

PIECE = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
         "bin": pa.int64(), "place": pa.int64(), "node": pa.int64(), "size": pa.int64()}
PIECE_SCHEMA = ", ".join(f"{n} {'int' if k == pa.int32() else 'bigint'}" for n, k in PIECE.items())
BIN_SCHEMA = "node bigint, bin bigint, size bigint, done boolean, bins array<bigint>, places array<bigint>"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and place of every item, and how full every sequence is.

    Longest items first, each into the open sequence with the least room that holds it.  Open
    sequences are listed by room, and one bit per room says whether that list holds any.
    """
    order = np.argsort(-sizes, kind="stable")
    ordered = sizes[order].tolist()
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits, filled = 0, []
    own, place = [], []
    for size in ordered:
        fits = bits >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            found = waiting[room].pop()
            if not waiting[room]:
                bits ^= 1 << room
        else:
            room, found = capacity, len(filled)
            filled.append(0)
        own.append(found)
        place.append(filled[found])
        filled[found] += size
        left = room - size
        if left:
            waiting[left].append(found)
            bits |= 1 << left
    sequence, offset = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    sequence[order], offset[order] = own, place
    return sequence, offset, np.array(filled, np.int64)


def unfinished(filled: np.ndarray, capacity: int, near: int, carry: int) -> np.ndarray:
    """Which sequences go up: those with room, at most ``carry``, the emptiest first."""
    up = filled <= capacity - near
    if up.sum() > carry:
        chosen = np.argsort(filled, kind="stable")[:carry]
        up = np.zeros(len(filled), bool)
        up[chosen] = True
    return up


def local_pieces(docs: DataFrame, doc_id: str, text: str, vocabulary: str | None, capacity: int, near: int, carry: int, most: int) -> DataFrame:
    """Every piece with its sequence in the partition; ``node`` is null where that is done."""

    def run(batches):
        encoder = word_encoder(vocabulary or default_path("word_bpe_49k.json"))
        end = END.to_bytes(4, "little")
        base = TaskContext.get().partitionId() * GROUPS
        groups, held = 0, []

        def packed():
            columns = [np.array(c) if k else c for k, c in enumerate(zip(*held, strict=True))]
            sequence, offset, filled = best_fit(columns[3], capacity)
            up = unfinished(filled, capacity, near, carry)[sequence]
            node = base + groups
            name = (node << 22) + sequence  # a group has fewer than 4 million sequences
            arrays = [pa.array(c, t) for c, t in zip(columns, PIECE.values(), strict=False)]
            arrays += [pa.array(name), pa.array(offset), pa.array(np.full(len(name), node), mask=~up), pa.array(filled[sequence])]
            whole = pa.RecordBatch.from_arrays(arrays, names=list(PIECE))
            for k in range(0, whole.num_rows, ROWS):
                yield whole.slice(k, ROWS)

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = encoder.encode(body or "") + end
                total = len(data) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    own = data[4 * start : 4 * (start + capacity)]
                    held.append((doc, piece, start, len(own) // 4, zlib.crc32(own)))
            if len(held) >= most:
                yield from packed()
                groups, held = groups + 1, []
        if held:
            yield from packed()

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECE_SCHEMA)


def merge_round(items: DataFrame, capacity: int, near: int, carry: int, final: bool) -> DataFrame:
    """Best fit over the items of every node: sequences of items, done or to go up."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("bin", "ascending")])
        sizes = np.asarray(table["size"].combine_chunks())
        names = np.asarray(table["bin"].combine_chunks())
        bins, places = table["bins"].to_pylist(), table["places"].to_pylist()
        sequence, offset, filled = best_fit(sizes, capacity)
        up = np.zeros(len(filled), bool) if final else unfinished(filled, capacity, near, carry)
        members: list[list[int]] = [[] for _ in filled]
        where: list[list[int]] = [[] for _ in filled]
        first = np.full(len(filled), -1, np.int64)
        for k, (s, at) in enumerate(zip(sequence.tolist(), offset.tolist(), strict=True)):
            members[s] += bins[k]
            where[s] += [at + p for p in places[k]]
            if at == 0:
                first[s] = names[k]  # a sequence goes on under the name of its first item
        node = table["node"][0].as_py()
        return pa.table({
            "node": pa.array(np.full(len(filled), node)), "bin": pa.array(first), "size": pa.array(filled), "done": pa.array(~up),
            "bins": pa.array(members, pa.list_(pa.int64())), "places": pa.array(where, pa.list_(pa.int64())),
        })

    return items.groupBy("node").applyInArrow(merge, BIN_SCHEMA)


def pack_tree(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY,
              near: int = NEAR, fan: int = FAN, carry: int = CARRY, most: int = PIECES) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    local = keep(local_pieces(docs, doc_id, text, vocabulary, capacity, near, carry, most), "residual-pieces")
    # A sequence has one first piece, so no grouping is needed to name it once.
    items = local.filter(F.col("node").isNotNull() & (F.col("place") == 0)).select(
        "node", "bin", "size", F.array("bin").alias("bins"), F.array(F.lit(0).cast("bigint")).alias("places"))
    numbers = items.select("node").distinct().orderBy("node")
    known = {r["node"]: k for k, r in enumerate(numbers.collect())}  # a number per group of pieces
    spark = docs.sparkSession
    if len(known) < 2:
        rounds = []
    else:
        dense = spark.createDataFrame(list(known.items()), "node bigint, nth bigint")
        items = items.join(F.broadcast(dense), "node").select(F.col("nth").alias("node"), "bin", "size", "bins", "places")
        rounds, nodes = [], len(known)
        while nodes > 1:
            nodes = -(-nodes // fan)
            merged = keep(merge_round(items.withColumn("node", F.floor(F.col("node") / fan).cast("bigint")), capacity, near, carry, nodes == 1), "residual-round")
            rounds.append(merged.filter("done"))
            items = merged.filter(~F.col("done")).select("node", "bin", "size", "bins", "places")
    out = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if not rounds:
        return local.select(*out, F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
    moved = rounds[0]
    for more in rounds[1:]:
        moved = moved.unionByName(more)
    member = F.explode(F.arrays_zip("bins", "places")).alias("member")
    moved = moved.select(F.col("bin").alias("sequence_id"), member).select(
        "sequence_id", F.col("member.bins").alias("bin"), F.col("member.places").alias("shift"))
    done = local.filter(F.col("node").isNull()).select(*out, F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
    rest = local.filter(F.col("node").isNotNull()).join(moved, "bin")
    return done.unionByName(rest.select(*out, "sequence_id", (F.col("shift") + F.col("place")).alias("offset")))
