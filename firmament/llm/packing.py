"""Packing documents into token sequences: cutting stock by column generation.

A document's ids, closed by an end token, are cut into full sequences and a rest.  The histogram of
lengths, at most CAPACITY numbers, is all that the driver sees.  Lengths fall into ``CLASSES``
classes.  A linear program over patterns (how many pieces of each class share a
sequence) is solved by column generation: a knapsack over the classes, priced by the duals, finds
the next pattern, and a revised simplex step brings it in, until the number of sequences is
within ``GAP`` of a proven bound.  Patterns are rounded down.  What is left over, less than a sequence per
pattern, and the short pieces are placed best fit by their exact lengths, in the room that patterns
leave and in further sequences.  Pieces are ranked within their length, and the
rank says which copy of which pattern a piece belongs to.

Ranks come from salted parts of a length, as many as its share of all pieces asks for, so that a
length which a third of all documents have is no single group.

Null and empty texts are one end token.  Repeated rows are packed once each; a null doc_id is
kept as it is.  Other columns are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmament.llm.common import keep, partitions
from firmament.llm.wordbpe import default_path, word_encoder

CAPACITY = 2048
CLASSES = 256  # of lengths in the linear program
SMALL = 32  # pieces of a 32nd of a sequence and less fill what room patterns leave
END = 1
GAP = 2e-3
REFRESH = 50  # pivots after which the inverse is made anew
STALL = 2  # pivots without progress by a quarter of the gap, per class, after which column generation ends


@dataclass
class Plan:
    """Patterns with their number of copies: ``items[p]`` is {class: pieces}."""

    items: list[dict[int, int]]
    copies: list[int]


def _knapsack(price: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, dict[int, int]]:
    """Best value of a sequence and its pieces, by dynamic programming over the room."""
    good = np.flatnonzero(price > 1e-12)
    if not len(good):
        return 0.0, {}
    size, value = sizes[good], price[good]
    best, take = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        n = int(np.searchsorted(size, c, side="right"))
        best[c] = best[c - 1]
        if n:
            options = value[:n] + best[c - size[:n]]
            k = int(options.argmax())
            if options[k] > best[c]:
                best[c], take[c] = options[k], k
    out: dict[int, int] = {}
    c = room
    while c > 0:
        if take[c] < 0:
            c -= 1
        else:
            k = int(good[take[c]])
            out[k] = out.get(k, 0) + 1
            c -= int(sizes[k])
    return float(best[room]), out


def _generate(sizes: np.ndarray, need: np.ndarray, room: int, gap: float) -> tuple[list[dict[int, int]], np.ndarray]:
    """Basis of the linear program, and the copies of its patterns, by column generation.

    The duals swing widely, so the knapsack is priced between them and the best duals so far,
    which start as size / room, the duals of sequences without padding; ``bound`` is the number
    of sequences that the best duals prove necessary.  Slight shifts of the demand keep pivots from
    standing still; should they do so for ``STALL`` times the number of classes, the patterns so
    far are taken, which any rounding makes a whole plan of.
    """
    m = len(sizes)
    shifted = need * (1 + 1e-7 * np.random.default_rng(5).random(m))
    columns = [{k: int(room // s)} for k, s in enumerate(sizes)]
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1.0 / (room // sizes))
    level = inverse @ shifted
    centre = sizes / room
    bound = float(centre @ shifted)
    pool, vectors = [], np.empty((0, m))
    pivots, least, idle = 0, np.inf, 0
    while level.sum() > bound * (1 + gap) and idle <= STALL * m:
        if level.sum() < least * (1 - gap / 4):
            least, idle = float(level.sum()), 0
        idle += 1
        duals = inverse.sum(axis=0)
        column = None
        if len(pool):
            worth = vectors @ duals
            k = int(worth.argmax())
            if worth[k] > 1 + 1e-7:
                column, entering = pool[k], vectors[k]
        weight = 0.9
        while column is None:
            price = weight * centre + (1 - weight) * duals
            value, found = _knapsack(price, sizes, room)
            proved = float(np.maximum(price, 0) @ shifted) / max(value, 1e-12)
            if proved > bound:
                bound, centre = proved, np.maximum(price, 0) / value
            entering = np.zeros(m)
            for k, n in found.items():
                entering[k] = n
            if entering @ duals > 1 + 1e-7:
                column = found
                pool.append(found)
                vectors = np.vstack([vectors, entering])
            elif weight == 0:
                return columns, np.linalg.solve(basis, need)
            else:
                weight = max(0.0, weight - 0.3)
        change = inverse @ entering
        ratio = np.where(change > 1e-9, level / np.where(change > 1e-9, change, 1), np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        columns[leave], basis[:, leave] = column, entering
        pivots += 1
        if pivots % REFRESH:
            level = level - ratio[leave] * change
            level[leave] = ratio[leave]
            pivot = inverse[leave] / change[leave]
            moved = np.flatnonzero(np.abs(change) > 1e-12)
            inverse[moved] -= change[moved, None] * pivot
            inverse[leave] = pivot
        else:
            inverse = np.linalg.inv(basis)  # takes out the rounding of the pivots
            level = inverse @ shifted
    return columns, np.linalg.solve(basis, need)


def cutting_stock(counts: dict[int, int], room: int, gap: float = GAP) -> Plan:
    """Patterns for ``counts`` pieces of each length in sequences of ``room`` tokens.

    The linear program is about the pieces that are longer than ``room // SMALL``, in classes of
    ``room // CLASSES`` tokens.  Its patterns get pieces of exact lengths, so what room is really left
    in each is known, and best fit fills that with the pieces left over by rounding and the short ones.
    """
    groups: list[Group] = []
    if counts.get(room):
        groups.append(Group({room: 1}, counts[room], 0))
    grain, small = max(1, room // CLASSES), room // SMALL
    left = {s: n for s, n in counts.items() if n > 0 and s < room}
    runs: dict[int, list[list[int]]] = {}
    for size in sorted((s for s in left if s > small), reverse=True):
        runs.setdefault(-(-size // grain), []).append([size, left[size]])
    sizes = np.array(sorted(c for c in runs if c * grain < room), np.int64)
    if len(sizes):
        need = np.array([sum(n for _, n in runs[int(c)]) for c in sizes], float)
        for column, x in zip(*_generate(sizes, need, room // grain, gap), strict=True):
            pattern = {int(sizes[k]): n for k, n in column.items()}
            here = {c: sum(n for _, n in runs[c]) for c in pattern}
            whole = min(max(0, int(np.floor(x + 1e-7))), *(here[c] // n for c, n in pattern.items()))
            groups += _filled(pattern, whole, runs, room)
        left = {s: n for s, n in left.items() if s <= small} | {s: n for own in runs.values() for s, n in own}
    _best_fit(left, room, groups)
    return Plan([g.items for g in groups], [g.copies for g in groups])


@dataclass
class Group:
    """Sequences of equal content: pieces by length, how many there are and the room left in each."""

    items: dict[int, int]
    copies: int
    room: int

    def taken(self, size: int, each: int, copies: int) -> Group:
        """So many of the sequences with ``each`` further pieces."""
        items = dict(self.items)
        items[size] = items.get(size, 0) + each
        return Group(items, copies, self.room - size * each)


def _filled(pattern: dict[int, int], copies: int, runs: dict[int, list[list[int]]], room: int) -> list[Group]:
    """Copies of a pattern with pieces of exact lengths, taken from the front of each class's runs.

    As long as all pieces of a copy come from one run per class, copies are made at once; a copy
    across the end of a run is made on its own.
    """
    made = []
    while copies:
        at_once = min(copies, *(runs[c][0][1] // n for c, n in pattern.items()))
        items: dict[int, int] = {}
        for c, n in pattern.items():
            wanted = n * max(1, at_once)
            while wanted:
                run = runs[c][0]
                take = min(wanted, run[1])
                items[run[0]] = items.get(run[0], 0) + take // max(1, at_once)
                run[1] -= take
                wanted -= take
                if not run[1] and len(runs[c]) > 1:
                    runs[c].pop(0)
        made.append(Group(items, max(1, at_once), room - sum(s * n for s, n in items.items())))
        copies -= max(1, at_once)
    return made


def _best_fit(counts: dict[int, int], room: int, groups: list[Group]) -> None:
    """Place pieces, longest first, each in the sequence with the least room that holds it; equal ones at once."""
    waiting: dict[int, list[int]] = {}
    bits = 0  # one per room that some group has

    def put(k: int) -> None:
        nonlocal bits
        if groups[k].room:
            waiting.setdefault(groups[k].room, []).append(k)
            bits |= 1 << groups[k].room

    for k in range(len(groups)):
        put(k)
    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            fits = bits >> size
            if fits:
                space = size + (fits & -fits).bit_length() - 1
                k = waiting[space].pop()
                if not waiting[space]:
                    bits ^= 1 << space
                own = groups[k]
            else:
                own, k = Group({}, -(-n // (room // size)), room), len(groups)
                groups.append(own)
            each = own.room // size
            full = min(own.copies, n // each)
            rest = min(n - full * each, each - 1) if full < own.copies else 0
            parts = [own.taken(size, each, full)] * (full > 0) + [own.taken(size, rest, 1)] * (rest > 0)
            over = own.copies - full - (rest > 0)
            parts += [Group(own.items, over, own.room)] * (over > 0)
            n -= full * each + rest
            groups[k] = parts[0]
            put(k)
            for part in parts[1:]:
                groups.append(part)
                put(len(groups) - 1)


def pieces(docs: DataFrame, doc_id: str, text: str, vocabulary: str | None, capacity: int, ids: bool) -> DataFrame:
    """Full sequences and the rest of every document, with a checksum and, if asked for, the ids."""
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + (", ids array<int>" if ids else "")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * ids
    end = END.to_bytes(4, "little")

    def run(batches):
        encoder = word_encoder(vocabulary or default_path("word_bpe_49k.json"))
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                rows: list[tuple] = []
                for doc, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    data = encoder.encode(body or "") + end
                    total = len(data) // 4
                    for start in range(0, total, capacity):
                        own = data[4 * start : 4 * (start + capacity)]
                        row = (doc, start, len(own) // 4, zlib.crc32(own), total)
                        rows.append((*row, np.frombuffer(own, "<i4")) if ids else row)
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * ids
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY,
         ids: bool = True) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and ``ids`` if asked for."""
    spark = docs.sparkSession
    cut = keep(pieces(docs, doc_id, text, vocabulary, capacity, ids), "packing-pieces")
    size = F.col("length").cast("int").alias("size")
    histogram = cut.groupBy(size).count().collect()  # capacity rows at most
    counts = {r["size"]: r["count"] for r in histogram}
    plan = cutting_stock(counts, capacity)
    total, parts = sum(counts.values()), partitions(spark)
    shares = spark.createDataFrame([(s, -(-n * parts // total)) for s, n in counts.items()], "size int, salts bigint")
    whole = ["doc_id", "start", "length", "ids_crc32"]
    salted = (
        cut.withColumn("size", size).join(F.broadcast(shares), "size")
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.col("salts")))
    )
    before = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = salted.groupBy("size", "salt").count().select(
        "size", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    order = Window.partitionBy("size", "salt").orderBy(*whole)
    ranked = salted.withColumn("nth", F.row_number().over(order)).join(bases, ["size", "salt"]).withColumn(
        "rank", F.col("base") + F.col("nth") - 1
    )
    shared = spark.sparkContext.broadcast(_places(plan))  # an entry per pattern and class

    def place(batches):
        places = shared.value
        for batch in batches:
            sizes = np.asarray(batch.column(batch.schema.get_field_index("size")))
            ranks = np.asarray(batch.column(batch.schema.get_field_index("rank")))
            sequence, slot = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            for s in np.unique(sizes):
                own = sizes == s
                low, each, first, ahead = places[int(s)]
                k = np.searchsorted(low, ranks[own], side="right") - 1
                within = ranks[own] - low[k]
                sequence[own] = first[k] + within // each[k]
                slot[own] = ahead[k] + within % each[k]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in out]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(slot)], names=[*out, "sequence_id", "slot"])

    out = [f for f in cut.columns]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    placed = ranked.select(*out, "size", "rank").mapInArrow(place, f"{kinds}, sequence_id bigint, slot bigint")
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(earlier), F.lit(0).cast("bigint")).alias("offset")
    return placed.select(*whole, "doc_tokens", "sequence_id", offset, *(["ids"] if ids else []))


def _places(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For every class: first rank, pieces per copy, first sequence and pieces ahead, pattern by pattern."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    filled: dict[int, int] = {}
    sequence = 0
    for items, copies in zip(plan.items, plan.copies, strict=True):
        ahead = 0
        for size in sorted(items, reverse=True):
            found.setdefault(size, []).append((filled.get(size, 0), items[size], sequence, ahead))
            filled[size] = filled.get(size, 0) + items[size] * copies
            ahead += items[size]
        sequence += copies
    return {s: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for s, rows in found.items()}
