"""N-gram Jaccard join: MinHash banding with exact verification.

A document is the set of its runs of ``n`` lower-case words (a shorter one: of all its words).
Rows with one set are copies and stand as one class member, whose representative is the smallest
doc_id.  ``bands`` picks the number of bands and rows for a target recall at the threshold;
representatives meet where a band hash agrees, and every pair is verified once, on the full
sets, in the first band that brings it together.

Buckets of any size are cut into blocks, and pairs of blocks are the unit of work: no task holds
more than two blocks, and what leaves it are link counts per member and a spanning forest, never
the pairs.  The result has a row per document: ``class_id`` (smallest doc_id of its connected
component of links), ``copy_id`` (smallest doc_id with the same set) and ``n_links`` (other
documents at or above the threshold, copies included).

Null, empty and blank texts have an empty set: they link to nothing and are their own class.  A
null doc_id takes no part; its row comes back with null class and copy and no links.  Rows that
repeat a doc_id and its text count as further copies; a doc_id with several texts ties their
sets together, and their links add up.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmament.llm.common import append, binary_rows, keep, mix, partitions, run_hashes, text_slices, unpack, words
from firmament.operators.graph import connected_components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
MOST_BANDS = 20
BLOCK_ROWS = 1024  # members and n-grams of a block
BLOCK_SHINGLES = 1 << 20
BITS = np.uint64(52)  # of an n-gram's hash


def bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_BANDS) -> tuple[int, int]:
    """(bands, rows): the longest bands, hence fewest false candidates, that reach the recall with ``most`` bands."""
    best = (1, 1)
    for rows in range(1, 16):
        hit = threshold**rows
        need = 1 if hit >= recall else int(np.ceil(np.log(1 - recall) / np.log1p(-hit)))
        if need > most:
            break
        best = (need, rows)
    return best


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every document of a slice, ascending, and the cuts between documents."""
    docs = len(offsets) - 1
    starts, ends, owner = words(data, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(docs + 1, np.int64)
    name = run_hashes(data, starts, ends)
    count = np.bincount(owner, minlength=docs)
    with np.errstate(over="ignore"):
        factors = mix(np.arange(11, 11 + n, dtype=np.uint64)) | np.uint64(1)
        parts = []
        if len(name) >= n:
            value = np.zeros(len(name) - n + 1, np.uint64)
            for j in range(n):
                value += name[j : len(name) - n + 1 + j] * factors[j]
            inside = owner[: len(name) - n + 1] == owner[n - 1 :]
            parts.append((owner[: len(name) - n + 1][inside], mix(value[inside])))
        short = np.flatnonzero((count > 0) & (count < n))
        if len(short):
            first = np.cumsum(count) - count
            value = np.zeros(len(short), np.uint64)
            for j in range(n - 1):
                has = count[short] > j
                value[has] += name[first[short[has]] + j] * factors[j]
            parts.append((short, mix(value + count[short].astype(np.uint64))))
    doc = np.concatenate([d for d, _ in parts]).astype(np.uint64)
    key = np.sort((doc << BITS) | (np.concatenate([v for _, v in parts]) >> (np.uint64(64) - BITS)))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    cuts = np.searchsorted(key, np.arange(docs + 1, dtype=np.uint64) << BITS)
    return key & ((np.uint64(1) << BITS) - np.uint64(1)), cuts


def _set_hash(value: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two words that name the set of every document; zeros for the empty set."""
    size = np.diff(cuts)
    full = np.flatnonzero(size)
    a, b = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    if len(full):
        with np.errstate(over="ignore"):
            a[full] = mix(np.add.reduceat(mix(value), cuts[full]) + size[full].astype(np.uint64))
            b[full] = mix(np.add.reduceat(mix(value ^ np.uint64(0x5851F42D4C957F2D)), cuts[full]))
    return a, b


def _signatures(n: int, count: int, rows: int):
    """Text column to set hash (two words), set size and band hashes."""
    rng = np.random.default_rng(23)
    masks = rng.integers(0, 1 << 63, count * rows, dtype=np.uint64)
    odd = rng.integers(0, 1 << 63, count * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    weights = mix(np.arange(71, 71 + rows, dtype=np.uint64)) | np.uint64(1)

    def work(texts: pa.Array) -> list[pa.Array]:
        low, high, sizes, found = [], [], [], []
        for start, end, data, offsets in text_slices(texts, rows=4000):
            value, cuts = shingle_sets(data, offsets, n)
            size = np.diff(cuts)
            full = np.flatnonzero(size)
            a, b = _set_hash(value, cuts)
            band = np.zeros((end - start, count), np.uint64)
            if len(full):
                heads = cuts[full]
                with np.errstate(over="ignore"):
                    for j in range(count):
                        total = np.zeros(len(full), np.uint64)
                        for r in range(rows):
                            k = j * rows + r
                            x = (value ^ masks[k]) * odd[k]
                            x ^= x >> np.uint64(31)
                            total += np.minimum.reduceat(x, heads) * weights[r]
                        band[full, j] = mix(total + np.uint64(j + 1))
            low.append(a)
            high.append(b)
            sizes.append(size)
            found.append(band)
        flat = np.concatenate(found) if found else np.empty((0, count), np.uint64)
        offsets = np.arange(len(flat) + 1) * (8 * count)
        return [
            pa.array(np.concatenate(low or [np.empty(0, np.uint64)]).view(np.int64)),
            pa.array(np.concatenate(high or [np.empty(0, np.uint64)]).view(np.int64)),
            pa.array(np.concatenate(sizes or [np.empty(0, np.int64)]).astype(np.int64)),
            binary_rows(flat.reshape(-1).view(np.uint8), offsets),
        ]

    return work


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that end where a key (band, bucket, x, y) ends, out of a sorted partition."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("key", "x", "y")]
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        if held:
            last = held[-1]
            change[0] = any(last.column(last.schema.get_field_index(c))[last.num_rows - 1].as_py() != k[0]
                            for c, k in zip(("key", "x", "y"), keys, strict=True))
        cut = np.flatnonzero(change)
        if len(cut):
            held.append(batch.slice(0, int(cut[-1])))
            yield pa.Table.from_batches([b for b in held if b.num_rows] or [batch.slice(0, 0)]).combine_chunks()
            held = []
            batch = batch.slice(int(cut[-1]))
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _bounds(table: pa.Table) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for c in ("key", "x", "y"):
        k = table.column(c).to_numpy()
        change[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)


def _first_meetings(band: np.ndarray, j: int, mine: np.ndarray | None) -> np.ndarray:
    """Which pairs (i, k) of a group meet in no band before ``j``; ``mine``: members of block x, for pairs across blocks."""
    n = len(band)
    new = np.zeros((n, n), bool)
    if mine is None:
        new = np.triu(~new, 1)
    else:
        new[np.ix_(mine, ~mine)] = True
    for i in range(j):
        new &= band[:, i][:, None] != band[:, i][None, :]
    return new


def _requests(count: int):
    """Members of a group that have a pair to verify there."""
    asked = ["rep", "set_a", "key", "x", "y", "j", "blk", "copies", "band"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            flat, _ = unpack(table.column("band"))
            band = np.frombuffer(flat.tobytes(), np.uint64).reshape(-1, count)
            bounds = _bounds(table)
            place, block = table.column("j").to_numpy(), table.column("blk").to_numpy()
            x, y = table.column("x").to_numpy(), table.column("y").to_numpy()
            heads, wanted = bounds[:-1], np.zeros(len(band), bool)
            together = np.minimum.reduceat(band, heads) == np.maximum.reduceat(band, heads) if len(band) else band == 0
            earlier = (together & (np.arange(count)[None, :] < place[heads][:, None])).any(axis=1)
            for g in np.flatnonzero(~earlier):
                a, b = int(bounds[g]), int(bounds[g + 1])
                if b - a < 2:
                    continue
                mine = None if x[a] == y[a] else block[a:b] == x[a]
                new = _first_meetings(band[a:b], int(place[a]), mine)
                wanted[a:b] = new.any(axis=0) | new.any(axis=1)
            kept = np.flatnonzero(wanted)
            yield pa.RecordBatch.from_arrays(
                [table.column(c).combine_chunks().take(pa.array(kept)) for c in asked], names=asked
            )

    return run


def overlaps(value: np.ndarray, cuts: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sorted sets, right wherever ``new`` holds."""
    n = len(cuts) - 1
    size = np.diff(cuts)
    owner = np.repeat(np.arange(n), size)
    element, number, held = np.unique(value, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(held > 1)
    if not len(shared):
        return np.zeros((n, n), np.int32)
    a, b = np.nonzero(new)
    if len(a) * size.mean() * 1e-7 < n * n * len(shared) * 1e-10:
        out = np.zeros((n, n), np.int32)
        for i, k in zip(a.tolist(), b.tolist(), strict=True):
            out[i, k] = len(np.intersect1d(value[cuts[i] : cuts[i + 1]], value[cuts[k] : cuts[k + 1]], assume_unique=True))
        return out
    column = np.full(len(element), -1)
    column[shared] = np.arange(len(shared))
    column = column[number]
    total = np.zeros((n, n), np.float32)
    for first in range(0, len(shared), 2048):
        inside = (column >= first) & (column < first + 2048)
        dense = np.zeros((n, min(2048, len(shared) - first)), np.float32)
        dense[owner[inside], column[inside] - first] = 1
        total += dense @ dense.T
    return total.astype(np.int32)


def _spanning(adjacent: np.ndarray) -> np.ndarray:
    """Smallest member reachable over the links of a group, for every member."""
    n = len(adjacent)
    root = np.arange(n)
    a, b = np.nonzero(adjacent)
    while len(a):
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            break
        root = low
    return root


def _verify(count: int, threshold: float):
    """Link counts of members and, as edges, a spanning forest of every group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            flat, _ = unpack(table.column("band"))
            band = np.frombuffer(flat.tobytes(), np.uint64).reshape(-1, count)
            sets, set_cuts = unpack(table.column("shingles"))
            value, set_cuts = np.frombuffer(sets.tobytes(), np.uint64), set_cuts // 8
            bounds = _bounds(table)
            place, block, rep = (table.column(c).to_numpy() for c in ("j", "blk", "rep"))
            x, y, copies = (table.column(c).to_numpy() for c in ("x", "y", "copies"))
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b - a < 2:
                    continue
                new = _first_meetings(band[a:b], int(place[a]), None if x[a] == y[a] else block[a:b] == x[a])
                cuts = set_cuts[a : b + 1] - set_cuts[a]
                size = np.diff(cuts)
                common = overlaps(value[set_cuts[a] : set_cuts[b]], cuts, new)
                either = size[:, None] + size[None, :] - common
                linked = new & (common >= threshold * either - 1e-9)
                if not linked.any():
                    continue
                weight = copies[a:b]
                links = linked @ weight + linked.T @ weight
                root = _spanning(linked)
                some = links > 0
                out.append((rep[a:b][some], rep[a:b][root[some]], links[some]))
            for nodes, roots, links in out:
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots), pa.array(links.astype(np.int64))],
                                                 names=["a", "b", "links"])

    return run


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE, threshold: float = THRESHOLD,
         recall: float = RECALL) -> DataFrame:
    """``doc_id, class_id, copy_id, n_links`` for every row of ``docs``."""
    spark = docs.sparkSession
    count, rows = bands(threshold, recall)
    parts = partitions(spark)
    lower = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.lower(F.col(text)).alias("text"))
    fields = [("set_a", T.LongType()), ("set_b", T.LongType()), ("size", T.LongType()), ("band", T.BinaryType())]
    signed, _ = append(lower, "text", fields, lambda: _signatures(n, count, rows))
    signed = keep(signed.drop("text"), "jaccard-signatures")
    known = signed.filter(F.col("doc_id").isNotNull() & (F.col("size") > 0))
    classes = keep(
        known.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
                                            F.first("size").alias("size"), F.first("band").alias("band")),
        "jaccard-classes",
    )
    slot = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    key = F.xxhash64(F.expr("substring(band, j * 8 + 1, 8)"), "j")
    spread = classes.withColumn("j", slot).select("rep", "set_a", "size", "j", key.alias("key"))
    buckets = (
        spread.groupBy("key", "j").agg(F.count("*").alias("n"), F.sum("size").alias("total")).filter("n > 1")
        .select("key", "j", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    )
    blk = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    met = (
        spread.join(buckets, ["key", "j"]).select("rep", "set_a", "j", "key", blk.alias("blk"), "blocks")
        .join(classes.select("rep", "set_a", "copies", "band"), ["rep", "set_a"])  # bands travel only with members of a bucket
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("rep", "set_a", "copies", "band", "j", "key", "blk", F.least("blk", "other").alias("x"), F.greatest("blk", "other").alias("y"))
    )
    order = ["key", "x", "y", "rep"]
    wanted = "rep bigint, set_a bigint, key bigint, x int, y int, j int, blk int, copies bigint, band binary"
    requests = keep(
        met.repartition(parts, "key", "x", "y").sortWithinPartitions(*order).mapInArrow(_requests(count), wanted), "jaccard-requests"
    )

    def sets(texts: pa.Array) -> list[pa.Array]:
        out, names = [], [np.empty(0, np.uint64)]
        for start, end, data, offsets in text_slices(texts, rows=4000):
            value, cuts = shingle_sets(data, offsets, n)
            out += [value[cuts[i] : cuts[i + 1]].tobytes() for i in range(end - start)]
            names.append(_set_hash(value, cuts)[0])
        return [pa.array(out, pa.binary()), pa.array(np.concatenate(names).view(np.int64))]

    texts = lower.join(requests.select(F.col("rep").alias("doc_id")).distinct().hint("merge"), "doc_id")  # one plan at any size
    full, _ = append(texts, "text", [("shingles", T.BinaryType()), ("set_a", T.LongType())], lambda: sets)
    one = full.select(F.col("doc_id").alias("rep"), "set_a", "shingles").dropDuplicates(["rep", "set_a"])  # repeated rows enter once
    loaded = requests.join(one, ["rep", "set_a"])
    links = keep(
        loaded.repartition(parts, "key", "x", "y").sortWithinPartitions(*order)
        .mapInArrow(_verify(count, threshold), "a bigint, b bigint, links bigint"),
        "jaccard-links",
    )
    counted = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    component = connected_components(links.select("a", "b").filter("a <> b")).select(F.col("node").alias("rep"), "component")
    of_class = (
        classes.select("rep", "copies", "set_a", "set_b").join(counted, "rep", "left").join(component, "rep", "left")
        .select("set_a", "set_b", F.col("rep").alias("copy_id"), F.coalesce("component", "rep").alias("class_id"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    inside = F.when(F.col("doc_id").isNotNull() & (F.col("size") > 0), F.col("set_a"))
    return (
        signed.select("doc_id", inside.alias("set_a"), "set_b").join(of_class, ["set_a", "set_b"], "left")
        .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("copy_id", "doc_id").alias("copy_id"),
                F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
    )
