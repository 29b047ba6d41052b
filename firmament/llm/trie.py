"""Prefix trie of conversations: sorted shards and a skeleton of the paths that lie on their borders.

A conversation becomes a path, 16 bytes of SHA-256 over role and text for every turn, and texts
travel no further.  Paths are dealt into ranges by (path, conv_id), so the members of a node are
neighbours and a path that a third of all conversations have is spread over many shards.

* The first path of every shard is a splitter.  The trie of the splitters is held as the depth that
  neighbouring shards share: two numbers per shard say which nodes lie on both sides, where such a
  node starts and where it ends.  These numbers are broadcast, a few bytes per shard.
* Every shard walks its sorted paths with a stack.  A node that no border crosses is finished there.
  A node of the skeleton gives one partial aggregate per shard that it reaches.
* Partials are added up by (shard where the node starts, depth), which names a node of the skeleton.
  In that order subtrees are intervals, so what skeleton nodes add to their ancestors is a
  running sum inside a shard and one over shards.

The ids of the conversations that end at a node are joined in order: shard by shard in strings of at
most ``ENDS`` ids, which one hash then takes in one after another without holding them.

Rows with a null conv_id take no part.  Null role or text is empty, a null turn comes first, turns of
equal number follow the order of their digests, and a repeated row is a turn of its own.  An empty
table gives no rows.  Other columns are not read.  A path has to fit a row: 16 bytes a turn.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmament.llm.common import keep, partitions

STEP = 16  # bytes of a turn in a path
ENDS = 4096  # ids in one string of ends
ROWS = 4096  # rows of one batch of output
SKELETON = 200_000  # rows of the skeleton up to which it is broadcast to find parents
WORD = r"[^\x20\x09-\x0D]+"
NODE, PARTIAL, IDS = 0, 1, 2

FIELDS = {
    "kind": pa.int32(), "conv_id": pa.int64(), "depth": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
    "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "words": pa.int64(), "ends": pa.string(), "owner": pa.int64(),
    "last": pa.int64(), "parent_conv_id": pa.int64(), "p_owner": pa.int64(), "p_depth": pa.int64(),
}
SCHEMA = ", ".join(f"{n} {'int' if k == pa.int32() else 'string' if k == pa.string() else 'bigint'}" for n, k in FIELDS.items())
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turns)``: digest and number of words of every turn, in order."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    named = F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said)
    narrow = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).isNotNull().alias("known"), F.col(turn).alias("turn"),
        F.unhex(F.substring(F.sha2(named, 256), 1, 2 * STEP)).alias("digest"), F.regexp_count(said, F.lit(WORD)).alias("words"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("known", "turn", "digest", "words")))
    return narrow.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns")
    )


def share_heads(convs: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """Conversations whose first ``heads`` turns (``most`` at most) are those of conversation ``base``, if that exists."""
    kept = keep(convs, "trie-conversations")
    first = kept.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    none = F.slice("turns", 1, 0)
    return (
        kept.withColumns({"base": base, "h": heads}).join(first, "base", "left")
        .select("conv_id", F.concat(
            F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
            F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))),
        ).alias("turns"))
    )


def paths(convs: DataFrame) -> DataFrame:
    """``(conv_id, path, words)`` of conversations."""
    joined = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    return convs.select("conv_id", joined.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))


def shared_depth(a: bytes, b: bytes) -> int:
    """Turns with which both paths begin."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // STEP
    k = 0
    while a[k : k + STEP] == b[k : k + STEP]:
        k += STEP
    return k // STEP


class Borders:
    """The trie of the splitters.

    ``depths[i]`` turns are shared by the paths at the border of shards i and i + 1, ``through[i]`` by
    the first and the last path of shard i.
    """

    def __init__(self, depths: list[int], through: list[int]):
        self.depths, self.through = depths, through

    def low(self, shard: int) -> int:
        return self.depths[shard - 1] if shard else -1

    def high(self, shard: int) -> int:
        return self.depths[shard] if shard < len(self.depths) else -1

    def owner(self, shard: int, depth: int) -> int:
        """Where the node at that depth on the first path of the shard starts."""
        while shard and self.depths[shard - 1] >= depth:
            shard -= 1
            if self.through[shard] < depth:
                break
        return shard

    def last(self, shard: int, depth: int) -> int:
        """Where the node at that depth on the last path of the shard ends."""
        while shard < len(self.depths) and self.depths[shard] >= depth:
            shard += 1
            if self.through[shard] < depth:
                break
        return shard


class _Node:
    """An open node: what its closed children and the conversations that end there add up to."""

    __slots__ = ("before", "children", "conv_id", "ends", "leaves", "members", "pending", "saved", "words")

    def __init__(self, words: int, before: bool):
        self.words, self.before = words, before  # before: the node reaches back into an earlier shard
        self.conv_id, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.pending = [], []


class Walk:
    """The walk over one shard's sorted paths."""

    def __init__(self, shard: int, borders: Borders):
        self.shard, self.borders = shard, borders
        self.low, self.high = borders.low(shard), borders.high(shard)
        self.open: list[_Node] = []
        self.path = b""
        self.rows: list[tuple] = []

    def add(self, conv_id: int, path: bytes, words: list[int]) -> None:
        first = not self.open
        if not first:
            common = shared_depth(self.path, path)
            while len(self.open) > common + 1:
                self._close(False)
        for depth in range(len(self.open), len(path) // STEP + 1):
            self.open.append(_Node(words[depth - 1] if depth else 0, first and depth <= self.low))
        self.open[-1].ends.append(conv_id)
        self.path = path

    def finish(self) -> None:
        while self.open:
            self._close(len(self.open) - 1 <= self.high)

    def _close(self, after: bool) -> None:
        """Take the deepest open node off the stack; after: it reaches into a later shard."""
        node = self.open.pop()
        depth = len(self.open)
        above = self.open[-1] if self.open else None
        conv_id = node.ends[0] if node.conv_id is None else min([node.conv_id, *node.ends[:1]])
        members = node.members + len(node.ends)
        if node.before or after:
            owner = self.borders.owner(self.shard, depth) if node.before else self.shard
            last = self.borders.last(self.shard, depth) if after else self.shard
            parent = (None, None)
            if depth:
                parent = (self.borders.owner(self.shard, depth - 1) if above.before else self.shard, depth - 1)
            self.rows += [(*row, None, owner, depth) for row in node.pending]
            self.rows.append((PARTIAL, conv_id, depth, members, node.children, node.leaves, node.saved, node.words, None, owner, last, None, *parent))
            for k in range(0, len(node.ends), ENDS):
                ids = ",".join(map(str, node.ends[k : k + ENDS]))
                self.rows.append((IDS, node.ends[k], depth, *[None] * 5, ids, owner, *[None] * 4))
            leaves, saved, new = node.leaves, node.saved, not node.before
        else:
            self.rows += [(*row, conv_id, None, None) for row in node.pending]
            leaves, saved, new = node.leaves or 1, node.saved + (members - 1) * node.words, True
            ends = hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest()
            row = (NODE, conv_id, depth, members, node.children, leaves, saved, None, ends, None, None)
            if above is None:
                self.rows.append((*row, None, None, None))
            elif above.before:
                self.rows.append((*row, None, self.borders.owner(self.shard, depth - 1), depth - 1))
            else:
                above.pending.append(row)
        if above is not None:
            above.conv_id = conv_id if above.conv_id is None else min(above.conv_id, conv_id)
            above.members += members
            above.children += new
            above.leaves += leaves
            above.saved += saved


def _batches(rows: list[tuple]):
    for k in range(0, len(rows), ROWS):
        columns = zip(*rows[k : k + ROWS], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, FIELDS.values(), strict=True)], names=list(FIELDS))


def _splitter_trie(ranged: DataFrame) -> tuple[list[int], Borders]:
    """Shards that hold rows, in order, and the depths that paths at both sides of their borders share."""
    spark = ranged.sparkSession
    edges = keep(ranged.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("final")), "trie-edges")
    shards = sorted(r["shard"] for r in edges.select("shard").collect())  # a number per shard
    following = spark.createDataFrame(list(zip(shards, [*shards, None][1:], strict=False)), "shard int, next int")
    after = edges.select(F.col("shard").alias("next"), F.col("first").alias("next_first"))
    pairs = edges.join(following, "shard").join(after, "next", "left")

    def depth(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays([
                pa.array([r["shard"] for r in rows], pa.int32()),
                pa.array([shared_depth(r["first"], r["final"]) for r in rows], pa.int32()),
                pa.array([shared_depth(r["final"], r["next_first"] or b"") for r in rows], pa.int32()),
            ], names=["shard", "through", "depth"])

    found = {r["shard"]: r for r in pairs.select("shard", "first", "final", "next_first").mapInArrow(depth, "shard int, through int, depth int").collect()}
    return shards, Borders([found[s]["depth"] for s in shards[:-1]], [found[s]["through"] for s in shards])


def _hash_ends(ids: DataFrame, count: int) -> DataFrame:
    """``(owner, depth, ends)``: SHA-256 over the strings of ids of a node, joined by commas, as a stream."""

    def run(batches):
        own, state = None, None
        done: list[tuple] = []
        for batch in batches:
            for owner, depth, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if own == (owner, depth):
                    state.update(b",")
                else:
                    if own:
                        done.append((*own, state.hexdigest()))
                    own, state = (owner, depth), hashlib.sha256()
                state.update(text.encode())
        if own:
            done.append((*own, state.hexdigest()))
        for k in range(0, len(done), ROWS):
            columns = zip(*done[k : k + ROWS], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["owner", "depth", "ends"])

    order = ["owner", "depth", "conv_id"]
    dealt = ids.select(*order, "ends").repartition(count, "owner", "depth").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "owner bigint, depth bigint, ends string")


def _skeleton(walked: DataFrame, shards: int, count: int) -> DataFrame:
    """The nodes that lie in several shards, with whole results and the name of their parent."""
    spark = walked.sparkSession
    whole = walked.filter(F.col("kind") == PARTIAL).groupBy("owner", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ["n_convs", "n_children", "n_leaves", "saved_tokens"]],
        *[F.max(c).alias(c) for c in ["words", "last", "p_owner", "p_depth"]],
    )
    reduced = keep(whole.withColumns({
        "own_leaf": (F.col("n_children") == 0).cast("bigint"), "own_saved": (F.col("n_convs") - 1) * F.col("words"),
    }), "trie-skeleton")
    totals = {r["owner"]: r for r in reduced.groupBy("owner").agg(F.sum("own_leaf").alias("leaf"), F.sum("own_saved").alias("saved")).collect()}
    running, leaf, saved = [(0, 0, 0)], 0, 0  # a row per shard: what earlier shards own
    for shard in range(shards):
        if shard in totals:
            leaf, saved = leaf + totals[shard]["leaf"], saved + totals[shard]["saved"]
        running.append((shard + 1, leaf, saved))
    sums = spark.createDataFrame(running, "shard bigint, leaf bigint, saved bigint")
    deeper = Window.partitionBy("owner").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    # Below a node lie deeper nodes of its first shard and all that start after that and before its last one.
    upto = sums.select((F.col("shard") - 1).alias("owner"), F.col("leaf").alias("owner_leaf"), F.col("saved").alias("owner_saved"))
    ahead = sums.select(F.col("shard").alias("last"), F.col("leaf").alias("last_leaf"), F.col("saved").alias("last_saved"))
    ends = _hash_ends(walked.filter(F.col("kind") == IDS), count)
    nothing = hashlib.sha256(b"").hexdigest()
    return reduced.withColumns({"leaf": F.sum("own_leaf").over(deeper), "saved": F.sum("own_saved").over(deeper)}).join(
        upto, "owner").join(ahead, "last").join(ends, ["owner", "depth"], "left").select(
        "owner", "conv_id", "depth", "n_convs", "n_children",
        (F.col("n_leaves") + F.col("leaf") + F.col("last_leaf") - F.col("owner_leaf")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("saved") + F.col("last_saved") - F.col("owner_saved")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"), "p_owner", "p_depth",
    )


def prefix_trie(named: DataFrame) -> DataFrame:
    """A row per node of the trie of ``(conv_id, path, words)``, as ``paths`` makes them."""
    spark = named.sparkSession
    count = partitions(spark)
    ranged = keep(named.repartitionByRange(count, "path", "conv_id").withColumn("shard", F.spark_partition_id()), "trie-shards")
    shards, borders = _splitter_trie(ranged)
    shared = spark.sparkContext.broadcast(({s: k for k, s in enumerate(shards)}, borders))  # three numbers per shard

    def walk(batches):
        places, borders = shared.value
        at, current = None, None
        for batch in batches:
            for shard, conv_id, path, words in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if shard != at:
                    if current:
                        current.finish()
                        yield from _batches(current.rows)
                    at, current = shard, Walk(places[shard], borders)
                current.add(conv_id, path, words)
            if current and len(current.rows) >= ROWS:
                yield from _batches(current.rows)
                current.rows = []
        if current:
            current.finish()
            yield from _batches(current.rows)

    dealt = ranged.select("shard", "conv_id", "path", "words").repartitionById(count, F.col("shard"))
    walked = keep(dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(walk, SCHEMA), "trie-nodes")
    finished = walked.filter(F.col("kind") == NODE).withColumnRenamed("ends", "ends_sha256")
    if not borders.depths:
        return finished.select(*RESULT)
    skeleton = keep(_skeleton(walked, len(shards), count), "trie-whole")
    parents = skeleton.select(F.col("owner").alias("p_owner"), F.col("depth").alias("p_depth"), F.col("conv_id").alias("parent_conv_id"))
    if skeleton.count() <= SKELETON:
        parents = F.broadcast(parents)
    open_ones = finished.filter(F.col("p_owner").isNotNull()).drop("parent_conv_id")
    own = [c for c in RESULT if c != "parent_conv_id"] + ["p_owner", "p_depth"]
    joined = open_ones.select(*own).unionByName(skeleton.select(*own)).join(parents, ["p_owner", "p_depth"], "left")
    return finished.filter(F.col("p_owner").isNull()).select(*RESULT).unionByName(joined.select(*RESULT))
