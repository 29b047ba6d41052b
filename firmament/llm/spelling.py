"""Spelling variants: edits of every word, screened by Bloom filters, joined to the vocabulary where they pass.

* Words are counted inside the tasks first, so a word that every document holds is one row per task.
* The vocabulary fills one blocked Bloom filter per word length: eight bits in one block of 256.  The
  filters of all lengths lie in one array, built in segments by the tasks and broadcast.  It has
  ``BITS`` bits per word up to ``ROOM`` bytes, a size that no vocabulary exceeds; beyond that a
  filter lets more false candidates pass and results stay the same.
* Every word generates its edits as hashes: each deletion is looked up in the filter of the next
  shorter length, each replacement by a later letter in its own.  Insertions and replacements by an
  earlier letter are the same pairs seen from the other word.  Only edits that pass become strings.
* Those meet the vocabulary in an equal join, which drops the false ones.

A word's form is its most frequent near word if that is ``times`` as frequent.  So frequency rises along
forms, there are no cycles, and roots come from pointer doubling.

Null and empty texts have no words.  A null doc_id is an empty one where it is spelt out, and its rows
count.  Repeated rows count once each, ties go to the smaller word in code-point order, very long
words are edited in stretches of ``STRETCH`` places, and an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import binary_rows, exchange, keep, mix, packed, packed_schema, partitions, records
from firmament.operators.graph import chase_pointers

RUN = "[A-Za-zÀ-ÿ]"
LENGTH = 5  # code points of a word at least
OCCURRENCES = 3
TIMES = 2  # a form is so many times as frequent
BITS = 16  # of filter per word
ROOM = 1 << 26  # bytes of all filters at most
SEGMENT = 4096  # blocks in one row while filters are built
LANES = 8  # 32-bit words of a block, each with one bit of every word
LEAST = 16  # blocks of a filter at least
STRETCH = 512  # places of a word that are edited at a time
STEP = 1 << 19  # edits that are looked up at a time
ENTRIES = 300_000  # words that a task counts before it passes them on
ROWS = 4096

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SALTS = (mix(np.arange(71, 71 + LANES, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)) | np.uint64(1)


def lower_ascii(run: str) -> str:
    """Only A-Z change."""
    return run.lower() if run.isascii() else run.encode().lower().decode()


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, typos: int = 0) -> DataFrame:
    """``(word, n)`` of all runs of letters with at least ``length`` code points.

    With ``typos`` a run loses one code point wherever the checksum of ``<doc_id>:<run>`` is a
    multiple of it: slips of the pen at known places.
    """
    pattern = f"{RUN}{{{length},}}"

    def run(batches):
        find = re.compile(pattern).findall
        counts: dict[str, int] = defaultdict(int)

        def rows():
            words, ns = list(counts), list(counts.values())
            for k in range(0, len(words), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(words[k : k + ROWS]), pa.array(ns[k : k + ROWS], pa.int64())], names=["word", "n"])
            counts.clear()

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not body:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for found, n in Counter(find(body)).items():
                    word = lower_ascii(found)
                    if typos:
                        h = zlib.crc32(word.encode(), start)
                        if h % typos == 0:
                            k = h % len(word)
                            word = word[:k] + word[k + 1 :]
                            if len(word) < length:
                                continue
                    counts[word] += n
                if len(counts) >= ENTRIES:
                    yield from rows()
        yield from rows()

    counted = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def code_points(words: list[str]) -> np.ndarray:
    """A row of code points per word; all have one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def powers(length: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(length, BASE))])


def spelling_hash(sums: np.ndarray, length: int) -> np.ndarray:
    """Hash of words out of their polynomial sums."""
    return mix(sums ^ np.uint64(length))


@dataclass
class Filters:
    """Blocked Bloom filters: for every length, how many blocks and where they start."""

    blocks: dict[int, int]
    starts: dict[int, int]
    bits: np.ndarray | None = None

    @classmethod
    def plan(cls, counts: dict[int, int], room: int = ROOM) -> Filters:
        """Sizes by the number of words of each length."""
        share = min(1.0, room * 8 / max(1, sum(counts.values()) * BITS))
        blocks = {n: max(LEAST, int(c * BITS * share) // (32 * LANES)) for n, c in counts.items()}
        starts, total = {}, 0
        for n in sorted(blocks):
            starts[n] = total
            total += blocks[n]
        return cls(blocks, starts)

    @property
    def size(self) -> int:
        return sum(self.blocks.values())

    def block(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Block of every hash of a word of that length."""
        return (((hashes >> np.uint64(32)) * np.uint64(self.blocks[length])) >> np.uint64(32)).astype(np.int64) + self.starts[length]

    def passing(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Places of the hashes that the filter lets pass; those that fail one lane are not looked up in the next."""
        left = np.arange(len(hashes))
        block = self.block(hashes, length) * LANES
        low = hashes & np.uint64(0xFFFFFFFF)
        for lane in range(LANES):
            good = (self.bits[block + lane] >> lane_bit(low, lane)) & np.uint32(1) > 0
            left, block, low = left[good], block[good], low[good]
        return left


def lane_bit(low: np.ndarray, lane: int) -> np.ndarray:
    """Bit of a lane, 0 to 31, for the low half of every hash."""
    with np.errstate(over="ignore"):
        return (((low * SALTS[lane]) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)).astype(np.uint32)


def by_length(words: list[str]) -> dict[int, list[int]]:
    """Places of the words of each length."""
    found: dict[int, list[int]] = defaultdict(list)
    for k, word in enumerate(words):
        found[len(word)].append(k)
    return found


def word_hashes(words: list[str]) -> np.ndarray:
    """Hash of words of one length."""
    points = mix(code_points(words))
    with np.errstate(over="ignore"):
        return spelling_hash((points * powers(points.shape[1])[:-1]).sum(axis=1, dtype=np.uint64), points.shape[1])


ENTRY = np.dtype([("block", np.int64), *((f"lane{k}", np.uint32) for k in range(LANES))])


def build_filters(vocabulary: DataFrame, counts: dict[int, int], room: int = ROOM) -> Filters:
    """Filters of all words of ``vocabulary``; the driver gets their bits, at most ``room`` bytes and ``LEAST`` blocks a length."""
    filters = Filters.plan(counts, room)
    segments = -(-filters.size // SEGMENT)

    def enter(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, places in by_length(words).items():
                hashes = word_hashes([words[k] for k in places])
                entries = np.zeros(len(hashes), ENTRY)
                entries["block"] = filters.block(hashes, length)
                for lane in range(LANES):
                    entries[f"lane{lane}"] = np.uint32(1) << lane_bit(hashes & np.uint64(0xFFFFFFFF), lane)
                yield packed(entries, entries["block"] // SEGMENT, segments)

    def unite(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                entries = records([one], ENTRY)
                segment = one.column(0)[0].as_py()
                bits = found.setdefault(segment, np.zeros((SEGMENT, LANES), np.uint32))
                for lane in range(LANES):
                    np.bitwise_or.at(bits[:, lane], entries["block"] - segment * SEGMENT, entries[f"lane{lane}"])
        for segment, bits in found.items():
            data = bits.reshape(-1).view(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), binary_rows(data, np.array([0, len(data)]))], names=["segment", "bits"])

    count = partitions(vocabulary.sparkSession)
    entered = exchange(vocabulary.select("word").mapInArrow(enter, packed_schema(ENTRY)), count)
    bits = np.zeros((segments, SEGMENT * LANES), np.uint32)
    for row in entered.mapInArrow(unite, "segment int, bits binary").toLocalIterator():
        bits[row["segment"]] = np.frombuffer(row["bits"], np.uint32)
    filters.bits = bits.reshape(-1)
    return filters


def edits(words: list[str], letters: np.ndarray, filters: Filters):
    """(place of a word, edited word) of every edit of words of one length that the filters let pass."""
    length = len(words[0])
    alphabet = mix(letters)
    factor = powers(length)
    each = max(1, STEP // (min(length, STRETCH) * len(letters)))
    for first in range(0, len(words), each):
        points = code_points(words[first : first + each])
        named = mix(points)
        with np.errstate(over="ignore"):
            terms = named * factor[:-1]
            ahead = np.cumsum(terms, axis=1, dtype=np.uint64)
            total = ahead[:, -1:]
            if length - 1 in filters.blocks:
                shorter = (ahead - terms) + (total - ahead) * INVERSE
                repeated = np.zeros(points.shape, bool)
                repeated[:, :-1] = points[:, :-1] == points[:, 1:]  # of equal neighbours the last one goes
                rows, places = np.nonzero(~repeated)
                for k in filters.passing(spelling_hash(shorter[rows, places], length - 1), length - 1).tolist():
                    word, at = words[first + rows[k]], int(places[k])
                    yield first + int(rows[k]), word[:at] + word[at + 1 :]
            for low in range(0, length, STRETCH):
                own = slice(low, low + STRETCH)
                changed = total[:, :, None] + (alphabet[None, None, :] - named[:, own, None]) * factor[:-1][own][None, :, None]
                rows, places, new = np.nonzero(letters[None, None, :] > points[:, own, None])
                for k in filters.passing(spelling_hash(changed[rows, places, new], length), length).tolist():
                    word, at = words[first + rows[k]], low + int(places[k])
                    yield first + int(rows[k]), word[:at] + chr(int(letters[new[k]])) + word[at + 1 :]


def near_pairs(vocabulary: DataFrame, room: int = ROOM) -> DataFrame:
    """``(word, n, near, near_n)``: all pairs of words one edit apart, in one direction each."""
    spark = vocabulary.sparkSession
    counts = {r["length"]: r["count"] for r in vocabulary.groupBy(F.length("word").alias("length")).count().collect()}  # a row per length
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").distinct().collect()  # the alphabet
    alphabet = np.array(sorted(ord(r["letter"]) for r in letters), np.uint64)
    shared = spark.sparkContext.broadcast((alphabet, build_filters(vocabulary, counts, room)))

    def generate(batches):
        letters, filters = shared.value
        for batch in batches:
            words, ns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found: list[tuple[str, int, str]] = []
            for places in by_length(words).values():
                for k, edited in edits([words[p] for p in places], letters, filters):
                    found.append((words[places[k]], ns[places[k]], edited))
                    if len(found) >= ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["word", "n", "near"])
                        found = []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["word", "n", "near"])

    dealt = vocabulary.select("word", "n").repartition(partitions(spark), "word")
    candidates = dealt.mapInArrow(generate, "word string, n bigint, near string")
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return candidates.join(known, "near").select("word", "n", "near", "near_n")


def variants(vocabulary: DataFrame, times: int = TIMES, room: int = ROOM) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a vocabulary ``(word, n)`` of distinct words."""
    vocabulary = keep(vocabulary, "spelling-vocabulary")
    pairs = near_pairs(vocabulary, room)
    sides = F.explode(F.array(
        F.struct("word", F.col("near"), F.col("near_n")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )).alias("side")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    met = pairs.select(sides).select("side.*").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    is_form = -F.col("best.less") >= times * F.col("n")
    formed = keep(vocabulary.join(met, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    ), "spelling-forms")
    # Chains are followed over the words that have a form; all others are their own root.
    linked = formed.filter(F.col("form").isNotNull()).select(F.col("word").alias("node"), F.col("form").alias("parent"))
    ends = linked.select(F.col("parent").alias("node")).distinct().join(linked.select("node"), "node", "left_anti")
    nothing = F.lit(None).cast("string")
    pointers = keep(linked.select("node", nothing.alias("root"), "parent").unionByName(
        ends.select("node", F.col("node").alias("root"), nothing.alias("parent"))), "spelling-links")
    roots = chase_pointers(pointers).select(F.col("node").alias("word"), "root")
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
