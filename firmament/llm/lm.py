"""Language-model scores by stupid backoff over runs of words or bytes, computed as joins.

``score_words`` explodes a document into the runs of one to ``WORDS`` words that end at each of its
words; a word is a run of non-blank bytes and n-grams are 64-bit names.  A word scores
count(n-gram) / count(n-gram without its last word) of the longest n-gram that occurs outside the
row itself, times ``ALPHA`` for every word of context given up; both counts leave out what the row
itself holds, as every n-gram of a row would else be known from that row, and shuffled words would
score as well as prose.  An n-gram that occurs once elsewhere counts.  A single word scores its share
of the corpus.  Near the start of a document the longest n-gram is the one that fits.

``score`` does the same with the ``ORDER`` bytes that end at each byte (zero bytes stand before the
start of a document); shorter n-grams are their ends, and the context of an n-gram is all but its
last byte.  There counts include the row, and n-grams seen less than ``LEAST`` times back off.

Documents are dealt into groups.  Every group sends its distinct n-grams with their counts to the
count tables, which are partitioned by hash; these add the counts of all groups up, join them to the
n-grams asked for and send the totals back.  Logarithms are summed per document.

A group asks once for an n-gram however often it holds it, so frequent n-grams are no hot keys.
Of words, texts travel compressed, a bucket of n-grams is a range of names, and a cell (the names that one
group asks of one bucket) is sent as the distances of ascending names: about 5.5 bytes a name, without loss.
Counts cover all documents, copies included.  Null and empty texts have no n-grams, a sum of 0
and no mean.  Rows are scored one by one, so repeated rows and ids get a row each; a null
doc_id is kept.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import SLICE_ROWS, exchange, mix, packed, packed_schema, partitions, records, run_hashes, text_slices, unpack, words

ORDER = 5  # at most 5
WORDS = 3
LEAST = 2
ALPHA = 0.4
GROUPS = 2  # groups of documents per partition
ASKED = np.dtype([("key", "<u8"), ("count", "<i8"), ("g", "<u4")])
TOTAL = np.dtype([("key", "<u8"), ("count", "<i8")])
PLACE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that the order of words counts
PACK_BYTES = 8 << 20  # text that a task holds before it sends it to the groups, compressed
KIND = np.uint64(40)  # keys: kind (order and whether context) above 40 bits of bytes


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` bytes up to and with every byte, as a number."""
    code = data.astype(np.uint64)
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    place = np.arange(len(data)) - begin
    for back in range(1, order):
        code[back:] |= np.where(place[back:] >= back, data[: len(data) - back], 0).astype(np.uint64) << np.uint64(8 * back)
    return code


def _kinds(code: np.ndarray, count: np.ndarray, order: int):
    """Keys and counts of the n-grams and contexts of every order, out of the longest."""
    for k in range(order, 0, -1):
        gram, number = np.unique(code & ((np.uint64(1) << np.uint64(8 * k)) - np.uint64(1)), return_inverse=True)
        held = np.bincount(number, count, minlength=len(gram)).astype(np.int64)
        yield gram | (np.uint64(2 * k) << KIND), held
        if k > 1:
            context, number = np.unique(gram >> np.uint64(8), return_inverse=True)
            yield context | (np.uint64(2 * k + 1) << KIND), np.bincount(number, held, minlength=len(context)).astype(np.int64)


def log_scores(code: np.ndarray, keys: np.ndarray, counts: np.ndarray, order: int, bytes_in_all: int) -> np.ndarray:
    """Logarithms of the scores of distinct longest n-grams; ``keys`` ascend."""
    def look(key):
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[place] == key, counts[place], 0)

    score = np.empty(len(code))
    waiting = np.arange(len(code))
    for k in range(order, 0, -1):
        gram = code[waiting] & ((np.uint64(1) << np.uint64(8 * k)) - np.uint64(1))
        held = look(gram | (np.uint64(2 * k) << KIND))
        below = look((gram >> np.uint64(8)) | (np.uint64(2 * k + 1) << KIND)) if k > 1 else np.full(len(gram), bytes_in_all)
        seen = held >= (LEAST if k > 1 else 0)
        score[waiting[seen]] = np.log(held[seen] / below[seen]) + (order - k) * np.log(ALPHA)
        waiting = waiting[~seen]
    return score


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """``doc_id, n_grams, log_score, mean_log_score`` of every row."""
    if not 1 <= order <= 5:
        raise ValueError("order must be 1 to 5")
    parts = partitions(docs.sparkSession)
    groups = GROUPS * parts
    rows = docs.select(F.pmod(F.xxhash64(doc_id, text), F.lit(groups)).cast("int").alias("g"), F.col(doc_id).cast("bigint").alias("doc_id"),
                       F.col(text).alias("text"))
    bytes_in_all = rows.agg(F.sum(F.octet_length("text")).alias("n")).head()["n"] or 0

    def ask(group: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.uint64), np.empty(0, np.int64))]
        for _, _, data, offsets in text_slices(group.column("text").combine_chunks()):
            code, held = np.unique(grams(data, offsets, order), return_counts=True)
            found.append((code, held))
        code, number = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
        held = np.bincount(number, np.concatenate([h for _, h in found]), minlength=len(code)).astype(np.int64)
        kinds = list(_kinds(code, held, order)) if len(code) else []
        out = np.zeros(sum(len(k) for k, _ in kinds), ASKED)
        if kinds:
            out["key"] = np.concatenate([k for k, _ in kinds])
            out["count"] = np.concatenate([h for _, h in kinds])
            out["g"] = group.column("g")[0].as_py()
        return pa.Table.from_batches([packed(out, (mix(out["key"]) % np.uint64(groups)).astype(np.int64), groups)])

    def add_up(batches):
        asked = records(batches, ASKED)
        if len(asked):
            _, number = np.unique(asked["key"], return_inverse=True)
            total = np.bincount(number, asked["count"]).astype(np.int64)
            out = np.empty(len(asked), TOTAL)
            out["key"], out["count"] = asked["key"], total[number]
            yield packed(out, asked["g"].astype(np.int64), groups)

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.sort(records([right], TOTAL), order="key") if right.num_rows else np.empty(0, TOTAL)
        sums, sizes = [np.empty(0)], [np.empty(0, np.int64)]
        for first, end, data, offsets in text_slices(left.column("text").combine_chunks()):
            doc = np.repeat(np.arange(end - first), np.diff(offsets))
            value = np.empty(0)
            if len(data):
                code, number = np.unique(grams(data, offsets, order), return_inverse=True)
                value = log_scores(code, known["key"], known["count"], order, bytes_in_all)[number]
            sums.append(np.bincount(doc, value, minlength=end - first))
            sizes.append(np.diff(offsets))
        return pa.table({"doc_id": left.column("doc_id"), "n_grams": np.concatenate(sizes), "log_score": np.concatenate(sums)})

    asked = rows.groupBy("g").applyInArrow(ask, packed_schema(ASKED))
    totals = exchange(asked, parts).mapInArrow(add_up, packed_schema(TOTAL)).withColumnRenamed("bucket", "g")
    found = rows.groupBy("g").cogroup(totals.groupBy("g")).applyInArrow(summed, "doc_id bigint, n_grams bigint, log_score double")
    return found.withColumn("mean_log_score", F.when(F.col("n_grams") > 0, F.col("log_score") / F.col("n_grams")))


def word_grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Names of the n-grams of every order that end at every word, 0 where none fits, and the document of every word."""
    starts, ends, doc = words(data, offsets)
    word = run_hashes(data, starts, ends)
    names = [mix(word) | np.uint64(1)]
    with np.errstate(over="ignore"):
        for k in range(2, order + 1):
            name = np.zeros(len(word), np.uint64)
            fits = doc[k - 1 :] == doc[: max(len(doc) - k + 1, 0)]
            name[k - 1 :][fits] = mix(names[-1][k - 2 : -1][fits] * PLACE + word[k - 1 :][fits] + np.uint64(k)) | np.uint64(1)
            names.append(name)
    return names, doc


def _counted(waiting: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct names, ascending, and their counts; the list is emptied, as only one copy is to be held."""
    names = np.concatenate([np.empty(0, np.uint64), *waiting])
    waiting.clear()
    names.sort()
    first = np.flatnonzero(np.append(True, names[1:] != names[:-1])[: len(names)])
    return names[first], np.diff(first, append=len(names))


def _totals(key: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of keys, where in it a new one begins, and the sums of each one's counts."""
    order = np.argsort(key, kind="stable")  # which merges the runs that ascend
    sorted_key = key[order]
    first = np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1])[: len(key)])
    return order, first, np.add.reduceat(held[order], first) if len(key) else held


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate([k for k, _ in found])
    order, first, total = _totals(key, np.concatenate([n for _, n in found]))
    return key[order[first]], total


def _held(texts, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of some texts, ascending, and their counts; merged whenever as much again has come."""
    found, waiting, come, size = [], [], 0, 1 << 22
    for _, _, data, offsets in text_slices(texts):
        names = np.concatenate(word_grams(data, offsets, order)[0])
        waiting.append(names[names != 0])
        come += len(waiting[-1])
        if come > size:
            found, come = [_merged([*found, _counted(waiting)])], 0
            size = max(size, len(found[0][0]))
    return _merged([*found, _counted(waiting)]) if found else _counted(waiting)


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in few bytes: as many byte planes as the greatest needs, each compressed on its own."""
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    parts = [pa.compress(np.ascontiguousarray(planes[:, p]), codec="zstd", asbytes=True) for p in range(width)]
    return b"".join([np.array([len(values), width, *map(len, parts)], "<u4").tobytes(), *parts])


def unsqueezed(data: memoryview) -> np.ndarray:
    count, width = (int(v) for v in np.frombuffer(data, "<u4", 2))
    planes, at = np.zeros((count, 8), np.uint8), 8 + 4 * width
    for p, size in enumerate(np.frombuffer(data, "<u4", width, 8)):
        planes[:, p] = np.frombuffer(pa.decompress(data[at : at + size], count, "zstd"), np.uint8)
        at += int(size)
    return planes.reshape(-1).view("<u8")


def _ranges(half: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """First keys of equal ranges of 63 bits, a bucket each, and the bounds of ascending keys in them."""
    first = np.arange(buckets, dtype=np.uint64) * np.uint64((1 << 63) // buckets + 1)
    return first, np.append(np.searchsorted(half, first), len(half))


def _cells(column) -> list[memoryview]:
    data, offsets = unpack(column)
    return [memoryview(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _texts(packs: pa.Table) -> pa.Array:
    """The texts of packed rows, one after another."""
    sizes = [np.asarray(s.values, np.int64) for s in packs.column("sizes")]
    data = [pa.decompress(t, int(s.sum()), "zstd", asbytes=True) for t, s in zip(_cells(packs.column("text")), sizes, strict=True) if s.sum()]
    offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.empty(0, np.int64), *sizes]))])
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(data))])


def _packs(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row per group out of ``(g, doc_id, text)`` rows: ids, bytes of every text and all texts compressed."""
    rows = pa.Table.from_batches(waiting).sort_by("g").combine_chunks()
    g = rows.column("g").to_numpy()
    data, offsets = unpack(rows.column("text"))
    bounds = np.append(np.flatnonzero(np.append(True, g[1:] != g[:-1])), len(g))
    texts = [pa.compress(data[offsets[a] : offsets[b]], codec="zstd", asbytes=True) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    ids, sizes = rows.column("doc_id").combine_chunks(), pa.array(np.diff(offsets), pa.int64())
    ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
    lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), v) for v in (ids, sizes)]
    return pa.RecordBatch.from_arrays([pa.array(g[bounds[:-1]], pa.int32()), *lists, pa.array(texts, pa.binary())], names=["g", "doc_id", "sizes", "text"])


def pack_texts(batches):
    waiting, size = [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(first, SLICE_ROWS)
            waiting.append(part)
            size += len(unpack(part.column(2))[0])
            if size > PACK_BYTES:
                yield _packs(waiting)
                waiting, size = [], 0
    if waiting:
        yield _packs(waiting)


def word_scores(names: list[np.ndarray], doc: np.ndarray, key: np.ndarray, total: np.ndarray, words_in_all: int) -> np.ndarray:
    """Logarithm of the score of every word; ``key`` ascends and has all names."""
    flat = np.stack(names, axis=1).ravel()  # by word, so a stable order by name is one by document below it
    order = np.argsort(flat, kind="stable")
    name, of = flat[order], doc[order // len(names)]
    other = np.append(True, name[1:] != name[:-1])
    firsts = np.flatnonzero(other)
    known = np.where(name[firsts] != 0, total[np.minimum(np.searchsorted(key, name[firsts]), len(key) - 1)], 0)
    everywhere = np.repeat(known, np.diff(np.append(firsts, len(name))))
    other[1:] |= of[1:] != of[:-1]
    sizes = np.diff(np.append(np.flatnonzero(other), len(name)))
    elsewhere = np.empty((len(doc), len(names)), np.int64)
    elsewhere.reshape(-1)[order] = np.where(name != 0, everywhere - np.repeat(sizes, sizes), 0)
    held = np.empty(len(flat), np.int64)
    held[order] = everywhere
    value = np.log(held[:: len(names)] / words_in_all)
    longest = sum((name != 0).astype(np.int64) for name in names)
    value += (longest - 1) * np.log(ALPHA)
    for k in range(2, len(names) + 1):
        seen = np.flatnonzero(elsewhere[:, k - 1] > 0)
        value[seen] = np.log(elsewhere[seen, k - 1] / elsewhere[seen - 1, k - 2]) + (longest[seen] - k) * np.log(ALPHA)
    return value


def score_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = WORDS) -> DataFrame:
    """``doc_id, n_grams, log_score, mean_log_score`` of every row, over words; n_grams are the words scored."""
    if order < 1:
        raise ValueError("order must be 1 or more")
    parts = partitions(docs.sparkSession)
    groups = GROUPS * parts
    rows = docs.select(F.pmod(F.xxhash64(doc_id, text), F.lit(groups)).cast("int").alias("g"), F.col(doc_id).cast("bigint").alias("doc_id"),
                       F.col(text).alias("text"))

    def number(batches):
        for batch in batches:
            n = sum(len(words(data, offsets)[0]) for _, _, data, offsets in text_slices(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    words_in_all = docs.select(text).mapInArrow(number, "n bigint").agg(F.sum("n").alias("n")).head()["n"] or 0

    def ask(group: pa.Table) -> pa.Table:
        key, held = _held(_texts(group), order)
        key >>= np.uint64(1)  # names are odd
        begins, bounds = _ranges(key, groups)
        used = np.flatnonzero(np.diff(bounds))
        keys, counts = [], []
        for bucket in used:
            cell = slice(bounds[bucket], bounds[bucket + 1])
            keys.append(squeezed(np.diff(key[cell], prepend=begins[bucket])))
            counts.append(squeezed(held[cell]))
        return pa.table({
            "bucket": used.astype(np.int32), "g": np.full(len(used), group.column("g")[0].as_py(), np.int32),
            "key": pa.array(keys, pa.binary()), "count": pa.array(counts, pa.binary()),
        })

    def add_up(batches):
        cells = {}  # by bucket, as sent; one bucket at a time is laid out
        for batch in batches:
            for bucket, *cell in zip(*(batch.column(i).to_pylist() for i in (0, 1)), *(_cells(batch.column(i)) for i in (2, 3)), strict=True):
                cells.setdefault(bucket, []).append(cell)
        for bucket in list(cells):
            asking, keys, counts = zip(*cells.pop(bucket), strict=True)
            keys = [np.cumsum(unsqueezed(key), dtype=np.uint64) for key in keys]
            bounds = np.cumsum([0, *map(len, keys)])
            order, first, total = _totals(np.concatenate(keys), np.concatenate([unsqueezed(c) for c in counts]))
            keys, every = None, np.empty(len(order), np.uint64)
            every[order] = np.repeat(total, np.diff(first, append=len(order)))
            for at in range(0, len(asking), 64):  # totals go back in the order asked, without the keys
                part = range(at, min(at + 64, len(asking)))
                sent = [squeezed(every[bounds[i] : bounds[i + 1]]) for i in part]
                yield pa.RecordBatch.from_arrays([pa.array(asking[at : at + 64], pa.int32()), pa.array([bucket] * len(sent), pa.int32()), pa.array(sent, pa.binary())], names=["g", "bucket", "count"])

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = _texts(left)
        key, total = _held(texts, order)
        _, bounds = _ranges(key >> np.uint64(1), groups)
        if len(key):
            for bucket, sent in zip(right.column("bucket").to_pylist(), _cells(right.column("count")), strict=True):
                total[bounds[bucket] : bounds[bucket + 1]] = unsqueezed(sent)
        sums, sizes = [np.empty(0)], [np.empty(0, np.int64)]
        for first, end, data, offsets in text_slices(texts):
            names, doc = word_grams(data, offsets, order)
            value = word_scores(names, doc, key, total, words_in_all) if len(doc) else np.empty(0)
            sums.append(np.bincount(doc, value, minlength=end - first))
            sizes.append(np.bincount(doc, minlength=end - first))
        ids = pa.concat_arrays([pa.array([], pa.int64()), *(ids.values for ids in left.column("doc_id"))])
        return pa.table({"doc_id": ids, "n_grams": np.concatenate(sizes), "log_score": np.concatenate(sums)})

    packs = rows.mapInArrow(pack_texts, "g int, doc_id array<bigint>, sizes array<bigint>, text binary")
    asked = packs.groupBy("g").applyInArrow(ask, "bucket int, g int, key binary, count binary")
    totals = exchange(asked, parts).mapInArrow(add_up, "g int, bucket int, count binary")
    found = packs.groupBy("g").cogroup(totals.groupBy("g")).applyInArrow(summed, "doc_id bigint, n_grams bigint, log_score double")
    return found.withColumn("mean_log_score", F.when(F.col("n_grams") > 0, F.col("log_score") / F.col("n_grams")))
