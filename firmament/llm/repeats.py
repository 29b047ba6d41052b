"""Suffix dedup with a run-length index: removes every byte that an earlier passage already has.

Every whole text counts as UTF-8 bytes.  A byte goes if it is covered by a ``LENGTH``-byte string
that also starts earlier: in a document with a smaller doc_id, or earlier in the same one.

1. *Anchors.*  In each window of ``LENGTH`` bytes the run of ``ANCHOR`` bytes whose hash is least
   is an anchor, so equal windows share an anchor at one offset.  An anchor's context reaches far
   enough to hold all windows around it.  Packed (anchor, context) records are exchanged by
   anchor hash; of records with one context (anchor and 96-bit name) all but the first are
   repeats as a whole, which settles copies and the inside of long passages.
2. *Index.*  Anchors with several contexts, about two per end of a repeated passage, are settled
   on the bytes: their contexts are exchanged by anchor, built into a run-length index in
   blocks, and streamed through it; places whose next ``LENGTH`` bytes start at an earlier origin
   are repeats.
3. *Removal.*  Spans meet their documents again and are cut out.

An anchor that a share of all documents has, a common line, would fill one task.  A sample of at
most ``SAMPLE`` documents names such anchors, which only decides where records travel: their
records are dealt by anchor and context, and their windows are compared by anchor and 96-bit name
and reduced to the first of each before the exchange.  Any other anchor that turns out to have more
contexts than ``crowd``, by default what one index holds, goes the same way after the first exchange,
so no block grows beyond two of them.  Either way the result is the same.

Null and empty texts have nothing to remove.  A null doc_id counts as the smallest.  Rows that
repeat doc_id and text are one document and get the same result; rows that repeat only the
doc_id are ordered by a 64-bit checksum of their texts.  Further columns are kept as they are.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmament.llm.common import (
    SYMBOLS, binary_rows, exchange, fresh, keep, mix, packed, packed_schema, partitions, records, slices, text_slices, unpack,
)
from firmament.llm.runindex import RunIndex

LENGTH = 100
ANCHOR = 48
SAMPLE = 20_000  # documents that name frequent anchors
FREQUENT = 8  # documents of the sample that make an anchor frequent
BLOCK = 1 << 19  # bytes that one index holds
GROUPS = 2  # groups of documents per partition
SPAN, HOT = 2, 1

ENTRY = np.dtype([("a", "<u8"), ("c", "<u8"), ("e", "<u4"), ("doc", "<i8"), ("tag", "<u8"), ("start", "<u4"), ("size", "u1"), ("flag", "u1")])
FOUND = np.dtype([("a", "<u8"), ("doc", "<i8"), ("tag", "<u8"), ("start", "<u4"), ("end", "<u4"), ("kind", "u1")])
CODE = np.uint64((1 << 32) - 1)  # lower half of a tag: Spark's hash of doc_id and text, which also deals the groups
FACTORS = mix(np.arange(501, 540, dtype=np.uint64)) | np.uint64(1)
SECOND = 20  # first factor of the other half of a name
OTHER_SYMBOLS = mix(np.arange(8193, 8449, dtype=np.uint64))


def _slide(value: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        value = pick(value[:-reach], value[reach:])
        reach *= 2
    return pick(value[: len(value) - (width - reach)], value[width - reach :]) if width > reach else value


def _run_hash(data: np.ndarray, width: int, symbols: np.ndarray = SYMBOLS, level: int = 0) -> np.ndarray:
    """Hashes of all runs of ``width`` bytes; ``level`` is the first factor used."""
    out = symbols[data]
    reach = 1
    with np.errstate(over="ignore"):
        while reach < width:
            more = min(reach, width - reach)
            out = out[: len(out) - more] * FACTORS[level] + out[more:]
            reach, level = reach + more, level + 1
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """Document, anchor hash, 64 and 32 bits of the context's name, context start and size of every anchor of a slice."""
    n, wide = len(data), length - ANCHOR
    none = np.empty(0, np.int64)
    if n < length:
        return none, *[none.astype(np.uint64)] * 3, none, none
    lengths = np.diff(offsets)
    finish = np.repeat(offsets[1:], lengths)
    short = _run_hash(data, ANCHOR)
    with np.errstate(over="ignore"):
        order = np.maximum((mix(short) >> np.uint64(32)).astype(np.uint32), 1)
        least = _slide(order, wide + 1, np.minimum)
        least[finish[: len(least)] - np.arange(len(least)) < length] = 0
        edge = np.zeros(wide, np.uint32)
        chosen = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), wide + 1, np.maximum) == order)
        doc = np.searchsorted(offsets, chosen, side="right") - 1
        start = np.maximum(offsets[doc], chosen - wide)
        end = np.minimum(offsets[doc + 1], chosen + length)
        cover, shape = -(-2 * wide // ANCHOR), ((end - start) * 1024 + (chosen - start)).astype(np.uint64)
        halves = []
        for runs, factor in ((short, FACTORS[10]), (_run_hash(data, ANCHOR, OTHER_SYMBOLS, SECOND), FACTORS[SECOND + 10])):
            name = np.zeros(len(chosen), np.uint64)
            for k in range(cover + 1):  # runs at most ANCHOR apart cover the context
                name = mix(name * factor + runs[start + (end - start - ANCHOR) * k // cover])
            halves.append(mix(name + shape))
        return doc, mix(short[chosen]), halves[0], halves[1] >> np.uint64(32), start - offsets[doc], end - start


def _tags(data: np.ndarray, offsets: np.ndarray, code: np.ndarray) -> np.ndarray:
    """64-bit checksums: CRC-32, which texts under one doc_id are ordered by, over ``code``."""
    view = memoryview(np.ascontiguousarray(data))
    own = np.array([zlib.crc32(view[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.uint64)
    return (own << np.uint64(32)) | code.astype(np.uint64)


def _groups(entries: np.ndarray, count: int) -> np.ndarray:
    """Group of the document of every record."""
    return ((entries["tag"] & CODE) % np.uint64(count)).astype(np.int64)


def _ids(array: pa.Array) -> np.ndarray:
    """Ids as integers, null as the smallest."""
    return np.asarray(array.fill_null(np.iinfo(np.int64).min))


def _repeated(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first record of every (anchor, context), and of the others; one place twice is no repeat.

    A 64-bit mix of the keys only gathers records; all 160 bits of anchor and name decide.
    """
    with np.errstate(over="ignore"):
        name = mix(entries["a"] * FACTORS[16] + entries["c"])
    order = np.argsort(name, kind="stable")
    ordered = name[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(order) else np.empty(0, bool)
    alone = head & np.append(head[1:], True) if len(order) else head
    several = order[~alone]
    if not len(several):
        return order[alone], several
    e = entries[several]
    several = several[np.lexsort((e["start"], e["tag"], e["doc"], e["e"], e["c"], e["a"], name[several]))]
    e = entries[several]
    head = np.ones(len(e), bool)
    head[1:] = (e["a"][1:] != e["a"][:-1]) | (e["c"][1:] != e["c"][:-1]) | (e["e"][1:] != e["e"][:-1])
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    same = (e["doc"] == e["doc"][first]) & (e["tag"] == e["tag"][first]) & (e["start"] == e["start"][first])
    return np.concatenate([order[alone], several[head]]), several[~same]


def _joined(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Positions to keep, starts and ends after overlapping spans of a document are joined."""
    if not len(doc):
        return np.empty(0, np.int64), start, end
    order = np.lexsort((start, tag, doc))
    d, t, s, e = doc[order], tag[order], start[order].astype(np.int64), end[order].astype(np.int64)
    other = np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])])
    base = np.cumsum(other) << 34
    reach = np.maximum.accumulate(base + e)
    head = np.concatenate([[True], (base + s)[1:] > reach[:-1]])
    tail = np.append(head[1:], True)
    return order[head], s[head], (reach - base)[tail]


def _spans(entries: np.ndarray) -> np.ndarray:
    """Span records of whole contexts, joined."""
    kept, start, end = _joined(entries["doc"], entries["tag"], entries["start"], entries["start"].astype(np.int64) + entries["size"])
    out = entries[kept].copy()
    out["start"], out["c"], out["flag"], out["a"], out["e"], out["size"] = start, end, SPAN, 0, 0, 0
    return out


def _settle_locally(entries: np.ndarray) -> np.ndarray:
    """First records of a slice, and spans for its other ones."""
    first, rest = _repeated(entries)
    return np.concatenate([entries[first], _spans(entries[rest])])


def _bucket(entries: np.ndarray, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        spread = mix(np.where(entries["flag"] == 0, entries["a"], entries["a"] * FACTORS[17] + entries["c"]))
        spread = np.where(entries["flag"] == SPAN, entries["tag"] & CODE, spread)
    return (spread % np.uint64(count)).astype(np.int64)


def _as_found(entries: np.ndarray, kind: int, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(entries), FOUND)
    for name in ("a", "doc", "tag", "start"):
        out[name] = entries[name]
    out["end"], out["kind"] = ends, kind
    return out


def _settle(batches, groups: int, crowd: int):
    """Spans, and contexts to look at, by group of documents; anchors with over ``crowd`` contexts count as frequent."""
    entries = records(batches, ENTRY)
    if not len(entries):
        return
    spans = entries[entries["flag"] == SPAN]
    entries = entries[entries["flag"] != SPAN]
    first, rest = _repeated(entries)
    spans = np.concatenate([spans, _spans(entries[rest])])
    heads = entries[first]
    hot = heads["flag"] == HOT
    cold = heads[~hot]
    _, number, held = np.unique(cold["a"], return_inverse=True, return_counts=True)
    crowded, cold = cold[held[number] > crowd], cold[(held[number] > 1) & (held[number] <= crowd)]
    many = np.concatenate([heads[hot], crowded])
    found = np.concatenate([
        _as_found(spans, 0, spans["c"]), _as_found(cold, 1, cold["start"] + cold["size"]),
        _as_found(many, 2, many["start"] + many["size"]),
    ])
    if len(found):
        yield packed(found, _groups(found, groups), groups)


def _frequent(docs: DataFrame, total: int, sample: int) -> np.ndarray:
    """Hashes of anchors that many documents of a sample share."""
    share = min(1.0, sample / max(total, 1))
    chosen = docs.filter(F.pmod(F.xxhash64("doc", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20)))

    def seen(batches):
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                doc, name, *_ = anchors(data, offsets)
                if len(doc):
                    pair = np.unique(np.stack([name, doc.astype(np.uint64)]), axis=1)
                    value, held = np.unique(pair[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(held)], names=["a", "n"])

    counts = chosen.select("text").mapInArrow(seen, "a bigint, n bigint").groupBy("a").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") >= FREQUENT).select("a").toArrow()  # at most the sample's anchors / FREQUENT
    return np.sort(rows.column(0).to_numpy().view(np.uint64) if rows.num_rows else np.empty(0, np.uint64))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, sample: int = SAMPLE,
            crowd: int | None = None, readable: bool = False) -> DataFrame:
    """All rows and columns with ``spans`` (removed byte ranges) and ``kept`` (the other bytes).

    With ``readable``, ``kept`` is a string: a character that lost some of its bytes goes as a whole.
    """
    if not 2 * ANCHOR <= length <= 150:
        raise ValueError("length must be between 96 and 150 bytes")
    spark = docs.sparkSession
    parts = partitions(spark)
    groups, wide = GROUPS * parts, 2 * length - ANCHOR
    crowd = BLOCK // wide if crowd is None else crowd
    code = fresh("code", docs.columns)
    group = fresh("g", [*docs.columns, code])
    ids = F.col(doc_id).cast("bigint")
    dealt = docs.withColumn(code, F.xxhash64(ids, F.col(text)).bitwiseAND(F.lit(int(CODE)).cast("bigint")))
    dealt = dealt.withColumn(group, F.pmod(code, F.lit(groups)).cast("int"))
    narrow = dealt.select(F.col(group).alias("g"), ids.alias("doc"), F.col(text).alias("text"), F.col(code).alias("code"))
    frequent = spark.sparkContext.broadcast(_frequent(narrow, docs.select(doc_id).count(), sample))

    def gather(batches):
        common = frequent.value
        for batch in batches:
            doc_ids, codes = _ids(batch.column(1)), np.asarray(batch.column(3))
            for first, end, data, offsets in text_slices(batch.column(2)):
                doc, a, c, e, start, size = anchors(data, offsets, length)
                if not len(doc):
                    continue
                entries = np.empty(len(doc), ENTRY)
                entries["a"], entries["c"], entries["e"], entries["start"], entries["size"] = a, c, e, start, size
                entries["doc"], entries["tag"] = doc_ids[first + doc], _tags(data, offsets, codes[first:end])[doc]
                place = np.minimum(np.searchsorted(common, a), max(len(common) - 1, 0))
                entries["flag"] = (common[place] == a) * HOT if len(common) else 0
                entries = _settle_locally(entries)
                yield packed(entries, _bucket(entries, groups), groups)

    met = exchange(narrow.mapInArrow(gather, packed_schema(ENTRY)), parts)
    found = keep(met.mapInArrow(lambda b: _settle(b, groups, crowd), packed_schema(FOUND)), "repeats-found")

    bodied = packed_schema(ENTRY) + ", body binary"

    def extract(left: pa.Table, right: pa.Table) -> pa.RecordBatch:
        wanted = records([right], FOUND) if right.num_rows else np.empty(0, FOUND)
        wanted = wanted[wanted["kind"] > 0]
        if not len(wanted) or not left.num_rows:
            return _with_bodies(np.empty(0, ENTRY), np.empty((0, wide), np.uint8), groups)
        doc_ids, data, offsets, tags = _rows(left, "doc", "text", "code")
        row = _lookup(doc_ids, tags, wanted)
        begin = offsets[row] + wanted["start"]
        size = (wanted["end"] - wanted["start"]).astype(np.int64)
        cold = wanted["kind"] == 1
        out = _copy(wanted[cold])
        out["size"] = size[cold]
        body = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(wide, np.uint8)]), wide)[begin[cold]]
        many = np.maximum(size[~cold] - length + 1, 0)
        origin = np.repeat(np.arange(len(many)), many)
        shift = np.arange(len(origin)) - np.repeat(np.cumsum(many) - many, many)
        windows = _copy(wanted[~cold][origin])
        windows["start"] += shift.astype(np.uint32)
        windows["size"], windows["flag"] = length, HOT
        windows["c"], windows["e"] = _window_names(data, begin[~cold][origin] + shift, length)
        return _with_bodies(np.concatenate([_settle_locally(windows), out]), body, groups)

    open_groups = found.withColumnRenamed("bucket", "g")
    segments = narrow.groupBy("g").cogroup(open_groups.groupBy("g")).applyInArrow(
        lambda left, right: pa.Table.from_batches([extract(left, right)]), bodied
    )

    def compare(batches):
        batches = list(batches)
        both = records(batches, ENTRY)
        bodies = [unpack(b.column(b.schema.get_field_index("body")))[0] for b in batches]
        body = (np.concatenate(bodies) if bodies else np.empty(0, np.uint8)).reshape(-1, wide)
        spans, windows = both[both["flag"] == SPAN], both[both["flag"] == HOT]
        spans = np.concatenate([spans, _spans(windows[_repeated(windows)[1]]), *_indexed(both[both["flag"] == 0], body, length)])
        if len(spans):
            yield packed(_as_found(spans, 0, spans["c"]), _groups(spans, groups), groups)

    settled = keep(exchange(segments, parts).mapInArrow(compare, packed_schema(FOUND)), "repeats-settled")

    names = [fresh("spans", docs.columns), fresh("kept", docs.columns)]
    schema = T.StructType([*docs.schema.fields,
                           T.StructField(names[0], T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                                                              T.StructField("end", T.IntegerType())]))),
                           T.StructField(names[1], T.StringType() if readable else T.BinaryType())])
    columns = list(docs.columns)
    lower = [c.lower() for c in columns]
    id_name, text_name = columns[lower.index(doc_id.lower())], columns[lower.index(text.lower())]

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        spans = records([right], FOUND) if right.num_rows else np.empty(0, FOUND)
        return _removed(left, spans[spans["kind"] == 0], id_name, text_name, code, columns, names, readable)

    every = found.unionByName(settled).withColumnRenamed("bucket", group)
    return dealt.groupBy(group).cogroup(every.groupBy(group)).applyInArrow(remove, schema)


def _copy(wanted: np.ndarray) -> np.ndarray:
    out = np.zeros(len(wanted), ENTRY)
    for name in ("a", "doc", "tag", "start"):
        out[name] = wanted[name]
    return out


def _with_bodies(entries: np.ndarray, body: np.ndarray, groups: int) -> pa.RecordBatch:
    """Packed records, with the bytes of those that carry no flag, in their order."""
    bucket = _bucket(entries, groups)
    rows, own = packed(entries, bucket, groups), bucket[entries["flag"] == 0]
    used = np.asarray(rows.column(0)).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=groups)[used])])
    column = binary_rows(body[np.argsort(own, kind="stable")].reshape(-1), bounds * body.shape[1])
    return pa.RecordBatch.from_arrays([*rows.columns, column], names=[*rows.schema.names, "body"])


def _rows(left: pa.Table, doc_id: str, text: str, code: str):
    ids = left.column(doc_id).combine_chunks()
    doc_ids = _ids(ids.cast(pa.int64()))
    data, offsets = unpack(left.column(text))
    return doc_ids, data, offsets, _tags(data, offsets, np.asarray(left.column(code)))


def _lookup(doc_ids: np.ndarray, tags: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Row of the document of every record."""
    row = {(d, t): i for i, (d, t) in enumerate(zip(doc_ids.tolist(), tags.tolist(), strict=True))}
    return np.array([row[d, t] for d, t in zip(wanted["doc"].tolist(), wanted["tag"].tolist(), strict=True)], np.int64)


def _window_names(data: np.ndarray, begin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of the names of windows."""
    name, other = np.zeros(len(begin), np.uint64), np.zeros(len(begin), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(0, length, 8):
            part = np.zeros(len(begin), np.uint64)
            for k in range(j, min(j + 8, length)):
                part = (part << np.uint64(8)) | data[begin + k].astype(np.uint64)
            name = mix(name * FACTORS[18] + part)
            other = mix((other ^ part) * FACTORS[SECOND + 18])
    return name, other >> np.uint64(32)


def _indexed(segments: np.ndarray, body: np.ndarray, length: int) -> list[np.ndarray]:
    """Span records of what the index finds, block by block; the contexts of an anchor stay together."""
    order = np.argsort(segments["a"], kind="stable")
    segments = segments[order]
    out = []
    start = 0
    wide = body.shape[1]
    while start < len(segments):
        end = min(len(segments), start + max(1, BLOCK // wide))
        if end < len(segments):
            end = int(np.searchsorted(segments["a"], segments["a"][end - 1], side="right"))
        block, rows = segments[start:end], body[order[start:end]]
        start = end
        size = block["size"].astype(np.int64)
        inside = np.arange(wide)[None, :] < size[:, None]
        pair = np.empty(len(block), [("doc", "<i8"), ("tag", "<u8")])
        pair["doc"], pair["tag"] = block["doc"], block["tag"]
        rank = np.unique(pair, return_inverse=True)[1].reshape(-1).astype(np.int64)
        place = (rank[:, None] << 32) + block["start"].astype(np.int64)[:, None] + np.arange(wide)[None, :]
        origins = place[inside]
        hits = np.flatnonzero(RunIndex(rows[inside], size, origins, length).earlier_matches(origins))
        if not len(hits):
            continue
        owner = np.repeat(np.arange(len(block)), size)[hits]
        shift = hits - (np.cumsum(size) - size)[owner]
        spans = np.zeros(len(hits), ENTRY)
        for name in ("doc", "tag"):
            spans[name] = block[name][owner]
        spans["start"], spans["size"] = block["start"][owner] + shift, length
        out.append(_spans(spans))
    return out


def _readable(kept: pa.Array) -> pa.Array:
    """The bytes as text, without those that are no whole character."""
    data, offsets = unpack(kept)
    body = data.tobytes()
    return pa.array([body[a:b].decode("utf-8", "ignore") for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())


def _removed(left: pa.Table, spans: np.ndarray, doc_id: str, text: str, code: str, columns: list[str], names: list[str],
             readable: bool = False) -> pa.Table:
    """The documents of a group with their spans and what is kept of them."""
    doc_ids, data, offsets, tags = _rows(left, doc_id, text, code)
    kept, start, end = _joined(spans["doc"], spans["tag"], spans["start"], spans["end"])
    by_doc: dict[tuple[int, int], list[int]] = {}
    for i, (d, t) in enumerate(zip(spans["doc"][kept].tolist(), spans["tag"][kept].tolist(), strict=True)):
        by_doc.setdefault((d, t), []).append(i)
    listed, parts = [], []
    for first, last in slices(offsets):
        base, size = offsets[first], int(offsets[last] - offsets[first])
        removed = np.zeros(size + 1, np.int32)
        for i in range(first, last):
            mine = by_doc.get((int(doc_ids[i]), int(tags[i])), [])
            listed.append([{"start": int(start[k]), "end": int(end[k])} for k in mine])
            for k in mine:
                removed[offsets[i] - base + start[k]] += 1
                removed[offsets[i] - base + end[k]] -= 1
        stays = np.cumsum(removed[:-1]) == 0
        before = np.concatenate([[0], np.cumsum(stays)])
        kept_rows = binary_rows(data[base : base + size][stays], before[offsets[first : last + 1] - base])
        parts.append(_readable(kept_rows) if readable else kept_rows)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    arrays = [left.column(c) for c in columns] + [pa.array(listed, kind), pa.chunked_array(parts, pa.string() if readable else pa.binary())]
    return pa.table(arrays, names=[*columns, *names])
