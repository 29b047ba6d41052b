"""Quality classifier: naive Bayes support vectors.

Indicators of hashed n-grams (runs of four bytes, and runs of one to three word shapes) are
scaled by the log ratio of their counts in the two classes.  A linear model with hinge loss is
fitted to them by dual coordinate descent, and a logistic curve, fitted to rows kept aside,
turns its margins into scores.

The fit sees at most ``SAMPLE`` labelled rows, those whose ids hash lowest, and of these, in the same
order, as many as hold ``VOLUME`` features together (256 MB on the driver); all documents are scored,
over their whole texts.  Null and empty texts have no n-gram and get the score of the
bias.  Without labelled rows of both classes every score is the share of label 1 (0.5 without
any).  Several labels of one document count as the lowest.  Of rows that repeat a doc_id the fit sees the
text that hashes lowest.  Repeated rows get equal scores; further columns are left as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmament.llm.common import append, keep, mix, run_hashes, text_slices, unpack, words

SAMPLE = 8_000  # labelled rows at most that a fit sees
VOLUME = 1 << 26  # features at most that these rows hold together
BITS = 18
ASIDE = 4  # every fourth sampled row fits the curve instead of the plane
EPOCHS = 12
COST = 1.0

_CLASS = np.zeros(256, np.uint8)  # bit 0 upper, 1 lower, 2 digit, 3 other ASCII, 4 beyond ASCII
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 1, 2, 4
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 8
_CLASS[128:] = 16


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(document, hash) of the runs of one to three word shapes."""
    kinds = _CLASS[data]
    shape = np.zeros(len(starts), np.uint64)
    for bit in range(5):
        total = np.concatenate([[0], np.cumsum((kinds >> bit) & 1, dtype=np.int64)])
        held = total[ends] - total[starts]
        shape |= (np.minimum(held, 2).astype(np.uint64)) << np.uint64(2 * bit)
    shape |= kinds[starts].astype(np.uint64) << np.uint64(10)
    tail = data[ends - 1]
    shape |= np.where(kinds[ends - 1] == 8, tail, 0).astype(np.uint64) << np.uint64(16)
    name = run_hashes(data, starts, ends)
    for back in (1, 2):
        same = np.zeros(len(name), bool)
        same[back:] = (name[back:] == name[:-back]) & (doc[back:] == doc[:-back])
        shape |= same.astype(np.uint64) << np.uint64(23 + back)
    found = []
    with np.errstate(over="ignore"):
        value = mix(shape)
        sized = mix(shape + (np.minimum(ends - starts, 20).astype(np.uint64) << np.uint64(32)))
        found.append((doc, sized))
        run = value.copy()
        for n in (1, 2):
            whole = doc[n:] == doc[: len(doc) - n] if len(doc) > n else np.zeros(0, bool)
            run = mix(run[: len(run) - 1] * np.uint64(31) + value[n:]) if len(run) > 1 else run[:0]
            found.append((doc[: len(whole)][whole], run[whole] + np.uint64(n)))
    return found


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs of a slice, in order."""
    keys = []
    n, docs = len(data), len(offsets) - 1
    width = np.uint64(64 - BITS)
    if n >= 4:
        wide = data.astype(np.uint32)
        code = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
        doc = np.repeat(np.arange(docs, dtype=np.uint32), np.diff(offsets))
        inside = doc[:-3] == doc[3:]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        keys.append(((doc[:-3] << np.uint32(BITS)) | code)[inside])
    starts, ends, owner = words(data, offsets)
    if len(starts):
        for doc, value in _shapes(data, starts, ends, owner):
            keys.append((doc.astype(np.uint32) << np.uint32(BITS)) | (value >> width).astype(np.uint32))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key = np.sort(np.concatenate(keys))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return (key >> np.uint32(BITS)).astype(np.int64), (key & np.uint32((1 << BITS) - 1)).astype(np.int64)


@dataclass
class Model:
    """``ratio``: log count ratios; ``plane``: weights of the scaled indicators; ``curve``: slope and shift."""

    ratio: np.ndarray
    plane: np.ndarray
    bias: float
    curve: tuple[float, float]
    prior: float | None = None

    def score(self, doc: np.ndarray, feature: np.ndarray, docs: int) -> np.ndarray:
        if self.prior is not None:
            return np.full(docs, self.prior)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * self.margin(doc, feature, docs) + self.curve[1], -40, 40)))

    def margin(self, doc: np.ndarray, feature: np.ndarray, docs: int) -> np.ndarray:
        length = np.sqrt(np.bincount(doc, self.ratio[feature] ** 2, minlength=docs))
        dot = np.bincount(doc, self.ratio[feature] * self.plane[feature], minlength=docs)
        return dot / np.where(length > 0, length, 1) + self.bias


def train(rows: list[tuple[np.ndarray, int]]) -> Model:
    """Fit a model to (features, label) rows."""
    labels = np.array([y for _, y in rows], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(1), np.zeros(1), 0.0, (1.0, 0.0), float(labels.mean()) if len(labels) else 0.5)
    size = 1 << BITS
    fit = np.arange(len(rows)) % ASIDE != 0
    if len(set(labels[fit].tolist())) < 2 or len(set(labels[~fit].tolist())) < 2:
        fit[:] = True
    counts = [np.ones(size), np.ones(size)]
    for i in np.flatnonzero(fit):
        counts[labels[i]][rows[i][0]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    sign = np.where(labels == 1, 1.0, -1.0)
    length = np.array([np.sqrt((ratio[f] ** 2).sum()) or 1.0 for f, _ in rows])
    plane, bias = np.zeros(size), 0.0

    def scaled(i):
        return ratio[rows[i][0]] / length[i]

    members = np.flatnonzero(fit)
    share = {c: len(members) / (2 * max(1, (labels[members] == c).sum())) for c in (0, 1)}
    cost = np.array([COST * share[y] for y in labels])
    dual, rng = np.zeros(len(rows)), np.random.default_rng(7)
    norm = np.array([(scaled(i) ** 2).sum() + 1 for i in range(len(rows))])
    for _ in range(EPOCHS):
        for i in rng.permutation(members):
            f, x, y = rows[i][0], scaled(i), sign[i]
            slope = y * (plane[f] @ x + bias) - 1
            new = min(max(dual[i] - slope / norm[i], 0.0), cost[i])
            if new != dual[i]:
                step = (new - dual[i]) * y
                plane[f] += step * x
                bias += step
                dual[i] = new
    model = Model(ratio, plane, bias, (1.0, 0.0))
    held = np.flatnonzero(~fit) if not fit.all() else members
    margin = np.array([plane[rows[i][0]] @ scaled(i) + bias for i in held])
    model.curve = logistic(margin, labels[held].astype(float))
    return model


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the margins, by Newton steps with a small ridge."""
    up = label.sum()
    target = np.where(label > 0, (up + 1) / (up + 2), 1 / (len(label) - up + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        h = np.array([[(w * margin * margin).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-3), float(b)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE, volume: int = VOLUME) -> Model:
    """Fit to at most ``sample`` labelled documents with at most ``volume`` features, those whose ids hash lowest."""
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    single = rows.groupBy("_id", "_label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    found, names = append(single, "_text", [("_features", T.BinaryType())], lambda: _feature_bytes)
    kept = keep(found.select("_id", "_label", F.xxhash64("_id").alias("_order"), F.col(names[0]).alias("_features")), "quality-sample")
    sizes = kept.select("_order", (F.octet_length("_features") / 4).cast("bigint").alias("n")).toArrow().sort_by("_order")
    within = np.cumsum(sizes.column("n").to_numpy()) <= volume
    if not within.all():
        kept = kept.filter(F.col("_order") < int(sizes.column("_order")[int(np.argmin(within))].as_py()))
    got = kept.select("_id", "_label", "_features").toArrow()
    flat, offsets = unpack(got.column(2))
    labelled = got.column(1).to_pylist()
    order = np.argsort(got.column(0).to_numpy(), kind="stable")
    return train([(flat[offsets[i] : offsets[i + 1]].view(np.int32), labelled[i]) for i in order.tolist()])


def _feature_bytes(texts: pa.Array) -> list[pa.Array]:
    out: list[bytes] = []
    for start, end, data, offsets in text_slices(texts):
        doc, feature = features(data, offsets)
        cuts = np.searchsorted(doc, np.arange(end - start + 1))
        flat = feature.astype(np.int32)
        out += [flat[cuts[i] : cuts[i + 1]].tobytes() for i in range(end - start)]
    return [pa.array(out, pa.binary())]


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, list[str]]:
    """All rows and columns with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 x 2^BITS numbers

    def start():
        own = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            out = [np.empty(0)]
            for first, end, data, offsets in text_slices(texts):
                doc, feature = features(data, offsets)
                out.append(own.score(doc, feature, end - first))
            value = np.concatenate(out)
            return [pa.array(value), pa.array((value >= 0.5).astype(np.int32))]

        return work

    return append(docs, text, [("score", T.DoubleType()), ("predicted", T.IntegerType())], start)
