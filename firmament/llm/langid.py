"""Language identification: a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read pieces of ``PIECE`` bytes of a text, one from the left and one
from the right.  Both states together label every byte with a probability for each language;
the probabilities of a document are the means over all its bytes.  Training is plain
backpropagation through time with Adam, over excerpts of at most ``SAMPLE`` documents per
language (those whose ids hash lowest); every whole text is labelled.

Gates are clipped lines and the candidate state is x / (1 + |x|), which are cheap and differ
little from the usual curves.  Null texts and texts without a letter get ``und`` and score 0, as
does everything if there is no text to learn from.  Ties between languages go to the first by
name.  Repeated rows get equal results; further columns are left as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmament.llm.common import append, text_slices, unpack

SAMPLE = 1_500  # documents per language that a fit sees at most
EXCERPTS, EXCERPT = 8, 64  # pieces of a document that a fit sees, and their bytes
UNITS = 8
PIECE = 128
STEPS, ROWS = 500, 384
PAD = 256  # symbol after the end of a text: it holds the state
UNKNOWN = "und"


def _gate(x: np.ndarray) -> np.ndarray:
    x *= 0.25
    x += 0.5
    return np.clip(x, 0, 1, out=x)


class Layer:
    """One direction; ``table`` (3H, 257) has the input's share of reset, update and candidate."""

    def __init__(self, table: np.ndarray, weights: np.ndarray):
        self.table, self.weights = table, weights
        self.units = weights.shape[1]

    def run(self, symbols: np.ndarray, tape: list | None = None):
        """States (H, B) after every row of ``symbols`` (T, B)."""
        h = self.units
        state = np.zeros((h, symbols.shape[1]), np.float32)
        inner = np.empty((3 * h, symbols.shape[1]), np.float32)
        for row in symbols:
            given = np.take(self.table, row, axis=1)
            np.matmul(self.weights, state, out=inner)
            gates = given[: 2 * h]
            gates += inner[: 2 * h]
            if tape is not None:
                open_gates = np.abs(gates) < 2
            _gate(gates)
            candidate = gates[:h] * inner[2 * h :]
            candidate += given[2 * h :]
            size = np.abs(candidate)
            size += 1
            candidate /= size
            before = state
            state = before - candidate
            state *= gates[h:]
            state += candidate
            if tape is not None:
                tape.append((row, before, gates, open_gates, inner[2 * h :].copy(), candidate, size))
            yield state

    def back(self, tape: list, outer: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and weights, given those of the states."""
        h = self.units
        table, weights = np.zeros_like(self.table.T), np.zeros_like(self.weights)
        carried = np.zeros_like(outer[0])
        for (row, before, gates, open_gates, inner, candidate, size), direct in zip(reversed(tape), reversed(outer), strict=True):
            carried = carried + direct
            reset, update = gates[:h], gates[h:]
            slope = np.empty((3 * h, before.shape[1]), np.float32)
            slope[2 * h :] = carried * (1 - update) / (size * size)
            slope[:h] = slope[2 * h :] * inner * 0.25 * open_gates[:h]
            slope[h : 2 * h] = carried * (before - candidate) * 0.25 * open_gates[h:]
            np.add.at(table, row, slope.T)
            slope[2 * h :] *= reset
            weights += slope @ before.T
            carried = carried * update + self.weights.T @ slope
        return table.T, weights


@dataclass
class Model:
    languages: list[str]
    parameters: dict[str, np.ndarray]

    def layers(self) -> tuple[Layer, Layer]:
        p = self.parameters
        return Layer(p["left_table"], p["left_weights"]), Layer(p["right_table"], p["right_weights"])

    def positions(self, symbols: np.ndarray):
        """Probabilities (L, B) of every row of ``symbols`` (T, B), from the last to the first."""
        left, right = self.layers()
        states = list(left.run(symbols))
        out, bias = self.parameters["out"], self.parameters["bias"][:, None]
        h = left.units
        for t, state in zip(range(len(symbols) - 1, -1, -1), right.run(symbols[::-1]), strict=True):
            value = out[:, :h] @ states[t]
            value += out[:, h:] @ state
            value += bias
            value -= value.max(axis=0)
            np.exp(value, out=value)
            value /= value.sum(axis=0)
            yield t, value

    def pool(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities (documents, languages); a document without bytes has zeros."""
        docs, count = len(offsets) - 1, len(self.languages)
        lengths = np.diff(offsets)
        pieces = -(-lengths // PIECE)
        owner = np.repeat(np.arange(docs), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = offsets[owner] + nth * PIECE
        held = np.minimum(PIECE, offsets[owner + 1] - begin)
        total = np.zeros((docs, count))
        for first in range(0, len(owner), 4096):
            part = slice(first, first + 4096)
            longest = int(held[part].max())
            place = begin[part][None, :] + np.arange(longest)[:, None]
            inside = np.arange(longest)[:, None] < held[part][None, :]
            symbols = np.where(inside, data[np.minimum(place, len(data) - 1)].astype(np.int16), PAD)
            summed = np.zeros((count, symbols.shape[1]), np.float32)
            whole = inside.all(axis=1)
            for t, value in self.positions(symbols):
                if not whole[t]:
                    value *= inside[t]
                summed += value
            for k in range(count):
                total[:, k] += np.bincount(owner[part], summed[k], minlength=docs)
        return total / np.maximum(lengths, 1)[:, None]


def _hold(table: np.ndarray, units: int) -> None:
    """Make the padding symbol keep the state: its update gate is fully shut."""
    table[:, PAD] = 0
    table[units : 2 * units, PAD] = 1e4


def train(symbols: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS, units: int = UNITS) -> Model:
    """Fit to excerpts: ``symbols`` (T, N) and the language number of each of the N."""
    rng, count = np.random.default_rng(11), len(languages)

    def normal(scale, *shape):
        return rng.normal(0, scale, shape).astype(np.float32)

    p = {
        "left_table": normal(0.5, 3 * units, 257), "left_weights": normal(units**-0.5, 3 * units, units),
        "right_table": normal(0.5, 3 * units, 257), "right_weights": normal(units**-0.5, 3 * units, units),
        "out": normal((2 * units) ** -0.5, count, 2 * units), "bias": np.zeros(count, np.float32),
    }
    model = Model(languages, p)
    mean = {k: np.zeros_like(v) for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    by_language = [np.flatnonzero(labels == k) for k in range(count)]
    for step in range(1, steps + 1):
        for side in ("left_table", "right_table"):
            _hold(p[side], units)
        pick = np.concatenate([rng.choice(own, max(1, ROWS // count)) for own in by_language])
        x, y = symbols[:, pick], labels[pick]
        left, right = model.layers()
        tapes: tuple[list, list] = ([], [])
        a, b = list(left.run(x, tapes[0])), list(right.run(x[::-1], tapes[1]))
        grad_a: list = [None] * len(a)
        grad_b: list = [None] * len(b)
        out_grad, bias_grad = np.zeros_like(p["out"]), np.zeros_like(p["bias"])
        inside = x != PAD
        weight = 1 / max(1, int(inside.sum()))
        for t in range(len(x)):
            both = np.concatenate([a[t], b[len(x) - 1 - t]])
            value = p["out"] @ both + p["bias"][:, None]
            value = np.exp(value - value.max(axis=0))
            value /= value.sum(axis=0)
            value[y, np.arange(len(y))] -= 1
            value *= inside[t] * np.float32(weight)
            out_grad += value @ both.T
            bias_grad += value.sum(axis=1)
            down = p["out"].T @ value
            grad_a[t], grad_b[len(x) - 1 - t] = down[:units], down[units:]
        grads = {"out": out_grad, "bias": bias_grad}
        grads["left_table"], grads["left_weights"] = left.back(tapes[0], grad_a)
        grads["right_table"], grads["right_weights"] = right.back(tapes[1], grad_b)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.02 * (1 - step / (steps + 1)) + 0.001
        for k, g in grads.items():
            g = g * np.float32(min(1.0, 1.0 / (norm + 1e-9)))
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            p[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    for side in ("left_table", "right_table"):
        _hold(p[side], units)
    return model


def _excerpts(texts: pa.Array) -> list[pa.Array]:
    data, offsets = unpack(texts)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        span = max(0, int(b - a) - EXCERPT)
        places = sorted({int(a) + span * k // max(1, EXCERPTS - 1) for k in range(EXCERPTS)})
        out.append([data[i : min(i + EXCERPT, int(b))].tobytes() for i in places if i < b])
    return [pa.array(out, pa.list_(pa.binary()))]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE,
        steps: int = STEPS) -> Model | None:
    """Fit to excerpts of at most ``sample`` documents per language; None if there is nothing to learn from."""
    known = docs.select(F.col(doc_id).alias("_id"), F.col(lang).alias("_lang"), F.col(text).alias("_text")).filter(
        F.col("_lang").isNotNull() & F.col("_text").isNotNull() & (F.col("_text") != "")
    )
    counts = {r["_lang"]: r["n"] for r in known.groupBy("_lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for name, n in counts.items():  # a language's rows whose ids hash below this share of all hashes
        share = F.when(F.col("_lang") == name, F.lit(1.1 if n <= sample else sample / n)).otherwise(share)
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.filter(place < share)
    taken, names = append(chosen, "_text", [("_pieces", T.ArrayType(T.BinaryType()))], lambda: _excerpts)
    got = taken.select("_lang", F.col(names[0]).alias("p"), "_id").limit(2 * sample * len(counts)).toArrow()
    languages = sorted(set(got.column(0).to_pylist()))
    if not languages:
        return None
    number = {name: k for k, name in enumerate(languages)}
    rows = [(piece, number[name]) for name, pieces, _ in sorted(zip(*(got.column(k).to_pylist() for k in range(3)), strict=True),
                                                               key=lambda r: (r[0], str(r[2]))) for piece in pieces]
    symbols = np.full((EXCERPT, len(rows)), PAD, np.int16)
    for k, (piece, _) in enumerate(rows):
        symbols[: len(piece), k] = np.frombuffer(piece, np.uint8)
    return train(symbols, np.array([y for _, y in rows]), languages, steps)


def label(docs: DataFrame, model: Model | None, text: str = "text") -> tuple[DataFrame, list[str]]:
    """All rows and columns with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def start():
        own = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            names: list[str | None] = []
            scores: list[np.ndarray] = [np.empty(0)]
            for first, end, data, offsets in text_slices(texts):
                if own is None:
                    names += [UNKNOWN] * (end - first)
                    scores.append(np.zeros(end - first))
                    continue
                shares = own.pool(data, offsets)
                names += [own.languages[k] for k in shares.argmax(axis=1)]
                scores.append(np.clip(shares.max(axis=1), 0, 1))
            return [pa.array(names, pa.string()), pa.array(np.concatenate(scores))]

        return work

    found, (name, score) = append(docs, text, [("lang_pred", T.StringType()), ("score", T.DoubleType())], start)
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return found.withColumns({
        name: F.when(lettered, F.col(name)).otherwise(UNKNOWN), score: F.when(lettered, F.col(score)).otherwise(0.0)
    }), [name, score]
