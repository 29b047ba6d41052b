"""Searches against brute force, with ties, repeats, nulls, non-finite and ragged vectors."""

import collections

import numpy as np
import pytest

from firmament.llm import ann, topk
from firmament.llm.queries import QUERIES
from firmament.llm.vectors import TopLists

SCHEMA = "vec_id bigint, embedding array<float>, score int, rank string"
NAN, INF = float("nan"), float("inf")


def vectors(seed, n, width=12, same=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, width))
    out = [(i, (centre[i % 6] + 0.3 * rng.normal(size=width)).astype(np.float32).tolist()) for i in range(n)]
    fixed = out[0][1]
    return [(i, fixed if i % 3 == 1 and i < 3 * same else v) for i, v in out]


def odd(rows):
    return rows + [(900, None), (901, []), (902, [1.0, None]), (950, [NAN, 1.0]), (951, [INF]), (1000, [0.5, 0.25]), (1050, [0.0] * 12),
                   (None, [1.0] * 12), rows[7], (7, [9.0] * 12)]


@pytest.fixture(scope="module")
def frame(spark):
    rows = odd(vectors(1, 600, same=150))
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(5).cache(), rows


def usable(rows, width=12, zeros=True):
    kept = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        if not zeros and not any(v):
            continue
        kept[i] = min(kept.get(i, v), v)
    ids = sorted(kept)
    full = np.zeros((len(ids), width))
    for k, i in enumerate(ids):
        full[k, : len(kept[i])] = np.float32(kept[i])
    return np.array(ids), full


def best(ids, scores, i, k=5):
    order = np.lexsort((ids, -scores))
    return [(int(ids[j]), scores[j]) for j in order if j != i][:k]


def listed(found):
    got = collections.defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


@pytest.mark.parametrize("small", [False, True])  # small: several query blocks, few first thresholds
def test_topk_equals_brute_force(frame, small, monkeypatch):
    if small:
        for name, value in (("QUERIES", 3), ("HEAD", 4), ("CHUNK", 16), ("SAMPLE", 5)):
            monkeypatch.setattr(topk, name, value)
    table, rows = frame
    ids, full = usable(rows)
    whole = np.floor(256 * full).astype(np.int64)
    got = listed(topk.search(table))
    queries = [k for k, i in enumerate(ids) if i % 50 == 0]
    assert set(got) == {int(ids[k]) for k in queries}
    for k in queries:
        assert got[int(ids[k])] == [(i, int(s)) for i, s in best(ids, whole @ whole[k], k)]


def test_ann_recall_scores_and_order(frame):
    table, rows = frame
    ids, full = usable(rows, zeros=False)
    got, hits, wanted = listed(ann.search(table)), 0, 0
    queries = [k for k, i in enumerate(ids) if i % 50 == 0]
    assert set(got) == {int(ids[k]) for k in queries}
    for k in queries:
        scores = ann.cosine(full, np.broadcast_to(full[k], full.shape))
        true = best(ids, scores, k)
        own = got[int(ids[k])]
        hits, wanted = hits + len({i for i, _ in true} & {i for i, _ in own}), wanted + len(true)
        assert all(abs(scores[np.searchsorted(ids, i)] - s) < 1e-12 for i, s in own)
        assert own == sorted(own, key=lambda r: (-r[1], r[0])) and int(ids[k]) not in dict(own)
    assert hits >= 0.9 * wanted


def test_ann_blocks_change_nothing(frame, monkeypatch):
    table, _ = frame
    want = listed(ann.search(table))
    for name, value in (("LIST_ROWS", 20), ("QUERY_ROWS", 2), ("CHUNK", 8)):
        monkeypatch.setattr(ann, name, value)
    got = listed(ann.search(table))
    shared = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert set(got) == set(want) and shared >= 0.95 * sum(map(len, want.values()))


def test_ann_queries_among_copies_get_all_rows(spark):
    rng = np.random.default_rng(12)
    copied, single = rng.normal(size=(20, 8)), rng.normal(size=(60, 8))
    rows = [(i, (single[i // 50] if i % 50 == 0 else copied[i % 20]).tolist(), 1, "") for i in range(3000)]
    got = listed(ann.search(spark.createDataFrame(rows, SCHEMA)))
    assert len(got) == 60 and {len(own) for own in got.values()} == {5}


def test_few_and_no_rows(spark):
    for search in (topk.search, ann.search):
        assert search(spark.createDataFrame([], SCHEMA)).collect() == []
        assert search(spark.createDataFrame([(0, [1.0, 2.0], 1, "")], SCHEMA)).collect() == []
        two = search(spark.createDataFrame([(0, [1.0, 2.0], 1, ""), (3, [1.0, 1.0], 1, "")], SCHEMA)).collect()
        assert [(r.query_id, r["rank"], r.vec_id) for r in two] == [(0, 1, 3)]


def test_bounds_drop_most_pairs():
    rng = np.random.default_rng(3)
    full = np.floor(256 * rng.normal(size=(4000, 32)) * np.geomspace(1, 0.02, 32))
    ids = np.arange(len(full))
    lists, scored = topk.scan(full[:40], ids[:40], np.full(40, -np.inf), full, ids, topk.rotation(full), 5)
    assert scored < 0.3 * 40 * len(full) and len(lists.query) == 200


def test_scan_reads_few_columns_of_far_vectors():
    rng = np.random.default_rng(4)
    full = rng.normal(size=(3000, 64)) + 4 * rng.normal(size=(30, 64))[np.arange(3000) % 30]
    ids = np.arange(len(full))
    _, read = ann.scan(full[:30], ids[:30], full, ids, ann.rotation(64), 5)
    assert read < 0.6 * 30 * len(full) * 4


def test_top_lists_keep_ties_by_id():
    lists = TopLists(2, 2)
    lists.add(np.array([0, 0, 1]), np.array([1.0, 1.0, 5.0]), np.array([9, 4, 1]))
    lists.add(np.array([0, 1]), np.array([1.0, 7.0]), np.array([2, 8]))
    assert list(zip(lists.query.tolist(), lists.vec.tolist(), strict=True)) == [(0, 2), (0, 4), (1, 8), (1, 1)]
    assert lists.worst.tolist() == [1.0, 5.0]


def embeddings(spark, tmp_path, rows):
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("size", [2.0**20, 2.0**27, 1e200])
def test_topk_query_is_exact_at_any_size(spark, tmp_path, size):
    """Scores above 2^53 are not rounded, and those beyond a long are its nearest end."""
    rng = np.random.default_rng(6)
    vectors = {i: (size * rng.normal(size=7)).tolist() for i in range(120)}
    vectors[7] = vectors[9]
    got = listed(QUERIES["op7_exact_topk"](spark, embeddings(spark, tmp_path, list(vectors.items()))))
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors.items()}
    ends = -(2**63), 2**63 - 1
    for q in (0, 50, 100):
        scores = [(min(max(sum(a * b for a, b in zip(whole[q], v, strict=True)), ends[0]), ends[1]), i) for i, v in whole.items() if i != q]
        assert got[q] == [(i, s) for s, i in sorted(scores, key=lambda r: (-r[0], r[1]))[:5]]


def test_ann_query_finds_tiny_and_huge_vectors(spark, tmp_path):
    rng = np.random.default_rng(7)
    plain = {i: rng.normal(size=6) for i in range(60)}
    sizes = {i: [1e-320, 1e-200, 1.0, 1e200, 1e307][i % 5] for i in plain}
    rows = [(i, (v * sizes[i]).tolist()) for i, v in plain.items()]
    got = listed(QUERIES["op8_adaptive_ann"](spark, embeddings(spark, tmp_path, rows)))
    assert {q: len(own) for q, own in got.items()} == {0: 5, 50: 5}
    for q, own in got.items():
        for i, s in own:
            if 1e-320 not in (sizes[q], sizes[i]):  # those keep few digits
                true = plain[q] @ plain[i] / np.sqrt((plain[q] @ plain[q]) * (plain[i] @ plain[i]))
                assert abs(s - true) < 1e-9
