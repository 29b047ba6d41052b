"""Operators on documents against brute force, with nulls, empty and long texts, ties and repeats."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmament.llm import bytebpe, jaccard, langid, licenses, lm, packing, quality, repeats
from firmament.llm.common import slices, unpack
from firmament.llm.runindex import RunIndex
from firmament.llm.wordbpe import WordEncoder, default_path

SCHEMA = "doc_id bigint, text string, score double, spans string"  # two columns clash with results


def prose(rng, n, words="the of and tion re er an in house tree water stone light über façade niño".split()):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(3, 120)) for _ in range(40)]
    shared = prose(rng, 40)
    texts += [texts[0], texts[0], texts[1] + " " + shared, shared + "\n" + texts[2], shared, "a" * 400, "ab " * 200, "ab " * 170]
    texts += [None, "", "   ", "12 34 !?", "é" * 90, prose(rng, 6000), texts[3][:-4] + "tail"]
    found = [(i * 3 + 1, t, 0.5, "x") for i, t in enumerate(texts)]
    rng.shuffle(found)
    return [*found, found[5], (None, texts[4], 0.1, None), (None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- packing


def test_sequences_have_little_padding():
    """Also where pieces are short; no more than one sequence in a hundred beyond the bound, or beyond best fit."""
    assert sum(packing.cutting_stock({1: 20_000}, 2048).copies) == 10
    rng = random.Random(9)
    for longest in (12, 60, 700, 2047):
        counts = collections.Counter(rng.randint(1, longest) for _ in range(4000))
        least = sum(s * n for s, n in counts.items()) / 2048
        plan = packing.cutting_stock(dict(counts), 2048)
        used = collections.Counter()
        for items, copies in zip(plan.items, plan.copies, strict=True):
            for s, n in items.items():
                used[s] += n * copies
        plain: list[packing.Group] = []
        packing._best_fit(dict(counts), 2048, plain)
        assert used == counts and sum(plan.copies) <= 1.01 * max(least, sum(g.copies for g in plain)) + 1


def test_cutting_stock_uses_every_piece_once():
    rng = random.Random(1)
    for room in (16, 64):
        counts = collections.Counter(rng.randint(1, room) for _ in range(500))
        plan = packing.cutting_stock(dict(counts), room)
        used = collections.Counter()
        for items, copies in zip(plan.items, plan.copies, strict=True):
            assert sum(s * n for s, n in items.items()) <= room
            for s, n in items.items():
                used[s] += n * copies
        assert used == counts
        least = sum(s * n for s, n in counts.items()) / room
        assert sum(plan.copies) <= least * 1.05 + 2


def test_cutting_stock_ends_on_many_demands():
    """Small demands make the linear program degenerate; it must end and stay near the bound."""
    rng = random.Random(6)
    for trial in range(25):
        n = rng.choice([20, 60, 150, 400])
        counts = collections.Counter(min(256, max(1, int(rng.lognormvariate(4, 0.9)))) for _ in range(n))
        plan = packing.cutting_stock(dict(counts), 256)
        used = collections.Counter()
        for items, copies in zip(plan.items, plan.copies, strict=True):
            for s, k in items.items():
                used[s] += k * copies
        assert used == counts
        assert sum(plan.copies) <= sum(s * k for s, k in counts.items()) / 256 * 1.06 + 2


def test_cutting_stock_edges():
    assert packing.cutting_stock({}, 8).copies == []
    assert packing.cutting_stock({8: 5}, 8).copies == [5]
    assert sum(packing.cutting_stock({1: 17}, 8).copies) == 3


def test_pack_places_every_id_once(docs, rows):
    got = packing.pack(docs).collect()
    encoder = WordEncoder(default_path("word_bpe_49k.json"))
    want = collections.Counter()
    for doc, text, *_ in rows:
        ids = [*encoder.library.encode(text or "", add_special_tokens=False).ids, packing.END]
        for start in range(0, len(ids), packing.CAPACITY):
            own = ids[start : start + packing.CAPACITY]
            want[doc, start, tuple(own), len(ids)] += 1
    assert collections.Counter((r.doc_id, r.start, tuple(r.ids), r.doc_tokens) for r in got) == want
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) for r in got)
    by_sequence = collections.defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_pack_empty_table(empty):
    assert packing.pack(empty).collect() == []


def test_word_encoder_equals_library():
    encoder, rng = WordEncoder(default_path("word_bpe_49k.json")), random.Random(2)
    parts = ["a", "Zürich", " ", "  ", "\n", "\t", "'s", "'ll", "'", "12", "²", "½", "!", "_", "<|endoftext|>", "<|", "中文", "́", "🙂",
             "İ", "ǅ", "\x1c", "\x85", "\x00", "ª", "א", "۳", "Σ", "ς", "“", "€", "ſ", " ", "a" * 80]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids, text


# ---- byte-level BPE


def test_byte_codec_equals_library():
    from tokenizers import Tokenizer

    path = default_path(bytebpe.VOCABULARY)
    codec, library, rng = bytebpe.ByteCodec(path), Tokenizer.from_file(path), random.Random(3)
    parts = ["a", "Zürich", " ", "  ", "\n", "\t", "\r\n", "'s", "'ll", "'", "12", "²", "½", "!", "_", "<|endoftext|>", "<|", "中文", "́",
             "🙂", "İ", "\x1c", "\x85", "\x0b", "\x00", "ª", "א", "۳", "Σ", "“", "€", " ", "​", "x" * 90]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        ids = codec.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_forced_pairs_are_cuts_no_token_crosses():
    codec = bytebpe.ByteCodec(default_path(bytebpe.VOCABULARY))
    for token in codec.table:
        assert codec.fragments(token) == [token] or token == b"<|endoftext|>"
    a, b = sorted(codec.forced)[0]
    assert codec.fragments(bytes([a, b])) == [bytes([a]), bytes([b])]


def test_bpe_roundtrip_of_a_table(docs, empty, rows):
    encoded, (ids, same) = bytebpe.encode(docs, check=True)
    decoded, text = bytebpe.decode(encoded, ids)
    assert decoded.filter(F.col(same) != F.col(text)).isEmpty()
    got = decoded.select("doc_id", "text", text).collect()
    assert len(got) == len(rows) and all(r[2] == (r[1] or "") for r in got)
    assert bytebpe.encode(empty)[0].collect() == []


# ---- suffix dedup


def brute_repeats(rows, length=100):
    """(removed runs, kept bytes) by (doc_id, text): rows that repeat both are one document."""
    seen, found = set(), {}
    order = {(d if d is not None else -(2**63), zlib.crc32((t or "").encode())): (d, t) for d, t, *_ in rows}
    for key in sorted(order):
        doc, text = order[key]
        body = (text or "").encode()
        gone = [False] * len(body)
        for i in range(len(body) - length + 1):
            window = body[i : i + length]
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        runs = [[i, i] for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1])]
        for run in runs:
            while run[1] < len(gone) and gone[run[1]]:
                run[1] += 1
        found[doc, text] = ([tuple(r) for r in runs], bytes(b for b, g in zip(body, gone, strict=True) if not g))
    return found


@pytest.mark.parametrize("frequent", [8, 1])  # with 1 every anchor takes the way of frequent ones
def test_repeats_equal_brute_force(docs, rows, frequent, monkeypatch):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    cut = repeats.repeats(docs)
    spans, kept = cut.columns[-2:]
    assert (spans, kept) == ("spans_", "kept")
    want = brute_repeats(rows)
    got = cut.collect()
    assert len(got) == len(rows)
    for r in got:
        runs, body = want[r.doc_id, r.text]
        assert [(s.start, s.end) for s in r[spans]] == runs and bytes(r[kept]) == body, (r.doc_id, (r.text or "")[:50])


@pytest.mark.parametrize("crowd", [0, None])  # with 0 every anchor's windows are dealt by name
def test_repeats_of_an_anchor_in_many_contexts(spark, crowd):
    """A line of 60 bytes between ever other words fills more contexts than one index holds; no sample names it."""
    rng, line = np.random.default_rng(3), "the line that all of these files hold is sixty bytes long ok"
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnop"), (4_000, 12))]
    rows = []
    for i in range(4_000):
        a, b, c, d, e, f = (words[j] for j in rng.integers(0, len(words), 6))
        rows.append((i, f"{a} {b} {c} {line} {d} {e} {f}"))
        if i % 500 == 0:
            rows.append((10_000 + i, f"{f} {b} {c} {line} {d} {e} {a} {line}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_repeats(rows)
    assert sum(len(runs) > 0 for runs, _ in want.values()) >= 8
    for r in repeats.repeats(docs, sample=0, crowd=crowd).collect():
        runs, body = want[r.doc_id, r.text]
        assert [(s.start, s.end) for s in r.spans] == runs and bytes(r.kept) == body, r.doc_id


def test_repeats_need_the_whole_name():
    """Records that agree in anchor and half of the name are different contexts."""
    entries = np.zeros(4, repeats.ENTRY)
    entries["a"], entries["c"], entries["e"], entries["doc"] = 7, 9, [1, 2, 1, 3], [4, 3, 2, 1]
    first, rest = repeats._repeated(entries)
    assert sorted(first.tolist()) == [1, 2, 3] and rest.tolist() == [0]


def test_texts_with_one_crc_are_told_apart(spark):
    """Rows without doc_id whose texts share their CRC-32 get the spans of their own texts."""
    seen = {}
    for i in range(400_000):
        text = "%x" % (i * 2_654_435_761)
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        if other != text:
            break
    assert zlib.crc32(text.encode()) == zlib.crc32(other.encode())
    shared = "and now for the passage of over one hundred bytes that the second of the two rows below shares with a longer third one"
    tail = shared[:118]
    rows = [(None, text + tail), (None, other + tail), (5, shared)]
    assert zlib.crc32(rows[0][1].encode()) == zlib.crc32(rows[1][1].encode())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text): (bytes(r.kept), len(r.spans)) for r in repeats.repeats(docs).collect()}
    whole = [got[None, t] for t in (text + tail, other + tail)]
    assert sorted(n for _, n in whole) == [0, 1] and got[5, shared][1] == 1


def test_repeats_as_text_drop_characters_cut_in_two(spark):
    passage = "".join(chr(0x430 + k * 7 % 32) for k in range(80))
    rows = [(1, "é" + passage + "а"), (2, "ы" + passage + "ж"), (3, None), (4, "")]  # both last ones begin with one byte
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: bytes(r.kept) for r in repeats.repeats(docs).collect()}[2] == "ы".encode() + "ж".encode()[1:]
    got = {r.doc_id: r.kept for r in repeats.repeats(docs, readable=True).collect()}
    assert got == {1: rows[0][1], 2: "ы", 3: "", 4: ""}


def test_repeats_empty_table(empty):
    assert repeats.repeats(empty).collect() == []


def test_run_index_equals_brute_force():
    rng = np.random.default_rng(0)
    for trial in range(120):
        length = int(rng.integers(1, 20))
        base = rng.integers(0, 3 if trial % 2 else 256, 300).astype(np.uint8)
        own = [base[a : a + n] for a, n in zip(rng.integers(0, 250, 5), rng.integers(1, 45, 5), strict=True)]
        sizes, data = np.array([len(x) for x in own]), np.concatenate(own)
        origins = rng.permutation(len(data)) if trial % 3 == 0 else np.arange(len(data))
        ends, first = np.repeat(np.cumsum(sizes), sizes), {}
        for i in range(len(data)):
            if i + length <= ends[i]:
                key = data[i : i + length].tobytes()
                first[key] = min(first.get(key, 10**9), origins[i])
        want = [i + length <= ends[i] and first[data[i : i + length].tobytes()] < origins[i] for i in range(len(data))]
        assert RunIndex(data, sizes, origins, length).earlier_matches(origins).tolist() == want


# ---- n-gram Jaccard join


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        count, rows = jaccard.bands(threshold)
        assert 1 - (1 - threshold**rows) ** count >= jaccard.RECALL or rows == 1


def brute_links(rows, n=5, threshold=0.8):
    sets = []
    for doc, text, *_ in rows:
        w = (text or "").lower().split()
        own = {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({" ".join(w)} if w else set())
        sets.append((doc, frozenset(own)))
    links, parent = collections.Counter(), {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and len(s & t) >= threshold * len(s | t):
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return links, {d: root(d) for d in parent}


def near_rows(seed, groups=6, members=7):
    rng, found = random.Random(seed), []
    for g in range(groups):
        base = prose(rng, 90, [f"w{k}" for k in range(400)]).split()
        for m in range(members):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = f"z{rng.random()}"
            found.append((g * 100 + m, " ".join(own), None, None))
    return found


def test_join_equals_brute_force(spark, docs, rows, empty, monkeypatch):
    for block in (1024, 3):  # three: buckets are cut into blocks
        monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
        for frame, own in ((docs, rows), (spark.createDataFrame(near := near_rows(7), SCHEMA), near)):
            links, classes = brute_links(own)
            got = jaccard.join(frame).collect()
            assert len(got) == len(own)
            repeated = collections.Counter(d for d, *_ in own)
            for r in got:
                if r.doc_id is None:
                    assert r.class_id is None and r.n_links == 0
                else:
                    assert r.class_id == classes[r.doc_id]
                    assert r.n_links == links[r.doc_id] // (repeated[r.doc_id] if repeated[r.doc_id] > 1 else 1), r
    assert jaccard.join(empty).collect() == []


def test_join_counts_links_of_a_repeated_row_once(spark):
    words = [f"w{i}" for i in range(100)]
    text, close = " ".join(words), " ".join([*words, "end"])
    for near in (close, " ".join([*words[:60], "other", *words[61:]])):
        frame = spark.createDataFrame([(1, text), (1, text), (2, near), (3, "something else for the end of it")], "doc_id bigint, text string")
        got = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard.join(frame).collect())
        assert got == [(1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 3, 0)]


# ---- language-model scores


def test_scores_equal_brute_force(docs, rows, empty):
    grams, contexts, total = collections.Counter(), collections.Counter(), 0
    for _, text, *_ in rows:
        body = bytes(4) + (text or "").encode()
        total += len(body) - 4
        for i in range(4, len(body)):
            for k in range(1, 6):
                grams[body[i - k + 1 : i + 1]] += 1
                contexts[k, body[i - k + 1 : i]] += 1
    want = collections.Counter()
    for doc, text, *_ in rows:
        body, value = bytes(4) + (text or "").encode(), 0.0
        for i in range(4, len(body)):
            for k in range(5, 0, -1):
                held = grams[body[i - k + 1 : i + 1]]
                if k == 1 or held >= lm.LEAST:
                    value += math.log(held / (contexts[k, body[i - k + 1 : i]] if k > 1 else total)) + (5 - k) * math.log(lm.ALPHA)
                    break
        want[doc, len(body) - 4, round(value, 6)] += 1
    got = lm.score(docs).collect()
    assert collections.Counter((r.doc_id, r.n_grams, round(r.log_score, 6)) for r in got) == want
    assert all((r.mean_log_score is None) == (r.n_grams == 0) for r in got)
    assert lm.score(empty).collect() == []


def test_word_scores_equal_brute_force(docs, rows, empty):
    held, total = collections.Counter(), 0
    own = []
    for doc, text, *_ in rows:
        body = (text or "").encode().split()
        mine = collections.Counter(tuple(body[i - k + 1 : i + 1]) for i in range(len(body)) for k in range(1, min(i + 1, 3) + 1))
        own.append((doc, body, mine))
        held.update(mine)
        total += len(body)
    want = collections.Counter()
    for doc, body, mine in own:
        value = 0.0
        for i in range(len(body)):
            longest = min(i + 1, 3)
            for k in range(longest, 0, -1):
                gram = tuple(body[i - k + 1 : i + 1])
                if k == 1 or held[gram] > mine[gram]:
                    value += math.log(held[gram] / total if k == 1 else (held[gram] - mine[gram]) / (held[gram[:-1]] - mine[gram[:-1]]))
                    value += (longest - k) * math.log(lm.ALPHA)
                    break
        want[doc, len(body), round(value, 6)] += 1
    got = lm.score_words(docs).collect()
    assert collections.Counter((r.doc_id, r.n_grams, round(r.log_score, 6)) for r in got) == want
    assert all((r.mean_log_score is None) == (r.n_grams == 0) for r in got)
    assert lm.score_words(empty).collect() == []


def shuffled(spark, frame):
    """Rows of a frame, and the bytes its stages wrote for exchanges."""
    spark.sparkContext.setJobGroup(frame_group := f"shuffled-{id(frame)}", "")
    got = frame.collect()
    spark.sparkContext.setJobGroup(None, None)
    bus = spark.sparkContext._jsc.sc()
    bus.listenerBus().waitUntilEmpty(30_000)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(frame_group) for s in tracker.getJobInfo(job).stageIds}
    return got, sum(bus.statusStore().lastStageAttempt(s).shuffleWriteBytes() for s in stages)


def test_word_scores_send_names_in_less_than_their_eight_bytes(spark):
    """Names are sent as distances, counts and texts compressed; texts travel once."""
    rng = random.Random(8)
    texts = [" ".join(f"{rng.getrandbits(16):x}" for _ in range(400)) for _ in range(600)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2).cache()
    frame.count()
    got, written = shuffled(spark, lm.score_words(frame))
    assert len(got) == 600 and sum(r.n_grams for r in got) == 240_000
    names = 600 * (400 + 399 + 398)
    assert written < 8 * names


def test_squeezed_numbers_come_back():
    for values in ([], [0], [0, 0], [1, 255, 256, 2**40], [2**64 - 1, 0, 7], list(range(100_000))):
        values = np.array(values, np.uint64)
        data = lm.squeezed(values)
        assert lm.unsqueezed(memoryview(data)).tolist() == values.tolist()
    assert len(lm.squeezed(np.ones(100_000, np.uint64))) < 100


def test_scores_of_the_query_see_the_order_of_words(spark, tmp_path):
    from firmament.llm.queries import QUERIES

    rng = random.Random(3)
    lines = [prose(rng, 12).split() for _ in range(30)]
    texts = [" ".join(w for i in rng.sample(range(30), 12) for w in lines[i]) for _ in range(40)]
    mixed = texts[0].split()
    rng.shuffle(mixed)
    spark.createDataFrame([*enumerate(texts), (99, " ".join(mixed))], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_grams, r.mean_log_score) for r in QUERIES["op3_lm_scoring"](spark, str(tmp_path)).collect()}
    assert got[0][0] == len(mixed) and got[99][1] < min(got[i][1] for i in range(40)) - 1


# ---- classifiers


def labelled(spark):
    rng = random.Random(9)
    good = [(i, prose(rng, rng.randint(10, 60)) + ".") for i in range(150)]
    bad = [(i + 150, " ".join(w.upper() + "!!" for w in prose(rng, rng.randint(10, 60)).split())) for i in range(150)]
    docs = spark.createDataFrame([*good, *bad, (301, None), (302, ""), (None, "stone")], "doc_id bigint, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(0, 300, 2)] + [(0, 1), (None, 1), (3, None)], "doc_id bigint, quality int")
    return docs, labels


def test_quality_separates_unseen_rows(spark, empty):
    docs, labels = labelled(spark)
    model = quality.fit(docs, labels)
    found, (score, predicted) = quality.score(docs, model)
    assert (score, predicted) == ("score_", "predicted")
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == 303 and all(0 <= r[score] <= 1 and r[predicted] == int(r[score] >= 0.5) for r in got.values())
    assert np.mean([got[i][predicted] == int(i < 150) for i in range(1, 300, 2)]) > 0.97
    assert got[301][score] == got[302][score]
    assert quality.score(empty, model)[0].collect() == []


def test_quality_sample_is_bounded_by_features(spark, monkeypatch):
    """Rows beyond the feature bound are not learnt from; the fit sees one text of a repeated id."""
    docs, labels = labelled(spark)
    docs = docs.select("doc_id", "text").unionByName(spark.range(200).select(F.lit(0).alias("doc_id"), F.concat(F.lit("copy "), "id").alias("text")))
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows: seen.append([(len(f), y) for f, y in rows]))
    for volume in (1 << 26, 2_000, 1):
        quality.fit(docs, labels, volume=volume)
    whole, bounded, nothing = seen
    assert len(whole) == 150 and sum(n for n, _ in whole) > 2_000
    assert 0 < len(bounded) < 150 and sum(n for n, _ in bounded) <= 2_000 and set(bounded) <= set(whole)
    assert nothing == []


def test_quality_without_two_classes(spark):
    docs, labels = labelled(spark)
    none = quality.fit(docs, labels.limit(0))
    one = quality.fit(docs, labels.filter("quality = 1"))
    assert {r[0] for r in quality.score(docs, none)[0].select("score_").collect()} == {0.5}
    assert {r[0] for r in quality.score(docs, one)[0].select("score_").collect()} == {1.0}


def test_language_of_unseen_rows(spark, empty):
    rng = random.Random(8)
    speech = {"aa": "the of and house water stone light tree".split(), "bb": "der und häuser wässer stein licht baum über".split(),
              "cc": "niño agua piedra luz árbol casa señor año".split()}
    rows = [(k * 200 + i, prose(rng, 12, own), lang) for k, (lang, own) in enumerate(speech.items()) for i in range(120)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 !? 7", "cc"), (903, "the house", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit(1))
    model = langid.fit(docs.filter("doc_id % 3 > 0"), steps=120)
    assert model.languages == ["aa", "bb", "cc"]
    found, (lang, score) = langid.label(docs, model)
    got = {r.doc_id: r for r in found.collect()}
    unseen = [r for i, r in got.items() if i < 900 and i % 3 == 0]
    assert np.mean([r[lang] == r.lang for r in unseen]) > 0.97
    for i in (900, 901, 902):
        assert (got[i][lang], got[i][score]) == ("und", 0.0)
    assert langid.fit(docs.limit(0)) is None
    assert {r[0] for r in langid.label(docs, None)[0].select("lang_pred").collect()} == {"und"}
    assert langid.label(empty, model)[0].collect() == []


def test_network_gradients():
    rng = np.random.default_rng(0)
    symbols, labels = rng.integers(0, 256, (6, 4)).astype(np.int16), np.array([0, 1, 1, 0])
    symbols[4:, 1] = langid.PAD
    model = langid.train(symbols, labels, ["a", "b"], steps=0, units=3)
    layer = model.layers()[0]
    layer.table, layer.weights = layer.table.astype(np.float64), layer.weights.astype(np.float64)
    weight = rng.normal(size=(6, 3, 4))

    def loss():
        return sum(float((s * w).sum()) for s, w in zip(layer.run(symbols), weight, strict=True))

    tape: list = []
    list(layer.run(symbols, tape))
    table, weights = layer.back(tape, list(weight))
    for array, grad, places in ((layer.weights, weights, [(0, 0), (4, 1), (8, 2)]), (layer.table, table, [(k, symbols[2, 0]) for k in (0, 4, 8)])):
        for place in places:
            keep = array[place]
            array[place] = keep + 1e-3
            up = loss()
            array[place] = keep - 1e-3
            down = loss()
            array[place] = keep
            assert abs((up - down) / 2e-3 - grad[place]) < 2e-2 * max(1, abs(grad[place]))


# ---- licenses


def test_license_headers_files_and_inheritance(spark):
    files = [
        (1, "a/LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
        (2, "a/b/c/x.py", "import os"), (3, "a/b/y.py", "Licensed under the Apache License, Version 2.0.\nprint(1)\n" + "word " * 90),
        (4, "a/d/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."), (5, "a/d/e/z.py", ""),
        (6, "top.py", None), (7, None, "Released under the MIT License."), (8, None, "x"), (9, "ab/q.py", "y"), (9, "ab/q.py", "y"),
        (10, "a/own.py", "my license is odd"),
    ]
    got = {r.doc_id: (r.license, r.source, r.from_path) for r in licenses.scan(spark.createDataFrame(files, "doc_id bigint, path string, text string")).collect()}
    assert got == {
        1: ("MIT", "file", "a/LICENSE"), 2: ("MIT", "inherited", "a/LICENSE"), 3: ("Apache-2.0", "header", "a/b/y.py"),
        4: ("GPL-3.0", "file", "a/d/COPYING.txt"), 5: ("GPL-3.0", "inherited", "a/d/COPYING.txt"), 6: (None, None, None),
        7: ("MIT", "file", None), 8: (None, None, None), 9: (None, None, None), 10: ("MIT", "inherited", "a/LICENSE"),
    }
    assert licenses.scan(spark.createDataFrame([], "doc_id bigint, path string, text string")).collect() == []


def test_license_texts_wrapped_headers_and_tags(spark):
    whole = {k: (licenses.TEXTS / f"{k}.txt").read_text() for k in ("MIT", "GPL-3.0", "GPL-2.0", "AGPL-3.0", "BSD-3-Clause", "Apache-2.0", "MPL-2.0")}
    gnu = licenses.HEADERS["GPL-3.0"][0].split()
    wrapped = "/*\n" + "\n".join(" * " + " ".join(gnu[i : i + 9]) for i in range(0, len(gnu), 9)) + "\n */\n\n" + "int x;\n" * 200
    files = [
        *((f"{k}/any.txt", t.replace("<owner>", "Ann Other").replace("<year>", "2024")) for k, t in whole.items()),
        ("h/wrapped.c", wrapped.replace("This program", "Frobnicator")),
        ("h/title.txt", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\n" + "stone river " * 60),
        ("h/tag.py", "# SPDX-License-Identifier: MIT\n" + "x = 1\n" * 90), ("h/tags.py", "// SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0 OR Zlib)\n"),
        ("h/apache.html", "<!-- SPDX-License-Identifier: Apache-2.0 -->\n"), ("h/prose.md", "This program is licensed under the MIT license.\n" + "stone river " * 60),
        ("h/two.md", "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.\n" + "stone river " * 60),
        ("h/none.md", "A driving license is needed here, and a warranty on the car."),
    ]
    got = {r.path: (r.license, r.source, {x.license for x in r.licenses or []})
           for r in licenses.scan(spark.createDataFrame([(i, *f) for i, f in enumerate(files)], "doc_id bigint, path string, text string")).collect()}
    for k in whole:
        assert got[f"{k}/any.txt"] == (k, "file", {k}), k
    assert got["h/wrapped.c"] == ("GPL-3.0", "header", {"GPL-3.0"})
    assert got["h/title.txt"][0] == "GPL-3.0"
    assert got["h/tag.py"] == ("MIT", "header", {"MIT"}) and got["h/apache.html"][2] == {"Apache-2.0"}
    assert got["h/tags.py"][2] == {"GPL-2.0", "Zlib"}
    assert got["h/prose.md"] == ("MIT", "header", {"MIT"})
    assert got["h/two.md"][2] == {"MIT", "Apache-2.0"}
    assert got["h/none.md"][2] == set()


# ---- shared pieces


def test_slices_and_buffers():
    import pyarrow as pa

    data, offsets = unpack(pa.array(["ab", None, "", "cde"]).slice(1))
    assert data.tobytes() == b"cde" and offsets.tolist() == [0, 0, 0, 3]
    assert list(slices(np.array([0, 5, 9, 30, 31]), 10)) == [(0, 2), (2, 3), (3, 4)]
