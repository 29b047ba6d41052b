"""Spelling variants, residual packing and the prefix trie through their registered queries, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from firmament.llm import residual, spelling, trie
from firmament.llm.oracle import ORACLE
from firmament.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, word string, node bigint, size string"  # three columns clash with inner ones
TURNS = "conv_id bigint, turn bigint, role string, text string, path string, depth string"


def table_dir(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def slips(rng, stem):
    """The word itself, mostly, or one edit of it."""
    if rng.random() < 0.7:
        return stem
    k = rng.randrange(len(stem))
    return rng.choice([stem[:k] + stem[k + 1 :], stem[:k] + rng.choice("abxé") + stem[k:], stem[:k] + rng.choice("abxé") + stem[k + 1 :]])


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    stems = ["wonder", "façade", "Niño12", "letters", "better", "aabbaab", "aabbab", "señoras", "x" * 9, "LONGER", "longer", "Éclair", "éclair"]
    rows = [(k, " ".join(slips(rng, rng.choice(stems)) for _ in range(60)), "w", 1, "s") for k in range(40)]
    rows += [rows[3], rows[3], (100, None, None, None, None), (101, "", "w", 1, "s"), (None, "wonder wonders wonder×÷ wonder", None, 2, None),
             (102, ("y" * 3000 + " ") * 3 + "y" * 2999 + " " + ("y" * 2999 + " ") * 2, "w", 1, "s"), (103, "12 34 … !", "w", 1, "s"), (104, "stringer " * 24 + "stringers " * 9 + "stringersx " * 4, "w", 1, "s")]
    return rows


def expected_variants(rows):
    n = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
        return a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :]

    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), form[w] and n[form[w]]) for w in n}


def test_spelling_query_equals_brute_force(spark, tmp_path, texts):
    got = QUERIES["op11_spelling_variants"](spark, table_dir(spark, tmp_path, "documents", texts, DOCS)).collect()
    assert len(got) == len({r.word for r in got})
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == expected_variants(texts)
    assert any(r.form and r.form != r.root for r in got) and any(len(r.word) > 2000 and r.n_near for r in got)


@pytest.mark.parametrize("room", [1 << 26, 0])
def test_full_filters_only_let_more_candidates_pass(spark, room):
    """Without room for the filters every length has the least number of blocks; pairs stay the same."""
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(5, 7))) for _ in range(3000)})
    vocabulary = spark.createDataFrame([(w, 3 + k % 50) for k, w in enumerate(words)], "word string, n bigint")
    got = {tuple(sorted((r.word, r.near))) for r in spelling.near_pairs(vocabulary, room).collect()}
    masks = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            masks[w[:k] + "*" + w[k + 1 :]].add(w)
    expected = {tuple(sorted((a, b))) for group in masks.values() for a in group for b in group if a != b}
    known = set(words)
    expected |= {tuple(sorted((w, w[:k] + w[k + 1 :]))) for w in words for k in range(len(w)) if w[:k] + w[k + 1 :] in known}
    assert got == expected


def test_passing_drops_words_that_were_never_entered(spark):
    words = [f"word{k:05d}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(4000)]
    vocabulary = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    filters = spelling.build_filters(vocabulary, {9: 4000})
    assert len(filters.passing(spelling.word_hashes(words), 9)) == 4000
    others = [w[::-1] for w in words]
    assert len(filters.passing(spelling.word_hashes(others), 9)) < 60


# ---- residual packing


def test_residual_query_packs_every_piece_once(spark, tmp_path):
    from tokenizers import Tokenizer

    from firmament.llm.wordbpe import default_path

    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(["water", "stone", "unlikeliest", "é", "12"]) for _ in range(rng.randint(0, 900))), "w", 1, "s") for k in range(150)]
    rows += [rows[4], rows[4], (500, None, None, None, None), (501, "", "w", 1, "s"), (None, "a b", "w", 1, "s"), (502, "stone " * 5000, "w", 1, "s")]
    got = QUERIES["op12_residual_packing"](spark, table_dir(spark, tmp_path, "documents", rows, DOCS)).collect()
    library = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    expected = Counter()
    for doc, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start : start + 2048]
            expected[doc, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 2048) + 1


def test_tree_of_many_groups_and_small_carry(spark):
    """Groups of 20 pieces, merged three by three; with little carried up nothing is lost, only room."""
    rows = [(k, "water " * (1 + k * 37 % 90)) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    sizes = []
    for carry in (10_000, 2):
        got = residual.pack_tree(docs, capacity=128, fan=3, most=20, carry=carry).collect()
        assert len(got) == 600
        filled = defaultdict(int)
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == filled[r.sequence_id]
            filled[r.sequence_id] += r.length
        assert max(filled.values()) <= 128
        sizes.append(len(filled))
    assert sizes[0] <= sizes[1] and sizes[0] <= 1.02 * sum(r.length for r in got) / 128 + 1


def test_best_fit_takes_the_fullest_sequence_that_holds_an_item():
    sequence, offset, filled = residual.best_fit(np.array([6, 5, 4, 3, 10]), 10)
    assert sequence.tolist() == [1, 2, 1, 2, 0] and offset.tolist() == [0, 0, 6, 5, 0] and filled.tolist() == [10, 10, 8]


def test_unfinished_keeps_the_emptiest():
    assert residual.unfinished(np.array([10, 9, 3, 5]), 10, 1, 2).tolist() == [False, False, True, True]


# ---- prefix trie


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        said = ["same", "first", "turns"] if rng.random() < 0.4 else [rng.choice("abc") for _ in range(rng.randint(1, 5))]
        rows += [(c, t, rng.choice([None, "user"]) if c % 7 == 0 else "user", x + " two\tthree", "p", "d") for t, x in enumerate(said)]
    return rows


def expected_nodes(rows):
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    base = {c: c - (c % 20 if c >= 0 else -(-c % 20)) for c in own}
    path = {c: tuple(own.get(base[c], [])[: h[c]] + own[c][h[c] :]) for c in own}
    members = defaultdict(list)
    for c, p in path.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * words
    return Counter(
        (min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(cs) if path[c] == p).encode()).hexdigest())
        for p, cs in members.items()
    )


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_trie_query_equals_brute_force(spark, tmp_path, shards):
    """With 40 shards most nodes near the root, and the ends of the common conversation, lie in many of them."""
    rows = conversations(5, 130)
    rows += [(3, None, "user", "before all", "p", "d"), (3, 1, "user", None, "p", "d"), rows[10], rows[10], (None, 0, "user", "nobody", "p", "d"),
             (-21, 0, "user", "a two\tthree", "p", "d"), (-25, 0, "user", "a two\tthree", "p", "d"), (1000, 0, "user", "", "p", "d"),
             (1001, 0, "us", "er", "p", "d"), (1002, 0, "user", "x" * 20_000, "p", "d")]
    rows += [(c, t, "user", f"long {t}", "p", "d") for c in (2001, 2002, 2003) for t in range(300)]
    folder = table_dir(spark, tmp_path, "conversations", rows, TURNS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        got = [tuple(r[c] for c in trie.RESULT) for r in QUERIES["op13_prefix_trie"](spark, folder).select(*trie.RESULT).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = lambda t: (t[0], t[1], t[2], t[3], t[4], t[5], t[6], t[7])
    assert Counter(map(order, got)) == expected_nodes(rows)


def test_ends_of_a_node_are_hashed_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trie, "ENDS", 3)
    rows = [(20 * c, 0, "user", "hello", "p", "d") for c in range(200)]
    got = QUERIES["op13_prefix_trie"](spark, table_dir(spark, tmp_path, "conversations", rows, TURNS)).collect()
    assert {(r.depth, r.n_convs, r.ends_sha256) for r in got if r.depth} == {
        (1, 200, hashlib.sha256(",".join(str(20 * c) for c in range(200)).encode()).hexdigest())}


@pytest.mark.parametrize("name,table,schema", [
    ("op11_spelling_variants", "documents", DOCS), ("op12_residual_packing", "documents", DOCS), ("op13_prefix_trie", "conversations", TURNS)])
def test_empty_tables(spark, tmp_path, name, table, schema):
    assert QUERIES[name](spark, table_dir(spark, tmp_path, table, [], schema)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    folder = "/root/testdata/sf0.001"
    with duckdb.connect() as con:
        for table in ("documents", "embeddings", "conversations"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
        found = con.execute(ORACLE[name])
        names = [c[0] for c in found.description]
        expected = Counter(found.fetchall())
    assert Counter(tuple(r[n] for n in names) for r in QUERIES[name](spark, folder).collect()) == expected and expected
