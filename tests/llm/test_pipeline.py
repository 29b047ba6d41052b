"""The pipeline's stages on the smallest tables, each against what its operator says."""

import os

import pytest

import corpus_pipeline
from firmament.llm import jaccard
from firmament.llm.common import keep, read_table
from firmament.llm.queries import ORACLE, QUERIES
from tests.llm.test_documents import brute_links, brute_repeats

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def stages(spark):
    docs = read_table(spark, SF_DIR, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(keep(stage(spark, found[-1], SF_DIR), f"test-{name}"))
    return found


def test_stages_keep_the_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for frame in stages[1:5]:
        assert frame.dtypes == stages[0].dtypes


def test_quality_stage_drops_what_labels_call_bad(spark, stages):
    labels = {r.doc_id: r.quality for r in read_table(spark, SF_DIR, "labels").collect()}
    before, after = ({r.doc_id for r in f.select("doc_id").collect()} for f in stages[:2])
    assert after < before
    wrong = [i for i in before if i in labels and (i in after) != (labels[i] == 1)]
    assert len(wrong) <= 0.03 * len(labels)


def test_language_stage_keeps_clean_documents(stages):
    assert stages[2].count() >= 0.97 * stages[1].count()


def test_join_stage_keeps_one_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    _, classes = brute_links(rows)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(set(classes.values()))


def test_dedup_stage_cuts_repeats(stages):
    rows = [(r.doc_id, r.text) for r in stages[3].collect()]
    want = {doc: body.decode("utf-8", "ignore") for (doc, _), (_, body) in brute_repeats(rows).items()}
    got = {r.doc_id: (r.text, r.n_chars) for r in stages[4].collect()}
    assert got == {doc: (text, len(text)) for doc, text in want.items()}


def test_packing_stage_places_every_document(stages):
    rows = stages[5].collect()
    held = {}
    for r in rows:
        held[r.doc_id] = held.get(r.doc_id, 0) + r.length
    assert held == {r.doc_id: r.doc_tokens for r in rows}
    assert set(held) == {r.doc_id for r in stages[4].select("doc_id").collect()}


def test_odd_documents_pass_every_stage(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the same text of these few words", None, "s", 1),
            (3, "the same text of these few words", "en", "s", 1), (3, "the same text of these few words", "en", "s", 1),
            (4, "the same text of these few words", "en", None, 1)]
    docs = spark.createDataFrame(rows, schema)
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = keep(stage(spark, frame, SF_DIR), f"odd-{name}")
            if name != "packing":
                assert out.dtypes == docs.dtypes
            if name == "ngram_jaccard_join" and frame is docs:
                assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 2, 3]
            out.count()


@pytest.mark.parametrize("columns", ["lang string, own_id string, text_key bigint, part int, base int, nth int", ""])
def test_no_text_is_lost_with_a_repeated_id(spark, columns):
    """(1, B) is near to (2, B'), so one of both goes; (1, A) stays, and so do texts that share an id without words."""
    words = " ".join(f"word{k}" for k in range(60))
    other = " ".join(f"other{k}" for k in range(60))
    rows = [(1, words), (1, other), (2, other + " end"), (3, words), (3, words), (5, None), (5, ""), (5, "..."), (6, "a b"), (6, "c d"), (None, words)]
    extra = (None,) * (6 if columns else 0)
    docs = spark.createDataFrame([(*r, *extra) for r in rows], "doc_id bigint, text string" + (columns and ", " + columns)).repartition(3)
    out = corpus_pipeline.keep_distinct(spark, docs, SF_DIR)
    assert out.dtypes == docs.dtypes
    left = sorted(((r.doc_id or 0), r.text or "") for r in out.collect())
    assert left == sorted([(0, words), (2, other + " end"), (3, words), (5, ""), (5, "..."), (6, "a b"), (6, "c d")])


def test_registered_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
    assert jaccard.SHINGLE == 5 and jaccard.THRESHOLD == 0.8
