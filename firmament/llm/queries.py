"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmament.llm import ann, bytebpe, jaccard, langid, licenses, lm, packing, quality, repeats, residual, spelling, topk, trie
from firmament.llm.common import id_crc32, read_table
from firmament.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; rows with crc32(doc_id) mod 3 = 1 are never learnt from."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(id_crc32() % 3 != 1))
    scored, (score, predicted) = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", F.coalesce(id_crc32() % 3 == 1, F.lit(False)).alias("held_out"), F.col(score).alias("score"),
        F.col(predicted).alias("predicted"),
    )


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows with crc32(doc_id) mod 4 = 2 are never learnt from."""
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(id_crc32() % 4 != 2))
    found, (lang, score) = langid.label(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", F.coalesce(id_crc32() % 4 == 2, F.lit(False)).alias("held_out"), F.col(lang).alias("lang_pred"),
        F.col(score).alias("score"),
    )


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class, copy class and links of every document: five words, similarity 0.8."""
    return jaccard.join(read_table(spark, sf_dir, "documents"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 100-byte strings that start earlier."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return repeats.repeats(docs).select(
        "doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: where every piece of every document lies."""
    return packing.pack(read_table(spark, sf_dir, "documents"), ids=False)


def bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the text that they decode to, as digests."""
    encoded, (ids, text) = bytebpe.encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), check=True)
    return encoded.select(
        "doc_id", (F.octet_length(ids) / 4).cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col(text).cast("binary"), 256).alias("decoded_sha256"),
    )


def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five highest integer inner products of every fiftieth vector, over all others."""
    return topk.search(read_table(spark, sf_dir, "embeddings"))


def adaptive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest by cosine that every fiftieth vector finds among all others."""
    return ann.search(read_table(spark, sf_dir, "embeddings"))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score, over runs of up to three words, of every document under the corpus it is part of."""
    return lm.score_words(read_table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document as a file of its source: in folders of a hundred, every tenth one at the top."""
    docs = read_table(spark, sf_dir, "documents")
    folder = F.concat(F.lit("d"), F.pmod(F.floor(F.col("doc_id") / 10), F.lit(100)), F.lit("/"))
    path = F.concat("source", F.lit("/"), F.when(F.col("doc_id") % 10 == 0, F.lit("")).otherwise(folder), "doc_id", F.lit(".txt"))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least five letters and three occurrences, with the frequent word that each is a slip of."""
    counts = spelling.word_counts(read_table(spark, sf_dir, "documents"), typos=97)
    return spelling.variants(counts.filter(F.col("n") >= spelling.OCCURRENCES))


def residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, packed in a tree: where every piece of every document lies."""
    return residual.pack_tree(read_table(spark, sf_dir, "documents"))


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of conversations, of which those of one block of twenty share up to three first turns."""
    convs = trie.conversations(read_table(spark, sf_dir, "conversations"))
    base = F.col("conv_id") - F.col("conv_id") % 20
    return trie.prefix_trie(trie.paths(trie.share_heads(convs, base, (id_crc32("conv_id") % 4).cast("int"), 3)))


QUERIES = {
    "op1_pack_sequences": pack_sequences,
    "op2_language_id": language_id,
    "op3_lm_scoring": lm_scores,
    "op4_quality_classifier": quality_classifier,
    "op5_bpe_roundtrip": bpe_roundtrip,
    "op6_suffix_dedup": suffix_dedup,
    "op7_exact_topk": exact_topk,
    "op8_adaptive_ann": adaptive_ann,
    "op9_license_scan": license_scan,
    "op10_ngram_jaccard": ngram_jaccard,
    "op11_spelling_variants": spelling_variants,
    "op12_residual_packing": residual_packing,
    "op13_prefix_trie": prefix_trie,
}
