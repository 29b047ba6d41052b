"""Corpus pipeline: a table of documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and is written
as Parquet in the shared folder, which the next one reads.  All stages but the last return the
columns of documents.  The models of the first two stages learn from the documents of the same
run; rows held out by the queries are held out here too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmament.llm import jaccard, langid, packing, quality, repeats
from firmament.llm.common import fresh, id_crc32, keep, partitions, read_table

MIXED = 0.4  # a document without a language of at least this probability is rejected


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(id_crc32() % 3 != 1))
    scored, (_, predicted) = quality.score(docs, model)
    return scored.filter(F.col(predicted) == 1).select(*docs.columns)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those in no language to speak of, go."""
    model = langid.fit(docs.filter(id_crc32() % 4 != 2))
    found, (lang, score) = langid.label(docs, model)
    return found.filter((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= MIXED)).select(*docs.columns)


def _own_ids(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, key, own``: a number of its own for every text of a doc_id that has several.

    Numbers follow the largest doc_id in the order of (doc_id, key), range by range.
    """
    spark = docs.sparkSession
    known = docs.filter(F.col("doc_id").isNotNull())
    several = known.groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high")).filter("low <> high").select("doc_id")
    pairs = known.select("doc_id", key).join(several, "doc_id", "left_semi").distinct()
    part = fresh("part", docs.columns)
    ranged = keep(pairs.repartitionByRange(partitions(spark), "doc_id", key).withColumn(part, F.spark_partition_id()), "pipeline-shared-ids")
    sizes = {r[part]: r["count"] for r in ranged.groupBy(part).count().collect()}  # a row per partition
    top = max(docs.agg(F.max("doc_id").alias("top")).head()["top"] or 0, 0)
    bases, ahead = [], top + 1
    for k in sorted(sizes):
        bases.append((k, ahead))
        ahead += sizes[k]
    base = fresh("base", docs.columns)
    dealt = ranged.join(F.broadcast(spark.createDataFrame(bases, f"{part} int, {base} bigint")), part)
    nth = F.row_number().over(Window.partitionBy(part).orderBy("doc_id", key))
    return keep(dealt.select("doc_id", key, (F.col(base) + nth - 1).alias("own")), "pipeline-own-ids")


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest doc_id stays.

    A doc_id that comes with several texts is one document per text here, and those rank behind all
    others, by doc_id and digest.  Of rows that repeat a doc_id and its text the one whose other columns
    hash lowest stays; rows without a doc_id all stay.  So no text goes that is near to none that stays.
    """
    key = fresh("text_key", docs.columns)
    own = fresh("own_id", [*docs.columns, key])
    named = docs.withColumn(key, F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 32))
    shared = _own_ids(named, key).withColumnRenamed("own", own)
    if shared.isEmpty():
        named = named.withColumn(own, F.col("doc_id").cast("bigint"))
    else:
        named = named.join(shared, ["doc_id", key], "left").withColumn(own, F.coalesce(own, F.col("doc_id").cast("bigint")))
    classes = jaccard.join(named.select(F.col(own).alias("doc_id"), "text"))
    first = classes.filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias(own)).distinct()
    nth = fresh("nth", named.columns)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")] or ["doc_id"]
    order = Window.partitionBy(own).orderBy(F.xxhash64(F.to_json(F.struct(*rest))))
    one = named.join(first.hint("merge"), own, "left_semi").withColumn(nth, F.row_number().over(order)).filter(F.col(nth) == 1)
    return one.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; a character cut in two goes as a whole."""
    cut = repeats.repeats(docs, readable=True)
    body = F.when(F.col("text").isNotNull(), F.col(cut.columns[-1]))
    new = cut.withColumn("text", body)
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new.select(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its place in a sequence of 2048 tokens."""
    return packing.pack(docs, ids=False)


STAGES = [
    ("quality_classifier", keep_quality),
    ("language_id", keep_language),
    ("ngram_jaccard_join", keep_distinct),
    ("suffix_array_dedup", cut_repeats),
    ("packing", pack_documents),
]

ORACLE_SQL = None  # trained models and byte matching are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the rows of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
