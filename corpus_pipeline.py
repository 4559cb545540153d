"""Corpus pipeline: from documents to packed training sequences.

STAGES are applied in order.  Each takes (spark, docs, sf_dir) and returns a
DataFrame; the result is written as Parquet and read again as the next one's docs.

* language_id: documents without a recognized language go; a null ``lang`` is filled.
* near_dedup: of each group of near-duplicates (5-word shingles, Jaccard 0.8 or
  more) the document with the smallest id stays, one without an id only if none has
  one.  A document is an id and a text: different texts of one id are different
  documents, and of rows that repeat both the one with the smallest other columns stays.
* pseudonyms: personal numbers and dates become keyed pseudonyms.
* source_mixing: documents are left out or repeated, at most three times, so that
  each source comes near its share; a repeated document is that many rows.
* packing: token ids of every document, packed into sequences of 4096.

All stages but the last return the columns of their input, whatever their names.  An empty table runs
through all stages.  SQL cannot express a learned model or a tokenizer, so ORACLE_SQL
is None; the stages are tested against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import language, minhash, mixing, packing, pseudonyms
from basketry.llm.support import is_held_out, prepare, written

#: Key of the registered run.  A production run passes a secret of its own.
PSEUDONYM_KEY = "basketry-documents"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, language.train(docs, ~is_held_out()))


def unused(docs: DataFrame, stem: str) -> str:
    """A column name that the documents do not have, in any spelling."""
    taken = {c.lower() for c in docs.columns}
    while stem in taken:
        stem += "_"
    return stem


def quoted(name: str) -> F.Column:
    return F.col("`" + name.replace("`", "``") + "`")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = [quoted(c) for c in docs.columns]
    key, row = unused(docs, "dedup key"), unused(docs, "dedup row")
    # The key depends on the row alone, so it is the same whenever the table is read.
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = minhash.near_duplicates(
        keyed.select(quoted(key).alias("doc_id"), "text"), minhash.Settings(shingle=5, percent=80)
    )
    groups = written(found.select("doc_id", "component_id").distinct(), "dedup-groups")
    documents = keyed.select(quoted(key).alias("own"), "doc_id").distinct()
    order = F.struct(F.col("a.doc_id").isNull(), F.col("a.doc_id"), F.col("a.own"))
    firsts = (
        documents.alias("a")
        .join(groups.alias("g"), F.col("a.own") == F.col("g.doc_id"))
        .groupBy("g.component_id")
        .agg(F.min_by("a.own", order).alias("first"))
    )
    kept = keyed.join(firsts.select(F.col("first").alias(key)), key, "left_semi")
    one = kept.groupBy(quoted(key)).agg(F.min(F.struct(*columns)).alias(row))
    return one.select(*[quoted(row).getField(c).alias(c) for c in docs.columns])


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(docs, PSEUDONYM_KEY)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row, copies, copy = (unused(docs, f"mix {name}") for name in ("row", "copies", "copy"))
    # The numbers are part of a written table: both reads see the same.
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    plan = mixing.mix(numbered, whole=True, keep=(row,)).where("taken > 0")
    wanted = plan.select(quoted(row), F.expr("cast(taken div size as int)").alias(copies))
    return (
        numbered.join(wanted, row)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), quoted(copies))))
        .select(*[quoted(c) for c in docs.columns])
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("pseudonyms", pseudonymize),
    ("source_mixing", source_mixing),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to all documents."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
