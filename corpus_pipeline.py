"""A training corpus from raw documents, stage by stage; each stage's rows are written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm import lang_id, line_dedup, packing, quality, simhash
from skyflow.llm.common import id_crc32, numbered, written

#: SQL has no classifier, language model or tokenizer; the stages are tested against brute force.
ORACLE_SQL = None
LEAST_QUALITY, LEAST_LANGUAGE = 0.5, 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is likelier of quality 1 than 0; null and empty texts are judged by the share of quality 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.pmod(id_crc32(F.col("doc_id")), F.lit(3)) != 1)
    score = quality.scored(F.col("text"), quality.fit(docs, labels), spark)
    return docs.where(score >= LEAST_QUALITY)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one language for which the model is sure enough; texts without a letter go, and those too unlikely
    in their best language, as texts in languages that were not learned are. Model and limits come from all rows with a
    language whose crc32 of the id is not divisible by 5."""
    names, rows = docs.columns, numbered(docs)
    own_id, text, lang = (rows.columns[names.index(c)] for c in ("doc_id", "text", "lang"))
    learned = F.pmod(id_crc32(F.col("doc_id")), F.lit(5)) != 0
    model = lang_id.fit(docs.where(learned), public_tokenizers.path("piece_bpe_32k.model"))
    # each text is judged once, for the limits and for its own row
    judged = written(rows.withColumn("found", lang_id.predicted(F.col(text), model, spark)), "judged")
    known = judged.select(F.col(own_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), "found")
    limit = F.lit(float("-inf"))
    for name, low in lang_id.least_of(known.where(learned & F.col("text").isNotNull())).items():
        limit = F.when(F.col("found.lang_pred") == name, low).otherwise(limit)
    sure = (F.col("found.lang_pred") != "und") & (F.col("found.score") >= LEAST_LANGUAGE)
    return judged.where(sure & (F.col("found.per_letter") >= limit)).drop("found").toDF(*names)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one has; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs)
    count = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return out.select(*(count.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the smallest doc_id; equal rows count once.

    Fingerprints within 3 bits are one group; groups within 7 bits are joined where their texts share at least 0.8 of
    their five-word shingles. A null doc_id stays only where no other document is in its group. Rows that share a
    doc_id are judged each by its own text; of those in one group the smallest fingerprint stays, then the smallest text.
    """
    grouped = written(simhash.near_copies(docs), "near-copies")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = grouped.where(~first).select(F.col("doc_id").alias("_id")).distinct()
    again = docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_id"))

    names, rows = docs.columns, numbered(docs)
    own_id, text = rows.columns[names.index("doc_id")], rows.columns[names.index("text")]

    def matched(rows: DataFrame, key: str, ids: DataFrame, how: str) -> DataFrame:
        return rows.join(ids, rows[key].eqNullSafe(ids["_id"]), how)

    once = matched(rows, own_id, gone.union(again), "left_anti")
    stay = matched(grouped.where(first), "doc_id", again, "left_semi").groupBy("doc_id", "root").agg(F.min("fingerprint").alias("_print"))
    stay = stay.select(F.col("doc_id").alias("_id"), "_print")
    several = simhash.with_fingerprint(matched(rows, own_id, again, "left_semi"), "_own", text=text)
    several = several.join(stay, several[own_id].eqNullSafe(stay["_id"]) & (several["_own"] == stay["_print"]), "left_semi")
    row = F.min_by(F.struct(*rows.columns), F.coalesce(text, F.lit("")))
    return once.union(several.groupBy(own_id, "_own").agg(row.alias("_row")).select("_row.*")).toDF(*names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences of 2048; a null or empty text is one token."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", keep_quality),
    ("language ID", keep_language),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
