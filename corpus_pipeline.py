"""Corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and reread as the next one's input. All but the last return the
columns of ``documents``.

1. toxicity: documents that the classifier calls toxic go.
2. line dedup: of near-equal lines of the corpus the first stays; a document may
   become empty but stays.
3. SimHash near-dedup: of each group of near-equal documents the one with the
   smallest id stays.
4. benchmark decontamination: documents that hold a window of a benchmark item go.
5. BPE: every text becomes token ids, with their digest and that of the text
   they decode to.

Defined cases: as the operators state; repeated rows and null ids are told apart
by a row key, so each row is judged on its own; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import bpe, decontaminate, linededup, simhash, toxicity
from tickwise.llm.common import with_row_key, work_dir, written
from tickwise.llm.queries import TOKENIZER, held_out, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, key = with_row_key(docs, "doc_id")
    labels = toxicity.training_labels(table(spark, sf_dir, "labels"), "doc_id", "toxic", ~held_out("doc_id"))
    scores = toxicity.toxicity(rows, "doc_id", "text", labels, key)
    toxic = written(scores.filter("predicted = 1").select(F.col("row_key").alias(key)), "toxic")
    return rows.join(toxic, key, "left_anti").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, key = with_row_key(docs, "doc_id")
    out = linededup.dedup_lines(rows, key, "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, key = with_row_key(docs, "doc_id")
    return simhash.keep_one_of_each(rows, key, "doc_id", "text").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, key = with_row_key(docs, "doc_id")
    items = table(spark, sf_dir, "benchmark")
    return decontaminate.remove_contaminated(rows, key, "text", items, "item_id", "text").select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.bpe_encode(docs.select("doc_id", "text"), "text", TOKENIZER, "ids", "decoded")
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_documents),
    ("benchmark decontamination", decontaminated),
    ("BPE", token_ids),
]

# Compression lengths and MinHash signatures have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a Parquet table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = work_dir(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
