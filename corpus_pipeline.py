"""A corpus pipeline: reject toxic and poor documents, remove near copies, mix sources to
target weights, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of `documents`. The first two judge every row in the pass that keeps or drops it; texts are neither written
nor shuffled for it. Near-duplicate removal decides on groups: it writes its rows with a key first, and the
decisions are joined back by that key. So every row is judged by its own contents, with or without an id, and rows
that share an id but not the text are different documents. Near-duplicate removal leaves exactly one row of
each group. An empty table passes as an empty table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.llm.common import drop_path, free_name, load, scratch, stored
from tripwire.llm.cpsjoin import near_duplicates
from tripwire.llm.mixing import mix_sources
from tripwire.llm.piece_codec import encode_digests
from tripwire.llm.quality import score_quality
from tripwire.llm.queries import tokenizer_path
from tripwire.llm.toxicity import score_toxicity

#: Share of the tokens that the mixing stage keeps; no document is taken twice.
MIX_SHARE = 0.8


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written with a unique key, and the key's name."""
    name = free_name(docs, "row")
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "keyed"), name


def _kept(keyed: DataFrame, key: str, kept: DataFrame) -> DataFrame:
    """The rows whose key is in `kept`, without the key."""
    return keyed.join(kept.select(key), key, "left_semi").drop(key)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = free_name(docs, "toxicity")
    judged = score_toxicity(docs, load(spark, sf_dir, "labels"), judged=name)
    return judged.where(F.col(name)["predicted"] == 0).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = free_name(docs, "quality")
    judged = score_quality(docs, load(spark, sf_dir, "labels"), judged=name)
    return judged.where(F.col(name)["predicted"] == 1).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word shingles of five, similarity 0.8; of each group the row with the smallest id stays (rows without
    an id last, then by key)."""
    keyed, key = _keyed(docs)
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), width=5, threshold=0.8)
    members = found.select(F.col("doc_id").alias(key), "component_id").join(
        keyed.select(key, F.col("doc_id").isNull().alias("no_id"), "doc_id"), key)
    first = members.groupBy("component_id").agg(F.min(F.struct("no_id", "doc_id", key)).alias("first"))
    return _kept(keyed, key, first.select(F.col(f"first.{key}").alias(key))).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chosen = mix_sources(docs, budget_share=MIX_SHARE, epochs=1).select("doc_id").distinct()
    return docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_digests(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("quality classifier", quality), ("near-duplicates", near_dedup),
          ("mixing", mixing), ("encoding", encoding)]

#: Model scores and randomised search have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is written and read again, and goes once the next one's
    is written."""
    docs, last = load(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = scratch(spark, f"stage{k}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last:
            drop_path(spark, last)
        last = path
    return docs
