"""A training-data pipeline over ``documents``: language ID, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerwise.llm import langid
from tickerwise.llm.common import Workspace, read
from tickerwise.llm.decontaminate import contamination
from tickerwise.llm.jaccard import ngram_jaccard
from tickerwise.llm.lines import line_dedup
from tickerwise.llm.packing import pack
from tickerwise.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """Rows of ``docs`` that no row of ``marked`` (doc_id, mark = hash of the text) names; nulls match nulls."""
    gone = marked.select(F.col("doc_id").alias("d"), F.col("mark").alias("m")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["d"]) & F.xxhash64("text").eqNullSafe(gone["m"]), "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a likely language go: too few letters, or no language likelier than the others together."""
    work = Workspace(spark)
    languages, logp = langid.train(docs.select("text", "lang"))
    none = F.lit(None).cast("string")
    items = docs.select(F.struct(F.col("doc_id"), F.xxhash64("text").alias("mark")).alias("key"), "text", F.col("lang").alias("declared"),
                        F.col("source").alias("host"), none.alias("domain"), none.alias("suffix"))
    judged = langid.identify(items, languages, logp, work)
    rejected = work.table(judged.where(~langid.accepted()).select("key.doc_id", "key.mark"), "rejected")
    return _without(docs, rejected).select(COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines shared by three or more documents stay in one; the document's text and length change."""
    out = line_dedup(docs, min_chars=20, min_docs=3, carry=["lang", "source"])
    return out.select("doc_id", F.col("kept_text").alias("text"), "carry.lang", "carry.source",
                      F.length("kept_text").cast(docs.schema["n_chars"].dataType).alias("n_chars"))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the smallest doc_id stays, once."""
    work = Workspace(spark)
    groups = work.table(ngram_jaccard(docs, shingle=5, num=80, den=100, lower=True).where("doc_id is not null"), "groups")
    losers = work.table(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("d")).distinct(), "losers")
    stay = docs.join(losers, docs["doc_id"] == losers["d"], "left_anti").select(COLUMNS)
    again = work.table(groups.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("d")), "again")
    once = stay.join(again, stay["doc_id"] == again["d"], "left_semi").dropDuplicates(["doc_id"])
    return stay.join(again, stay["doc_id"] == again["d"], "left_anti").unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    work = Workspace(spark)
    dirty = work.table(contamination(docs, read(spark, sf_dir, "benchmark")).where("contaminated").select("doc_id", "mark"), "dirty")
    return _without(docs, dirty).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path())


STAGES = [("language_id", language_id), ("line_dedup", dedup_lines), ("ngram_jaccard", dedup_documents),
          ("decontamination", decontaminate), ("packing", packing)]
ORACLE_SQL = None  # token ids are not expressible in SQL; the tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, docs = Workspace(spark), read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
