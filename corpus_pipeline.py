"""From raw documents to packed training sequences, in five stages."""

from pyspark.sql import DataFrame, SparkSession

from chartspark.llm import mixing, naming, packing, simhash, toxicity
from chartspark.llm.common import rows_only, stored_rows, table
from chartspark.llm.workload import tokenizer_path
from chartspark.sources.storage import drop_at_exit, drop_now, fresh_path, kept, scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted to the labels in ``sf_dir``, scores below its threshold."""
    return toxicity.ordinary_rows(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of every group of documents with equal text."""
    docs, row = stored_rows(docs)
    return rows_only(docs, row, naming.exact_dedup(docs, row=row).filter("NOT kept").select("row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of every group of documents linked by SimHash fingerprints."""
    docs, row = stored_rows(docs)
    return rows_only(docs, row, simhash.simhash_groups(docs, row=row).filter("NOT kept").select("row"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least, those of small sources more often, up to twice as often as those of the largest."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document drawn goes in sequences of 2048 tokens; equal rows are numbered by ``row``."""
    return packing.best_fit_packing(docs, tokenizer_path()).withColumnRenamed("key", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Toxicity scores, fingerprints and token ids are beyond SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``, each on the stored rows of the one before.

    What a stage stores on its way is deleted when its rows are stored, and these when the next stage's are.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        drop_at_exit(spark, path)
        with scratch(spark):
            docs = kept(stage(spark, docs, sf_dir), path)
        if before is not None:
            drop_now(spark, before)
        before = path
    return docs
