"""From raw documents to packed training sequences, stage by stage over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.packing import pack_documents
from fareloom.llm.quality import keep_good
from fareloom.llm.registry import BYTE_BPE, held_out_ids
from fareloom.llm.repeats import mark_repeats
from fareloom.llm.simhash import drop_near_duplicates
from fareloom.llm.tables import prepare, table
from fareloom.session import written

#: Passages of this many words that appear again are cut out.
WINDOW = 50


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, learnt from the labels outside the held-out quarter."""
    learn_from = ~F.coalesce(held_out_ids(F.col("doc_id")), F.lit(False))
    return keep_good(docs, table(spark, sf_dir, "labels"), learn_from)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: SimHash prints of three-word shingles, two differing bits at most."""
    prepare(spark)
    return drop_near_duplicates(docs, size=3, bits=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words of passages that start earlier; other texts stay as they are."""
    prepare(spark)
    marked = mark_repeats(docs, window=WINDOW, carry=tuple(docs.columns))
    cut = F.col("n_removed") > 0
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("bigint")}
    return marked.select(
        *(
            F.when(cut, new[c]).otherwise(F.col("carried")[c]).alias(c) if c in new
            else F.col("carried")[c].alias(c)
            for c in docs.columns
        )
    )


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of up to 2048 tokens."""
    prepare(spark)
    return pack_documents(docs, BYTE_BPE, most=2048)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: No SQL states a fitted classifier or a tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
