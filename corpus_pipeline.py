"""From raw documents to token ids: the training-data stages in order.

Each stage takes (spark, docs, sf_dir), works on every document its predecessor
kept and returns a DataFrame, which is written as Parquet and read again as
the next stage's documents.  All stages but the last return the columns of the
documents table.  ``run`` applies them to the documents of a table folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import toxicity
from faultline.llm.bpe_codec import round_trip
from faultline.llm.frames import read_table, written_step
from faultline.llm.mixing import mixed_documents
from faultline.llm.near_dedup import one_of_each
from faultline.llm.queries import BYTE_BPE, DECIDE_FROM, toxicity_model
from faultline.llm.repeats import remove_repeated_text


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that op10_toxicity does not call toxic, by the same model and decision.

    NULL, empty and blank texts have the score of the model's bias.  Without
    labels of both kinds every document has one score: the share of toxic
    labels, 0.5 without any label, which rejects all.
    """
    model = toxicity_model(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out="_toxic").where(F.col("_toxic") < DECIDE_FROM).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 and more on five-word shingles: that of the smallest id.

    Texts without words are in no group and stay.  A NULL id never names a
    group: its rows go where a group has another id, and stay otherwise; rows
    equal in id and text stay or go together.
    """
    return one_of_each(docs, words=5, percent=80)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes and more that a document of a smaller id holds, n_chars counted again.

    NULL texts count as empty; a text that is all repeats stays, empty.
    """
    return remove_repeated_text(docs, min_bytes=50).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken.

    Texts without words have no size and are not taken; a NULL source is a
    source, the last; equal rows are taken alike but for the one at the cut.
    """
    return mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digest of what they decode to; NULL and empty texts have none."""
    both = round_trip(docs.select("doc_id", "lang", "source", "text"), BYTE_BPE)
    return both.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", reject_toxic), ("near_dedup", near_dedup), ("repeats", remove_repeats), ("mixing", mix),
          ("bpe", tokenize)]

ORACLE_SQL = None  # learned scores, similarity groups and merges are not SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written_step(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
