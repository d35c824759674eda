"""Training-data pipeline over ``documents``: identify languages, keep one of
each group of near-duplicates, take out personal data, pack into sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, written as Parquet to the shared folder and reread as the
next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffline.llm import dart_minhash, langid, packing, pii
from staffline.llm.common import bound_batches, crc_remainder, ensure_checkpoint_dir, read

#: A text goes if no language has this mean posterior over its words and the words, each for itself, are
#: not sure of a language either (langid.MIN_SURE): a text evenly of several languages stays.
MIN_LANGUAGE_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one or several of the learned languages; the field is learned from the
    labelled documents that are not held out."""
    bound_batches(spark)
    learn = docs.where(~F.coalesce(crc_remainder("doc_id", 3) == 1, F.lit(False)))
    model = langid.train(langid.training_sample(learn))
    return langid.keep_identified(docs, model, MIN_LANGUAGE_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    bound_batches(spark)
    return dart_minhash.one_of_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its type; n_chars follows the new text."""
    bound_batches(spark)
    clean = pii.redact_texts(docs, pii.train(pii.training_texts(docs)))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token placed in a sequence; one row per piece of a document."""
    bound_batches(spark)
    return packing.best_fit_pack(docs.select("doc_id", packing.token_length().alias("length")))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: The language model, the signatures and the packing have no SQL form; the tests hold the stages against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.mode("overwrite").parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
