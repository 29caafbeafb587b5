"""The corpus pipeline: language ID, exact dedup, near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the shared
folder and read back as the next stage's docs, so a lost executor costs at most the stage it works on.
All but the last return the columns of documents. A stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.llm import exact_dedup, langid, near_dedup, packing, substring_dedup
from tablehaul.llm.common import read, saved
from tablehaul.llm.queries import tokenizer_path

# Below this share of words in one language a text counts as none of them.
MIN_SCORE = 0.4


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those with no language for a good part of their words."""
    judged = langid.predict(docs, langid.fit(docs))
    return judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z) the row with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one stays."""
    return near_dedup.drop_near_copies(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stay where they occur first; texts of which nothing else is left go."""
    return substring_dedup.drop_repeats(docs).where(F.length(F.trim("text")) > 0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, as in op5."""
    out = packing.pack(docs, tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language_id", keep_known_languages), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("substring_dedup", cut_repeated_passages), ("packing", pack_sequences)]

# A trained model, sketches and a tokenizer decide, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
