"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir), is written as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``; where a stage changes a text it also sets ``n_chars``. A document whose text a stage
removes as a whole goes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loupeline.llm import decontamination, language, packing, queries, simhash, substring_dedup
from loupeline.session import written

LEAST_FIT = 0.0  # n-grams have to be likelier in the language than evenly drawn ones: clean texts of the given tables have 3 and more, random letters less than -0.5
SIMILARITY = (4, 5)  # Jaccard, as p / q, of the five-word shingles of two documents from which on they are near copies


def _with_text(docs: DataFrame, columns: list[str], text: str, changed: str) -> DataFrame:
    """``docs`` with another text where it changed; nothing else of a document that stays as it was is touched."""
    new = {"text": F.col(text), "n_chars": F.when(F.col(changed), F.length(text).cast("bigint")).otherwise(F.col("n_chars"))}
    return docs.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents with letters whose n-grams fit the language that is recognised; what no learned language explains goes."""
    model = language.learn(docs.where(queries.remainder(4) != 2))
    given = {name: f"_{name}" for name in ("score", "lang_pred", "fit")}
    found = language.identify(docs.withColumnsRenamed(given), model, fit="fit")
    kept = found.where((F.col("lang_pred") != "und") & (F.col("fit") >= LEAST_FIT)).drop(*given)
    return kept.withColumnsRenamed({new: name for name, new in given.items()}).select(*(f"`{c}`" for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest number of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs, similarity=SIMILARITY)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that stand earlier in the corpus."""
    cut = substring_dedup.remove_repeats(docs)
    left = cut.where("n_removed = 0 or n_removed < n_words").withColumn("_changed", F.col("n_removed") > 0)
    return _with_text(left, docs.columns, "kept_text", "_changed")


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts phrases of the test set."""
    found = decontamination.decontaminate(docs, queries.read(spark, sf_dir, "benchmark"))
    left = found.where("n_hit = 0 or n_hit < n_words").withColumn("_changed", F.col("n_hit") > 0)
    return _with_text(left, docs.columns, "clean_text", "_changed")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences."""
    return packing.pack(docs, queries.tokenizer_path(), size=2048, end_id=0)


STAGES = [("language_id", identify_language), ("simhash_near_dedup", drop_near_copies), ("substring_dedup", cut_repeats),
          ("benchmark_decontamination", cut_benchmark), ("best_fit_packing", pack)]
ORACLE_SQL = None  # a trained model, fingerprints and token ids: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
