"""The corpus pipeline: five stages from raw documents to packed sequences.

No stage minds other columns, whatever their names; an empty table passes
through all of them.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import delete_folder, load, small_batches, staged_alone, unused_name
from strata.llm.decontamination import decontaminate
from strata.llm.jaccard_join import component_firsts, with_set
from strata.llm.language_id import UND, with_language
from strata.llm.packing import pack
from strata.llm.pii import redact

#: Documents whose language is less certain than this go.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language: those with a letter, and certain enough.
    Every row is judged by its own text; rows without text, or with a blank one,
    go, and so do all if no row has a known language."""
    small_batches(spark)
    lang, score = unused_name(docs, "found_lang"), unused_name(docs, "found_score")
    found = with_language(docs, (lang, score))
    return found.where((F.col(lang) != UND) & (F.col(score) >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one of the smallest id, of each linked group (one
    without an id only if no other is linked). Rows that share an id are judged
    each by its own text: only rows equal in id and set of shingles are repeats,
    of which one stays. Rows without words are linked with nothing; of those
    that share an id one stays."""
    small_batches(spark)
    name = unused_name(docs, "shingle_set")
    found, _ = staged_alone(spark, lambda: component_firsts(docs), "kept")
    rows = with_set(docs, name)
    found = found.toDF("kept_id", "kept_set")
    same = rows["doc_id"].eqNullSafe(found["kept_id"]) & (rows[name] == found["kept_set"])
    return rows.join(found, same, "left_semi").dropDuplicates(["doc_id", name]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows whose text holds a benchmark item. Rows without text hold
    none; rows that share an id, or have none, are judged each by its own text."""
    small_batches(spark)
    return decontaminate(docs, load(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars follows the new text. All rows
    stay, repeated ones each; a null text stays null."""
    small_batches(spark)
    out = redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the stream of all remaining documents into sequences. A null or empty
    text is its end id; repeated rows are packed each; no rows give no pieces."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: A recurrent network, EM and a tokenizer are not SQL: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table. A stage's rows are deleted
    once the next stage's are written."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = staged_alone(spark, lambda d=docs, f=stage: f(spark, d, sf_dir), f"stage-{name}")
        if before:
            delete_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
