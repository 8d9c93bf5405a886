"""The training-corpus pipeline over ``documents``.

Five stages, each over all that the one before it kept:

1. the quality classifier scores every document; those below its threshold go;
2. of each group of near copies (five words, similarity 0.8 or more) one
   document stays;
3. documents that hold a benchmark item, in one piece or in several, go;
4. the sources are mixed to their target weights: a row for each copy that
   the mix takes of a document, the last one of a source cut to the quota;
5. the mix is encoded into wavelet-matrix shards and read back.

A stage's rows are written as Parquet and read again as the next one's
documents, so a lost executor costs at most a stage.

Every stage takes documents with nulls in any column, empty and very long texts,
repeated rows and columns of any other names, and an empty table, which gives one:

* ``classify`` scores a null or empty text like any other and drops it if the
  classifier rejects it; a null doc_id is scored too; repeated rows stay.
* ``drop_near_copies`` keeps every document without words (it is linked with
  nothing) and one row of repeated ones; ties go to the smallest doc_id, nulls last.
* ``decontaminate`` keeps null and empty texts; rows that share a doc_id are judged by
  their own text.
* ``mix`` draws no document without words; a null source is a source of its own.
* ``encode`` gives a null text the end id alone; null keys come first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import mixing, neardup, quality, tiling, wavelet
from kestrel.llm.common import delete, read, stored, unused, work_dir, workspace
from kestrel.llm.queries import tokenizer_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the classifier adds these two columns; those of the table that have their names wait
    added = [c for c in docs.columns if c.lower() in ("score", "predicted")]
    other = dict(zip(added, unused(docs.columns, *added)))
    marked = quality.scored(docs.withColumnsRenamed(other), read(spark, sf_dir, "labels"))
    kept = marked.where("predicted = 1").drop("score", "predicted")
    return kept.withColumnsRenamed({v: k for k, v in other.items()}).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tiling.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.drawn(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return wavelet.tokenized(docs, tokenizer_path())


STAGES = [
    ("quality classifier", classify),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", encode),
]

#: a trained classifier and a tokenizer are outside SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        # what a stage writes on the way goes with its end, its input with the next one's
        with workspace(spark, f"pipeline-stage-{k}"):
            docs = stored(stage(spark, docs, sf_dir), f"{path}/{k}")
        if k:
            delete(spark, f"{path}/{k - 1}")
    return docs
