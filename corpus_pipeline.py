"""The training-corpus pipeline: five stages over ``documents``, each stored before the next.

quality rules -> language identification -> near-duplicates -> source mixing -> packing

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of ``documents``:

1. quality rules remove failing lines from texts and reject documents (``text`` and ``n_chars``
   follow the removal, texts without failing lines stay as they were);
2. language identification, learnt on this stage's own input, rejects texts without letters and
   texts in no learnt language;
3. near-duplicates on five-word shingles keep one row of each group, that with the smallest id, nulls
   last (of rows that share an id, the first by a hash of the row);
4. mixing to target weights drops documents and repeats others, as rows;
5. best-fit packing returns a row per piece of a document: its sequence, offset and capacity.

Null texts go in stage 1; repeated rows are one document from stage 3 on, until stage 4 repeats
documents on purpose; rows that share an id, or have none, but differ in text are documents of their own; columns beyond those of ``documents`` are carried along; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgauge.llm import language, mixing, near_text, packing, quality
from shopgauge.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean_documents(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.in_known_language(docs, language.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are judged, not ids: the first row of each group of near-duplicates stays."""
    shared = docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if shared.isEmpty():
        rows, key = docs, "doc_id"
    else:
        # Ids that are null or shared do not tell rows apart: places in id order do, nulls last.
        key = "_row"
        while key in docs.columns:
            key += "_"
        order = [F.col("doc_id").asc_nulls_last(), F.xxhash64(*docs.columns)]
        rows = stored(docs.repartitionByRange(*order).sortWithinPartitions(*order)
                      .withColumn(key, F.monotonically_increasing_id()), "pipeline-rows")
    found = near_text.near_documents(rows, id_col=key, size=5, least=0.8)
    # Only the keys to drop meet the texts.
    drop = stored(found.filter("not kept").select(F.col("doc_id").alias(key)), "pipeline-drop")
    return rows.join(drop, key, "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("near duplicates", near_duplicates),
    ("source mixing", mix_sources),
    ("best-fit packing", best_fit_packing),
]

# Sketches, automata and best-fit packing are beyond SQL; a brute-force version tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir).select(
        F.col("doc_id"), "piece", "piece_start", "n_words", "bin_id", "bin_start",
        "bin_capacity", "bin_used")
