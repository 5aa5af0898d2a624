"""From raw documents to packed training sequences: five stages, each by one operator of ``salestide.llm``.

A stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the next
one's documents. All but the last keep the columns of ``documents`` and drop rows. ORACLE_SQL is None: the
classifier, the searches and the tokenizer have no SQL; the stages are tested against brute force.

Null texts count as empty everywhere; null and repeated keys are keys like others; an empty table stays empty, and other
columns are kept as they are, whatever their names. Texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salestide.llm import decontaminate, exact_dedup, ngram_join, packing, quality
from salestide.llm.ship import ship
from salestide.session import materialize, use_small_batches

ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _prepare(spark: SparkSession) -> None:
    ship(spark)
    use_small_batches(spark)


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier, trained on the labelled documents of this input, rejects.

    Equal texts have equal scores, so repeated rows stay or go together. Without labels none is rejected.
    """
    _prepare(spark)
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep the row with the smallest doc_id; of several with that one, and of repeated rows, one.

    Texts are equal when runs of white space count as one space: all empty and null texts are equal.
    """
    _prepare(spark)
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, keep the document with the smallest doc_id.

    As pipeline stages on word shingles do, it takes five words and a similarity of 0.8. Texts without words link with nothing and stay;
    of rows that repeat the smallest doc_id one stays.
    """
    _prepare(spark)
    return ngram_join.keep_one_of_each(docs, size=5, share=80)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark. Texts without words hold none, and items without words are in none."""
    _prepare(spark)
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every piece of the remaining documents in a sequence of at most 1024 tokens; an empty text is its end token."""
    _prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_good_documents),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored before the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
