"""The text pipeline: each stage reads what the one before it has written, and the last packs what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoframe.llm.common import stored, table
from geoframe.llm.mixing import mixed
from geoframe.llm.packing import pack, pieces
from geoframe.llm.quality import accepted
from geoframe.llm.simhash import without_near_copies
from geoframe.llm.suffix import without_repeats

#: Bytes of a repeated passage; 51 words of these languages have more.
PASSAGE = 200
#: A domain is brought to at most so many times its share of the tokens.
MOST = 4.0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that all rules keep, columns as given. Null and empty texts go; an empty table gives no rows."""
    return accepted(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that with the smallest doc_id, columns as given. Null ids and texts stay; an empty table gives no rows."""
    return without_near_copies(docs, shingle=5, similarity=0.8)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without later copies of passages of PASSAGE bytes in text; n_chars follows. Null texts stay null; an empty table gives no rows."""
    return without_repeats(docs, PASSAGE)


def target_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as their rate says, some not at all, columns as given. Rows that repeat are equal. An empty table gives no rows.

    The rules before have removed most of a domain, so a target is at most MOST times the share that is left of its domain.
    Rows with a null id are one group with one rate.
    """
    return mixed(docs, table(spark, sf_dir, "labels"), most=MOST)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece, as of op9_packing. Each row of docs is packed, repeated ones too; a null text is a document of one separator."""
    return pack(pieces(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("target_mixing", target_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: The classifier, the rates and the tokens have no SQL; tests compare the stages' operators with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
