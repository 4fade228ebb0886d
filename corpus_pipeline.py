"""From raw documents to token ids in training order, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``, and any others that these have, whatever their names.

Defined cases, beside those of each operator: a NULL, empty or wordless text fails the
first stage's rules; of repeated rows, one stays after the third; a row that is taken
several times comes as often from the fourth on; an empty table goes through all stages.

Each stage sets the session's batches to few rows (``weir.session.configure_texts``), as
rows hold whole texts; the setting stays, as the stage's result is computed later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import dart_minhash, line_dedup, mixing, pieces, quality_rules
from weir.llm.common import read, stored
from weir.llm.queries import PIECES
from weir.session import configure_texts


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted trees."""
    configure_texts(spark)
    trees = quality_rules.learn(docs, read(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, trees)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go but for one occurrence; so do documents made of nothing else."""
    configure_texts(spark)
    n = "__lines_cut"
    cut = line_dedup.dedup_lines(docs, removed=n)
    left = cut.where((F.col(n) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.when(F.col(n) > 0, F.length("text").cast("bigint"))
    return left.withColumn("n_chars", F.coalesce(changed, "n_chars")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    configure_texts(spark)
    return dart_minhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time a document is trained on, in training order."""
    configure_texts(spark)
    return mixing.training_order(docs, mixing.cycling_schedules(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip)."""
    configure_texts(spark)
    return pieces.encode_documents(docs, PIECES)


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", without_boilerplate),
    ("near-duplicate documents", one_of_each),
    ("mixing", mixed),
    ("pieces", encoded),
]

#: Boosted trees, signatures and merges have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(configure_texts(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), "corpus-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
