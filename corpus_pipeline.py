"""Corpus pipeline: toxic documents go, one of each group of near-duplicates stays, repeated passages
and contaminated documents go, and the rest becomes tokens.

``STAGES`` lists (name, function); each takes (spark, docs, sf_dir) and returns a DataFrame, which
``run`` writes to the shared folder as Parquet and reads again as the next stage's docs. All but the
last return the columns that they got. Columns travel under neutral names, so that none clashes with an operator's
results. The operators' docstrings define what null and empty texts, ties, repeated rows and empty tables give.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cupom.llm import bpe, fm_index, probminhash, suffix_dedup, toxicity
from cupom.llm.common import ship, stored, table
from cupom.llm.queries import vocabulary

#: Some stages have no SQL (learned weights, sketches, byte pairs); tests compare them with brute force.
ORACLE_SQL = None


def _shielded(docs: DataFrame, apply: Callable[[DataFrame, str, str], DataFrame]) -> DataFrame:
    """``apply(docs, id column, text column)`` with neutral column names; the given columns under their own names again."""
    ship(docs.sparkSession)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    out = apply(docs.toDF(*names), names[docs.columns.index("doc_id")], names[docs.columns.index("text")])
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")

    def apply(rows: DataFrame, key: str, text: str) -> DataFrame:
        lexicon = toxicity.learn(rows, labels.withColumnRenamed("doc_id", key), key, text)
        return toxicity.score(rows, lexicon, text).where("predicted = 0")

    return _shielded(docs, apply)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _shielded(docs, probminhash.keep_one)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of earlier documents; ``n_chars`` follows the text."""
    out = _shielded(docs, suffix_dedup.dedup)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return _shielded(docs, lambda rows, _, text: fm_index.decontaminate(rows, benchmark, text).where("not contaminated"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): ids as little-endian unsigned 32-bit integers; whether they decode to the text."""
    ship(spark)
    # Executors that ran the other stages have grown heaps: the encoders keep less than they would alone.
    both = bpe.round_trip(docs.select("doc_id", "text"), vocabulary(spark, states=100_000, pieces=100_000))
    return both.select("doc_id", "n_tokens", "ids", (F.coalesce("text", F.lit("")).cast("binary") == F.col("decoded")).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("benchmark_contamination", drop_contaminated),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
