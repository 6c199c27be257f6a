"""A training-corpus pipeline: each stage works on what the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return the columns of ``documents``. ``run`` applies them to the
table ``documents``, each result written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import language, line_dedup, mixing, pieces, simhash
from webloom.llm.common import fresh, stage

VOCABULARY = "piece_bpe_32k.model"
#: Shingle length and largest number of differing bits, as in ``op5_simhash``.
NEAR = {"words": 3, "distance": 2}


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages: texts without a letter and ambiguous ones go.

    Null and empty texts have no letter. Repeated rows are judged alike; all columns stay.
    """
    model = language.train(docs, ~language.held_out())
    return language.keep_identified(docs, model)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that one of smaller id holds; ``n_chars`` follows the text.

    A null text stays null. Rows that share an id are one document; rows without an id are one
    that comes after all others. All columns stay, whatever their names.
    """
    out, before, went = line_dedup.drop_lines(docs, line_dedup.lost_lines(docs))
    out = out.drop(before, went)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id from each group of near-duplicates, all columns as they are.

    Groups are those of the SimHash operator. Rows without an id come after all others, and of
    rows that share the smallest id one stays. Null texts and texts without words are one group.
    An empty table stays empty.
    """
    return simhash.one_of_each(docs, **NEAR)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says, on average; those without an id once.

    Rows that share an id occur equally often. All columns stay, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    times = fresh(docs, "copies")
    mixed = mixing.mix(docs, labels).where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("copies").alias(times)
    )
    joined = docs.join(mixed, "doc_id", "left").withColumn(times, F.coalesce(times, F.lit(1)))
    each = F.explode(F.sequence(F.lit(1), F.col(times)))
    repeated = joined.where(F.col(times) > 0).withColumn(times, each)
    return repeated.select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_pieces, n_byte_pieces, ids_hash, decoded_sha256, round_trip) of each row."""
    model = pieces.Model(spark, public_tokenizers.path(VOCABULARY))
    decoded = pieces.decode(pieces.encode(docs, model), model)
    return pieces.checked(decoded).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_domains),
    ("sentencepiece", encode_pieces),
]

#: SQL cannot express trained classifiers and tokenizers: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
