"""From raw documents to packed training sequences: the stages in order, and all of them in one run.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``docs``; ``n_chars``, where
present, follows the text. An empty table passes through all stages. Other columns pass whatever their names: rows travel
as one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.llm import pii
from clickfolk.llm.packing import pack, token_pieces
from clickfolk.llm.queries import TOKENIZERS
from clickfolk.llm.simhash import fingerprints, least_of_components
from clickfolk.llm.substring_dedup import remove_repeats
from clickfolk.llm.tables import table
from clickfolk.llm.toxicity import fit, graded, sample_of, without_toxic
from clickfolk.session import materialise


KEY = "struct<no_id:boolean,id:bigint,of_text:bigint,of_row:bigint>"


def _with_text(docs: DataFrame, columns: list[str], text: Column, row: str) -> DataFrame:
    """The columns held in the struct ``row``, with a new text and its length."""
    out = [text.alias("text") if c == "text" else F.length(text).cast("bigint").alias("n_chars") if c == "n_chars" else
           F.col(row)[c].alias(c) for c in columns]
    return docs.select(*out)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on a bounded sample of ``labels``, calls toxic go."""
    return without_toxic(docs, fit(graded(sample_of(table(spark, sf_dir, "labels"), docs))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row stays: the least by id, then hash of its text, then of the row.

    Rows that share an id are separate rows, each goes by its own group only; a null id comes after all others. Of rows
    equal in every column one stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("bigint").alias("id"),
                   F.xxhash64("text").alias("of_text"), F.xxhash64(*sorted(docs.columns)).alias("of_row"))
    prints = materialise(fingerprints(docs.select(key.alias("key"), "text"), "key", "text", key_type=KEY), "fingerprints")
    alike = prints.groupBy("fp", "doc").agg(F.count("*").alias("n"))
    distinct = materialise(alike.groupBy("fp").agg(F.min(F.struct("doc", "n")).alias("least")), "distinct-fingerprints")
    kept = materialise(least_of_components(distinct).groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.doc").alias("key"), F.col("least.n").alias("n")), "kept-keys")
    found = docs.select(key.alias("key"), F.struct("*").alias("row")).join(kept, "key")
    single = found.where("n = 1").select("row.*")
    if kept.where("n > 1").isEmpty():
        return single
    # few rows here differ: equal ones are combined in each task before they meet
    return single.unionByName(found.where("n > 1").dropDuplicates(["key"]).select("row.*"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of 20 words that start earlier in the corpus go; the rest of the text stays as it was."""
    cut = remove_repeats(docs, window=20, start=10, joined=False, carry=True)
    return _with_text(cut, docs.columns, F.col("kept"), "carried")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data gives way to its kind in brackets."""
    found = pii.find_spans(docs.select("text", F.struct("*").alias("row")))
    masked = found.select("row", pii.masked(F.col("text"), F.col("spans")).alias("masked"))
    return _with_text(masked, docs.columns, F.col("masked"), "row")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048 tokens."""
    pieces = token_pieces(docs, f"{TOKENIZERS}/byte_bpe_50k.json", capacity=2048, end_id=0)
    return pack(pieces, 2048).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None  # SQL can't express the fitted model, the fingerprints and the tokens; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
