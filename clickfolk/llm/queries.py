"""Registered queries of the numbered operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfolk.catalog.registry import Query
from clickfolk.llm import ann, chat, oracles, periodic_runs, pieces, pii, toxicity, url_filters
from clickfolk.llm.filter_audit import audit
from clickfolk.llm.html_wrapper import extract_articles
from clickfolk.llm.packing import pack, token_pieces
from clickfolk.llm.repetition import repetition_rules
from clickfolk.llm.simhash import near_duplicates
from clickfolk.llm.substring_dedup import remove_repeats
from clickfolk.llm.tables import table

TOKENIZERS = "/opt/tokenizers"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts and digests of the base kinds, and all spans."""
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["order"] < len(pii.BASE))
    counts = [pii.number_of("spans", kind).cast("bigint").alias(f"n_{kind.name}") for kind in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.digest(base), 256).alias("base_sha256"),
                        pii.digest(F.col("spans")).alias("spans"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    rows = toxicity.sample_of(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))
    return toxicity.fit(toxicity.graded(rows))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, by a model fitted on a bounded sample of the labels."""
    return toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of the repetition rules."""
    return repetition_rules(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    pieces = token_pieces(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", capacity=2048, end_id=0)
    return pack(pieces, 2048).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing every 20-word passage that starts earlier in the corpus."""
    out = remove_repeats(table(spark, sf_dir, "documents"), window=20, start=10)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = near_duplicates(table(spark, sf_dir, "documents"), size=3, bits=3)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best segmentations of every document into pieces; the best one is decoded again."""
    return pieces.nbest_digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model", 3)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that says control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.format_chats(rows.unionByName(extra)))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest neighbours of every 50th vector."""
    vectors = table(spark, sf_dir, "embeddings")
    router = ann.fit(ann.usable(vectors, "vec_id", "embedding"))
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"), k=5, router=router)


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = extract_articles(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each source at each step of all their orders."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of them made periodic first."""
    text = periodic_runs.planted(F.col("doc_id"), F.col("text"))
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), text=text)
    best = found.withColumn("best", periodic_runs.longest_run(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest fitting rule and the verdict of every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


QUERIES: dict[str, Query] = {
    "op1_pii": Query(op1_pii, oracles.PII),
    "op2_toxicity": Query(op2_toxicity),
    "op3_repetition": Query(op3_repetition),
    "op4_packing": Query(op4_packing),
    "op5_substring_dedup": Query(op5_substring_dedup, oracles.SUBSTRINGS),
    "op6_simhash": Query(op6_simhash),
    "op7_pieces": Query(op7_pieces),
    "op8_chat": Query(op8_chat, oracles.CHATS),
    "op9_ann": Query(op9_ann),
    "op10_html": Query(op10_html),
    "op11_filter_audit": Query(op11_filter_audit, oracles.FILTER_AUDIT),
    "op12_periodic_runs": Query(op12_periodic_runs),
    "op13_url_filters": Query(op13_url_filters, oracles.URL_FILTERS),
}
