"""The registered query of every corpus operator: each applies its operator,
with production parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.llm import (
    bitpack, crf_quality, decontam, exact_topk, filter_audit, line_dedup, license_scan, mcd_quality, mixing, pii, prefix_trie,
    pu_toxicity)
from envlake.llm.common import table
from envlake.llm.simhash import simhash_groups

#: Where the public tokenizers' files are; a parameter of the queries that need one.
TOKENIZER_DIR = "/opt/tokenizers"


def tokenizer(name: str = "byte_bpe_50k.json", folder: str = TOKENIZER_DIR) -> bitpack.HfTokenizer:
    try:
        import public_tokenizers
        return bitpack.HfTokenizer(public_tokenizers.path(name))
    except ModuleNotFoundError:
        return bitpack.HfTokenizer(f"{folder}/{name}")


def fold(of: int) -> Column:
    """The remainder of the CRC-32 of the id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License wording of every document."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("hits")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality counts and the robust outlier verdict of every document."""
    return mcd_quality.robust_quality(table(spark, sf_dir, "documents"))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to bit-packed files in id order, and read back."""
    return bitpack.token_index(table(spark, sf_dir, "documents"), tokenizer(), end_id=0)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line and every paragraph removed as a repetition, however short, with its
    offsets and those of the one that stays."""
    return line_dedup.repeated_lines_and_paragraphs(table(spark, sf_dir, "documents")).drop("__row1", "__row2")


def op4_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same: the name under which lines and paragraphs were first listed."""
    return op4_line_dedup(spark, sf_dir)


def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that stands in an earlier document, wherever in its lines."""
    return line_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("__row1", "__row2")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learned from two folds of three."""
    docs = table(spark, sf_dir, "documents")
    model = pu_toxicity.train(docs, table(spark, sf_dir, "labels"), fold(3) != 1)
    out = pu_toxicity.score_toxicity(docs, model, 0.7)
    return out.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every region of a document that matches a benchmark item."""
    hits = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.drop("__row1", "__row2")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: 3-word shingles, 3 bits."""
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mix of its sources."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("__row1", "__row2", "n")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learned from four folds of five."""
    docs = table(spark, sf_dir, "documents")
    model = crf_quality.train(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    out = crf_quality.score_quality(docs, model, 0.3)
    return out.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt with shared first turns."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, for every source, order and step."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors of highest inner product for every vector whose id is divisible by 50."""
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_quality_rules, op3_token_ids, op4_line_dedup, op4_unit_dedup,
                                   op4_passage_dedup, op5_toxicity, op6_decontaminate, op7_pii, op8_simhash, op9_mixing, op10_quality,
                                   op11_prefix_trie, op12_filter_audit, op13_exact_topk)}

#: What SQL can express; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {"op1_license_scan": license_scan.ORACLE, "op4_line_dedup": line_dedup.ORACLE,
                              "op4_unit_dedup": line_dedup.ORACLE, "op4_passage_dedup": line_dedup.PASSAGE_ORACLE,
                              "op7_pii": pii.ORACLE, "op11_prefix_trie": prefix_trie.ORACLE,
                              "op12_filter_audit": filter_audit.ORACLE, "op13_exact_topk": exact_topk.ORACLE}
