"""The registered queries of this folder: name -> fn(spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import conversation_repair, line_dedup, mixing, multi_index, ngram_bloom, order_minhash, pii, piece_sampling, pstable, sharding, token_alignment, toxicity, url_filter
from wardline.llm.common import read

Builder = Callable[[SparkSession, str], DataFrame]


def op1_find_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: base kinds and identifiers discovered from their contexts."""
    return pii.pii_report(read(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: class_id is the smallest doc_id of the group."""
    return order_minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to target weights: size, source size, target and words taken."""
    return mixing.mixing_report(read(spark, sf_dir, "documents"))


def op4_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into 8 shards of the same mixture (law rows)."""
    return sharding.shard_report(read(spark, sf_dir, "documents"), 8)


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every vector whose id is divisible by 100."""
    found = multi_index.search_embeddings(read(spark, sf_dir, "embeddings"), 10, 100)
    return found.select("query_id", "rank", "vec_id", "score")


def op6_repeated_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of lines that repeat in the corpus."""
    return line_dedup.line_report(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chained probabilities of low quality and toxicity for every document."""
    return toxicity.toxicity_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text under the smoothed pair model, and under the word model."""
    return ngram_bloom.score_texts(read(spark, sf_dir, "documents"))


def op9_near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with their links (cosine of 0.9 or more) and components."""
    return pstable.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


def op10_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as sampled pieces and back: digests of the ids and of the decoded text."""
    return piece_sampling.encoding_report(read(spark, sf_dir, "documents"))


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned by bytes, with corpus-wide counts of linked id pairs."""
    return token_alignment.alignment_report(read(spark, sf_dir, "documents"))


def op12_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, winning rule and verdict of every page's url."""
    return url_filter.url_report(read(spark, sf_dir, "pages"))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest repair and the repaired text's digest."""
    return conversation_repair.repair_report(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Builder] = {f.__name__: f for f in (op1_find_personal_data, op2_near_duplicates, op3_mix_sources, op4_stratified_shards, op5_nearest_vectors, op6_repeated_line_runs, op7_toxicity, op8_language_model, op9_near_duplicate_vectors, op10_sampled_pieces, op11_align_tokens, op12_url_verdicts, op13_repair_conversations)}

ORACLES: dict[str, str] = {
    "op3_mix_sources": mixing.REPORT_SQL,
    "op4_stratified_shards": sharding.REPORT_SQL,
    "op5_nearest_vectors": multi_index.EXACT_SQL,
    "op6_repeated_line_runs": line_dedup.REPORT_SQL,
    "op9_near_duplicate_vectors": pstable.ALL_PAIRS_SQL,
    "op12_url_verdicts": url_filter.REPORT_SQL,
}
