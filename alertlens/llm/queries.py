"""Registered queries of the training-data operators and their DuckDB oracle."""
from __future__ import annotations

from pyspark.sql import functions as F

from alertlens.llm import adapt_join, bloom_cascade, bpe, decision_list, hilbert, importance, line_dedup, mixing, mtree, periodic_runs, pitman_yor, secret_grammar, suffix_dedup
from alertlens.llm.common import table


def op1_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_line_edits(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"), short=True)


def op3_pitman_yor(spark, sf_dir):
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def op4_suffix_arrays(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), texts=False).withColumnRenamed("kept", "kept_sha256")


def op5_mtree(spark, sf_dir):
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


def op6_adaptive_jaccard(spark, sf_dir):
    return adapt_join.similar_groups(table(spark, sf_dir, "documents"))


def word_vocabulary() -> str:
    """Place of the tokenizer file; it is read in place and never copied."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), word_vocabulary())


def op8_bloom_cascade(spark, sf_dir):
    return bloom_cascade.judge(table(spark, sf_dir, "pages"))


def op9_hilbert_shards(spark, sf_dir):
    return hilbert.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_decision_list(spark, sf_dir):
    return decision_list.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_secret_grammar(spark, sf_dir):
    return secret_grammar.report(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.report(table(spark, sf_dir, "documents"))


def op13_importance(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_line_edits, op3_pitman_yor, op4_suffix_arrays, op5_mtree, op6_adaptive_jaccard, op7_bpe, op8_bloom_cascade, op9_hilbert_shards, op10_decision_list, op11_secret_grammar, op12_periodic_runs, op13_importance)}

LLM_ORACLE = {
    "op1_mix_sources": mixing.ORACLE,
    "op5_mtree": mtree.ORACLE,
    "op6_adaptive_jaccard": adapt_join.ORACLE,
    "op8_bloom_cascade": bloom_cascade.ORACLE,
    "op9_hilbert_shards": hilbert.oracle(),
    "op12_periodic_runs": periodic_runs.ORACLE,
    "op13_importance": importance.ORACLE,
}
