"""One query for each operator, over its whole table."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import bpe, counting, cuckoo, jaccard, language, licenses, mixing, packing, repeats, sharding, trie, vectors, whitening
from tidemark.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

TOKEN_LIMIT = 4096


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_shards")
def op1(spark, sf_dir):
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


@query("op2_jaccard_join", jaccard.JACCARD_SQL)
def op2(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), n=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


@query("jaccard_links")
def links(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), n=3, percent=90).drop("mark")


@query("op3_language_id")
def op3(spark, sf_dir):
    return language.document_languages(table(spark, sf_dir, "documents")).drop("mark")


@query("page_languages")
def pages(spark, sf_dir):
    model = language.fit(table(spark, sf_dir, "documents"))
    return language.page_languages(table(spark, sf_dir, "pages"), model)


@query("op4_exact_dedup", cuckoo.DEDUP_SQL)
def op4(spark, sf_dir):
    return cuckoo.exact_duplicates(table(spark, sf_dir, "documents")).drop("mark")


@query("op5_bpe")
def op5(spark, sf_dir):
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"),
                             finish=bpe.digest_rows, schema=bpe.DIGESTS)


@query("op6_mix", mixing.MIX_SQL)
def op6(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("mark")


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query("op7_repeats")
def op7(spark, sf_dir):
    return repeats.without_repeats(table(spark, sf_dir, "documents"), finish=repeats.digest_rows,
                                   schema=repeats.DIGESTS)


@query("op8_token_counts")
def op8(spark, sf_dir):
    counts = counting.token_counts(table(spark, sf_dir, "documents"),
                                   vocabulary("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op9_license_scan")
def op9(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op10_top_k", vectors.TOP_K_SQL)
def op10(spark, sf_dir):
    return vectors.top_k(table(spark, sf_dir, "embeddings"))


@query("op11_whitening")
def op11(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query("op12_prefix_trie", trie.TRIE_SQL)
def op12(spark, sf_dir):
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_packing")
def op13(spark, sf_dir):
    cut = packing.pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"),
                         with_ids=False)
    return packing.packed(cut)
