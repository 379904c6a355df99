"""The registered queries of this package; each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import alignment, bpe, decontaminate, lines, lm, packing, passages, pii, simhash, toxicity, trie, urls, vectors
from larder.llm.oracle import ORACLE as _SQL

#: Key of the registered query; users pass their own, which they keep secret.
_SURROGATE_KEY = "larder-registered-query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents"), key=_SURROGATE_KEY)


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents")).drop("keep_runs")


def op8_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.without_repeats(table(spark, sf_dir, "documents")).drop("starts", "ends")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), token_file())


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_classes(table(spark, sf_dir, "embeddings"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens of two public tokenizers."""
    return alignment.aligned(table(spark, sf_dir, "documents"), token_file(), token_file("piece_bpe_32k.model"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of what they decode to."""
    back = bpe.round_trip(table(spark, sf_dir, "documents"), token_file())
    return back.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the conversations, each opened by the first turns of the one its group begins with."""
    found = trie.sequences(table(spark, sf_dir, "conversations"))
    return trie.prefix_nodes(trie.with_shared_openings(found))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_toxicity,
        op3_surrogates,
        op4_language_model,
        op5_decontamination,
        op6_url_filter,
        op7_line_dedup,
        op8_passage_dedup,
        op9_packing,
        op10_embedding_dedup,
        op11_token_alignment,
        op12_bpe,
        op13_prefix_trie,
    )
}
ORACLE = {name: _SQL[name] for name in QUERIES if name in _SQL}
