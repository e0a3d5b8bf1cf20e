"""The registered queries of this folder, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salespect.llm import decontaminate, exact_dedup, html_text, jaccard_join, language, packing, quality, spelling, token_counts, toxicity, vectors, wavelet, whitening

BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BYTE_BPE)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.wavelet_round_trip(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), tokenizer_path())


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("row_key")


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1, digests=True))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(toxicity.training_rows(docs, _table(spark, sf_dir, "labels"))))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "pages"), *language.train(_table(spark, sf_dir, "documents")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark, f"{sf_dir}/documents.parquet")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_wavelet, op2_token_counts, op3_quality, op4_html_text, op5_jaccard, op6_vectors, op7_decontaminate, op8_pack, op9_toxicity, op10_language, op11_whitening, op12_exact_dedup, op13_spelling)
}

# Models, tokenizers and similarity joins are beyond SQL.
ORACLE: dict[str, str] = {
    "op12_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
