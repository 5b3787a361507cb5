"""The operators' registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from requestmill.llm import (
    bpe,
    decontaminate,
    html_tree,
    merkle,
    mil_quality,
    pii,
    quality_divergence,
    simhash,
    suffix_dedup,
    token_rollup,
    toxicity,
    warc,
    whitening,
)
from requestmill.llm.common import table, written
from requestmill.llm.labelled import Split
from requestmill.llm.oracles import ORACLES
from requestmill.session import working_folder

__all__ = ["ORACLES", "PII_KEY", "QUERIES", "tokenizer_path"]

# A key for tests; a real one comes from a secret store and is passed to the operator.
PII_KEY = b"pseudonym key of the registered query"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_divergence.judged(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_html_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.extract(table(spark, sf_dir, "pages"))


def op1_token_count_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in under two tokenizer versions, every document's first line is then
    cut, documents of under ten words are withdrawn, and one batch is sent a second time."""
    text = F.col("text")
    first = F.substring_index(text, "\n", 1)
    rest_chars = F.greatest(
        token_rollup.chars(text) - token_rollup.chars(first) - 1, F.lit(0).cast("long")
    )
    counts = table(spark, sf_dir, "documents").select(
        "source",
        "lang",
        token_rollup.tokens(text, "words-1").alias("words"),
        token_rollup.tokens(first, "words-1").alias("first_words"),
        token_rollup.tokens(text, "pieces-1").alias("pieces"),
        token_rollup.chars(text).alias("chars"),
        rest_chars.alias("rest_chars"),
    )
    counts = written(
        counts.withColumn("rest_words", F.col("words") - F.col("first_words")), "counts"
    )
    words = token_rollup.counted(counts, "words-1", "words", "chars")
    pieces = token_rollup.counted(counts, "pieces-1", "pieces", "chars")
    revised = token_rollup.counted(counts, "words-1", "rest_words", "rest_chars")
    short = counts.where("words < 10")
    rollup = token_rollup.TokenRollup(spark, working_folder(spark, "llm-rollup"))
    revision = token_rollup.revisions(words, revised)
    rollup.commit("1-words", token_rollup.inserts(words))
    rollup.commit("2-pieces", token_rollup.inserts(pieces))
    rollup.commit("3-first-lines", revision)
    rollup.commit(
        "4-short",
        token_rollup.deletes(
            token_rollup.counted(short, "words-1", "rest_words", "rest_chars").unionByName(
                token_rollup.counted(short, "pieces-1", "pieces", "chars")
            )
        ),
    )
    rollup.commit("3-first-lines", revision)
    return rollup.totals()


def _judged(scores: DataFrame, split: Split) -> DataFrame:
    return scores.select(
        "doc_id",
        split.column(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op4_deep_shallow_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(
        F.transform("spans", lambda s: (s.end - s.start).cast("long")),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_toxicity_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _judged(toxicity.scores(docs, model), toxicity.SPLIT)


def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return found.select(
        "doc_id",
        F.size("__llm_spans").cast("long").alias("n_replaced"),
        F.array_join(F.array_sort(F.array_distinct("__llm_spans.kind")), ",").alias("kinds"),
        "text",
    )


def op8_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path())
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = mil_quality.fit(docs, table(spark, sf_dir, "labels"))
    return _judged(mil_quality.scores(docs, model), mil_quality.SPLIT)


def op11_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new archive of all pages, read back."""
    archive = warc.Archive(spark, working_folder(spark, "llm-warc")).write(table(spark, sf_dir, "pages"))
    return archive.contents().drop("url")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.checked(merkle.manifest(table(spark, sf_dir, "documents")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_count_rollup,
        op2_distribution_divergence,
        op3_benchmark_decontamination,
        op4_deep_shallow_dedup,
        op5_toxicity_deobfuscation,
        op6_simhash_near_dedup,
        op7_feistel_pseudonyms,
        op8_bpe_chunk_reuse,
        op9_attention_quality,
        op10_html_tree_scoring,
        op11_warc_archive,
        op12_merkle_manifest,
        op13_embedding_whitening,
    )
}
