"""One query per operator over the whole given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetschema.llm import (
    alignment,
    decontaminate,
    embeddings,
    html,
    linedup,
    mixing,
    pii,
    quality,
    sharding,
    simhash,
    substring,
    tokenids,
    whitening,
)
from fleetschema.llm.common import table
from fleetschema.llm.sql import ORACLES
from fleetschema.staging import new_folder, stage

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality.fit(docs, labels.where(quality.learnable("doc_id")))
    return quality.score_quality(docs, model).select(
        "doc_id",
        (~quality.learnable("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.KEEP).cast("int").alias("predicted"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_counts(substring.dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text")))


def _with_counts(cut: DataFrame) -> DataFrame:
    lines = F.aggregate("removed", F.lit(0), lambda n, s: n + s["lines"])
    return cut.select("doc_id", "text", "removed", lines.cast("long").alias("n_removed"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_hits(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    )
    names = F.array_sort(F.transform("hits.items", lambda i: i.cast("string")))
    hit = decontaminate.n_hit("hits")
    return found.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    # the result has no text, so only what is worked out from it goes through the joins
    text = F.col("text")
    docs = docs.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        sharding.text_size(text).alias("size"),
        sharding.text_crc(text).alias("text_crc32"),
        sharding.text_unit(text).alias("unit"),
    )
    dealt = sharding.shard_documents(docs, weight=F.col("size"), unit=F.col("unit"), shards=8)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_counts(linedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text")))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = pii.pseudonymise(table(spark, sf_dir, "documents", "doc_id", "text"))
    return changed.select("doc_id", "text", "replaced", F.size("replaced").cast("long").alias("n_replaced"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_duplicate_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return marked.select("doc_id", simhash.hex_print("fingerprint").alias("fingerprint"), "component_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-archive")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    tokenids.write_ids(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return tokenids.read_ids(spark, folder).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_tokenizers(docs, a, b).select(
        F.col("key").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    model = whitening.fit(vectors, "embedding", components=8)
    rows = stage(whitening.whiten(vectors, "embedding", model).drop("embedding"), "whitened")
    error = whitening.identity_error(rows, "whitened", len(model.values))
    explained = F.array(*[F.lit(x) for x in model.explained]).cast("array<double>")
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        F.element_at(explained, F.col("place") + 1).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_substring_dedup,
        op3_decontamination,
        op4_embedding_near_dedup,
        op5_html_extraction,
        op6_sharding,
        op7_line_dedup,
        op8_pii,
        op9_simhash_near_dedup,
        op10_mixing,
        op11_token_ids,
        op12_token_alignment,
        op13_embedding_whitening,
    )
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
