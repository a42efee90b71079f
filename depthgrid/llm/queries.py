"""One query per operator, over whole tables, with the production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthgrid.llm import (
    centroids,
    decontaminate,
    exact_dedup,
    main_text,
    mixing,
    near_dedup,
    pii,
    quality,
    suffix_dedup,
    token_count,
    token_links,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


#: Bytes of text that go to a Python worker at once; the default of 64 MB is held several times.
ARROW_BYTES = "16m"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Workers started from elsewhere are told where this package lies (on a
    cluster it has to be installed or submitted with the job), and get texts in small batches.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    workers = spark.sparkContext.environment
    if ROOT not in workers.get("PYTHONPATH", "").split(os.pathsep):
        workers["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, workers.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark, sf_dir):
    folder = warc.archive_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, with_payload=False).select(
        F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = main_text.main_texts(pages, main_text.fit(pages), text_col="text")
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_token_count(spark, sf_dir):
    import public_tokenizers

    counted = token_count.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_mix_sources(spark, sf_dir):
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op6_suffix_dedup(spark, sf_dir):
    spans = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "start_word", "end_word", "n_words")


def op7_minhash_dedup(spark, sf_dir):
    return near_dedup.link_components(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir):
    found = exact_dedup.exact_groups(
        table(spark, sf_dir, "documents"), carry=exact_dedup.full_digest(F.col("text"))
    )
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.col("carried").alias("text_sha256")
    )


def op9_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.fit(docs))


def op10_decontaminate(spark, sf_dir):
    return decontaminate.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_quality(spark, sf_dir):
    scored = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        F.col("__id").alias("doc_id"),
        quality.held_out(F.col("__id")).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"),
    )


def op12_token_links(spark, sf_dir):
    import public_tokenizers

    return token_links.align_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op13_centroids(spark, sf_dir):
    found = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_main_text": op2_main_text,
    "op3_token_count": op3_token_count,
    "op4_toxicity": op4_toxicity,
    "op5_mix_sources": op5_mix_sources,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_personal_data": op9_personal_data,
    "op10_decontaminate": op10_decontaminate,
    "op11_quality": op11_quality,
    "op12_token_links": op12_token_links,
    "op13_centroids": op13_centroids,
}
