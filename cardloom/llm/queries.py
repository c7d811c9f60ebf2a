"""One query for each operator, on the whole table it is made for."""

from __future__ import annotations

import base64
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm import (
    chat,
    decontaminate,
    html_wrapper,
    lm_score,
    ngram_join,
    packing,
    quality,
    token_alignment,
    toxicity,
    url_filter,
    vector_codes,
    warc,
    wordpiece,
)
from cardloom.llm.common import table
from cardloom.sources.staging import stage_path

RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)


def labelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``host, bad`` of every page whose document is labelled: the last part of a
    page's path is the number of its document, and it is bad with quality 0 or toxic."""
    url = F.col("url")
    pages = table(spark, sf_dir, "pages").select(
        url_filter.host_of(url).alias("host"),
        F.expr("try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) as bigint)").alias(
            "doc_id"
        ),
    )
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.expr("cast(quality = 0 or toxic = 1 as int)").alias("bad")
    )
    return pages.join(labels, "doc_id").select("host", "bad")


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, labelled_pages(spark, sf_dir), RULES).drop("lower")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document and item that occurs in it: how many windows do, the
    fewest edits of one, and where the found part begins and ends."""
    found = decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.groupBy("doc_id", "item_id").agg(
        F.count_distinct("item_start").alias("n_windows"),
        F.min("edits").alias("edits"),
        F.min("doc_start").alias("doc_start"),
        F.max("doc_end").alias("doc_end"),
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), n=4, percent=85)


def op4_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["length"]))
    return out.withColumn("mask", F.concat_ws(",", spans))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("good")


def vocabulary() -> list[bytes]:
    """The byte strings of a public byte-level vocabulary."""
    lines = Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes().splitlines()
    return [base64.b64decode(line.split()[0]) for line in lines if line]


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.rewrite(table(spark, sf_dir, "pages"), stage_path(spark, "archives"))


def tokenizer() -> str:
    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = toxicity.train(docs, labels)
    return docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        toxicity.score_column(model)(F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.main_text(table(spark, sf_dir, "pages"))


def alignment_files() -> tuple[str, bytes]:
    """A byte-level tokenizer's file and a sentencepiece model."""
    return (
        Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8"),
        Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes(),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.token_alignment(table(spark, sf_dir, "documents"), *alignment_files())


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_reputation,
        op2_decontaminate,
        op3_ngram_join,
        op4_perspectives,
        op5_quality_rules,
        op6_token_counts,
        op7_pseudo_likelihood,
        op8_warc_revisits,
        op9_packing,
        op10_toxicity,
        op11_main_text,
        op12_token_alignment,
        op13_vector_codes,
    )
}
