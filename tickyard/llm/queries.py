"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import fresh_dir, use_utc
from ..sources.tables import table
from . import (bpe, decontaminate, fill_in_middle, hard_negatives, html_extract, near_dedup, quality_classifier,
               quality_rules, sharding, token_counts, token_files, url_filter, warc_zip)
from . import oracles
from .common import QueryFn

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SHARDS = 8
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


@register("op1_html_extract")
def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


@register("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them, as digests."""
    path = public_tokenizers.path(TOKENIZER)
    both = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    digits = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op4_quality_rules", oracles.OP4)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of the learned fences for every document."""
    judged = quality_rules.rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


@register("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document from a model fitted on the training fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.scores(docs, quality_classifier.train(docs, labels))


@register("op9_near_dedup", oracles.OP9)
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over two-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


@register("op3_decontaminate", oracles.OP3)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) where the document holds the item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from the token files."""
    path = fresh_dir(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path,
                             public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.with_starts(token_files.read_tokens(spark, path))


@register("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes, equal texts together."""
    packed = sharding.pack(table(spark, sf_dir, "documents"), shards=SHARDS)
    return packed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@register("op6_warc_zip", oracles.OP6)
def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from ZIP-packaged archives."""
    path = fresh_dir(spark, "warc")
    warc_zip.write_archives(table(spark, sf_dir, "pages"), path)
    return warc_zip.read_archives(spark, path).drop("payload", "url")


@register("op7_url_filter")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL; the model learns from the URLs that rules decide."""
    pages = table(spark, sf_dir, "pages")
    model = url_filter.train(url_filter.labelled_by_rules(pages, URL_RULES))
    return url_filter.judge(pages, URL_RULES, model, "page_id")


@register("op11_hard_negatives", oracles.OP11)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor and positive of the embeddings."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


@register("op12_fill_in_middle", oracles.OP12)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's form and cuts; digests of its output and of the text restored from it."""
    made = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256"))


@register("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
