"""The operators as registered queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from . import (
    ann,
    chat,
    hard_negatives,
    lang_id,
    main_text,
    mixing,
    near_dup,
    packing,
    quality,
    secrets,
    substring,
    url_rules,
    whitening,
)
from .words import word_count


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = lang_id.learn(docs.filter(~held_out))
    named = lang_id.predict(docs.select("doc_id", "text"), model).drop("text")
    spans = F.size("spans").cast("long").alias("n_spans")
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", spans)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string"
    )
    formatted = chat.conversations(chat.chain(rows.unionByName(extra)))
    read = F.transform(chat.parsed(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat.masked(F.col("formatted"), F.col("loss"))
    return formatted.select(
        F.col("tree").alias("conv_id"),
        F.size(chat.parsed(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(F.array_join(read, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).drop("factors")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.quality_rules(docs).drop("text", "lang")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.url_filter(pages).select("page_id", "host", "path", "rule", "verdict")


def op7_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size")
    )
    mixed = mixing.mix(stage(docs, "mix-sizes"))
    taken = F.col("copies") * F.col("size")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "rate", "copies")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs).drop("text")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, secrets.BASE),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in bins; copies of a text are a cluster."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("cluster"),
        word_count(F.col("text")).alias("size"),
    )
    return packing.pack(stage(docs, "pack-sizes"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row has its label moved on by one."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract(pages).drop("html")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_chat_format": op2_chat_format,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_url_filter": op6_url_filter,
    "op7_ann_search": op7_ann_search,
    "op8_mix_sources": op8_mix_sources,
    "op9_secret_scan": op9_secret_scan,
    "op10_packing": op10_packing,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_main_text": op13_main_text,
}
