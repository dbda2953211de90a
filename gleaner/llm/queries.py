"""Registered queries of this subpackage, one per operator, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import chat, decontaminate, hard_negatives, jaccard, langid, packing, phrases, quality, substring, token_output, toxicity, urls, warc
from gleaner.llm.common import read, small_batches, stage
from gleaner.session import ship_package, stage_path

REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    REGISTERED[fn.__name__] = run
    return run


@query
def op1_packing(spark, sf):
    return packing.pack(read(spark, sf, "documents"), with_ids=False).drop("ids")


@query
def op2_jaccard_join(spark, sf):
    return jaccard.similar_sets(read(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


@query
def op3_substring_dedup(spark, sf):
    kept, own = substring.remove_repeats(read(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", *[F.col(own[n]).alias(n) for n in ("n_words", "n_removed", "kept_sha256")])


#: A conversation whose texts hold what a template might take for its own marks.
TRAP = r"\### Assistant: </turn> ok"


@query
def op4_chat_format(spark, sf):
    rows = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = F.array(*[F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role"), F.lit(TRAP).alias("text")) for i, r in enumerate(("user", "assistant"))])
    rows = rows.unionByName(spark.range(1).select(F.inline(extra)))
    return chat.read_back(chat.format_paths(chat.choose_paths(chat.turns_as_tree(rows))))


@query
def op5_training_order(spark, sf):
    path = stage_path(spark, "training-order")
    token_output.write_training_order(read(spark, sf, "documents"), path)
    with small_batches(spark, size=token_output.BATCH_BYTES):  # one shard to a batch, not eight
        written = stage(token_output.digests(token_output.read_training_order(spark, path)), "digests")
    held = spark.read.parquet(f"{path}/manifest")
    return written.join(held, "slot").select("slot", "shard", "byte_offset", "index", "n_ids", "ids_crc32", F.col("pieces.doc_id").alias("doc_ids"), F.col("pieces.start").alias("starts"), F.col("pieces.length").alias("lengths"))


@query
def op6_quality_rules(spark, sf):
    judged = quality.judge_quality(read(spark, sf, "documents"), read(spark, sf, "labels"))
    return judged.select("doc_id", *quality.STATISTICS, "base_failed", "kept")


#: Host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op7_url_filter(spark, sf):
    judged = urls.judge_pages(read(spark, sf, "pages"), urls.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op8_language(spark, sf):
    docs = read(spark, sf, "documents")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs, model)
    return found.select("doc_id", F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op9_decontaminate(spark, sf):
    return decontaminate.report(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query
def op10_warc(spark, sf):
    archive = stage_path(spark, "warc")
    warc.write_archive(read(spark, sf, "pages"), archive, "page_id", "url", "html")
    found = warc.read_archive(spark, archive, with_payload=False)
    return found.select(
        F.col("id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to")
    )


@query
def op11_hard_negatives(spark, sf):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf, "embeddings"), "vec_id", "embedding", moved, F.col("id") % 100 == 0)


@query
def op12_phrases(spark, sf):
    return phrases.top_phrases(read(spark, sf, "documents"))


@query
def op13_toxicity(spark, sf):
    docs = read(spark, sf, "documents")
    scored = toxicity.predict(docs, toxicity.fit(docs, read(spark, sf, "labels")))
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
