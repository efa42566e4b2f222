"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dualpath.llm import ann, bpe, common, conversations, mixing, phrases, quality, simhash, substring, token_counts, tokenfile, topk, toxicity, warc
from dualpath.llm.oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(common.tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_substring_dedup(spark, sf_dir):
    out = substring.dedup(common.table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op6_simhash(spark, sf_dir):
    out = simhash.near_dedup(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op4_token_files(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    manifest, folder = tokenfile.write(docs, common.tokenizer_path("word_bpe_49k.json"), end_id=1)
    return tokenfile.read(spark, manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_token_counts(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, ["doc_id"], common.tokenizer_path("byte_bpe_50k.json"))


@query
def op9_byte_bpe(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    files = common.tokenizer_path("byte_bpe_50k.tiktoken"), common.pattern()
    encoded = bpe.encode_texts(docs, ["doc_id"], *files)
    return bpe.digests(bpe.decode_ids(encoded, ["doc_id", "ids"], *files), ["doc_id"])


@query
def op10_mix(spark, sf_dir):
    out = mixing.mix(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op7_toxicity(spark, sf_dir):
    docs, labels = (common.table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = toxicity.score(docs, ["doc_id"], toxicity.fit(docs, labels))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op2_top_k(spark, sf_dir):
    return topk.top_k(common.table(spark, sf_dir, "embeddings"))


@query
def op3_neighbours(spark, sf_dir):
    return ann.neighbours(common.table(spark, sf_dir, "embeddings"))


@query
def op5_warc(spark, sf_dir):
    archives = warc.write(common.table(spark, sf_dir, "pages"))
    return warc.read(spark, archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"
    )


@query
def op11_phrases(spark, sf_dir):
    return phrases.phrases(common.table(spark, sf_dir, "documents"))


@query
def op13_conversations(spark, sf_dir):
    return conversations.Repair(common.table(spark, sf_dir, "conversations")).report()


@query
def op12_quality(spark, sf_dir):
    docs, labels = (common.table(spark, sf_dir, t) for t in ("documents", "labels"))
    ranked = quality.rank(docs, labels, ["doc_id"])
    return ranked.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
