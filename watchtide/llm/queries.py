"""The check queries of the operators and, where SQL can express them, the same results in DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchtide.llm.decontaminate import contained_items
from watchtide.llm.importance import resampled
from watchtide.llm.line_dedup import dedup_lines
from watchtide.llm.mixing import mixed
from watchtide.llm.oracle import ORACLE  # noqa: F401
from watchtide.llm.neardup import NearDup, near_duplicates
from watchtide.llm.packing import packed
from watchtide.llm.periodic import with_runs
from watchtide.llm.quality import fit, with_scores
from watchtide.llm.secrets import KNOWN, with_secrets
from watchtide.llm.sharding import grown, planned, with_shards, with_slots
from watchtide.llm.topk import top_k
from watchtide.llm.url_filter import Rule, url_verdicts
from watchtide.llm.warc import archive, read_warc

QUERIES = {}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(given(spark, sf_dir, "documents"), NearDup(shingle=2)).drop("text_hash")


def _spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_secrets(given(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("secrets", lambda s: s["rank"] < len(KNOWN))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind, *_ in KNOWN],
        F.sha2(_spans(base).cast("binary"), 256).alias("base_sha256"),
        _spans(F.col("secrets")).alias("spans"),
    )


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    model = fit(docs, given(spark, sf_dir, "labels"), ~held_out())
    return with_scores(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = planned(16)
    sharded = with_shards(given(spark, sf_dir, "documents"), tree, grown(tree))
    return with_slots(sharded.select("doc_id", "size", "text_crc32", "law", "shard", "grown_shard"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "words", "covered", "coverage", F.size("tiles").alias("n_tiles"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(given(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_warc(spark, archive(given(spark, sf_dir, "pages")))
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).cast("bigint")
    return records.select(
        page("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), "payload_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(given(spark, sf_dir, "documents"), keep=["doc_id"]).drop("copies")


@query
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(given(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


#: The listed rules.
URL_RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of a page is the quality label of the document that has its number: the tables link them no other way."""
    outcomes = given(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return url_verdicts(given(spark, sf_dir, "pages"), outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packed(given(spark, sf_dir, "documents"), *map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def planted(id: Column, text: Column) -> Column:
    """The text, its words made periodic from some word on for one id in ten, as the hash of the id says."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, h = F.size(words).cast("bigint"), F.coalesce(F.crc32(id.cast("string").cast("binary")), F.lit(1))
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    unit = F.slice(words, a + 1, period)
    times = F.ceil((n - a) / period).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), repeated), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    found = with_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    longer = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, lambda best, run: F.when(best.isNull() | longer(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    digest = lambda column: F.sha2(column.cast("binary"), 256)
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), digest(F.array_join(lines, "")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_features", "weight", "score", "rank")
