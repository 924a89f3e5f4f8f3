"""Queries over whole tables, one for each operator of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import ball_search, minhash, mixing, pieces, pii, secret_scan, sharding, toxicity, vectors, web_pages, word_bpe, word_runs
from rollbook.llm.common import WORD, span_list, table

_OUT: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _OUT[fn.__name__] = fn
    return fn


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_OUT)


def _digest(found: DataFrame, base: tuple[str, ...], kinds: tuple[str, ...]) -> list[Column]:
    """Counts by base kind, digest of the base spans, all spans."""
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return [
        *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(span_list(of(base), base), 256).alias("base_sha256"),
        span_list(F.col("spans"), kinds).alias("spans"),
    ]


@query
def op1_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf, "documents"))
    return found.select("doc_id", *_digest(found, pii.BASE, pii.KINDS))


@query
def op2_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf, "documents"))
    return found.select("doc_id", *_digest(found, secret_scan.BASE, secret_scan.KINDS))


@query
def op3_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode(table(spark, sf, "documents")).select("doc_id", "n_pieces", "lossless", "ids")


@query
def op4_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op5_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return web_pages.extract(table(spark, sf, "pages"))


@query
def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf, "documents"))


@query
def op7_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op8_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf, "embeddings"))


@query
def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.rate(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op10_shards(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; one document in ten repeats a stretch of its words to its end, by a rule on its id."""
    given = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)))
    given = given.withColumn("words", words).withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    given = given.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    given = given.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest)), " ")
    return given.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = word_runs.find_runs(_with_repeats(table(spark, sf, "documents")))
    more = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda y, x: F.when(more(x, y), x).otherwise(y))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{k}").alias(k) for k in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return ball_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op13_word_bpe(spark: SparkSession, sf: str) -> DataFrame:
    encoded = word_bpe.encode(table(spark, sf, "documents"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
