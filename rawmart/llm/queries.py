"""Registered queries of the training-data operators: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, hyperminhash, knn, langid, license_scan, mixing, oracles, pii, resampling, runs, sentence_pieces, sharding, substring_dedup, suffix_index
from .text import documents

#: place of the vocabulary file; a parameter of the queries that need it
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(documents(spark, sf_dir), k=3, percent=85)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    model = langid.fit(docs.where((remainder != 1) & F.col("lang").isNotNull()))
    found = langid.identify(docs, model)
    return found.select("doc_id", (remainder == 1).alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["first"])).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 50 == 0, k=5)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_windows(documents(spark, sf_dir), 50)


def op6_suffix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.dedup_bytes(documents(spark, sf_dir), 50)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.histogram_shards(documents(spark, sf_dir), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.find_pii(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select("doc_id", *[count(k) for k in pii.BASE_KINDS], F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"), F.transform("spans", lambda s: s["score"]).alias("scores"))


def op10_sentence_pieces(spark: SparkSession, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    decoded = sentence_pieces.round_trip(documents(spark, sf_dir), model_path)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=10)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with the contract's periods: where crc32(doc_id) is divisible by 10, the words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    start = (g % n).cast("int")
    rest = n - F.col("a")
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({mixing.WORD})"), 1)))
    rows = rows.withColumn("a", F.when(n > 0, start)).withColumn("p", (1 + F.floor(rest / (3 + g % 8))).cast("int"))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    passes, over = F.floor(rest / F.col("p")).cast("int"), (rest % F.col("p")).cast("int")
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.flatten(F.array_repeat(period, passes)), F.slice("words", F.col("a") + 1, over))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse_runs(with_planted_periods(documents(spark, sf_dir)), min_length=24, min_exponent=3)

    def first(x: Column, y: Column) -> Column:
        more = y["length"] * x["period"] - x["length"] * y["period"]
        return F.when(more != 0, F.signum(more)).when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(x["period"] - y["period"])).cast("int")

    top = F.get(F.array_sort("runs", first), F.lit(0))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    rows = found.select("doc_id", "runs", "collapsed", top.alias("top"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_language_id": op2_language_id,
    "op3_license_scan": op3_license_scan,
    "op4_top_k": op4_top_k,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_suffix_index": op6_suffix_index,
    "op7_decontamination": op7_decontamination,
    "op8_histogram_sort": op8_histogram_sort,
    "op9_pii": op9_pii,
    "op10_sentence_pieces": op10_sentence_pieces,
    "op11_mixing": op11_mixing,
    "op12_resampling": op12_resampling,
    "op13_runs": op13_runs,
}

#: the others learn a model, draw samples, cut by hashes or match with a tolerance; tests hold them against brute force
ORACLE: dict[str, str] = {
    "op1_minhash": oracles.NEAR_DUPLICATES,
    "op4_top_k": oracles.TOP_K,
    "op5_substring_dedup": oracles.WINDOW_DEDUP,
    "op6_suffix_index": oracles.BYTE_DEDUP,
    "op11_mixing": oracles.MIXING,
    "op12_resampling": oracles.RESAMPLING,
    "op13_runs": oracles.RUNS,
}
