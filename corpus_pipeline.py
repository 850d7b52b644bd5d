"""Corpus pipeline: documents through five of the training-data operators, one stage after another.

Each stage takes what its predecessor kept, with the columns of ``documents``, and returns the same columns; the last one returns
the sampled ids and the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rawmart.llm import decontam, hyperminhash, langid, pii, sentence_pieces
from rawmart.llm.queries import PIECE_MODEL
from rawmart.llm.text import documents, scratch

#: least share of a text's letters that its main language has
MIN_LANGUAGE_SHARE = 0.4


def _flat(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named by their place, so that no names clash, and the new names of doc_id, text and n_chars."""
    names = docs.columns
    return docs.toDF(*[f"_{i}" for i in range(len(names))]), {n: f"_{names.index(n)}" for n in ("doc_id", "text", "n_chars")}


def _back(flat: DataFrame, docs: DataFrame) -> DataFrame:
    return flat.select(*[f"_{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects rows without a letter (null and empty texts too), and those of which no language has MIN_LANGUAGE_SHARE of the letters.

    Each row is judged by its own text: repeated rows, null ids and very long texts go the way of their text. Equal shares go to
    the first language by name. Columns are kept by place, whatever their names. An empty table stays empty.
    """
    model = langid.fit(docs)
    flat, at = _flat(docs)
    tagged = langid.tag(flat, model, text_col=at["text"])
    return _back(tagged.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SHARE)), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group (5-word shingles, similarity 0.8).

    Rows with a null id, and those without words, are in no group and stay. Rows that share an id are one document: of them the
    one with the first text in order stays (of equal texts any one; a null text comes last). What goes is written as a
    table of ids first: a small one is then broadcast by its size, a large one joined by a shuffle. Columns are kept by place.
    """
    flat, at = _flat(docs)
    key, text = at["doc_id"], at["text"]
    found = scratch(hyperminhash.near_duplicates(flat, k=5, percent=80, id_col=key, text_col=text).select(F.col("doc_id").alias(key), "kept"), "near-duplicates")
    repeated = scratch(found.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key), "repeated-ids")
    gone = found.where(~F.col("kept")).select(key)
    one = flat.join(scratch(gone.unionByName(repeated), "gone"), key, "left_anti")
    if not repeated.isEmpty():
        kept = repeated.join(gone, key, "left_anti")
        order = Window.partitionBy(key).orderBy(F.col(text).asc_nulls_last(), *[F.col(at[c]) for c in ("n_chars",)])
        rows = flat.join(kept, key, "left_semi").withColumn("_first", F.row_number().over(order)).where("_first = 1")
        one = one.unionByName(rows.drop("_first"))
    return _back(one, docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, or one with other values.

    Each row is judged by its text, so copies go together, whatever their ids (null ones too). Null and empty texts hold nothing
    and stay. An empty benchmark drops nothing. Columns are kept by place.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    flat, at = _flat(docs)
    flat = flat.withColumn("_text", F.sha2(at["text"], 256))
    leaks = scratch(decontam.find_leaks(flat, benchmark, id_col="_text", text_col=at["text"]).select(F.col("doc_id").alias("_text")).distinct(), "leaking-texts")
    return _back(flat.join(leaks, "_text", "left_anti"), docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars follows the text.

    Every row stays. A null text stays null and keeps its n_chars; texts without personal data stay as they are. Spans that overlap
    are one. Columns are kept by place, so clashing names, repeated rows and null ids don't matter.
    """
    flat, at = _flat(docs)
    clean = pii.redacted(flat, text_col=at["text"])
    length = F.coalesce(F.char_length(at["text"]).cast("long"), F.col(at["n_chars"]))
    return _back(clean.withColumn(at["n_chars"], length), docs)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of each row and the text they decode to: doc_id, n_ids, ids, text, lossless (whether that is the text).

    A null text has null ids and decodes to null (lossless); an empty one has no ids. Rows of one id draw the same pieces for
    the same text; a null id is a key of its own. Whole texts are encoded, however long.
    """
    done = sentence_pieces.round_trip(docs, PIECE_MODEL)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.col("decoded").alias("text"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


STAGES = [
    ("language_id", identify_language),
    ("minhash", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", redact_personal_data),
    ("sentence_pieces", encode_and_decode),
]

#: stages with trained models and samplers can't be expressed in SQL; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each one's result written as Parquet and read by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
