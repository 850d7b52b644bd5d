import corpus_pipeline
import llm_brute as brute
from llm_rows import SF
from pyspark.sql import functions as F

from rawmart.llm import queries


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "minhash", "decontamination", "pii", "sentence_pieces"]

    one = steps["language_id"](spark, docs, SF)
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == {i for i, t in rows.items() if any(c.isalpha() for c in t or "")}

    two = steps["minhash"](spark, docs, SF)
    found = brute.near_duplicates(list(rows.items()), 5, 80)
    assert two.columns == columns and sorted(r["doc_id"] for r in two.collect()) == sorted(i for i, (_, c) in found.items() if i == c)

    three = steps["decontamination"](spark, docs, SF)
    items = [" ".join(brute.ALNUM_WORD.findall(r["text"].lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leak = {i for i, t in rows.items() if any(x in " ".join(brute.ALNUM_WORD.findall(t.lower())) for x in items)}
    assert three.columns == columns and {r["doc_id"] for r in three.collect()} == set(rows) - leak

    four = steps["pii"](spark, docs, SF)
    assert four.columns == columns
    for r in four.collect():
        assert brute.pii(r["text"])[:4] == (0, 0, 0, 0) and r["n_chars"] == len(r["text"])
        if brute.pii(rows[r["doc_id"]])[:4] == (0, 0, 0, 0):
            assert r["text"] == rows[r["doc_id"]]

    five = steps["sentence_pieces"](spark, docs, SF)
    assert {r["doc_id"]: r["text"] for r in five.collect()} == rows
    assert five.where(~F.col("lossless")).count() == 0


def test_run_chains_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    kept = out.count()
    assert 0 < kept < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert out.where("lossless").count() == kept


def test_edge_rows_pass_all_stages(spark, edge):
    """The extra columns with clashing names stay; a copy of a benchmark item with a null id goes."""
    again = edge.toDF(*[f"c{i}" for i in range(len(edge.columns))]).where("c0 in (2, 6, 12)")
    docs = edge.union(again.toDF(*edge.columns))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    docs = docs.union(spark.createDataFrame([(None, item, "en", "s", 1, "x", "y", 7)], docs.schema))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "sentence_pieces":
            assert docs.columns == columns
        got = [(r[0], r[1]) for r in docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).collect()]
        ids = [i for i, _ in got]
        if name == "minhash":  # one row of each group, repeated rows included
            own = [i for i in ids if i is not None]
            assert len(own) == len(set(own)) and 7 not in own and 6 in own
            assert (None, item) in got
        if name == "decontamination":
            assert (None, item) not in got and None in ids
    assert 13 in ids and 1 not in ids


def test_repeated_ids_keep_the_first_text(spark):
    rows = [(1, "b " * 20), (1, "a c d e f"), (2, "quite another text of some words")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 3):
        out = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(parts), SF)
        assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, "a c d e f"), (2, "quite another text of some words")]


def test_empty_table(spark, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_query_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
