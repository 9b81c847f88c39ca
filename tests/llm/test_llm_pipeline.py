"""The pipeline's stages one by one and together: awkward rows, clashing columns, what each stage takes out."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crawlprism.llm import bagminhash, components, decontam, linedup, mixing, toxicity

CLASH = "toxic int, _id int, _doc int, _leak int, _kept int, spans string, _row int, _name string, n_removed string, words_removed int, band string, lead int, node string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
FILL = (1, 2, 3, 4, 5, "s", 6, "n", "r", 7, "b", 8, "x")


def prose(seed, n=160):
    draw = random.Random(seed)
    stems = [a + b + c for a in ("lor", "dan", "mir", "tes", "vol", "can", "per") for b in ("em", "is", "ot", "al") for c in ("", "er", "ing", "ed")]
    return " ".join(" ".join(draw.choice(stems) for _ in range(9)).capitalize() + "." for _ in range(n // 9))


ITEM = "Anna buys seventeen red apples and gives four of them to her brother before walking home along the river"
SHARED = " ".join(f"Shared{k} passage word that many documents hold and nobody wrote anew here." for k in range(8))
ROWS = [
    *[(k, prose(k), "en", "abc"[k % 3]) for k in range(60)],
    (100, prose(3), "en", "a"), (101, prose(3), "en", "a"),
    (102, prose(70) + " " + ITEM + ". " + prose(71), "en", "b"),
    (103, prose(72) + "\n" + SHARED, "en", "c"), (104, prose(73) + "\n" + SHARED, "en", "c"),
    (105, None, None, None), (106, "", "en", "a"), (None, prose(74), "en", None), (None, prose(75), "en", None), (107, "short", "en", "a"),
    (108, prose(76, 20000), "de", "b"), (109, prose(77), "en", "a"), (109, prose(77), "en", "a"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = [(*r, len(r[1] or ""), *FILL) for r in ROWS]
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (None, "")], "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_columns_and_clean_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        rows = out.collect()
        ids = {r.doc_id for r in rows}
        assert set(range(60)) - {3} <= ids, name
        assert all(tuple(r[c] for c in CLASH_COLUMNS) == FILL for r in rows if name != "line_dedup"), name
        if name == "quality_rules":
            assert not ids & {105, 106, 107}
        if name == "line_dedup":
            back = {r.doc_id: r.text for r in rows}
            assert back[103] == texts[103] and back[104] == prose(73) and 100 not in ids and 101 not in ids
        if name == "near_duplicates":
            assert 3 in ids and not ids & {100, 101} and sum(r.doc_id == 109 for r in rows) == 1
        if name == "decontamination":
            assert 102 not in ids and len(rows) == len(ROWS) - 1


CLASH_COLUMNS = [c.split()[0] for c in CLASH.split(", ")]


def test_pipeline_against_stages(spark, folder):
    """``run`` is the stages one after the other, over all that each has kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
    got = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    ids = {r.doc_id for r in got.collect()}
    assert 3 in ids and not ids & {100, 101, 102, 105, 106, 107}


def test_stages_on_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).isEmpty(), name


def test_clashing_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = docs.filter("doc_id < 60").select("doc_id", F.lit(0).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    assert toxicity.score(docs, labels).count() == len(ROWS)
    assert linedup.dedup_lines(docs).count() == len(ROWS)
    assert mixing.taken(docs).count() == len(ROWS)
    assert decontam.without_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).columns == docs.columns
    assert bagminhash.keep_one(docs).columns == docs.columns


def test_rows_of_one_id_are_told_apart(spark):
    """Two texts without an id whose names agree in 31 bits lose their repeated passages all the same."""
    first = SHARED
    rows = [(1, first)] + [(None, prose(k) + "\n" + SHARED) for k in range(40)]
    got = linedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id IS NULL").collect()
    assert sorted(r.text for r in got) == sorted(prose(k) for k in range(40)) and all(r.n_removed > 0 for r in got)


def test_rounds_of_a_rising_chain(spark, monkeypatch):
    rounds = []
    plain = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, name: rounds.append(name) or plain(df, name))
    links = spark.createDataFrame([(k, k + 1) for k in range(1000)], "a long, b long").coalesce(1)
    got = components.connected_components(links)
    assert {r.label for r in got.collect()} == {0} and got.count() == 1001
    assert rounds.count("edges") == 2 and rounds.count("least") <= 13
