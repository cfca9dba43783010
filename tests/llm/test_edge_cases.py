"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

from furrow.llm import decontaminate, html_extract, ivfpq, jaccard_join, language, licenses, lm_scoring, packing, pii, stages, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "onder ander sonder wander " * 4000


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "the thing is onder and ander. write to a.b@mail.example.com now", "en", "s", 10),
        (2, None, "en", None, None),
        (3, "", None, "s", 0),
        (4, LONG, "en", "s", len(LONG)),
        (4, LONG, "en", "s", len(LONG)),
        (5, "12 34 ... !!", "en", "s", 5),
        (None, "der die das und ein kein wort", "de", "s", 5),
        (7, "der die das und ein kein wort mehr", "de", "s", 5),
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumn("score", F.lit("clash")).withColumn("bucket", F.lit(1)).withColumn("list", F.lit(None).cast("string"))


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_language(spark, docs, none):
    known = [(1, "the thing is that and we write to them now with the others " * 3, "en"), (2, "der die das und ein kein wort mehr als nicht auch noch " * 3, "de"), (3, None, "de"), (4, "x", None)]
    got = language.identify(docs, spark.createDataFrame(known, "doc_id long, text string, lang string")).collect()
    assert len(got) == 8
    by = {r.doc_id: r for r in got}
    assert [(by[k].lang_pred, by[k].score, by[k].spans) for k in (2, 3, 5)] == [("und", 0.0, [])] * 3
    assert (by[1].lang_pred, by[7].lang_pred, by[None].lang_pred) == ("en", "de", "de")
    assert language.identify(none, docs).count() == 0
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}


def test_lm(docs, none):
    got = {r.doc_id: r for r in lm_scoring.score(docs, docs.where("doc_id = 1").select("doc_id")).collect()}
    assert (got[2].n_tokens, got[2].score, got[3].score) == (0, 0.0, 0.0)
    assert got[4].n_tokens == 16000
    assert got[1].score < got[7].score
    assert got[None].n_tokens == 7
    assert lm_scoring.score(none, none.select("doc_id")).count() == 0
    assert lm_scoring.score(docs.where("doc_id = 2"), none.select("doc_id")).count() == 1


def test_pii(spark, docs, none):
    got = {r.doc_id: r for r in pii.detect(docs).collect()}
    assert len(got) == 7
    assert got[1].n_email == 1
    assert (got[2].spans, got[3].spans) == ("", "")
    assert got[2].base_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert pii.detect(none).count() == 0
    long = [(1, "ander " * 5000 + "write to bob (at) mail (dot) org now " + "ander " * 5000), (2, "a" * 300_000), (3, "a.b@mail.example.com " * 300)]
    found = {r.doc_id: r for r in pii.detect(spark.createDataFrame(long, "doc_id long, text string"), masked=False).collect()}
    assert found[1].spans == "email:30009:30032"
    assert found[2].spans == ""
    assert found[3].n_email == 300
    assert found[3].spans.count("email") == 300


def test_decontaminate(spark, docs, none):
    text = "ander wander der die das und ein kein wort mehr als " * 2
    bench = spark.createDataFrame([(1, text, 0), (2, None, 0), (3, "kein", 0), (4, text, 0), (None, text, 0), (5, " ", 0)], "item_id long, text string, doc_id int")
    more = docs.where("doc_id <> 7").union(docs.where("doc_id = 7").withColumn("text", F.lit("x " + text.upper() + " y")))
    assert {(r.doc_id, r.item_id, r.edits) for r in decontaminate.find_passages(more, bench).collect()} == {(7, 1, 0), (7, 4, 0), (7, 3, 0)}
    assert {r.doc_id for r in decontaminate.find_passages(docs, bench).collect()} == {None, 7}
    assert decontaminate.find_passages(none, bench).count() == 0
    assert decontaminate.find_passages(docs, bench.limit(0)).count() == 0
    assert stages.drop_contaminated(more, bench).count() == 6
    assert stages.drop_contaminated(docs, bench.limit(0)).count() == 8
    assert stages.drop_contaminated(none, bench).columns == docs.columns


def test_neighbours(spark):
    inf = float("inf")
    rows = [(100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, []), (9, [0.0, 1.0]), (None, [1.0, 1.0]), (200, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("entry", F.lit("clash")).withColumn("score", F.lit(0))
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in ivfpq.search(df, F.col("vec_id") % 100 == 0).collect())
    far = 1.414214
    assert got == [(100, 1, 1, 0.0), (100, 2, 2, 0.0), (100, 3, 9, far), (100, 4, 200, far), (200, 1, 9, 0.0), (200, 2, 1, far), (200, 3, 2, far), (200, 4, 100, far)]
    assert ivfpq.search(df.union(df), F.col("vec_id") % 100 == 0).count() == len(got)
    assert ivfpq.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert ivfpq.search(df.where("vec_id = 3"), F.lit(True)).count() == 0


def test_html(spark):
    page = "<nav><a href=1>x</a></nav><article><h1>A &amp; B</h1><p>One  two &lt;three&gt; four five six seven eight nine.<p>Next one here, with words.</article><script>var a='</p>'</script>"
    df = spark.createDataFrame([(1, "u", page), (1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p>" * 3000 + "x" * 100_000), (5, "u", "a < b <!-- never"), (6, "u", "</div></p><b>")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(((r.page_id, r.text, r.n_chars) for r in html_extract.extract(df).collect()), key=str)
    assert [t for i, t, _ in got if i == 1] == ["A & B One two <three> four five six seven eight nine. Next one here, with words."] * 2
    assert [(t, n) for i, t, n in got if i in (2, 3)] == [("", 0)] * 2
    assert all(n == len(t) for _, t, n in got)
    assert html_extract.extract(df.limit(0)).count() == 0


def test_licenses(spark, docs, none):
    mit = licenses.TEMPLATES["MIT text"]
    rows = [(1, "abc\nReleased under the MIT License.\nmore", 0), (1, "abc\nReleased under the MIT License.\nmore", 0), (2, None, 0), (3, "", 0), (4, "x\n" + mit + "\ny", 0), (5, mit.replace(". ", ".\n\n"), 0), (None, "Released under the MIT License", 0), (6, "word", 0), (7, ("no " * 50 + "Released under the MIT License. ") * 2000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license int").withColumn("dice", F.lit("clash")).withColumn("row", F.lit(0))
    got = [(r.doc_id, r.license, r.start_word) for r in licenses.scan(df).collect()]
    assert sorted(x for x in got if x[0] != 7 and x[0]) == [(1, "MIT reference", 1), (4, "MIT text", 1), (5, "MIT text", 0)]
    assert [x for x in got if x[0] is None] == [(None, "MIT reference", 0)]
    assert len({x for x in got if x[0] == 7}) == 2000
    assert licenses.scan(none).count() == 0
    assert licenses.scan(docs).count() == 0


def test_packing(docs, none):
    got = packing.pack(docs, buckets=3, budget=100).collect()
    assert len(got) == 8
    assert {r.n_tokens for r in got if r.doc_id in (2, 3)} == {0}
    assert len({(r.bucket, r.batch, r.place) for r in got}) == 8
    assert packing.pack(none).count() == 0


def test_packing_of_one_hot_row(spark, monkeypatch):
    """Most rows have no id and one length: they fill several slots."""
    monkeypatch.setattr(packing, "SLOT_DOCS", 50)
    df = spark.createDataFrame([(None, "a b c")] * 700 + [(i, "x " * (1 + i % 5)) for i in range(300)], "doc_id long, text string")
    got = packing.pack(df, buckets=2, budget=60).collect()
    assert len(got) == 1000
    assert len({(r.bucket, r.batch, r.place) for r in got}) == 1000
    for b in {r.bucket for r in got}:
        own = [r for r in got if r.bucket == b]
        cap = 60 // own[0].bucket_len
        assert sorted(r.batch * cap + r.place for r in own) == list(range(len(own)))


def test_jaccard(docs, none):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(docs).collect()), key=str)
    assert got == sorted([(1, 6, 1), (2, 0, 2), (3, 0, 3), (4, 4, 4), (4, 4, 4), (5, 1, 5), (7, 4, 7), (None, 3, None)], key=str)
    assert jaccard_join.join(none).count() == 0


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (4, 1, 0), (7, None, 1)], "doc_id long, toxic int, score int")
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == 8
    assert {r.score for r in got if r.doc_id in (2, 3)} == {0.0}
    assert toxicity.score(none, toxicity.train(docs, labels)).count() == 0
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect()} == {0.0}


def test_stages_keep_columns_and_rows(docs, none):
    for stage in (stages.keep_identified, stages.keep_first_of_group, stages.mask_personal_data):
        assert stage(none).columns == docs.columns
        assert stage(none).count() == 0
        assert stage(docs).columns == docs.columns
    assert {r.doc_id for r in stages.keep_identified(docs).collect()} == {1, 4, None, 7}
    assert {r.doc_id for r in stages.keep_identified(docs.drop("lang")).collect()} == {1, 4, None, 7}
    assert stages.drop_contaminated(docs, none.select(F.col("doc_id").alias("item_id"), "text")).columns == docs.columns
    kept = [r.doc_id for r in stages.keep_first_of_group(docs).collect()]
    assert sorted(map(str, kept)) == ["1", "2", "3", "4", "5", "7", "None"]
    masked = {r.doc_id: r for r in stages.mask_personal_data(docs).collect()}
    assert masked[1].text == "the thing is onder and ander. write to <email> now"
    assert masked[1].n_chars == len(masked[1].text)
    assert masked[2].text is None
    bare = docs.select("doc_id", "text")
    assert stages.mask_personal_data(bare).columns == ["doc_id", "text"]
    assert stages.mask_personal_data(bare).count() == 8
