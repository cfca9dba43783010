"""The pipeline against a plain version of each stage, and the rows that each stage removes."""

import random

import numpy as np
from test_brute_force import linked, near, words

import corpus_pipeline
from furrow.llm import decontaminate, language, packing, pii, stages
from furrow.llm.common import read_table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket string"


def corpus(tmp_path, spark):
    """Two languages; copies, near copies, passages of the benchmark, personal data, blank and letterless rows."""
    r = random.Random(21)
    en = "the and of to in is that for with as was by on are it be this have from or".split()
    de = "der die und das nicht ist ein eine mit von auf für sich dem den im zu als auch nach".split()

    def prose(vocab, n):
        return " ".join(r.choice(vocab) if r.random() < 0.5 else words(r, 1) for _ in range(n))

    items = [(i, prose(en, r.randint(15, 30))) for i in range(8)] + [(50, None)]
    rows = []
    for i in range(60):
        rows.append([i, prose(de if i % 3 == 0 else en, r.randint(30, 90)), "de" if i % 3 == 0 else "en"])
    for i in range(60, 75):  # near copies and copies
        t = rows[i - 60][1].split()
        for _ in range(i % 3):
            t[r.randrange(len(t))] = "changed"
        rows.append([i, " ".join(t), None])
    for i in range(75, 83):  # a passage inside other prose
        t = list(items[i - 75][1])
        for _ in range(i % 3):
            t[r.randrange(len(t))] = "x"
        rows.append([i, f"{prose(en, 20)} {''.join(t)} {prose(en, 20)}", "en"])
    rows[5][1] += " write to jane.doe@mail.example.com or call (717) 555-0202 now"
    rows[7][1] = "Contact Mr John Smith, 12 Baker Street, London. " + rows[7][1]
    rows += [[90, None, "en"], [91, "", "de"], [92, "12 34 -- 56", "en"]]
    spark.createDataFrame([(i, t, lang, "s", len(t or ""), "clash") for i, t, lang in rows], DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return {i: t for i, t, _ in rows}, [t for _, t in items if t]


def test_each_stage_and_the_whole_against_a_plain_version(spark, tmp_path):
    texts, passages = corpus(tmp_path, spark)
    docs, stage = read_table(spark, str(tmp_path), "documents"), dict(corpus_pipeline.STAGES)
    named = {x.doc_id: x for x in language.identify(docs, language.training_rows(docs)).collect()}
    want = {i: t for i, t in texts.items() if named[i].lang_pred != "und" and named[i].score >= stages.MIN_SHARE}
    got = stage["language"](spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert {x.doc_id: (x.text, x.lang) for x in got.collect()} == {i: (t, named[i].lang_pred) for i, t in want.items()}
    assert set(texts) - set(want) >= {90, 91, 92}
    assert set(range(60)) <= set(want)

    def rows(d):
        return spark.createDataFrame([(i, t, "en", "s", len(t), "clash") for i, t in d.items()], DOCS)

    first = linked(want)
    before, want = want, {i: t for i, t in want.items() if first[i] == i}
    assert {x.doc_id for x in stage["near_duplicates"](spark, rows(before), str(tmp_path)).collect()} == set(want)
    assert set(range(60, 75, 3)) & set(before) <= set(before) - set(want) <= set(range(60, 75))

    def holds(t):
        t = decontaminate.normal(t)
        return any(near(p, t, min(int(decontaminate.EDIT_RATE * len(p)), (len(p) - decontaminate.Q) // decontaminate.Q)) for p in map(decontaminate.normal, passages))

    before, want = want, {i: t for i, t in want.items() if not holds(t)}
    assert {x.doc_id for x in stage["decontamination"](spark, rows(before), str(tmp_path)).collect()} == set(want)
    assert set(before) - set(want) == set(range(75, 83))

    crf, before = pii.trained(), want
    want = {i: pii.mask(t, pii.find([t], crf)[0][1]) for i, t in want.items()}
    got = {x.doc_id: x for x in stage["personal_data"](spark, rows(before), str(tmp_path)).collect()}
    assert {i: x.text for i, x in got.items()} == want
    assert all(x.n_chars == len(x.text) for x in got.values())
    assert "<email>" in want[5]
    assert "<phone>" in want[5]
    assert "Smith" not in want[7]
    assert sum(want[i] == before[i] for i in want) >= len(want) - 4

    sizes = {i: len(t.encode().split()) for i, t in want.items()}
    lengths = sorted(set(sizes.values()))
    bounds = packing.boundaries(lengths, [list(sizes.values()).count(n) for n in lengths])
    plan = {i: (n, min(b for b in bounds if b >= n)) for i, n in sizes.items()}
    for result in (stage["packing"](spark, rows(want), str(tmp_path)), corpus_pipeline.run(spark, str(tmp_path))):
        found = result.collect()
        assert {x.doc_id: (x.n_tokens, x.bucket_len) for x in found} == plan
        assert len({(x.bucket, x.batch, x.place) for x in found}) == len(found)
        for x in found:
            assert 0 <= x.place < max(1, packing.TOKEN_BUDGET // x.bucket_len)
    assert np.isclose(sum(sizes.values()), sum(n for n, _ in plan.values()))
