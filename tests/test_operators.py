from pyspark.sql import functions as F

from furrow.operators import audit, merge, normalise, repair, resolve, review, star
from furrow.sources import html_tables, landed

ROW = "source string, source_system string, state string, market_name string, market_id string, commodity_name string, commodity_alias_lookup_id string, variety string, date timestamp, min_price double, max_price double, modal_price double, ordinal int"


def problems(spark, lo, hi, modal):
    df = spark.createDataFrame([(lo, hi, modal)], "lo double, hi double, m double")
    return df.select(review.price_problems(F.col("lo"), F.col("hi"), F.col("m")).alias("p")).first().p


def test_price_problems(spark):
    assert problems(spark, 2400.0, 2500.0, 2441.0) == []
    assert problems(spark, None, None, 2441.0) == []
    assert problems(spark, 2600.0, 2500.0, 2441.0) == ["min price 2600 is above max price 2500"]
    assert problems(spark, 2400.0, 2500.0, 3000.0) == ["modal price 3000 is outside 2400–2500"]
    assert problems(spark, 0.0, 2500.0, 2441.0) == ["min price is 0"]


def test_review_keys(spark):
    from datetime import datetime

    rows = spark.createDataFrame([("agmarknet", "agmarknet", "andhra pradesh", "pendurthi apmc", "m1", "hen", None, "paddy", datetime(2026, 10, 31, 6), 2400.0, 100.0, 2441.0, 1)], ROW)
    status = spark.createDataFrame([("Punjab", False, "Punjab scrape failed", "timeout", 0)], "source string, success boolean, error string, details string, records long")
    keys = {r.key for r in review.review_items(rows, status, "run", F.lit("2026-10-31").cast("timestamp")).collect()}
    assert keys == {"price_invalid|agmarknet|andhra pradesh|pendurthi apmc|hen|paddy|2026-10-31", "run_failed|Punjab|2026-10-31", "unmapped_commodity|hen"}


def test_run_documents_and_pipeline(spark):
    rows = spark.createDataFrame([("s", "s", "kerala", f"m{i}", None, "hen", None, None, None, None, None, None, i) for i in range(2)], ROW)
    status = spark.createDataFrame([("s", True, None, None, 2), ("Punjab", False, "Punjab scrape failed", "timeout", 0)], "source string, success boolean, error string, details string, records long")
    docs = review.run_documents(review.run_stats(rows), status, "r")
    assert {r.source: r.error for r in docs.collect()} == {"s": None, "Punjab": "Punjab scrape failed: timeout"}
    whole = review.pipeline_row(docs).first()
    assert (whole.success, whole.sources_failed, whole.records_fetched) == (False, ["Punjab"], 2)


def test_merge_is_idempotent_and_keeps_policies(spark):
    schema = "k string, first string, last string, n long, s array<string>, ordinal int"
    p = {"first": "insert_only", "last": "overwrite_even_null", "s": "set_union"}
    old = merge.fold_batch(spark.createDataFrame([(None, "a", "b", 1, ["x"], 1), ("k", "a", "b", 1, ["x"], 1)], schema), ["k"], p)
    batch = spark.createDataFrame([(None, "c", None, 1, ["y"], 1), (None, "d", "e", 1, ["z"], 2), ("new", "q", None, 1, None, 1)], schema)
    once = merge.merge(old, batch, ["k"], p).drop("action")
    twice = merge.merge(once, batch, ["k"], p).drop("action")
    rows = {r.k: tuple(r)[1:] for r in once.collect()}
    assert rows == {None: ("a", "e", ["x", "y", "z"]), "k": ("a", "b", ["x"]), "new": ("q", None, [])}
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_normalise_compat_and_quarantine(spark):
    rows = spark.createDataFrame([("meghalaya", 1, {"date": "01/02/2026", "market": " Shillong ", "commodity_name": "Hen", "variety": "v", "modal_price_rs_per_quintal": "Rs 5"}), ("unknown", 2, {"a": "b"}), ("nagaland", 3, {"Arrival Date": "soon", "Commodity": "Yam"})], "source string, ordinal int, record map<string,string>")
    fixed = {r.ordinal: r for r in normalise.normalise(rows).collect()}
    old = {r.ordinal: r for r in normalise.normalise(rows, compat=True).collect()}
    assert (fixed[1].variety, fixed[1].modal_price, fixed[1].market_name) == ("v", 5.0, "shillong")
    assert (old[1].variety, old[1].modal_price) == (None, None)
    assert (fixed[3].alias_input, old[3].alias_input) == ("yam", None)
    bad = normalise.quarantine(normalise.normalise(rows), F.lit("2026-01-15").cast("timestamp"))
    assert {(r.ordinal, r.reason) for r in bad.collect()} == {(1, "future date"), (3, "date: soon")}
    assert {r.source for r in normalise.quarantine_summary(bad).collect()} == {"meghalaya", "nagaland"}
    assert [r.source for r in normalise.unknown_sources(rows).collect()] == ["unknown"]
    dim, fact = star.split(normalise.normalise(rows).withColumn("market_id", F.lit(None).cast("string")).withColumn("commodity_alias_lookup_id", F.lit(None).cast("string")))
    assert (dim.count(), fact.count()) == (2, 1)


def test_payloads_and_html(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"a": {"success": true, "data": [{"x": "1"}, {"x": "2"}]}, "b": {"success": false, "error": "e", "details": "d"}}')
    got = landed.read_payloads(spark, str(tmp_path / "p.json"))
    assert {(r.source, r.success, r.records) for r in landed.source_status(got).collect()} == {("a", True, 2), ("b", False, 0)}
    assert landed.successful(got).count() == 2
    assert html_tables.table_rows(None) == []
    rows = html_tables.table_rows("<span>Group A</span><table><tr><th>A<th>B<tr><td>1 &amp; 2<td><a>x</a></table>")
    assert rows == [(0, "Group A", 0, ["A", "B"], True, False), (0, "Group A", 1, ["1 & 2", "x"], False, True)]


def test_repairs(spark):
    facts = spark.createDataFrame([(1, "keep", "d1"), (2, "old", "d1"), (3, "old", "d2"), (4, "other", "d1")], "id int, fk string, day string")
    pairs = spark.createDataFrame([("keep", "old")], "keep_id string, old_id string")
    plan = repair.merge_sources(facts, pairs, "fk", "day", "id")
    assert {r.id: r.action for r in plan.collect()} == {1: "keep", 2: "drop", 3: "remap", 4: "keep"}
    assert repair.apply_plan(plan).count() == 3
    dim = spark.createDataFrame([("keep", None), ("old", "m"), ("other", None)], "id string, market_id string")
    assert {r.id: r.market_id for r in repair.merge_dims(dim, pairs, ["market_id"]).collect()} == {"keep": "m", "other": None}
    assert [r.id for r in repair.orphan_facts(facts, dim.where("id <> 'other'"), "fk").collect()] == [4]
    labels = spark.createDataFrame([("a", "new", "k1"), ("b", "old", "k1"), ("c", "old", "k2")], "id string, label string, key string")
    own = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d1"), (3, "b", "d2"), (4, "c", "d1")], "fact int, fk string, day string")
    left, moved = repair.rename_source(labels, own, "label", "old", "new", ["key"], "fk", "day", "fact")
    assert {tuple(r) for r in left.collect()} == {("a", "new", "k1"), ("c", "new", "k2")}
    assert {r.fact: (r.target, r.action) for r in moved.collect()} == {1: ("a", "keep"), 2: ("a", "drop"), 3: ("a", "remap"), 4: ("c", "keep")}


def test_resolve_new_and_suggestions(spark):
    names = spark.createDataFrame([("Kolar Yard", "Orissa"), ("nowhere", None), (" ", "kerala")], "market_name string, state string")
    entities = spark.createDataFrame([("1", "Kolar", ["K"], "odisha")], "id string, name string, aliases array<string>, state string")
    found = resolve.resolve_markets(names, entities)
    assert {r.market_name: (r.market_id, r.tier) for r in found.collect()} == {"Kolar Yard": ("1", 4), "nowhere": (None, None), " ": (None, None)}
    assert [r.name for r in resolve.new_markets(found).collect()] == ["Nowhere"]
    lookup = spark.createDataFrame([("a", "tomato", ["tamatar"]), ("b", "onion", None)], "id string, canonical_name string, aliases array<string>")
    best = resolve.fuzzy_best(spark.createDataFrame([("Tomatoes",), ("zzz",)], "name string"), lookup)
    got = {r.name: (r.best_id, r.accepted, r.reason) for r in best.collect()}
    assert got["Tomatoes"] == ("a", True, None)
    assert got["zzz"][1:] == (False, "score too low")
    assert {r.key: r.suggestion.group_name for r in review.suggestions(best.withColumn("records", F.lit(1)), F.lit("2026-01-01").cast("timestamp"), "r").collect()}["unmapped_commodity|Tomatoes"] == "tomato"


def test_audit_nulls_on_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert {(r.metric, r.value, r.severity) for r in audit.nulls(empty, "s", ["a", "b"]).collect()} == {("a", 0, "ok"), ("b", 0, "ok")}
    assert audit.uniqueness(empty, {"u": ["a"]}).first().holds


def test_versions_and_stream(spark, tmp_path):
    from furrow.streaming.ingest import daily_counts, merge_stream

    schema = "k string, v int, ordinal int"
    table, inbox = str(tmp_path / "t"), str(tmp_path / "in")
    policies = {"v": "overwrite_even_null"}
    merge.save_version(merge.fold_batch(spark.createDataFrame([("a", 1, 1)], schema), ["k"], policies), table, 0)
    spark.createDataFrame([("a", 5, 2), ("b", 2, 1)], schema).write.json(inbox)
    q = merge_stream(spark.readStream.schema(schema).json(inbox), table, ["k"], policies, str(tmp_path / "c"))
    q.awaitTermination(120)
    assert {(r.k, r.v) for r in merge.load_current(spark, table).collect()} == {("a", 5), ("b", 2)}
    events = spark.readStream.schema("source string, t timestamp").json(inbox)
    assert daily_counts(events, "t").isStreaming
    copied = landed.copy_table(spark, merge.current_version(spark, table)[1], str(tmp_path / "copy"))
    assert copied == 2


def test_fuzzy_best_against_all_pairs(spark):
    """Best and second of every name by scoring it with every entry, in one block and in several."""
    import random

    from furrow.functions import fuzzy

    r = random.Random(3)
    stems = ["paddy", "green gram", "coriander", "tomato", "black pepper", "maize", "moong", "urad dal"]

    def variant(t):
        t = list(t + r.choice(["", "", " (whole)", "/dry", " local", "-2"]))
        for _ in range(r.randint(0, 2)):
            t[r.randrange(len(t))] = r.choice("abcdeé ")
        return "".join(t)

    entries = [(f"{i:03d}", variant(r.choice(stems)), [variant(r.choice(stems)) for _ in range(r.randint(0, 3))]) for i in range(60)]
    entries += [("060", "paddy", ["padd y", "paddy"]), ("061", "", []), ("062", None, None)]
    names = sorted({variant(r.choice(stems)) for _ in range(60)} | {"paddy", "pa-ddy", "zzz", "(x)", "\uff30addy"})
    lookup = spark.createDataFrame(entries, "id string, canonical_name string, aliases array<string>")
    probes = spark.createDataFrame([(n,) for n in [*names, " ", None]], "name string")
    for contained, block in ((5, 20_000), (4, 9)):
        got = {x.name: x for x in resolve.fuzzy_best(probes, lookup, contained=contained, block=block).collect()}
        assert set(got) == set(names)
        for n in names:
            ranked = sorted((-fuzzy.best_ratio(n, [c, *(a or [])], contained), i) for i, c, a in entries)
            assert (got[n].score, got[n].best_id, got[n].second) == (-ranked[0][0], ranked[0][1], -ranked[1][0])
            sure = got[n].score >= 0.78 and (got[n].score - got[n].second >= 0.04 or got[n].score >= 0.99)
            assert got[n].accepted == sure


def test_containing_needs_no_third_character(spark):
    lookup = spark.createDataFrame([("1", "c1", ["ab", "xaby"]), ("2", "c2", ["a"]), ("3", None, ["b"])], "id string, crop_master_id string, aliases array<string>")
    names = spark.createDataFrame([("A",), ("b",), ("aby",), ("abyz",), ("",), (None,)], "name string")
    assert {r.name: (r.crop_master_id, r.rank) for r in resolve.crop_master_id(names, lookup).collect()} == {"A": ("c2", 1), "b": ("c1", 2), "aby": ("c1", 2), "abyz": (None, None), "": (None, None), None: (None, None)}


def test_workers_get_the_package(spark, tmp_path):
    """Another session, in a folder of its own and without the package on its path."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from furrow.session import builder
from furrow.operators import resolve
from furrow.sources import html_tables
s = builder("w").master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
s.createDataFrame([(1, "<table><tr><td>x</td></tr></table>")], "page_id int, html string").createOrReplaceTempView("p")
print("ROWS", html_tables.read_rows(s.table("p")).count(), resolve.fuzzy_best(s.createDataFrame([("paddy",)], "name string"), s.createDataFrame([("1", "paddy", ["x"])], "id string, canonical_name string, aliases array<string>")).first().score)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "ROWS 1 1.0" in out.stdout, out.stderr[-2000:]


def test_a_batch_that_died_before_its_pointer_can_be_written_again(spark, tmp_path):
    table, df = str(tmp_path / "t"), spark.createDataFrame([("a", 1)], "k string, n int")
    merge.save_version(df, table, 0)
    df.write.parquet(f"{table}/v1-dead")  # a part of an attempt that never moved the pointer
    merge.save_version(df.withColumn("n", F.lit(2)), table, 1)
    merge.save_version(df.withColumn("n", F.lit(2)), table, 1)
    assert merge.current_version(spark, table)[0] == 1
    assert [tuple(r) for r in merge.load_current(spark, table).collect()] == [("a", 2)]


def test_nulls_count_as_a_source_and_a_name(spark):
    df = spark.createDataFrame([("k", "a", "x"), ("k", None, None), ("j", "a", "x"), ("j", "a", "x")], "k string, source string, name string")
    assert [tuple(r) for r in audit.source_overlap(df, [F.col("k")], "source").collect()] == [("|a", 1, 2)]
    assert [tuple(r) for r in audit.variants(df, ["k"], "name").collect()] == [("k", 2, 2, "|x")]


def test_blank_names_open_no_items(spark):
    rows = spark.createDataFrame([("", "feed", "", "", None, "", None, "v", None, None, None, None, 1)], ROW)
    stats = review.run_stats(rows).first()
    assert (stats.source, stats.state, stats.records, stats.markets, stats.unmapped_commodities, stats.unknown_markets) == ("feed", "unknown", 1, 0, 0, 0)
    status = spark.createDataFrame([], "source string, success boolean, error string, details string, records long")
    assert review.review_items(rows, status, "run", F.lit("2026-10-31").cast("timestamp")).count() == 0


def test_swap_of_one_source_only(spark):
    facts = spark.createDataFrame([(1, "2026-09-07", "a"), (2, "2026-09-07", "b"), (3, "2026-09-22", "a")], "fk int, day string, source string").withColumn("day", F.col("day").cast("date"))
    plan = repair.swap_plan(facts, "fk", "day", F.lit("2026-08-13").cast("date"), F.col("source") == "a")
    assert {(r.fk, r.action) for r in plan.collect()} == {(1, "move"), (3, "delete")}


def test_payload_whose_data_is_a_very_long_text(spark):
    record = F.to_json(F.array_repeat(F.create_map(F.lit("id"), F.repeat(F.lit("x"), 10_000)), 2_100))
    texts = spark.range(1).select(F.to_json(F.create_map(F.lit("s"), F.struct(F.lit(True).alias("success"), record.alias("data")))).alias("value"))
    assert landed.payload_records(texts).agg(F.count("record"), F.max("ordinal")).first()[:] == (2_100, 2_099)
