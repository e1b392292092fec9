import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import exprs, types
from quarry.operators import drift, edges, gates, mining, profile
from quarry.plans import documents, sequence
from quarry.sources.tables import Constraint, Source, distinct_estimate, in_scope, reconcile


def values(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(inputs)], f"k int, v {kind}")
    return [r[0] for r in df.orderBy("k").select(expression(F.col("v"))).collect()]


def test_zeros_and_formats(spark):
    assert values(spark, exprs.strip_zeros, ["000", "0012", "12", "0a", "", None]) == ["0", "12", "12", "0a", "", None]
    texts = ["", "A@B.CO", "0123", "+49 (30) 123-4567", "O'BRIEN", "APPLE INC.", "A, B", "12-34", "2020/1/2"]
    assert values(spark, exprs.format_class, texts) == ["mixed", "email", "all-digits", "phone-like", "alpha", "alpha", "mixed", "mixed", "mixed"]


def test_times(spark):
    stamps = [dt.datetime(2002, 4, 1), dt.datetime(2002, 4, 1, 9, 5, 7), dt.datetime(2002, 12, 31, 0, 0, 0, 5), None]
    assert values(spark, exprs.render_time, stamps, "timestamp_ntz") == ["2002/4/1", "2002/4/1 9:05:07", "2002/12/31 0:00:00", None]
    texts = ["2002-04-01 09:05:07", "2002-04-01 09:05:07.25", "2002-04-01", "Apr  1 2002 12:00AM", "2002/4/1 9:05:07", "soon"]
    read = values(spark, lambda c: exprs.render_time(exprs.parse_time(c)), texts)
    assert read == ["2002/4/1 9:05:07", "2002/4/1 9:05:07", "2002/4/1", "2002/4/1", "2002/4/1 9:05:07", None]


def test_types():
    assert types.canonical("character varying", length=160) == "VARCHAR(160)"
    assert types.canonical("nvarchar", length=-1) == "NVARCHAR(MAX)"
    assert types.canonical("numeric", precision=10, scale=2) == "NUMERIC(10,2)"
    assert types.canonical("hstore") == "HSTORE" and types.canonical(None) == "UNKNOWN"
    assert types.is_integer("NUMERIC(10,0)") and types.is_integer("NUMBER") and not types.is_integer("NUMERIC(10,2)")


def test_keyed_digest_stays_out_of_plans(spark, monkeypatch):
    monkeypatch.setenv("A_KEY", "very-secret-key")
    df = spark.createDataFrame([("x",), (None,)], "v string").select(exprs.keyed_digest("A_KEY")("v").alias("h"))
    assert [len(r["h"]) if r["h"] else None for r in df.collect()] == [16, None]
    assert "very-secret-key" not in df._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        exprs.keyed_digest("NO_SUCH_KEY")


def test_gates(spark):
    rows = spark.createDataFrame([("a", 0.5, 30), ("b", 0.51, 31), ("c", None, None), ("key", 0.1, 5)], "column string, distinct_ratio double, n_distinct long")
    got = {r["column"]: (r["fingerprint_gate"], r["top_n_gate"]) for r in gates.decide(rows, ["key"], ["T.B"], "t").collect()}
    assert got == {"a": ("cardinality-gate", "allow"), "b": ("sensitive", "sensitive"), "c": ("cardinality-gate", "unknown-distinct"), "key": ("allow", "allow")}
    assert values(spark, lambda c: gates.junk(c, F.lit(1)), ["orders", "x_bkp", "TMP_1"]) == [False, True, True]
    budget = gates.Budget(tables=1)
    assert budget.take("tables", 1, "a") and not budget.take("tables", 1, "b") and budget.denied == [("tables", "b")]


def test_normalised_samples_merge_and_record_rules(spark):
    df = spark.createDataFrame([("007",), (" 7",), ("7",), ("ab",), (None,)], "v string")
    sampled = profile.samples(profile.values(df))
    assert {(r["value"], r["freq"]) for r in sampled.collect()} == {("7", 3), ("AB", 1)}
    assert profile.rules(sampled).first()["rules"] == ["trim", "uppercase", "strip_leading_zeros"]
    cut = profile.samples(profile.values(spark.range(20).toDF("v")), 5).collect()
    assert len(cut) == 5 and all(r["truncated"] for r in cut)


def test_nested_columns_and_empty_tables(spark):
    df = spark.createDataFrame([], "v string, a array<int>")
    assert [r.asDict() for r in profile.counts(df).collect()] == [{"column": "v", "n_rows": 0, "non_null": 0, "n_distinct": 0, "low": None, "high": None}]
    assert profile.rates(profile.counts(df)).first()["null_rate"] is None


TABLES = {("core", "album"): ["album_id", "title", "artist_id"], ("core", "artist"): ["artist_id", "name"], ("sales", "invoice"): ["id", "artist_id"]}


@pytest.mark.parametrize(
    ("sql", "cut", "reason"),
    [
        (None, False, "no-definition"), ("  ", False, "no-definition"), ("SELECT 1 FROM album", True, "truncated"),
        ("BEGIN EXECUTE 'SELECT * FROM ' || t; END", False, "dynamic-sql"), ("SELECT a.x FROM (SELECT 1 AS x) a", False, "nested-select"),
        ("SELECT title FROM album UNION SELECT name FROM artist", False, "multiple-selects"), ("SELECT g.x FROM generate_series(1, 10) g", False, "unsupported-from"),
        ("SELECT a.title FROM albums a", False, "unresolved-identifier: albums"),
        ("SELECT a.ghost FROM album a JOIN artist b ON a.ghost = b.artist_id", False, "unresolved-identifier: a.ghost"),
        ("SELECT a.title FROM album a JOIN artist a ON a.artist_id = a.artist_id", False, "ambiguous-alias: a"),
    ],
)
def test_refusals(sql, cut, reason):
    with pytest.raises(mining.Refused, match=f"^{reason}$"):
        mining.mine("core", "v", sql, cut, mining.Inventory(TABLES))


def test_mined_joins():
    known = mining.Inventory(TABLES)
    fact = [("core", "album", "artist_id", "core", "artist", "artist_id")]
    for sql in (
        "SELECT 1 FROM album a JOIN artist b ON a.artist_id = b.artist_id",
        'SELECT 1 FROM [album] AS a, "artist" b WHERE b.ARTIST_ID = a.artist_id AND a.artist_id = b.artist_id',
        "SELECT 1 FROM ((album a JOIN artist b ON (a.artist_id = b.artist_id)))",
        "SELECT 1 FROM album JOIN core.artist ON album.artist_id = artist.artist_id -- album.title = artist.name",
    ):
        assert mining.mine("core", "v", sql, False, known) == (fact, set())
    facts, outside = mining.mine("core", "v", "SELECT 1 FROM other.core.song s JOIN album a ON s.id = a.album_id", False, known)
    assert facts == [] and outside == {"other.core.song"}


def test_drift(spark):
    kinds = "table string, column string, type string, n_rows long, n_distinct long, distinct_ratio double, null_rate double, description string"
    old = spark.createDataFrame([("t", "a", "INT", 100, 10, 0.1, 0.0, "x"), ("t", "b", "INT", 100, 0, 0.0, 0.0, None)], kinds)
    new = spark.createDataFrame([("t", "a", "TEXT", 110, 12, 0.16, 0.0, "y"), ("t", "c", "INT", 1, 1, 1.0, 0.0, None)], kinds)
    got = {(r["column"], r["reason"]): r["invalidates"] for r in drift.drift(old, new).collect()}
    assert got == {
        ("a", "type-changed"): True, ("a", "n_distinct-shifted"): True, ("a", "distinct_ratio-shifted"): True, ("a", "description-changed"): False,
        ("b", "column-dropped"): True, ("c", "column-added"): True,
    }


def test_truncated_overlap_is_corrected(spark):
    prints = None
    for name, n in (("l", 400), ("r", 4000)):
        own = profile.fingerprints(profile.samples(profile.values(spark.range(n).toDF("k_id")), 300)).withColumn("table", F.lit(name))
        prints = own if prints is None else prints.unionByName(own)
    heads = spark.createDataFrame(
        [("left", "l", "k_id", "number", 400, True, True), ("right", "r", "k_id", "number", 4000, True, False)],
        "side string, table string, column string, type_class string, n_rows long, indexed boolean, primary boolean",
    )
    row = edges.scored(prints, heads).first()
    assert row["containment"] < 0.3 and row["corrected"] == 1.0 and row["status"] == "candidate" and row["confidence"] == "medium"
    intents = spark.createDataFrame([("main", "r", "k_id", "main", "l", "k_id", "v")], mining.INTENTS)
    assert edges.with_code_evidence(edges.scored(prints, heads), intents).first()["confidence"] == "high"


def test_documents_round_trip_and_checks():
    rows = [{"column": "c", "type": "INT", "n_rows": 3, "non_null": 3, "n_distinct": 3, "low": "1", "high": "9", "top_values": ["secret-value"]}]
    doc = documents.render("core.t", "DB", "2020-01-01", rows)
    assert documents.read(doc.text()).text() == doc.text() and documents.check(doc) == []
    hidden = documents.render("core.t", "DB", "2020-01-01", rows, listed={"c"})
    assert "secret-value" not in hidden.text()
    hidden.columns["c"].append(("observed", "top_values", "x"))
    assert documents.check(hidden) == ["T011 c"]
    assert documents.review_queue(doc) == [("c", "description")]
    assert "T021 nonsense" in documents.check(documents.read(doc.text() + "nonsense\n"))


def test_paths_scopes_and_counts(spark):
    known = [("a", "b", "high"), ("b", "c", "medium"), ("a", "c", "weak")]
    way = sequence.path(known, "a", "c")
    assert way == [("a", "b", "high"), ("b", "c", "medium")] and sequence.path(known[2:], "a", "c") is None
    assert sequence.order({"a": 5, "c": 1}, way)[0] == ["c", "b", "a"]
    assert not in_scope("SYS") and in_scope("Core", ["core"]) and not in_scope("core", ["core"], ["CORE"])
    assert reconcile(5, 4, 1) == "COMPLETE" and reconcile(5, 4, 0) == "UNVERIFIED" and reconcile(5, 4, 1, failures=1) == "INCOMPLETE"
    assert values(spark, lambda c: distinct_estimate(c, F.lit(200)), [5.0, -0.5, 0.0], "double") == [5.0, 100.0, None]
    source = Source(spark, {"t": spark.range(1)}, [Constraint("t", "PRIMARY KEY", ("id",)), Constraint("u", "FOREIGN KEY", ("t_id",), "t")])
    assert source.constraint_columns().where("kind = 'FOREIGN KEY'").first()["target_column"] == "id"
    with pytest.raises(KeyError):
        source.column("t", "id; drop table t")


def test_streaming_profile_equals_the_batch(spark, tmp_path):
    from compare import SF

    from quarry.streaming.profile import windowed

    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{SF}/events.parquet*")
    run = windowed(stream, "ts", ["event_type"]).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True)
    run.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    batch = windowed(spark.read.schema(schema).parquet(f"{SF}/events.parquet"), "ts", ["event_type"])
    assert sorted(map(str, spark.table("w").collect())) == sorted(map(str, batch.collect()))


def test_distinct_counts_are_of_values_and_not_of_what_is_shown(spark):
    times = [dt.datetime(2020, 1, 1, 0, 0, 0, k * 100000) for k in range(3)]
    df = spark.createDataFrame([(1e-7, times[0], 0.0), (2e-7, times[1], -0.0), (3e-7, times[1], float("nan")), (1e40, None, float("nan"))], "a double, b timestamp_ntz, c double")
    got = {r["column"]: r for r in profile.counts(df).collect()}
    assert (got["a"]["n_distinct"], got["b"]["n_distinct"], got["c"]["n_distinct"]) == (4, 2, 2)
    assert got["a"]["low"] == "1.0E-7" and got["a"]["high"] == "1.0E40"
    assert values(spark, lambda c: exprs.as_text(c, T.DoubleType()), [0.5, 1e-7, 1e40, None], "double") == ["0.500000", "1.0E-7", "1.0E40", None]


def test_paths_are_walked_from_their_start():
    assert sequence.order({"a": 1, "b": 2, "c": 3}, [("b", "a", "high"), ("b", "c", "high")])[0] == ["a", "b", "c"]
    assert sequence.order({"a": 9, "b": 2, "c": 3}, [("b", "a", "high"), ("c", "b", "high")])[0] == ["c", "b", "a"]
    assert sequence.order({}, []) == ([], []) and sequence.order({"a": 2, "b": 1}, [("a", "b", "high")])[0] == ["b", "a"]


def test_confirmed_edges_outrank_scores_until_a_type_changes(spark):
    rows = spark.createDataFrame([("l", "a", "r", "b", "medium"), ("l", "c", "r", "d", "weak")], "l_table string, l_column string, r_table string, r_column string, confidence string")
    confirmed = spark.createDataFrame([("l", "a", "r", "b", "INT", "INT", "x", "2020"), ("l", "c", "r", "d", "INT", "TEXT", "x", "2020")], "l_table string, l_column string, r_table string, r_column string, l_type string, r_type string, by string, date string")
    now = spark.createDataFrame([("l", "a", "INT"), ("r", "b", "INT"), ("l", "c", "INT"), ("r", "d", "INT")], "table string, column string, type string")
    got = {r["l_column"]: (r["confidence"], r["standing"]) for r in edges.with_confirmations(rows, confirmed, now).collect()}
    assert got == {"a": ("confirmed", "confirmed"), "c": ("weak", "stale-confirmed")}


def test_a_crawl_writes_its_files_and_deletes_leftovers(spark, tmp_path):
    from quarry import crawl
    from quarry.plans import bundle

    source = Source(spark, {"t": spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string"), "t_old": spark.range(3)}, [Constraint("t", "PRIMARY KEY", ("id",))])
    out = crawl.crawl(source, "SHOP", date="2020-01-01")
    assert out.completeness == "COMPLETE" and out.failures == []
    (tmp_path / "db" / "SHOP" / "main").mkdir(parents=True)
    (tmp_path / "db" / "SHOP" / "main" / "gone.md").write_text("x")
    assert bundle.write(out.files, f"file://{tmp_path}") == ["db/SHOP/main/gone.md"]
    text = (tmp_path / "db" / "SHOP" / "main" / "t.md").read_text()
    assert "### id" in text and "dense_sequence: true" in text and "fingerprints/main.t.id.json" in text
    assert (tmp_path / "db" / "SHOP" / "fingerprints" / "main.t.id.json").exists()
    assert "flags: [junk]" in (tmp_path / "db" / "SHOP" / "main" / "t_old.md").read_text()
    back = bundle.from_json(bundle.to_json(out.profiles), out.profiles)
    assert back.count() == out.profiles.count()


def test_answers_and_settings():
    from quarry.plans import bundle

    assert bundle.answer('```json\n{"a": 1}\n```') == {"a": 1}
    for bad in ("[1]", "no"):
        with pytest.raises(ValueError):
            bundle.answer(bad)
    with pytest.raises(ValueError, match="unknown"):
        bundle.settings(None, {"x": 1}, {"y"})
    with pytest.raises(ValueError, match="environment"):
        bundle.settings(None, {"connection": {"Password": "p"}}, {"connection"})
