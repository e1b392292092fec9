"""Registered queries with SQL, and the pipeline against a brute-force version."""

import collections
import random

import pytest
from compare import SF, duck_rows, spark_rows
from llm.test_operators import SCHEMA, brute_components, check_packing

import corpus_pipeline
from quarry.llm import mixing, quality, queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert spark_rows(queries.queries()[name](spark, SF)) == duck_rows(queries.oracle_sql()[name])


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    verdict = {r["doc_id"]: r["kept"] for r in quality.rules(docs).collect()}
    wanted = {i for i in rows if verdict[i]}
    one = corpus_pipeline.quality_rules(spark, docs, SF)
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == wanted
    best = {}
    for i in wanted:
        best[rows[i]["text"]] = max(i, best.get(rows[i]["text"], i))
    two = corpus_pipeline.exact_duplicates(spark, one, SF)
    assert two.columns == docs.columns and sorted(r["doc_id"] for r in two.collect()) == sorted(best.values())
    three = corpus_pipeline.near_duplicates(spark, two, SF)
    groups = brute_components([(i, rows[i]["text"]) for i in best.values()])
    assert three.columns == docs.columns and sorted(repr(r["doc_id"]) for r in three.collect()) == sorted({c for _, _, c in groups})
    four = corpus_pipeline.source_mix(spark, three, SF)
    times = {r["doc_id"]: r[mixing.RESULT]["times"] for r in mixing.mix(three).collect()}
    copies = collections.Counter(r["doc_id"] for r in four.collect())
    assert four.columns == docs.columns and copies == collections.Counter({i: n for i, n in times.items() if n})
    check_packing([(r["doc_id"], r["text"]) for r in four.collect()], corpus_pipeline.packed(spark, four, SF).collect())


def test_stages_drop_rows_and_not_namesakes(spark):
    """Null ids, and one doc_id on different texts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in quality.rules(docs).where("kept").select("doc_id").collect()}
    rows = docs.orderBy("doc_id").limit(40).collect()
    for same in (None, 7):
        one = docs.where(docs["doc_id"] < rows[-1]["doc_id"]).selectExpr(f"cast({'null' if same is None else same} as long) as doc_id", "text", "lang", "source", "doc_id as n_chars")
        both = one.unionByName(docs.where(docs["doc_id"] >= rows[-1]["doc_id"]).selectExpr("doc_id", "text", "lang", "source", "doc_id as n_chars"))
        assert {r["n_chars"] for r in corpus_pipeline.quality_rules(spark, both, SF).collect()} == kept

    rng = random.Random(5)
    prose = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(120))
    a, b, c, d, e = (prose() for _ in range(5))
    near = [
        (None, a, 1), (None, a + " x", 2),  # near copies without an id: one stays
        (5, b, 3), (None, b + " x", 4), (None, c, 5),  # a null-id member goes, another null-id text stays
        (8, d, 6), (3, d + " x", 7), (8, e, 8), (9, e + " x", 9),  # 8 goes as a copy of 3, its namesake represents 9
        (1, prose(), 10), (1, prose(), 11), (2, d + " y", 12), (2, d + " z", 13),  # namesakes that differ; near copies that share the least id
    ]
    table = spark.createDataFrame([(i, t, "en", "a", k) for i, t, k in near], SCHEMA)
    left = corpus_pipeline.near_duplicates(spark, table, SF)
    found = sorted(r["n_chars"] for r in left.collect())
    assert left.columns == table.columns
    assert len({1, 2} & set(found)) == len({12, 13} & set(found)) == 1 and [k for k in found if k not in (1, 2, 12, 13)] == [3, 5, 8, 10, 11]


def test_stages_of_awkward_tables(spark):
    for rows in ([], [(None, None, None, None, None)], [(1, "", None, None, 0), (1, "", None, None, 0)]):
        docs = spark.createDataFrame(rows, SCHEMA)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_awkward_rows_in_later_stages(spark):
    """Rows that the rules keep, with null and repeated ids, very long text, ties, null source, and columns named as the operators' own."""
    rng = random.Random(12)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    a, b, c, long = prose(120), prose(130), prose(140), prose(60_000)
    rows = [(None, a, "s"), (None, a, None), (None, b, "s"), (4, c, "s"), (4, c, "s"), (4, prose(90), "t"), (6, c + " x", "t"), (7, long, None), (8, None, "s"), (9, "", "s")]
    kinds = SCHEMA + ", mix long, dedup long, times long, salt long, cid long, label long, piece long, uid long"
    docs = spark.createDataFrame([(i, t, None, s, k, *range(8)) for k, (i, t, s) in enumerate(rows)], kinds)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), kinds)
        left = sorted(r["n_chars"] for r in docs.collect())
        if name == "exact dedup":
            assert len(left) == 7 and {2, 5, 6, 7} < set(left) and len({0, 1} & set(left)) == len({3, 4} & set(left)) == len({8, 9} & set(left)) == 1
        if name == "n-gram Jaccard join":
            assert len(left) == 6 and 6 not in left
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_packing(texts, corpus_pipeline.packed(spark, docs, SF).collect())
