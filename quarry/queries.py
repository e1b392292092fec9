"""Registered queries over the test tables, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import exprs, types
from quarry.operators import drift as drifting
from quarry.operators import edges, gates, measure, mining, profile
from quarry.plans import bundle, sequence, validate
from quarry.sources import dictionary
from quarry.sources.tables import Constraint, Index, Source
from quarry.streaming import profile as streaming

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def each(columns: list[str], sql: str) -> str:
    return " UNION ALL ".join(sql.replace("{c}", c) for c in columns)


TABLES = ["customer", "orders", "lineitem", "part", "supplier", "nation", "region", "events"]
LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
RENDERED = "concat(year({c}), '/', month({c}), '/', day({c}), CASE WHEN {c} = date_trunc('day', {c}) THEN '' ELSE concat(' ', hour({c}), ':', lpad(CAST(minute({c}) AS VARCHAR), 2, '0'), ':', lpad(CAST(second({c}) AS VARCHAR), 2, '0')) END)"


EVENTS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
DOUBLES = {"l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice", "value"}
EXACT = "CASE WHEN CAST(CAST({c} AS DECIMAL(38,6)) AS DOUBLE) = {c} THEN CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"


def bounds_sql(table_name: str, columns: list[str], times: set[str]) -> str:
    parts = []
    for c in columns:
        shown = RENDERED if c in times else EXACT if c in DOUBLES else "CAST({c} AS VARCHAR)"
        text = lambda e, c=c, shown=shown: shown.replace("{c}", f"{e}({c})")
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct, {text('min')} AS low, {text('max')} AS high FROM {table_name}"
        )
    return " UNION ALL ".join(parts)


INVENTORY = """SELECT t AS "table", CAST(row_number() OVER (PARTITION BY t ORDER BY n) AS INT) AS ordinal, column_name AS "column",
CASE WHEN column_type = 'BIGINT' THEN 'BIGINT' WHEN column_type = 'INTEGER' THEN 'INT' WHEN column_type = 'DOUBLE' THEN 'DOUBLE PRECISION' WHEN column_type = 'FLOAT' THEN 'REAL' WHEN column_type = 'VARCHAR' THEN 'TEXT' WHEN column_type = 'TIMESTAMP' THEN 'TIMESTAMP' WHEN column_type = 'DATE' THEN 'DATE' WHEN column_type = 'BOOLEAN' THEN 'BOOLEAN' ELSE 'UNSUPPORTED' END AS type,
true AS nullable, regexp_full_match(column_name, '[A-Za-z_][A-Za-z0-9_$#]{0,127}') AS plain_name, column_type NOT LIKE '%[%' AS profiled FROM ({all})"""
INVENTORY = INVENTORY.replace("{all}", " UNION ALL ".join(f"SELECT '{t}' AS t, row_number() OVER () AS n, column_name, column_type FROM (DESCRIBE {t})" for t in [*TABLES, "documents", "embeddings"]))


@query(INVENTORY)
def column_inventory(spark, sf_dir):
    return Source.parquet(spark, sf_dir, TABLES + ["documents", "embeddings"]).inventory()


@query(bounds_sql("lineitem", LINE, {"l_shipdate"}))
def profile_counts_lineitem(spark, sf_dir):
    return profile.counts(table(spark, sf_dir, "lineitem"))


@query(bounds_sql("orders", ORDERS, {"o_orderdate"}))
def profile_counts_orders(spark, sf_dir):
    return profile.counts(table(spark, sf_dir, "orders"))


@query(bounds_sql("events", EVENTS, {"ts"}))
def profile_counts_events(spark, sf_dir):
    return profile.counts(table(spark, sf_dir, "events"))


@query("SELECT (SELECT count(*) FROM customer) AS customer, (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lineitem")
def row_counts(spark, sf_dir):
    one = lambda n: table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias(n))
    return one("customer").crossJoin(one("orders")).crossJoin(one("lineitem"))  # three single rows


@query(
    each(
        ORDERS,
        "SELECT '{c}' AS \"column\", (count(*) - count({c})) / count(*) AS null_rate, count(DISTINCT {c}) / nullif(count({c}), 0) AS distinct_ratio FROM orders",
    )
)
def null_distinct_rates_orders(spark, sf_dir):
    return profile.rates(profile.counts(table(spark, sf_dir, "orders"), ORDERS)).select("column", "null_rate", "distinct_ratio")


@query(
    each(
        ["o_orderkey", "o_custkey"],
        "SELECT '{c}' AS \"column\", coalesce(min({c}) <= 1 AND count(DISTINCT {c}) >= 2 AND count(DISTINCT {c}) / (max({c}) - min({c}) + 1) >= 0.95, false) AS dense_sequence FROM orders",
    )
)
def dense_sequence(spark, sf_dir):
    keys = ["o_orderkey", "o_custkey"]
    return profile.dense(profile.counts(table(spark, sf_dir, "orders"), keys), keys).select("column", "dense_sequence")


@query(each(["c_name", "c_mktsegment"], "SELECT '{c}' AS \"column\", CAST(min(length({c})) AS INT) AS min_length, CAST(max(length({c})) AS INT) AS max_length, avg(length({c})) AS avg_length FROM customer"))
def length_stats_customer(spark, sf_dir):
    return profile.lengths(table(spark, sf_dir, "customer"))


TOP = """SELECT {c} AS value, count(*) AS freq, CAST(round_even(100 * count(*) / (SELECT count({c}) FROM {t}), 0) AS INT) AS percent
FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY freq DESC, value LIMIT 20"""


@query(TOP.replace("{c}", "l_returnflag").replace("{t}", "lineitem"))
def top_values_lineitem_returnflag(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "lineitem"), "l_returnflag")


@query(TOP.replace("{c}", "o_orderpriority").replace("{t}", "orders"))
def top_values_orders_priority(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("SELECT upper(trim(p_brand)) AS value, min(p_brand) AS raw, CAST(count(*) AS BIGINT) AS freq FROM part GROUP BY 1 ORDER BY md5(value) LIMIT 5000")
def normalized_sample_part_brand(spark, sf_dir):
    return profile.samples(profile.values(table(spark, sf_dir, "part"), ["p_brand"])).select("value", "raw", "freq")


@query("SELECT o_orderkey, " + RENDERED.replace("{c}", "o_orderdate") + " AS rendered FROM orders")
def temporal_render_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", exprs.render_time(F.col("o_orderdate")).alias("rendered"))


@query(
    "WITH v AS (SELECT " + RENDERED.replace("{c}", "o_orderdate") + " AS v FROM orders) SELECT 'o_orderdate' AS \"column\", CAST(min(length(v)) AS INT) AS min_length, CAST(max(length(v)) AS INT) AS max_length, sum(length(v)) / count(*) AS avg_length FROM v"
)
def temporal_lengths_orders(spark, sf_dir):
    return profile.value_lengths(profile.values(table(spark, sf_dir, "orders"), ["o_orderdate"]))


CLASSES = r"""WITH v AS ({values}), s AS (SELECT c, v FROM v GROUP BY c, v QUALIFY row_number() OVER (PARTITION BY c ORDER BY md5(v)) <= 500),
k AS (SELECT c, CASE WHEN v = '' THEN 'mixed' WHEN regexp_full_match(v, '[^@\s]+@[^@\s]+\.[^@\s]+') THEN 'email' WHEN regexp_full_match(v, '[0-9]+') THEN 'all-digits'
 WHEN NOT regexp_matches(v, '\p{L}') AND length(regexp_replace(v, '[^0-9]', '', 'g')) >= 7 AND regexp_full_match(v, '[0-9+\-() ]+') THEN 'phone-like'
 WHEN regexp_matches(v, '\p{L}') AND regexp_full_match(v, '[\p{L} .\-''’]+') THEN 'alpha' ELSE 'mixed' END AS f FROM s),
n AS (SELECT c, f, count(*) AS n FROM k GROUP BY c, f), m AS (SELECT c, max(n) AS n FROM n GROUP BY c)
SELECT c AS "column", CASE WHEN count(*) > 1 THEN 'mixed' ELSE min(f) END AS format FROM n JOIN m USING (c, n) GROUP BY c"""


@query(CLASSES.replace("{values}", each(["c_custkey", "c_name", "c_mktsegment"], "SELECT '{c}' AS c, CASE WHEN regexp_full_match(upper(trim(CAST({c} AS VARCHAR))), '[0-9]+') THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE upper(trim(CAST({c} AS VARCHAR))) END AS v FROM customer").replace("CAST(CAST(c_name AS BIGINT) AS VARCHAR)", "c_name").replace("CAST(CAST(c_mktsegment AS BIGINT) AS VARCHAR)", "c_mktsegment")))
def format_class_customer(spark, sf_dir):
    return profile.formats(profile.values(table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_mktsegment"]))


@query("SELECT upper(trim(CAST(o_orderkey AS VARCHAR))) AS value, CAST(count(*) AS BIGINT) AS freq FROM orders GROUP BY 1 ORDER BY md5(value) LIMIT 5000")
def bottom_k_orders(spark, sf_dir):
    return profile.samples(profile.values(table(spark, sf_dir, "orders"), ["o_orderkey"])).select("value", "freq")


@query("SELECT substr(sha256(v), 1, 16) AS h, md5(v) AS rank FROM (SELECT DISTINCT upper(trim(CAST(o_custkey AS VARCHAR))) AS v FROM orders) ORDER BY md5(v) LIMIT 5000")
def fingerprint_orders_custkey(spark, sf_dir):
    return profile.fingerprints(profile.samples(profile.values(table(spark, sf_dir, "orders"), ["o_custkey"]))).select("h", "rank")


@query(
    "WITH p AS ("
    + each(ORDERS, "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) / nullif(count({c}), 0) AS r FROM orders")
    + """) SELECT "column", CASE WHEN "column" = 'o_orderstatus' THEN 'sensitive' WHEN "column" = 'o_custkey' OR coalesce(r > 0.5, false) THEN 'allow' ELSE 'cardinality-gate' END AS fingerprint_gate,
CASE WHEN "column" = 'o_orderstatus' THEN 'sensitive' WHEN n_distinct <= 30 THEN 'allow' ELSE 'too-many-values' END AS top_n_gate FROM p"""
)
def gate_decisions(spark, sf_dir):
    figures = profile.rates(profile.counts(table(spark, sf_dir, "orders"), ORDERS))
    return gates.decide(figures, ["o_custkey"], ["orders.o_orderstatus"], "orders").select("column", "fingerprint_gate", "top_n_gate")


def join_inputs(spark: SparkSession, sf_dir: str, right: dict[str, list[str]]) -> tuple[DataFrame, DataFrame]:
    """Fingerprints and column headers of customer against other tables."""
    facts = {
        "constraints": [Constraint("customer", "PRIMARY KEY", ("c_custkey",)), Constraint("orders", "PRIMARY KEY", ("o_orderkey",))],
        "indexes": [Index("orders", ("o_custkey",)), Index("events", ("user_id",))],
    }
    wanted = {"customer": ["c_custkey", "c_name"], **right}
    source = Source.parquet(spark, sf_dir, list(wanted), **facts)
    keys, prints, heads = source.key_columns(), None, None
    for name, columns in wanted.items():
        df = source.tables[name]
        own = profile.fingerprints(profile.samples(profile.values(df, columns))).withColumn("table", F.lit(name))
        kinds = {f.name: types.of_spark(f.dataType) for f in df.schema.fields}
        cells = [
            F.struct(
                F.lit(c).alias("column"), F.lit("number" if types.is_integer(kinds[c]) else "text" if types.is_character(kinds[c]) else "other").alias("type_class"),
                F.lit((name, c) in keys).alias("indexed"), F.lit(any(x.table == name and c in x.columns and x.kind == "PRIMARY KEY" for x in source.constraints)).alias("primary"),
            )
            for c in columns
        ]
        head = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit("left" if name == "customer" else "right").alias("side"), F.lit(name).alias("table"), "n_rows", F.explode(F.array(*cells)).alias("cell")
        ).select("side", "table", "n_rows", "cell.*")
        prints = own if prints is None else prints.unionByName(own)
        heads = head if heads is None else heads.unionByName(head)
    return prints, heads


RIGHT = {"orders": ["o_orderkey", "o_custkey", "o_orderpriority"], "events": ["user_id"]}
SCORED = """WITH v AS (
 SELECT 'customer' AS t, 'c_custkey' AS c, 'number' AS k, CAST(c_custkey AS VARCHAR) AS v FROM customer UNION ALL SELECT 'customer', 'c_name', 'text', upper(trim(c_name)) FROM customer
 UNION ALL SELECT 'orders', 'o_orderkey', 'number', CAST(o_orderkey AS VARCHAR) FROM orders UNION ALL SELECT 'orders', 'o_custkey', 'number', CAST(o_custkey AS VARCHAR) FROM orders
 UNION ALL SELECT 'orders', 'o_orderpriority', 'text', upper(trim(o_orderpriority)) FROM orders UNION ALL SELECT 'events', 'user_id', 'number', CAST(user_id AS VARCHAR) FROM events),
d AS (SELECT t, c, k, v, row_number() OVER (PARTITION BY t, c ORDER BY md5(v)) AS n FROM (SELECT DISTINCT * FROM v WHERE v IS NOT NULL)),
s AS (SELECT t, c, k, v, md5(v) AS r, max(md5(v)) OVER (PARTITION BY t, c) AS top, (SELECT max(n) FROM d x WHERE x.t = d.t AND x.c = d.c) > 5000 AS cut, count(*) OVER (PARTITION BY t, c) AS size FROM d WHERE n <= 5000),
h AS (SELECT DISTINCT t, c, k, top, cut, size FROM s), sim(l, r, x) AS (VALUES {sims}),
p AS (SELECT l.t AS lt, l.c AS lc, r.t AS rt, r.c AS rc, l.k, l.size AS ls, r.size AS rs, l.cut OR r.cut AS cut, least(CASE WHEN l.cut THEN l.top END, CASE WHEN r.cut THEN r.top END) AS lim
  FROM h l JOIN h r ON l.k = r.k WHERE l.t = 'customer' AND r.t <> 'customer'),
o AS (SELECT p.*, (SELECT count(*) FROM s a JOIN s b USING (v) WHERE a.t = lt AND a.c = lc AND b.t = rt AND b.c = rc) AS common,
  (SELECT count(*) FROM s a JOIN s b USING (v) WHERE a.t = lt AND a.c = lc AND b.t = rt AND b.c = rc AND (lim IS NULL OR a.r <= lim)) AS within,
  (SELECT count(*) FROM s a WHERE a.t = lt AND a.c = lc AND (lim IS NULL OR a.r <= lim)) AS lw, (SELECT count(*) FROM s a WHERE a.t = rt AND a.c = rc AND (lim IS NULL OR a.r <= lim)) AS rw FROM p),
f AS (SELECT *, common / least(ls, rs) AS containment, common / (ls + rs - common) AS jaccard, within / greatest(least(lw, rw), 1) AS corrected, sim.x AS similarity FROM o JOIN sim ON sim.l = lc AND sim.r = rc),
m AS (SELECT *, CASE WHEN cut THEN corrected ELSE containment END AS measure FROM f),
z AS (SELECT *, CASE WHEN least(ls, rs) < 30 THEN 'below-floor' WHEN k = 'number' AND measure >= 0.5 AND similarity < 0.6 THEN 'suppressed' WHEN measure < 0.5 THEN 'no-overlap' WHEN measure < 0.7 THEN 'weak' ELSE 'candidate' END AS status FROM m)
SELECT lt AS l_table, lc AS l_column, rt AS r_table, rc AS r_column, """


def _sims() -> str:
    import difflib

    pairs = [(a, b) for a in ("c_custkey", "c_name") for columns in RIGHT.values() for b in columns]
    return ", ".join(f"('{a}', '{b}', {difflib.SequenceMatcher(None, a, b).ratio()!r}::DOUBLE)" for a, b in pairs)


SCORED = SCORED.replace("{sims}", _sims())


@query(SCORED + "containment, jaccard, status FROM z WHERE status IN ('candidate', 'weak')")
def overlap_edges(spark, sf_dir):
    return edges.accepted(edges.scored(*join_inputs(spark, sf_dir, RIGHT))).select("l_table", "l_column", "r_table", "r_column", "containment", "jaccard", "status")


@query(SCORED + "containment, corrected FROM z")
def overlap_edges_corrected(spark, sf_dir):
    return edges.scored(*join_inputs(spark, sf_dir, RIGHT)).select("l_table", "l_column", "r_table", "r_column", "containment", "corrected")


@query(SCORED + "status FROM z WHERE status IN ('suppressed', 'below-floor')")
def suppressed_pairs(spark, sf_dir):
    rows = edges.scored(*join_inputs(spark, sf_dir, RIGHT)).where(F.col("status").isin("suppressed", "below-floor"))
    return rows.select("l_table", "l_column", "r_table", "r_column", "status")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def sequenced_key_binding(spark, sf_dir):
    left = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return sequence.bound(table(spark, sf_dir, "orders"), "o_custkey", left, "c_custkey").select("o_orderkey", "o_custkey")


VIEWS = [
    ("main", "v_orders", "SELECT c.c_name, o.o_totalprice FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey", False),
    ("main", "v_lines", "SELECT * FROM orders o, lineitem l WHERE l.l_orderkey = o.o_orderkey -- and o.o_orderkey = l.l_partkey", False),
    ("main", "v_dynamic", "BEGIN EXECUTE 'SELECT 1'; END", False),
    ("main", "v_nested", "SELECT a.x FROM (SELECT 1 AS x) a", False),
    ("main", "v_cut", "SELECT 1 FROM orders", True),
]


def mined_views(spark, sf_dir):
    names = {("main", t): table(spark, sf_dir, t).columns for t in ("customer", "orders", "lineitem")}
    return mining.mined(spark.createDataFrame(VIEWS, "schema string, name string, definition string, truncated boolean"), names)


@query("SELECT * FROM (VALUES ('main', 'customer', 'c_custkey', 'main', 'orders', 'o_custkey', 'main.v_orders'), ('main', 'lineitem', 'l_orderkey', 'main', 'orders', 'o_orderkey', 'main.v_lines')) t(schema, \"table\", \"column\", other_schema, other_table, other_column, source)")
def join_intent_edges(spark, sf_dir):
    return mining.intents(mined_views(spark, sf_dir))


@query("SELECT * FROM (VALUES ('v_orders', 'parsed', NULL), ('v_lines', 'parsed', NULL), ('v_dynamic', 'unparsed', 'dynamic-sql'), ('v_nested', 'unparsed', 'nested-select'), ('v_cut', 'unparsed', 'truncated')) t(name, status, reason)")
def code_object_status(spark, sf_dir):
    return mined_views(spark, sf_dir).select("name", "status", "reason")


@query(
    """SELECT o_custkey, CASE WHEN n % 3 = 0 THEN 'no-statistics' WHEN n % 3 = 1 THEN 'estimate' WHEN CAST(last AS DATE) < DATE '2001-06-01' - 90 THEN 'stale' ELSE 'none' END AS row_scan,
CASE WHEN CAST(last AS DATE) < DATE '2001-06-01' - 90 THEN 'stale' WHEN n BETWEEN 15 AND 60 THEN 'near-boundary' ELSE 'none' END AS column_scan
FROM (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last FROM orders GROUP BY o_custkey)"""
)
def stats_first_plan(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").cast("date").alias("last"))
    today = F.to_date(F.lit("2001-06-01"))
    source = F.when(F.col("n") % 3 == 0, F.lit(None)).when(F.col("n") % 3 == 1, "stats-estimate").otherwise("stats")
    return rows.select(
        "o_custkey", gates.table_scan(source, F.col("last"), today).alias("row_scan"), gates.column_scan(F.col("n"), F.lit(False), F.col("last"), today).alias("column_scan")
    )


def order_profile(df: DataFrame) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    figures = profile.rates(profile.counts(df, columns))
    return figures.select(
        F.lit("orders").alias("table"), "column", F.lit("t").alias("type"), "n_rows", "n_distinct", "distinct_ratio", "null_rate", F.lit(None).cast("string").alias("description")
    )


DRIFT = (
    "WITH a AS ("
    + each(["o_orderkey", "o_custkey", "o_orderstatus"], "SELECT '{c}' AS c, count(*) AS n, count(DISTINCT {c}) AS d, count(DISTINCT {c}) / nullif(count({c}), 0) AS r FROM orders")
    + "), b AS ("
    + each(["o_orderkey", "o_custkey", "o_orderstatus"], "SELECT '{c}' AS c, count(*) AS n, count(DISTINCT {c}) AS d, count(DISTINCT {c}) / nullif(count({c}), 0) AS r FROM orders WHERE o_orderstatus = 'F'")
    + """), j AS (SELECT a.c, a.n, a.d, a.r, b.n AS n2, b.d AS d2, b.r AS r2 FROM a JOIN b USING (c))
SELECT 'orders' AS "table", c AS "column", 'profile' AS class, x AS reason, true AS invalidates FROM (
 SELECT c, 'n_rows-shifted' AS x FROM j WHERE abs(n2 - n) / n > 0.1 UNION ALL SELECT c, 'n_distinct-shifted' FROM j WHERE abs(d2 - d) / d > 0.1 UNION ALL SELECT c, 'distinct_ratio-shifted' FROM j WHERE abs(r2 - r) > 0.05)"""
)


@query(DRIFT)
def profile_drift(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return drifting.drift(order_profile(orders), order_profile(orders.where("o_orderstatus = 'F'")))


@query("SELECT * FROM (VALUES ('customer name', 'customer', 'c_name'), ('order date', 'orders', 'o_orderdate'), ('account balance', 'customer', 'c_acctbal')) t(field, \"table\", \"column\")")
def field_resolution(spark, sf_dir):
    return sequence.best(field_scores(spark, sf_dir)).select("field", "table", "column")


def field_scores(spark, sf_dir):
    wanted = spark.createDataFrame([("customer name", "text"), ("order date", "other"), ("account balance", "number")], "field string, type_class string")
    rows = Source.parquet(spark, sf_dir, ["customer", "orders"]).inventory()
    kind = F.when(F.col("type").isin("TEXT"), "text").when(F.col("type").isin("TIMESTAMP", "DATE"), "other").otherwise("number")
    return sequence.resolve(wanted, rows.select("table", "column", kind.alias("type_class"), F.lit("").alias("description")))


@query("SELECT * FROM (VALUES ('customer name', 1, 'c_name'), ('order date', 1, 'o_orderdate'), ('account balance', 1, 'c_acctbal')) t(field, rank, \"column\")")
def field_candidates(spark, sf_dir):
    return sequence.ranked(field_scores(spark, sf_dir), 3).where("rank = 1").select("field", "rank", "column")


MEASURED = """WITH p AS ({parts}),
g AS (SELECT *, CASE WHEN c = 'o_orderstatus' THEN 'sensitive' WHEN c = 'o_custkey' OR d / nullif(m, 0) > 0.5 THEN 'allow' ELSE 'cardinality-gate' END AS fingerprint_gate,
  CASE WHEN c = 'o_orderstatus' THEN 'sensitive' WHEN d <= 30 THEN 'allow' ELSE 'too-many-values' END AS top_n_gate FROM p)
SELECT c AS "column", n AS n_rows, m AS non_null, d AS n_distinct, fingerprint_gate, top_n_gate, w AS dense_sequence,
  CASE WHEN fingerprint_gate = 'allow' THEN least(r, 5000) END AS hashes, CASE WHEN fingerprint_gate = 'allow' THEN CASE WHEN r > 5000 THEN greatest(5000, d) ELSE r END END AS sample_count,
  CASE WHEN top_n_gate = 'allow' THEN least(d, 20) END AS shown, CASE WHEN fingerprint_gate = 'allow' THEN NULL ELSE fingerprint_gate END AS suppressed FROM g"""


def measured_sql(name: str, columns: list[str], times: set[str]) -> str:
    parts = []
    for c in columns:
        shown = (RENDERED if c in times else EXACT if c in DOUBLES else "CAST({c} AS VARCHAR)").replace("{c}", c)
        whole = f"coalesce(min({c}) <= 1 AND count(DISTINCT {c}) >= 2 AND count(DISTINCT {c}) / (max({c}) - min({c}) + 1) >= 0.95, false)" if c.endswith("key") else "false"
        parts.append(f"SELECT '{c}' AS c, count(*) AS n, count({c}) AS m, count(DISTINCT {c}) AS d, count(DISTINCT upper(trim({shown}))) AS r, {whole} AS w FROM {name}")
    return MEASURED.replace("{parts}", " UNION ALL ".join(parts))


@query(measured_sql("orders", ORDERS, {"o_orderdate"}))
def measured_orders(spark, sf_dir):
    options = measure.Options(keys=["o_custkey"], sensitive=["orders.o_orderstatus"])
    rows = measure.measured(table(spark, sf_dir, "orders"), "orders", options)
    count = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).cast("long")
    return rows.select("column", "n_rows", "non_null", "n_distinct", "fingerprint_gate", "top_n_gate", "dense_sequence", count("fingerprint").alias("hashes"), "sample_count", count("top_values").alias("shown"), "suppressed")


@query("SELECT * FROM (VALUES ('o_orderkey', 'none', 1000, 'stats'), ('o_custkey', 'none', 90, 'stats'), ('o_orderpriority', 'near-boundary', (SELECT count(DISTINCT o_orderpriority) FROM orders), 'live'), ('o_orderdate', 'no-statistics', (SELECT count(DISTINCT o_orderdate) FROM orders), 'live')) t(\"column\", scan, n_distinct, distinct_source)")
def measured_with_statistics(spark, sf_dir):
    import datetime as dt

    day = dt.date(2020, 6, 1)
    rows = [(None, 1000, None, None, False, "stats", day), ("o_orderkey", 1000, 1000, 0.0, False, "stats", day), ("o_custkey", 1000, 90, 0.0, False, "stats", day), ("o_orderpriority", 1000, 20, 0.0, False, "stats", day)]
    stats = spark.createDataFrame(rows, "column string, n_rows long, n_distinct long, null_fraction double, approximate boolean, source string, stats_date date")
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    return measure.measured(df, "orders", measure.Options(today=day), stats).select("column", "scan", "n_distinct", "distinct_source")


HEADS = [("s", "pk_a", "s", "a", "PRIMARY KEY"), ("s", "fk_b", "s", "b", "FOREIGN KEY"), ("s", "u_c", "s", "c", "UNIQUE")]
USAGE = [("s", "pk_a", "x", 1), ("s", "pk_a", "y", 2), ("s", "fk_b", "ay", 2), ("s", "fk_b", "ax", 1), ("s", "u_c", "m", 1), ("s", "u_c", "n", 1)]


@query("SELECT * FROM (VALUES ('a', 'PRIMARY KEY', 'x,y', NULL, NULL, false), ('b', 'FOREIGN KEY', 'ax,ay', 'a', 'x,y', false), ('c', 'UNIQUE', 'm,n', NULL, NULL, true)) t(\"table\", kind, columns, target, target_columns, ambiguous)")
def constraint_pairing(spark, sf_dir):
    heads = spark.createDataFrame(HEADS, "constraint_schema string, constraint_name string, table_schema string, table_name string, constraint_type string")
    usage = spark.createDataFrame(USAGE, "constraint_schema string, constraint_name string, column_name string, ordinal_position int")
    refs = spark.createDataFrame([("s", "fk_b", "s", "pk_a")], "constraint_schema string, constraint_name string, unique_constraint_schema string, unique_constraint_name string")
    rows = dictionary.constraints(heads, usage, refs)
    return rows.select("table", "kind", F.array_join("columns", ",").alias("columns"), "target", F.array_join("target_columns", ",").alias("target_columns"), "ambiguous")


@query("SELECT * FROM (VALUES ('orders', 'o_orderkey', 1), ('orders', 'o_custkey', 2), ('orders', 'o_totalprice', NULL)) t(\"table\", \"column\", place)")
def index_columns(spark, sf_dir):
    rows = spark.createDataFrame([("s", "orders", "i", True, ["o_orderkey", "o_custkey"], ["o_totalprice"])], "schema string, table string, name string, primary boolean, columns array<string>, included array<string>")
    return dictionary.indexes(rows).select("table", "column", "place")


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN CAST(n_nationkey + 1 AS BIGINT) WHEN n_nationkey % 3 = 1 THEN CAST(round_even(0.5 * 10 * n_nationkey, 0) AS BIGINT) END AS n_distinct FROM nation""")
def planner_distincts(spark, sf_dir):
    n = F.col("n_nationkey")
    figure = F.when(n % 3 == 0, (n + 1).cast("double")).when(n % 3 == 1, F.lit(-0.5)).otherwise(F.lit(0.0))
    return table(spark, sf_dir, "nation").select("n_nationkey", dictionary.estimated(10 * n, figure).alias("n_distinct"))


@query("SELECT CAST(o_custkey % 50 AS VARCHAR) AS \"table\", arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS n_rows FROM orders GROUP BY 1")
def latest_collections(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.lit("s").alias("schema"), (F.col("o_custkey") % 50).cast("string").alias("table"), F.col("o_orderkey").alias("n_rows"), F.struct("o_orderdate", "o_orderkey").alias("at"))
    newest = rows.groupBy("schema", "table").agg(F.max_by("n_rows", "at").alias("n_rows"))
    return newest.select("table", "n_rows")


@query("SELECT o_orderpriority AS \"table\", CAST(sum(o_custkey) AS BIGINT) AS n_rows FROM orders GROUP BY 1")
def partition_sums(spark, sf_dir):
    return dictionary.partitions(table(spark, sf_dir, "orders").select(F.lit("s").alias("schema"), F.col("o_orderpriority").alias("table"), F.col("o_custkey").alias("n_rows"))).select("table", "n_rows")


@query("SELECT * FROM (VALUES ('ghost', 'x')) t(\"table\", \"column\")")
def orphan_columns(spark, sf_dir):
    tables = spark.createDataFrame([("s", t, "BASE TABLE") for t in TABLES], "table_schema string, table_name string, table_type string")
    columns = [("s", t, c) for t in TABLES for c in table(spark, sf_dir, t).columns] + [("s", "ghost", "x")]
    return dictionary.inventory(tables, spark.createDataFrame(columns, "table_schema string, table_name string, column_name string"))[1].select("table", "column")


@query("SELECT * FROM (VALUES ('s.far', 'srv.db.s.t', 'synonym'), ('other', 'other', 'server')) t(name, target, kind)")
def external_references(spark, sf_dir):
    synonyms = spark.createDataFrame([("s", "far", "srv.db.s.t"), ("s", "near", "s.t")], "schema string, name string, target string")
    return dictionary.external(synonyms, spark.createDataFrame([("other",)], "name string"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN true WHEN event_id % 4 = 1 THEN false END AS flag, nullif(trim(CASE WHEN event_id % 2 = 0 THEN '  ' ELSE concat(' ', event_type, ' ') END), '') AS text FROM events")
def coerced_values(spark, sf_dir):
    n = F.col("event_id")
    word = F.when(n % 4 == 0, " YES").when(n % 4 == 1, "0").when(n % 4 == 2, "maybe")
    blank = F.when(n % 2 == 0, "  ").otherwise(F.concat(F.lit(" "), "event_type", F.lit(" ")))
    return table(spark, sf_dir, "events").select("event_id", dictionary.flag(word).alias("flag"), dictionary.text(blank).alias("text"))


@query("SELECT * FROM (VALUES ('Name', 'Name', false), ('code', 'CODE', false), ('id', NULL, true), ('ghost', NULL, false)) t(\"column\", found, ambiguous)")
def identifier_lookup(spark, sf_dir):
    names = spark.createDataFrame([("Name",), ("name",), ("CODE",), ("ID",), ("Id",)], "column string")
    return dictionary.lookup(names, spark.createDataFrame([("Name",), ("code",), ("id",), ("ghost",)], "column string"), "column")


@query(SCORED + "status, CASE WHEN status = 'candidate' THEN CASE WHEN least((SELECT count(*) FROM customer), CASE rt WHEN 'orders' THEN (SELECT count(*) FROM orders) ELSE (SELECT count(*) FROM events) END) >= 1000 AND k <> 'number' THEN 'high' ELSE 'medium' END WHEN status = 'weak' THEN 'weak' END AS confidence, (lc = 'c_custkey' AND rc IN ('o_custkey', 'o_orderkey', 'user_id')) AS both_indexed, rc = 'o_orderkey' AS primary_right FROM z")
def edge_labels(spark, sf_dir):
    rows = edges.scored(*join_inputs(spark, sf_dir, RIGHT))
    has = lambda label: F.array_contains("boosts", label)
    return rows.select("l_table", "l_column", "r_table", "r_column", "status", "confidence", has("idx-idx").alias("both_indexed"), has("pi-right").alias("primary_right"))


@query("SELECT count(*) FILTER (status = 'candidate') AS accepted, count(*) FILTER (status = 'weak') AS weak, count(*) FILTER (status = 'suppressed') AS suppressed_int_pairs, count(*) FILTER (status = 'below-floor') AS below_evidence_floor, count(*) FILTER (status = 'no-overlap') AS no_overlap FROM ("
       + SCORED.replace("SELECT lt AS l_table, lc AS l_column, rt AS r_table, rc AS r_column, ", "SELECT status FROM z)"))
def edge_counters(spark, sf_dir):
    return edges.counters(edges.scored(*join_inputs(spark, sf_dir, RIGHT)))


@query("SELECT * FROM (VALUES ('customer', 'c_custkey', 'lineitem', 'l_suppkey', 'medium', true), ('customer', 'c_custkey', 'orders', 'o_custkey', CASE WHEN (SELECT count(*) FROM (SELECT DISTINCT o_custkey AS v FROM orders INTERSECT SELECT c_custkey FROM customer)) / (SELECT least(count(DISTINCT o_custkey), (SELECT count(*) FROM customer)) FROM orders) >= 0.7 THEN 'high' ELSE 'medium' END, false)) t(l_table, l_column, r_table, r_column, confidence, no_evidence)")
def declared_edges(spark, sf_dir):
    rows = [("main", "customer", "c_custkey", "main", "orders", "o_custkey", "v1"), ("main", "customer", "c_custkey", "main", "lineitem", "l_suppkey", "v2")]
    scored = edges.with_code_evidence(edges.scored(*join_inputs(spark, sf_dir, RIGHT)), spark.createDataFrame(rows, mining.INTENTS))
    return scored.where("declared").select("l_table", "l_column", "r_table", "r_column", "confidence", F.array_contains("boosts", "no-value-evidence").alias("no_evidence"))


@query("SELECT * FROM (VALUES ('customer', 'c_custkey', 'join-intent: orders.o_custkey (main.v_orders)'), ('orders', 'o_custkey', 'join-intent: customer.c_custkey (main.v_orders)'), ('lineitem', 'l_orderkey', 'join-intent: orders.o_orderkey (main.v_lines)'), ('orders', 'o_orderkey', 'join-intent: lineitem.l_orderkey (main.v_lines)')) t(\"table\", \"column\", line)")
def join_intent_lines(spark, sf_dir):
    return bundle.join_intents(mining.intents(mined_views(spark, sf_dir)), ["customer", "orders", "lineitem"])


@query("SELECT * FROM (VALUES ('orders', 'o_orderstatus', 'schema', 'constraint-changed', true), ('orders', 'o_orderkey', 'profile', 'fingerprint-changed', true), ('orders', NULL, 'profile', 'flags-changed', true), ('old', NULL, 'table', 'table-dropped', true), ('new', NULL, 'table', 'table-added', true)) t(\"table\", \"column\", class, reason, invalidates)")
def drift_reasons(spark, sf_dir):
    own = order_profile(table(spark, sf_dir, "orders")).withColumns({"constraints": F.array(F.lit("PRIMARY KEY")), "fingerprint": F.lit("a"), "flags": F.lit("[]")})
    status = F.col("column") == "o_orderstatus"
    now = own.withColumns({"constraints": F.when(status, F.array().cast("array<string>")).otherwise(F.col("constraints")), "fingerprint": F.when(F.col("column") == "o_orderkey", "b").otherwise("a"), "flags": F.lit("[junk]")})
    return drifting.drift(own.unionByName(own.limit(1).withColumn("table", F.lit("old"))), now.unionByName(now.limit(1).withColumn("table", F.lit("new"))), by_table=True)


@query("SELECT * FROM (VALUES ('T010', 'error', 'db/SHOP/main/orders.md'), ('B007', 'error', 'db/SHOP/index.md')) t(code, severity, path)")
def bundle_findings(spark, sf_dir):
    """A bundle of orders is written as files and checked after a description and a table document have gone."""
    rows = bundle.annotated(measure.measured(table(spark, sf_dir, "orders"), "orders", measure.Options(sensitive=["o_orderstatus"])))
    more = bundle.annotated(measure.measured(table(spark, sf_dir, "nation"), "nation"))
    both = rows.unionByName(more)
    files = bundle.table_files(both, "SHOP", "2020-01-01").unionByName(bundle.index_file(both, "SHOP", "2020-01-01", "Orders. And nations. Nothing else.", "COMPLETE"))
    broken = files.where("path not like '%nation%'").withColumn("text", F.regexp_replace("text", r"(### o_custkey[\s\S]*?)\n- \[inferred:low\] insufficient evidence", "$1"))
    documents = spark.createDataFrame(broken.collect(), broken.schema)  # four documents; rules read them many times
    return validate.validate(documents).select("code", "severity", "path")


@query(
    each(["event_type", "user_id"], "SELECT date_trunc('hour', ts) AS window_start, '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS non_null, min(CAST({c} AS VARCHAR)) AS low, max(CAST({c} AS VARCHAR)) AS high FROM events GROUP BY 1")
)
def event_window_profile(spark, sf_dir):
    rows = streaming.windowed(table(spark, sf_dir, "events"), "ts", ["event_type", "user_id"]).drop("about_distinct")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
