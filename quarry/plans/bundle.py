"""Bundles of documents: written from profiles and edges, refreshed without leftovers, and read as JSON.

The documents are those that quarry.plans.validate checks. One row of `files` is one file
(path below the root, text), made by DataFrame functions; only write() touches the file system.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHOWN = 6
TAG = r"^\s*\[[a-z-]+(:[a-z]+)?\]\s*"


def sanitized(text: Column) -> Column:
    """Prose for one line: white space flattened, a leading tag dropped, the first sentence only; nothing left is null."""
    flat = F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), TAG, "")
    return F.nullif(F.regexp_extract(flat, r"^(.*?[.!?])(?:\s|$)|^(.*)$", 0), F.lit(""))


def annotated(profiles: DataFrame, said: DataFrame | None = None) -> DataFrame:
    """profiles with description and confidence of each column; said (table, column, description, confidence) is cleaned first.

    What names no column of the profiles is left out, an unknown confidence is low, and a column without
    a description says that evidence is insufficient. Sensitive columns never show more than that.
    """
    if said is None:
        said = profiles.sparkSession.createDataFrame([], "table string, column string, description string, confidence string")
    clean = said.select("table", "column", sanitized(F.col("description")).alias("description"), F.when(F.col("confidence").isin("high", "medium", "low"), F.col("confidence")).otherwise("low").alias("confidence"))
    rows = profiles.join(clean.dropDuplicates(["table", "column"]), ["table", "column"], "left")
    blank = F.col("description").isNull()
    return rows.withColumns({"confidence": F.when(blank, "low").otherwise(F.col("confidence")), "description": F.coalesce("description", F.lit("insufficient evidence"))})


def join_intents(facts: DataFrame, tables: list[str]) -> DataFrame:
    """Mined joins in both directions, between base tables only: table, column, line."""
    there = facts.select("table", "column", "other_table", "other_column", "source")
    back = facts.select(F.col("other_table").alias("table"), F.col("other_column").alias("column"), F.col("table").alias("other_table"), F.col("column").alias("other_column"), "source")
    rows = there.unionByName(back).where(F.col("table").isin(tables) & F.col("other_table").isin(tables))
    return rows.select("table", "column", F.concat(F.lit("join-intent: "), "other_table", F.lit("."), "other_column", F.lit(" ("), "source", F.lit(")")).alias("line")).distinct()


def literal(c: Column, kind: Column) -> Column:
    """A bound as it is written: numbers bare, all else quoted."""
    number = kind.rlike("^(INT|BIGINT|SMALLINT|TINYINT|BYTEINT|DECIMAL|NUMERIC|NUMBER|REAL|FLOAT|DOUBLE)")
    return F.when(number, c).otherwise(F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'")))


def table_files(profiles: DataFrame, database: str, crawl_date: str, engine: str = "spark", schema: str = "main") -> DataFrame:
    """(path, text) of table documents and fingerprint payloads, from annotated profiles of quarry.operators.measure."""
    live = F.when(F.col("distinct_source") == "live", "").otherwise(F.concat(F.lit("  # source: "), F.coalesce("distinct_source", F.lit("none"))))
    say = lambda key, value, tag="observed": F.when(value.isNotNull(), F.concat(F.lit(f"- [{tag}] {key}: "), value))
    txt = lambda c: F.col(c).cast("string")
    counts = F.when(F.col("n_distinct").isNotNull(), F.concat_ws("; ", F.concat(txt("n_distinct"), F.coalesce(F.concat(F.lit("; distinct_ratio: "), txt("distinct_ratio")), F.lit(""))), F.concat(F.lit("null_rate: "), txt("null_rate"))))
    bounds = F.concat(F.lit("["), literal(F.col("low"), F.col("type")), F.lit(" .. "), literal(F.col("high"), F.col("type")), F.lit("]"))
    shape = F.concat_ws("; ", F.coalesce("format", F.lit("mixed")), F.when(~F.col("sensitive"), F.concat(F.lit("range: "), bounds)))
    tops = F.concat(F.lit("["), F.array_join(F.transform(F.slice("top_values", 1, SHOWN), lambda x: F.concat(x["value"], F.lit(" ("), x["percent"].cast("string"), F.lit("%)"))), ", "), F.lit("]"))
    place = F.concat(F.lit(f"fingerprints/{schema}."), "table", F.lit("."), "column", F.lit(".json"))
    lines = F.array_compact(
        F.array(
            F.concat(F.lit("### "), "column"), say("type", txt("type")), F.concat(say("distinct_count", counts), live),
            F.when(F.col("min_length").isNotNull() & F.col("max_length").isNotNull(), F.concat(F.lit("- [observed] length: "), txt("min_length"), F.lit(".."), txt("max_length"), F.lit("; avg: "), txt("avg_length"))),
            say("format", shape), F.when(F.col("dense_sequence"), F.lit("- [observed] dense_sequence: true")),
            F.when(F.col("sensitive"), F.lit("- [observed] sensitive: true")), F.when(~F.col("sensitive"), say("top_values", tops)),
            F.when(F.col("fingerprint").isNotNull(), F.concat(F.lit("- [observed] fingerprint: sha256/8B @ "), place)).otherwise(F.concat(F.lit("- [observed] fingerprint: suppressed ("), F.coalesce("suppressed", F.lit("none")), F.lit(")"))),
            F.when(F.col("fingerprint").isNotNull(), F.concat(F.lit("- [observed] normalization: ["), F.array_join(F.when(F.size("rules") > 0, F.col("rules")).otherwise(F.array(F.lit("none"))), ", "), F.lit("]"))),
            F.concat(F.lit("- [inferred:"), "confidence", F.lit("] "), "description"),
        )
    )
    blocks = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", F.array_join(lines, "\n").alias("block")))), lambda x: x["block"]), "\n\n")  # columns of one table
    junk = F.bool_or(F.col("why") == "junk")
    head = [
        ("type", F.lit("table")), ("name", F.concat(F.lit(f"{schema}."), "table")), ("description", F.concat(F.lit("Table "), "table")), ("description_confirmed", F.lit("false")),
        ("database", F.lit(database)), ("engine", F.lit(engine)), ("row_count", F.max("n_rows").cast("string")), ("row_count_source", F.max("row_count_source")),
        ("crawl_date", F.lit(crawl_date)), ("flags", F.when(junk, "[junk]").when(F.max("n_rows") == 0, "[empty]").otherwise("[]")),
    ]
    front = F.concat_ws("\n", F.lit("---"), *[F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v)) for k, v in head], F.lit("---\n\n## Columns\n\n"))
    tables = profiles.groupBy("table").agg(F.concat(front, blocks, F.lit("\n")).alias("text"))
    docs = tables.select(F.concat(F.lit(f"db/{database}/{schema}/"), "table", F.lit(".md")).alias("path"), "text")
    body = F.to_json(
        F.struct(
            F.lit("sha256-64").alias("algo"), F.when(F.size("rules") > 0, F.col("rules")).otherwise(F.array(F.lit("none"))).alias("normalization"), F.lit(5000).alias("sample_cap"),
            F.col("sample_count").alias("count"), F.col("fingerprint").alias("hashes"),
        )
    )
    payloads = profiles.where("fingerprint is not null").select(F.concat(F.lit(f"db/{database}/"), place).alias("path"), F.concat(body, F.lit("\n")).alias("text"))
    return docs.unionByName(payloads)


def index_file(profiles: DataFrame, database: str, build_date: str, summary: str, completeness: str, objects: tuple[int, int] | None = None, outside: list[str] = (), schema: str = "main") -> DataFrame:
    """(path, text) of a database's index: its summary, how many code objects were read, what lies outside, and a line a table."""
    rows = profiles.groupBy("table").agg(F.max("n_rows").alias("n"))
    line = F.concat(F.lit(f"- `{schema}/"), "table", F.lit(".md` — Table "), "table", F.coalesce(F.concat(F.lit(" ("), F.col("n").cast("string"), F.lit(" rows)")), F.lit("")))
    top = ["---", "type: index", f"database: {database}", f"description: Tables of {database}.", "engine: spark", f"build_date: {build_date}", f"completeness: {completeness}", "---", "", f"- [inferred:low] {summary}"]
    top += [f"- [observed] code_objects: {objects[0]}; unparsed: {objects[1]}"] if objects is not None else []
    top += [f"- [observed] external_reference: {name}" for name in sorted(outside)]
    text = F.concat(F.lit("\n".join([*top, "", "## Tables", ""]) + "\n"), F.array_join(F.array_sort(F.collect_list(line)), "\n"), F.lit("\n"))
    return rows.agg(text.alias("text")).select(F.lit(f"db/{database}/index.md").alias("path"), "text")


def pair_files(edges: DataFrame, left: str, right: str, dates: dict[str, str], counters: dict[str, int], schema: str = "main") -> DataFrame:
    """(path, text) of the relationship documents of two databases and their index, from scored edges."""
    first, second = sorted((left, right))
    said = lambda c: F.bround(F.col(c), 3).cast("string")
    block = F.concat(
        F.lit("## "), "l_table", F.lit("."), "l_column", F.lit(" <-> "), "r_table", F.lit("."), "r_column",
        F.lit("\n- [observed] containment: "), F.coalesce(said("containment"), F.lit("unknown")), F.lit("; jaccard: "), F.coalesce(said("jaccard"), F.lit("unknown")),
        F.lit("\n- [observed] boosts: ["), F.array_join("boosts", ", "), F.lit("]\n- [inferred:"), F.when(F.col("confidence") == "weak", "low").otherwise(F.col("confidence")), F.lit("] Likely join."),
    )
    pins = ", ".join(f"db/{n}@{dates[n]}" for n in (first, second))
    head = F.concat(F.lit(f"---\ntype: relationship\ntables: [{left}.{schema}."), "l_table", F.lit(f", {right}.{schema}."), "r_table", F.lit(f"]\nbuilt_from: [{pins}]\n---\n\n"))
    name = F.concat("l_table", F.lit("--"), "r_table", F.lit(".md"))
    docs = edges.groupBy("l_table", "r_table").agg(F.array_join(F.array_sort(F.collect_list(block)), "\n\n").alias("blocks"), F.count(F.lit(1)).alias("n"))
    docs = docs.select(name.alias("name"), F.concat(head, "blocks", F.lit("\n")).alias("text"), "n")
    numbers = [f"{k}: {v}" for k, v in counters.items()]
    top = "\n".join(["---", "type: index", f"databases: [{first}, {second}]", f"description: Edges of {first} and {second}.", f"build_date: {max(dates.values())}", "completeness: COMPLETE", *numbers, "---", "", "- [inferred:low] Edges by the overlap of fingerprints.", "", "## Table pairs", ""])
    line = F.concat(F.lit("- `"), "name", F.lit("` — "), F.col("n").cast("string"), F.lit(" edge(s)"))
    index = docs.agg(F.concat(F.lit(top + "\n"), F.array_join(F.array_sort(F.collect_list(line)), "\n"), F.lit("\n")).alias("text"))
    return docs.select(F.concat(F.lit(f"rel/{first}--{second}/"), "name").alias("path"), "text").unionByName(index.select(F.lit(f"rel/{first}--{second}/index.md").alias("path"), "text"))


def write(files: DataFrame, root: str) -> list[str]:
    """Write files below root by Hadoop's file systems, and delete documents there that are not among them; the deleted paths.

    The files are documents: one a table, held by no task but the one that writes them.
    """
    spark = files.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(root)
    store = top.getFileSystem(conf)
    kept = set()
    for r in files.toLocalIterator():
        kept.add(r["path"])
        out = store.create(jvm.org.apache.hadoop.fs.Path(top, r["path"]), True)
        out.write(bytearray(r["text"].encode()))
        out.close()
    gone = []
    base = store.makeQualified(top).toString().rstrip("/") + "/"
    found = store.listFiles(top, True)
    while found.hasNext():
        at = found.next().getPath()
        name = at.toString()[len(base) :]
        if name.startswith(("db/", "rel/")) and name.endswith((".md", ".json")) and name not in kept:
            store.delete(at, False)
            gone.append(name)
    return sorted(gone)


def to_json(profiles: DataFrame) -> DataFrame:
    """Profiles as one JSON text a row, to keep a crawl."""
    return profiles.select(F.to_json(F.struct(*profiles.columns)).alias("value"))


def from_json(lines: DataFrame, like: DataFrame) -> DataFrame:
    """Profiles from such texts; keys that are missing are null."""
    return lines.select(F.from_json("value", like.schema).alias("x")).select("x.*")


def answer(text: str) -> dict:
    """The JSON object in an annotator's answer, with or without a code fence; anything else is an error."""
    body = text.strip()
    if body.startswith("```"):
        body = body.partition("\n")[2].rpartition("```")[0]
    found = json.loads(body)
    if not isinstance(found, dict):
        raise ValueError("not an object")
    return found


def settings(spark: SparkSession, values: dict, known: set[str]) -> dict:
    """A run's settings; unknown keys and passwords are refused."""
    if unknown := sorted(set(values) - known):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    if secrets := sorted({"password", "passwd", "pwd", "secret"} & {k.lower() for k in values.get("connection", {})}):
        raise ValueError(f"passwords come from the environment, not from: {', '.join(secrets)}")
    return values
