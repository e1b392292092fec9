"""Validation of bundles of profile documents: one rule, one filter; all rules in one union.

Input is a table of files (path below the root, text): `db/<database>/index.md`,
`db/<database>/<schema>/<table>.md`, `db/<database>/fingerprints/*.json`,
`rel/<a>--<b>/index.md` and `rel/<a>--<b>/<file>.md`. Output is (code, severity, path, message);
an empty result is a valid root. Documents are small and many, so everything goes by path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Required fields, tags and vocabularies of the documents.
REQUIRED = {
    "table": ["type", "name", "description", "description_confirmed", "database", "engine", "crawl_date"],
    "relationship": ["type", "tables", "built_from"],
    "index": ["type", "description", "build_date", "completeness"],
}
CODES = {"table": "T001", "relationship": "R001", "index": "I001"}
KINDS = ["observed", "inferred", "confirmed", "stale-confirmed"]
LEVELS = ["high", "medium", "low"]
COMPLETENESS = ["COMPLETE", "INCOMPLETE", "UNVERIFIED"]
REASONS = ["sensitive", "cardinality-gate", "budget", "unparseable-temporal", "none"]
SENTENCES, ONE_LINER, PAIR = (3, 6), 120, "--"
LINE = r"^- \[([a-z-]+)(?::([^\]\s]*))?[^\]]*\] ?(.*)$"
ENTRY = r"^- `([^`]*)` (?:—|--|-) ?(.*)$"
REFERENCE = r"^sha256/8B @ (\S+)$"
WARNINGS = ["I007", "I012", "X001"]


def read(spark, root: str) -> DataFrame:
    """The files of a bundle root with their paths below it."""
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("at"), F.col("value").alias("text"))
    return raw.select(F.regexp_extract("at", r"/((?:db|rel)/[^/]+/.*)$", 1).alias("path"), "text").where("path <> ''")


def documents(files: DataFrame) -> DataFrame:
    """path, class, bundle and front matter (map of plain texts) of each document."""
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    kind = F.when(name == "index.md", "index").when(parts[0] == "rel", "relationship").otherwise("table")
    head = F.regexp_extract("text", r"^---\n([\s\S]*?)\n?---(?:\n|$)", 1)
    pairs = F.filter(F.split(head, "\n"), lambda x: x.rlike(r"^[a-z_]+:"))
    value = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"^[a-z_]+:\s*", ""), r"\s+#.*$", ""))
    entries = F.transform(pairs, lambda x: F.struct(F.substring_index(x, ":", 1).alias("key"), value(x).alias("value")))
    body = F.regexp_replace("text", r"^---\n[\s\S]*?\n?---(?:\n|$)", "")
    md = files.where(F.col("path").endswith(".md"))
    return md.select("path", kind.alias("class"), F.concat_ws("/", parts[0], parts[1]).alias("bundle"), F.map_from_entries(entries).alias("front"), body.alias("body"))


def contents(docs: DataFrame) -> DataFrame:
    """path, class, pos, section (of two marks), block (a column or an edge), tag, level, text, key and value of each body line."""
    rows = docs.select("path", "class", F.posexplode(F.split("body", "\n")).alias("pos", "raw")).where(F.trim("raw") != "")
    upto = Window.partitionBy("path").orderBy("pos")  # lines of one document
    two, three = F.regexp_extract("raw", "^## (.+)$", 1), F.regexp_extract("raw", "^### (.+)$", 1)
    rows = rows.withColumn("section", F.last(F.when(two != "", two), True).over(upto))
    deep = F.last(F.when(three != "", F.struct(F.col("pos").alias("at"), three.alias("name"))).when(two != "", F.struct(F.col("pos").alias("at"), F.when(F.col("class") == "relationship", two).alias("name"))), True).over(upto)
    rows = rows.withColumn("block", deep["name"]).withColumn("block_at", deep["at"])
    part = lambda k: F.regexp_extract("raw", LINE, k)
    tagged = F.col("raw").rlike(LINE)
    text = F.when(tagged, F.trim(F.regexp_replace(part(3), r"\s+# .*$", "")))
    key = F.regexp_extract(text, r"^([a-z_]+): ", 1)
    return rows.select(
        "path", "class", "pos", "section", "block", "block_at", "raw", F.col("raw").rlike("^#{2,3} ").alias("heading"),
        F.when(tagged, part(1)).alias("tag"), F.when(tagged & (part(2) != ""), part(2)).alias("level"), text.alias("text"),
        F.when(key != "", key).alias("key"), F.when(key != "", F.regexp_replace(text, r"^[a-z_]+: ", "")).alias("value"),
        *[F.when(F.col("raw").rlike(ENTRY), F.regexp_extract("raw", ENTRY, k)).alias(n) for k, n in ((1, "entry"), (2, "one_liner"))],
    )


def listed(c: Column) -> Column:
    """The items of a flow list."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, r"^\[|\]$", ""), ","), lambda x: F.trim(x)), lambda x: x != "")


def validate(files: DataFrame) -> DataFrame:
    """(code, severity, path, message) of everything that breaks a rule."""
    docs = documents(files)
    lines = contents(docs)
    front = lambda k: F.col("front")[k]
    said = lambda *parts: F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    found: list[DataFrame] = []

    def rule(code: str, rows: DataFrame, condition: Column | str | None, message: Column) -> None:
        rows = rows if condition is None else rows.where(condition)
        found.append(rows.select(F.lit(code).alias("code"), F.lit("warning" if code in WARNINGS else "error").alias("severity"), "path", message.alias("message")))

    tags = lines.where("tag is not null")
    rule("P001", tags, ~F.col("tag").isin(KINDS), said("unknown tag", F.col("tag")))
    rule("P002", tags, (F.col("tag") == "inferred") & ~F.coalesce(F.col("level").isin(LEVELS), F.lit(False)), said("inferred without a confidence:", F.col("raw")))
    rule("P003", tags, F.col("tag").isin([k for k in KINDS if k != "inferred"]) & F.col("level").isNotNull(), said("no confidence belongs to", F.col("tag")))
    for kind, names in REQUIRED.items():
        for k in names:
            rule(CODES[kind], docs, (F.col("class") == kind) & (F.coalesce(front(k), F.lit("")).isin("", "[]")), said("missing or empty:", k))
    rule("D001", docs, front("type") != F.col("class"), said("type", front("type"), "in a document of class", F.col("class")))

    # Tables
    tables = docs.where("class = 'table'")
    rule("T002", tables, ~front("name").rlike(r"^[^.\s]+\.[^.\s]+$"), said("name is not schema.table:", front("name")))
    lines_of_head = files.select("path", F.explode(F.split(F.regexp_extract("text", r"^---\n([\s\S]*?)\n?---", 1), "\n")).alias("x"))
    rule("T003", lines_of_head.join(tables.select("path"), "path", "left_semi"), (F.trim("x") != "") & ~F.col("x").rlike("^[a-z_]+:"), said("a field of more than one line:", F.col("x")))
    rule("T004", tables, ~front("description_confirmed").isin("true", "false", ""), said("description_confirmed is no flag:", front("description_confirmed")))
    rule("T005", tables, ~front("row_count").rlike(r"^\d+$"), said("bad row_count:", front("row_count")))
    rule("T006", tables, ~front("flags").rlike(r"^\[.*\]$"), said("flags is no list:", front("flags")))
    columns = lines.where("class = 'table' and raw like '### %'").select("path", "block", F.col("block_at"))
    rule("T007", tables.join(columns, "path", "left_anti"), None, said("no columns"))
    rule("T008", columns.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n")), "n > 1", said("column twice:", F.col("block")))
    own = tags.where("class = 'table' and block is not null")
    by_column = own.groupBy("path", "block", "block_at").agg(
        F.bool_or(F.col("tag") != "observed").alias("described"),
        F.bool_or(F.coalesce(F.col("text").rlike("^sensitive"), F.lit(False))).alias("sensitive"),
        F.bool_or(F.coalesce(F.col("key") == "top_values", F.lit(False))).alias("shown"),
        F.first(F.when(F.col("key") == "fingerprint", F.col("value")), True).alias("fingerprint"),
        F.first(F.when(F.col("key") == "normalization", F.col("value")), True).alias("normalization"),
    )
    rule("T009", columns.join(by_column, ["path", "block", "block_at"], "left_anti"), None, said("column without lines:", F.col("block")))
    described = columns.select("path", "block", "block_at").join(by_column.where("described"), ["path", "block", "block_at"], "left_anti")
    rule("T010", described, None, said("column without a description:", F.col("block")))
    rule("T011", by_column, "sensitive and shown", said("sensitive column shows values:", F.col("block")))
    prints = by_column.where("fingerprint is not null").withColumn("reason", F.regexp_extract("fingerprint", r"^suppressed \((.*)\)$", 1)).withColumn("ref", F.regexp_extract("fingerprint", REFERENCE, 1))
    rule("T020", prints, (F.col("reason") != "") & ~F.col("reason").isin(REASONS), said("unknown reason:", F.col("reason")))
    rule("T021", prints, "reason = '' and ref = ''", said("neither a reference nor a reason:", F.col("fingerprint")))
    refs = prints.where("reason = '' and ref <> ''").join(tables.select("path", "bundle", front("name").alias("name")), "path")
    rule("T012", refs, "sensitive", said("sensitive column has a fingerprint:", F.col("block")))
    rule("T019", refs, F.col("ref") != F.concat(F.lit("fingerprints/"), "name", F.lit("."), "block", F.lit(".json")), said("payload path:", F.col("ref")))
    rule("T013", tables, F.concat(F.lit("db/"), front("database")) != F.col("bundle"), said("database", front("database"), "in", F.col("bundle")))
    rule("T014", tables, F.concat("bundle", F.lit("/"), F.replace(front("name"), F.lit("."), F.lit("/")), F.lit(".md")) != F.col("path"), said("path is not that of", front("name")))
    payloads = files.where("path like 'db/%/fingerprints/%.json'").select(
        F.col("path").alias("payload"), F.from_json("text", "algo string, normalization array<string>, sample_cap long, count long, hashes array<string>, signature array<long>").alias("own")
    )
    absolute = F.col("ref").startswith("/")
    held = refs.withColumn("payload", F.concat("bundle", F.lit("/"), "ref")).join(payloads, "payload", "left")
    rule("T015", held, F.col("own").isNull() & ~absolute, said("no payload at", F.col("ref")))
    rule("T016", held, absolute, said("reference is not below the bundle:", F.col("ref")))
    rule("T017", held, F.col("own").isNotNull() & (F.col("own.algo").isNull() | (F.col("own.hashes").isNull() & F.col("own.signature").isNull())), said("unreadable payload:", F.col("ref")))
    rule("T018", held, F.col("own.algo").isNotNull() & ~F.array_sort(F.coalesce("own.normalization", F.array())).eqNullSafe(F.array_sort(F.coalesce(listed(F.col("normalization")), F.array()))), said("normalization differs from the payload's:", F.col("block")))

    # Relationships
    relations = docs.where("class = 'relationship'")
    sides = relations.select("path", "bundle", listed(front("tables")).alias("tables"))
    rule("R002", sides, (F.size("tables") != 2), said("not two tables"))
    side = sides.select("path", "bundle", F.explode("tables").alias("side"))
    rule("R003", side, ~F.col("side").rlike(r"^[^.\s]+\.[^.\s]+\.[^.\s]+$"), said("not database.schema.table:", F.col("side")))
    pins = relations.select("path", "bundle", F.explode(listed(front("built_from"))).alias("pin"))
    rule("R004", pins, ~F.col("pin").rlike(r"^[^@\s]+@\d{4}-\d{2}-\d{2}$"), said("not bundle@date:", F.col("pin")))
    edges = lines.where("class = 'relationship' and raw like '## %'").select("path", "block", "block_at")
    rule("R005", relations.join(edges, "path", "left_anti"), None, said("no edges"))
    rule("R006", edges.join(tags, ["path", "block_at"], "left_anti"), None, said("edge without lines:", F.col("block")))
    pair = F.split(F.element_at(F.split("bundle", "/"), 2), PAIR)
    rule("R007", side, (F.size(pair) == 2) & ~F.array_contains(pair, F.substring_index("side", ".", 1)), said("outside the pair:", F.col("side")))

    # Indexes
    indexes = docs.where("class = 'index'")
    rule("I002", indexes, front("database").isNull() & front("databases").isNull(), said("no database"))
    two = listed(front("databases"))
    rule("I003", indexes, F.size(two) != 2, said("not two databases"))
    rule("I004", indexes, (F.size(two) == 2) & (two != F.array_sort(two)), said("databases are not sorted"))
    rule("I005", indexes, ~front("completeness").isin([*COMPLETENESS, ""]), said("unknown completeness:", front("completeness")))
    top = tags.where("class = 'index' and section is null and entry is null")
    rule("I006", indexes.join(top, "path", "left_anti"), None, said("no summary"))
    prose = top.where("tag <> 'observed'").groupBy("path").agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])).alias("prose"))
    summary = indexes.where(front("database").isNotNull()).select("path").join(top.select("path").distinct(), "path").join(prose, "path", "left")
    sentences = F.size(F.filter(F.split(F.trim(F.coalesce("prose", F.lit(""))), r"(?<=[.!?])\s+"), lambda x: F.trim(x) != ""))
    rule("I007", summary, ~sentences.between(*SENTENCES), said("sentences in the summary:", sentences))
    entries = lines.where("class = 'index' and entry is not null").select("path", "entry", "one_liner").join(indexes.select("path", "bundle"), "path")
    rule("I008", indexes.join(entries, "path", "left_anti"), None, said("no entries"))
    rule("I009", entries.groupBy("path", "entry").agg(F.count(F.lit(1)).alias("n")), "n > 1", said("entry twice:", F.col("entry")))
    rule("I010", entries, F.col("entry").startswith("/"), said("entry is not below the bundle:", F.col("entry")))
    rule("I011", entries, F.trim("one_liner") == "", said("entry without a line:", F.col("entry")))
    rule("I012", entries, F.char_length("one_liner") > ONE_LINER, said("long line of entry", F.col("entry")))

    # Bundles
    rule("B001", indexes.where("path like 'db/%'"), F.concat(F.lit("db/"), front("database")) != F.col("bundle"), said("database", front("database"), "in", F.col("bundle")))
    used = held.select("payload")
    rule("B002", payloads.join(used, "payload", "left_anti").withColumn("path", F.col("payload")), None, said("payload without a reference"))
    pairs = indexes.where("path like 'rel/%'").withColumn("pair", pair)
    rule("B003", pairs, F.size("pair") != 2, said("not a pair:", F.col("bundle")))
    rule("B004", pairs, (F.size("pair") == 2) & (F.col("pair") != F.array_sort("pair")), said("pair is not sorted:", F.col("bundle")))
    rule("B005", pairs, (F.size("pair") == 2) & (F.size(two) > 0) & (two != F.col("pair")), said("databases are not those of", F.col("bundle")))
    children = docs.where("class <> 'index'").select(F.col("path").alias("child"), "bundle", front("description").alias("description"), "class")
    places = entries.withColumn("child", F.concat("bundle", F.lit("/"), "entry"))
    homes = indexes.select("path", "bundle")
    rule("B006", children.join(homes, "bundle").join(places.select("child"), "child", "left_anti"), None, said("not listed:", F.col("child")))
    rule("B007", places.join(children.select("child"), "child", "left_anti"), None, said("listed but absent:", F.col("entry")))
    rule("B008", places.join(children.where("class = 'table'").drop("bundle"), "child"), (F.coalesce("description", F.lit("")) != "") & ~F.col("one_liner").startswith(F.col("description")), said("line does not begin with the description:", F.col("entry")))

    # Across bundles
    built = indexes.where("path like 'db/%'").select(F.col("bundle").alias("built"), front("build_date").alias("date"), front("completeness").alias("state"))
    pinned = pins.select("path", F.substring_index("pin", "@", 1).alias("built"), F.substring_index("pin", "@", -1).alias("pinned")).join(built, "built", "left")
    rule("X001", pinned, "state is null and date is null", said("no such bundle:", F.col("built")))
    rule("X002", pinned, "date <> pinned", said("stale pin of", F.col("built")))
    sources = pairs.select("path", front("completeness").alias("own"), F.explode("pair").alias("name")).withColumn("built", F.concat(F.lit("db/"), "name")).join(built, "built")
    rule("X003", sources, (F.col("state") != "COMPLETE") & (F.col("own") == "COMPLETE"), said("incomplete source:", F.col("name")))

    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return out
