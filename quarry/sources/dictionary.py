"""Database dictionaries as DataFrames: inventories, constraints, indexes, statistics and code objects.

Every function takes dictionary tables as they come from JDBC (or anywhere else) and returns one
shape for all engines. jdbc() reads them with statements that have no parameters; a password comes from
an environment variable and is in no plan.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters from which a dictionary's definition column may have cut a text.
CUT_AT = 12_500
#: Statements by name; none may hold a placeholder.
STATEMENTS = {
    "tables": "SELECT table_catalog, table_schema, table_name, table_type FROM information_schema.tables",
    "columns": "SELECT table_schema, table_name, column_name, ordinal_position, data_type, character_maximum_length, numeric_precision, numeric_scale, is_nullable FROM information_schema.columns",
    "constraints": "SELECT constraint_schema, constraint_name, table_schema, table_name, constraint_type FROM information_schema.table_constraints",
    "usage": "SELECT constraint_schema, constraint_name, column_name, ordinal_position FROM information_schema.key_column_usage",
    "references": "SELECT constraint_schema, constraint_name, unique_constraint_schema, unique_constraint_name FROM information_schema.referential_constraints",
    "views": "SELECT table_schema AS object_schema, table_name AS object_name, view_definition AS definition FROM information_schema.views",
}


def jdbc(spark: SparkSession, url: str, user: str, password_variable: str, driver: str | None = None, statements: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The dictionary's tables over JDBC, by name of the statement."""
    password = os.environ.get(password_variable, "")
    if not password:
        raise ValueError(f"{password_variable} holds no password")
    options = {"url": url, "user": user, "password": password} | ({"driver": driver} if driver else {})
    out = {}
    for name, sql in (statements or STATEMENTS).items():
        if "{" in sql or "?" in sql:
            raise ValueError(f"statement {name} takes parameters")
        out[name] = spark.read.format("jdbc").options(**options).option("query", sql).load()
    return out


def text(c: Column) -> Column:
    """Trimmed text; blank is null."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def flag(c: Column) -> Column:
    """true for y, yes, t, true and 1, false for their opposites, null for all else."""
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin("y", "yes", "t", "true", "1"), True).when(word.isin("n", "no", "f", "false", "0"), False)


def whole(c: Column) -> Column:
    """The integer in a value, null if there is none."""
    return F.expr("null").cast("bigint") if c is None else c.cast("string").try_cast("decimal(38,6)").try_cast("bigint")


def day(c: Column) -> Column:
    return F.to_date(F.try_to_timestamp(c.cast("string")))


def inventory(tables: DataFrame, columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(schema, table, kind) of tables and views, and columns without such a table (schema, table, column), which are warnings."""
    kind = F.when(F.upper(F.col("table_type")).contains("VIEW"), "view").otherwise("table")
    known = tables.select(text(F.col("table_schema")).alias("schema"), text(F.col("table_name")).alias("table"), kind.alias("kind"))
    held = columns.select(text(F.col("table_schema")).alias("schema"), text(F.col("table_name")).alias("table"), text(F.col("column_name")).alias("column"))
    return known, held.join(known, ["schema", "table"], "left_anti")


def visible(tables: DataFrame) -> int:
    """How many base tables a user can see."""
    return tables.where(~F.upper(F.col("table_type")).contains("VIEW")).count()


def folded(rows: DataFrame, keys: list[str], place: str, value: str) -> DataFrame:
    """Values of a group in order of their place, and whether a place comes twice."""
    return rows.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(place, value))), lambda x: x[value]).alias("values"), (F.count_distinct(place) < F.count(F.lit(1))).alias("ambiguous")
    )  # columns of one constraint or index


def constraints(heads: DataFrame, usage: DataFrame, references: DataFrame) -> DataFrame:
    """A row a constraint: schema, table, name, kind, columns and, for foreign keys, target and its columns paired by place (none if the numbers differ by more than a prefix)."""
    key = ["constraint_schema", "constraint_name"]
    own = heads.join(folded(usage, key, "ordinal_position", "column_name"), key)
    target = own.select(
        F.col("constraint_schema").alias("unique_constraint_schema"), F.col("constraint_name").alias("unique_constraint_name"),
        F.col("table_schema").alias("target_schema"), F.col("table_name").alias("target"), F.col("values").alias("target_columns"),
    )
    paired = own.join(references, key, "left").join(target, ["unique_constraint_schema", "unique_constraint_name"], "left")
    return paired.select(
        F.col("table_schema").alias("schema"), F.col("table_name").alias("table"), F.col("constraint_name").alias("name"), F.col("constraint_type").alias("kind"),
        F.col("values").alias("columns"), "target_schema", "target", F.slice("target_columns", 1, F.size("values")).alias("target_columns"), "ambiguous",
    )


def indexes(rows: DataFrame) -> DataFrame:
    """(schema, table, name, columns, included, primary) -> a row a column with its place; included ones have none and do not count as keys."""
    key = rows.select("schema", "table", "name", "primary", F.posexplode("columns").alias("place", "column")).withColumn("place", F.col("place") + 1)
    more = rows.select("schema", "table", "name", "primary", F.lit(None).cast("int").alias("place"), F.explode("included").alias("column"))
    return key.unionByName(more)


def members(found: DataFrame, indexed: DataFrame) -> DataFrame:
    """(schema, table, column) of all constraint columns and index keys, once each."""
    keys = found.select("schema", "table", F.explode("columns").alias("column"))
    return keys.unionByName(indexed.where("place is not null").select("schema", "table", "column")).distinct()


def estimated(rows: Column, n_distinct: Column) -> Column:
    """Distinct values by a planner's figure: a count if positive, a share of the rows if negative, unknown if 0."""
    return F.when(n_distinct > 0, n_distinct).when(n_distinct < 0, F.bround(-n_distinct * rows)).cast("long")


def statistics(tables: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """Statistics of all tables, also those without any: column null has the table's rows; approximate marks planner figures."""
    sized = tables.select("schema", "table").join(rows, ["schema", "table"], "left")
    own = sized.select("schema", "table", F.lit(None).cast("string").alias("column"), "n_rows", F.lit(None).cast("long").alias("n_distinct"), F.lit(None).cast("double").alias("null_fraction"), "stats_date")
    by_column = columns.join(sized.select("schema", "table", "n_rows", "stats_date"), ["schema", "table"]).select(
        "schema", "table", "column", "n_rows", estimated(F.col("n_rows"), F.col("n_distinct")).alias("n_distinct"), F.col("null_fraction").cast("double"), "stats_date"
    )
    both = own.unionByName(by_column)
    return both.withColumns({"approximate": F.col("column").isNotNull(), "source": F.when(F.col("n_rows").isNotNull(), "stats-estimate")})


def latest(collections: DataFrame) -> DataFrame:
    """(schema, table, n_rows, collected) -> the newest collection of each table."""
    return collections.groupBy("schema", "table").agg(F.max_by("n_rows", "collected").alias("n_rows"), F.max("collected").cast("date").alias("stats_date"))


def partitions(parts: DataFrame) -> DataFrame:
    """(schema, table, partition, n_rows) -> the rows of each table."""
    return parts.groupBy("schema", "table").agg(F.sum("n_rows").alias("n_rows"))


def code_objects(*sources: DataFrame) -> DataFrame:
    """(object_schema, object_name, definition) of views, routines and triggers -> schema, name, definition, truncated; parts of one object are joined by their `part` if there is one."""
    out = None
    for rows in sources:
        if "part" in rows.columns:
            rows = folded(rows, ["object_schema", "object_name"], "part", "definition").select("object_schema", "object_name", F.array_join("values", "").alias("definition"))
        rows = rows.select(F.col("object_schema").alias("schema"), F.col("object_name").alias("name"), "definition", F.coalesce(F.char_length("definition") >= CUT_AT, F.lit(False)).alias("truncated"))
        out = rows if out is None else out.unionByName(rows)
    return out


def external(synonyms: DataFrame, servers: DataFrame) -> DataFrame:
    """Names outside this database: synonyms (schema, name, target) whose target has three parts or more, and foreign servers (name)."""
    far = synonyms.where(F.size(F.split("target", r"\.")) >= 3).select(F.concat_ws(".", "schema", "name").alias("name"), "target", F.lit("synonym").alias("kind"))
    return far.unionByName(servers.select("name", F.col("name").alias("target"), F.lit("server").alias("kind")))


def lookup(names: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """wanted joined to the name it means: the exact one, else the only one that differs in case; null and `ambiguous` if there are several."""
    low = names.select(F.col(column).alias("found"), F.lower(column).alias("_low"))
    several = Window.partitionBy("_low")
    low = low.withColumn("n", F.count(F.lit(1)).over(several))  # spellings of one name
    exact = low.select(F.col("found").alias("exact"))
    rows = wanted.join(exact, wanted[column] == exact["exact"], "left").withColumn("_low", F.lower(column))
    rows = rows.join(low.groupBy("_low").agg(F.max("found").alias("other"), F.max("n").alias("n")), "_low", "left")
    return rows.select(column, F.coalesce("exact", F.when(F.col("n") == 1, F.col("other"))).alias("found"), (F.col("exact").isNull() & (F.coalesce("n", F.lit(0)) > 1)).alias("ambiguous"))
