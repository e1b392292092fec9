"""From accepted edges to sequenced, key-bound queries over several sources."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import exprs, types

GRADES = {"confirmed": 0, "high": 1, "medium": 2}


def resolve(fields: DataFrame, columns: DataFrame) -> DataFrame:
    """Rank columns (table, column, type_class, description) for each wanted field (field, type_class); the type is a hard filter."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda w: w != ""))
    wanted = fields.select("field", F.col("type_class").alias("wanted_class"), words(F.col("field")).alias("words"))
    held = columns.withColumn("own", words(F.concat_ws(" ", "column", "description"))).withColumn("table_words", words(F.col("table")))
    met = wanted.join(held, F.col("wanted_class") == F.col("type_class"))
    by_word = F.size(F.array_intersect("words", "own")) / F.size(F.array_union("words", "own"))
    by_table = F.when(F.size(F.array_intersect("words", "table_words")) > 0, 0.1).otherwise(0.0)
    spelled = 1 - F.levenshtein(F.lower("field"), F.lower("column")) / F.greatest(F.length("field"), F.length("column"))
    # Column names abbreviate: a word counts if its first three letters are in the name.
    short = F.size(F.filter("words", lambda w: F.contains(F.lower(F.col("column")), F.substring(w, 1, 3)))) / F.size("words")
    scored = met.withColumn("score", by_word + by_table + spelled + short)
    return scored.select("field", "table", "column", "score")


def best(ranked: DataFrame) -> DataFrame:
    """The foremost column of each field; ties by name, the last one first."""
    found = ranked.groupBy("field").agg(F.max(F.struct("score", "table", "column")).alias("best"))
    return found.select("field", "best.table", "best.column", "best.score")


def ranked(scored: DataFrame, n: int = 5) -> DataFrame:
    """The n foremost columns of each field with their rank."""
    place = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("score"), F.desc("table"), F.desc("column")))
    return scored.withColumn("rank", place).where(F.col("rank") <= n)


def shape(result: DataFrame, expected: list[tuple[str, str]]) -> list[str]:
    """What is wrong with a result's columns (name, type class of types.type_class), without running it."""
    have = {f.name: types.type_class(f.dataType) for f in result.schema.fields}
    found = [f"missing: {c}" for c, _ in expected if c not in have]
    found += [f"type: {c} is {have[c]}, not {k}" for c, k in expected if c in have and have[c] != k]
    return found + [f"unexpected: {c}" for c in have if c not in {c for c, _ in expected}]


def grade_a(fields: dict[str, tuple[str, str]], steps: list[str], bindings: list[tuple[str, str, str]]) -> str:
    """A resolved plan as a YAML document: fields, sequence of tables, and the key that each step binds (table, column, rule)."""
    lines = ["grade: A", "fields:"] + [f"  {f}: {t}.{c}" for f, (t, c) in sorted(fields.items())]
    lines += ["sequence:"] + [f"  - {t}" for t in steps] + ["bindings:"] + [f"  - table: {t}\n    column: {c}\n    normalization: [{r}]" for t, c, r in bindings]
    return "\n".join(lines) + "\n"


def grade_b(found: DataFrame) -> str:
    """Ranked candidates of fields that were not resolved, as a YAML document; a bounded list for people to read."""
    lines, last = ["grade: B", "candidates:"], None
    for r in found.orderBy("field", "rank").limit(10_000).collect():
        lines += [f"  {r['field']}:"] if r["field"] != last else []
        last = r["field"]
        lines.append(f"    - column: {r['table']}.{r['column']}\n      score: {r['score']:.3f}")
    return "\n".join(lines) + "\n"


def path(edges: list[tuple[str, str, str]], start: str, goal: str) -> list[tuple[str, str, str]] | None:
    """Fewest edges (left, right, grade) from start to goal, better grades first; weak edges do not count."""
    near: dict[str, list] = {}
    for a, b, grade in sorted((e for e in edges if e[2] in GRADES), key=lambda e: (GRADES[e[2]], e)):
        near.setdefault(a, []).append((b, (a, b, grade)))
        near.setdefault(b, []).append((a, (a, b, grade)))
    seen, queue = {start}, deque([(start, [])])
    while queue:
        at, way = queue.popleft()
        if at == goal:
            return way
        for to, edge in near.get(at, []):
            if to not in seen:
                seen.add(to)
                queue.append((to, [*way, edge]))
    return None


def order(rows: dict[str, int], way: list[tuple[str, str, str]], warn_above: int = 1_000_000) -> tuple[list[str], list[str]]:
    """Tables of a path from its smaller end, and those whose projected key list is large."""
    if not way:
        return [], []
    ends = [t for t in way[0][:2] if len(way) == 1 or t not in way[1][:2]]
    at = ends[0] if ends else way[0][0]
    tables = [at]
    for a, b, _ in way:
        at = b if at == a else a
        tables.append(at)
    if tables and rows.get(tables[-1], 0) < rows.get(tables[0], 0):
        tables.reverse()
    return tables, [t for t in tables[:-1] if rows.get(t, 0) > warn_above]


def bound(right: DataFrame, right_key: str, left: DataFrame, left_key: str, zeros: bool = False) -> DataFrame:
    """Rows of right whose normalised key occurs in left: key transfer as a semi-join, not as a list of literals."""
    rule = (lambda c: exprs.strip_zeros(exprs.normalize(c.cast("string")))) if zeros else (lambda c: exprs.normalize(c.cast("string")))
    keys = left.select(rule(F.col(left_key)).alias("_key")).distinct()
    return right.join(keys, rule(F.col(right_key)) == F.col("_key"), "left_semi")
