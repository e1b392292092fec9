"""A crawl from the command line: profile Parquet tables, mine their views, write a bundle and check it.

python -m quarry.crawl FOLDER ROOT --database NAME [--tables a,b] [--sensitive t.c,...] [--expected N]
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from quarry.operators import gates, measure
from quarry.plans import bundle, validate
from quarry.sources.tables import Source, reconcile


@dataclass
class Outcome:
    profiles: DataFrame | None
    files: DataFrame | None
    completeness: str
    failures: list[tuple[str, str]] = field(default_factory=list)


#: Steps that a crawl cannot do without; others are skipped with a note if they fail.
REQUIRED = ("tables", "columns")


def crawl(source: Source, database: str, options: measure.Options | None = None, expected: int | None = None, date: str | None = None) -> Outcome:
    """Inventory first, then every table is measured; a table that fails is noted and left out, and the crawl is then incomplete."""
    options, date = options or measure.Options(), date or dt.date.today().isoformat()
    names, found, failures = sorted(source.tables), None, []
    if not names:
        raise ValueError("no tables in scope")
    for name in names:
        keys = [c for t, c in source.key_columns() if t == name]
        own = measure.Options(keys, options.sensitive, options.junk, options.trust_estimates, options.today, options.budget, options.sample)
        try:
            rows = measure.measured(source.tables[name], name, own)
        except Exception as e:  # the reason is a class name: texts of errors may quote values
            failures.append((name, type(e).__name__))
            continue
        found = rows if found is None else found.unionByName(rows)
    state = reconcile(len(names), len(names) - len(failures), 0, expected, len(failures))
    if found is None:
        return Outcome(None, None, state, failures)
    said = bundle.annotated(found)
    summary = f"Database {database}. It has {len(names)} tables. Descriptions are not written yet."
    files = bundle.table_files(said, database, date).unionByName(bundle.index_file(said, database, date, summary, state))
    return Outcome(found, files, state, failures)


def main(args: list[str]) -> int:
    p = argparse.ArgumentParser(prog="quarry.crawl")
    p.add_argument("folder")
    p.add_argument("root")
    p.add_argument("--database", required=True)
    p.add_argument("--tables", default="")
    p.add_argument("--sensitive", default="")
    p.add_argument("--expected", type=int)
    p.add_argument("--max-tables", type=int)
    found = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    names = [t for t in found.tables.split(",") if t]
    if not names:
        p.error("--tables names no table")
    options = measure.Options(sensitive=[c for c in found.sensitive.split(",") if c], budget=gates.Budget(tables=found.max_tables))
    out = crawl(Source.parquet(spark, found.folder, names), found.database, options, found.expected)
    if out.files is None:
        return 1
    gone = bundle.write(out.files, found.root)
    issues = validate.validate(validate.read(spark, found.root)).collect()
    for r in issues:
        print(r["severity"], r["code"], r["path"], r["message"])
    print(f"{out.completeness}: {len(names) - len(out.failures)} tables, {len(gone)} files deleted")
    return int(any(r["severity"] == "error" for r in issues) or bool(out.failures))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
