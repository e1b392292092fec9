"""Tables to profile: Parquet folders, catalog tables or JDBC, with inventories as DataFrames."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import types

NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$#]{0,127}")
SYSTEM_SCHEMAS = ("information_schema", "pg_catalog", "sys", "dbc")


@dataclass(frozen=True)
class Constraint:
    table: str
    kind: str  # PRIMARY KEY, FOREIGN KEY, UNIQUE
    columns: tuple[str, ...]
    target: str | None = None
    target_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Index:
    table: str
    columns: tuple[str, ...]
    included: tuple[str, ...] = ()
    primary: bool = False


@dataclass
class Source:
    """A named set of tables; names not in it cannot be used, so nothing is injected."""

    spark: SparkSession
    tables: dict[str, DataFrame]
    constraints: list[Constraint] = field(default_factory=list)
    indexes: list[Index] = field(default_factory=list)

    @classmethod
    def parquet(cls, spark: SparkSession, folder: str, names: list[str], **facts) -> Source:
        return cls(spark, {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}, **facts)

    @classmethod
    def catalog(cls, spark: SparkSession, database: str, include: list[str] = (), exclude: list[str] = (), **facts) -> Source:
        if not in_scope(database, include, exclude):
            return cls(spark, {}, **facts)
        return cls(spark, {t.name: spark.table(f"`{database}`.`{t.name}`") for t in spark.catalog.listTables(database)}, **facts)

    @classmethod
    def jdbc(cls, spark: SparkSession, options: dict[str, str], names: list[str], partitions: dict[str, dict] | None = None, **facts) -> Source:
        """Tables over JDBC; partitions gives partitionColumn, lowerBound, upperBound and numPartitions by table."""
        read = lambda n: spark.read.format("jdbc").options(**options, **(partitions or {}).get(n, {})).option("dbtable", n).load()
        return cls(spark, {n: read(n) for n in names}, **facts)

    def column(self, table: str, name: str):
        if name not in self.tables[table].columns:
            raise KeyError(f"{table} has no such column")
        return F.col(f"`{name}`")

    def inventory(self) -> DataFrame:
        """A row a column: place, canonical type, nullability, and whether it can be profiled."""
        rows = [
            (t, k + 1, f.name, types.of_spark(f.dataType), f.nullable, bool(NAME.fullmatch(f.name)), types.of_spark(f.dataType) != "UNSUPPORTED")
            for t, df in sorted(self.tables.items())
            for k, f in enumerate(df.schema.fields)
        ]
        return self.spark.createDataFrame(rows, "table string, ordinal int, column string, type string, nullable boolean, plain_name boolean, profiled boolean")

    def key_columns(self) -> set[tuple[str, str]]:
        """Columns of constraints and index keys; included columns do not count."""
        return {(x.table, c) for x in [*self.constraints, *self.indexes] for c in x.columns}

    def constraint_columns(self) -> DataFrame:
        """A row a constraint column, foreign keys with their target by place; unresolved targets stay empty."""
        keys = {x.table: x.columns for x in self.constraints if x.kind == "PRIMARY KEY"}
        rows = []
        for x in self.constraints:
            there = x.target_columns or keys.get(x.target or "", ())
            for k, c in enumerate(x.columns):
                rows.append((x.table, x.kind, k + 1, c, x.target, there[k] if k < len(there) else None))
        return self.spark.createDataFrame(rows, "table string, kind string, place int, column string, target string, target_column string")


def in_scope(schema: str, include: list[str] = (), exclude: list[str] = ()) -> bool:
    """System schemas never, excluded ones not, and only included ones if any are; case does not matter."""
    name, low = schema.lower(), lambda names: {n.lower() for n in names}
    return name not in SYSTEM_SCHEMAS and name not in low(exclude) and (not include or name in low(include))


def reconcile(visible: int, cataloged: int, system: int, expected: int | None = None, failures: int = 0) -> str:
    """COMPLETE, INCOMPLETE or UNVERIFIED from the counts of a run."""
    if expected is not None:
        state = "COMPLETE" if cataloged == expected else "INCOMPLETE"
    else:
        state = "COMPLETE" if visible == cataloged + system else "UNVERIFIED"
    return "INCOMPLETE" if failures and state == "COMPLETE" else state


def distinct_estimate(n_distinct, rows):
    """Catalog statistics: positive is a count, negative a share of the rows, zero is unknown."""
    return F.when(n_distinct > 0, n_distinct).when(n_distinct < 0, -n_distinct * rows)
