"""Canonical type names of source spellings, and classes of Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

#: Source spellings and their canonical names.
CANONICAL = {
    name: group
    for group, names in {
        "INT": ["int", "int4", "integer"], "BIGINT": ["bigint", "int8"], "SMALLINT": ["smallint", "int2"], "TINYINT": ["tinyint"], "BYTEINT": ["byteint"],
        "DECIMAL": ["decimal"], "NUMERIC": ["numeric"], "MONEY": ["money"], "SMALLMONEY": ["smallmoney"], "NUMBER": ["number"],
        "REAL": ["real", "float4"], "FLOAT": ["float"], "DOUBLE PRECISION": ["float8", "double", "double precision"],
        "CHAR": ["char", "character", "bpchar"], "NCHAR": ["nchar"], "VARCHAR": ["varchar", "varchar2", "character varying"],
        "NVARCHAR": ["nvarchar", "national character varying"], "TEXT": ["text", "ntext"], "CLOB": ["clob"],
        "BINARY": ["binary"], "VARBINARY": ["varbinary", "bytea"], "BLOB": ["blob"], "BYTE": ["byte"], "VARBYTE": ["varbyte"],
        "DATE": ["date"], "TIME": ["time", "time without time zone"], "TIME WITH TIME ZONE": ["time with time zone"],
        "TIMESTAMP": ["timestamp", "timestamp without time zone", "datetime", "datetime2", "smalldatetime"],
        "TIMESTAMP WITH TIME ZONE": ["timestamp with time zone", "datetimeoffset"],
        "BOOLEAN": ["boolean", "bool"], "BIT": ["bit"], "UUID": ["uniqueidentifier", "uuid"], "XML": ["xml"], "JSON": ["json"], "JSONB": ["jsonb"],
    }.items()
    for name in names
}
#: Type codes of Teradata's dictionary.
TERADATA = {
    "I": "INT", "I8": "BIGINT", "I2": "SMALLINT", "I1": "BYTEINT", "D": "DECIMAL", "F": "FLOAT", "N": "NUMBER", "CF": "CHAR", "CV": "VARCHAR", "CO": "CLOB",
    "BF": "BYTE", "BV": "VARBYTE", "BO": "BLOB", "DA": "DATE", "AT": "TIME", "TS": "TIMESTAMP", "TZ": "TIME WITH TIME ZONE", "SZ": "TIMESTAMP WITH TIME ZONE",
}
SIZED = {"CHAR", "NCHAR", "VARCHAR", "NVARCHAR", "BINARY", "VARBINARY", "BYTE", "VARBYTE"}
SCALED = {"DECIMAL", "NUMERIC", "NUMBER"}


def canonical(spelling: str | None, length: int | None = None, precision: int | None = None, scale: int | None = None) -> str:
    if spelling is None:
        return "UNKNOWN"
    word = spelling.strip()
    name = CANONICAL.get(word.lower(), word.upper())
    if name in SIZED and length is not None:
        return f"{name}({'MAX' if length == -1 else length})"
    if name in SCALED and precision is not None:
        return f"{name}({precision})" if scale is None else f"{name}({precision},{scale})"
    return name


def of_teradata(code: str | None, length: int | None = None, precision: int | None = None, scale: int | None = None) -> str:
    """Canonical name of a dictionary code; unknown ones are shown."""
    if code is None:
        return "UNKNOWN"
    known = TERADATA.get(code.strip().upper())
    return f"UNKNOWN({code.strip()})" if known is None else canonical(known, length, precision, scale)


def of_spark(kind: T.DataType) -> str:
    """Canonical name of a Spark type; nested types have none and are told by UNSUPPORTED."""
    if isinstance(kind, T.DecimalType):
        return canonical("decimal", precision=kind.precision, scale=kind.scale)
    if isinstance(kind, (T.VarcharType, T.CharType)):
        return canonical(kind.typeName(), length=kind.length)
    names = {
        T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INT", T.LongType: "BIGINT", T.FloatType: "REAL", T.DoubleType: "DOUBLE PRECISION",
        T.StringType: "TEXT", T.BinaryType: "VARBINARY", T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
        T.TimestampType: "TIMESTAMP WITH TIME ZONE",
    }
    return names.get(type(kind), "UNSUPPORTED")


def base(name: str) -> str:
    return name.partition("(")[0]


def is_integer(name: str) -> bool:
    """Integers, and decimals whose scale is 0 or not known."""
    if base(name) in {"INT", "BIGINT", "SMALLINT", "TINYINT", "BYTEINT"}:
        return True
    return base(name) in SCALED and ("," not in name or name.endswith(",0)"))


def is_character(name: str) -> bool:
    return base(name) in {"CHAR", "NCHAR", "VARCHAR", "NVARCHAR", "TEXT", "CLOB"}


def is_temporal(name: str) -> bool:
    return base(name).startswith(("DATE", "TIME"))


def is_numeric(name: str) -> bool:
    return is_integer(name) or base(name) in SCALED | {"REAL", "FLOAT", "DOUBLE PRECISION"}


def type_class(kind: T.DataType) -> str:
    """number, text, time, flag or other."""
    name = of_spark(kind)
    return "number" if is_numeric(name) else "text" if is_character(name) else "time" if is_temporal(name) else "flag" if name == "BOOLEAN" else "other"
