"""Schema contracts: drift, compatibility, rows that do not fit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Casts that lose nothing.
WIDER = {
    "tinyint": {"smallint", "int", "bigint", "float", "double"},
    "smallint": {"int", "bigint", "float", "double"},
    "int": {"bigint", "double"},
    "bigint": set(),
    "float": {"double"},
    "date": {"timestamp_ntz", "timestamp"},
}


def schema_drift(expected: T.StructType, actual: T.StructType) -> list[tuple[str, str]]:
    """(column, issue) for missing, unexpected and differently typed columns."""
    have = {f.name: f.dataType for f in actual}
    want = {f.name: f.dataType for f in expected}
    issues = []
    for name, kind in want.items():
        if name not in have:
            issues.append((name, "missing"))
        elif have[name] != kind:
            issues.append((name, f"type {have[name].simpleString()}, expected {kind.simpleString()}"))
    return issues + [(name, "unexpected") for name in have if name not in want]


def drift_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The drift of a frame against its contract, with the rows whose value does not fit the wanted type."""
    issues = schema_drift(expected, df.schema)
    want = {f.name: f.dataType.simpleString() for f in expected}
    lines = []
    for name, issue in issues:
        bad = F.lit(0).cast("bigint")
        if issue.startswith("type"):
            bad = F.count_if(F.col(name).isNotNull() & F.expr(f"try_cast(`{name}` AS {want[name]})").isNull())
        elif issue == "missing":
            bad = F.count(F.lit(1))
        lines.append(F.struct(F.lit(name).alias("column_name"), F.lit(issue).alias("issue"), bad.alias("bad_rows")))
    if not lines:
        return df.sparkSession.createDataFrame([], "column_name string, issue string, bad_rows bigint")
    return df.agg(F.array(*lines).alias("a")).select(F.inline("a"))


def _readable(writer: T.StructType, reader: T.StructType) -> list[str]:
    """Why data of `writer` cannot be read with `reader`."""
    wrote = {f.name: f for f in writer}
    problems = []
    for f in reader:
        if f.name not in wrote:
            if not f.nullable:
                problems.append(f"{f.name}: required but not written")
            continue
        a, b = wrote[f.name].dataType.simpleString(), f.dataType.simpleString()
        if a != b and b not in WIDER.get(a, set()):
            problems.append(f"{f.name}: {a} does not fit {b}")
        if wrote[f.name].nullable and not f.nullable:
            problems.append(f"{f.name}: may be null but must not be")
    return problems


def schema_compat(old: T.StructType, new: T.StructType, mode: str = "FULL") -> list[str]:
    """Problems of a schema change: BACKWARD (new reads old), FORWARD (old reads new) or FULL (both)."""
    if mode not in ("BACKWARD", "FORWARD", "FULL"):
        raise ValueError(f"unknown mode {mode}")
    problems = []
    if mode != "FORWARD":
        problems += _readable(old, new)
    if mode != "BACKWARD":
        problems += _readable(new, old)
    return problems
