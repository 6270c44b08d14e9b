"""The exit gate: names, order and types are fixed, keys are unique, values agree."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.operators.compare import difference_counts, key_difference, value_difference
from sievework.operators.joins import duplicate_keys

EXAMPLES = 3


class ContractError(ValueError):
    """The table is not what was agreed."""


def name_problems(actual: T.StructType, agreed: T.StructType) -> list[str]:
    """Missing, unexpected and misplaced columns, in words."""
    got, want = actual.fieldNames(), agreed.fieldNames()
    out = [f"missing column {c}" for c in want if c not in got]
    out += [f"unexpected column {c}" for c in got if c not in want]
    if not out and got != want:
        out.append(f"column order {got}, agreed {want}")
    return out


def type_problems(actual: T.StructType, agreed: T.StructType, any_width: bool = False) -> list[str]:
    """Columns of another type; with ``any_width``, whole numbers of any size count as one type."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

    def differs(a: T.DataType, b: T.DataType) -> bool:
        return a != b and not (any_width and isinstance(a, whole) and isinstance(b, whole))

    return [f"{f.name}: {actual[f.name].dataType.simpleString()}, agreed {f.dataType.simpleString()}"
            for f in agreed.fields if f.name in actual.names and differs(actual[f.name].dataType, f.dataType)]


def enforce_contract(df: DataFrame, agreed: T.StructType) -> DataFrame:
    """``df`` with exactly the agreed schema, or an error.

    Names and their order must match.  Whole numbers may change width (a value that
    does not fit stops the job); no other type is converted.  Columns agreed to be
    NOT NULL are tested while the data flows, without a pass of their own.
    """
    problems = name_problems(df.schema, agreed) + type_problems(df.schema, agreed, any_width=True)
    if problems:
        raise ContractError("; ".join(problems))

    def gate(f: T.StructField):
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"contract: {f.name} is missing")).cast(f.dataType)).otherwise(c)
        return c.alias(f.name)

    return df.select(*[gate(f) for f in agreed.fields])


@dataclass(frozen=True)
class Finding:
    check: str
    ok: bool
    detail: str = ""
    examples: tuple = field(default=())


def check_contract(actual: DataFrame, expected: DataFrame, key: Sequence[str], *, tolerance: float = 0.0,
                   fail_fast: bool = True) -> list[Finding]:
    """Columns, types, key uniqueness, row set, values: stops at the first failure unless told not to.

    Counting happens on the cluster; at most three examples per failure come back.
    """
    findings: list[Finding] = []

    def add(check: str, ok: bool, detail: str = "", examples=()) -> bool:
        findings.append(Finding(check, ok, "" if ok else detail, () if ok else tuple(examples)))
        return ok or not fail_fast

    names, types = name_problems(actual.schema, expected.schema), type_problems(actual.schema, expected.schema)
    if not add("columns", not names, "; ".join(names)) or not add("types", not types, "; ".join(types)):
        return findings
    if any(k not in actual.columns for k in key):
        return findings
    repeated = [tuple(r)[:-1] for r in duplicate_keys(actual, key).limit(EXAMPLES).collect()]
    if not add("unique key", not repeated, "repeated keys", repeated):
        return findings
    typed = {f.name: f.dataType for f in expected.schema.fields}
    shared = [c for c in expected.columns
              if c not in key and c in actual.columns and actual.schema[c].dataType == typed[c]]
    counts = difference_counts(actual, expected, key, shared, tolerance).first()
    row_set_ok = counts.extra == 0 and counts.missing == 0
    examples = () if row_set_ok else [
        tuple(r) for r in key_difference(actual, expected, key).orderBy("side", *key).limit(EXAMPLES).collect()]
    if not add("row set", row_set_ok, f"{counts.extra} extra, {counts.missing} missing", examples):
        return findings
    wrong = [c for c in shared if counts[f"differs_{c}"]]
    for c in shared:
        cells = () if c not in wrong else [
            tuple(r) for r in value_difference(actual, expected, key, [c], tolerance).orderBy(*key)
            .limit(EXAMPLES).collect()]
        add(f"values of {c}", c not in wrong, f"{counts[f'differs_{c}']} rows differ", cells)
    return findings


def file_is_sorted(df_from_file: DataFrame, key: Sequence[str]) -> bool:
    """Is a single exported Parquet file in ascending key order?  (For one file, i.e. an export.)"""
    rows = df_from_file.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"),
                               F.struct(*key).alias("k"))
    following = rows.select("f", (F.col("i") - 1).alias("i"), F.col("k").alias("next"))
    return rows.join(following, ["f", "i"]).filter(F.col("next") < F.col("k")).isEmpty()


def require(findings: Sequence[Finding]) -> None:
    """Raise when any finding failed."""
    bad = [f"{f.check}: {f.detail} {list(f.examples) or ''}".rstrip() for f in findings if not f.ok]
    if bad:
        raise ContractError("; ".join(bad))


