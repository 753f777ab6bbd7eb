"""Column names, types and null sentinels."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DataType, DecimalType, DoubleType, FloatType, NumericType, StringType

BOOL, NUM, CAT = "bool", "num", "cat"

# Text that means "missing", and text that means true or false.
NULL_SENTINELS = (
    "", " ", "nan", "NaN", "NAN", '"nan"', '"NaN"', '"Nan"', "none", "None", '"None"',
    "inf", "Inf", "INF", "Infinity", '"inf"', '"Inf"', '"Infinity"',
)
TRUE_TEXT = ("true", "True", "TRUE")
FALSE_TEXT = ("false", "False", "FALSE")


def standard_name(name: str) -> str:
    out = re.sub("_+", "_", re.sub("[^0-9A-Za-z_]+", "_", name.strip().lower())).strip("_")
    if not out:
        raise ValueError(f"column name {name!r} has no usable characters")
    return out


def standardise(df: DataFrame, split_column: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Clean column names, suffixing collisions ``_2, _3, ...``; returns new -> original names.

    A source column that would shadow the split column is an error.
    """
    names: list[str] = []
    for column in df.columns:
        base = standard_name(column)
        name, n = base, 2
        while name in names:
            name, n = f"{base}_{n}", n + 1
        names.append(name)
    if split_column and split_column.lower() in names:
        raise ValueError(f"a source column would shadow {split_column}")
    return df.toDF(*names), dict(zip(names, df.columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN becomes null; Spark would otherwise order and compare it as a number."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def decimals_to_doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema
                           if isinstance(f.dataType, DecimalType)}) if any(
        isinstance(f.dataType, DecimalType) for f in df.schema) else df


def logical_type(data_type: DataType) -> str:
    if isinstance(data_type, BooleanType):
        return BOOL
    return NUM if isinstance(data_type, NumericType) else CAT


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns in sorted order; a missing one is an error."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise KeyError(f"columns {missing} are not in the frame")
    return df.select(*sorted(columns))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by logical type: unreadable numbers become null, sentinels become null.

    bool gives 1.0 / 0.0, num gives double, cat gives string.
    """
    out = {}
    for f in df.schema:
        c = F.col(f.name)
        text = isinstance(f.dataType, StringType)
        if text:
            c = F.when(~c.isin(*NULL_SENTINELS), c)
        want = types.get(f.name)
        number = c.try_cast("double") if text else c.cast("double") if want in (NUM, BOOL) and logical_type(
            f.dataType) != CAT else F.lit(None).cast("double")
        if want == BOOL:
            out[f.name] = F.when(c.isin(*TRUE_TEXT), 1.0).when(c.isin(*FALSE_TEXT), 0.0).otherwise(
                number) if text else number
        elif want == NUM:
            out[f.name] = number
        elif want == CAT:
            out[f.name] = c.cast("string")
        elif text:
            out[f.name] = c
    return df.withColumns(out) if out else df
