"""Column expressions shared by the operators.  All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType

# Fixed values.
TIMESTAMP_PATTERN = "MM-dd-yyyy HH:mm:ss"
NULL_LIKE_TEXTS = ["", "null", "none", "nan", "na", "n/a"]
PSI_WARNING_FROM = 0.10
PSI_DRIFT_FROM = 0.25
LABEL_TEXTS = {1: "Churn", 0: "Kein Churn"}
# End of fixed values.

STRICT = "strict"
PERMISSIVE = "permissive"


def _check_mode(mode: str) -> None:
    if mode not in (STRICT, PERMISSIVE):
        raise ValueError(f"mode must be '{STRICT}' or '{PERMISSIVE}', got '{mode}'")


def parse_timestamp(column: str | Column, mode: str = STRICT) -> Column:
    """Text in the raw date pattern to a timestamp; bad text fails, or becomes null when permissive."""
    _check_mode(mode)
    parse = F.to_timestamp if mode == STRICT else F.try_to_timestamp
    pattern = TIMESTAMP_PATTERN if mode == STRICT else F.lit(TIMESTAMP_PATTERN)
    return parse(F.col(column) if isinstance(column, str) else column, pattern)


def as_int(column: str | Column, mode: str = STRICT) -> Column:
    """Cast to a 32-bit integer; a double is cut toward zero."""
    _check_mode(mode)
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("int") if mode == STRICT else value.try_cast("int")


def as_double(column: str | Column) -> Column:
    """Numeric reading of any column, null where it is not a number."""
    value = F.col(column) if isinstance(column, str) else column
    return value.try_cast("double")


def is_null_like_text(column: Column) -> Column:
    return F.lower(F.trim(column)).isin(NULL_LIKE_TEXTS)


def is_missing(column: Column, data_type: DataType) -> Column:
    """Null, NaN in a floating column, or a text that only stands for a missing value."""
    if isinstance(data_type, (FloatType, DoubleType)):
        return column.isNull() | F.isnan(column)
    if isinstance(data_type, StringType):
        return column.isNull() | is_null_like_text(column)
    return column.isNull()


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, 0.0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def label_text(column: Column) -> Column:
    return F.when(column == 1, LABEL_TEXTS[1]).when(column == 0, LABEL_TEXTS[0])


def psi_status(psi: Column) -> Column:
    return (
        F.when(psi.isNull() | F.isnan(psi), "not_evaluable")
        .when(psi < PSI_WARNING_FROM, "stable")
        .when(psi < PSI_DRIFT_FROM, "warning")
        .otherwise("drift")
    )
