"""Rules a table has to meet before it is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.columns import DIRECT_IDENTIFIER_COLUMNS, ID_COLUMN, NON_NEGATIVE_FEATURES, TARGET_COLUMN


def direct_identifiers(df: DataFrame) -> list[str]:
    """Names of personal columns the table must not have."""
    present = {name.lower() for name in df.columns}
    return [name for name in DIRECT_IDENTIFIER_COLUMNS if name in present]


def training_data_rules(
    df: DataFrame, id_column: str = ID_COLUMN, target_column: str = TARGET_COLUMN
) -> DataFrame:
    """``rule, violations`` in one aggregate, in the order the rules are enforced.

    Labels are counted, not collected, so a column that is no label at all stays harmless.
    """
    label = F.col(target_column)
    ids = F.count(id_column)
    rules: dict[str, Column] = {
        "table_not_empty": (F.count(F.lit(1)) == 0).cast("long"),
        "id_not_null": F.count(F.lit(1)) - ids,
        "id_unique": ids - F.count_distinct(id_column),
        "label_present": (F.count(label) == 0).cast("long"),
        "label_binary": F.count_if(label.isNotNull() & ~label.isin(0, 1)),
        "label_not_null": F.count_if(label.isNull()),
        "no_direct_identifier": F.lit(len(direct_identifiers(df))).cast("long"),
    }
    names = list(rules)
    checked = df.agg(*[expression.alias(name) for name, expression in rules.items()])
    return checked.unpivot([], names, "rule", "violations")


def validate_training_data(
    df: DataFrame,
    id_column: str = ID_COLUMN,
    target_column: str = TARGET_COLUMN,
    require_labels: bool = False,
) -> None:
    """Raise on the first broken rule.  ``require_labels`` also refuses null labels, as training does."""
    absent = sorted({id_column, target_column} - set(df.columns))
    if absent:
        raise ValueError(f"the table lacks the columns {absent}")
    found = {row["rule"]: row["violations"] for row in training_data_rules(df, id_column, target_column).collect()}
    if found["table_not_empty"]:
        raise ValueError("there is no row to train on")
    if found["id_not_null"] or found["id_unique"]:
        raise ValueError(
            f"{id_column} is not unique: {found['id_not_null']} rows without a value, {found['id_unique']} that repeat one"
        )
    if found["label_present"] or found["label_binary"]:
        raise ValueError(
            f"{target_column} is not binary: {found['label_binary']} rows hold something other than 0 and 1"
            + (", no row holds a label" if found["label_present"] else "")
        )
    if require_labels and found["label_not_null"]:
        raise ValueError(f"{found['label_not_null']} rows have no {target_column}")


def with_rejection_reasons(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add ``reasons``: the measures that are negative.  Null measures are allowed."""
    names = NON_NEGATIVE_FEATURES if columns is None else columns
    reasons = [F.when(F.col(name) < 0, F.lit(f"{name} < 0")) for name in names]
    return df.withColumn("reasons", F.array_compact(F.array(*reasons)))


def split_scoring_rows(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that may be scored, and refused rows with their reasons."""
    checked = with_rejection_reasons(df, columns)
    accepted = checked.where(F.size("reasons") == 0).drop("reasons")
    return accepted, checked.where(F.size("reasons") > 0)
