"""Encoding stage (P7): one-hot columns (X14), goal and header (X15),
boolean flags (X16), vendor label (X17) - one projection each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.encode import flag, one_hot, vendor_label
from pitchlake.schemas import BOOL_TO_INT, DUMMIES


def dummy_columns(dummies: dict | None = None) -> dict[str, Column]:
    """One-hot columns of every mapped category, plus ``header``."""
    dummies = DUMMIES if dummies is None else dummies
    cols = {name: one_hot(source, value) for source, mapping in dummies.items() for value, name in mapping.items()}
    cols["header"] = one_hot("shot_body_part", "Head")
    return cols


def flag_columns(columns: list[str], penalty: Column | None = None) -> dict[str, Column]:
    """Nullable booleans as 0/1 (X16); ``goal`` comes from the outcome and a
    ``penalty`` (default: by ``shot_type``) counts as one-on-one."""
    cols = {}
    for c in columns:
        src = F.col("shot_outcome") == "Goal" if c == "goal" else F.col(c)
        cols[c] = flag(src)
    if "shot_one_on_one" in cols:
        penalty = F.col("shot_type") == "Penalty" if penalty is None else penalty
        cols["shot_one_on_one"] = F.when(penalty, 1).otherwise(cols["shot_one_on_one"])
    return cols


def create_dummies(df: DataFrame, dummies: dict | None = None, drop_source: bool = True) -> DataFrame:
    dummies = DUMMIES if dummies is None else dummies
    cols = {**dummy_columns(dummies), "goal": F.col("shot_outcome") == "Goal"}
    out = df.withColumns(cols)
    if drop_source:
        out = out.drop(*dummies.keys(), "shot_body_part")
    return out


def bool_to_int(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The flags of ``columns`` as 0/1; penalties are known by ``pk_type``
    where the one-hot columns are there already."""
    columns = BOOL_TO_INT if columns is None else columns
    return df.withColumns(flag_columns(columns, F.col("pk_type") == 1 if "pk_type" in df.columns else None))


def with_vendor_label(df: DataFrame, xg_col: str = "shot_statsbomb_xg", out: str = "sb_prediction") -> DataFrame:
    return df.withColumn(out, vendor_label(xg_col))
