"""Column-level operators.

All of these are single projections or filters of built-in expressions, so
they stay inside whole-stage codegen and push nothing through Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The column-name clean-up applied after one-hot encoding,
# as literal (not regex) replacements, in this order.
NAME_REPLACEMENTS = ((" ", ""), ("(", "-"), (")", ""))

# The label mapping used for the attrition label.
YES_NO = {"Yes": 1, "No": 0}


def _cols(cols: str | Iterable[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def to_double(df: DataFrame, cols: str | Iterable[str]) -> DataFrame:
    """Text -> double; text that is not a number becomes null.

    Uses ``try_cast`` because a plain cast raises under ANSI mode.
    """
    wanted = set(_cols(cols))
    return df.select(
        *[F.col(f"`{c}`").try_cast("double").alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns]
    )


def map_label(
    df: DataFrame,
    col: str,
    mapping: Mapping[str, int] = YES_NO,
    out: str | None = None,
    dtype: str = "int",
) -> DataFrame:
    """Map label text to integers; unmapped values become null; optional rename."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(F.col(col) == F.lit(k), F.lit(v)))
    expr = (expr if expr is not None else F.lit(None)).cast(dtype)
    out = out or col
    return df.select(*[expr.alias(out) if c == col else F.col(f"`{c}`") for c in df.columns])


def clean_name(name: str) -> str:
    for old, new in NAME_REPLACEMENTS:
        name = name.replace(old, new)
    return name


def clean_names(df: DataFrame) -> DataFrame:
    """Rename every column with the literal clean-up rules.

    Raises if two cleaned names collide (Spark resolves names
    case-insensitively by default, so that check is case-insensitive too).
    """
    new = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        key = n.lower()
        if key in seen:
            raise ValueError(f"column names collide after clean-up: {seen[key]!r} and {old!r} -> {n!r}")
        seen[key] = old
    return df.toDF(*new)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or any of ``subset``) column."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def fill_constant(df: DataFrame, cols: str | Iterable[str], value: str = "") -> DataFrame:
    """Replace nulls in string columns with a constant."""
    return df.fillna(value, subset=_cols(cols))


def correct_flag(label: str | Column, prediction: str | Column) -> Column:
    """1 where label equals prediction, else 0 (a null on either side is 0)."""
    lab = F.col(label) if isinstance(label, str) else label
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.when(lab == pred, F.lit(1)).otherwise(F.lit(0))


def flag_correct(df: DataFrame, label: str, prediction: str, out: str = "accurate") -> DataFrame:
    return df.withColumn(out, correct_flag(label, prediction))


def description_ok(text: str | Column, min_chars: int = 20) -> Column:
    """1 if the text is longer than ``min_chars`` characters, else 0 (null -> 0)."""
    t = F.col(text) if isinstance(text, str) else text
    return (F.coalesce(F.length(t), F.lit(0)) > F.lit(min_chars)).cast("int")


def check_description(df: DataFrame, col: str, out: str = "has_description", min_chars: int = 20) -> DataFrame:
    return df.withColumn(out, description_ok(col, min_chars))


def hash_bucket(seed: int | str, *keys: str | Column) -> Column:
    """Deterministic 32-bit bucket: first 8 hex digits of md5('seed:key...').

    Independent of partitioning and reproducible outside Spark
    (e.g. ``('0x'||substr(md5(seed||':'||key),1,8))::BIGINT`` in DuckDB).
    A null key part is written as '' so (NULL, 5) and (5, NULL) differ
    (``concat_ws`` alone would skip nulls).
    """
    parts = [F.lit(str(seed))] + [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit(""))
                                  for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")
