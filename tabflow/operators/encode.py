"""One-hot encoding with a fitted, reusable category list.

``fit`` runs one small job: the distinct (column, value) pairs, which Spark
computes with a map-side partial aggregate, so each task ships at most the
number of distinct values it saw. Only a bounded number of pairs reaches the
driver; a column with more than ``max_values`` distinct values raises instead
of collecting an unbounded list.

``transform`` is one wide projection of ``CASE WHEN`` expressions, so the
encoding is a narrow (no-shuffle) operator and a scoring batch that lacks a
category still gets every fitted column.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.columns import clean_names
from tabflow.operators.cumulative import row_numbers


@dataclass
class OneHotModel:
    columns: list[str]
    categories: dict[str, list[str]] = field(default_factory=dict)
    dtype: str = "bigint"

    def output_names(self) -> list[str]:
        return [f"{c}_{v}" for c in self.columns for v in self.categories[c]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Untouched columns first (source order), then per encoded column its
        sorted values as ``{col}_{value}``; the source column is dropped.
        Null or unseen values encode as all zeros."""
        keep = [F.col(f"`{c}`") for c in df.columns if c not in self.columns]
        enc = []
        for c in self.columns:
            src = F.col(f"`{c}`").cast("string")
            for v in self.categories[c]:
                enc.append(F.when(src == F.lit(v), F.lit(1)).otherwise(F.lit(0)).cast(self.dtype).alias(f"{c}_{v}"))
        return df.select(*keep, *enc)


class OneHot:
    def __init__(self, columns: Sequence[str], max_values: int = 1000, dtype: str = "bigint"):
        self.columns = list(columns)
        self.max_values = max_values
        self.dtype = dtype

    def fit(self, df: DataFrame) -> OneHotModel:
        pairs = (
            df.select(
                F.explode(
                    F.array(*[
                        F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v"))
                        for c in self.columns
                    ])
                ).alias("p")
            )
            .select("p.c", "p.v")
            .where(F.col("v").isNotNull())
            .distinct()
        )
        cap = self.max_values * len(self.columns)
        rows = pairs.limit(cap + 1).collect()
        if len(rows) > cap:
            raise ValueError(f"columns {self.columns} have more than {cap} distinct values together; "
                             "encode them with category_table, or hash them (hash_text)")
        cats: dict[str, list[str]] = {c: [] for c in self.columns}
        for r in rows:
            cats[r["c"]].append(r["v"])
        for c, vals in cats.items():
            if len(vals) > self.max_values:
                raise ValueError(f"column {c!r} has more than {self.max_values} distinct values; "
                                 "encode it with category_table, or hash it (hash_text)")
            vals.sort()
        return OneHotModel(self.columns, cats, self.dtype)

    @staticmethod
    def from_categories(categories: Mapping[str, Iterable[str]], dtype: str = "bigint") -> OneHotModel:
        return OneHotModel(list(categories), {c: sorted(v) for c, v in categories.items()}, dtype)


def one_hot(df: DataFrame, columns: Sequence[str], clean: bool = True) -> DataFrame:
    """Fit and apply in one call (``get_dummies`` style), optionally cleaning names."""
    out = OneHot(columns).fit(df).transform(df)
    return clean_names(out) if clean else out


# ---------------------------------------------------------------- any number of categories

def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The dictionary of the columns' distinct non-null values: (column, value,
    index), numbered from 0 per column in order of the value's md5, without a
    task that holds a whole column and without a list on the driver."""
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("p"))
    pairs = pairs.select("p.*").where(F.col("value").isNotNull()).distinct()
    place = F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("double")
    numbered = row_numbers(pairs.withColumn("_place", place), ["_place", "value"], ["column"], out="index")
    return numbered.select("column", "value", (F.col("index") - 1).alias("index"))


def encode_sparse(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], output: str = "indices") -> DataFrame:
    """df with ``output``, the places of the ones in its one-hot vector (the
    columns' values one after the other, in their order; null and unseen values
    have none), and ``n_features``, the vector's length. The dictionary is
    joined once per column: broadcast by adaptive execution if it is small,
    else by a shuffle whose hot values are split."""
    sizes = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count("*").alias("n")).collect()}  # a row per column
    out, start, places = df, 0, []
    for i, c in enumerate(columns):
        own = dictionary.where(F.col("column") == c).select(F.col("value").alias(f"_value{i}"), (F.col("index") + start).alias(f"_index{i}"))
        out = out.join(own, F.col(f"`{c}`").cast("string") == F.col(f"_value{i}"), "left")
        places.append(F.col(f"_index{i}"))
        start += sizes.get(c, 0)
    every = F.filter(F.array(*places), lambda x: x.isNotNull())
    return out.select(*[F.col(f"`{c}`") for c in df.columns], every.alias(output), F.lit(start).cast("long").alias("n_features"))
