"""Frequency counts and top-N (per group and global).

Per-group top-N is ``row_number() <= n`` over a window; Spark plans it with a
partial WindowGroupLimit *before* the shuffle, so even a group holding a third
of all rows sends at most ``n`` rows per map task across the network.
Ties are always broken by the item key (rule N9), so results are total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list:
    if isinstance(cs, (str, Column)):
        return [cs]
    return list(cs)


def item_counts(df: DataFrame, group: str | Sequence[str] | None, item: str = "sku_id",
                count_col: str = "cnt") -> DataFrame:
    """Non-null item frequency within each non-null group (pandas value_counts)."""
    groups = _cols(group) if group is not None else []
    cond = F.col(item).isNotNull()
    for g in groups:
        cond = cond & F.col(g).isNotNull()
    return (df.where(cond)
            .groupBy(*groups, item)
            .agg(F.count(item).alias(count_col)))


def top_n_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column],
                    n: int, rank_col: str = "rnk") -> DataFrame:
    w = Window.partitionBy(*_cols(group)).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))


def global_top_n(df: DataFrame, order: Sequence[Column], n: int, rank_col: str = "rnk") -> DataFrame:
    """Global top-N (TakeOrderedAndProject), numbered 1..n.

    The limit is the feature here: the list itself is what is published.
    The numbering runs over at most ``n`` rows.
    """
    top = df.orderBy(*order).limit(n)
    w = Window.orderBy(*order)
    return top.withColumn(rank_col, F.row_number().over(w).cast("bigint"))


def top_items_per_group(df: DataFrame, group: str | Sequence[str], n: int, item: str = "sku_id",
                        count_col: str = "cnt", rank_col: str = "rnk") -> DataFrame:
    counts = item_counts(df, group, item, count_col)
    return top_n_per_group(counts, group, [F.col(count_col).desc(), F.col(item).asc()], n, rank_col)
