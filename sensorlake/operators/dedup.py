"""Deterministic one-row-per-id de-duplication and duplicate profiles.

``dropDuplicates`` keeps an arbitrary copy. Here the surviving copy has the
smallest preference order and, among equals, the smallest orderable columns, so
the choice is defined; columns that can't be ordered (maps) ride along. It is a ``min_by`` aggregate (folds: ``min`` of rows), not a window: the partial
aggregate folds every id's copies inside each map task before the shuffle, so
an id repeated across a third of all rows still sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, PipelineConfig


ORDERS = ("prefer_value", "first_arrival")


def preference(cfg: PipelineConfig, order: str) -> list[Column]:
    c = cfg.cols
    if order == "prefer_value":
        # earliest copy that carries a reading, then earliest arrival
        return [F.col(c.value).isNull(), F.col(c.time), F.col(c.ingested)]
    if order == "first_arrival":
        return [F.col(c.ingested), F.col(c.time)]
    raise ValueError(f"unknown dedup order {order!r}")


def _preferred(df: DataFrame, cfg: PipelineConfig, order: str, whole: bool = False) -> Column:
    """The aggregate that keeps a group's preferred row."""
    keys = preference(cfg, order)
    ties = [f.name for f in df.schema.fields if _orderable(f.dataType)]
    if whole and ties == df.columns:
        # every column is compared, so the smallest rank is the row itself: it is carried once, not beside its rank
        best = F.min(F.struct(*[k.alias(f"_o{i}") for i, k in enumerate(keys)], *[F.col(f"`{x}`").alias(f"_t{i}") for i, x in enumerate(ties)]))
        return F.struct(*[best[f"_t{i}"].alias(x) for i, x in enumerate(ties)])
    rank = F.struct(*[k.alias(f"_o{i}") for i, k in enumerate(keys)], *[F.col(f"`{x}`").alias(f"_t{i}") for i, x in enumerate(ties)])
    return F.min_by(F.struct(*[F.col(f"`{x}`") for x in df.columns]), rank)


def dedup(df: DataFrame, cfg: PipelineConfig = DEFAULT, order: str | None = None) -> DataFrame:
    """Keep one row per event id (rows with a NULL id collapse to one row)."""
    return (df.groupBy(F.col(cfg.cols.event_id).alias("_id"))
              .agg(_preferred(df, cfg, order or cfg.dedup_order).alias("_row"))
              .select("_row.*"))


def fold_ids(df: DataFrame, cfg: PipelineConfig = DEFAULT, orders: tuple[str, ...] = ORDERS) -> DataFrame:
    """One row per event id: ``id``, its number of ``copies`` and the copy that each order prefers, as a struct named
    like the order.

    Stored once, it answers every question about copies without another shuffle of the ids: ``preferred``,
    ``copied_ids`` and ``copies_surplus`` read it. An id that holds a third of all rows is folded inside each map
    task and is one row here, where a table bucketed by id would hold all its rows in one bucket.
    """
    return df.groupBy(F.col(cfg.cols.event_id).alias("id")).agg(
        F.count(F.lit(1)).alias("copies"), *[_preferred(df, cfg, o, whole=True).alias(o) for o in orders])


def preferred(folds: DataFrame, order: str) -> DataFrame:
    """The rows that ``dedup`` keeps, from folded ids."""
    return folds.select(f"{order}.*")


def copied_ids(folds: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """``duplicate_ids`` from folded ids."""
    return folds.filter(F.col("copies") > 1).select(F.col("id").alias(cfg.cols.event_id), F.col("copies").alias("count"))


def copies_surplus(folds: DataFrame) -> DataFrame:
    """``duplicate_surplus`` from folded ids."""
    total = F.coalesce(F.sum("copies"), F.lit(0))
    return folds.agg(total.alias("total_rows"), F.count("id").alias("distinct_ids"),
                     (total - F.count(F.lit(1))).alias("surplus_rows"))


def _orderable(kind: T.DataType) -> bool:
    """Whether values of the type can be compared: any but maps and what holds one."""
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def duplicate_ids(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Ids seen more than once, with their number of copies."""
    c = cfg.cols
    return (df.groupBy(c.event_id).agg(F.count(F.lit(1)).alias("count"))
              .filter(F.col("count") > 1))


def top_duplicate_ids(df: DataFrame, n: int = 10, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    c = cfg.cols
    return duplicate_ids(df, cfg).orderBy(F.col("count").desc(), F.col(c.event_id)).limit(n)


def surplus_expr(cfg: PipelineConfig = DEFAULT) -> Column:
    """Rows a one-row-per-id dedup removes (NULL ids count as one id)."""
    idc = F.col(cfg.cols.event_id)
    return (F.count(F.lit(1)) - F.countDistinct(idc)
            - F.max(F.when(idc.isNull(), F.lit(1)).otherwise(F.lit(0)))).cast("long")


def duplicate_surplus(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.countDistinct(cfg.cols.event_id).alias("distinct_ids"),
                  F.coalesce(surplus_expr(cfg), F.lit(0)).alias("surplus_rows"))
