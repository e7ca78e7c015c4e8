"""Keyed tables: newest row per key, upsert, insert-if-absent.

``MERGE`` does not exist on plain Parquet, so an upsert is the union of the old
and new rows reduced to one row per key. The reduction is an aggregation with a
map-side part, so a key that repeats very often shrinks before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import BAR_KEY, BOOK_KEY


def order_key(columns: Sequence[str]) -> Column:
    """One sortable value for an order; a single column stays a cheap fixed-width buffer."""
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, keep_order: bool = True
) -> DataFrame:
    """The row with the greatest ``order`` for each key; the order must be unique per key.

    A NULL in the order is its lowest value, whatever the types. With one order column each value is picked by that
    scalar, so that fixed-width values stay in hash aggregation; several columns are compared as a struct, which Spark
    aggregates by sorting.
    """
    dropped = () if keep_order else tuple(order)
    values = [c for c in df.columns if c not in keys and c not in dropped]
    if not values:
        return df.select(*keys).distinct()
    shown = [c for c in df.columns if c not in dropped]
    if len(order) == 1:
        by = F.col(order[0])
        # max_by skips rows without an order: they count where a key has no other (then there is one, as orders are unique)
        picked = df.groupBy(*keys).agg(
            F.max(by).alias("_order"),
            *[F.max_by(c, by).alias(f"_v{i}") for i, c in enumerate(values)],
            *[F.first(F.when(by.isNull(), F.col(c)), ignorenulls=True).alias(f"_n{i}") for i, c in enumerate(values)],
        )
        rows = [F.when(F.col("_order").isNull(), F.col(f"_n{i}")).otherwise(F.col(f"_v{i}")).alias(c) for i, c in enumerate(values)]
        return picked.select(*keys, *rows).select(*shown)
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values]).select(*shown)


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], ingest_order: Sequence[str]
) -> DataFrame:
    """Stored rows overwritten by incoming ones; the last incoming row of a key wins.

    ``ingest_order`` names columns of ``incoming`` that give its arrival order;
    stored rows come before all of them. An incoming row without an order comes
    after the stored one and before those that have one.
    """
    order = [f"_order{i}" for i in range(len(ingest_order))]
    arrival = [F.col(c).alias(name) for c, name in zip(ingest_order, order)]
    new = incoming.select(*existing.columns, *arrival)
    types = [new.schema[name].dataType for name in order]
    old = existing.withColumns({n: F.lit(None).cast(t) for n, t in zip(order, types)})
    old, new = old.withColumn("_new", F.lit(0)), new.withColumn("_new", F.lit(1))
    return latest_per_key(old.unionByName(new), keys, ["_new", *order], keep_order=False)


def insert_absent(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], ingest_order: Sequence[str]
) -> DataFrame:
    """Stored rows plus incoming rows of new keys; the first incoming row of a key wins."""
    values = [c for c in existing.columns if c not in keys]
    by = order_key(ingest_order)
    if values:
        first = incoming.groupBy(*keys).agg(F.min_by(F.struct(*values), by).alias("_row"))
        first = first.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])
    else:
        first = incoming.select(*keys).distinct()
    fresh = first.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def upsert_bars(existing: DataFrame, incoming: DataFrame, ingest_order: Sequence[str]) -> DataFrame:
    return upsert(existing, incoming, BAR_KEY, ingest_order)


def upsert_prices(existing: DataFrame, incoming: DataFrame, ingest_order: Sequence[str]) -> DataFrame:
    return upsert(existing, incoming, ["symbol"], ingest_order)


def upsert_instruments(
    existing: DataFrame, incoming: DataFrame, ingest_order: Sequence[str]
) -> DataFrame:
    """Update attributes by symbol; stored ids stay, new symbols bring their own id."""
    ids = existing.select("symbol", F.col("symbol_id").alias("_id"))
    kept = incoming.join(ids, "symbol", "left").withColumn(
        "symbol_id", F.coalesce("_id", "symbol_id")
    )
    return upsert(existing, kept.drop("_id"), ["symbol"], ingest_order)


def upsert_book_levels(
    existing: DataFrame, incoming: DataFrame, ingest_order: Sequence[str]
) -> DataFrame:
    return upsert(existing, incoming, BOOK_KEY, ingest_order)


def register_unknown_symbols(prices: DataFrame, seen: DataFrame) -> DataFrame:
    """Price table plus a row with price 0 for every symbol seen but not listed."""
    unknown = seen.select("symbol").filter("symbol is not null").distinct()
    unknown = unknown.join(prices.select("symbol"), "symbol", "left_anti")
    zero = F.lit(0).cast(prices.schema["price"].dataType)
    return prices.select("symbol", "price").unionByName(unknown.withColumn("price", zero))


def track_symbol_period(tracked: DataFrame, wanted: DataFrame, periods: DataFrame) -> DataFrame:
    """Add (symbol, period) pairs to the tracked list; an unknown period is an error."""
    known = periods.select("period", F.lit(True).alias("_known"))
    bad = F.concat(F.lit("unknown period: "), F.coalesce("period", F.lit("NULL")))
    checked = wanted.join(F.broadcast(known), "period", "left").select(
        "symbol",
        F.when(F.col("_known"), F.col("period")).otherwise(F.raise_error(bad)).alias("period"),
    )
    return insert_absent(tracked, checked, ["symbol", "period"], ["symbol"])
