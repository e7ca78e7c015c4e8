"""JSON messages to typed rows. Every parser works on batch and streaming input.

Fields are cast with ``try_cast``, so a bad value never fails the job. An element
(a bar, a level, a ticker, a price, an instrument) is a row if every required field
can be read; else it is a reject. Rows and rejects together account for every element
and every message: ``*_rejects`` returns whole messages that cannot be read,
``*_element_rejects`` the elements, with the first field at fault.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import seconds_to_ts
from tickloom.schemas import BARS, BOOK, INSTRUMENTS, PRICES, TICKER_24H

# Fixed value: HTTP status of a landed page that may be parsed.
OK_STATUS = 200

# Positions of a bar's fields in a page row.
BAR_PAGE_FIELDS = (
    "open_time",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
    "close_time",
    "quote_asset_volume",
    "num_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
)

# Keys of a bar event; some differ in case only.
BAR_EVENT_KEYS = {
    "symbol": "s",
    "period": "i",
    "open_time": "t",
    "open_price": "o",
    "high_price": "h",
    "low_price": "l",
    "close_price": "c",
    "volume": "v",
    "close_time": "T",
    "quote_asset_volume": "q",
    "num_trades": "n",
    "taker_buy_base_asset_volume": "V",
    "taker_buy_quote_asset_volume": "Q",
}

# Keys of a 24-hour ticker object.
TICKER_KEYS = {
    "price_change": "priceChange",
    "price_change_percent": "priceChangePercent",
    "weighted_avg_price": "weightedAvgPrice",
    "prev_close_price": "prevClosePrice",
    "last_price": "lastPrice",
    "last_qty": "lastQty",
    "bid_price": "bidPrice",
    "ask_price": "askPrice",
    "open_price": "openPrice",
    "high_price": "highPrice",
    "low_price": "lowPrice",
    "volume": "volume",
    "quote_volume": "quoteVolume",
    "open_time": "openTime",
    "close_time": "closeTime",
}

# Keys of an instrument object.
INSTRUMENT_KEYS = {
    "symbol": "symbol",
    "status": "status",
    "base_asset": "baseAsset",
    "base_asset_precision": "baseAssetPrecision",
    "quote_asset": "quoteAsset",
    "quote_precision": "quotePrecision",
    "quote_asset_precision": "quoteAssetPrecision",
    "base_commission_precision": "baseCommissionPrecision",
    "quote_commission_precision": "quoteCommissionPrecision",
    "default_self_trade_prevention_mode": "defaultSelfTradePreventionMode",
}


def _typed(value: Column, name: str, schema) -> Column:
    return value.try_cast(schema[name].dataType).alias(name)


def _fault(fields: dict[str, Column], schema, required: Sequence[str]) -> Column:
    """Name of the first field that is missing though required, or there but unreadable; NULL if all are good."""
    bad = [
        F.when(
            value.try_cast(schema[name].dataType).isNull() & (F.lit(name in required) | value.isNotNull()), F.lit(name)
        )
        for name, value in fields.items()
    ]
    return F.coalesce(*bad)


def _accepted(rows: DataFrame, fields: dict[str, Column], schema, required: Sequence[str], others: Sequence) -> DataFrame:
    good = rows.filter(_fault(fields, schema, required).isNull())
    return good.select(*others, *[_typed(value, name, schema) for name, value in fields.items()])


def _rejected(rows: DataFrame, fields: dict[str, Column], schema, required: Sequence[str], others: Sequence) -> DataFrame:
    element = F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
    marked = rows.select(*others, _fault(fields, schema, required).alias("field"), element.alias("element"))
    return marked.filter(F.col("field").isNotNull())


def page_rows(body: Column) -> Column:
    """Rows of a bar page as arrays of text; NULL when the page is not such JSON."""
    return F.from_json(body, "array<array<string>>")


def parse_bar_pages(pages: DataFrame) -> DataFrame:
    """Landed pages (symbol, period, body and perhaps status) to bar rows.

    A page is an array of arrays; fields after the eleventh are ignored. Only
    pages with status 200 are parsed. Other columns are passed on.
    """
    if "status" in pages.columns:
        pages = pages.filter(F.col("status") == OK_STATUS)
    passed = [c for c in pages.columns if c not in ("symbol", "period", "body", "status")]
    parsed = _accepted(_page_elements(pages), _page_fields(), BARS, BAR_PAGE_FIELDS, ["symbol", "period", *passed])
    return parsed.select(*BARS.names, *passed)


def bar_page_element_rejects(pages: DataFrame) -> DataFrame:
    """Bars of readable pages that ``parse_bar_pages`` does not read, with the field at fault."""
    if "status" in pages.columns:
        pages = pages.filter(F.col("status") == OK_STATUS)
    passed = [c for c in pages.columns if c not in ("symbol", "period", "body", "status")]
    return _rejected(_page_elements(pages), _page_fields(), BARS, BAR_PAGE_FIELDS, ["symbol", "period", *passed])


def _page_fields() -> dict[str, Column]:
    return {name: F.get("_r", F.lit(i)) for i, name in enumerate(BAR_PAGE_FIELDS)}


def _page_elements(pages: DataFrame) -> DataFrame:
    passed = [c for c in pages.columns if c not in ("symbol", "period", "body", "status")]
    return pages.select("symbol", "period", *passed, F.explode(page_rows(F.col("body"))).alias("_r"))


def bar_page_rejects(pages: DataFrame) -> DataFrame:
    """Pages that ``parse_bar_pages`` does not read: bad status or not a page."""
    bad = page_rows(F.col("body")).isNull()
    if "status" in pages.columns:
        bad = bad | ~F.col("status").eqNullSafe(F.lit(OK_STATUS))
    return pages.filter(bad)


def parse_bar_events(messages: DataFrame) -> DataFrame:
    """Stream envelopes (``value``) with one bar each, finished or not, to bar rows.

    ``json_tuple`` reads all keys in one parse and tells ``t`` from ``T``.
    """
    passed = [c for c in messages.columns if c != "value"]
    names = list(BAR_EVENT_KEYS)
    bar = messages.select(*passed, F.get_json_object("value", "$.data.k").alias("_k"))
    fields = bar.select(*passed, F.json_tuple("_k", *BAR_EVENT_KEYS.values()).alias(*names))
    typed = _accepted(fields, {n: F.col(n) for n in BARS.names}, BARS, BARS.names, passed)
    return typed.select(*BARS.names, *passed)


def bar_event_rejects(messages: DataFrame) -> DataFrame:
    """Messages that ``parse_bar_events`` does not read, with the ``field`` at fault."""

    def part(key: str) -> Column:
        return F.get_json_object("value", f"$.data.k.{key}")

    fields = {name: part(BAR_EVENT_KEYS[name]) for name in BARS.names}
    return messages.withColumn("field", _fault(fields, BARS, BARS.names)).filter(F.col("field").isNotNull())


def with_event_time(messages: DataFrame) -> DataFrame:
    """Messages with the time they were sent, as ``event_ms``, to order them by."""
    sent = F.coalesce(F.get_json_object("value", "$.data.E"), F.get_json_object("value", "$.E"))
    return messages.withColumn("event_ms", sent.try_cast("bigint"))


_PAIRS = "array<array<string>>"


def _depth_fields(messages: DataFrame) -> DataFrame:
    """Readable depth messages: a symbol, an event time, and sides that are lists or absent."""
    passed = [c for c in messages.columns if c != "value"]
    return _depth_parts(messages).filter(F.col("field").isNull()).select(
        *passed,
        F.upper("_s").alias("symbol"),
        seconds_to_ts(F.col("_e").try_cast("bigint")).alias("ptime"),
        F.coalesce("bids", F.array().cast(_PAIRS)).alias("bids"),
        F.coalesce("asks", F.array().cast(_PAIRS)).alias("asks"),
    )


def _depth_parts(messages: DataFrame) -> DataFrame:
    raw = messages.select("*", F.json_tuple("value", "E", "s", "b", "a").alias("_e", "_s", "_b", "_a"))
    raw = raw.withColumns({"bids": F.from_json("_b", _PAIRS), "asks": F.from_json("_a", _PAIRS)})
    fault = (
        F.when(F.col("_s").isNull(), F.lit("symbol"))
        .when(F.col("_e").try_cast("bigint").isNull(), F.lit("ptime"))
        .when(F.col("_b").isNotNull() & F.col("bids").isNull(), F.lit("bids"))
        .when(F.col("_a").isNotNull() & F.col("asks").isNull(), F.lit("asks"))
    )
    return raw.withColumn("field", fault)


def depth_rejects(messages: DataFrame) -> DataFrame:
    """Messages that ``parse_depth_updates`` does not read, with the ``field`` at fault."""
    return _depth_parts(messages).filter(F.col("field").isNotNull()).select(*messages.columns, "field")


def _depth_levels(messages: DataFrame) -> DataFrame:
    passed = [c for c in messages.columns if c != "value"]

    def tagged(levels: str, side: str) -> Column:
        return F.transform(
            levels,
            lambda p: F.struct(F.lit(side).alias("side"), F.get(p, F.lit(0)).alias("_p"), F.get(p, F.lit(1)).alias("_v")),
        )

    levels = F.concat(tagged("bids", "bid"), tagged("asks", "ask"))
    return _depth_fields(messages).select(*passed, "symbol", "ptime", F.inline(levels))


_LEVEL = ("price", "volume")


def _level_fields() -> dict[str, Column]:
    return {"price": F.col("_p"), "volume": F.col("_v")}


def parse_depth_updates(messages: DataFrame) -> DataFrame:
    """Depth messages (``value``) to levels (symbol, side, ptime, price, volume).

    Event time is cut to whole seconds and the symbol is upper-cased. A missing side
    gives none of that side.
    """
    passed = [c for c in messages.columns if c != "value"]
    rows = _accepted(_depth_levels(messages), _level_fields(), BOOK, _LEVEL, ["symbol", "side", "ptime", *passed])
    return rows.select("symbol", "side", "ptime", "price", "volume", *passed)


def depth_element_rejects(messages: DataFrame) -> DataFrame:
    """Levels of readable messages whose price or volume cannot be read."""
    passed = [c for c in messages.columns if c != "value"]
    return _rejected(_depth_levels(messages), _level_fields(), BOOK, _LEVEL, ["symbol", "side", "ptime", *passed])


def depth_counts(messages: DataFrame) -> DataFrame:
    """Per message: symbol, event time, number of bids and of asks."""
    passed = [c for c in messages.columns if c != "value"]
    return _depth_fields(messages).select(
        *passed,
        "symbol",
        F.col("ptime").alias("event_time"),
        F.size("bids").alias("bids_affected"),
        F.size("asks").alias("asks_affected"),
    )


def _objects(body: Column, keys: dict[str, str]) -> Column:
    fields = ", ".join(f"`{key}`: string" for key in keys.values())
    return F.from_json(body, f"array<struct<{fields}>>")


def _listed(messages: DataFrame, body: Column, keys: dict[str, str]) -> DataFrame:
    """The elements of lists of objects, one row each, fields as text under their keys."""
    passed = [c for c in messages.columns if c != "value"]
    return messages.select(*passed, F.inline(_objects(body, keys)))


def _list_rejects(messages: DataFrame, body: Column, keys: dict[str, str]) -> DataFrame:
    """Messages that hold no such list."""
    return messages.filter(_objects(body, keys).isNull())


_TICKER = {"symbol": "symbol", **TICKER_KEYS}
_TICKER_SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), *TICKER_24H.fields])
_TICKER_REQUIRED = ("symbol", "open_time", "close_time", "last_price")


def _ticker_fields() -> dict[str, Column]:
    return {name: F.col(key) for name, key in _TICKER.items()}


def parse_ticker_24h(messages: DataFrame) -> DataFrame:
    """Arrays of 24-hour ticker objects (``value``) to symbol and 15 typed columns.

    Symbol, both times and the last price are required; other fields may be missing, not unreadable.
    """
    passed = [c for c in messages.columns if c != "value"]
    rows = _listed(messages, F.col("value"), _TICKER)
    rows = _accepted(rows, _ticker_fields(), _TICKER_SCHEMA, _TICKER_REQUIRED, passed)
    return rows.select(*_TICKER, *passed)


def ticker_rejects(messages: DataFrame) -> DataFrame:
    return _list_rejects(messages, F.col("value"), _TICKER)


def ticker_element_rejects(messages: DataFrame) -> DataFrame:
    passed = [c for c in messages.columns if c != "value"]
    rows = _listed(messages, F.col("value"), _TICKER)
    return _rejected(rows, _ticker_fields(), _TICKER_SCHEMA, _TICKER_REQUIRED, passed)


def ticker_rows(parsed: DataFrame, instruments: DataFrame) -> DataFrame:
    """Parsed ticker rows in the layout of the ticker table; unknown symbols drop out."""
    ids = instruments.select("symbol", "symbol_id")
    return parsed.join(ids, "symbol").select(*TICKER_24H.names)


_PRICED = {"symbol": "symbol", "price": "price"}


def _price_fields() -> dict[str, Column]:
    return {name: F.col(name) for name in _PRICED}


def parse_price_list(messages: DataFrame) -> DataFrame:
    """Arrays of ``{symbol, price}`` (``value``) to price rows."""
    passed = [c for c in messages.columns if c != "value"]
    rows = _accepted(_listed(messages, F.col("value"), _PRICED), _price_fields(), PRICES, list(_PRICED), passed)
    return rows.select(*_PRICED, *passed)


def price_rejects(messages: DataFrame) -> DataFrame:
    return _list_rejects(messages, F.col("value"), _PRICED)


def price_element_rejects(messages: DataFrame) -> DataFrame:
    passed = [c for c in messages.columns if c != "value"]
    return _rejected(_listed(messages, F.col("value"), _PRICED), _price_fields(), PRICES, list(_PRICED), passed)


def _instruments(messages: DataFrame) -> tuple[DataFrame, dict[str, Column], list[str]]:
    rows = _listed(messages, F.get_json_object("value", "$.symbols"), INSTRUMENT_KEYS)
    return rows, {name: F.col(key) for name, key in INSTRUMENT_KEYS.items()}, [c for c in messages.columns if c != "value"]


def parse_exchange_info(messages: DataFrame) -> DataFrame:
    """Objects with a ``symbols`` list (``value``) to instrument attributes; only the symbol is required."""
    rows, fields, passed = _instruments(messages)
    return _accepted(rows, fields, INSTRUMENTS, ["symbol"], passed).select(*INSTRUMENT_KEYS, *passed)


def instrument_rejects(messages: DataFrame) -> DataFrame:
    return _list_rejects(messages, F.get_json_object("value", "$.symbols"), INSTRUMENT_KEYS)


def instrument_element_rejects(messages: DataFrame) -> DataFrame:
    rows, fields, passed = _instruments(messages)
    return _rejected(rows, fields, INSTRUMENTS, ["symbol"], passed)
