"""Messages with bad elements: rows and rejects of each parser account for all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.plans.fixtures import Tables
from tickloom.plans.queries.base import query
from tickloom.sources import messages


def _sent(t: Tables, before: str, after: str, name: str = "value") -> DataFrame:
    """One message for each event. Of ten, the first has an unreadable value, the second none, the third is no JSON."""
    k = F.col("event_id") % 10
    number = F.concat(F.lit('"'), (F.col("event_id") % 1000).cast("string"), F.lit('"'))
    value: Column = F.when(k == 0, F.lit('"oops"')).when(k == 1, F.lit("null")).otherwise(number)
    body = F.when(k == 2, F.lit("broken")).otherwise(F.concat(F.lit(before), value, F.lit(after)))
    return t.read("events").select(body.alias(name))


def _expected(first: str, second: str, third: str) -> str:
    return f"""SELECT CASE event_id % 10 WHEN 0 THEN '{first}' WHEN 1 THEN '{second}' WHEN 2 THEN '{third}' ELSE 'row' END AS field,
  count(*) AS n FROM events GROUP BY 1"""


def _counted(rows: DataFrame, *rejects: DataFrame) -> DataFrame:
    found = rows.select(F.lit("row").alias("field"))
    for bad in rejects:
        found = found.unionByName(bad.select("field" if "field" in bad.columns else F.lit("message").alias("field")))
    return found.groupBy("field").agg(F.count("*").alias("n"))


@query("reject_bar_pages", _expected("close_price", "close_price", "message"))
def reject_bar_pages(t: Tables):
    pages = _sent(t, '[[60000,"1","1","1",', ',"1",119999,"1",1,"1","1"]]', "body")
    pages = pages.select(F.lit("x").alias("symbol"), F.lit("1m").alias("period"), "body")
    return _counted(
        messages.parse_bar_pages(pages), messages.bar_page_rejects(pages), messages.bar_page_element_rejects(pages)
    )


@query("reject_bar_events", _expected("close_price", "close_price", "symbol"))
def reject_bar_events(t: Tables):
    sent = _sent(
        t,
        '{"data":{"k":{"s":"x","i":"1m","t":60000,"T":119999,"o":"1","h":"1","l":"1","v":"1","q":"1","n":1,"V":"1","Q":"1","c":',
        "}}}",
    )
    return _counted(messages.parse_bar_events(sent), messages.bar_event_rejects(sent))


@query("reject_depth", _expected("price", "price", "symbol"))
def reject_depth(t: Tables):
    sent = _sent(t, '{"E":1700000000000,"s":"x","b":[[', ',"1"]],"a":[]}')
    return _counted(
        messages.parse_depth_updates(sent), messages.depth_rejects(sent), messages.depth_element_rejects(sent)
    )


def _lists(name: str, sql: str, before: str, after: str, *functions: Callable[[DataFrame], DataFrame]) -> None:
    @query(name, sql)
    def run(t: Tables):
        sent = _sent(t, before, after)
        return _counted(*[f(sent) for f in functions])


_lists(
    "reject_tickers",
    _expected("last_price", "last_price", "message"),
    '[{"symbol":"x","openTime":1,"closeTime":2,"lastPrice":',
    "}]",
    messages.parse_ticker_24h,
    messages.ticker_rejects,
    messages.ticker_element_rejects,
)
_lists(
    "reject_prices",
    _expected("price", "price", "message"),
    '[{"symbol":"x","price":',
    "}]",
    messages.parse_price_list,
    messages.price_rejects,
    messages.price_element_rejects,
)
_lists(
    "reject_instruments",
    _expected("quote_precision", "row", "message"),  # a missing precision is no fault
    '{"symbols":[{"symbol":"x","quotePrecision":',
    "}]}",
    messages.parse_exchange_info,
    messages.instrument_rejects,
    messages.instrument_element_rejects,
)


@query(
    "depth_counts",
    """SELECT upper(event_type) AS symbol, date_trunc('second', ts) AS event_time, 2 AS bids_affected, 0 AS asks_affected
FROM events""",
)
def depth_counts(t: Tables):
    level = F.concat(F.lit('["'), F.col("price").cast("string"), F.lit('","1"]'))
    sent = t.ticks.select(
        F.concat(
            F.lit('{"E":'), F.unix_millis("ts").cast("string"), F.lit(',"s":"'), "symbol", F.lit('","b":['),
            level, F.lit(","), level, F.lit("]}"),
        ).alias("value")
    )
    return messages.depth_counts(sent)
