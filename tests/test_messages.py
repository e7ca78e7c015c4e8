"""Parsers on good, odd and broken messages."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tickloom.operators.ingest import ingest_stats
from tickloom.sources import messages

ROW = '[1499040000000,"0.01634790","0.80000000","0.01575800","0.01577100","148976.11427815",1499644799999,"2434.19055334",308,"1756.87402397","28.46694368","17928899.62484339"]'


def test_bar_pages(spark):
    pages = spark.createDataFrame(
        [
            ("A", "1w", f"[{ROW}]", 200),
            ("A", "1w", '{"code":-1121}', 400),
            ("B", "1w", "not json", 200),
            ("C", "1w", "[]", 200),
            ("D", "1w", "[[null,1,2]]", 200),
        ],
        "symbol string, period string, body string, status int",
    )
    rows = messages.parse_bar_pages(pages).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.symbol, r.period, r.open_time, r.close_time, r.num_trades) == ("A", "1w", 1499040000000, 1499644799999, 308)
    assert (r.open_price, r.volume) == (Decimal("0.01634790"), Decimal("148976.11427815"))
    assert r.taker_buy_quote_asset_volume == Decimal("28.46694368")
    assert sorted(r.symbol for r in messages.bar_page_rejects(pages).collect()) == ["A", "B"]
    stats = {r.symbol: r for r in ingest_stats(pages).collect()}
    assert (stats["A"].rows_affected, stats["A"].next_start, stats["A"].finished) == (1, 1499644800000, True)
    assert stats["C"].rows_affected == 0 and stats["C"].next_start is None
    assert not ingest_stats(pages.filter("symbol = 'A'"), limit=1).first().finished


EVENT = (
    '{"stream":"x@1m","data":{"e":"bar","E":1,"s":"XYZ","k":{"t":100,"T":159,"s":"XYZ","i":"1m","f":1,"L":2,'
    '"o":"0.0010","c":"0.0020","h":"0.0025","l":"0.0015","v":"1000","n":100,"x":false,"q":"1.5","V":"500","Q":"0.5","B":"0"}}}'
)


def test_bar_events(spark):
    feed = spark.createDataFrame(
        [(EVENT, 1), ("{broken", 2), ('{"result":null,"id":1}', 3), ('{"data":{"k":{"s":"X","i":"1m"}}}', 4)],
        "value string, seq int",
    )
    rows = messages.parse_bar_events(feed).collect()
    assert [(r.symbol, r.period, r.open_time, r.close_time, r.seq) for r in rows] == [("XYZ", "1m", 100, 159, 1)]
    assert (rows[0].volume, rows[0].quote_asset_volume) == (Decimal(1000), Decimal("1.5"))
    assert (rows[0].taker_buy_base_asset_volume, rows[0].taker_buy_quote_asset_volume) == (Decimal(500), Decimal("0.5"))
    assert sorted(r.seq for r in messages.bar_event_rejects(feed).collect()) == [2, 3, 4]


def test_event_time(spark):
    feed = spark.createDataFrame([(EVENT,), ('{"e":"x","E":7}',), ("junk",)], "value string")
    assert [r.event_ms for r in messages.with_event_time(feed).collect()] == [1, 7, None]


def test_depth_updates(spark):
    bids = ",".join(f'["{27711 - i}.18000000","{i % 3}.05411000"]' for i in range(20))
    asks = ",".join(f'["{27712 + i}.10000000","0.00000000"]' for i in range(11))
    feed = spark.createDataFrame(
        [
            (f'{{"e":"depthUpdate","E":1680492645210,"s":"btcusdt","U":1,"u":2,"b":[{bids}],"a":[{asks}]}}',),
            ('{"E":1680492645999,"s":"ETH","a":[["2","3"]]}',),
            ('{"E":1680492645210,"b":[["1","1"]],"a":[]}',),
            ("nonsense",),
        ],
        "value string",
    )
    rows = messages.parse_depth_updates(feed)
    counts = {(r.symbol, r.side): r["count"] for r in rows.groupBy("symbol", "side").count().collect()}
    assert counts == {("BTCUSDT", "bid"): 20, ("BTCUSDT", "ask"): 11, ("ETH", "ask"): 1}
    assert {r.ptime for r in rows.collect()} == {dt.datetime(2023, 4, 3, 3, 30, 45)}
    assert rows.filter("volume = 0").count() == 11
    sizes = {r.symbol: (r.bids_affected, r.asks_affected) for r in messages.depth_counts(feed).collect()}
    assert sizes == {"BTCUSDT": (20, 11), "ETH": (0, 1)}


def test_price_list_takes_numbers_and_text(spark):
    feed = spark.createDataFrame(
        [('[{"symbol":"QWXUSD","price":417},{"symbol":"ETHUSD","price":"900.5"},{"symbol":"BAD","price":"x"}]',)],
        "value string",
    )
    rows = {r.symbol: r.price for r in messages.parse_price_list(feed).collect()}
    assert rows == {"QWXUSD": Decimal(417), "ETHUSD": Decimal("900.5")}


def test_ticker_and_exchange_info(spark):
    feed = spark.createDataFrame(
        [('[{"symbol":"AB","priceChange":"-1.5","lastPrice":"4","openTime":1,"closeTime":2,"count":76}]',)], "value string"
    )
    row = messages.parse_ticker_24h(feed).first()
    assert (row.symbol, row.price_change, row.last_price, row.open_time) == ("AB", Decimal("-1.5"), Decimal(4), 1)
    instruments = spark.createDataFrame([("AB", 7)], "symbol string, symbol_id int")
    assert messages.ticker_rows(messages.parse_ticker_24h(feed), instruments).first().symbol_id == 7
    info = spark.createDataFrame(
        [('{"timezone":"UTC","symbols":[{"symbol":"AB","status":"TRADING","baseAsset":"A","baseAssetPrecision":8,"quoteAsset":"B","filters":[]}]}',)],
        "value string",
    )
    row = messages.parse_exchange_info(info).first()
    assert (row.symbol, row.base_asset, row.base_asset_precision, row.quote_precision) == ("AB", "A", 8, None)
    assert messages.parse_exchange_info(info).select(F.col("base_asset_precision")).schema[0].dataType.simpleString() == "smallint"
