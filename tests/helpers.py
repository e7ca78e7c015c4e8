"""Small bar tables for tests."""

from __future__ import annotations

import random
from decimal import Decimal

from tickloom.schemas import BARS, PERIOD_MS

START_MS = 1_700_006_400_000


def bar(symbol, period, open_time, close, volume, **more):
    price = Decimal(str(close))
    row = {
        "symbol": symbol,
        "period": period,
        "open_time": open_time,
        "open_price": price,
        "high_price": price,
        "low_price": price,
        "close_price": price,
        "volume": Decimal(str(volume)),
        "close_time": open_time + PERIOD_MS[period] - 1,
        "quote_asset_volume": price * Decimal(str(volume)),
        "num_trades": 1,
        "taker_buy_base_asset_volume": Decimal(0),
        "taker_buy_quote_asset_volume": Decimal(0),
    }
    row.update({k: Decimal(str(v)) if isinstance(v, (int, float)) and k.endswith("price") else v for k, v in more.items()})
    return tuple(row[n] for n in BARS.names)


def bars_frame(spark, rows):
    return spark.createDataFrame(rows, BARS)


def random_rows(seed, counts, period="1m", gap=0.3, big_gap=0.02):
    """Series with gaps: {symbol: rows}, as tuples in the layout of BARS."""
    rng = random.Random(seed)
    rows = []
    for symbol, count in counts.items():
        at, price = START_MS, 100.0
        for _ in range(count):
            at += PERIOD_MS[period]
            while rng.random() < gap:
                at += PERIOD_MS[period]
            if rng.random() < big_gap:
                at += PERIOD_MS[period] * rng.randrange(100, 5000)
            price = max(1.0, round(price + rng.gauss(0, 1.5), 2))
            rows.append(bar(symbol, period, at, price, rng.randrange(0, 200)))
    rng.shuffle(rows)
    return rows
