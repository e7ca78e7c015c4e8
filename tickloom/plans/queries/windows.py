"""Neighbours, bands, spikes, crossovers, and the presets built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom import schemas as S
from tickloom.functions.times import to_epoch_ms
from tickloom.operators import book as books
from tickloom.operators import crossover, windows
from tickloom.operators.bars import resample_by_count
from tickloom.plans import presets
from tickloom.plans.fixtures import AS_OF_EVENTS, Tables, with_ctes
from tickloom.plans.queries.base import as_double, query
from tickloom.plans.queries.scalars import TEXT_SQL

PAIRS = ((10, 6), (20, 13), (50, 33))
SERIES_WINDOW = "(PARTITION BY symbol, period ORDER BY open_time)"


def frame(rows: str) -> str:
    return f"(PARTITION BY symbol, period ORDER BY open_time ROWS BETWEEN {rows})"


def neighbours_sql(source: str) -> str:
    parts = []
    for name in windows.NEIGHBOURED:
        cast = "" if name == "num_trades" else "AS DOUBLE"
        for call, prefix in (("lag", "prev"), ("lead", "next")):
            text = f"{call}({name}) OVER {SERIES_WINDOW}"
            parts.append(f"{f'CAST({text} AS DOUBLE)' if cast else text} AS {prefix}_{name}")
    return f"SELECT *, {', '.join(parts)} FROM {source}"


def bands_sql(source: str, n: int, bandwidth: float, where: str = "true") -> str:
    """Bands over ``source``; prices there have two digits, so sums of cents are exact."""
    return f"""SELECT *, CASE WHEN prev <= lower_band AND c > lower_band THEN 'BUY'
      WHEN prev >= upper_band AND c < upper_band THEN 'SELL' END AS trade_signal
    FROM (SELECT *, middle_band + standard_deviation * {bandwidth} AS upper_band,
        middle_band - standard_deviation * {bandwidth} AS lower_band
      FROM (SELECT *, CAST(s1 AS DOUBLE) * 1e6 / CAST({n * 1e8!r} AS DOUBLE) AS middle_band,
          sqrt(CAST(({n} * s2 - s1 * s1) * 1000000000000 AS DOUBLE) / CAST({n * n * 1e16!r} AS DOUBLE)) AS standard_deviation
        FROM (SELECT *, CAST(close_price AS DOUBLE) AS c, row_number() OVER {SERIES_WINDOW} AS rn,
            sum(cents) OVER {frame(f'{n - 1} PRECEDING AND CURRENT ROW')} AS s1,
            sum(cents * cents) OVER {frame(f'{n - 1} PRECEDING AND CURRENT ROW')} AS s2,
            CASE WHEN row_number() OVER {SERIES_WINDOW} > {n}
              THEN CAST(lag(close_price) OVER {SERIES_WINDOW} AS DOUBLE) END AS prev
          FROM (SELECT *, CAST(close_price * 100 AS HUGEINT) AS cents FROM {source} WHERE {where}))
        WHERE rn >= {n}))"""


BANDS = "upper_band, middle_band, standard_deviation, lower_band, trade_signal"


@query(
    "neighbour_bars",
    with_ctes(
        f"""SELECT symbol, open_time, {as_double('close_price', 'high_price', 'low_price', 'volume')}, num_trades,
  {', '.join(f'{p}_{n}' for n in windows.NEIGHBOURED for p in ('prev', 'next'))} FROM near""",
        "bars_1h",
        extra={"near": neighbours_sql("bars_1h")},
    ),
)
def neighbour_bars(t: Tables):
    rows = windows.neighbour_bars(t.bars("1h"))
    added = [f"{p}_{n}" for n in windows.NEIGHBOURED for p in ("prev", "next")]
    return rows.select("symbol", "open_time", *windows.NEIGHBOURED, *added)


@query(
    "bollinger_bands",
    with_ctes(
        f"SELECT symbol, period, open_time, {as_double('close_price')}, {BANDS} FROM banded",
        "bars_1h",
        extra={"banded": bands_sql("bars_1h", 20, 1.0)},
    ),
)
def bollinger_bands(t: Tables):
    return windows.bollinger_bands(t.bars("1h"), bandwidth=1.0, n=20)


@query(
    "bollinger_orders",
    with_ctes(
        f"SELECT symbol, period, open_time, {as_double('close_price')}, {BANDS} FROM banded",
        "order_bars",
        extra={"banded": bands_sql("order_bars", 20, 2.0)},
    ),
)
def bollinger_orders(t: Tables):
    return windows.bollinger_bands(t.order_bars, bandwidth=2.0, n=20)


SIGNAL_COLUMNS = as_double(
    "volume", "prev_volume", "next_volume", "close_price", "prev_close_price", "next_close_price"
)


def signals_sql(source: str, n: int, bandwidth: float, where: str = "true") -> str:
    """Band rows joined to the neighbours of the whole series."""
    return with_ctes(
        f"""SELECT b.symbol, b.period, make_timestamp(b.open_time * 1000) AS open_time, b.trade_signal,
  {as_double('volume', 'close_price', table='w')}, w.prev_volume, w.next_volume,
  w.prev_close_price, w.next_close_price
FROM banded b JOIN near w USING (symbol, period, open_time)
WHERE w.volume > w.prev_volume * 3""",
        source,
        extra={"banded": bands_sql(source, n, bandwidth, where), "near": neighbours_sql(NEAR[source])},
    )


_LINE_AS_BAR = "(SELECT *, close_price AS high_price, close_price AS low_price FROM {})"
NEAR = {
    "bars_1h": "bars_1h",
    "line_bars_1m": _LINE_AS_BAR.format("line_bars_1m"),
    "line_bars_1s": _LINE_AS_BAR.format("line_bars_1s"),
}


@query("signals_with_neighbours", signals_sql("bars_1h", 20, 1.0))
def signals_with_neighbours(t: Tables):
    return windows.signals_with_neighbours(t.bars("1h"), bandwidth=1.0, n=20, factor=3)


SPIKE_DAYS = 25
SPIKE_FROM = to_epoch_ms(AS_OF_EVENTS) - SPIKE_DAYS * S.DAY_MS


@query(
    "volume_spikes",
    with_ctes(
        f"""SELECT symbol, period, make_timestamp(open_time * 1000) AS open_time,
  CAST(round(volume, 0) AS DOUBLE) AS volume,
  CASE WHEN second_before IS NOT NULL THEN array_to_string(around, ', ') END AS price_vol_window
FROM (SELECT *, CAST(sum(volume) OVER (PARTITION BY symbol, period) AS DECIMAL(28,8)) * CAST(1.5 AS DECIMAL(2,1)) AS level,
    count(*) OVER (PARTITION BY symbol, period) AS bars,
    coalesce(lag(volume) OVER {SERIES_WINDOW}, 0) AS before, coalesce(lead(volume) OVER {SERIES_WINDOW}, 0) AS behind,
    lag(open_time, 2) OVER {SERIES_WINDOW} AS second_before,
    list({TEXT_SQL}) OVER {frame('2 PRECEDING AND 3 FOLLOWING')} AS around
  FROM bars_1h WHERE open_time >= {SPIKE_FROM})
WHERE CAST(volume AS DECIMAL(18,8)) * bars >= level AND volume >= before AND volume >= behind
  AND CAST(greatest(before, behind) AS DECIMAL(18,8)) * bars > level""",
        "bars_1h",
    ),
)
def volume_spikes(t: Tables):
    return windows.volume_spikes(
        t.bars("1h"), n=1.5, as_of=AS_OF_EVENTS, duration_ms=SPIKE_DAYS * S.DAY_MS
    )


@query(
    "direction_spikes",
    with_ctes(
        f"""SELECT symbol, period, make_timestamp(open_time * 1000) AS open_time,
  {as_double('close_price', 'prev_close', 'volume', 'prev_volume')},
  CASE direction WHEN 1 THEN 'BUY' ELSE 'SELL' END AS trade_signal,
  array_to_string(list_transform(list_filter(around, lambda e: e.t >= open_time - 5 * 3600000)[1:7],
    lambda e: e.x), ', ') AS prices_window
FROM (SELECT *, coalesce(lag(direction) OVER {SERIES_WINDOW}, 0) AS before
  FROM (SELECT *, CASE WHEN prev_close IS NULL THEN 0
      WHEN close_price <> 0 AND abs(close_price - prev_close) < close_price * CAST(0.05 AS DECIMAL(3,2)) THEN 0
      WHEN close_price > prev_close THEN 1 WHEN close_price < prev_close THEN -1 ELSE 0 END AS direction
    FROM (SELECT *, lag(close_price) OVER {SERIES_WINDOW} AS prev_close,
        lag(volume) OVER {SERIES_WINDOW} AS prev_volume
      FROM (SELECT *, list({{'t': open_time, 'x': {TEXT_SQL}}})
          OVER {frame('5 PRECEDING AND 6 FOLLOWING')} AS around FROM bars_1h)
      WHERE open_time >= {SPIKE_FROM})))
WHERE direction <> before AND direction <> 0 AND prev_close IS NOT NULL AND volume > prev_volume""",
        "bars_1h",
    ),
)
def direction_spikes(t: Tables):
    return windows.direction_spikes(
        t.bars("1h"), increase=0.05, as_of=AS_OF_EVENTS, duration_ms=SPIKE_DAYS * S.DAY_MS
    )


def mean_sql(column: str, oldest: int, newest: int) -> str:
    rows = frame(f"{oldest} PRECEDING AND {f'{newest} PRECEDING' if newest else 'CURRENT ROW'}")
    return f"CAST(sum({column}) OVER {rows} AS DOUBLE) / {oldest - newest + 1}.0"


@query(
    "moving_average_pair",
    with_ctes(
        f"""SELECT symbol, period, open_time, {as_double('close_price')},
  CASE WHEN rn > 20 THEN avg1 END AS avg1, CASE WHEN rn > 20 THEN avg2 END AS avg2
FROM (SELECT *, row_number() OVER {SERIES_WINDOW} AS rn, {mean_sql('close_price', 20, 1)} AS avg1,
  {mean_sql('close_price', 19, 0)} AS avg2 FROM bars_1h)""",
        "bars_1h",
    ),
)
def moving_average_pair(t: Tables):
    return crossover.moving_average_pair(t.bars("1h"), 20)


RULE_SQL = """CASE WHEN s1 >= 0 AND s2 >= 0 AND s1 < s2 AND s1 < l1 AND s2 > l2 THEN 'BUY'
  WHEN s1 >= 0 AND s2 >= 0 AND s1 > s2 AND s1 > l1 AND s2 < l2 THEN 'SELL' END"""


@query(
    "mac_crossover",
    with_ctes(
        f"""SELECT symbol, period, open_time, {as_double('close_price')}, s1, s2, l1, l2, {RULE_SQL} AS trade_signal
FROM (SELECT *, row_number() OVER {SERIES_WINDOW} AS rn,
  {mean_sql('close_price', 12, 1)} AS s1, {mean_sql('close_price', 11, 0)} AS s2,
  {mean_sql('close_price', 19, 1)} AS l1, {mean_sql('close_price', 18, 0)} AS l2 FROM bars_1h)
WHERE rn >= 20""",
        "bars_1h",
    ),
)
def mac_crossover(t: Tables):
    return crossover.mac_crossover(t.bars("1h"), 20, 13)


def mac_sql(columns: str, source: str = "bars_1h", where: str = "true") -> str:
    """Signals of ``PAIRS`` in the frame form."""
    parts = []
    for long_term, short_term in PAIRS:
        parts.append(
            f"""SELECT symbol, period, open_time, rn, volume, {long_term} AS long_term, {short_term} AS short_term,
  {mean_sql('close_price', short_term, 2)} AS s1, {mean_sql('close_price', short_term - 1, 1)} AS s2,
  {mean_sql('close_price', long_term, 2)} AS l1, {mean_sql('close_price', long_term - 1, 1)} AS l2,
  {mean_sql('volume', long_term - 1, 0)} AS vol_avg, {mean_sql('volume', 2, 0)} AS vol3_avg FROM numbered"""
        )
    return with_ctes(
        f"""SELECT {columns} FROM (SELECT symbol, period, open_time, long_term, short_term, trade_signal,
    CAST(volume AS DOUBLE) AS volume, vol_avg, vol3_avg,
    CAST(CASE trade_signal WHEN 'SELL' THEN -1 ELSE 1 END * (long_term * 4096 + short_term) AS INTEGER) AS indicator_id
  FROM (SELECT *, {RULE_SQL} AS trade_signal FROM pairs WHERE rn - 1 >= long_term + 2)
  WHERE trade_signal IS NOT NULL AND {where})""",
        source,
        extra={
            "numbered": f"SELECT *, row_number() OVER {SERIES_WINDOW} AS rn FROM {source}",
            "pairs": " UNION ALL ".join(parts),
        },
    )


MAC_COLUMNS = "symbol, period, open_time, indicator_id, long_term, short_term, trade_signal, volume, vol_avg, vol3_avg"


@query("mac_signals", mac_sql(MAC_COLUMNS))
def mac_signals(t: Tables):
    return crossover.mac_signals(t.bars("1h"), PAIRS)


def folded_sql(sizes=S.SIGNAL_PERIOD_MINUTES) -> str:
    return f"""SELECT symbol, size, pos // size AS bar_index, min(open_time) AS open_time,
      arg_min(open_price, pos) AS open_price, max(high_price) AS high_price, min(low_price) AS low_price,
      arg_max(close_price, pos) AS close_price, arg_max(close_time, pos) AS close_time,
      {', '.join(f'sum({c}) AS {c}' for c in (
        'volume', 'quote_asset_volume', 'taker_buy_base_asset_volume', 'taker_buy_quote_asset_volume'))},
      CAST(sum(num_trades) AS BIGINT) AS num_trades
    FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time) - 1 AS pos FROM minute_bars),
      (VALUES {', '.join(f'({n})' for n in sizes)}) v(size) GROUP BY symbol, size, pos // size"""


GRID_REPORT = """symbol, period, indicator_id, count(*) AS signals, min(open_time) AS first_time,
  max(open_time) AS last_time, sum(volume) AS volume"""

_INDEXED = " ".join(f"WHEN {n} THEN {i}" for i, n in enumerate(S.SIGNAL_PERIOD_MINUTES))


@query(
    "mac_grid_signals",
    with_ctes(
        f"""SELECT {GRID_REPORT} FROM (SELECT l.symbol, CASE l.size {_INDEXED} END AS period, l.open_time, l.volume,
    CAST(CASE WHEN s.m1 < s.m2 AND s.m1 < l.m1 AND s.m2 > l.m2 THEN 1
      WHEN s.m1 > s.m2 AND s.m1 > l.m1 AND s.m2 < l.m2 THEN -1 END * (l.term * 4096 + s.term) AS INTEGER) AS indicator_id
  FROM means l JOIN means s ON s.symbol = l.symbol AND s.size = l.size AND s.bar_index = l.bar_index
    AND s.term < l.term WHERE l.term >= 10 AND l.bar_index >= l.term + 2 AND s.term <= 66)
WHERE indicator_id IS NOT NULL GROUP BY symbol, period, indicator_id""",
        "minute_bars",
        extra={
            "folded": folded_sql(),
            "sums": """SELECT *, sum(close_price) OVER w AS r FROM folded
    WINDOW w AS (PARTITION BY symbol, size ORDER BY bar_index)""",
            "means": """SELECT a.symbol, a.size, a.bar_index, a.open_time, CAST(a.volume AS DOUBLE) AS volume, t.term,
      CAST(b2.r - coalesce(b1n.r, 0) AS DOUBLE) / (t.term - 1) AS m1,
      CAST(b1.r - bn.r AS DOUBLE) / (t.term - 1) AS m2
    FROM folded a JOIN range(6, 101) t(term) ON a.bar_index >= t.term + 1
    JOIN sums b1 ON b1.symbol = a.symbol AND b1.size = a.size AND b1.bar_index = a.bar_index - 1
    JOIN sums b2 ON b2.symbol = a.symbol AND b2.size = a.size AND b2.bar_index = a.bar_index - 2
    JOIN sums bn ON bn.symbol = a.symbol AND bn.size = a.size AND bn.bar_index = a.bar_index - t.term
    LEFT JOIN sums b1n ON b1n.symbol = a.symbol AND b1n.size = a.size AND b1n.bar_index = a.bar_index - 1 - t.term""",
        },
    ),
)
def mac_grid_signals(t: Tables):
    """The whole signal job on all minutes, reported per symbol, period and indicator."""
    return grid_report(crossover.mac_grid_signals(t.minute_bars))


def grid_report(found):
    return found.groupBy("symbol", "period", "indicator_id").agg(
        F.count(F.lit(1)).alias("signals"),
        F.min("open_time").alias("first_time"),
        F.max("open_time").alias("last_time"),
        F.sum("volume").alias("volume"),
    )


@query(
    "trailing_volume",
    with_ctes(
        f"""SELECT symbol, period, open_time, {as_double('volume')},
  CAST(sum(volume) OVER {frame('9 PRECEDING AND CURRENT ROW')} AS DOUBLE)
    / count(*) OVER {frame('9 PRECEDING AND CURRENT ROW')} AS vol_avg,
  CAST(sum(volume) OVER {frame('2 PRECEDING AND CURRENT ROW')} AS DOUBLE)
    / count(*) OVER {frame('2 PRECEDING AND CURRENT ROW')} AS vol3_avg FROM bars_1h""",
        "bars_1h",
    ),
)
def trailing_volume(t: Tables):
    return windows.trailing_volume(t.bars("1h"), 10)


@query(
    "trailing_bars",
    with_ctes(
        f"""SELECT symbol, period, open_time, CASE WHEN rn - 1 > 5 THEN array_to_string(last, ' ') END AS closes
FROM (SELECT *, row_number() OVER {SERIES_WINDOW} AS rn,
  list(CAST(close_price AS VARCHAR)) OVER {frame('4 PRECEDING AND CURRENT ROW')} AS last FROM bars_1h)""",
        "bars_1h",
    ),
)
def trailing_bars(t: Tables):
    rows = windows.trailing_bars(t.bars("1h"), 5)
    closes = F.transform("trailing", lambda b: b["close_price"].cast("string"))
    return rows.select("symbol", "period", "open_time", F.array_join(closes, " ").alias("closes"))


SPLIT = 500


@query(
    "running_volume",
    with_ctes(
        f"""SELECT symbol, CAST(price AS DOUBLE) AS price, CAST(volume AS DOUBLE) AS volume, ptime,
  CAST(running AS DOUBLE) AS running_volume, CAST(round(running / {SPLIT}) AS INTEGER) AS part
FROM (SELECT *, sum(volume) OVER (PARTITION BY symbol ORDER BY price) AS running
  FROM (SELECT symbol, price, arg_max(volume, ptime) AS volume, max(ptime) AS ptime FROM book GROUP BY symbol, price))""",
        "book",
    ),
)
def running_volume(t: Tables):
    return books.running_volume(books.latest_levels(t.book), SPLIT)


PRESET_1M_AS_OF = "2001-01-04T00:00:00"
PRESET_1S_AS_OF = "2001-01-01T04:00:00"


def _preset_sql(source: str, as_of: str, back_ms: int, step_ms: int) -> str:
    first = to_epoch_ms(as_of) - back_ms - presets.BAND_BARS * step_ms
    return signals_sql(source, presets.BAND_BARS, presets.BAND_WIDTH, f"open_time >= {first}")


@query("preset_bollinger_1m", _preset_sql("line_bars_1m", PRESET_1M_AS_OF, S.DAY_MS, S.MINUTE_MS))
def preset_bollinger_1m(t: Tables):
    return presets.bollinger_1m(t.line_bars("1m"), PRESET_1M_AS_OF)


@query("preset_bollinger_1s", _preset_sql("line_bars_1s", PRESET_1S_AS_OF, 3 * S.HOUR_MS, 1000))
def preset_bollinger_1s(t: Tables):
    return presets.bollinger_1s(t.line_bars("1s"), PRESET_1S_AS_OF)


@query(
    "resample_by_count",
    with_ctes(
        f"""SELECT symbol, size, bar_index, open_time, close_time, num_trades, {as_double(
  'open_price', 'high_price', 'low_price', 'close_price', 'volume', 'quote_asset_volume',
  'taker_buy_base_asset_volume', 'taker_buy_quote_asset_volume')} FROM folded""",
        "minute_bars",
        extra={"folded": folded_sql()},
    ),
)
def resample_all(t: Tables):
    return resample_by_count(t.minute_bars)
