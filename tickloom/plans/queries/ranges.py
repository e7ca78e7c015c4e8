"""The operators at the ends of their ranges: huge values, missing values, thresholds met exactly, missing orders."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas as S
from tickloom.functions.times import to_epoch_ms
from tickloom.operators import keyed, stats, windows
from tickloom.plans import indicators
from tickloom.plans.fixtures import AS_OF_EVENTS, Tables, with_ctes
from tickloom.plans.queries.base import as_double, query
from tickloom.plans.queries.windows import BANDS, bands_sql, frame

LARGE_BARS = "SELECT * REPLACE (CAST(close_price * 1000000 AS DECIMAL(28,8)) AS close_price) FROM bars_1h"


@query(
    "bollinger_large_prices",
    with_ctes(
        f"SELECT symbol, period, open_time, {as_double('close_price')}, {BANDS} FROM banded",
        "bars_1h",
        extra={"large": LARGE_BARS, "banded": bands_sql("large", 20, 1.0)},
    ),
)
def bollinger_large_prices(t: Tables):
    """Closes to 5e8."""
    rows = t.bars("1h").withColumn("close_price", (F.col("close_price") * 1_000_000).cast(S.PRICE))
    return windows.bollinger_bands(rows, bandwidth=1.0, n=20)


MISSING = "open_time // 3600000 % 7 = 0"


@query(
    "bollinger_missing_closes",
    with_ctes(
        f"""SELECT symbol, period, open_time, {as_double('close_price')},
  CAST(s1 AS DOUBLE) * 1e6 / (m * 1e8) AS middle_band,
  sqrt(CAST((m * s2 - s1 * s1) * 1000000000000 AS DOUBLE) / (CAST(m AS DOUBLE) * m * 1e16)) AS standard_deviation
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, period ORDER BY open_time) AS rn,
    count(cents) OVER {frame('19 PRECEDING AND CURRENT ROW')} AS m,
    sum(cents) OVER {frame('19 PRECEDING AND CURRENT ROW')} AS s1,
    sum(cents * cents) OVER {frame('19 PRECEDING AND CURRENT ROW')} AS s2
  FROM (SELECT *, CAST(close_price * 100 AS HUGEINT) AS cents
    FROM (SELECT * REPLACE (CASE WHEN {MISSING} THEN NULL ELSE close_price END AS close_price) FROM bars_1h)))
WHERE rn >= 20""",
        "bars_1h",
    ),
)
def bollinger_missing_closes(t: Tables):
    """One close of seven hours is NULL and counts as no value."""
    gone = F.expr("open_time div 3600000 % 7 = 0")
    rows = t.bars("1h").withColumn("close_price", F.when(~gone, F.col("close_price")))
    bands = windows.bollinger_bands(rows, bandwidth=1.0, n=20)
    return bands.select("symbol", "period", "open_time", "close_price", "middle_band", "standard_deviation")


@query(
    "stats_large_volumes",
    with_ctes(
        f"""SELECT symbol, count(*) AS count, CAST((sum(cents) + 50) // 100 AS DOUBLE) AS total_amount,
  CAST((2 * sum(cents) + 100 * count(*)) // (200 * count(*)) AS DOUBLE) AS avg_per_day,
  CAST((max(cents) + 50) // 100 AS DOUBLE) AS max_per_day
FROM (SELECT symbol, CAST(volume AS HUGEINT) * 1000000000000000 * CAST(close_price * 100 AS HUGEINT) AS cents
  FROM bars_1d WHERE open_time > {to_epoch_ms(AS_OF_EVENTS) - 30 * S.DAY_MS}) GROUP BY symbol""",
        "bars_1d",
    ),
)
def stats_large_volumes(t: Tables):
    """Volumes of 1e19 and more: those of a day of many ticks lie beyond the type of the bar table."""
    scale = F.lit(10**15).cast("decimal(16,0)")
    rows = t.bars("1d").withColumn("volume", (F.col("volume").cast("decimal(12,0)") * scale).cast("decimal(32,8)"))
    found = stats.daily_stats(rows, AS_OF_EVENTS)
    return found.select("symbol", "count", "total_amount", "avg_per_day", "max_per_day")


# 5 % of 100 000 - event_id % 2 units: every other move is exactly at the threshold, the rest just below it.
@query(
    "direction_at_threshold",
    """SELECT event_id AS open_time, CASE WHEN event_id % 4 = 1 THEN 'SELL' ELSE 'BUY' END AS trade_signal
FROM events WHERE event_id > (SELECT min(event_id) FROM events) AND event_id % 2 = 1
  AND event_id - 1 IN (SELECT event_id FROM events)""",
)
def direction_at_threshold(t: Tables):
    """One series of events: each odd one moves by exactly 5 % of itself, each even one by a little less."""
    step = F.col("event_id") % 4
    # 95 -> 100 is +5 % of 100; 105 -> 100 is -5 % of 100
    close = F.when(step == 0, 105).when(step == 1, 100).when(step == 2, F.lit(95)).otherwise(100)
    bars = t.read("events").select(
        F.lit("x").alias("symbol"),
        F.lit("1s").alias("period"),
        F.col("event_id").alias("open_time"),
        close.cast(S.PRICE).alias("close_price"),
        F.col("event_id").cast("decimal(28,8)").alias("volume"),
    )
    # ids are no grid of seconds, so their chunks are runs of ids
    found = windows.direction_spikes(bars, increase=0.05, chunk=F.floor(F.col("open_time") / 4096))
    return found.select(F.unix_millis("open_time").alias("open_time"), "trade_signal").where("open_time % 2 = 1")


ORDER_TYPES = {"int": "cast(event_id as int)", "bigint": "event_id", "timestamp": "timestamp_seconds(event_id)"}


@query(
    "upsert_missing_orders",
    f"""WITH incoming AS (
  SELECT event_id AS k, CAST(value AS DOUBLE) AS price, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS o
  FROM events WHERE event_id % 5 <> 0
  UNION ALL SELECT event_id, CAST(value AS DOUBLE) + 1, event_id + 1 FROM events WHERE event_id % 7 = 0),
newest AS (SELECT k, arg_max(price, coalesce(o, -1)) AS price FROM incoming GROUP BY k),
merged AS (SELECT k, price FROM newest UNION ALL
  SELECT event_id, -1.0 FROM events WHERE event_id % 2 = 0 AND event_id NOT IN (SELECT k FROM newest))
SELECT kind, k, price FROM merged, (VALUES {', '.join(f"('{k}')" for k in [*ORDER_TYPES, 'composite'])}) v(kind)""",
)
def upsert_missing_orders(t: Tables):
    """The same rows whatever the type of the order, NULL orders included."""
    events = t.read("events")
    price = F.col("value").cast("double")
    existing = events.where("event_id % 2 = 0").select(F.col("event_id").alias("k"), F.lit(-1.0).alias("price"))
    first = events.where("event_id % 5 <> 0").select(
        F.col("event_id").alias("k"), price.alias("price"), F.expr("CASE WHEN event_id % 3 <> 0 THEN event_id END").alias("event_id")
    )
    second = events.where("event_id % 7 = 0").select(
        F.col("event_id").alias("k"), (price + 1).alias("price"), (F.col("event_id") + 1).alias("event_id")
    )
    incoming = first.unionByName(second)
    merged = None
    for kind, order in [*ORDER_TYPES.items(), ("composite", None)]:
        columns = {"o": F.expr(order)} if order else {"o": F.col("event_id") * 0, "p": F.col("event_id")}
        found = keyed.upsert(existing, incoming.withColumns(columns), ["k"], list(columns))
        found = found.withColumn("kind", F.lit(kind))
        merged = found if merged is None else merged.unionByName(found)
    return merged


@query(
    "price_period_dim",
    f"""SELECT event_type AS symbol, suffix, duration_ms, duration_months,
  (last - first) // duration_ms + 1 AS periods_spanned
FROM (SELECT event_type, epoch_ms(min(ts)) AS first, epoch_ms(max(ts)) AS last FROM events GROUP BY event_type),
  (VALUES {', '.join(map(str, S.PRICE_PERIODS))}) p(suffix, duration_ms, duration_months)""",
)
def price_period_dim(t: Tables):
    span = t.ticks.groupBy("symbol").agg(F.unix_millis(F.min("ts")).alias("first"), F.unix_millis(F.max("ts")).alias("last"))
    named = span.withColumn("suffix", F.explode(F.array(*[F.lit(n) for n, _, _ in S.PRICE_PERIODS])))
    rows = named.join(F.broadcast(S.price_period_dim(t.spark)), "suffix")  # eight rows
    return rows.selectExpr(
        "symbol", "suffix", "duration_ms", "duration_months", "(last - first) div duration_ms + 1 AS periods_spanned"
    )


@query(
    "pandas_indicator",
    with_ctes(
        f"""SELECT symbol, open_time, CAST(max(close_price) OVER {frame('4 PRECEDING AND CURRENT ROW')} AS DOUBLE) AS highest
FROM bars_1h""",
        "bars_1h",
    ),
)
def pandas_indicator(t: Tables):
    """A user's indicator: the highest of the last five closes."""

    def highest(bars):
        return bars["close_price"].astype(float).rolling(5, min_periods=1).max()

    made = indicators.pandas_indicator(highest, 5, "highest", T.DoubleType())
    return made(t.bars("1h")).select("symbol", "open_time", "highest")
