"""The scalar functions as temporary SQL functions, for use in ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# name(parameters) -> type: expression. Lengths of 1, 7 and 30 days mean day, week and month.
_FUNCTIONS = {
    "ms2ts(ms BIGINT) RETURNS TIMESTAMP": "timestamp_millis(ms)",
    "tstz(ms BIGINT) RETURNS TIMESTAMP": "timestamp_millis(ms)",
    "ts2ms(ts TIMESTAMP) RETURNS BIGINT": "(unix_micros(ts) + IF(unix_micros(ts) >= 0, 500, -500)) div 1000",
    "dayago(as_of TIMESTAMP DEFAULT current_timestamp()) RETURNS TIMESTAMP": "as_of - INTERVAL 1 DAY",
    "weekago(as_of TIMESTAMP DEFAULT current_timestamp()) RETURNS TIMESTAMP": "as_of - INTERVAL 7 DAYS",
    "trading_signal(prev DOUBLE, last DOUBLE, lower_band DOUBLE, upper_band DOUBLE) RETURNS STRING": (
        "CASE WHEN prev <= lower_band AND last > lower_band THEN 'BUY' "
        "WHEN prev >= upper_band AND last < upper_band THEN 'SELL' END"
    ),
    "start_of_period(ts TIMESTAMP, duration INTERVAL DAY TO SECOND) RETURNS TIMESTAMP": """CASE duration
        WHEN INTERVAL '1' DAY THEN date_trunc('day', ts)
        WHEN INTERVAL '7' DAY THEN date_trunc('week', ts)
        WHEN INTERVAL '30' DAY THEN date_trunc('month', ts)
        ELSE timestamp_micros(unix_micros(ts) - pmod(
          unix_micros(ts) - unix_micros(TIMESTAMP '2001-01-01 00:00:00Z'),
          unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + duration))) END""",
}


def register_functions(spark: SparkSession) -> None:
    """Create the functions in this session (replacing those of the same name)."""
    for signature, expression in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {expression}")


def register_symbol_lookup(spark: SparkSession, instruments: DataFrame) -> None:
    """``get_symbol_id(symbol)``: id of a symbol text in any case, NULL when unknown.

    A scalar subquery on ``instruments``, which Spark plans as a left join.
    """
    instruments.select("symbol", "symbol_id").createOrReplaceTempView("instrument_ids")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION get_symbol_id(name STRING) RETURNS INT "
        "RETURN SELECT max(i.symbol_id) FROM instrument_ids i WHERE i.symbol = upper(name)"
    )
