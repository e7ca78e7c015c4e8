"""Registry of indicators: name -> (bars, parameters) -> rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.operators.blocks import DEFAULT_BLOCKS, SERIES, Blocks, split_series
from tickloom.operators.crossover import mac_signals
from tickloom.operators.windows import bollinger_bands, direction_spikes, volume_spikes

Indicator = Callable[..., DataFrame]

_REGISTRY: dict[str, Indicator] = {
    "MAC": mac_signals,
    "Bollinger": bollinger_bands,
    "VolumeSpikes": volume_spikes,
    "DirectionSpikes": direction_spikes,
}


def register(name: str, indicator: Indicator) -> None:
    _REGISTRY[name] = indicator


def indicators() -> Iterator[str]:
    return iter(sorted(_REGISTRY))


def run(name: str, bars: DataFrame, **params) -> DataFrame:
    return _REGISTRY[name](bars, **params)


def pandas_indicator(
    function: Callable[[pd.DataFrame], pd.Series],
    look_back: int,
    column: str,
    data_type: T.DataType,
) -> Indicator:
    """Indicator from a pandas function over a run of bars in time order.

    The function gets one block of a series (a bounded number of bars) together
    with the ``look_back`` bars before it, and returns one value per bar; values
    of the borrowed bars are dropped. It may not look further back.
    """

    def indicator(bars: DataFrame, *, blocks: Blocks = DEFAULT_BLOCKS) -> DataFrame:
        cut = split_series(bars, before=look_back, blocks=blocks)
        schema = T.StructType([*cut.df.schema.fields, T.StructField(column, data_type)])

        def one_block(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("open_time", ignore_index=True)
            return pdf.assign(**{column: function(pdf)})

        rows = cut.df.groupBy(*SERIES, "_block").applyInPandas(one_block, schema)
        return cut.owned(rows)

    return indicator
