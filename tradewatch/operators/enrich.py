"""Market titles, series and volumes by market id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.functions.text import title_from_slug
from tradewatch.operators.skew import salted_join


def market_profile(
    markets: DataFrame, markets_a: DataFrame, markets_b: DataFrame, series: DataFrame, volume_scale: float = 100.0
) -> DataFrame:
    """Titles, series and volumes of the markets named in `markets`, one row each.

    Meant for the few markets that have a candidate: both dimensions are reduced to those before anything is joined.
    Venue A wins where both dimensions know the market. The scale applies to venue-A volumes.
    """
    keyed = markets.select("market_id").filter(F.col("market_id").isNotNull()).distinct()
    markets_a = markets_a.join(keyed, F.col("ticker") == F.col("market_id"), "left_semi")
    markets_b = markets_b.join(keyed, F.col("id") == F.col("market_id"), "left_semi")
    titled_series = series.select(F.col("ticker").alias("a_series"), F.col("title").alias("a_series_title"))
    side_a = salted_join(
        markets_a.select(
            F.col("ticker").alias("market_id"),
            F.col("series_ticker").alias("a_series"),
            F.col("title").alias("a_title"),
            (F.col("volume_fp") * volume_scale).alias("a_volume"),
            (F.col("volume_24h_fp") * volume_scale).alias("a_volume_24h"),
        ),
        titled_series,
        ["a_series"],
        "left",
    )
    side_b = markets_b.select(
        F.col("id").alias("market_id"),
        F.col("event_ticker").alias("b_series"),
        F.col("event_title").alias("b_series_title"),
        title_from_slug(F.col("slug")).alias("b_title"),
        F.col("volume").alias("b_volume"),
        F.col("volume_24h").alias("b_volume_24h"),
    )
    pairs = {
        "series_ticker": ("a_series", "b_series"),
        "series_title": ("a_series_title", "b_series_title"),
        "title": ("a_title", "b_title"),
        "volume": ("a_volume", "b_volume"),
        "volume_24h": ("a_volume_24h", "b_volume_24h"),
    }
    return (
        keyed.join(side_a, "market_id", "left")
        .join(side_b, "market_id", "left")
        .select(*keyed.columns, *[F.coalesce(a, b).alias(name) for name, (a, b) in pairs.items()])
    )
