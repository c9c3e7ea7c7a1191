"""Catalogue refresh of both venues, from landed pages to staged rows, upsert and subscriptions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.functions.coerce import blank_to_null, to_double
from tradewatch.operators.numbering import numbered
from tradewatch.operators.once import computed_once
from tradewatch.operators.skew import first_per_key, salted_join
from tradewatch.operators.subscribe import open_tickers, tradable_markets
from tradewatch.operators.upsert import CLOSED, SETTLED, upsert
from tradewatch.session import stored
from tradewatch.sources.pages import event_markets, normalise_markets_a, normalise_markets_b, normalise_series


def traded_series(series_items: DataFrame) -> DataFrame:
    """Series items with lifetime volume above zero; missing or unreadable volume counts as zero."""
    parsed = computed_once(series_items, s=F.from_json("payload", "ticker string, volume_fp string"))
    volume = F.coalesce(F.expr(to_double("s.volume_fp")), F.lit(0.0))
    return parsed.filter(volume > 0).select(*series_items.columns, F.col("s.ticker").alias("series_ticker"))


def discover_markets(event_items: DataFrame, order: list[str]) -> DataFrame:
    """Markets nested in event items, each market id once: the first in discovery order counts.

    `order` names the columns that give the discovery order of event items (tag, page, position).
    Markets without an id are skipped.
    """
    markets = computed_once(
        event_markets(event_items), id=blank_to_null(F.from_json("payload", "id string")["id"])
    )
    return first_per_key(
        markets.filter(F.col("id").isNotNull()), ["id"], [F.col(c) for c in [*order, "market_position"]]
    )


def discovery_counts(found: DataFrame, levels: list[str]) -> DataFrame:
    """Counts per level and in total, in one pass; `level` says how many columns are filled."""
    grouped = found.rollup(*levels).agg(
        F.count(F.lit(1)).alias("n"), (F.lit(len(levels)) - F.bit_count(F.grouping_id())).cast("int").alias("level")
    )
    return grouped.select(*levels, "level", "n")


#: How a run stores what it has parsed, by name; all its outputs read that.
Stage = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class CatalogA:
    series: DataFrame
    markets: DataFrame
    subscriptions: DataFrame
    counts: DataFrame
    staged: DataFrame


def refresh_catalog_a(
    series_items: DataFrame,
    market_items: DataFrame,
    target: DataFrame,
    manual: DataFrame,
    as_of: datetime,
    stage: Stage = stored,
) -> CatalogA:
    """Venue-A refresh: series table, markets upsert frozen once settled, open tickers.

    `series_items` has category, position and payload, `market_items` series_ticker and payload.
    Markets are taken for series with volume, under the category the series was found in. Each payload is parsed once.
    """
    series = stage(normalise_series(series_items, more=[F.col("category").alias("found_in")]), "series")
    followed = series.filter(F.col("volume_fp") > 0).select(F.col("ticker").alias("series_ticker"), F.col("found_in").alias("category"))
    found = salted_join(market_items.drop("category"), followed, ["series_ticker"])
    staged = stage(normalise_markets_a(found), "markets")
    return CatalogA(
        series=series.drop("found_in"),
        markets=upsert(target, staged, ["source", "ticker"], as_of, SETTLED),
        subscriptions=open_tickers(staged, manual),
        counts=discovery_counts(staged, ["category", "series_ticker"]),
        staged=staged,
    )


@dataclass(frozen=True)
class CatalogB:
    markets: DataFrame
    counts: DataFrame
    staged: DataFrame
    order: tuple[str, ...]

    @property
    def subscriptions(self) -> DataFrame:
        """Tradable tokens with their place in discovery order: of markets that share a token the later one counts."""
        tradable = tradable_markets(self.staged).select(F.col("market_id").alias("id"), "yes_token_id", "no_token_id")
        placed = tradable.join(self.staged.select("id", *self.order, "market_position"), "id")
        found = numbered(placed, [*self.order, "market_position"], name="__place")
        return found.select(F.col("id").alias("market_id"), "yes_token_id", "no_token_id", F.col("__place").alias("position"))


def refresh_catalog_b(
    event_items: DataFrame,
    target: DataFrame,
    as_of: datetime,
    order: tuple[str, ...] = ("tag_position", "page", "position"),
    stage: Stage = stored,
) -> CatalogB:
    """Venue-B refresh: first-found markets, upsert frozen once closed, tradable tokens. The feed is parsed once."""
    found = discover_markets(event_items, list(order))
    staged = stage(normalise_markets_b(found, more=[F.col(c) for c in (*order, "market_position")]), "markets")
    return CatalogB(
        markets=upsert(target, staged.select(*schemas.MARKETS_B_STAGED.names), ["source", "id"], as_of, CLOSED),
        counts=discovery_counts(staged, [order[0]]),
        staged=staged,
        order=order,
    )
