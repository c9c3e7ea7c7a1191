"""Landed catalogue pages and the normalisation of their items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch import fixed, schemas
from tradewatch.functions.coerce import (
    blank_to_null,
    coerce,
    json_object,
    parse_schema,
    tag_slugs,
    text_array_item,
    to_double,
)
from tradewatch.operators.once import computed_once


def read_pages(spark: SparkSession, path: str, items_key: str, tags: str) -> DataFrame:
    """Items of landed JSON pages: the folder columns named in `tags`, `position`, `payload`.

    `tags` is a DDL list of the folders' partition columns, such as ``category string, page int``.
    Pages without a list yield no rows.
    """
    names = [part.split()[0] for part in tags.split(",")]
    pages = spark.read.schema(f"`{items_key}` array<string>, {tags}").option("multiLine", True).json(path)
    return pages.select(*names, F.posexplode(F.col(items_key)).alias("position", "payload"))


def event_markets(events: DataFrame) -> DataFrame:
    """Flatten event payloads (column `payload`) to one row per nested market.

    Keeps all other columns; adds `event` (the event's own payload), `market_position` and the
    market's `payload`.
    """
    others = [c for c in events.columns if c != "payload"]
    nested = F.from_json("payload", "markets array<string>")["markets"]
    return events.select(
        *others, F.col("payload").alias("event"), F.posexplode(nested).alias("market_position", "payload")
    )


def _from_fields(parsed: str, fields) -> list[Column]:
    return [F.expr(f"{coerce(f'{parsed}.`{name}`', kind)} AS `{column}`") for name, column, kind in fields]


def normalise_markets_a(items: DataFrame, source: str = "venue_a") -> DataFrame:
    """Venue-A market payloads (`payload`, `series_ticker`, `category`) as staged market rows."""
    fields = [("ticker", "ticker", "text"), *[(name, name, kind) for name, kind in fixed.MARKET_A_FIELDS]]
    parsed = computed_once(items, p=json_object(F.col("payload"), parse_schema([(f, k) for f, _, k in fields])))
    return parsed.select(F.lit(source).alias("source"), "series_ticker", "category", *_from_fields("p", fields)).select(
        *schemas.MARKETS_A_STAGED.fieldNames()
    )


def normalise_series(items: DataFrame, source: str = "venue_a", more: Sequence[Column] = ()) -> DataFrame:
    """Series payloads (`payload`, `category` = the queried category) as series rows, with `more` columns over `items`."""
    fields = [("ticker", "ticker", "text"), *[(name, name, kind) for name, kind in fixed.SERIES_FIELDS]]
    wanted = parse_schema([("category", "text"), *[(f, k) for f, _, k in fields]])
    parsed = computed_once(items, p=json_object(F.col("payload"), wanted))
    return parsed.select(
        F.lit(source).alias("source"),
        F.coalesce(blank_to_null(F.col("p.category")), F.col("category")).alias("category"),
        *_from_fields("p", fields),
        F.struct(F.lit(0).alias("none"), *more).alias("__more"),
    ).select(*[c for c in schemas.SERIES.fieldNames() if c != "resolved_at"], "__more.*").drop("none")


def normalise_markets_b(items: DataFrame, source: str = "venue_b", more: Sequence[Column] = ()) -> DataFrame:
    """Venue-B market payloads (`payload`, `event`) as staged market rows, with `more` columns over `items`.

    The two outcomes become parallel YES/NO columns, taken from JSON array texts.
    """
    own = [
        ("outcomes", "outcomes_raw", "only_text"),
        ("outcomePrices", "outcome_prices_raw", "only_text"),
        ("clobTokenIds", "clob_token_ids_raw", "only_text"),
    ]
    wanted = parse_schema([(name, kind) for name, _, kind in [*own, *fixed.MARKET_B_FIELDS]])
    parsed = computed_once(
        items,
        p=json_object(F.col("payload"), wanted),
        ev=json_object(F.col("event"), "id string, ticker string, slug string, title string, tags string"),
    ).select("p", "ev", *_from_fields("p", own), F.struct(F.lit(0).alias("none"), *more).alias("__more"))
    return parsed.select(
        F.lit(source).alias("source"),
        F.col("ev.id").alias("event_id"),
        F.col("ev.ticker").alias("event_ticker"),
        F.col("ev.slug").alias("event_slug"),
        F.col("ev.title").alias("event_title"),
        tag_slugs(F.col("ev.tags")).alias("event_tag_slugs"),
        *[column for _, column, _ in own],
        F.expr(text_array_item("clob_token_ids_raw", 1)).alias("yes_token_id"),
        F.expr(text_array_item("clob_token_ids_raw", 2)).alias("no_token_id"),
        F.expr(to_double(text_array_item("outcome_prices_raw", 1))).alias("yes_price"),
        F.expr(to_double(text_array_item("outcome_prices_raw", 2))).alias("no_price"),
        *_from_fields("p", fixed.MARKET_B_FIELDS),
        "__more",
    ).select(*schemas.MARKETS_B_STAGED.fieldNames(), "__more.*").drop("none")
