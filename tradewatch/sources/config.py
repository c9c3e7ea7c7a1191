"""The small hand-edited intent file, read on the driver."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.functions.coerce import blank_to_null
from tradewatch.operators.once import computed_once


@dataclass(frozen=True)
class Intent:
    """Which markets to follow and whether follow-up debates are published."""

    categories: tuple[str, ...] = ()
    tickers: tuple[str, ...] = ()
    tag_slugs: tuple[str, ...] = ()
    debates_enabled: bool = False
    debates_auto_publish: bool = True


def read_intent(spark: SparkSession, path: str, venue_a: str = "venue_a", venue_b: str = "venue_b") -> Intent:
    """Read one JSON or YAML intent file; absent sections take their defaults."""
    text = spark.read.option("wholetext", True).text(path).first()["value"]
    try:
        data = json.loads(text)
    except ValueError:
        import yaml

        data = yaml.safe_load(text)
    data = data or {}
    a, b, d = (data.get(key) or {} for key in (venue_a, venue_b, "debater"))
    return Intent(
        categories=tuple(a.get("categories") or ()),
        tickers=tuple(a.get("tickers") or ()),
        tag_slugs=tuple(b.get("tag_slug") or ()),
        debates_enabled=bool(d.get("enabled", False)),
        debates_auto_publish=bool(d.get("auto_publish", True)),
    )


def valid_subscriptions(items: DataFrame) -> DataFrame:
    """Token subscriptions out of JSON texts (`payload`): objects with three non-empty ids."""
    names = ["market_id", "yes_token_id", "no_token_id"]
    fields = F.when(
        F.ltrim("payload").startswith("{"),
        F.from_json("payload", ", ".join(f"{n} string" for n in names)),
    )
    rows = computed_once(items, s=fields)
    kept = F.lit(True)
    for name in names:
        kept = kept & blank_to_null(F.col(f"s.{name}")).isNotNull()
    others = [c for c in items.columns if c != "payload"]
    return rows.filter(kept).select(*others, *[F.col(f"s.{n}").alias(n) for n in names])
