"""Trade ingest of both venues into one trades table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tradewatch.sources.frames import parse_frames_a, parse_frames_b


def ingest_trades(frames_a: DataFrame, frames_b: DataFrame, tokens: DataFrame, ingested_at: Column) -> DataFrame:
    return parse_frames_a(frames_a, ingested_at).unionByName(parse_frames_b(frames_b, tokens, ingested_at))
