"""Registered queries on catalogue pages, upserts and subscriptions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch import fixed, schemas
from tradewatch.operators.subscribe import delta_counts, open_tickers, subscription_delta, tradable_markets
from tradewatch.operators.upsert import CLOSED, SETTLED, upsert
from tradewatch.plans.catalog import (
    discover_markets,
    discovery_counts,
    refresh_catalog_a,
    refresh_catalog_b,
    traded_series,
)
from tradewatch.queries import payloads, views
from tradewatch.queries.shape import r6, r6_sql, wall
from tradewatch.session import shared_folder
from tradewatch.sources.buckets import read_buckets, upsert_buckets
from tradewatch.sources.pages import normalise_markets_a, normalise_markets_b, normalise_series, read_pages

_A = [("ticker", "ticker", "text"), *[(name, name, kind) for name, kind in fixed.MARKET_A_FIELDS]]
_B = list(fixed.MARKET_B_FIELDS)
_S = [("ticker", "ticker", "text"), *[(name, name, kind) for name, kind in fixed.SERIES_FIELDS]]


_RUN = datetime(2024, 2, 1)


def _zoneless(df: DataFrame) -> DataFrame:
    return df.select(*[wall(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes])


def _markets_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.spread_table(spark, sf_dir, "part", "p_partkey").select(
        payloads.render(_A, "p_partkey").alias("payload"),
        F.col("p_brand").alias("series_ticker"),
        F.col("p_type").alias("category"),
    )
    return _zoneless(normalise_markets_a(items))


_EVENT = """concat('{"id": ', c_nationkey, ', "ticker": "n', c_nationkey, '", "slug": "s", "title": "N", "tags": [',
  '{"slug": "politics"}, {"slug": ""}, 5, {"label": "x"}, {"slug": "', lower(c_mktsegment), '"}]}')"""
_OUTCOMES = r"""concat('"outcomes": "[\\"Yes\\",\\"No\\"]", "outcomePrices": ',
  CASE c_custkey % 4 WHEN 0 THEN '"[\\"0.42\\",\\"0.58\\"]"' WHEN 1 THEN '"[\\"0.42\\"]"'
    WHEN 2 THEN '["0.42","0.58"]' ELSE '"not json"' END,
  ', "clobTokenIds": ', CASE c_custkey % 3 WHEN 0 THEN '"[]"'
    ELSE concat('"[\\"1', c_custkey, '\\", \\"2', c_custkey, '\\"]"') END)"""


def _markets_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.spread_table(spark, sf_dir, "customer", "c_custkey").select(
        payloads.render(_B, "c_custkey", _OUTCOMES).alias("payload"), F.expr(_EVENT).alias("event")
    )
    return _zoneless(normalise_markets_b(items))


def _series_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = """concat('"category": ', CASE s_suppkey % 3 WHEN 0 THEN '"own"' WHEN 1 THEN '""' ELSE 'null' END)"""
    return views.spread_table(spark, sf_dir, "supplier", "s_suppkey").select(
        payloads.render(_S, "s_suppkey", category).alias("payload"),
        F.concat(F.lit("c"), F.col("s_nationkey")).alias("category"),
    )


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(normalise_series(_series_items(spark, sf_dir)))


def _traded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traded_series(_series_items(spark, sf_dir)).select("series_ticker", "category")


def _event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stored event as a tagged page item that lists two markets and one without an id."""
    user = F.col("user_id")
    rest = [
        F.lit(False).alias("closed"),
        (user % 4 != 0).alias("acceptingOrders"),
        F.concat(F.lit('["y'), user, F.lit('","n'), user, F.lit('"]')).alias("clobTokenIds"),
    ]
    ids = [F.concat(F.lit("m"), user), F.lit(""), F.concat(F.lit("m"), user * 2)]
    markets = F.array(*[F.struct(x.alias("id"), *rest) for x in ids])
    tags = F.array(*[F.lit(t) for t in ("view", "click", "purchase", "signup", "error")])
    tag = F.array_position(tags, F.col("event_type"))
    return views.table(spark, sf_dir, "events").select(
        "event_type",
        tag.alias("tag_position"),
        F.floor(F.col("event_id") / 500).alias("page"),
        (F.col("event_id") % 500).alias("position"),
        F.to_json(F.struct(F.col("event_id").alias("id"), markets.alias("markets"))).alias("payload"),
    )


_DISCOVERY = ["tag_position", "page", "position"]


def _discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discover_markets(_event_items(spark, sf_dir), _DISCOVERY)
    return found.select("id", "tag_position", "page", "position", F.col("market_position").cast("bigint"))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.table(spark, sf_dir, "part").select(
        F.col("p_type").alias("category"), F.col("p_brand").alias("series_ticker")
    )
    return discovery_counts(found, ["category", "series_ticker"])


def _counts_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery_counts(discover_markets(_event_items(spark, sf_dir), _DISCOVERY), ["event_type"])


def _catalog(spark: SparkSession, sf_dir: str, key: str) -> tuple[DataFrame, DataFrame]:
    orders = views.table(spark, sf_dir, "orders")
    columns = [
        F.lit("venue").alias("source"),
        F.concat(F.lit("o"), F.col("o_orderkey")).alias(key),
        F.col("o_orderpriority").alias("title"),
        F.col("o_totalprice").alias("volume"),
    ]
    status = F.col("o_orderstatus")
    state = {
        "ticker": F.when(status == "F", F.col("o_orderdate")).alias("settlement_ts"),
        "id": F.when(status == "F", True).when(status == "O", False).alias("closed"),
    }[key]
    target = orders.filter(F.col("o_orderkey") % 3 != 0).select(
        *columns, state, F.lit("2020-01-01 00:00:00").cast("timestamp").alias("resolved_at")
    )
    staged = orders.filter(F.col("o_orderkey") % 2 == 0).select(
        *columns[:3], (F.col("o_totalprice") * 2).alias("volume"), state
    )
    return target, staged


def _upsert(spark: SparkSession, sf_dir: str, key: str, freeze: str) -> DataFrame:
    target, staged = _catalog(spark, sf_dir, key)
    return _zoneless(upsert(target, staged, ["source", key], _RUN, freeze))


def _upsert_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over one stored table: all of the target, the staged rows, and one row for which one bucket is written."""
    target, staged = _catalog(spark, sf_dir, "ticker")
    path, keys = shared_folder(spark, "markets"), ["source", "ticker"]
    one = target.groupBy("source").agg(F.min_by(F.struct(*staged.columns), "ticker").alias("s")).select("s.*")
    one = one.withColumn("title", F.lit("last"))
    for rows, at in ((target.drop("resolved_at"), datetime(2020, 1, 1)), (staged, _RUN), (one, datetime(2024, 3, 1))):
        upsert_buckets(rows, path, target.schema, keys, at, SETTLED)
    return _zoneless(read_buckets(spark, path, target.schema))


def _upsert_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, "ticker", SETTLED)


def _upsert_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, "id", CLOSED)


def _open(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    markets = orders.select(
        F.concat(F.lit("o"), F.col("o_custkey")).alias("ticker"),
        F.when(F.col("o_orderstatus") == "O", "active").otherwise("settled").alias("status"),
    )
    manual = views.table(spark, sf_dir, "supplier").select(F.concat(F.lit("o"), F.col("s_suppkey") * 7).alias("ticker"))
    return open_tickers(markets, manual)


def _tradable(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    markets = views.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), key).alias("id"),
        F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False).alias("closed"),
        F.when(key % 5 != 0, key % 2 == 0).alias("accepting_orders"),
        F.when(key % 7 != 0, F.concat(F.lit("y"), key)).alias("yes_token_id"),
        F.when(key % 11 == 0, "").otherwise(F.concat(F.lit("n"), key)).alias("no_token_id"),
    )
    return tradable_markets(markets)


def _sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = views.table(spark, sf_dir, "orders").select("o_orderstatus", F.col("o_custkey").alias("market_id"))
    return orders.filter(F.col("o_orderstatus") == "F"), orders.filter(F.col("o_orderstatus") == "O")


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscription_delta(*_sets(spark, sf_dir))


def _delta_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_counts(subscription_delta(*_sets(spark, sf_dir)))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as landed series pages of at most 1000 items, written, read back and normalised."""
    root = shared_folder(spark, "pages")
    key = F.col("c_custkey")
    item = F.struct(
        F.concat(F.lit("s"), key).alias("ticker"),
        F.col("c_name").alias("title"),
        F.col("c_acctbal").cast("string").alias("volume_fp"),
        F.array("c_mktsegment").alias("tags"),
    )
    pages = (
        views.table(spark, sf_dir, "customer")
        .groupBy(F.lower("c_mktsegment").alias("category"), F.floor(key / 1000).cast("int").alias("page"))
        .agg(F.array_sort(F.collect_list(item)).alias("series"))
        .select("category", "page", F.to_json(F.struct("series", F.lit("next").alias("cursor"))).alias("value"))
    )
    pages.write.partitionBy("category", "page").text(root)
    items = read_pages(spark, root, "series", "category string, page int")
    return normalise_series(items).select("source", "ticker", "category", "title", "tags", r6("volume_fp"))


def _refreshed_a(spark: SparkSession, sf_dir: str):
    """Parts as venue-A markets of the suppliers' series; every third is in the target already."""
    key = F.col("p_partkey")
    parts = views.spread_table(spark, sf_dir, "part", "p_partkey")
    market_items = parts.select(
        payloads.render(_A, "p_partkey").alias("payload"), F.concat(F.lit("ticker-"), key % 13).alias("series_ticker")
    )
    target = schemas.conform(
        parts.filter(key % 3 == 0).select(
            F.lit("venue_a").alias("source"),
            F.concat(F.lit("ticker-"), key).alias("ticker"),
            F.lit("old").alias("category"),
            F.when(key % 2 == 0, F.lit("2023-01-01 00:00:00").cast("timestamp")).alias("settlement_ts"),
            F.lit("2020-01-01 00:00:00").cast("timestamp").alias("resolved_at"),
        ),
        schemas.MARKETS_A,
    )
    manual = spark.createDataFrame([("manual-1",)], "ticker string")
    return refresh_catalog_a(_series_items(spark, sf_dir), market_items, target, manual, _RUN)


def _refresh_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(_refreshed_a(spark, sf_dir).markets)


def _refresh_a_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series, followed tickers and counts of the same run, one under the other."""
    found = _refreshed_a(spark, sf_dir)
    none = F.lit(None)
    series = found.series.select(F.lit("series").alias("output"), F.col("ticker").alias("name"), "category", none.cast("int").alias("level"), none.cast("bigint").alias("n"))
    followed = found.subscriptions.select(F.lit("ticker"), "ticker", none.cast("string"), none.cast("int"), none.cast("bigint"))
    return series.unionAll(followed).unionAll(found.counts.select(F.lit("count"), "series_ticker", "category", "level", "n"))


def _refreshed_b(spark: SparkSession, sf_dir: str):
    """Stored events as tagged pages; the markets found first, less those closed in the target."""
    items = _event_items(spark, sf_dir)
    target = schemas.conform(
        views.table(spark, sf_dir, "events")
        .select("user_id")
        .distinct()
        .select(
            F.lit("venue_b").alias("source"),
            F.concat(F.lit("m"), "user_id").alias("id"),
            F.lit("old").alias("event_id"),
            F.when(F.col("user_id") % 3 == 0, True).when(F.col("user_id") % 3 == 1, False).alias("closed"),
            F.lit("2020-01-01 00:00:00").cast("timestamp").alias("resolved_at"),
        ),
        schemas.MARKETS_B,
    )
    return refresh_catalog_b(items, target, _RUN)


def _refresh_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(_refreshed_b(spark, sf_dir).markets)


def _refresh_b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed_b(spark, sf_dir).subscriptions


def _refresh_b_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed_b(spark, sf_dir).counts


QUERIES = {
    "normalise_markets_a": _markets_a,
    "normalise_markets_b": _markets_b,
    "normalise_series": _series,
    "series_with_volume": _traded,
    "discover_dedup": _discover,
    "discovery_counts": _counts,
    "discovery_counts_by_tag": _counts_by_tag,
    "upsert_freeze_settled": _upsert_settled,
    "upsert_freeze_closed": _upsert_closed,
    "upsert_stored_runs": _upsert_runs,
    "subscriptions_open": _open,
    "subscriptions_tradable": _tradable,
    "subscription_delta": _delta,
    "subscription_delta_counts": _delta_counts,
    "landed_pages": _pages,
    "catalog_refresh_a": _refresh_a,
    "catalog_refresh_b": _refresh_b,
    "catalog_refresh_a_outputs": _refresh_a_outputs,
    "catalog_refresh_b_tokens": _refresh_b_tokens,
    "catalog_refresh_b_counts": _refresh_b_counts,
}


def _nulls(schema, present: set[str]) -> str:
    types = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}
    return "".join(
        f", CAST(NULL AS {types[f.dataType.simpleString()]}) AS {f.name}" for f in schema.fields if f.name not in present
    )


_SETTLED_SQL = "CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS settlement_ts"


def _upsert_sql(key: str, state: str, frozen: str) -> str:
    return f"""
WITH base AS (
  SELECT 'venue' AS source, 'o' || o_orderkey AS {key}, o_orderpriority AS title, o_totalprice AS volume, {state},
         o_orderkey % 3 <> 0 AS in_target, o_orderkey % 2 = 0 AS in_staged
  FROM orders
), picked AS (
  SELECT *, in_staged AND NOT (in_target AND {frozen}) AS taken FROM base WHERE in_target OR in_staged
)
SELECT source, {key}, title, CASE WHEN taken THEN volume * 2 ELSE volume END AS volume,
       {state.split(' AS ')[-1]},
       CASE WHEN taken THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2020-01-01 00:00:00' END AS resolved_at
FROM picked"""


_DISCOVER_SQL = """
WITH items AS (
  SELECT event_id, event_type, user_id,
         list_position(['view', 'click', 'purchase', 'signup', 'error'], event_type) AS tag_position,
         event_id // 500 AS page, event_id % 500 AS position
  FROM events
), markets AS (
  SELECT *, 'm' || user_id AS id, 0 AS market_position FROM items
  UNION ALL SELECT *, 'm' || (user_id * 2), 2 FROM items
), found AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY tag_position, page, position, market_position) AS rn
  FROM markets
)"""

_REFRESH_A_SQL = f"""
WITH followed AS (
  SELECT 'ticker-' || s_suppkey AS series_ticker, 'c' || s_nationkey AS category
  FROM supplier
  WHERE s_suppkey % 3 < 2 AND s_suppkey % 1000 + {[f for f, _, _ in _S].index("volume_fp")} > 0
), staged AS (
  SELECT 'venue_a' AS source, f.series_ticker, f.category, {payloads.expected_sql(_A, "p_partkey")}
  FROM part JOIN followed f ON f.series_ticker = 'ticker-' || (p_partkey % 13)
)"""

_REFRESH_B_SQL = f"""{_DISCOVER_SQL}, staged AS (
  SELECT 'venue_b' AS source, id, CAST(event_id AS VARCHAR) AS event_id, FALSE AS closed, user_id % 4 <> 0 AS accepting_orders,
         '["y' || user_id || '","n' || user_id || '"]' AS clob_token_ids_raw, 'y' || user_id AS yes_token_id, 'n' || user_id AS no_token_id,
         tag_position, page, position, market_position
  FROM found WHERE rn = 1
)"""


def _taken_sql(schema, key: str, frozen: str) -> str:
    """The rows after an upsert of `fresh` into `target`."""
    columns = [
        f"CASE WHEN s.{key} IS NOT NULL AND NOT coalesce({frozen}, FALSE) THEN s.{c} ELSE t.{c} END AS {c}" for c in schema.names
    ]
    return f"SELECT {', '.join(columns)} FROM fresh s FULL JOIN target t ON s.{key} = t.{key}"


ORACLES = {
    "normalise_markets_a": f"""
SELECT 'venue_a' AS source, p_brand AS series_ticker, p_type AS category, {payloads.expected_sql(_A, "p_partkey")}
FROM part""",
    "normalise_markets_b": f"""
SELECT 'venue_b' AS source, CAST(c_nationkey AS VARCHAR) AS event_id, 'n' || c_nationkey AS event_ticker,
       's' AS event_slug, 'N' AS event_title, '["politics","' || lower(c_mktsegment) || '"]' AS event_tag_slugs,
       '["Yes","No"]' AS outcomes_raw,
       CASE c_custkey % 4 WHEN 0 THEN '["0.42","0.58"]' WHEN 1 THEN '["0.42"]' WHEN 3 THEN 'not json' END
         AS outcome_prices_raw,
       CASE c_custkey % 3 WHEN 0 THEN '[]' ELSE '["1' || c_custkey || '", "2' || c_custkey || '"]' END
         AS clob_token_ids_raw,
       CASE WHEN c_custkey % 3 <> 0 THEN '1' || c_custkey END AS yes_token_id,
       CASE WHEN c_custkey % 3 <> 0 THEN '2' || c_custkey END AS no_token_id,
       CASE WHEN c_custkey % 4 < 2 THEN 0.42::DOUBLE END AS yes_price,
       CASE WHEN c_custkey % 4 = 0 THEN 0.58::DOUBLE END AS no_price,
       {payloads.expected_sql(_B, "c_custkey")}
FROM customer""",
    "normalise_series": f"""
SELECT 'venue_a' AS source, CASE s_suppkey % 3 WHEN 0 THEN 'own' ELSE 'c' || s_nationkey END AS category,
       {payloads.expected_sql(_S, "s_suppkey")}
FROM supplier""",
    "series_with_volume": f"""
SELECT 'ticker-' || s_suppkey AS series_ticker, 'c' || s_nationkey AS category
FROM supplier
WHERE s_suppkey % 3 < 2 AND s_suppkey % 1000 + {[f for f, _, _ in _S].index("volume_fp")} > 0""",
    "discover_dedup": f"""{_DISCOVER_SQL}
SELECT id, tag_position, page, position, market_position FROM found WHERE rn = 1""",
    "discovery_counts": """
SELECT p_type AS category, p_brand AS series_ticker,
       2 - (grouping(p_type) + grouping(p_brand)) AS level, count(*) AS n
FROM part GROUP BY ROLLUP (p_type, p_brand)""",
    "discovery_counts_by_tag": f"""{_DISCOVER_SQL}
SELECT event_type, 1 - grouping(event_type) AS level, count(*) AS n FROM found WHERE rn = 1
GROUP BY ROLLUP (event_type)""",
    "upsert_freeze_settled": _upsert_sql("ticker", _SETTLED_SQL, "settlement_ts IS NOT NULL"),
    "upsert_stored_runs": f"""
WITH second AS ({_upsert_sql("ticker", _SETTLED_SQL, "settlement_ts IS NOT NULL")}),
first AS (SELECT min('o' || o_orderkey) AS ticker FROM orders WHERE o_orderkey % 3 <> 0),
one AS (SELECT 'o' || o_orderkey AS ticker, o_totalprice AS volume FROM orders
        WHERE 'o' || o_orderkey = (SELECT ticker FROM first) AND o_orderstatus <> 'F')
SELECT s.source, s.ticker, CASE WHEN o.ticker IS NULL THEN s.title ELSE 'last' END AS title,
       CASE WHEN o.ticker IS NULL THEN s.volume ELSE o.volume END AS volume, s.settlement_ts,
       CASE WHEN o.ticker IS NULL THEN s.resolved_at ELSE TIMESTAMP '2024-03-01 00:00:00' END AS resolved_at
FROM second s LEFT JOIN one o ON o.ticker = s.ticker""",
    "upsert_freeze_closed": _upsert_sql(
        "id",
        "CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS closed",
        "coalesce(closed, FALSE)",
    ),
    "subscriptions_open": """
SELECT 'o' || o_custkey AS ticker FROM orders WHERE o_orderstatus = 'O'
UNION SELECT 'o' || (s_suppkey * 7) FROM supplier""",
    "subscriptions_tradable": """
SELECT 'o' || o_orderkey AS market_id, 'y' || o_orderkey AS yes_token_id, 'n' || o_orderkey AS no_token_id
FROM orders
WHERE o_orderstatus <> 'F' AND o_orderkey % 5 <> 0 AND o_orderkey % 2 = 0 AND o_orderkey % 7 <> 0
  AND o_orderkey % 11 <> 0""",
    "subscription_delta": """
WITH current AS (SELECT DISTINCT o_custkey AS market_id FROM orders WHERE o_orderstatus = 'F'),
     desired AS (SELECT DISTINCT o_custkey AS market_id FROM orders WHERE o_orderstatus = 'O')
SELECT market_id, 'added' AS change FROM (FROM desired EXCEPT FROM current)
UNION ALL SELECT market_id, 'removed' FROM (FROM current EXCEPT FROM desired)""",
    "subscription_delta_counts": """
WITH current AS (SELECT DISTINCT o_custkey AS market_id FROM orders WHERE o_orderstatus = 'F'),
     desired AS (SELECT DISTINCT o_custkey AS market_id FROM orders WHERE o_orderstatus = 'O'),
     counts AS (
  SELECT (SELECT count(*) FROM (FROM desired EXCEPT FROM current)) AS added,
         (SELECT count(*) FROM (FROM current EXCEPT FROM desired)) AS removed)
SELECT added, removed, added + removed > 0 AS changed FROM counts""",
    "landed_pages": f"""
SELECT 'venue_a' AS source, 's' || c_custkey AS ticker, lower(c_mktsegment) AS category, c_name AS title,
       '["' || c_mktsegment || '"]' AS tags, {r6_sql("c_acctbal", "volume_fp")}
FROM customer""",
    "catalog_refresh_a": f"""{_REFRESH_A_SQL}, target AS (
  SELECT 'venue_a' AS source, 'ticker-' || p_partkey AS ticker, 'old' AS category, TIMESTAMP '2020-01-01' AS resolved_at,
         CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2023-01-01' END AS settlement_ts
         {_nulls(schemas.MARKETS_A, {"source", "ticker", "category", "settlement_ts", "resolved_at"})}
  FROM part WHERE p_partkey % 3 = 0
), fresh AS (SELECT *, TIMESTAMP '2024-02-01' AS resolved_at FROM staged)
{_taken_sql(schemas.MARKETS_A, "ticker", "t.settlement_ts IS NOT NULL")}""",
    "catalog_refresh_a_outputs": f"""{_REFRESH_A_SQL}
SELECT 'series' AS output, 'ticker-' || s_suppkey AS name, CASE s_suppkey % 3 WHEN 0 THEN 'own' ELSE 'c' || s_nationkey END AS category,
       CAST(NULL AS INTEGER) AS level, CAST(NULL AS BIGINT) AS n
FROM supplier
UNION ALL SELECT 'ticker', 'manual-1', NULL, NULL, NULL
UNION ALL SELECT 'count', series_ticker, category, 2 - (grouping(category) + grouping(series_ticker)), count(*)
FROM staged GROUP BY ROLLUP (category, series_ticker)""",
    "catalog_refresh_b": f"""{_REFRESH_B_SQL}, target AS (
  SELECT DISTINCT 'venue_b' AS source, 'm' || user_id AS id, 'old' AS event_id, TIMESTAMP '2020-01-01' AS resolved_at,
         CASE user_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS closed
         {_nulls(schemas.MARKETS_B, {"source", "id", "event_id", "closed", "resolved_at"})}
  FROM events
), fresh AS (
  SELECT source, id, event_id, closed, accepting_orders, clob_token_ids_raw, yes_token_id, no_token_id, '[]' AS event_tag_slugs,
         TIMESTAMP '2024-02-01' AS resolved_at
         {_nulls(schemas.MARKETS_B, {"source", "id", "event_id", "closed", "accepting_orders", "clob_token_ids_raw", "yes_token_id", "no_token_id", "event_tag_slugs", "resolved_at"})}
  FROM staged
)
{_taken_sql(schemas.MARKETS_B, "id", "coalesce(t.closed, FALSE)")}""",
    "catalog_refresh_b_tokens": f"""{_REFRESH_B_SQL}
SELECT id AS market_id, yes_token_id, no_token_id,
       row_number() OVER (ORDER BY tag_position, page, position, market_position) - 1 AS position
FROM staged WHERE accepting_orders""",
    "catalog_refresh_b_counts": f"""{_REFRESH_B_SQL}
SELECT tag_position, 1 - grouping(tag_position) AS level, count(*) AS n FROM staged GROUP BY ROLLUP (tag_position)""",
}
