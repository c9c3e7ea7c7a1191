"""The scheduled jobs over one warehouse folder, for ``spark-submit`` or a scheduler's Python task.

    spark-submit tradewatch/jobs.py detect --root s3://bucket/warehouse --as-of 2024-06-01T12:00:00

The folder holds the landed inputs (`landed/<name>/run=<microseconds>/...`) and every table the jobs keep. A job takes what
landed since it last finished. A job run again for the same moment replaces what it wrote for it.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch import schemas
from tradewatch.functions.coerce import instant, micros_of
from tradewatch.operators.upsert import CLOSED, SETTLED
from tradewatch.plans.accounting import debate_accounts, debate_rows
from tradewatch.plans.cells import cells_path, merge_cells, store_cells
from tradewatch.plans.catalog import refresh_catalog_a, refresh_catalog_b
from tradewatch.plans.detect import DetectParams, detect_anomalies
from tradewatch.plans.ingest import ingest_trades
from tradewatch.plans.notify import debate_requests, notifications, sent_state, with_state
from tradewatch.plans.pending import (
    admitted,
    handed_out,
    recent_after,
    settled,
    still_open,
    told_threads,
    waiting,
)
from tradewatch.plans.requests import (
    cached_rows,
    command_requests,
    fresh_runs,
    recent_debates,
    reuse_lookup,
    valid_requests,
)
from tradewatch.session import prepare
from tradewatch.sources.buckets import read_buckets, upsert_buckets
from tradewatch.sources.config import read_intent
from tradewatch.sources.packed import pack, read_packed
from tradewatch.sources.pages import read_pages
from tradewatch.sources.register import NOTES, kept_notes, notes_table, read_batches, unseen
from tradewatch.sources.tables import (
    BATCH,
    STATE,
    append_alerts,
    append_debates,
    append_state,
    append_threads,
    append_trades,
    outbox,
    read_if_there,
    read_parts,
    read_subscriptions,
    refresh_series,
    replace_subscriptions,
    thread_bucket,
    write_parts,
    write_table,
)

_DELIVERIES = "alert_id string, thread_id string, ok boolean"
_COMMANDS = "command_id string, thread_id string, question string"
_RUNS = (
    "debate_id string, alert_id string, source string, series_ticker string, market_id string, title string,"
    " started_at timestamp, finished_at timestamp, thread_id string"
)
_PENDING = {"open": schemas.PENDING, "seen": NOTES, "recent": schemas.RECENT_THREADS}
#: Folders of runs are told apart by their leading digits: 10^11 microseconds, some 28 hours.
_DAY_DIGITS = 11
_DAY = 10**_DAY_DIGITS
_FINISHED = T.StructType().add("number", T.LongType())


@dataclass(frozen=True)
class Warehouse:
    """The tables below one folder."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def trades(self) -> DataFrame:
        """The trades of all finished batches, packed or not."""
        path = self.path("trades")
        return read_packed(self.spark, path, schemas.TRADES, "trade_date", cells_path(path))

    def alerts(self) -> DataFrame:
        """All alerts, with who was told of them."""
        alerts = read_packed(self.spark, self.path("alerts"), schemas.ALERTS, "detected_date")
        return with_state(alerts, self.state())

    def state(self) -> DataFrame:
        return read_if_there(self.spark, self.path("alert_state"), STATE, f"{BATCH} string, notified_date date")

    def pending(self, as_of: datetime) -> dict[str, DataFrame]:
        """The open set of alerts before this run, the batches it has taken in, and the threads of late."""
        return read_parts(self.spark, self.path("pending"), _PENDING, as_of)

    def threads(self, wanted: DataFrame) -> DataFrame:
        """The threads with sent alerts that `wanted` (thread_id) may ask for; only their folders are read."""
        told = read_if_there(self.spark, self.path("threads"), schemas.THREADS, f"{BATCH} string, thread_bucket int")
        buckets = wanted.select(thread_bucket(F.col("thread_id")).alias("b")).distinct().collect()
        return told.filter(F.col("thread_bucket").isin([r["b"] for r in buckets]))

    def debates(self) -> DataFrame:
        return read_if_there(self.spark, self.path("debates"), schemas.DEBATES, f"{BATCH} string, started_date date")

    def since(self, job: str, as_of: datetime) -> int:
        """When the job last finished before this run, in microseconds; 0 if never."""
        done = read_if_there(self.spark, self.path("runs"), _FINISHED, "job string, finished bigint")
        last = done.filter((F.col("job") == job) & (F.col("finished") < micros_of(as_of))).agg(F.max("finished").alias("at"))
        return last.first()["at"] or 0

    def finish(self, job: str, as_of: datetime) -> None:
        """Note that the run is over; only then do later runs begin behind it. A run that broke off begins anew."""
        number = micros_of(as_of)
        row = self.spark.createDataFrame([(number,)], _FINISHED).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.path('runs')}/job={job}/finished={number}")

    def landed(self, name: str, job: str, as_of: datetime, newest: bool = False) -> list[str] | None:
        """The folders `landed/<name>/run=<microseconds>` that belong to this run: landed behind the last run of the job
        and not after this one. None if there are none."""
        low, high = self.since(job, as_of), micros_of(as_of)
        runs = [x for x in self._runs(f"landed/{name}", low, high) if low < x <= high]
        return [self.path(f"landed/{name}/run={x}") for x in (runs[-1:] if newest else runs)] or None

    def batches(self, name: str, job: str, as_of: datetime) -> DataFrame:
        """The rows of a table's batches that belong to this run of the job, with their batch."""
        low, high = self.since(job, as_of), micros_of(as_of)
        at = F.regexp_extract(F.col(BATCH), "^r([0-9]+)", 1).cast("bigint")
        try:
            rows = self.spark.read.parquet(self.path(name))
        except AnalysisException:
            return self.spark.createDataFrame([], f"{BATCH} string")
        return rows.filter((at > low) & (at <= high))

    def _runs(self, name: str, low: int, high: int) -> list[int]:
        """The numbers of the folders `run=<microseconds>` below, of the days from `low` to `high`: what landed on earlier days
        is not listed again. Names only, no file is opened."""
        days = range(low // _DAY, high // _DAY + 1) if low >= 10 * _DAY else []
        names = ",".join(f"{day}{'?' * _DAY_DIGITS}" for day in days) or "*"
        files = self.spark.read.format("binaryFile").option("basePath", self.path(name))
        try:
            found = files.load(f"{self.path(name)}/run={{{names}}}").select("run").distinct().collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(int(r["run"]) for r in found)

    def markets_a(self, before: datetime | None = None) -> DataFrame:
        return read_buckets(self.spark, self.path("markets_a"), schemas.MARKETS_A, before)

    def markets_b(self, before: datetime | None = None) -> DataFrame:
        return read_buckets(self.spark, self.path("markets_b"), schemas.MARKETS_B, before)

    def series(self) -> DataFrame:
        return read_if_there(self.spark, self.path("series"), schemas.SERIES)

    def subscriptions(self) -> DataFrame:
        return read_subscriptions(self.spark, self.path("subscriptions"))


def _stamped(as_of: datetime) -> str:
    return f"r{micros_of(as_of)}"


def ingest(w: Warehouse, as_of: datetime) -> None:
    """The frames that landed since the last run into the trades table; `streaming.jobs` keeps doing so."""
    tokens = w.subscriptions().filter("yes_token_id IS NOT NULL")
    frames = [w.landed(f"frames_{v}", "ingest", as_of) for v in "ab"]
    text = [w.spark.createDataFrame([], "value string") if f is None else w.spark.read.text(f) for f in frames]
    append_trades(ingest_trades(*text, tokens, instant(as_of)), w.path("trades"), _stamped(as_of))
    store_cells(w.spark, w.path("trades"), _stamped(as_of))
    w.finish("ingest", as_of)


def compact(w: Warehouse, as_of: datetime) -> None:
    """Merge the baseline cells of the batches since the last time."""
    merge_cells(w.spark, w.path("trades"), as_of)


def pack_batches(w: Warehouse, as_of: datetime) -> None:
    """Copy the batches of trades and alerts that were noted since the last time into packs of even files; once a day is enough."""
    trades, alerts = w.path("trades"), w.path("alerts")
    pack(w.spark, trades, schemas.TRADES, "trade_date", ["source", "market_id", "ts"], as_of, cells_path(trades))
    pack(w.spark, alerts, schemas.ALERTS, "detected_date", ["source", "market_id", "alert_id"], as_of)


def _staging(w: Warehouse, job: str, as_of: datetime):
    """Where a run stores what it has parsed: one folder per run, replaced when the run is repeated."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        folder = w.path(f"staging/{job}/{BATCH}={_stamped(as_of)}/{name}")
        write_table(df, folder, "overwrite")
        return w.spark.read.schema(df.schema).parquet(folder)

    return stage


def refresh_a(w: Warehouse, as_of: datetime) -> None:
    """Venue-A catalogue from the series and market pages of the newest landed run."""
    pages = w.landed("series", "refresh-a", as_of, newest=True)
    if pages is None:
        return
    intent = read_intent(w.spark, w.path("landed/intent.json"))
    series = read_pages(w.spark, pages[0], "series", "category string, page int")
    followed = series.filter(F.col("category").isin(list(intent.categories)))
    markets = read_pages(w.spark, w.path(f"landed/markets/{pages[0].rsplit('/', 1)[1]}"), "markets", "series_ticker string, page int")
    manual = w.spark.createDataFrame([(t,) for t in intent.tickers], "ticker string")
    found = refresh_catalog_a(followed, markets, w.markets_a(as_of), manual, as_of, _staging(w, "refresh-a", as_of))
    refresh_series(found.series, w.path("series"), as_of)
    keys, order = ["source", "ticker"], ["source", "category", "status"]
    upsert_buckets(found.staged, w.path("markets_a"), schemas.MARKETS_A, keys, as_of, SETTLED, cluster_by=order)
    tickers = found.subscriptions.select(F.lit("venue_a").alias("source"), F.col("ticker").alias("market_id"))
    replace_subscriptions(schemas.conform(tickers, schemas.SUBSCRIPTIONS), w.path("subscriptions"), "venue_a", as_of)
    w.finish("refresh-a", as_of)


def refresh_b(w: Warehouse, as_of: datetime) -> None:
    """Venue-B catalogue from the event pages of the newest landed run, tags in the order of the intent file."""
    pages = w.landed("events", "refresh-b", as_of, newest=True)
    if pages is None:
        return
    intent = read_intent(w.spark, w.path("landed/intent.json"))
    events = read_pages(w.spark, pages[0], "events", "tag string, page int")
    order = w.spark.createDataFrame(list(enumerate(intent.tag_slugs)), "tag_position int, tag string")
    tagged = events.join(F.broadcast(order), "tag")
    found = refresh_catalog_b(tagged, w.markets_b(as_of), as_of, stage=_staging(w, "refresh-b", as_of))
    staged = found.staged.select(*schemas.MARKETS_B_STAGED.names)
    keys, order = ["source", "id"], ["source", "closed", "accepting_orders"]
    upsert_buckets(staged, w.path("markets_b"), schemas.MARKETS_B, keys, as_of, CLOSED, cluster_by=order)
    tokens = found.subscriptions.withColumn("source", F.lit("venue_b"))
    replace_subscriptions(schemas.conform(tokens, schemas.SUBSCRIPTIONS), w.path("subscriptions"), "venue_b", as_of)
    w.finish("refresh-b", as_of)


def detect(w: Warehouse, as_of: datetime, params: DetectParams = DetectParams()) -> None:
    mine = _stamped(as_of)
    known = w.alerts().filter(F.col(BATCH) != mine)
    found = detect_anomalies(
        w.trades(), w.markets_a(), w.markets_b(), w.series(), known, as_of, params, known_since=params.lookback
    )
    append_alerts(found, w.path("alerts"), mine)


def notify(w: Warehouse, as_of: datetime, retry_after: timedelta | None = None) -> None:
    """Hand the waiting alerts to the sender; what an earlier cycle handed on stays in its own folder.

    Alerts of new batches join the open set, in which they stay until they are reported as sent, whatever their age. What
    has been handed out is not handed out again before an answer, or before `retry_after` has passed.
    """
    mine, before = _stamped(as_of), w.pending(as_of)
    seen = {tuple(r) for r in before["seen"].collect()}
    new = unseen(w.spark, w.path("alerts"), seen)
    fresh = read_batches(w.spark, w.path("alerts"), {name for name, _ in new}, schemas.ALERTS, "detected_date date")
    first = fresh.agg(F.min("detected_date").alias("day")).first()["day"]
    told = w.state().filter(F.col("notified_date") >= F.lit(first)) if first else w.state().limit(0)
    pending = admitted(before["open"], fresh, told)
    free = waiting(pending, as_of, retry_after)
    queue = notifications(free, as_of, told=before["recent"])
    folder = f"{w.path('outgoing')}/{BATCH}={mine}"
    write_table(queue, folder, "overwrite", cluster_by=["queue_pos"])
    open_ = handed_out(pending, w.spark.read.parquet(folder), mine, as_of)
    parts = {"open": open_, "seen": notes_table(w.spark, kept_notes(seen | new)), "recent": before["recent"]}
    write_parts(parts, w.path("pending"), as_of)


def deliver(w: Warehouse, as_of: datetime) -> None:
    """Take over what the sender reports, of this or any earlier cycle: note who was told and hand on debate requests."""
    intent = read_intent(w.spark, w.path("landed/intent.json"))
    landed = w.landed("deliveries", "deliver", as_of)
    if landed is None:
        return
    mine, before = _stamped(as_of), w.pending(as_of)
    folder = f"{w.path('settled')}/{BATCH}={mine}"
    write_table(settled(before["open"], w.spark.read.schema(_DELIVERIES).json(landed)), folder, "overwrite")
    rows = w.spark.read.parquet(folder)
    asked = debate_requests(rows.filter("started_now"), intent.debates_enabled, intent.debates_auto_publish)
    write_table(outbox(asked, "alert_id"), f"{w.path('requests')}/{BATCH}={mine}", "overwrite")
    append_state(sent_state(rows, as_of), w.path("alert_state"), mine)
    told = told_threads(rows, as_of)
    append_threads(told, w.path("threads"), mine)
    recent = recent_after(before["recent"], told, as_of)
    write_parts({"open": still_open(rows), "seen": before["seen"], "recent": recent}, w.path("pending"), as_of)
    w.finish("deliver", as_of)


def command(w: Warehouse, as_of: datetime) -> None:
    """Commands that landed since the last run become requests beside those of the notification cycles."""
    landed = w.landed("commands", "command", as_of)
    if landed is None:
        return
    commands = w.spark.read.schema(_COMMANDS).json(landed)
    asked = command_requests(commands, w.threads(commands))
    write_table(outbox(asked, "alert_id"), f"{w.path('requests')}/{BATCH}={_stamped(as_of)}c", "overwrite")
    w.finish("command", as_of)


def resolve(w: Warehouse, as_of: datetime) -> None:
    """Answer the requests since the last run from recent debates; the others go on to a fresh run."""
    sent = w.batches("requests", "resolve", as_of)
    if "value" not in sent.columns:
        return
    fields = F.from_json("value", schemas.REQUESTS)
    asked = valid_requests(sent.select(fields.alias("r")).select("r.*")).withColumn("requested_at", instant(as_of))
    mine = _stamped(as_of)
    others = w.debates().filter(F.col(BATCH) != mine)
    looked = reuse_lookup(asked, recent_debates(others, asked))
    write_table(fresh_runs(looked), f"{w.path('fresh_requests')}/{BATCH}={mine}", "overwrite")
    answered = cached_rows(looked).join(recent_debates(others, asked).select("debate_id"), "debate_id", "left_anti")
    append_debates(schemas.conform(answered, schemas.DEBATES), w.path("debates"), mine)
    w.finish("resolve", as_of)


def account(w: Warehouse, as_of: datetime, limit_usd: float = 0.50) -> None:
    """Finished debates that landed since the last run (what was asked, and transcripts) as rows of the debates table."""
    runs, lines = (w.landed(x, "account", as_of) for x in ("debate_runs", "transcripts"))
    if runs is None or lines is None:
        return
    accounts = debate_accounts(w.spark.read.schema(schemas.TRANSCRIPTS).json(lines), limit_usd)
    rows = debate_rows(accounts, w.spark.read.schema(_RUNS).json(runs))
    append_debates(schemas.conform(rows, schemas.DEBATES), w.path("debates"), f"{_stamped(as_of)}d")
    w.finish("account", as_of)


JOBS = {
    "ingest": ingest,
    "compact": compact,
    "pack": pack_batches,
    "refresh-a": refresh_a,
    "refresh-b": refresh_b,
    "detect": detect,
    "notify": notify,
    "deliver": deliver,
    "command": command,
    "resolve": resolve,
    "account": account,
}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--root", required=True, help="the warehouse folder")
    parser.add_argument("--as-of", required=True, type=datetime.fromisoformat, help="time of the run; UTC without zone")
    args = parser.parse_args()
    as_of = args.as_of if args.as_of.tzinfo else args.as_of.replace(tzinfo=timezone.utc)
    spark = prepare(SparkSession.builder.appName(f"tradewatch {args.job}").getOrCreate())
    JOBS[args.job](Warehouse(spark, args.root), as_of)


if __name__ == "__main__":
    main()
