"""Alerts over several cycles: late, repeated and contradicting reports, failures, alerts of any age."""

import json
from datetime import datetime, timedelta, timezone

import pytest

from tests.test_jobs import land
from tests.test_notify import alerts
from tradewatch import jobs
from tradewatch.sources.register import kept_notes, note_batch, notes_since, unseen
from tradewatch.sources.tables import append_alerts

NOW = datetime(2024, 6, 1, 12, tzinfo=timezone.utc)


@pytest.fixture
def house(spark, tmp_path):
    land(tmp_path, "intent.json", {"venue_a": {}, "venue_b": {}, "debater": {"enabled": True}})

    class House(jobs.Warehouse):
        def at(self, minutes):
            return NOW + timedelta(minutes=minutes)

        def add(self, batch, *rows):
            """(id, series, market, minutes before noon)"""
            append_alerts(alerts(spark, [(i, s, s and f"Series {s}", f"t {m}", m, ago, None, None) for i, s, m, ago in rows]), self.path("alerts"), batch)

        def notify(self, minutes, **more):
            for _attempt in range(self.attempts):
                jobs.notify(self, self.at(minutes), **more)
            folder = f"{self.path('outgoing')}/batch_id=r{int(self.at(minutes).timestamp() * 1_000_000)}"
            return {r["alert_id"]: r for r in spark.read.parquet(folder).collect()}

        def report(self, minutes, *reports):
            lines = [json.dumps({"alert_id": a, "thread_id": t, "ok": ok}) for a, t, ok in reports]
            land(tmp_path, "deliveries/1.json", "\n".join(lines), self.at(minutes))
            for _attempt in range(self.attempts):
                jobs.deliver(self, self.at(minutes))

        def told(self):
            return {r["alert_id"]: (r["discord_thread_id"], round((r["notified_at"].astimezone(timezone.utc) - NOW).total_seconds() / 60)) for r in self.state().collect()}

        def asked(self):
            return sorted(r["key"] for r in spark.read.parquet(self.path("requests")).collect())

    House.attempts = 1
    return House(spark, str(tmp_path))


def test_a_report_two_cycles_late_is_booked_and_nothing_is_handed_out_twice(house):
    type(house).attempts = 2  # each run is repeated
    house.add("d1", ("a1", "S1", "m1", 10), ("a2", "S2", "m2", 9))
    assert set(house.notify(0)) == {"a1", "a2"}
    house.report(2, ("a1", "t1", True))
    house.add("d2", ("a3", "S3", "m3", 1))
    assert set(house.notify(5)) == {"a3"}
    assert set(house.notify(10)) == set()
    house.report(12, ("a2", "t2", True), ("a3", "t3", True))
    assert house.told() == {"a1": ("t1", 2), "a2": ("t2", 12), "a3": ("t3", 12)}
    assert house.asked() == ["a1", "a2", "a3"]
    assert set(house.notify(15)) == set() and house.pending(house.at(20))["open"].count() == 0


def test_repeated_and_contradicting_reports(house):
    house.add("d1", ("a1", "S1", "m1", 10), ("a2", "S2", "m2", 9), ("a3", "S3", "m3", 9))
    house.notify(0)
    house.report(1, ("a1", "t1", True), ("a1", None, False), ("a1", "t1", True), ("a2", None, False), ("nobody", "t", True))
    assert house.told() == {"a1": ("t1", 1)}
    house.report(2, ("a1", "t9", True), ("a1", None, False), ("a2", "t2", True))  # a2 was sent after all
    assert house.told() == {"a1": ("t1", 1), "a2": ("t2", 2)}
    assert set(house.notify(5)) == set()  # a3 has no report yet
    house.report(6, ("a3", None, False))
    assert set(house.notify(10)) == {"a3"}
    house.report(11, ("a3", "t3", True))
    assert house.told()["a3"] == ("t3", 11) and house.asked() == ["a1", "a2", "a3"]


def test_groups_over_several_reports(house):
    house.add("d1", ("a1", "S1", "m1", 10), ("a2", "S1", "m2", 9), ("a3", "S1", "m3", 8), ("b1", "S2", "m4", 9), ("b2", "S2", "m5", 8))
    first = house.notify(0)
    assert {k: r["is_starter"] for k, r in first.items()} == {"a1": True, "a2": False, "a3": False, "b1": True, "b2": False}
    house.report(1, ("a2", None, True))  # the starter has not been heard of
    assert house.told() == {}
    house.report(2, ("a1", "t1", True), ("b2", None, True), ("b1", None, False))
    assert house.told() == {"a1": ("t1", 2), "a2": ("t1", 2)}
    assert house.asked() == ["a1", "a2", "a3"]  # the group's markets are asked for once, as soon as it has a thread
    house.report(3, ("a3", None, False))
    again = house.notify(5)  # a3 failed by itself, the b's with their starter; a3 goes on in the thread of its series
    assert set(again) == {"a3", "b1", "b2"} and again["a3"]["thread_id"] == "t1"
    house.report(6, ("a3", "t1", True), ("b1", "t2", True), ("b2", "t2", True))
    assert house.told() == {"a1": ("t1", 2), "a2": ("t1", 2), "a3": ("t1", 6), "b1": ("t2", 6), "b2": ("t2", 6)}


def test_alerts_of_any_age_wait_and_threads_are_found(spark, tmp_path, house):
    old = 60 * 24 * 8
    house.add("d1", ("a1", "S1", "m1", old))
    assert set(house.notify(-old + 1)) == {"a1"}
    house.report(0, ("a1", "t1", True))  # after eight days
    assert house.told() == {"a1": ("t1", 0)}
    house.add("d0", ("a0", "S0", "m0", 2 * old))  # a run that finished late
    house.add("d1", ("a1", "S1", "m1", old))  # a run that was repeated
    assert set(house.notify(5)) == {"a0"}
    land(tmp_path, "commands/1.json", json.dumps({"command_id": "c", "thread_id": "t1", "question": None}), house.at(old + 1))
    jobs.command(house, house.at(old + 2))
    assert house.asked() == ["a1", "a1"]


def test_retry_after(house):
    house.add("d1", ("a1", "S1", "m1", 10))
    house.notify(0)
    assert set(house.notify(30, retry_after=timedelta(hours=1))) == set()
    assert set(house.notify(60, retry_after=timedelta(hours=1))) == {"a1"}


def test_register_is_read_from_its_end(spark, tmp_path):
    path = str(tmp_path / "t")
    assert notes_since(spark, path) == set()
    for name in ("x", "y", "x"):
        note_batch(spark, path, name)
    seen = notes_since(spark, path)
    assert sorted(name for name, _ in seen) == ["x", "y"]
    note_batch(spark, path, "z")
    assert [name for name, _ in unseen(spark, path, seen)] == ["z"]
    older = {(name, day - timedelta(days=k)) for k, (name, day) in enumerate(sorted(seen))}
    assert {name for name, _ in unseen(spark, path, older)} == {"y", "z"}
    assert {name for name, _ in unseen(spark, path, older, again=False)} == {"z"}
    far = {(name, day - timedelta(days=3 * k)) for k, (name, day) in enumerate(sorted(seen))}
    assert {name for name, _ in kept_notes(far)} == {"x"} and kept_notes(set()) == set()
