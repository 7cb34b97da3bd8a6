"""Events and their tables brought up to date from new rows alone.

The cleaned events are partitioned by day. New bronze rows can change an event that is known
already, on its own day or on another; so the known rows of their ids are looked up, the
better row wins as it would among all rows, and what remains is a set of changed events. Only
the days that these leave or enter are written again, the daily tables are computed again for
these days, and lifetime values for the users concerned. The outcome equals a full run: the
best row of a key is the best of the best rows of any split.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_first
from tidemark.operators.events import event_order, events_quarantine, events_silver
from tidemark.plans.activity import daily_active_users
from tidemark.plans.revenue import daily_revenue_gross, daily_revenue_net, ltv_per_user
from tidemark.sources.tables import BRONZE, GOLD, SILVER, Warehouse

#: The layer of rows that only a run in progress needs.
STAGING = "_staging"
_DAILY: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily_active_users": daily_active_users,
    "daily_revenue_gross": daily_revenue_gross,
    "daily_revenue_net": daily_revenue_net,
}


@dataclass(frozen=True)
class Changes:
    """What came between two versions of the cleaned events: the days whose events changed, as
    many as a calendar has, and the users concerned. Without a version before, everything."""

    before: int | None
    after: int
    days: list[dt.date | None]
    users: DataFrame | None = None

    def cover(self, taken: int | None) -> bool:
        """Whether a table made from version ``taken`` lacks these changes and no others."""
        return self.before is not None and taken == self.before


def refresh_events(tables: Warehouse, full: bool = False) -> Changes:
    """Bring ``events_silver`` and ``events_quarantine`` up to date with ``events_bronze``.

    The silver table's notes name the bronze version it has taken. Where that is unknown, or
    bronze rows were replaced since, or with ``full``, both are made from all rows.
    """
    source, target = tables.snapshot(BRONZE, "events_bronze"), tables.snapshot(SILVER, "events_silver")
    notes = {"events_bronze": source.version}
    taken = target.notes.get("events_bronze") if target and not full else None
    new = tables.added_since(BRONZE, "events_bronze", taken) if taken else None
    if new is None:
        bronze = tables.read(BRONZE, "events_bronze")
        tables.save(events_quarantine(bronze), SILVER, "events_quarantine", notes=notes)
        tables.save(events_silver(bronze), SILVER, "events_silver", ("event_date",), notes)
        return Changes(None, _version(tables), [])
    if taken == source.version:
        return Changes(target.version, target.version, [])

    # The quarantine has notes of its own: a run cut short after it does not append twice.
    if tables.snapshot(SILVER, "events_quarantine").notes.get("events_bronze") != source.version:
        tables.append(events_quarantine(new), SILVER, "events_quarantine", notes)
    known = tables.read(SILVER, "events_silver")
    fresh = events_silver(new).withColumn("_new", F.lit(True))
    of_same_ids = known.join(fresh.select("event_id"), "event_id", "left_semi").withColumn("_new", F.lit(False))
    candidates = tables.save(fresh.unionByName(of_same_ids), STAGING, "event_candidates")
    best = keep_first(candidates, ["event_id"], [*event_order(), F.asc("_new")])
    changed = tables.save(best.filter("_new").drop("_new"), STAGING, "changed_events")
    left = candidates.filter(~F.col("_new")).join(changed.select("event_id"), "event_id", "left_semi")
    moved = changed.select("event_date", "user_id").union(left.select("event_date", "user_id"))
    days = [row[0] for row in moved.select("event_date").distinct().collect()]
    unmoved = known.filter(among("event_date", days)).join(changed.select("event_id"), "event_id", "left_anti")
    tables.replace_days(unmoved.unionByName(changed), SILVER, "events_silver", days, notes)
    users = moved.select("user_id").filter("user_id IS NOT NULL").distinct()
    return Changes(target.version, _version(tables), days, users)


def _version(tables: Warehouse) -> int:
    return tables.snapshot(SILVER, "events_silver").version


def among(column: str, days: list[dt.date | None]) -> Column:
    """Whether a date is one of ``days``; null is a day of its own."""
    found = F.col(column).isin([day for day in days if day is not None])
    return F.coalesce(found, F.lit(None in days))


def _taken(tables: Warehouse, name: str) -> int | None:
    """The version of the cleaned events that a gold table was made from."""
    latest = tables.snapshot(GOLD, name)
    return latest.notes.get("events_silver") if latest else None


def refresh_daily(tables: Warehouse, changes: Changes) -> None:
    """The daily tables of the events: changed days are computed, the others kept."""
    events, notes = tables.read(SILVER, "events_silver"), {"events_silver": changes.after}
    for name, table in _DAILY.items():
        taken = _taken(tables, name)
        if taken == changes.after:
            continue
        if changes.cover(taken):
            kept = tables.read(GOLD, name).filter(~among("event_date", changes.days))
            computed = kept.unionByName(table(events.filter(among("event_date", changes.days))))
        else:  # a run was cut short before it came here
            computed = table(events)
        tables.save(computed, GOLD, name, notes=notes)


def refresh_ltv(tables: Warehouse, changes: Changes) -> DataFrame:
    """Lifetime values: those of users with changed events are computed, the others kept."""
    events, name = tables.read(SILVER, "events_silver"), "ltv_per_user"
    taken = _taken(tables, name)
    if taken == changes.after:
        return tables.read(GOLD, name)
    if changes.cover(taken):
        users = tables.save(changes.users, STAGING, "changed_users")
        kept = tables.read(GOLD, name).join(users, "user_id", "left_anti")
        computed = kept.unionByName(ltv_per_user(events.join(users, "user_id", "left_semi")))
    else:
        computed = ltv_per_user(events)
    return tables.save(computed, GOLD, name, notes={"events_silver": changes.after})
