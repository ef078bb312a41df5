"""Keyed state with event-time timers: the open cycles of orders and when they are overdue.

A key is a group of orders (a hash of the order id), because every call of a state or a timer is a message between Spark and Python:
one per group and batch, not one per order.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

REPORT = "order_id string, started_at timestamp, timeout_at timestamp, max_cycle_minutes int"
# What is known of a group, as rows (order, kind, id, time in ms, minutes, deadlines a start has passed).
STATE = ("orders array<string>, kinds array<string>, ids array<string>, times array<bigint>, minutes array<int>, "
         "passed array<int>")
MINUTE = 60_000
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def deadlines(start: tuple, rows: list[tuple], until: int | None) -> list[tuple[int, int]]:
    """(deadline, limit in minutes) of a start, one after the other: an extension up to a deadline moves it, a later one adds
    another. ``until`` is the order's next start; extensions from then on are not for this one."""
    _, _, at, limit, _ = start
    out = [(at + limit * MINUTE, limit)]
    own = sorted(r[2:4] for r in rows if r[0] == "extension" and r[2] >= at and (until is None or r[2] < until))
    for time, minutes in own:
        limit += minutes
        if time <= out[-1][0]:
            out.pop()
        out.append((at + limit * MINUTE, limit))
    return out


class Deadlines(StatefulProcessor):
    """Times of starts, ends and extensions in one value per group of orders; a row "timer" per order tells when it is looked at
    again, at its next deadline or to forget it. The group has one timer, at the first of these times."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("cycles", STATE)

    def _orders(self) -> dict[str, list[tuple]]:
        value, found = self.state.get(), {}
        for order, *row in zip(*value) if value and value[0] else ():
            found.setdefault(order, []).append(tuple(row))
        return found

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known, new, ids = self._orders(), set(), {}
        before = _first_timer(known)
        for row in rows:
            own = known.setdefault(row.order_id, [])
            if row.order_id not in new:
                new.add(row.order_id)
                ids[row.order_id] = {(r[0], r[1]) for r in own}
            if (row.kind, row.id) not in ids[row.order_id]:
                ids[row.order_id].add((row.kind, row.id))
                own.append((row.kind, row.id, row.ms, row.max_cycle_minutes or 0, 0))
        yield from self._advance(known, new, before, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self._orders()
        yield from self._advance(known, set(), _first_timer(known), timerValues)

    def _advance(self, known: dict[str, list[tuple]], new: set[str], old: int | None, timers) -> Iterator[Row]:
        """Reports the deadlines the watermark has passed, sets the timer of the next one and forgets what is over. Orders without
        new rows are left alone until their time has come."""
        mark = timers.getCurrentWatermarkInMs()
        found, changed = [], bool(new)
        for order in list(known):
            time = _timer(known[order])
            if order not in new and time is not None and time >= mark:
                continue
            due, known[order] = self._order(order, known[order], mark)
            found += due
            changed = True
            if not known[order]:
                del known[order]
        timer = _first_timer(known)
        if old is not None and old != timer and old >= mark:    # timers before the mark are gone by themselves
            self.handle.deleteTimer(old)
        if timer is None:
            self.state.clear()
        elif changed:
            if old is None or old != timer or old < mark:
                self.handle.registerTimer(timer)
            flat = [(order, *row) for order, rows in known.items() for row in rows]
            self.state.update(tuple(list(c) for c in zip(*flat)))
        for order_id, started, due, limit in found:
            yield Row(order_id=order_id, started_at=EPOCH + timedelta(milliseconds=started),
                      timeout_at=EPOCH + timedelta(milliseconds=due), max_cycle_minutes=limit)

    def _order(self, order: str, rows: list[tuple], mark: int) -> tuple[list[tuple], list[tuple]]:
        """The reports of an order and its rows from now on, none when it is over."""
        starts = sorted((r for r in rows if r[0] == "start"), key=lambda r: (r[2], r[1]))
        ends = sorted(r[2] for r in rows if r[0] == "end")
        found, kept, waits, last = [], [], [], 0
        for i, start in enumerate(starts):
            until = starts[i + 1][2] if i + 1 < len(starts) else None
            series = deadlines(start, rows, until)
            due = [d for d in series[start[4]:] if d[0] < mark]
            first_end = next((e for e in ends if e >= start[2]), None)
            found += [(order, start[2], d, limit) for d, limit in due if first_end is None or first_end > d]
            passed = start[4] + len(due)
            if passed < len(series):
                waits.append(series[passed][0])
            last = max(last, series[-1][0])
            kept.append((*start[:4], passed))
        others = [r for r in rows if r[0] not in ("start", "timer")]
        last = max([last, *[r[2] for r in others]]) + self.keep_ms
        if last < mark:
            return found, []
        return found, [*kept, *others, ("timer", "", min([*waits, last]), 0, 0)]


def _timer(rows: list[tuple]) -> int | None:
    return next((r[2] for r in reversed(rows) if r[0] == "timer"), None)


def _first_timer(known: dict[str, list[tuple]]) -> int | None:
    return min((t for t in map(_timer, known.values()) if t is not None), default=None)
