"""Keyed state processors for the streaming operators Spark has no
built-in for: per visitor a few values plus, for bounce detection, the
records of one undecided band (kept on the state store, RocksDB).

* ``NewVisitorProcessor`` (W2) and ``DailyFirstProcessor`` (W3): first
  visit ever / first visit per day, decided when the watermark passes the
  end of the candidate record's window.  W2 holds a new visitor's records
  until then and releases them together (order-preserving for downstream
  jobs); W3 keeps the smallest record per open day.
* ``BounceProcessor`` (W4 / W5): an event-time two-step pattern with a
  timeout.  Page records are buffered until the watermark passes
  ``ts + within`` of an entry page; then the strictly next record decides.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FIRST_EVENT_OUT = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.LongType()),
    T.StructField("is_new", T.StringType()),
    T.StructField("value", T.StringType()),
])

BOUNCE_OUT = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("value", T.StringType()),
])


NOBODY = "\0nobody-"     # begins the keys of records without a visitor


def _window_end(ts: int, window_ms: int) -> int:
    return (ts // window_ms) * window_ms + window_ms


class NewVisitorProcessor(StatefulProcessor):
    """Every app-log record of a visitor, ``is_new = 1`` on the first one
    ever (smallest ``(ts, event_id)``), ``0`` on all others.

    Input rows ``(mid, ts, event_id, value)``; event-time mode.  Until the
    visitor's first record is decided, records are kept in list state (on
    the state store, streamed back out, never held in memory together) and
    the smallest one is tracked in a single value.  The decision is taken
    when the watermark passes the end of that record's ``window_ms`` window:
    every earlier record has arrived by then.  Afterwards each record is
    emitted as soon as it arrives, flagged ``0``.  Releasing an undecided
    visitor's records together keeps them in event-time order for the jobs
    downstream (a first record held back alone could reach them late).
    """

    CHUNK = 1024

    def __init__(self, window_ms: int):
        self.window_ms = int(window_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.decided = handle.getValueState("decided", "ts long, event_id long")
        self.cand = handle.getValueState("cand", "ts long, event_id long")
        self.buf = handle.getListState("buf", "ts long, event_id long, value string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mid = key[0]
        if mid.startswith(NOBODY) or self.decided.exists():
            for r in rows:
                yield Row(mid=mid, event_id=r["event_id"], ts=r["ts"], is_new="0", value=r["value"])
            return
        cand = tuple(self.cand.get()) if self.cand.exists() else None
        chunk = []
        for r in rows:
            k = (r["ts"], r["event_id"])
            if cand is None or k < cand:
                cand = k
            chunk.append((r["ts"], r["event_id"], r["value"]))
            if len(chunk) >= self.CHUNK:
                self.buf.appendList(chunk)
                chunk = []
        if chunk:
            self.buf.appendList(chunk)
        if cand is not None:
            self.cand.update(cand)
            self.handle.registerTimer(_window_end(cand[0], self.window_ms))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.decided.exists() or not self.cand.exists():
            return
        first = tuple(self.cand.get())
        if _window_end(first[0], self.window_ms) > timerValues.getCurrentWatermarkInMs():
            return                      # an older timer; the current candidate's fires later
        mid = key[0]
        if self.buf.exists():
            found = False               # of a record that came twice, one is the first
            for ts, eid, value in self.buf.get():
                new = not found and (ts, eid) == first
                found = found or new
                yield Row(mid=mid, event_id=eid, ts=ts, is_new="1" if new else "0", value=value)
        self.buf.clear()
        self.cand.clear()
        self.decided.update(first)

    def close(self) -> None:
        pass


class DailyFirstProcessor(StatefulProcessor):
    """The first record of a visitor on each calendar day.

    Input rows ``(mid, ts, event_id, day, day_end, value)`` (``day`` and its
    end in epoch ms computed in Spark, in the session zone); event-time mode.
    State per visitor: its open days with their smallest record so far (one
    value, so a batch costs a couple of state calls per visitor however many
    days it holds), the last day emitted, and one timer at the earliest
    pending window end.  A day's record is emitted when the watermark passes
    the end of its ``window_ms`` window.  Once the watermark passes the end
    of the last emitted day every later record falls on a later day, so an
    idle visitor ends with no state.
    """

    def __init__(self, window_ms: int):
        self.window_ms = int(window_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "days string")
        self.last_day = handle.getValueState("last_day", "day string, day_end long")

    def _load(self) -> dict:
        import json
        return json.loads(self.open.get()[0]) if self.open.exists() else {}

    def _save(self, days: dict) -> None:
        import json
        if days:
            self.open.update((json.dumps(days, separators=(",", ":")),))
            self.handle.registerTimer(min(_window_end(v[0], self.window_ms)
                                          for v in days.values()))
        else:
            self.open.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        done = self.last_day.get()[0] if self.last_day.exists() else None
        days = self._load()
        before = dict(days)
        for r in rows:
            day = r["day"]
            if done is not None and day <= done:
                continue
            cur = days.get(day)
            if cur is None or (r["ts"], r["event_id"]) < (cur[0], cur[1]):
                days[day] = [r["ts"], r["event_id"], r["day_end"], r["value"]]
        if days != before:
            self._save(days)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        days = self._load()
        ready = sorted(d for d, v in days.items() if _window_end(v[0], self.window_ms) <= wm)
        out, last_end = [], None
        for d in ready:
            ts, eid, day_end, value = days.pop(d)
            out.append(Row(mid=key[0], event_id=eid, ts=ts, is_new="1", value=value))
            last_end = int(day_end)
        if ready:
            self._save(days)
            self.last_day.update((ready[-1], last_end))
            self.handle.registerTimer(last_end)      # to forget the day once it is over
        elif not days and self.last_day.exists() and self.last_day.get()[1] <= wm:
            self.last_day.clear()                    # idle visitor: no state left
        return iter(out)

    def close(self) -> None:
        pass


class BounceProcessor(StatefulProcessor):
    """Input rows: ``(mid, ts, event_id, entry, ok, value)`` where ``entry``
    marks a start record, ``ok`` whether the record satisfies the next-step
    rule, and ``value`` is the whole record (start records only); event-time
    mode.

    ``emit="both"``: a match (strictly next record inside the band with
    ``ok``) and a timeout (no record inside the band) emit the start record.
    ``emit="timeout"``: only timeouts.  A gap of exactly ``within`` is a
    timeout.

    State per visitor: the records of the undecided band as one value (a
    couple of state calls per visitor and batch) and one timer: at the
    earliest undecided start's ``ts + within``, or, without such a start, just
    after the earliest record.  A start is decided once the watermark passes
    that point: every record before it has arrived.  Then records that can no
    longer be anyone's next record are pruned, so a visitor whose last record
    the watermark has passed by the band holds no state.
    """

    def __init__(self, within_ms: int, emit: str = "both"):
        if emit not in ("both", "timeout"):
            raise ValueError("emit is 'both' or 'timeout'")
        self.within = int(within_ms)
        self.emit = emit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getValueState("buf", "items string")

    def _load(self) -> list:
        import json
        return json.loads(self.buf.get()[0]) if self.buf.exists() else []

    def _save(self, items: list) -> None:
        import json
        if not items:
            self.buf.clear()
            return
        self.buf.update((json.dumps(items, separators=(",", ":")),))
        pending = [x[0] for x in items if x[2] and not x[5]]
        self.handle.registerTimer(min(pending) + self.within if pending
                                  else min(x[0] for x in items) + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        items = self._load()
        n = len(items)
        for r in rows:
            items.append([r["ts"], r["event_id"], bool(r["entry"]), bool(r["ok"]),
                          r["value"], False])
        if len(items) != n:
            self._save(items)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        items = sorted(self._load(), key=lambda x: (x[0], x[1]))
        if not items:
            return iter([])
        out, changed = [], False
        for i, x in enumerate(items):
            ts, eid, entry, _, value, decided = x
            if entry and not decided and ts + self.within <= wm:
                nxt = items[i + 1] if i + 1 < len(items) else None
                timeout = nxt is None or nxt[0] - ts >= self.within
                if timeout or (self.emit == "both" and nxt[3]):
                    out.append(Row(mid=key[0], ts=ts, event_id=eid, value=value))
                x[4], x[5], changed = None, True, True
        # rows before the earliest undecided start (and before the watermark)
        # can no longer be anyone's next record
        undecided = [x[0] for x in items if x[2] and not x[5]]
        floor = min([wm] + undecided)
        kept = [x for x in items if x[0] >= floor or (x[2] and not x[5])]
        if changed or len(kept) != len(items):
            self._save(kept)
        return iter(out)

    def close(self) -> None:
        pass
