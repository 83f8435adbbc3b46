"""Rounds of a day and the next slot, as pure rules, and the streaming form of the task lifecycle."""

from __future__ import annotations

import datetime as dt
import fcntl
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUSY = 75


def next_slot(ts: Column, hour: int, minute: int, offset_hours: int) -> Column:
    """The first hour:minute at the offset strictly after `ts` (a timestamp without zone, in UTC)."""
    local = ts + F.make_dt_interval(hours=F.lit(offset_hours))
    today = F.date_trunc("day", local).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hour), mins=F.lit(minute))
    return F.when(today > local, today).otherwise(today + F.make_dt_interval(days=F.lit(1))) - F.make_dt_interval(hours=F.lit(offset_hours))


@dataclass(frozen=True)
class Rounds:
    """A batch of rounds. Only successes count; a busy or failed round is tried again; rounds never overlap."""

    wanted: int
    completed: int = 0
    attempts: int = 0
    running: bool = False

    def start(self) -> Rounds:
        if self.running or self.completed >= self.wanted:
            return self
        return Rounds(self.wanted, self.completed, self.attempts + 1, True)

    def end(self, code: int) -> Rounds:
        return Rounds(self.wanted, self.completed + (code == 0), self.attempts, False)

    @property
    def over(self) -> bool:
        return not self.running and self.completed >= self.wanted


def slot_after(now: dt.datetime, hour: int, minute: int) -> dt.datetime:
    """W10 on the driver: the first hour:minute strictly after `now`, in its zone."""
    today = now.replace(hour=hour, minute=minute, second=0, microsecond=0)
    return today if today > now else today + dt.timedelta(days=1)


class RoundLoop:
    """Days of rounds. `launch(now)` runs one round and gives its exit code, or raises OSError if it can't start.

    A day begins at its slot (the first one at once with `at_once`) and ends after `rounds` rounds of code 0; any other
    round is tried again after a pause and doesn't count. `stop` ends the loop before the next round or pause.
    """

    def __init__(self, launch: Callable[[dt.datetime], int], rounds: int, hour: int, minute: int, offset_hours: float = 8, poll_seconds: float = 30, at_once: bool = False, clock: Callable[[], float] = time.time, pause: Callable[[float], None] = time.sleep):
        self.launch, self.rounds, self.hour, self.minute = launch, rounds, hour, minute
        self.zone, self.poll, self.at_once = dt.timezone(dt.timedelta(hours=offset_hours)), poll_seconds, at_once
        self.clock, self.pause, self.stopped = clock, pause, False

    def now(self) -> dt.datetime:
        return dt.datetime.fromtimestamp(self.clock(), self.zone)

    def stop(self) -> None:
        self.stopped = True

    def wait(self) -> None:
        """Until the next slot, in pauses of at most the polling time."""
        slot = slot_after(self.now(), self.hour, self.minute)
        while not self.stopped and (left := (slot - self.now()).total_seconds()) > 0:
            self.pause(min(self.poll, left))

    def day(self) -> Rounds:
        """One day's rounds."""
        state = Rounds(self.rounds)
        while not self.stopped and not state.over:
            state = state.start()
            try:
                state = state.end(self.launch(self.now()))
            except OSError:
                state = state.end(1)
            if not self.stopped and not state.over:
                self.pause(self.poll)
        return state

    def run(self, days: int | None = None) -> Rounds | None:
        """`days` days, or until `stop`; the last day's rounds."""
        last, left = None, days
        while not self.stopped and left != 0:
            if not self.at_once:
                self.wait()
            self.at_once = False
            if not self.stopped:
                last = self.day()
            left = left and left - 1
        return last


class Busy(RuntimeError):
    """Another process holds the lock."""


@contextmanager
def driver_lock(path: str) -> Iterator[None]:
    """One driver at a time. The system frees the lock when its holder ends; the file itself means nothing."""
    file = Path(path)
    file.parent.mkdir(parents=True, exist_ok=True)
    with file.open("ab") as held:
        try:
            fcntl.flock(held, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError:
            raise Busy(path) from None
        yield


def run_locked(path: str, run: Callable[[], int]) -> int:
    """The exit code of `run`, or BUSY if another driver is at it."""
    try:
        with driver_lock(path):
            return run()
    except Busy:
        return BUSY


def step(status: str, failures: int, event: str, max_failures: int = 2) -> tuple[str, int]:
    """One event of a task's lifecycle."""
    if event == "retry":
        return (status, failures) if status == "done" else ("pending", 0)
    if status == "deferred":
        return status, failures
    if event == "begin":
        return "running", failures
    if event == "done":
        return "done", 0
    failures += 1
    return ("deferred" if event == "over_limit" or failures >= max_failures else "pending"), failures


def stream_tasks(events: DataFrame) -> DataFrame:
    """W2 to W5, W7 on a stream of (key, ts, seq, event): each key's state after every batch."""

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        status, failures = state.get if state.exists else ("pending", 0)
        for event in pd.concat(list(parts)).sort_values(["ts", "seq"])["event"]:
            status, failures = step(status, int(failures), event)
        state.update((status, failures))
        yield pd.DataFrame({"key": [key[0]], "status": [status], "failures": [failures]})

    return events.groupBy("key").applyInPandasWithState(advance, "key long, status string, failures long", "status string, failures long", "update", "NoTimeout")
