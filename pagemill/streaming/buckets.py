"""Keys of a stateful processor in buckets: Spark calls the processor once a bucket, as a call costs more than a key's work.

The state stays a row for each key, in a map; a batch reads and writes only those of its keys.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

#: Buckets of keys. A checkpoint holds for the number that it was made with.
BUCKETS = 512
#: The bucket of the null key, whose place in the map is that of `none` in `bucket_of`.
NULL_BUCKET = -1


def bucket_of(key: Column) -> Column:
    return F.when(key.isNull(), NULL_BUCKET).otherwise(F.pmod(F.xxhash64(key), F.lit(BUCKETS))).cast("int")


class Alarms:
    """When keys of a bucket are due (milliseconds of event time), under one timer of Spark's, that of the first."""

    def __init__(self, handle: StatefulProcessorHandle, key_type: str):
        self.handle = handle
        self.state = handle.getValueState("alarms", f"keys array<{key_type}>, times array<long>")

    def load(self) -> dict:
        held = self.state.get()
        times = {} if held is None else dict(zip(*held, strict=True))
        self.first = min(times.values(), default=None)
        return times

    def save(self, times: dict) -> None:
        """What `load` gave, changed by the caller."""
        first = min(times.values(), default=None)
        if first != self.first:
            if self.first is not None:
                self.handle.deleteTimer(self.first)
            if first is not None:
                self.handle.registerTimer(first)
        if times:
            self.state.update((list(times), list(times.values())))
        elif self.first is not None:
            self.state.clear()

    def due(self, times: dict, now: int) -> Iterable:
        """Takes the keys due at `now` out of `times`."""
        found = [key for key, at in times.items() if at <= now]
        for key in found:
            del times[key]
        return found
