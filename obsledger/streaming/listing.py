"""Listing state as keyed streaming state (T3, T8): the streaming twin of ``operators.observation.listing_state``.

Input: one row per (source, key, day) with ``kind`` 'seen' for a sighting or 'obs' for an observation of
the source that did not show the key, and the observation's ``complete``, ``origin`` and ``method``. State per
key: the last sighting, the last complete day seen with its origin and method (K), the last day of any row, and
the complete days without the key: all of the last ``LATENESS`` days, before those only the first after K. Rows
may come in any order as long as none is later than that; the state does not depend on it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "source string, key long, last_seen string, k string, c string, listed boolean"
STATE = "last_seen string, k string, k_origin string, k_method string, latest string, absent string"
#: Days by which a row may come late.
LATENESS = 60
EMPTY = (None, None, None, None, None, None)


def advance(state: tuple, rows: list[tuple]) -> tuple:
    """The state after more rows (day, kind, complete, origin, method), in whatever order."""
    last, k, origin, method, latest, absent = state
    gone = {tuple(x) for x in json.loads(absent or "[]")}
    for day, kind, complete, o, m in rows:
        latest = max(latest or day, day)
        if kind == "seen":
            last = max(last or day, day)
            if complete and (k is None or day > k):
                k, origin, method = day, o, m
        elif complete:
            gone.add((day, o, m))
    after = sorted(x for x in gone if k is None or x[0] > k)
    edge = (date.fromisoformat(latest) - timedelta(days=LATENESS)).isoformat() if latest else ""
    kept = [x for n, x in enumerate(after) if x[0] >= edge or (n == 0 and k is not None)]
    return last, k, origin, method, latest, json.dumps(kept)


def first_absence(state: tuple) -> tuple | None:
    """The first complete day after K without the key: (day, origin, method)."""
    k, absent = state[1], json.loads(state[5] or "[]")
    return tuple(absent[0]) if k is not None and absent else None


def verdict(state: tuple) -> bool | None:
    """True if seen on the latest day; false if gone by a comparable complete day; else null."""
    last, k, origin, method, latest, _ = state
    c = first_absence(state)
    if last is not None and last == latest:
        return True
    if c is None or (origin, method) != c[1:] or last > c[0]:
        return None
    return False


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    now = tuple(state.get) if state.exists else EMPTY
    for pdf in batches:
        now = advance(now, [(str(d), k, bool(c), o, m) for d, k, c, o, m in zip(pdf["day"], pdf["kind"], pdf["complete"], pdf["origin"], pdf["method"], strict=True)])
    state.update(now)
    c = first_absence(now)
    yield pd.DataFrame([(key[0], key[1], now[0], now[1], c[0] if c else None, verdict(now))], columns=["source", "key", "last_seen", "k", "c", "listed"])


def listing_stream(events: DataFrame) -> DataFrame:
    """The changing state of every key that a batch touches; run in update mode. Null ``complete`` counts as incomplete."""
    events = events.withColumn("complete", F.coalesce("complete", F.lit(False)))
    return events.groupBy("source", "key").applyInPandasWithState(_step, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout)


def once_per_day(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """The first row of a (source, key, day); repeats inside the watermark are dropped."""
    return events.withColumn("at", F.col("day").cast("timestamp")).withWatermark("at", delay).dropDuplicatesWithinWatermark(["source", "key", "day"]).drop("at")
