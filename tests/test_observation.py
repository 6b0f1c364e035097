"""Truth tables of the three-valued operators, and the streaming twin."""

import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import functions as F

from obsledger.operators import cells, observation as ob
from obsledger.streaming import listing

#: case: sightings, complete observations (day, origin), latest, listed, gone by, last complete sighting
CASES = {
    1: ([20], [(20, "u"), (21, "u")], 21, False, 21, 20),
    2: ([20], [(20, "u")], 21, None, None, 20),
    3: ([20, 22], [(20, "u")], 22, True, None, 20),
    4: ([20], [(20, "u"), (23, "u")], 23, False, 23, 20),
    5: ([20, 24], [(20, "u"), (23, "u")], 25, None, None, 20),
    6: ([20], [(20, "u"), (23, "v")], 25, None, None, 20),
    7: ([21], [(20, "u")], 25, None, None, None),
    8: ([20], [], 25, None, None, None),
    9: ([20], [(20, "u"), (22, "v"), (25, "u")], 26, None, None, 20),
}
day = lambda n: dt.date(2026, 1, n)


def test_nine_listing_cases(spark):
    seen = [(str(k), 1, day(d)) for k, c in CASES.items() for d in c[0]]
    obs = []
    for k, (sights, complete, latest, *_) in CASES.items():
        done = dict(complete)
        for d in sorted({*sights, *done, latest}):
            obs.append((str(k), day(d), True if d in done else None, done.get(d, "u"), "m"))
    got = ob.listing_state(
        spark.createDataFrame(seen, "source string, key long, day date").repartition(3),
        spark.createDataFrame(obs, "source string, day date, complete boolean, origin string, method string"),
    ).collect()
    assert {int(r.source): (r.listed, r.kieta_kakunin, r.kakunin_saigo) for r in got} == {
        k: (c[3], c[4] and day(c[4]), c[5] and day(c[5])) for k, c in CASES.items()
    }


@pytest.mark.parametrize("k", CASES)
def test_streaming_state_agrees(k):
    sights, complete, latest, listed, *_ = CASES[k]
    done = dict(complete)
    rows = [(str(day(d)), "seen" if d in sights else "obs", d in done, done.get(d, "u"), "m") for d in sorted({*sights, *done, latest})]
    state = listing.EMPTY
    for r in rows:  # one row a batch
        state = listing.advance(state, [r])
    assert listing.verdict(state) is listed
    for order in itertools.islice(itertools.permutations(rows), 200):
        late = listing.EMPTY
        for r in order:
            late = listing.advance(late, [r])
        assert (late, listing.verdict(late)) == (state, listed)


def test_late_sightings_and_methods():
    rows = [("2026-01-20", "seen", True, "u", "m"), ("2026-01-23", "obs", True, "u", "m"), ("2026-01-22", "seen", True, "u", "m")]
    state = listing.EMPTY
    for r in rows:
        state = listing.advance(state, [r])
    assert listing.verdict(state) is False and listing.first_absence(state)[0] == "2026-01-23"
    other = listing.advance(listing.EMPTY, [rows[0], ("2026-01-23", "obs", True, "u", "another")])
    assert listing.verdict(other) is None
    days = [str(day(1) + dt.timedelta(days=n)) for n in range(400)]
    long = listing.advance(listing.EMPTY, [(days[0], "seen", True, "u", "m")])
    for d in days[1:]:
        long = listing.advance(long, [(d, "obs", True, "u", "m")])
    assert listing.verdict(long) is False and listing.first_absence(long)[0] == days[1] and len(json.loads(long[5])) <= listing.LATENESS + 2


def test_stream_runs(spark, tmp_path):
    rows = [("s", 1, "2026-01-20", "seen", True, "u", "m"), ("s", 1, "2026-01-21", "obs", True, "u", "m"), ("s", 2, "2026-01-20", "seen", False, "u", "m"), ("s", 2, "2026-01-20", "seen", None, "u", None)]
    df = spark.createDataFrame(rows, "source string, key long, day string, kind string, complete boolean, origin string, method string")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = listing.listing_stream(stream).writeStream.outputMode("update").format("memory").queryName("listing_t").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {r.key: r.listed for r in spark.table("listing_t").collect()}
    assert got == {1: False, 2: True}
    q = listing.once_per_day(stream).writeStream.format("memory").queryName("once_t").option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("once_t").count() == 3


def test_marks_fail_closed(spark):
    df = spark.createDataFrame([("yes", "yes"), ("yes", None), ("no", None), ("yes", "maybe")], "a string, b string")
    complete, reason = ob.all_marks({"a": F.col("a"), "b": F.col("b")})
    assert [tuple(r) for r in df.select(complete, reason).collect()] == [(True, "all yes"), (None, "unknown:b"), (False, "no:a"), (None, "unknown:b")]


def test_guards(spark):
    cases = {"a": (range(5), [], True), "b": (range(10), range(4), True), "c": (range(10), range(6), False), "d": ([], range(40), False)}
    seen = [(s, k, day(d)) for s, (x, y, _) in cases.items() for d, ks in ((1, x), (2, y)) for k in ks]
    obs = [(s, day(d), True, "u", "m") for s in cases for d in (1, 2)]
    got = ob.batch_guards(spark.createDataFrame(seen, "source string, key long, day date"), spark.createDataFrame(obs, "source string, day date, complete boolean, origin string, method string"))
    assert {r.source: r.mark == ob.UNKNOWN for r in got.where("day = '2026-01-02'").collect()} == {s: c[2] for s, c in cases.items()}


def test_rates_grid(spark):
    grid = [(c, p) for c in (0, 1, 2, 3, 9) for p in (None, 0, 400, 499, 500, 5000)]
    want = [True if not p else False if c == 0 else True if p < 500 else c <= 2 for c, p in grid]
    got = spark.createDataFrame(grid, "c long, p long").select(cells.suppress_rate(F.col("c"), F.col("p")).alias("x")).collect()
    assert [r.x for r in got] == want


def test_totals_must_reconcile(spark):
    df = spark.createDataFrame([(5, 3, 1)], "t long, a long, b long")
    with pytest.raises(Exception, match="does not reconcile"):
        df.select(cells.reconciled(F.col("t"), F.col("a"), F.col("b"))).collect()
