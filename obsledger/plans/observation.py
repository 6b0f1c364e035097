"""Observation queries on ``events``: sources are event types, keys are users, days are calendar days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import observation as ob
from ..session import table

#: Order of the sources, from which the emulated completeness of a day follows.
ORD = {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


def _seen(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir).select(F.col("event_type").alias("source"), F.col("user_id").alias("key"), "day").distinct()


def _obs(seen: DataFrame) -> DataFrame:
    ord_ = F.create_map(*(F.lit(x) for kv in ORD.items() for x in kv))[F.col("source")]
    days = seen.select("source", "day").distinct()
    return days.select(
        "source", "day", ((F.dayofmonth("day") * 7 + ord_) % 4 != 0).alias("complete"),
        F.when(F.col("day") < F.lit("2024-01-16").cast("date"), "a").otherwise("b").alias("origin"), F.lit("m").alias("method"),
    )


def _iso(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def listing_state(spark, sf_dir):
    seen = _seen(spark, sf_dir)
    return _iso(ob.listing_state(seen, _obs(seen)), "first_seen", "last_seen", "kakunin_saigo", "kieta_kakunin")


def snapshot_fold(spark, sf_dir):
    out = ob.snapshot_fold(_events(spark, sf_dir), ["event_type", "user_id"], "day", ["ts", "event_id"], ["props", "value"])
    return _iso(out, "first_seen", "last_seen")


def observation_completeness(spark, sf_dir):
    n = _events(spark, sf_dir).groupBy(F.col("event_type").alias("source"), "day").agg(F.count("*").alias("n"))
    v = lambda k: F.pmod(F.col("n") * k + F.dayofmonth("day"), F.lit(11))
    marks = {f"m{k}": F.when(v(k) == 0, ob.NO).when(v(k) > 1, ob.YES) for k in range(1, 8)}
    complete, reason = ob.all_marks(marks)
    return _iso(n.select("source", "day", ob.tri(complete).alias("complete"), reason.alias("reason")), "day")


def batch_guards(spark, sf_dir):
    seen = _seen(spark, sf_dir)
    return _iso(ob.batch_guards(seen, _obs(seen)), "day", "prev")


def diff_permission(spark, sf_dir):
    obs = _obs(_seen(spark, sf_dir))
    state = F.struct("complete", "origin", "method")
    w = Window.partitionBy("source").orderBy("day")
    return _iso(obs.select("source", "day", state.alias("now"), F.lag(state).over(w).alias("prev")).select("source", "day", ob.diff_reason("prev", "now").alias("reason")), "day")


def tenant_diff(spark, sf_dir):
    e = _events(spark, sf_dir).select(F.col("event_type").alias("source"), F.col("user_id").alias("key"), "day", F.col("event_id").alias("pos"))
    return _iso(ob.observation_diff(e, _obs(e.select("source", "day"))), "day")


def gone_intervals(spark, sf_dir):
    seen = _seen(spark, sf_dir)
    return ob.gone_intervals(ob.listing_state(seen, _obs(seen)))


def appearance_gaps(spark, sf_dir):
    first = _seen(spark, sf_dir).groupBy("source", "key").agg(F.min("day").alias("day"))
    out = ob.gaps(first, "source", "day")
    return out.withColumn("median_gap", F.col("median_gap").cast("double"))


def prospective_new(spark, sf_dir):
    """Users first seen from the cut-off on; days from first signup to first purchase."""
    e = _events(spark, sf_dir)
    per = e.groupBy("user_id").agg(F.min("day").alias("first_seen"), F.min(F.when(F.col("event_type") == "signup", F.col("day"))).alias("public"), F.min(F.when(F.col("event_type") == "purchase", F.col("day"))).alias("seen"))
    new = per.where(F.col("first_seen") >= F.lit("2024-01-03").cast("date")).withColumn("lag", F.datediff("seen", "public"))
    return new.agg(F.count("*").alias("n_new"), F.count("lag").alias("n_lag"), F.median("lag").cast("double").alias("median_lag"), F.min("lag").alias("min_lag"), F.max("lag").alias("max_lag"))


def fingerprint_status(spark, sf_dir):
    """Is a user's payload new, the same or replaced? Compared within one origin only."""
    e = _events(spark, sf_dir).withColumn("origin", F.when(F.col("day") < F.lit("2024-01-16").cast("date"), "a").otherwise("b")).withColumn("fp", F.when(F.col("event_id") % 7 != 0, F.sha2(F.col("props").cast("binary"), 256)))
    w = Window.partitionBy("user_id", "origin").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    prev, n = F.last("fp", ignorenulls=True).over(w), F.count("*").over(w)
    status = F.when(F.col("fp").isNull(), "not taken").when(n == 0, "first").when(prev.isNull(), "before not taken").when(prev == F.col("fp"), "same").otherwise("replaced")
    return e.select("event_id", "user_id", "origin", status.alias("status"))


def rolling_limit(spark, sf_dir):
    """Uses in the trailing 1, 7 and 30 days; over any limit is blocked."""
    d = _events(spark, sf_dir).groupBy("user_id", "day").agg(F.count("*").alias("n"))
    num = F.datediff("day", F.lit("2024-01-01").cast("date"))
    w = lambda k: Window.partitionBy("user_id").orderBy(num).rangeBetween(-(k - 1), 0)
    out = d.select("user_id", F.col("day").cast("string").alias("day"), "n", F.sum("n").over(w(7)).alias("last7"), F.sum("n").over(w(30)).alias("last30"))
    return out.withColumn("blocked", (F.col("n") > 4) | (F.col("last7") > 18) | (F.col("last30") > 60))


def ledger_latest(spark, sf_dir):
    """The latest entry of a key wins; its class decides the next attempt."""
    e = _events(spark, sf_dir)
    last = e.groupBy("user_id").agg(F.max_by(F.struct("event_type", "day", "event_id"), F.struct("ts", "event_id")).alias("x"), F.count("*").alias("entries"))
    kind = F.when(F.col("x.event_type") == "purchase", "done").when(F.col("x.event_type") == "signup", "never").when(F.col("x.event_type") == "error", "next run").otherwise("after 30 days")
    nxt = F.when(kind == "next run", F.date_add("x.day", 1)).when(kind == "after 30 days", F.date_add("x.day", 30))
    return last.select("user_id", "entries", F.col("x.event_id").alias("event_id"), kind.alias("retry"), nxt.cast("string").alias("next_attempt"))


def budgeted_frontier(spark, sf_dir):
    """What came up after it was last done, newest first, at most 12 a source, within a request budget of 40."""
    e = _events(spark, sf_dir)
    done = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("day").alias("done_on"))
    todo = e.where("event_type <> 'purchase'").groupBy(F.col("event_type").alias("source"), "user_id").agg(F.max("day").alias("day"), F.count("*").alias("cost")).join(done, "user_id", "left").where("done_on IS NULL OR day > done_on")
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("day"), "user_id"))
    capped = todo.withColumn("rank", rank).where("rank <= 12")
    spent = F.sum("cost").over(Window.partitionBy("source").orderBy("rank"))
    return _iso(capped.withColumn("spent", spent).where("spent <= 40").select("source", "user_id", "day", "rank", "spent"), "day")


def events_tumbling(spark, sf_dir):
    """Extension, no counterpart in the reference: hourly tumbling windows."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.date_format("w.start", "yyyy-MM-dd").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


def events_session(spark, sf_dir):
    """Extension: sessions of a user, split by gaps of more than six hours."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = e.groupBy(F.session_window("ts", "6 hours").alias("w"), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


QUERIES = {f.__name__: f for f in (listing_state, snapshot_fold, observation_completeness, batch_guards, diff_permission, tenant_diff, gone_intervals, appearance_gaps, prospective_new, fingerprint_status, rolling_limit, ledger_latest, budgeted_frontier, events_tumbling, events_session)}

_SEEN = "seen AS (SELECT DISTINCT event_type AS source, user_id AS key, ts::DATE AS day FROM events)"
_OBS = """obs AS (SELECT source, day, (day(day) * 7 + CASE source WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END) % 4 <> 0 AS complete,
  CASE WHEN day < DATE '2024-01-16' THEN 'a' ELSE 'b' END AS origin FROM (SELECT DISTINCT event_type AS source, ts::DATE AS day FROM events))"""
_STATE = f"""{_SEEN}, {_OBS},
latest AS (SELECT source, max(day) AS latest FROM obs GROUP BY source),
k AS (SELECT s.source, s.key, min(s.day) AS first_seen, max(s.day) AS last_seen, max(s.day) FILTER (WHERE o.complete) AS k FROM seen s JOIN obs o USING (source, day) GROUP BY ALL),
c AS (SELECT k.*, (SELECT min(o.day) FROM obs o WHERE o.source = k.source AND o.complete AND o.day > k.k) AS c FROM k),
state AS (SELECT c.source, c.key, first_seen, last_seen, CASE WHEN last_seen = latest THEN true WHEN k IS NULL OR c IS NULL THEN NULL WHEN ok.origin <> oc.origin THEN NULL WHEN last_seen > c THEN NULL ELSE false END AS listed, k, c
  FROM c JOIN latest USING (source) LEFT JOIN obs ok ON ok.source = c.source AND ok.day = k LEFT JOIN obs oc ON oc.source = c.source AND oc.day = c)"""

ORACLES = {
    "listing_state": f"WITH {_STATE} SELECT source, key, first_seen::VARCHAR AS first_seen, last_seen::VARCHAR AS last_seen, listed, k::VARCHAR AS kakunin_saigo, CASE WHEN listed = false THEN c::VARCHAR END AS kieta_kakunin FROM state",
    "snapshot_fold": "SELECT event_type, user_id, min(ts::DATE)::VARCHAR AS first_seen, max(ts::DATE)::VARCHAR AS last_seen, count(DISTINCT ts::DATE) AS days_seen, arg_max(props, (ts, event_id)) AS props, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY ALL",
    "observation_completeness": """
WITH n AS (SELECT event_type AS source, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL),
m AS (SELECT source, day, k, (n * k + day(day)) % 11 AS v FROM n, (SELECT unnest(range(1, 8)) AS k)),
a AS (SELECT source, day, string_agg('m' || k, ',' ORDER BY k) FILTER (WHERE v = 0) AS no, string_agg('m' || k, ',' ORDER BY k) FILTER (WHERE v = 1) AS unsure FROM m GROUP BY ALL)
SELECT source, day::VARCHAR AS day, CASE WHEN no IS NOT NULL THEN 'no' WHEN unsure IS NOT NULL THEN 'unknown' ELSE 'yes' END AS complete,
  CASE WHEN no IS NOT NULL THEN 'no:' || no WHEN unsure IS NOT NULL THEN 'unknown:' || unsure ELSE 'all yes' END AS reason FROM a""",
    "batch_guards": f"""
WITH {_SEEN}, {_OBS},
p AS (SELECT o.source, o.day, (SELECT max(x.day) FROM obs x WHERE x.source = o.source AND x.complete AND x.day < o.day) AS prev FROM obs o),
q AS (SELECT p.*, (SELECT count(*) FROM seen s WHERE s.source = p.source AND s.day = p.day) AS n, CASE WHEN prev IS NOT NULL THEN (SELECT count(*) FROM seen s WHERE s.source = p.source AND s.day = p.prev) END AS prev_n,
  CASE WHEN prev IS NOT NULL THEN (SELECT count(*) FROM seen s WHERE s.source = p.source AND s.day = p.prev AND NOT EXISTS (SELECT 1 FROM seen t WHERE t.source = s.source AND t.key = s.key AND t.day = p.day)) END AS lost_n FROM p)
SELECT source, day::VARCHAR AS day, prev::VARCHAR AS prev, n, prev_n, lost_n, coalesce(prev_n > 0 AND lost_n * 2 >= prev_n, false) AS mass_drop, CASE WHEN coalesce(prev_n > 0 AND lost_n * 2 >= prev_n, false) THEN 'unknown' ELSE 'yes' END AS mark FROM q""",
    "diff_permission": f"""
WITH {_OBS}, l AS (SELECT *, lag(day) OVER w AS pd, lag(complete) OVER w AS pc, lag(origin) OVER w AS po FROM obs WINDOW w AS (PARTITION BY source ORDER BY day))
SELECT source, day::VARCHAR AS day, CASE WHEN pd IS NULL THEN 'no previous observation' WHEN NOT complete THEN 'this observation is not complete' WHEN NOT pc THEN 'the previous observation is not complete' WHEN po <> origin THEN 'origin changed' ELSE '' END AS reason FROM l""",
    "tenant_diff": f"""
WITH {_OBS}, l AS (SELECT *, lag(day) OVER w AS pd, lag(complete) OVER w AS pc, lag(origin) OVER w AS po FROM obs WINDOW w AS (PARTITION BY source ORDER BY day)),
r AS (SELECT source, day, pd, complete, CASE WHEN pd IS NULL THEN 'no previous observation' WHEN NOT complete THEN 'this observation is not complete' WHEN NOT pc THEN 'the previous observation is not complete' WHEN po <> origin THEN 'origin changed' ELSE '' END AS reason FROM l),
s AS (SELECT event_type AS source, user_id AS key, ts::DATE AS day, min(event_id) AS pos FROM events GROUP BY ALL),
a AS (SELECT r.source, r.day, s.key, 1 AS now, NULL AS pos FROM r JOIN s USING (source, day) WHERE pd IS NOT NULL UNION ALL SELECT r.source, r.day, s.key, NULL, s.pos FROM r JOIN s ON s.source = r.source AND s.day = r.pd),
b AS (SELECT source, day, key, max(now) AS now, max(pos) AS pos FROM a GROUP BY ALL),
c AS (SELECT source, day, count(*) FILTER (WHERE pos IS NULL) AS entered, count(*) FILTER (WHERE now IS NULL) AS gone, coalesce(min(pos) FILTER (WHERE now IS NULL) > max(pos) FILTER (WHERE now IS NOT NULL), false) AS tail FROM b GROUP BY ALL)
SELECT r.source, r.day::VARCHAR AS day, true AS processed, CASE WHEN complete THEN 'yes' ELSE 'no' END AS observed, true AS saved, reason = '' AND NOT coalesce(tail, false) AS diffed,
  CASE WHEN reason = '' AND tail THEN 'held: loss at the tail' ELSE reason END AS reason, CASE WHEN reason = '' AND NOT tail THEN entered END AS entered, CASE WHEN reason = '' AND NOT tail THEN gone END AS gone, CASE WHEN reason = '' THEN tail END AS tail
FROM r LEFT JOIN c USING (source, day)""",
    "gone_intervals": f"WITH {_STATE} SELECT source, strftime(k, '%Y-%m') AS month, CASE WHEN c - k = 1 THEN 'one day' ELSE 'wider' END AS width, count(*) AS n FROM state WHERE listed = false GROUP BY ALL",
    "appearance_gaps": f"""
WITH {_SEEN}, f AS (SELECT DISTINCT source, min(day) AS day FROM seen GROUP BY source, key), g AS (SELECT source, day, day - lag(day) OVER (PARTITION BY source ORDER BY day) AS gap FROM f)
SELECT source, count(*) AS n_days, median(gap)::DOUBLE AS median_gap, min(gap) AS min_gap, max(gap) AS max_gap, CASE WHEN count(*) < 2 THEN 'fewer than two days' ELSE '' END AS reason FROM g GROUP BY source""",
    "prospective_new": """
WITH p AS (SELECT user_id, min(ts::DATE) AS first_seen, min(ts::DATE) FILTER (WHERE event_type = 'signup') AS public, min(ts::DATE) FILTER (WHERE event_type = 'purchase') AS seen FROM events GROUP BY user_id),
l AS (SELECT seen - public AS lag FROM p WHERE first_seen >= DATE '2024-01-03')
SELECT count(*) AS n_new, count(lag) AS n_lag, median(lag)::DOUBLE AS median_lag, min(lag) AS min_lag, max(lag) AS max_lag FROM l""",
    "fingerprint_status": """
WITH e AS (SELECT *, CASE WHEN ts::DATE < DATE '2024-01-16' THEN 'a' ELSE 'b' END AS origin, CASE WHEN event_id % 7 <> 0 THEN sha256(props) END AS fp FROM events),
w AS (SELECT *, last_value(fp IGNORE NULLS) OVER x AS prev, count(*) OVER x AS n FROM e WINDOW x AS (PARTITION BY user_id, origin ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, user_id, origin, CASE WHEN fp IS NULL THEN 'not taken' WHEN n = 0 THEN 'first' WHEN prev IS NULL THEN 'before not taken' WHEN prev = fp THEN 'same' ELSE 'replaced' END AS status FROM w""",
    "rolling_limit": """
WITH d AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL),
r AS (SELECT user_id, day::VARCHAR AS day, n, sum(n) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS last7, sum(n) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS last30 FROM d)
SELECT user_id, day, n, last7::BIGINT AS last7, last30::BIGINT AS last30, n > 4 OR last7 > 18 OR last30 > 60 AS blocked FROM r""",
    "ledger_latest": """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn, count(*) OVER (PARTITION BY user_id) AS entries FROM events),
k AS (SELECT *, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'signup' THEN 'never' WHEN 'error' THEN 'next run' ELSE 'after 30 days' END AS retry FROM r WHERE rn = 1)
SELECT user_id, entries, event_id, retry, CASE retry WHEN 'next run' THEN (ts::DATE + 1)::VARCHAR WHEN 'after 30 days' THEN (ts::DATE + 30)::VARCHAR END AS next_attempt FROM k""",
    "budgeted_frontier": """
WITH done AS (SELECT user_id, max(ts::DATE) AS done_on FROM events WHERE event_type = 'purchase' GROUP BY user_id),
todo AS (SELECT event_type AS source, user_id, max(ts::DATE) AS day, count(*) AS cost FROM events LEFT JOIN done USING (user_id) WHERE event_type <> 'purchase' GROUP BY event_type, user_id, done_on HAVING done_on IS NULL OR max(ts::DATE) > done_on),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY day DESC, user_id) AS rank FROM todo QUALIFY rank <= 12),
s AS (SELECT *, sum(cost) OVER (PARTITION BY source ORDER BY rank)::BIGINT AS spent FROM r)
SELECT source, user_id, day::VARCHAR AS day, rank, spent FROM s WHERE spent <= 40""",
    "events_tumbling": "SELECT strftime(ts::DATE, '%Y-%m-%d') AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
    "events_session": """
WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 HOURS OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k""",
}
