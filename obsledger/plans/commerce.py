"""Queries on the order tables: cells, pivots, history, matching."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import cells, resolve
from ..session import table

_KINDS = ("corp", "individual", "undisclosed")


def _supplier(spark, sf_dir):
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (F.col("s_suppkey") % 3 + 1).cast("int"))
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select("n_name", F.when(F.col("s_acctbal") < 0, "minus").otherwise("plus").alias("band"), kind.alias("kind"))  # nation: 25 rows, fixed


def masked_cells(spark, sf_dir):
    return cells.cell_counts(_supplier(spark, sf_dir), ["n_name", "band"], "kind")


def not_counted(spark, sf_dir):
    """Orders left out of the cells, by the first reason that applies; counted and left out add up."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    r = o.join(c, (o.o_custkey + F.when(o.o_orderkey % 11 == 0, 10_000_000).otherwise(0)) == c.c_custkey, "left")
    reason = F.when(F.col("c_custkey").isNull(), "unresolved").when(F.col("o_orderstatus") == "P", "undecided").when(F.col("o_totalprice") < 2000, "gone")
    r = r.select(reason.alias("reason"))
    left = cells.reasons_filled(spark, r.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n")), ["unresolved", "unobserved", "undecided", "gone"])
    total = r.agg(F.count("*").alias("total"), F.count_if(F.col("reason").isNull()).alias("counted"), F.count("reason").alias("left_out"))
    total = total.select(cells.reconciled(F.col("total"), F.col("counted"), F.col("left_out")).alias("total"))
    return left.select("*", total.scalar().alias("total"))


def suppressed_rates(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count_if(F.col("s_acctbal") < 0).alias("count"))
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg((F.count("*") * 10).alias("population"))
    out = c.join(s, "nation", "left").withColumn("count", F.coalesce("count", F.lit(0).cast("long"))).withColumn("suppressed", cells.suppress_rate(F.col("count"), F.col("population")))
    return out.withColumn("rate", F.when(~F.col("suppressed"), F.round(F.col("count") / F.col("population"), 6)))


def monthly_kind_pivot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return cells.pivot_masked(o, "month", "o_orderstatus", ["F", "O", "P"])


def source_summary(spark, sf_dir):
    """Per event type, rows and rows by user segment, and the latest day."""
    e = table(spark, sf_dir, "events")
    seg = F.col("user_id") % 4
    return e.groupBy("event_type").agg(F.count("*").alias("n"), *(F.count_if(seg == k).alias(f"seg{k}") for k in range(4)), F.to_date(F.max("ts")).cast("string").alias("latest"))


def kind_order(spark, sf_dir):
    """Known kinds in their order, then unknown ones sorted."""
    return cells.kind_order(table(spark, sf_dir, "events"), "event_type", ["view", "click", "purchase"])


def issue_rollup(spark, sf_dir):
    """An issue's date is the one with most titles (ties: oldest); topics sum over its dates."""
    li = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"), (F.col("l_suppkey") % 50).alias("issue"), F.col("l_returnflag").alias("topic"))
    per = li.groupBy("issue", "day").agg(F.count("*").alias("n"))
    date = per.groupBy("issue").agg(F.min_by("day", F.struct(-F.col("n"), "day")).alias("day"), F.sum("n").alias("titles"))
    topics = li.groupBy("issue").agg(*(F.count_if(F.col("topic") == t).alias(f"topic_{t.lower()}") for t in "ANR"))
    return date.join(topics, "issue").withColumn("day", F.col("day").cast("string"))


def area_profile(spark, sf_dir):
    """Customers of a nation by segment, least and largest balance."""
    c, n, r = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    g = c.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count_if(F.col("c_mktsegment") == "BUILDING").alias("building"), F.min("c_acctbal").alias("least"), F.max("c_acctbal").alias("largest"))
    return g.join(F.broadcast(n), g.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("r_name", "n_name", "n", "building", "least", "largest")


def kind_top_areas(spark, sf_dir):
    """A10/K5: the thirty most frequent nations of each segment, ties by nation."""
    g = table(spark, sf_dir, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("c_mktsegment").orderBy(F.desc("n"), "c_nationkey"))
    return g.withColumn("rank", rank).where("rank <= 30")


def top_recent(spark, sf_dir):
    """K2/K3: the twelve most recent of each status; the key falls back to the order date where shipping is unknown."""
    o = table(spark, sf_dir, "orders")
    ship = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("ship"))
    r = o.join(ship, "o_orderkey", "left").withColumn("recent", F.to_date(F.coalesce("ship", "o_orderdate")))
    rank = F.row_number().over(Window.partitionBy("o_orderstatus").orderBy(F.desc("recent"), "o_orderkey"))
    return r.withColumn("rank", rank).where("rank <= 12").select("o_orderstatus", "rank", "o_orderkey", F.col("recent").cast("string").alias("recent"))


def future_events(spark, sf_dir):
    """Orders all of whose shipping lies after the cut-off derived from the newest order."""
    today = table(spark, sf_dir, "orders").agg(F.date_sub(F.to_date(F.max("o_orderdate")), 30).alias("today"))
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.to_date(F.min("l_shipdate")).alias("first"))
    return li.where(F.col("first") > today.scalar()).select("l_orderkey", F.col("first").cast("string").alias("first_ship"))


def majority_lookup(spark, sf_dir):
    """The most common nation of each segment, and customers elsewhere."""
    c = table(spark, sf_dir, "customer")
    best = resolve.majority(c, "c_mktsegment", "c_nationkey")
    return c.groupBy("c_mktsegment").agg(F.count("*").alias("total")).join(F.broadcast(best), "c_mktsegment").select("c_mktsegment", "c_nationkey", "n", (F.col("total") - F.col("n")).alias("elsewhere"))  # best: one row a segment


def tiered_match(spark, sf_dir):
    """Errors are exits, signups openings; tier 1 user and payload class, tier 2 user."""
    e = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"), "user_id", (F.col("event_id") % 10).alias("k"), "event_type")
    x = e.where("event_type = 'error'").select(F.col("event_id").alias("id"), "day", F.when(F.col("user_id") % 5 == 0, "individual").otherwise("corp").alias("kind"), "user_id", "k")
    o = e.where("event_type = 'signup'").select("day", "user_id", "k")
    out = resolve.tiered_match(x, o, [["user_id", "k"], ["user_id"]], ["user_id"], "k")
    return out.withColumns({c: F.col(c).cast("string") for c in ("opened_on", "closed_on")})


def linkage_funnel(spark, sf_dir):
    """Customers located directly, through one of the same nation and segment, or not at all."""
    c = table(spark, sf_dir, "customer").withColumn("fine", F.col("c_custkey") % 7 == 0)
    fine = c.where("fine").select("c_nationkey", "c_mktsegment").distinct().withColumn("linked", F.lit(True))
    r = c.join(fine, ["c_nationkey", "c_mktsegment"], "left")
    step = F.when(F.col("fine"), "direct").when(F.col("linked"), "linked").when(F.col("c_acctbal") > 0, "permit").otherwise("rest")
    return r.groupBy(step.alias("step")).agg(F.count("*").alias("n"))


def succession_links(spark, sf_dir):
    """Per customer, the previous known priority where a finished order shows another."""
    o = table(spark, sf_dir, "orders").withColumn("holder", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")))
    out = resolve.succession(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F", "holder")
    return out.select("o_custkey", "o_orderkey", "previous", "holder")


def store_rollup(spark, sf_dir):
    """Per customer first, last, current name and number of real changes; notation twins do not count."""
    o = table(spark, sf_dir, "orders").withColumn("name", F.when(F.col("o_orderkey") % 6 == 0, "").when(F.col("o_orderkey") % 6 == 1, F.lower(F.concat(F.lit(" "), "o_orderpriority"))).otherwise(F.col("o_orderpriority")))
    order = F.struct("o_orderdate", "o_orderkey")
    g = o.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).cast("string").alias("first"), F.to_date(F.max("o_orderdate")).cast("string").alias("last"),
        F.max_by(F.when(F.col("name") != "", F.col("name")), F.when(F.col("name") != "", order)).alias("now"),
        F.count("*").alias("n"),
    )
    changes = resolve.change_counts(o, "o_custkey", ["o_orderdate", "o_orderkey"], "name", F.upper(F.trim("name")))
    return g.join(changes, "o_custkey", "left").fillna(0, ["changes"])


def change_events(spark, sf_dir):
    """Status, priority and price band of a customer's orders over time."""
    o = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    out = resolve.change_events(o, "o_custkey", "day", "o_orderkey", {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority"), "band": F.floor(F.col("o_totalprice") / 100000).cast("int")})
    return out.withColumns({c: F.col(c).cast("string") for c in ("after", "before")})


def comparable_units(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return resolve.comparable_units(o, "o_custkey", "o_orderdate", {"status": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), "price": F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).cast("string")})


def multi_vs_moved(spark, sf_dir):
    """Customers with several values at once on a day, against those whose one value moved."""
    o = table(spark, sf_dir, "orders").withColumn("day", F.date_trunc("month", "o_orderdate"))
    per = o.groupBy("o_custkey", "day").agg(F.count_distinct("o_orderstatus").alias("d"))
    all_ = o.groupBy("o_custkey").agg(F.count_distinct("o_orderstatus").alias("values"))
    r = per.groupBy("o_custkey").agg(F.max("d").alias("at_once")).join(all_, "o_custkey")
    return r.groupBy(F.when(F.col("at_once") > 1, "multi").when(F.col("values") > 1, "moved").otherwise("one").alias("class")).agg(F.count("*").alias("n"))


def hypothesis_hit(spark, sf_dir):
    """Is the last shipment within 14 days of 60 days after the order? Hits, misses, unknown."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("last"))
    off = F.abs(F.datediff("last", F.date_add(F.to_date("o_orderdate"), 60)))
    v = F.when(off.isNull(), "none").when(off <= 14, "ok").otherwise("ng")
    return o.join(li, "o_orderkey", "left").groupBy(v.alias("verdict")).agg(F.count("*").alias("n"))


def small_change_share(spark, sf_dir):
    """Price changes between a customer's adjacent orders, and how many are under one per cent."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = table(spark, sf_dir, "orders").withColumn("was", F.lag("o_totalprice").over(w)).where("was IS NOT NULL AND was <> 0")
    rel = F.abs(F.col("o_totalprice") - F.col("was")) / F.col("was")
    return o.agg(F.count("*").alias("n"), F.count_if(rel < 0.01).alias("small"), F.count_if(rel >= 0.01).alias("large"))


def planned_vs_actual(spark, sf_dir):
    """Shipped as planned, later or earlier than thirty days after the order."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    first = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("first"))
    late = F.datediff("first", F.date_add(F.to_date("o_orderdate"), 30))
    return o.join(first, "o_orderkey").agg(F.count_if(late == 0).alias("on_plan"), F.count_if(late > 0).alias("later"), F.count_if(late < 0).alias("earlier"), F.max(late).alias("latest"))


def town_gap(spark, sf_dir):
    """Three disjoint denominators by nation: no key, unreadable, readable."""
    c = table(spark, sf_dir, "customer")
    num = F.regexp_extract("c_name", r"([0-9]+)$", 1).cast("long") % 10
    return c.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count_if(num == 0).alias("missing"), F.count_if(num.isin(1, 2)).alias("unreadable"), F.count_if(num > 2).alias("readable"))


def worklist(spark, sf_dir):
    """Per code how many rows and the longest name (ties: the last in order); rows without a code are counted."""
    p = table(spark, sf_dir, "part").withColumn("code", F.when(F.col("p_size") > 5, F.col("p_size")))
    return p.groupBy("code").agg(F.count("*").alias("n"), F.max_by("p_name", F.struct(F.length("p_name"), "p_name")).alias("name"))


def bipartite_degrees(spark, sf_dir):
    """Classes of the order-supplier relation by how many partners either side has."""
    e = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("p"), F.col("l_suppkey").alias("s")).distinct()
    dp, ds = e.groupBy("p").agg(F.count("*").alias("np")), e.groupBy("s").agg(F.count("*").alias("ns"))
    k = F.when((F.col("np") == 1) & (F.col("ns") == 1), "one to one").when(F.col("np") == 1, "several orders of one supplier").when(F.col("ns") == 1, "several suppliers of one order").otherwise("many to many")
    return e.join(dp, "p").join(ds, "s").groupBy(k.alias("class")).agg(F.count("*").alias("edges"))


def search_index(spark, sf_dir):
    """The public projection in global order, blanks last."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("notified_on"), F.col("o_orderpriority").alias("kind")).orderBy(F.desc_nulls_last("notified_on"), F.desc("kind"), F.desc("o_orderkey"))


QUERIES = {f.__name__: f for f in (masked_cells, not_counted, suppressed_rates, monthly_kind_pivot, source_summary, kind_order, issue_rollup, area_profile, kind_top_areas, top_recent, future_events, majority_lookup, tiered_match, linkage_funnel, succession_links, store_rollup, change_events, comparable_units, multi_vs_moved, hypothesis_hit, small_change_share, planned_vs_actual, town_gap, worklist, bipartite_degrees, search_index)}

ORACLES = {
    "masked_cells": """
WITH s AS (SELECT n_name, CASE WHEN s_acctbal < 0 THEN 'minus' ELSE 'plus' END AS band, s_suppkey % 3 AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey),
g AS (SELECT n_name, band, count(*) AS n, bool_or(k <> 0) AS person FROM s GROUP BY ALL)
SELECT n_name, band, CASE WHEN n <= 2 AND person THEN NULL ELSE n END AS count, CASE WHEN n <= 2 AND person THEN '1-2' ELSE n::VARCHAR END AS count_label FROM g""",
    "not_counted": """
WITH r AS (SELECT CASE WHEN c_custkey IS NULL THEN 'unresolved' WHEN o_orderstatus = 'P' THEN 'undecided' WHEN o_totalprice < 2000 THEN 'gone' END AS reason
  FROM orders LEFT JOIN customer ON o_custkey + CASE WHEN o_orderkey % 11 = 0 THEN 10000000 ELSE 0 END = c_custkey)
SELECT d.reason, (SELECT count(*) FROM r WHERE r.reason = d.reason) AS n, (SELECT count(*) FROM r) AS total FROM (VALUES ('unresolved'), ('unobserved'), ('undecided'), ('gone')) d(reason)""",
    "suppressed_rates": """
WITH s AS (SELECT s_nationkey AS nation, count(*) FILTER (WHERE s_acctbal < 0) AS count FROM supplier GROUP BY ALL), c AS (SELECT c_nationkey AS nation, count(*) * 10 AS population FROM customer GROUP BY ALL),
j AS (SELECT nation, coalesce(count, 0) AS count, population, CASE WHEN coalesce(count, 0) = 0 THEN false WHEN population < 500 THEN true ELSE count BETWEEN 1 AND 2 END AS suppressed FROM c LEFT JOIN s USING (nation))
SELECT *, CASE WHEN NOT suppressed THEN round(count::DOUBLE / population, 6) END AS rate FROM j""",
    "monthly_kind_pivot": """
WITH g AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders GROUP BY ALL),
m AS (SELECT month, CASE WHEN f BETWEEN 1 AND 2 THEN NULL ELSE f END AS f, CASE WHEN o BETWEEN 1 AND 2 THEN NULL ELSE o END AS o, CASE WHEN p BETWEEN 1 AND 2 THEN NULL ELSE p END AS p FROM g)
SELECT month, f AS "F", o AS "O", p AS "P", f + o + p AS total FROM m""",
    "source_summary": "SELECT event_type, count(*) AS n, " + ", ".join(f"count(*) FILTER (WHERE user_id % 4 = {k}) AS seg{k}" for k in range(4)) + ", max(ts)::DATE::VARCHAR AS latest FROM events GROUP BY event_type",
    "kind_order": "SELECT event_type, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS place, count(*) AS n FROM events GROUP BY event_type",
    "issue_rollup": """
WITH l AS (SELECT l_shipdate::DATE AS day, l_suppkey % 50 AS issue, l_returnflag AS topic FROM lineitem),
p AS (SELECT issue, day, count(*) AS n FROM l GROUP BY ALL), d AS (SELECT issue, day FROM p QUALIFY row_number() OVER (PARTITION BY issue ORDER BY n DESC, day) = 1),
t AS (SELECT issue, count(*) AS titles, count(*) FILTER (WHERE topic = 'A') AS topic_a, count(*) FILTER (WHERE topic = 'N') AS topic_n, count(*) FILTER (WHERE topic = 'R') AS topic_r FROM l GROUP BY issue)
SELECT issue, day::VARCHAR AS day, titles, topic_a, topic_n, topic_r FROM d JOIN t USING (issue)""",
    "area_profile": "SELECT r_name, n_name, count(*) AS n, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building, min(c_acctbal) AS least, max(c_acctbal) AS largest FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
    "kind_top_areas": "WITH g AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY n DESC, c_nationkey) AS rank FROM g QUALIFY rank <= 30",
    "top_recent": """
WITH s AS (SELECT l_orderkey, max(l_shipdate) AS ship FROM lineitem GROUP BY ALL), r AS (SELECT o_orderstatus, o_orderkey, coalesce(ship, o_orderdate)::DATE AS recent FROM orders LEFT JOIN s ON l_orderkey = o_orderkey)
SELECT o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY recent DESC, o_orderkey) AS rank, o_orderkey, recent::VARCHAR AS recent FROM r QUALIFY rank <= 12""",
    "future_events": "SELECT l_orderkey, min(l_shipdate)::DATE::VARCHAR AS first_ship FROM lineitem GROUP BY ALL HAVING min(l_shipdate)::DATE > (SELECT max(o_orderdate)::DATE - 30 FROM orders)",
    "majority_lookup": "WITH g AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL), t AS (SELECT c_mktsegment, count(*) AS total FROM customer GROUP BY ALL) SELECT c_mktsegment, c_nationkey, n, total - n AS elsewhere FROM g JOIN t USING (c_mktsegment) QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY n DESC, c_nationkey) = 1",
    "tiered_match": """
WITH x AS (SELECT event_id AS id, ts::DATE AS day, user_id, event_id % 10 AS k FROM events WHERE event_type = 'error'), o AS (SELECT ts::DATE AS day, user_id, event_id % 10 AS k FROM events WHERE event_type = 'signup'),
m AS (SELECT x.*, (SELECT min(o.day) FROM o WHERE o.user_id = x.user_id AND o.k = x.k) AS o1, (SELECT min(o.day) FROM o WHERE o.user_id = x.user_id) AS o2, (SELECT count(*) FROM o WHERE o.user_id = x.user_id AND o.k <> x.k AND o.day < x.day) AS near FROM x),
r AS (SELECT *, CASE WHEN o1 < day THEN 'tier1' WHEN o2 < day THEN 'tier2' END AS label, CASE WHEN o1 < day THEN o1 WHEN o2 < day THEN o2 END AS opened FROM m)
SELECT id, coalesce(label, CASE WHEN near > 0 THEN 'near miss' END, 'none') AS match, CASE WHEN user_id % 5 <> 0 THEN opened::VARCHAR END AS opened_on, CASE WHEN user_id % 5 <> 0 THEN day::VARCHAR END AS closed_on, CASE WHEN user_id % 5 <> 0 THEN day - opened END AS days, CASE WHEN label IS NULL THEN near ELSE 0 END AS near_candidates FROM r""",
    "linkage_funnel": "WITH f AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 7 = 0) SELECT CASE WHEN c_custkey % 7 = 0 THEN 'direct' WHEN f.c_nationkey IS NOT NULL THEN 'linked' WHEN c_acctbal > 0 THEN 'permit' ELSE 'rest' END AS step, count(*) AS n FROM customer c LEFT JOIN f ON f.c_nationkey = c.c_nationkey AND f.c_mktsegment = c.c_mktsegment GROUP BY ALL",
    "succession_links": """
WITH o AS (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS holder FROM orders), p AS (SELECT *, last_value(holder IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM o)
SELECT o_custkey, o_orderkey, previous, holder FROM p WHERE o_orderstatus = 'F' AND previous <> holder""",
    "store_rollup": """
WITH o AS (SELECT o_custkey, o_orderdate, o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN lower(' ' || o_orderpriority) ELSE o_orderpriority END AS name FROM orders),
s AS (SELECT *, lag(upper(trim(name))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS was FROM o WHERE name <> ''),
c AS (SELECT o_custkey, count(*) FILTER (WHERE was <> upper(trim(name))) AS changes, arg_max(name, (o_orderdate, o_orderkey)) AS now FROM s GROUP BY ALL)
SELECT o_custkey, min(o_orderdate)::DATE::VARCHAR AS first, max(o_orderdate)::DATE::VARCHAR AS last, any_value(c.now) AS now, coalesce(any_value(c.changes), 0) AS changes, count(*) AS n FROM o LEFT JOIN c USING (o_custkey) GROUP BY o_custkey""",
    "change_events": """
WITH u AS (SELECT o_custkey, o_orderdate::DATE AS day, o_orderkey, unnest(['status', 'priority', 'band']) AS field, unnest([o_orderstatus, o_orderpriority, floor(o_totalprice / 100000)::INT::VARCHAR]) AS value FROM orders),
l AS (SELECT *, lag(value) OVER w AS bv, lag(day) OVER w AS bd FROM u WHERE value NOT IN ('', '0') WINDOW w AS (PARTITION BY o_custkey, field ORDER BY day, o_orderkey))
SELECT o_custkey, field, bv AS before_value, value AS after_value, bd::VARCHAR AS after, day::VARCHAR AS before FROM l WHERE bv <> value""",
    "comparable_units": """
WITH g AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus <> 'P') AS s, count(*) FILTER (WHERE o_totalprice > 100000) AS p FROM orders GROUP BY ALL)
SELECT 'status' AS field, count(*) FILTER (WHERE s >= 2) AS comparable FROM g UNION ALL SELECT 'price', count(*) FILTER (WHERE p >= 2) FROM g""",
    "multi_vs_moved": """
WITH p AS (SELECT o_custkey, date_trunc('month', o_orderdate) AS m, count(DISTINCT o_orderstatus) AS d FROM orders GROUP BY ALL), a AS (SELECT o_custkey, count(DISTINCT o_orderstatus) AS v FROM orders GROUP BY ALL), r AS (SELECT o_custkey, max(d) AS x FROM p GROUP BY ALL)
SELECT CASE WHEN x > 1 THEN 'multi' WHEN v > 1 THEN 'moved' ELSE 'one' END AS class, count(*) AS n FROM r JOIN a USING (o_custkey) GROUP BY ALL""",
    "hypothesis_hit": "WITH l AS (SELECT l_orderkey, max(l_shipdate)::DATE AS last FROM lineitem GROUP BY ALL) SELECT CASE WHEN last IS NULL THEN 'none' WHEN abs(last - (o_orderdate::DATE + 60)) <= 14 THEN 'ok' ELSE 'ng' END AS verdict, count(*) AS n FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY ALL",
    "small_change_share": "WITH w AS (SELECT o_totalprice AS p, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS was FROM orders) SELECT count(*) AS n, count(*) FILTER (WHERE abs(p - was) / was < 0.01::DOUBLE) AS small, count(*) FILTER (WHERE abs(p - was) / was >= 0.01::DOUBLE) AS large FROM w WHERE was <> 0",
    "planned_vs_actual": "WITH f AS (SELECT l_orderkey, min(l_shipdate)::DATE AS first FROM lineitem GROUP BY ALL), d AS (SELECT first - (o_orderdate::DATE + 30) AS late FROM orders JOIN f ON l_orderkey = o_orderkey) SELECT count(*) FILTER (WHERE late = 0) AS on_plan, count(*) FILTER (WHERE late > 0) AS later, count(*) FILTER (WHERE late < 0) AS earlier, max(late) AS latest FROM d",
    "town_gap": "WITH c AS (SELECT c_nationkey, regexp_extract(c_name, '([0-9]+)$', 1)::BIGINT % 10 AS d FROM customer) SELECT c_nationkey, count(*) AS n, count(*) FILTER (WHERE d = 0) AS missing, count(*) FILTER (WHERE d IN (1, 2)) AS unreadable, count(*) FILTER (WHERE d > 2) AS readable FROM c GROUP BY ALL",
    "worklist": "SELECT CASE WHEN p_size > 5 THEN p_size END AS code, count(*) AS n, arg_max(p_name, (length(p_name), p_name)) AS name FROM part GROUP BY ALL",
    "bipartite_degrees": """
WITH e AS (SELECT DISTINCT l_orderkey AS p, l_suppkey AS s FROM lineitem), d AS (SELECT count(*) OVER (PARTITION BY p) AS np, count(*) OVER (PARTITION BY s) AS ns FROM e)
SELECT CASE WHEN np = 1 AND ns = 1 THEN 'one to one' WHEN np = 1 THEN 'several orders of one supplier' WHEN ns = 1 THEN 'several suppliers of one order' ELSE 'many to many' END AS class, count(*) AS edges FROM d GROUP BY ALL""",
    "search_index": "SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS notified_on, o_orderpriority AS kind FROM orders",
}
