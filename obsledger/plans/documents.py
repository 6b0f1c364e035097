"""Queries on documents, pages, labels and conversations: merging, comparison, page profiling, text state."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import web
from ..operators import resolve
from ..session import table
from ..staging import staged


def _keyed(spark, sf_dir):
    return table(spark, sf_dir, "documents").withColumn("h", F.md5(tx.squash(F.lower("text"))))


def cross_source_merge(spark, sf_dir):
    """Documents equal up to case and white space, settled across sources."""
    d = _keyed(spark, sf_dir).select("h", "doc_id", "source", "n_chars", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")).alias("lang2"))
    d = staged(d, "merge-keys")  # texts are read and hashed once
    out = resolve.merge_sources(d.withColumn("article", F.lit("")), ["h"], "article", ["lang2", "n_chars"], "doc_id")
    return out.select("h", "doc_id", "lang2", "n_chars", F.array_join("sources", ",").alias("sources"), F.size("merged_keys").cast("long").alias("merged"))


def duplicate_datasets(spark, sf_dir):
    """The same language and text in at least two sources."""
    g = _keyed(spark, sf_dir).groupBy("lang", "h").agg(F.count_distinct("source").alias("n_sources"), F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))
    return g.where("n_sources >= 2").select("lang", "first_doc", "n_sources", "n")


def three_way_compare(spark, sf_dir):
    """Each later copy against the first of its text: length and language; differs > undecided > same."""
    d = _keyed(spark, sf_dir).withColumn("lang2", F.when(F.col("doc_id") % 4 != 0, F.col("lang")))
    first = d.groupBy("h").agg(F.min_by(F.struct("doc_id", "n_chars", "lang2"), "doc_id").alias("a"), F.count("*").alias("n")).where("n > 1")
    j = d.join(first, "h").where("doc_id <> a.doc_id")
    v = resolve.worst(resolve.compare(F.col("a.n_chars"), F.col("n_chars")), resolve.compare(F.col("a.lang2"), F.col("lang2")))
    return j.select(F.col("a.doc_id").alias("first_doc"), "doc_id", v.alias("verdict"))


def two_denominator_rates(spark, sf_dir):
    """Hits among labelled good and among labelled bad, separately; no overall ratio."""
    d, la = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    hit = F.col("text").rlike(r"[*#$%&!|]{2,}")
    j = d.join(la, "doc_id", "left").select("quality", hit.alias("hit"))
    g = j.agg(*(F.count_if(F.col("quality") == q).alias(f"n{q}") for q in (0, 1)), *(F.count_if((F.col("quality") == q) & F.col("hit")).alias(f"hit{q}") for q in (0, 1)), F.count_if(F.col("quality").isNull()).alias("absent"))
    return g.select("*", F.round(F.try_divide("hit0", "n0"), 6).alias("rate0"), F.round(F.try_divide("hit1", "n1"), 6).alias("rate1"))


def accuracy_vs_truth(spark, sf_dir):
    """Predicted against labelled: correct, missed, invented; ratios are null where only part is checked."""
    d, la = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    p = d.select("doc_id", "lang", F.col("text").rlike(r"[*#$%&!|]{2,}").alias("bad"))
    j = p.join(la.select("doc_id", (F.col("quality") == 0).alias("truth")), "doc_id", "full")
    g = j.groupBy("lang").agg(
        F.count("*").alias("n"), F.count("truth").alias("checked"), F.count_if(F.col("bad") & F.col("truth")).alias("correct"), F.count_if(~F.col("bad") & F.col("truth")).alias("missed"), F.count_if(F.col("bad") & ~F.col("truth")).alias("invented"),
    )
    return g.withColumn("ratio", F.when(F.col("checked") == F.col("n"), F.try_divide("correct", F.col("correct") + F.col("missed") + F.col("invented"))))


def link_harvest(spark, sf_dir):
    """Links of a page in order, with label, absolute form, host test and class."""
    p = table(spark, sf_dir, "pages")
    return web.links(p, "page_id", "url", "html").withColumn("class", web.link_class(F.col("label"), F.col("href")))


def page_shape(spark, sf_dir):
    """Counts of elements, the main content's length and a verdict."""
    p = table(spark, sf_dir, "pages")
    n = {k: F.regexp_count("html", F.lit(rf"(?i)<{k}[ >]")).cast("long").alias(f"n_{k}") for k in ("a", "p", "h1", "table", "script")}
    body = web.main_content(F.col("html"), "<article>", "</article>")
    return p.select("page_id", *n.values(), F.length(body).cast("long").alias("main_chars"), web.page_verdict(F.col("html")).alias("verdict"))


def page_verdicts(spark, sf_dir):
    """Pages per verdict."""
    return page_shape(spark, sf_dir).groupBy("verdict").agg(F.count("*").alias("n"))


def url_shapes(spark, sf_dir):
    """The most common shapes of paths, numbers as a star."""
    p = table(spark, sf_dir, "pages").select(web.url_shape(web.url_part(F.col("url"), "path")).alias("shape"))
    return p.groupBy("shape").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "shape").limit(4)


def strip_text(spark, sf_dir):
    """visible text of a page and its fingerprint."""
    t = tx.strip_tags(F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "))
    return table(spark, sf_dir, "pages").select("page_id", F.length(t).cast("long").alias("n"), F.md5(t).alias("h"))


def host_rollup(spark, sf_dir):
    """Hosts, their organisation (last two labels) and addresses that differ in more than the query."""
    p = table(spark, sf_dir, "pages")
    host = web.url_part(F.col("url"), "host")
    key = F.concat_ws("|", F.regexp_extract("url", r"^([a-z]+):", 1), host, F.regexp_replace(web.url_part(F.col("url"), "path"), "/$", ""))
    return p.select(web.organisation(host).alias("org"), host.alias("host"), key.alias("key")).groupBy("org").agg(F.count("*").alias("pages"), F.count_distinct("host").alias("hosts"), F.count_distinct("key").alias("addresses"))


def heading_state(spark, sf_dir):
    """Each line's heading in force (a line of one short sentence) and words per heading."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    head = F.when(F.length("line") < 25, F.col("line"))
    d = d.withColumn("heading", F.last(head, ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("pos")))
    return d.groupBy("doc_id", F.coalesce("heading", F.lit("")).alias("heading")).agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("chars"))


def turn_state(spark, sf_dir):
    """Conversations: the last user turn in force at every assistant turn, compared by fingerprint."""
    c = table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    asked = F.last(F.when(F.col("role") == "user", F.md5("text")), ignorenulls=True).over(w)
    return c.withColumn("asked", asked).where("role = 'assistant'").select("conv_id", "turn", "asked", F.length("text").cast("long").alias("n_chars"))


def item_states(spark, sf_dir):
    """Word counts of each benchmark item, and whether 60 % of its words are long."""
    b = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("w"))
    g = b.groupBy("item_id").agg(F.count("*").alias("n"), F.count_if(F.length("w") > 4).alias("long"))
    return g.withColumn("coerced", (F.col("n") >= 3) & (F.col("long") * 10 >= F.col("n") * 6))


def gram_neighbours(spark, sf_dir):
    """J23/K5 on embeddings: vectors per label and the largest first component."""
    e = table(spark, sf_dir, "embeddings")
    return e.groupBy("label").agg(F.count("*").alias("n"), F.max_by("vec_id", F.struct(F.get("embedding", F.lit(0)), F.col("vec_id"))).alias("top"))


QUERIES = {f.__name__: f for f in (cross_source_merge, duplicate_datasets, three_way_compare, two_denominator_rates, accuracy_vs_truth, link_harvest, page_shape, page_verdicts, url_shapes, strip_text, host_rollup, heading_state, turn_state, item_states, gram_neighbours)}

_KEYED = r"d AS (SELECT *, md5(regexp_replace(lower(text), '[\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', '', 'g')) AS h FROM documents)"
_BAD = r"regexp_matches(text, '[*#$%&!|]{2,}')"
_STRIP = r"trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '[\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))".replace('\\"', '"')

ORACLES = {
    "cross_source_merge": f"""
WITH {_KEYED}, e AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS lang2, (CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END) + (CASE WHEN n_chars = 0 THEN 0 ELSE 1 END) AS fill FROM d),
per AS (SELECT h, source, count(*) AS n FROM e GROUP BY ALL), ok AS (SELECT h, count(*) > 1 AND max(n) = 1 AS settles FROM per GROUP BY h),
r AS (SELECT e.*, settles, row_number() OVER (PARTITION BY h ORDER BY fill DESC, source, doc_id) AS rk FROM e JOIN ok USING (h)),
s AS (SELECT h, arg_min(doc_id, rk) AS doc_id, coalesce(arg_min(lang2, rk) FILTER (WHERE lang2 <> ''), '') AS lang2, arg_min(n_chars, rk) AS n_chars, string_agg(source, ',' ORDER BY source) AS sources, count(*) - 1 AS merged FROM r WHERE settles GROUP BY h)
SELECT * FROM s UNION ALL SELECT h, doc_id, lang2, n_chars, source, 0 FROM r WHERE NOT settles""",
    "duplicate_datasets": f"WITH {_KEYED} SELECT lang, min(doc_id) AS first_doc, count(DISTINCT source) AS n_sources, count(*) AS n FROM d GROUP BY lang, h HAVING count(DISTINCT source) >= 2",
    "three_way_compare": f"""
WITH {_KEYED}, e AS (SELECT *, CASE WHEN doc_id % 4 <> 0 THEN lang END AS lang2, min(doc_id) OVER (PARTITION BY h) AS f FROM d)
SELECT a.doc_id AS first_doc, b.doc_id, CASE WHEN a.n_chars <> b.n_chars OR a.lang2 <> b.lang2 THEN 'differs' WHEN a.lang2 IS NULL OR b.lang2 IS NULL THEN 'undecided' ELSE 'same' END AS verdict FROM e a JOIN e b ON a.doc_id = b.f AND b.doc_id <> a.doc_id""",
    "two_denominator_rates": f"""
WITH j AS (SELECT quality, {_BAD} AS hit FROM documents LEFT JOIN labels USING (doc_id)),
g AS (SELECT count(*) FILTER (WHERE quality = 0) AS n0, count(*) FILTER (WHERE quality = 1) AS n1, count(*) FILTER (WHERE quality = 0 AND hit) AS hit0, count(*) FILTER (WHERE quality = 1 AND hit) AS hit1, count(*) FILTER (WHERE quality IS NULL) AS absent FROM j)
SELECT *, round(hit0::DOUBLE / n0, 6) AS rate0, round(hit1::DOUBLE / n1, 6) AS rate1 FROM g""",
    "accuracy_vs_truth": f"""
WITH j AS (SELECT lang, {_BAD} AS bad, quality = 0 AS truth FROM documents LEFT JOIN labels USING (doc_id)),
g AS (SELECT lang, count(*) AS n, count(truth) AS checked, count(*) FILTER (WHERE bad AND truth) AS correct, count(*) FILTER (WHERE NOT bad AND truth) AS missed, count(*) FILTER (WHERE bad AND NOT truth) AS invented FROM j GROUP BY lang)
SELECT *, CASE WHEN checked = n THEN correct::DOUBLE / nullif(correct + missed + invented, 0) END AS ratio FROM g""",
    "link_harvest": r"""
WITH a AS (SELECT page_id, url, html, regexp_extract_all(html, '(?is)<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1) AS hs, regexp_extract_all(html, '(?is)<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2) AS ls FROM pages),
l AS (SELECT page_id, url, unnest(hs) AS href, unnest(ls) AS label, generate_subscripts(hs, 1) - 1 AS pos FROM a),
b AS (SELECT page_id, pos, href, trim(label) AS label, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href WHEN regexp_matches(href, '^[a-z]+://') THEN href ELSE regexp_extract(url, '^([a-z]+://[^?#]*/)', 1) || href END AS target, url FROM l)
SELECT page_id, pos, href, label, target, regexp_extract(target, '^[a-z]+://([^/?#:]*)', 1) = regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS same_host,
  CASE WHEN regexp_matches(lower(href), '\.(pdf)$') THEN 'pdf' WHEN regexp_matches(lower(href), '\.(xlsx?|csv)$') THEN 'table' WHEN regexp_matches(lower(label), 'record|notice|届出|記録') THEN 'record' ELSE 'page' END AS class FROM b""",
    "page_shape": r"""
WITH c AS (SELECT page_id, html, """ + ", ".join(f"len(regexp_extract_all(html, '(?i)<{k}[ >]')) AS n_{k}" for k in ("a", "p", "h1", "table", "script")) + r""", regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM pages)
SELECT page_id, n_a, n_p, n_h1, n_table, n_script, length(body) AS main_chars, CASE WHEN n_table > 0 THEN 'table' WHEN regexp_matches(lower(html), 'href="[^"]*\.(xlsx?|csv)"') THEN 'excel' WHEN regexp_matches(lower(html), 'href="[^"]*\.pdf"') THEN 'pdf' ELSE 'unknown' END AS verdict FROM c""",
    "page_verdicts": r"""SELECT CASE WHEN regexp_matches(lower(html), '<table[ >]') THEN 'table' WHEN regexp_matches(lower(html), 'href="[^"]*\.(xlsx?|csv)"') THEN 'excel' WHEN regexp_matches(lower(html), 'href="[^"]*\.pdf"') THEN 'pdf' ELSE 'unknown' END AS verdict, count(*) AS n FROM pages GROUP BY ALL""",
    "url_shapes": r"SELECT regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[0-9]+', '*', 'g') AS shape, count(*) AS n FROM pages GROUP BY ALL ORDER BY n DESC, shape LIMIT 4",
    "strip_text": f"SELECT page_id, length({_STRIP}) AS n, md5({_STRIP}) AS h FROM pages",
    "host_rollup": r"""
WITH h AS (SELECT regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host, regexp_extract(url, '^([a-z]+):', 1) AS scheme, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/$', '') AS path FROM pages)
SELECT regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS org, count(*) AS pages, count(DISTINCT host) AS hosts, count(DISTINCT scheme || '|' || host || '|' || path) AS addresses FROM h GROUP BY ALL""",
    "heading_state": r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
s AS (SELECT *, last_value(CASE WHEN length(line) < 25 THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM l)
SELECT doc_id, coalesce(heading, '') AS heading, count(*) AS n_lines, sum(length(line))::BIGINT AS chars FROM s GROUP BY ALL""",
    "turn_state": "WITH s AS (SELECT *, last_value(CASE WHEN role = 'user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS asked FROM conversations) SELECT conv_id, turn, asked, length(text) AS n_chars FROM s WHERE role = 'assistant'",
    "item_states": "WITH w AS (SELECT item_id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM benchmark) SELECT item_id, count(*) AS n, count(*) FILTER (WHERE length(w) > 4) AS long, count(*) >= 3 AND count(*) FILTER (WHERE length(w) > 4) * 10 >= count(*) * 6 AS coerced FROM w GROUP BY item_id",
    "gram_neighbours": "SELECT label, count(*) AS n, arg_max(vec_id, (embedding[1], vec_id)) AS top FROM embeddings GROUP BY label",
}
