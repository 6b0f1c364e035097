"""The registered queries ``opN_<name>``: thin digests of the operators over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, langid, licenses, lines, packing, quality, secrets, simhash, substrings


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"])
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(F.transform("places", lambda p: p["label"])).alias("base_labels"), joined(F.map_keys("labels")).alias("labels"),
        F.coalesce(F.array_max(F.map_values("labels")), F.lit(0.0)).alias("score"),
    )


def _remainder(name: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(parts))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.remove_shared_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    profiles = langid.fit_profiles(docs.where(_remainder("doc_id", 4) != 2))
    return langid.identify(docs.select("doc_id", "text"), profiles).select("doc_id", F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"), lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(5)) != 0)
    return quality.score(docs, model).select("doc_id", F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digest(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *(count(k) for k in secrets.BASE), F.sha2(text(base), 256).alias("base_sha256"), text("secrets").alias("spans"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumn("items", F.array_join("items", ","))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_line_dedup": op3_line_dedup,
    "op4_language_id": op4_language_id,
    "op5_quality": op5_quality,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_packing": op7_packing,
    "op8_secret_scan": op8_secret_scan,
    "op9_decontamination": op9_decontamination,
    "op10_simhash": op10_simhash,
}


def _packing_sql() -> str:
    """The dynamic program unrolled, one common table a bucket; ties go to the lowest bound, as in the operator."""
    m, s, k, budget = packing.MAX_TOKENS, packing.STEP, packing.BUCKETS, packing.BUDGET
    steps = "\n".join(
        f"c{i} AS (SELECT j, min(cost * 100000 + i) AS best FROM (SELECT b.j, a.j AS i, a.cost + (b.below - a.below) * b.j AS cost FROM d{i - 1} a JOIN bins b ON a.j <= b.j) GROUP BY j),\n"
        f"d{i} AS (SELECT c.j, c.best // 100000 AS cost, c.best % 100000 AS back, bins.below FROM c{i} c JOIN bins USING (j)),"
        for i in range(1, k + 1)
    )
    bounds = "\n".join(f"b{i} AS (SELECT {f'd{i + 1}.back' if i < k else 'j'} AS spot FROM {f'd{i + 1} JOIN b{i + 1} ON d{i + 1}.j = b{i + 1}.spot' if i < k else 'top'})," for i in range(k, 0, -1))
    union = " UNION ".join(f"SELECT spot FROM b{i}" for i in range(1, k + 1))
    return f"""
WITH n AS (SELECT doc_id, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS name, coalesce(strlen(text), 0)::BIGINT AS n FROM documents),
pieces AS (SELECT doc_id, name, n, unnest(range(greatest(1, (n + {m - 1}) // {m}))) AS piece FROM n),
seq AS (SELECT doc_id, piece, piece * {m} AS start, least(n - piece * {m}, {m}) AS n_tokens,
        md5(name || ':' || piece::VARCHAR) AS key FROM pieces),
st AS (SELECT *, greatest(1, (n_tokens + {s - 1}) // {s}) AS steps FROM seq),
top AS (SELECT max(steps) AS j FROM st),
bins AS (SELECT j, (SELECT count(*) FROM st WHERE steps <= j) AS below FROM (SELECT unnest(range(0, (SELECT j FROM top) + 1)) AS j)),
d0 AS (SELECT j, CASE WHEN j = 0 THEN 0 ELSE 1000000000000 END AS cost, 0 AS back, below FROM bins),
{steps}
{bounds}
bounds AS (SELECT DISTINCT spot FROM ({union}) WHERE spot > 0),
dealt AS (SELECT st.*, (SELECT min(spot) FROM bounds WHERE spot >= st.steps) AS bucket FROM st),
numbered AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY key, doc_id, piece, n_tokens) - 1 AS spot,
             greatest(1, {budget} // (bucket * {s})) AS room FROM dealt)
SELECT doc_id, piece, start, n_tokens, bucket * {s} AS bucket_tokens, spot // room AS batch, spot % room AS slot FROM numbered
"""


def _decontamination_sql() -> str:
    """Tokens are judged one by one here, and windows compared as text; rules as in the operator's docstrings."""
    low = lambda words: ", ".join(f"'{u}'" for u in words)
    mark = f"CASE WHEN regexp_matches(t, '^\\p{{N}}') THEN '0' WHEN regexp_full_match(t, '\\p{{Lu}}\\p{{Ll}}+') AND lower(t) NOT IN ({low(decontaminate.OPENERS)}) THEN '1' WHEN lower(t) IN ({low(decontaminate.UNITS)}) THEN '2' END"
    toks = "regexp_extract_all(coalesce(text, ''), '[\\p{L}\\p{M}]+|\\p{N}+(?:[.,]\\p{N}+)*')"
    w, share, plain = decontaminate.WIDTH, decontaminate.SHARE, decontaminate.PLAIN
    windows = lambda key, words, table: f"SELECT {key}, spot, array_to_string({words}[spot + 1:spot + {w}], ' ') AS h, {words}[spot + 1:spot + {w}] AS win FROM (SELECT {key}, {words}, unnest(range(0, len({words}) - {w - 1})) AS spot FROM {table} WHERE len({words}) >= {w})"
    return f"""
WITH d0 AS (SELECT doc_id, toks, list_transform(toks, lambda t: {mark}) AS marks FROM (SELECT doc_id, {toks} AS toks FROM documents)),
d AS (SELECT *, list_transform(toks, lambda t, i: coalesce(marks[i], lower(t))) AS canon, list_transform(toks, lambda t: lower(t)) AS lows FROM d0),
b0 AS (SELECT item_id, toks, list_transform(toks, lambda t: {mark}) AS marks FROM (SELECT item_id, {toks} AS toks FROM benchmark WHERE text IS NOT NULL)),
b AS (SELECT *, list_transform(toks, lambda t, i: coalesce(marks[i], lower(t))) AS canon, list_transform(toks, lambda t: lower(t)) AS lows,
      list_transform(toks, lambda t, i: CASE WHEN marks[i] = '1' THEN CASE WHEN lower(t) IN ({low(decontaminate.UNITS)}) THEN '2' ELSE lower(t) END ELSE coalesce(marks[i], lower(t)) END) AS flat FROM b0),
own AS (SELECT item_id, spot, h FROM ({windows('item_id', 'canon', 'b')}) WHERE len(list_filter(win, lambda x: x NOT IN ('0', '1', '2'))) >= {plain}),
bw AS (SELECT * FROM own UNION SELECT f.item_id, f.spot, f.h FROM ({windows('item_id', 'flat', 'b')}) f SEMI JOIN own USING (item_id, spot)),
total AS (SELECT item_id, count(*) AS total FROM own GROUP BY ALL),
dw AS ({windows('doc_id', 'canon', 'd')}),
m AS (SELECT doc_id, item_id, bw.spot, dw.spot - bw.spot AS shift FROM dw JOIN bw USING (h)),
runs AS (SELECT doc_id, item_id, shift, total, count(DISTINCT spot) AS n FROM m JOIN total USING (item_id) GROUP BY ALL),
tried AS (SELECT doc_id, item_id, shift FROM runs QUALIFY n >= {share}::DOUBLE * total OR row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n DESC, shift) = 1),
cov AS (SELECT doc_id, item_id, count(DISTINCT spot) AS n FROM m GROUP BY ALL),
cand AS (SELECT doc_id, item_id, n::DOUBLE / total AS coverage FROM cov JOIN total USING (item_id) WHERE n >= {share}::DOUBLE * total),
spots AS (SELECT doc_id, item_id, shift, unnest(range(1, len(b.toks) + 1)) AS i, b.lows AS bl, b.marks AS bm, d.lows AS dl, d.marks AS dm
          FROM cand JOIN tried USING (doc_id, item_id) JOIN b USING (item_id) JOIN d USING (doc_id)),
slots AS (SELECT doc_id, item_id, shift, bl[i] AS a, CASE WHEN i + shift >= 1 THEN dl[i + shift] END AS v, bm[i] AS am, CASE WHEN i + shift >= 1 THEN dm[i + shift] END AS vm FROM spots WHERE bm[i] IS NOT NULL),
judged AS (SELECT doc_id, item_id, shift, count(*) AS n, count(*) FILTER (WHERE NOT coalesce(am = vm, false) AND NOT coalesce(a = v, false)) AS broken,
           count(DISTINCT (a, v)) FILTER (WHERE coalesce(am = vm, false) OR coalesce(a = v, false)) AS pairs, count(DISTINCT a) FILTER (WHERE coalesce(am = vm, false) OR coalesce(a = v, false)) AS vals
           FROM slots GROUP BY ALL),
bad AS (SELECT doc_id, item_id FROM judged GROUP BY ALL HAVING bool_and(pairs > vals OR broken > (1 - {share}::DOUBLE) * n)),
short AS (SELECT item_id, lows FROM b ANTI JOIN total USING (item_id) WHERE len(lows) > 0),
whole AS (SELECT doc_id, item_id, 1.0::DOUBLE AS coverage FROM d, short WHERE CASE WHEN len(short.lows) < {plain} THEN d.lows = short.lows
          ELSE contains(chr(1) || array_to_string(d.lows, chr(1)) || chr(1), chr(1) || array_to_string(short.lows, chr(1)) || chr(1)) END),
every AS (SELECT doc_id, item_id, coverage FROM cand ANTI JOIN bad USING (doc_id, item_id) UNION ALL SELECT * FROM whole),
leaks AS (SELECT doc_id, list(DISTINCT item_id ORDER BY item_id) AS items, max(coverage) AS coverage FROM every GROUP BY doc_id)
SELECT doc_id, items IS NOT NULL AS leaked, coalesce(len(items), 0) AS n_items, coalesce(array_to_string(items, ','), '') AS items, coalesce(coverage, 0.0) AS coverage
FROM documents LEFT JOIN leaks USING (doc_id)
"""


def _secrets_sql() -> str:
    """The rules as expressions: kind, expression (RE2), its group that must be long, least length; spans from what stands between matches."""
    fold = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    names = "|".join(fold(w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    kinds = [
        ("assign", f"""({names})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16), ("github", "gh[oprsu]_[A-Za-z0-9]+", 0, 24),
        ("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15), ("stripe", "[rs]k_live_[A-Za-z0-9]+", 0, 24), ("google", "AIza[A-Za-z0-9_-]+", 0, 24), ("jwt", "eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 36),
        ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ]
    found = " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS k, '{kind}' AS kind, start, start + size AS stop FROM (
  SELECT doc_id, unnest(list_transform(sizes, lambda x, i: list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0)))::BIGINT AS start, unnest(sizes) AS size, unnest(tails) AS tail FROM (
    SELECT doc_id, list_transform(string_split_regex(text, '{p}'), lambda x: length(x)) AS gaps, list_transform(regexp_extract_all(text, '{p}'), lambda x: length(x)) AS sizes,
           list_transform(regexp_extract_all(text, '{p}', {group}), lambda x: length(x)) AS tails FROM t WHERE regexp_matches(text, '{p}'))) WHERE tail >= {least}"""
        for k, (kind, p, group, least) in enumerate(kinds)
    )
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({found}),
g AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS a, count(*) FILTER (WHERE k = 1) AS b, count(*) FILTER (WHERE k = 2) AS c,
      string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (WHERE k < 3) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN g USING (doc_id)
"""


def _license_sql() -> str:
    """Votes of the index's postings by start, within the drift; then key phrases and score in the window around it."""
    post, phrases = licenses._index()
    lists = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    places = ", ".join(f"('{w}', {k}, {i})" for w, found in post.items() for k, i in found)
    rules = ", ".join(f"({k}, '{label}', {lists(words)}, {'NULL' if keys is None else lists(' '.join(x) for x in keys)}, {need}, {drift})" for k, (label, words, keys, need, drift) in enumerate(phrases))
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM documents),
post(word, k, i) AS (VALUES {places}), rule(k, label, own, keys, need, drift) AS (VALUES {rules}),
x AS (SELECT doc_id, word, p FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS p FROM w) WHERE word IN (SELECT word FROM post)),
v AS (SELECT doc_id, k, p - i AS s, count(*) AS n FROM x JOIN post USING (word) GROUP BY ALL),
base AS (SELECT doc_id, s, label FROM v JOIN rule USING (k) WHERE keys IS NULL AND n >= need AND s >= 0),
cand AS (SELECT a.doc_id, a.k, a.s FROM v a JOIN rule r ON r.k = a.k AND r.keys IS NOT NULL JOIN v b ON b.doc_id = a.doc_id AND b.k = a.k AND b.s BETWEEN a.s - r.drift AND a.s + r.drift GROUP BY a.doc_id, a.k, a.s, r.need HAVING sum(b.n) >= r.need),
win AS (SELECT c.doc_id, c.k, c.s, r.label, r.own, r.keys, w.ws, greatest(c.s - r.drift, 0) AS first, c.s + len(r.own) + r.drift AS last FROM cand c JOIN rule r USING (k) JOIN w USING (doc_id)),
met AS (SELECT doc_id, label, len(list_filter(own, lambda o: list_contains(ws[first + 1:last], o)))::DOUBLE / len(own) AS score FROM win
        WHERE len(list_filter(keys, lambda q: contains(' ' || array_to_string(ws[first + 1:last + len(string_split(q, ' ')) - 1], ' ') || ' ', ' ' || q || ' '))) = len(keys)),
every AS (SELECT doc_id, label, 1.0::DOUBLE AS score FROM base UNION ALL SELECT * FROM met),
l AS (SELECT doc_id, array_to_string(list(DISTINCT label ORDER BY label), ',') AS labels, max(score) AS score FROM every GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n, min(s) AS first_word, max(s) AS last_word, array_to_string(list(DISTINCT label ORDER BY label), ',') AS base_labels FROM base GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM w LEFT JOIN g USING (doc_id) LEFT JOIN l USING (doc_id)
"""


ORACLES = {
    "op2_license_scan": _license_sql(),
    "op8_secret_scan": _secrets_sql(),
    "op3_line_dedup": rf"""
WITH raw AS (SELECT doc_id, line, i FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
             WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
l AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS clean FROM raw),
c AS (SELECT *, len(string_split(clean, ' ')) AS words, sum(len(string_split(clean, ' '))) OVER (PARTITION BY doc_id ORDER BY p) AS upto FROM l),
ranges AS (SELECT a.doc_id, a.p AS s, b.p AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.p BETWEEN a.p AND a.p + {lines.BLOCK_WORDS - 1} WHERE b.upto - a.upto + a.words >= {lines.BLOCK_WORDS}),
least AS (SELECT doc_id, s, min(e) AS e FROM ranges GROUP BY doc_id, s UNION SELECT doc_id, max(s) AS s, e FROM ranges GROUP BY doc_id, e),
unit AS (SELECT least.doc_id, s, e, string_agg(clean, chr(10) ORDER BY p) AS key FROM least JOIN c ON c.doc_id = least.doc_id AND p BETWEEN s AND e GROUP BY ALL),
later AS (SELECT doc_id, s, e FROM unit QUALIFY doc_id > min(doc_id) OVER (PARTITION BY key)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS p FROM later),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS kept, count(*) AS n FROM l ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
total AS (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines, 0) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op7_packing": _packing_sql(),
    "op9_decontamination": _decontamination_sql(),
    "op6_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20)),
rep AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM rep),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
""",
    "op1_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
""",
}
