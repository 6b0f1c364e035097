"""Exact dedup and SimHash against brute force, with the awkward rows."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash

from obsledger.llm import exact_dedup, graph, simhash

SCHEMA = "doc_id long, text string, keep_id long, lang string"
ROWS = [
    (5, "a b\tc", 1, "en"), (3, "abc", 2, None), (9, "a  b  c", 3, "en"), (9, "a  b  c", 3, "en"), (None, "abc", 0, None),
    (7, None, 0, None), (8, "", 0, "de"), (2, " \n", 0, "de"), (11, "été", 0, "fr"), (12, "x" * 50_000, 0, "en"), (13, "unique text", 0, "en"),
]


def brute_exact(rows):
    key = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()
    groups = {}
    for r in rows:
        groups.setdefault(key(r[1]), []).append(r)
    out = []
    for sha, g in groups.items():
        best = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        kept = False
        for r in g:
            own = not kept and r[:2] == best[:2]
            kept |= own
            out.append((r[0], best[0], len(g), own, sha))
    return sorted(out, key=str)


def test_exact_matches_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = [tuple(r) for r in exact_dedup.exact_dedup(df).collect()]
    assert sorted(got, key=str) == brute_exact(ROWS)


def test_exact_in_slices_gives_the_same(spark):
    rows = ROWS + [(100 + i, f"text {i % 40}", 0, None) for i in range(5000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in exact_dedup.exact_dedup(df, max_bits=1 << 15).collect()]
    assert sorted(got, key=str) == brute_exact(rows)


def test_drop_exact_copies_keeps_rows_whole(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = exact_dedup.drop_exact_copies(df)
    assert got.columns == df.columns
    want = sorted((r[0] for r in brute_exact(ROWS) if r[3]), key=str)
    assert sorted((r.doc_id for r in got.collect()), key=str) == want
    assert got.where("doc_id = 9").first().text == "a  b  c"


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_dedup(df).count() == 0
    assert exact_dedup.drop_exact_copies(df).count() == 0
    assert simhash.near_dedup(df).count() == 0


def brute_fp(text, width=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]
    if not words:
        return 0
    sh = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        base = list(rng.choice(words, 150))
        for k in range(int(rng.integers(1, 4))):
            t = list(base)
            for _ in range(k):
                t[int(rng.integers(len(t)))] = "Éx"
            rows.append((len(rows) * 2, " ".join(t)))
    rows += [(1, None), (3, " \t"), (5, "one"), (7, "one two"), (7, "one two"), (9, "ONE two"), (11, "a b c d " * 3000)]
    fps = {}
    for i, t in rows:
        fps[i] = brute_fp(t)
    root = {i: i for i in fps}
    find = lambda i: i if root[i] == i else find(root[i])
    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.fingerprint == f"{fps[r.doc_id]:016x}"
        assert r.component_id == find(r.doc_id)


def test_split_blocks_lose_no_link(spark):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 20, 40)]
    fps = sorted({b ^ (1 << int(x)) ^ (1 << int(y)) for b in base for x, y in rng.integers(0, 62, (12, 2))} | set(base))
    df = spark.createDataFrame([(f, f) for f in fps], "node long, fp long")
    want = simhash.near_links(df, 3, group=10_000)
    got = simhash.near_links(df, 3, group=64)
    comp = lambda e: {r.node: r.root for r in graph.connected_components(e).collect()}
    brute = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3}
    root = {f: f for f in fps}
    for _ in range(len(fps)):
        for a, b in brute:
            root[a] = root[b] = min(root[a], root[b])
    linked = {f for e in brute for f in e}
    assert comp(want) == comp(got) == {f: root[f] for f in linked}


def test_near_copies_try_more_than_the_nearest(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 100_000, 300)]
    rows = [(0, " ".join(base))]
    for i in range(1200):
        t = list(base)
        for at in rng.choice(300, 5, replace=False):
            t[int(at)] = f"x{i}y{at}"
        rows.append((i + 1, " ".join(t)))
    sets = [{" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for w in (r[1].split() for r in rows)]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j]:
                common = len(sets[i] & sets[j])
                if common >= simhash.STAGE_SHARE * (len(sets[i]) + len(sets[j]) - common):
                    old, new = max(root[i], root[j]), min(root[i], root[j])
                    root = [new if r == old else r for r in root]
    got = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(root))


def test_near_copies_from_the_share_on_are_found(spark):
    rng = np.random.default_rng(6)
    rows, pairs = [], []
    for _ in range(150):
        base = [f"w{i}" for i in rng.integers(0, 100_000, 300)]
        t = list(base)
        for at in np.linspace(2, 297, 6).astype(int).tolist():
            t[at] = f"x{rng.integers(1 << 40)}"
        pairs.append((len(rows), len(rows) + 1))
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(t))]
    got = {r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {a for a, _ in pairs}


def test_bands_dealt_in_parts_lose_no_pair(spark):
    pool = [[1, 2, 3, 4, 5], [11, 12, 13, 14, 15], [21, 22, 23, 24, 25]]
    rows = [(i, pool[i % 3], [7]) for i in range(40)]
    nodes = spark.createDataFrame([(i, b) for i, _, b in rows], "node long, bands array<long>")
    sets = spark.createDataFrame([(i, bytearray([s[0]] * 160), s) for i, s, _ in rows], "node long, low binary, shingles array<int>")
    roots = spark.createDataFrame([], "node long, root long")
    _, groups = simhash.band_links(nodes, 40)
    found = graph.connected_components(simhash.rest_of_bands(groups, nodes, sets, roots, 0.8, 40, group=8)).collect()
    assert {r.node: r.root for r in found} == {i: i % 3 for i in range(40)}


def test_near_copies_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(None, text), (None, text + " more"), (1, text), (None, ""), (4, None), (5, " "), (7, text), (7, text), (8, "one two"), (9, "ONE two"), (10, "x " * 60_000), (None, "alone here"), (None, "alone here"), (11, "one"), (11, "other words")]
    df = spark.createDataFrame([(i, t, 0, 1, 2) for i, t in rows], "doc_id long, text string, row long, d long, maybe long")
    got = simhash.drop_near_copies(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, (r.text or "")[:20]) for r in got.collect()), key=str) == sorted([(1, text[:20]), (4, ""), (8, "one two"), (10, ("x " * 10)), (None, "alone here"), (None, "alone here"), (11, "one"), (11, "other words")], key=str)
    assert simhash.drop_near_copies(df.where("false")).count() == 0


def test_links_folded_in_parts_lose_none(spark, monkeypatch):
    monkeypatch.setattr(simhash, "_HELD", 3)
    rng = np.random.default_rng(4)
    fps = sorted({int(x) for x in rng.integers(0, 64, 60)} | {1 << 40, (1 << 40) + 7})
    run = simhash._links_in(3, False)
    found = [b for b in run([pa.RecordBatch.from_arrays([pa.array([0] * len(fps)), pa.array([0] * len(fps)), pa.array(fps), pa.array(fps)], ["mask", "key", "node", "fp"])])]
    root = {f: f for f in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 3:
                    root[a] = root[b] = min(root[a], root[b])
    own = {f: f for f in fps}
    for u, v in ((u, v) for b in found for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
        a, b = own[u], own[v]
        own = {f: min(a, b) if x in (a, b) else x for f, x in own.items()}
    assert own == root
