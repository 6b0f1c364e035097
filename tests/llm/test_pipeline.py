"""The pipeline's rows against brute force over all pairs, and packing against its SQL."""

import re

import duckdb
import numpy as np
import pytest

from obsledger.llm import queries

ITEMS = [(1, "which of the seven planets in this table is the one that has no moon at all today"), (2, "Who wrote Hamlet")]


def rows():
    rng = np.random.default_rng(12)
    vocab = {"en": [f"the{x}" for x in "abcdefgh"] + ["and", "of"], "de": [f"der{x}" for x in "abcdefgh"] + ["und", "ist"]}
    out = []
    for i in range(40):
        lang = "en" if i % 2 else "de"
        base = [f"{w}{k}" for k, w in enumerate(rng.choice(vocab[lang], 90))]
        out.append((1000 - 7 * i, " ".join(base), lang))
        if i % 4 == 0:  # near copies, some within 0.8 and some not
            for k in range(3):
                t = list(base)
                for at in rng.choice(90, 1 + 2 * k, replace=False):
                    t[int(at)] = f"new{rng.integers(1 << 30)}"
                out.append((2000 + 10 * i + k, " ".join(t), lang))
        if i % 5 == 0:
            out.append((3000 + i, "  ".join(base), lang))
    out += [(1, None, "en"), (2, "", None), (3, "12 !?", "de"), (4, f"before {ITEMS[0][1]} after", "en"), (5, "Who wrote Hamlet", "en"), (6, "word " * 3000, "en"), (None, "no id here at all", None), (7, "tiny", None)]
    return out


def survivors(data):
    kept = [r for r in data if re.search(r"[^\W\d_]", r[1] or "")]
    best = {}
    for r in kept:
        key = re.sub(r"[\x20\x09-\x0D]", "", r[1])
        order = (-len(r[1]), r[0] is None, r[0] or 0)
        if key not in best or order < best[key][0]:
            best[key] = (order, r)
    kept = [r for _, r in best.values()]
    sets = []
    for r in kept:
        w = r[1].lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(kept)))
    for i in range(len(kept)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    out = []
    for g in set(root):
        out.append(min((r for k, r in enumerate(kept) if root[k] == g), key=lambda r: (r[0] is None, r[0] or 0)))
    return [r for r in out if not any(item.lower() in r[1].lower() for _, item in ITEMS)]


def test_pipeline_matches_brute_force(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    data, folder = rows(), str(tmp_path)
    spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in data], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    want = survivors(data)
    spark.createDataFrame([(i, t) for i, t, _ in want], "doc_id long, text string").write.parquet(f"{folder}/kept.parquet")
    got = [tuple(r) for r in pipeline.run(spark, folder).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/kept.parquet/*.parquet'")
    sql = con.execute(f"SELECT doc_id, piece, start, n_tokens, bucket_tokens, batch, slot FROM ({queries.ORACLES['op7_packing']})").fetchall()
    assert sorted(got, key=str) == sorted(sql, key=str)
    assert {i for i, *_ in got} == {i for i, *_ in want}
