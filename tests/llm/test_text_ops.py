"""Line dedup, packing and decontamination: brute force and awkward rows."""

import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsledger.llm import decontaminate, lines, packing

SCHEMA = "doc_id long, text string, row string, bucket string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", None) for i, t in rows], SCHEMA)


def line(k):
    return f"line number {k} of the shared passage with several words more"


def brute_lines(rows, block):
    """Whole definition, every pair: lines in a run of ``block`` words or more that an earlier document holds in a row."""
    docs = [(i is None, i or 0, [x for x in (t or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]) for i, t in rows]
    clean = [[" ".join(x.split()) for x in d[2]] for d in docs]
    out = []
    for a, (i, t) in enumerate(rows):
        gone, own = set(), clean[a]
        for b in range(len(rows)):
            if docs[b][:2] < docs[a][:2]:
                for s in range(len(own)):
                    for j in range(len(clean[b])):
                        n = 0
                        while s + n < len(own) and j + n < len(clean[b]) and own[s + n] == clean[b][j + n]:
                            n += 1
                        if sum(len(x.split()) for x in own[s : s + n]) >= block:
                            gone.update(range(s, s + n))
        out.append((i, len(own), len(gone), "\n".join(x for k, x in enumerate(docs[a][2]) if k not in gone)))
    return sorted(out, key=str)


def test_line_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    pool = [" ".join([f"w{k}"] * int(n)) for k, n in enumerate(rng.integers(1, 14, 14))]
    rows = [(i, "\n".join(rng.choice(pool, int(rng.integers(0, 14))))) for i in range(60)]
    chunk = pool[2:9]
    rows += [(100 + i, "\n".join([*rng.choice(pool, 3), *chunk, *rng.choice(pool, 3), *(chunk if i % 2 else [])])) for i in range(12)] + [(None, "\n".join(chunk)), (200, "\n".join(chunk * 3)), (201, "\n".join(pool[::-1]))]
    for block in (10, 4):
        got = sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in lines.remove_shared_lines(frame(spark, rows), block_words=block).collect()), key=str)
        assert got == brute_lines(rows, block)


def test_line_dedup(spark):
    a = "\n".join(line(k) for k in range(6))
    rows = [
        (1, a), (2, f"own start here\n{a}\nown end here"), (3, "\n".join([line(3), "between stands a line", line(1)])), (4, "\n\n" + a.replace(" ", "  ") + "\n"),
        (5, "short\nline"), (6, "short\nother"), (7, None), (8, ""), (9, "\n \n"), (None, a), (20, a), (20, a), (30, "\n".join([line(2)] * 3)),
        (40, "six words stand in line one"), (41, "six words stand in line two"), (42, "six words stand in line one\nsix words stand in line two"), (50, "long text\n" * 50_000 + a), (51, "x" * 300_000),
    ]
    got = {}
    for r in lines.remove_shared_lines(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    one = lambda i: got[i][0]
    assert (one(1).n_removed, one(1).partners, one(1).kept) == (0, 0, a)
    assert (one(2).n_removed, one(2).partners, one(2).kept) == (6, 1, "own start here\nown end here")
    assert one(3).n_removed == 2  # the two cross: one is aligned, the other a moved block
    assert (one(4).n_removed, one(4).kept) == (6, "")
    assert one(6).n_removed == 0  # too few words for a block
    assert one(42).n_removed == 0  # each partner shares less than a block
    assert [(one(i).n_lines, one(i).n_removed) for i in (7, 8, 9)] == [(0, 0)] * 3
    assert one(None).n_removed == 6
    assert [(r.n_removed, r.kept) for r in got[20]] == [(6, ""), (6, "")]
    assert one(30).n_removed == 3  # each of the repeats is a block that an earlier document holds
    assert (one(50).n_removed, one(51).n_removed) == (6, 0)
    assert lines.remove_shared_lines(frame(spark, [])).count() == 0


def test_a_first_holder_that_repeats_the_passage(spark):
    a = "\n".join(line(k) for k in range(4))
    got = {r.doc_id: r.n_removed for r in lines.remove_shared_lines(frame(spark, [(1, f"{a}\nown words\n{a}"), (2, f"start\n{a}"), (3, f"{a}\nend")])).collect()}
    assert got == {1: 0, 2: 4, 3: 4}


def test_alignment_follows_the_order():
    shared = [([k], k + 5, 1, 1) for k in range(4)] + [([8], 2, 1, 2), ([5, 11], 20, 2, 1)]
    assert lines.align(shared) == [(0, 5, 4), (5, 20, 1), (8, 2, 2), (11, 20, 1)]
    assert lines.units([4, 4, 4, 12, 1], 10) == [(0, 3), (1, 4), (2, 4), (3, 4), (3, 5)]


def test_many_holders_give_one_partner_each(spark):
    rows = [(i, f"{line(0)}\n{line(1)}\nown {i}") for i in range(400)]
    got = lines.remove_shared_lines(frame(spark, rows)).groupBy("n_removed", "partners").count().collect()
    assert {tuple(r) for r in got} == {(0, 0, 1), (2, 1, 399)}


def test_increasing_is_longest():
    rng = np.random.default_rng(1)
    for _ in range(50):
        v = rng.permutation(9).tolist()
        best = max(n for n in range(10) for c in itertools.combinations(v, n) if list(c) == sorted(c))
        got = [v[i] for i in lines.increasing(v)]
        assert got == sorted(got) and len(got) == best


def test_boundaries_are_optimal():
    rng = np.random.default_rng(2)
    for _ in range(30):
        h = {int(k): int(n) for k, n in zip(rng.choice(np.arange(1, 12), 6, replace=False), rng.integers(1, 50, 6), strict=True)}
        cost = lambda bs: sum(n * min(b for b in bs if b >= k) for k, n in h.items())
        best = min(cost((*c, max(h))) for c in itertools.combinations(range(1, max(h)), min(2, max(h) - 1)))
        got = packing.best_boundaries(h, 3)
        assert len(got) <= 3 and cost(got) == best
    assert packing.best_boundaries({}) == [] and packing.best_boundaries({1: 5}, 4) == [1]


def test_packing(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "x" * int(n)) for i, n in enumerate(rng.integers(0, 500, 300))] + [(1000, "y" * 10_001), (1001, None), (1002, ""), (None, "é"), (5, "z"), (5, "z")]
    got = packing.pack(frame(spark, rows), max_tokens=1024, budget=4096, buckets=4).collect()
    want = sum(max(1, -(-len((t or "").encode()) // 1024)) for _, t in rows)
    assert len(got) == want and sum(r.n_tokens for r in got) == sum(len((t or "").encode()) for _, t in rows)
    batches = {}
    for r in got:
        assert r.n_tokens <= r.bucket_tokens and r.start == r.piece * 1024
        batches.setdefault((r.bucket_tokens, r.batch), []).append(r.slot)
    for (size, k), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= max(1, 4096 // size)
        assert len(slots) == max(1, 4096 // size) or k == max(b for s, b in batches if s == size)
    again = packing.pack(frame(spark, rows).repartition(7), max_tokens=1024, budget=4096, buckets=4)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, got), key=str)
    assert packing.pack(frame(spark, [])).count() == 0


ITEMS = [
    (1, "A train leaves the old station at 60 km per hour and Tom waits for Tom during 3 hours near the bridge"),
    (2, "Which of the seven planets in this table is the one that has no moon at all today"), (2, None), (3, "so short"), (6, "so short"), (4, "1 2 3 4 5 6 7 8 9 10 11 12"), (5, ""),
]


def test_decontamination(spark):
    same = ITEMS[1][1]
    changed = ITEMS[0][1].replace("60", "75.5").replace("km", "miles").replace("Tom", "Ann").replace(" 3 ", " 12 ")
    mixed = ITEMS[0][1].replace("and Tom", "and Ann")  # one value of the item would stand for two
    rows = [
        (1, f"Some words before. {same} and others after"), (2, same.upper()), (3, changed), (4, mixed), (5, None), (6, ""), (7, "So, short!"), (8, "9 8 7 6 5 4 3 2 1 0 1 2"), (14, "is so short here"), (15, "0 1 2 3 4 5 6 7 8 9 10 11 12 13"), (9, same[:40]),
        (10, "clean text " * 300), (11, same), (11, same), (None, same), (12, f"{changed}. {same}"), (13, same.replace("seven", "seven big")),
    ]
    bench = spark.createDataFrame([(*r, "clash") for r in ITEMS], "item_id long, text string, doc_id string")
    got = {}
    for r in decontaminate.decontaminate(frame(spark, rows), bench).collect():
        got.setdefault(r.doc_id, []).append(r)
    leaked = {i: r[0]["items"] for i, r in got.items() if r[0].leaked}
    assert leaked == {1: [2], 2: [2], 3: [1], 7: [3, 6], 11: [2], None: [2], 12: [1, 2], 15: [4]}
    assert len(got[11]) == 2 and all(r.leaked and r.n_items == 1 and r.coverage == 1.0 for r in got[11])
    kept = decontaminate.drop_leaked(frame(spark, rows), bench)
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 8, 9, 10, 13, 14]
    assert decontaminate.decontaminate(frame(spark, []), bench).count() == 0
    none = decontaminate.decontaminate(frame(spark, rows), bench.where("false"))
    assert none.where("leaked").count() == 0 and none.count() == len(rows)


def test_decontamination_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.decontaminate(frame(spark, [(1, ITEMS[1][1]), (2, "clean text " * 20), (3, ITEMS[0][1])]), bench)
    assert {r.doc_id for r in got.where("leaked").collect()} == {1, 3}


def test_native_path_has_no_python(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.decontaminate(frame(spark, [(1, ITEMS[1][1])]), bench)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_pipeline(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(5)
    words = {"en": ["the", "and", "of", "thing", "river", "house", "green"], "de": ["der", "und", "ist", "haus", "fluss", "grün", "nicht"]}
    text = lambda lang, n=60: " ".join(rng.choice(words[lang], n))
    rows = [(i, text("en" if i % 2 else "de"), "en" if i % 2 else "de", "s", 0) for i in range(60)]
    rows += [(100, rows[0][1].replace(" ", "  "), "de", "s", 0), (101, "123 !!", None, "s", 0), (102, None, None, "s", 0)]
    item = "which of the seven planets in this table is the one that has no moon at all today"
    rows += [(103, f"{text('en', 10)} {item} {text('en', 10)}", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in got}
    assert ids == set(range(1, 60)) | ({0} if len(rows[0][1]) + 59 <= len(rows[0][1]) else {100})
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, step in pipeline.STAGES[:-1]:
        docs = step(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, clashing extra columns, no rows at all."""
    pipeline = pytest.importorskip("corpus_pipeline")
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, score string, lang_pred string, row string, _row long, _keep long, k string, d string"
    extra = (1, "s", "l", "r", 2, 3, "k", "d")
    rows = [(1, "der und ist haus", "de", None, None, *extra), (1, "der und ist haus", "de", None, None, *extra), (None, "the and of house", None, "s", 1, *extra), (2, None, "en", "s", 1, *extra), (3, "", "en", "s", 0, *extra), (4, "river " * 30_000, "en", "s", 0, *extra)]
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for labelled in (True, False):
        docs = spark.createDataFrame([r if labelled else (*r[:2], None, *r[3:]) for r in rows], schema)
        for _, step in pipeline.STAGES[:-1]:
            docs = step(spark, docs, str(tmp_path))
            assert docs.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        got = docs.collect()
        assert sorted((r.doc_id for r in got), key=str) == [1, 4, None]
        assert {(r.score, r._row, r.k) for r in got} == {("s", 2, "k")}
        assert pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 2 + -(-len("river " * 30_000) // 4096)
    none = spark.createDataFrame([], schema)
    for _, step in pipeline.STAGES:
        assert step(spark, none, str(tmp_path)).count() == 0


def test_template_words(spark):
    texts = ["He met Tom Smith, paid 3.50 dollars. Then left", "5kg of x9 Mel\u0301on IN Paris's 1,000.5 Feet", "Tom", "", None, "Ünal ate ½ Éclair; iPhone 3G Straße. A Z"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select(decontaminate.template(F.col("text")).alias("t"), F.transform(decontaminate.tokens(F.col("text")), lambda t: F.coalesce(decontaminate._slot(t), F.lower(t))).alias("one")).collect()
    assert got[0].t == ["he", "met", "1", "1", "paid", "0", "2", "then", "left"]
    assert all(r.t == r.one for r in got) and got[4].t == []


def test_decontamination_tries_every_full_alignment(spark):
    item = "the baker sold 5 warm loaves in the morning and then 5 more loaves before the shop was closed"
    other = item.replace("5 warm", "3 warm").replace("5 more", "4 more")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"{other} . {item}"), (2, other), (3, f"{other} . {other}"), (4, f"{item} . {other}")]
    got = decontaminate.decontaminate(frame(spark, rows), bench)
    assert {r.doc_id for r in got.where("leaked").collect()} == {1, 4}


def test_names_that_open_sentences_are_slots(spark):
    items = [
        (1, "Tom has 5 apples in his bag. Tom eats 2 of them on the way. Tom then buys 3 more. How many apples does Tom have now?"),
        (2, "Natalia sold clips to 48 of her friends in April, and then Natalia sold half as many clips in May"),
        (3, "Who wrote Hamlet"),
    ]
    rows = [
        (1, items[0][1].replace("Tom", "Anna").replace("5", "7").replace("2", "4")), (2, items[1][1].replace("Natalia", "Marta").replace("48", "52").replace("April", "June")),
        (3, "Who wrote Hamlet"), (4, "nobody knows who wrote Hamlet in truth"), (5, items[0][1].lower()), (6, items[0][1].replace("Tom eats", "Anna eats")),
        (7, items[1][1].replace("48", "some").replace("April", "spring").replace("May", "winter")),
    ]
    got = decontaminate.decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: r["items"] for r in got.where("leaked").collect()} == {1: [1], 2: [2], 3: [3], 4: [3], 5: [1]}


def test_decontamination_of_a_long_text(spark):
    same = ITEMS[1][1]
    got = decontaminate.decontaminate(frame(spark, [(1, "filler of many words " * 40_000 + same), (2, "x" * 300_000)]), spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert {r.doc_id: r.leaked for r in got.collect()} == {1: True, 2: False}
