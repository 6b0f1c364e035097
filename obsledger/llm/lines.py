"""Line dedup by pairwise alignment of overlapping documents.

A line of ``block_words`` words or more is hashed by itself; a shorter one together with the lines after it,
and with those before it, up to that many words. Such a unit is the least block that counts, so two documents
have a common block exactly where they share units. Each shared unit, rare ones first, leads a document to the
earliest document that holds it: one partner a unit, never all pairs of its holders, whatever their number.
With each partner the document is aligned by patience diff (units that both hold once, the longest run of them
in the same order, then repeated ones between these); what crosses that order stands as a moved block. Aligned
units on one diagonal merge into blocks, which are contiguous on both sides, and go from the later document.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, join_groups, maybe_in, rows_of, scratch, stage

#: Words that a common block needs in order to be deleted.
BLOCK_WORDS = 10


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience sorting)."""
    tops, piles, back = [], [], []
    for k, v in enumerate(values):
        p = bisect_left(tops, v)
        if p == len(tops):
            tops.append(v)
            piles.append(k)
        else:
            tops[p], piles[p] = v, k
        back.append(piles[p - 1] if p else -1)
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def split_lines(text: bytes) -> tuple[list[bytes], list[list[bytes]]]:
    """The lines that hold more than white space, as written and as words."""
    both = [(x, w) for x in text.split(b"\n") if (w := x.split())]
    return [x for x, _ in both], [w for _, w in both]


def units(words: list[int], block_words: int) -> list[tuple[int, int]]:
    """Ranges (start, stop) of lines that are least, from either end, among those of ``block_words`` words or more."""
    out, total, stop = set(), 0, 0
    for start in range(len(words)):
        while stop < len(words) and total < block_words:
            total += words[stop]
            stop += 1
        if total < block_words:
            break
        out.add((start, stop))
        total -= words[start]
    total, start = 0, len(words)
    for stop in range(len(words), 0, -1):
        while start > 0 and total < block_words:
            start -= 1
            total += words[start]
        if total < block_words:
            break
        out.add((start, stop))
        total -= words[stop - 1]
    return sorted(out)


def align(shared: list[tuple[list[int], int, int, int]]) -> list[tuple[int, int, int]]:
    """Common blocks (start here, start there, lines) of two documents, by patience diff over shared units.

    ``shared``: for each unit (starts here, first start there, times there, lines). Units single on both sides
    anchor the alignment; of those that cross, the longest ordered run stays. Repeated and crossing units are
    then put in order between the anchors where they fit, and stand as moved blocks where they do not.
    """
    anchors = sorted((here[0], there, n) for here, there, times, n in shared if len(here) == 1 and times == 1)
    kept = [anchors[k] for k in increasing([t for _, t, _ in anchors])]
    rest = sorted({(h, there, n) for here, there, _, n in shared for h in here}.difference(kept))
    starts, fits, moved = [h for h, *_ in kept], [], []
    for h, t, n in rest:
        at = bisect_left(starts, h)
        inside = (not at or kept[at - 1][1] < t) and (at == len(kept) or t < kept[at][1])
        (fits if inside else moved).append((h, t, n))
    chosen = set(increasing([t for _, t, _ in fits]))
    moved += [x for k, x in enumerate(fits) if k not in chosen]
    blocks: list[list[int]] = []
    for h, t, n in sorted([*kept, *(fits[k] for k in chosen), *moved], key=lambda x: (x[1] - x[0], x[0])):
        if blocks and blocks[-1][1] - blocks[-1][0] == t - h and h <= blocks[-1][0] + blocks[-1][2]:
            blocks[-1][2] = max(blocks[-1][2], h + n - blocks[-1][0])
        else:
            blocks.append([h, t, n])
    return sorted(map(tuple, blocks))


def common_blocks(found: list[tuple[int, int, list[int], int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(partner, start here, start there, lines) of one document from its shared units (holders, partner, starts
    here, lines, start there, times there). The partner of the rarest unit goes first; one whose units already
    lie in blocks is not aligned."""
    partners: dict[int, list] = {}
    for holders, first, here, n, there, times in found:
        partners.setdefault(first, []).append((holders, here, there, times, n))
    gone, out = set(), []
    for first, shared in sorted(partners.items(), key=lambda x: (min(s[0] for s in x[1]), -len(x[1]), x[0])):
        if all(p in gone for _, here, _, _, n in shared for h in here for p in range(h, h + n)):
            continue
        blocks = align([s[1:] for s in shared])
        out += [(first, *b) for b in blocks]
        gone.update(p for h, _, n in blocks for p in range(h, h + n))
    return out


def _send(block_words: int):
    """Rows (id, row, text) -> a row for each distinct unit: id, row, h, here, lines."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                owner, keys, starts, sizes = [], [], [], []
                for k, (text,) in enumerate(rows_of([part.select(["text"])], 32)):
                    words = split_lines(text)[1]
                    clean = [b" ".join(w) for w in words]
                    held: dict = {}
                    for s, e in units([len(w) for w in words], block_words):
                        held.setdefault((xxhash.xxh3_128_digest(b"\n".join(clean[s:e])), e - s), []).append(s)
                    owner += [k] * len(held)
                    keys += [h for h, _ in held]
                    sizes += [n for _, n in held]
                    starts += held.values()
                take = pa.array(owner, pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("id").take(take), part.column("row").take(take), pa.array(keys, pa.binary()), pa.array(starts, pa.list_(pa.int32())), pa.array(sizes, pa.int32())], ["id", "row", "h", "here", "lines"])

    return run


def _solve():
    """Shared units sorted by document -> (row, blocks)."""
    kind = pa.list_(pa.struct([("partner", pa.int64()), ("start", pa.int32()), ("there", pa.int32()), ("lines", pa.int32())]))

    def batch_of(out):
        blocks = [[{"partner": p, "start": h, "there": t, "lines": n} for p, h, t, n in b] for _, b in out]
        return pa.RecordBatch.from_arrays([pa.array([r for r, _ in out], pa.int64()), pa.array(blocks, kind)], ["row", "blocks"])

    def run(batches):
        now, found, out = None, [], []
        for row, *rest in rows_of(batches):
            if row != now and found:
                out.append((now, common_blocks(found)))
                found = []
                if len(out) >= 1000:
                    yield batch_of(out)
                    out = []
            now = row
            found.append(tuple(rest))
        if found:
            out.append((now, common_blocks(found)))
        if out:
            yield batch_of(out)

    return run


def shared_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(row, blocks): for rows that overlap earlier ones, their common blocks (partner row, start, start there, lines).

    ``row`` is the hash of id and text; lines are counted from 0 among the non-blank ones. Of rows with one id
    and other texts, the one of lesser ``row`` is the earlier. Null and empty texts overlap nothing; repeated
    rows are one document; no rows give no blocks.
    """
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), as_bytes(text_col).alias("text"))
    own = stage(rows.mapInArrow(_send(block_words), f"id {kind}, row long, h binary, here array<int>, lines int"), "line-units")
    n = own.count()
    first = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "row", F.col("here")[0].alias("there"), F.size("here").alias("times"))).alias("first")
    groups = stage(own.groupBy("h").agg(first, F.count("*").alias("holders")).where("holders > 1").select("h", "holders", F.col("first.row").alias("first_row"), "first.there", "first.times"), "line-first")
    met = join_groups(own, groups, "h", "holders", n).where("row <> first_row").select("row", "holders", "first_row", "here", "lines", "there", "times")
    return met.repartition("row").sortWithinPartitions("row").mapInArrow(_solve(), "row long, blocks array<struct<partner:long,start:int,there:int,lines:int>>")


def remove_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per input row: id, ``n_lines`` (non-blank), ``n_removed``, ``partners`` (documents it was aligned
    with to some block), ``kept`` (the other lines as written, joined by newlines).

    A line goes exactly if it lies in a run of consecutive non-blank lines, of ``block_words`` words or more,
    that an earlier row (smaller id, null ids last) holds as consecutive lines too. Rows alike in id and text
    are one document and keep the same lines. Null and empty texts have no lines; white space inside a line does
    not count for its identity; repeats inside one document are not deleted. Only rows with blocks shuffle their
    text, the others pass through the scan. No rows in, no rows out.
    """
    with scratch() as keep:
        found = keep(stage(shared_blocks(docs, id_col, text_col, block_words), "line-blocks"))
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), as_bytes(text_col).alias("text"))
    rows = rows.withColumn("maybe", maybe_in(found, "row"))
    whole = rows.where(~F.col("maybe")).select("id", "text", F.lit(None).cast(found.schema["blocks"].dataType).alias("blocks"))
    some = rows.where("maybe").join(found, "row", "left").select("id", "text", "blocks")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for text, blocks in rows_of([part.select(["text", "blocks"])], 32):
                    lines = split_lines(text)[0]
                    gone = {p for b in blocks or () for p in range(b["start"], b["start"] + b["lines"])}
                    out.append((len(lines), len(gone), len({b["partner"] for b in blocks or ()}), b"\n".join(x for k, x in enumerate(lines) if k not in gone).decode("utf-8", "replace")))
                cols = [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays([part.column("id"), *cols], ["id", "n_lines", "n_removed", "partners", "kept"])

    schema = f"id {kind}, n_lines long, n_removed long, partners long, kept string"
    return whole.mapInArrow(run, schema).unionByName(some.mapInArrow(run, schema)).withColumnRenamed("id", id_col)
