"""Substring dedup by super-k-mer partitioning.

A window is ``width`` consecutive words. Its minimiser is the least hash among its ``M``-word pieces;
neighbouring windows mostly share it, and such a run of windows travels as one packed string (a
super-k-mer) to the bucket of its minimiser, so that equal windows always meet. Pieces that many rows
share come last in that order: a window takes one only if it has no other, so that a common phrase does
not draw the texts around it into one bucket. In a bucket the windows are sorted by a hash of their
bytes, equal ones are compared as text, and of equal windows all but the earliest are repeats. Equal
packed strings inside a map task travel once, which keeps common passages from filling a bucket.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import as_bytes, bitmap_of, in_bitmap, maybe_of, rows_of, stage

#: Words of a window, words of a minimiser.
WIDTH, M = 20, 4
#: Bytes of packed strings, as Python objects, that a map task holds before it sends them.
HOLD = 32 << 20
#: Packed bytes that one bucket is meant to get; sets how many buckets there are. Most reduce tasks.
BUCKET, MAX_TASKS = 4 << 20, 100_000
#: Rows (expected) of the sample that finds common pieces, rows of it that make one common, bits of their filter.
#: The sample decides only which bucket windows meet in, never what is found.
SAMPLE_ROWS, COMMON, COMMON_BITS = 1 << 16, 8, 1 << 24
#: Bytes whose windows are hashed at a time.
_BLOCK = 1 << 19
_LAST = (1 << 63) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def minimisers(words: list[bytes], width: int = WIDTH, m: int = M, common: np.ndarray | None = None) -> np.ndarray:
    """The least hash of an ``m``-word piece in each window; pieces in ``common`` (a bitmap) come after all others."""
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) * _MIX
    piece = h[: len(h) - m + 1].copy()
    for k in range(1, m):
        piece = ((piece ^ (piece >> np.uint64(29))) * _MIX + h[k : len(h) - m + 1 + k]).astype(np.uint64)
    piece ^= piece >> np.uint64(32)
    piece *= _MIX
    piece >>= np.uint64(1)
    if common is not None:
        at = piece & np.uint64(COMMON_BITS - 1)
        piece |= ((common[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)).astype(np.uint64) << np.uint64(63)
    span, low, size = width - m + 1, piece, 1
    while size * 2 <= span:  # minimum over a window by doubling
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(low) - (span - size)], low[span - size :]) if span > size else low


def super_kmers(words: list[bytes], width: int = WIDTH, m: int = M, common: np.ndarray | None = None):
    """(minimiser, first window, end window) for each run of windows that share a minimiser."""
    if len(words) < width:
        return
    low = minimisers(words, width, m, common)
    cut = np.flatnonzero(low[1:] != low[:-1]) + 1
    starts = np.concatenate(([0], cut))
    yield from zip(low[starts].tolist(), starts.tolist(), np.append(cut, len(low)).tolist(), strict=True)


def _pack_ranges(ranges) -> bytes:
    return np.array(ranges, np.int64).tobytes()


def _pack(items: list[tuple[int, int, int, bytes]]) -> bytes:
    """Super-k-mers (doc, row, start, text) in one compressed string; the numbers by column and byte, for size."""
    head = np.array([(d, r, s) for d, r, s, _ in items], np.int64)
    head[1:, 0] -= head[:-1, 0].copy()
    planes = np.ascontiguousarray(head.view(np.uint8).T)
    return zstandard.compress(len(items).to_bytes(8, "little") + planes.tobytes() + b"\n".join(p for *_, p in items) + b"\n", 3)


def _unpack(blob: bytes) -> tuple[np.ndarray, bytes]:
    """(doc, row, start) of each super-k-mer and their texts, a newline after each."""
    raw = zstandard.decompress(blob)
    n = int.from_bytes(raw[:8], "little")
    head = np.frombuffer(raw, np.uint8, n * 24, 8).reshape(24, n).T.copy().view(np.int64)
    head[:, 0] = head[:, 0].cumsum()
    return head, raw[8 + n * 24 :]


def _map(n_buckets: int, width: int, common):
    """Rows (bucket, kind, doc, row, data): packed super-k-mers (kind 0), or window ranges known to repeat (kind 1)."""

    def send(held, again):
        repeats: dict = {}
        by: dict[int, list] = {}
        for packed, (low, doc, row, start) in held.items():
            by.setdefault(low % n_buckets, []).append((doc, row, start, packed))
        for packed, places in again.items():
            for d, r, s in places:
                repeats.setdefault((d, r), []).append((s, s + packed.count(b" ") + 2 - width))
        held.clear()
        again.clear()
        while by:
            b, items = by.popitem()
            yield (b, 0, 0, 0, _pack(items))
        for k, v in repeats.items():
            yield (zlib.crc32(b"%d:%d" % k) % n_buckets, 1, *k, _pack_ranges(v))

    def batches_of(rows):
        while part := list(islice(rows, 512)):
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["bucket", "kind", "doc", "row", "data"])

    def run(batches):
        held, again, size, flags = {}, {}, 0, np.frombuffer(common.value, np.uint8) if common else None
        for doc, row, text in rows_of(batches, 64):
            words = (text or b"").split()
            if len(words) < width:
                continue
            doc = _LAST if doc is None else doc
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            begin = np.concatenate(([0], ends[:-1])).tolist()
            ends = ends.tolist()
            for low, a, b in super_kmers(words, width, common=flags):
                packed = joined[begin[a] : ends[b + width - 2] - 1]
                had = held.get(packed)
                if had is None:
                    held[packed] = (low, doc, row, a)
                    size += len(packed) + 320  # with the Python objects
                    if size > HOLD:
                        yield from batches_of(send(held, again))
                        size = 0
                    continue
                now = (doc, row, a)
                if had[1:] != now:  # else the same row again
                    if now < had[1:]:
                        held[packed], now = (low, *now), had[1:]
                    again.setdefault(packed, []).append(now)
                    size += 160
        if held:
            yield from batches_of(send(held, again))

    return run


def _hashed(data: np.ndarray, width: int):
    """(text, word, start, stop, hash) of each window of newline-ended texts; equal windows have equal hashes.

    The hash is a polynomial over the window's bytes, taken from sums over all that stand before.
    """
    ends = np.flatnonzero((data == 32) | (data == 10))
    last = data[ends] == 10
    text = np.cumsum(last) - last
    begin = np.concatenate(([0], ends[:-1] + 1))
    word = np.arange(len(ends)) - np.concatenate(([0], np.flatnonzero(last) + 1))[text]
    ok = np.flatnonzero(text[width - 1 :] == text[: len(text) - width + 1]) if len(ends) >= width else np.zeros(0, np.int64)
    start, stop = begin[ok], ends[ok + width - 1]
    power, inverse = _powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), (data * power[: len(data)]).cumsum()))
    h = (sums[stop] - sums[start]) * inverse[start]
    h ^= h >> np.uint64(32)
    return text[ok], word[ok], start, stop, h * _MIX


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        base = 0x2545F4914F6CDD1D
        _POWERS[:] = [np.concatenate((np.ones(1, np.uint64), np.full(n, x, np.uint64))).cumprod() for x in (base, pow(base, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _blocks(texts: bytes):
    """Slices (start, stop) of about ``_BLOCK`` bytes that end after a text."""
    at = 0
    while at < len(texts):
        stop = texts.find(b"\n", min(at + _BLOCK, len(texts) - 1)) + 1
        yield at, stop
        at = stop


def _repeats_in(blobs: list[bytes], width: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """(doc, row) -> windows of the packed strings that an earlier (doc, row, start) has too.

    A bucket beyond its intended size is sorted in passes over shares of its windows, by their hash.
    """
    parts = [_unpack(b) for b in blobs]
    place, texts = np.concatenate([p for p, _ in parts]), b"".join([t for _, t in parts])
    parts = None
    rank = np.empty(len(place), np.int64)
    rank[np.lexsort((place[:, 2], place[:, 1], place[:, 0]))] = np.arange(len(place))
    passes = 1 + len(texts) // (2 * BUCKET)
    hit = np.concatenate([_later(place, rank, texts, width, k, passes) for k in range(passes)])
    out: dict = {}
    if len(hit):
        d, r, s = hit[np.lexsort((hit[:, 2], hit[:, 1], hit[:, 0]))].T
        cut = np.flatnonzero((d[1:] != d[:-1]) | (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1)) + 1
        a = np.concatenate(([0], cut))
        b = np.append(cut, len(hit)) - 1
        for dd, rr, x, y in zip(d[a].tolist(), r[a].tolist(), s[a].tolist(), (s[b] + 1).tolist(), strict=True):
            out.setdefault((dd, rr), []).append((x, y))
    return out


def _later(place, rank, texts: bytes, width: int, k: int, passes: int) -> np.ndarray:
    """(doc, row, start) of the windows of share ``k`` that equal an earlier one."""
    every, n = [], 0
    for a, b in _blocks(texts):
        text, word, start, stop, h = _hashed(np.frombuffer(texts, np.uint8, b - a, a), width)
        own = h % np.uint64(passes) == k if passes > 1 else slice(None)
        every.append((*((x[own] + by).astype(np.int32) for x, by in ((text, n), (word, 0), (start, a), (stop, a))), h[own]))
        n += texts.count(b"\n", a, b)
    text, word, start, stop, h = (np.concatenate(x) for x in zip(*every, strict=True))
    every = None
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    again = order[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(order) else order
    if not len(again):
        return np.zeros((0, 3), np.int64)
    again = again[np.lexsort((word[again], rank[text[again]], h[again]))]  # equal hashes in order of occurrence
    text, word, start, stop, h = (x[again] for x in (text, word, start, stop, h))
    lead = np.arange(len(again))
    first = np.concatenate(([True], h[1:] != h[:-1]))
    lead = np.maximum.accumulate(np.where(first, lead, 0))
    lead = _exact(lead, start.tolist(), stop.tolist(), texts)
    spot = np.column_stack((place[text, 0], place[text, 1], place[text, 2] + word))
    return spot[(spot != spot[lead]).any(1)]


def _exact(lead: np.ndarray, start: list[int], stop: list[int], texts: bytes) -> np.ndarray:
    """For each window the earliest one of the same text, given the earliest one of the same hash."""
    out, others = lead.copy(), {}
    for k, one in enumerate(lead.tolist()):
        if k == one:
            now, others = texts[start[k] : stop[k]], {}
        elif (own := texts[start[k] : stop[k]]) != now:  # another text with this hash
            out[k] = others.setdefault(own, k)
    return out


def _reduce(width: int):
    """Rows sorted by bucket -> (doc, row, ranges of repeated windows)."""

    def emit(found):
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.int64()), pa.array([_pack_ranges(v) for v in found.values()], pa.binary())], ["doc", "row", "ranges"])

    def run(batches):
        now, blobs = None, []
        for bucket, kind, doc, row, data in rows_of(batches, 16):
            if kind == 1:
                yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([row], pa.int64()), pa.array([data], pa.binary())], ["doc", "row", "ranges"])
                continue
            if bucket != now and blobs:
                yield emit(_repeats_in(blobs, width))
                blobs = []
            now = bucket
            blobs.append(data)
        if blobs:
            yield emit(_repeats_in(blobs, width))

    return run


def _row(text: str):
    """Tells rows of one id apart by their text, in 32 bits."""
    return F.pmod(F.xxhash64(text), F.lit(1 << 32)).alias("row")


def _common_pieces(rows: DataFrame, n: int, width: int) -> bytes | None:
    """Bitmap of the minimisers that ``COMMON`` rows or more of a sample of about ``SAMPLE_ROWS`` rows have; None without any."""
    share = min(1.0, SAMPLE_ROWS / max(n, 1))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = []
                for (text,) in rows_of([batch.slice(at, 256).select(["text"])], 64):
                    words = (text or b"").split()
                    if len(words) >= width:
                        found.append(np.unique(minimisers(words, width)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64())], ["piece"])

    drawn = rows.where(F.pmod(F.xxhash64("doc", "row", F.lit(6)), F.lit(1 << 30)) < share * (1 << 30)) if share < 1 else rows
    found = drawn.select("text").mapInArrow(run, "piece long").groupBy("piece").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON).select("piece").toArrow()  # at most sample windows / COMMON
    at = found["piece"].to_numpy().view(np.uint64) & np.uint64(COMMON_BITS - 1)
    bits = np.zeros(COMMON_BITS // 8, np.uint8)
    np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return bits.tobytes() if len(at) else None


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc, row, parts): packed ranges of the windows of a row that start earlier elsewhere. Ids must be of an integral type."""
    if not isinstance(docs.select(F.col(id_col).alias("id")).schema["id"].dataType, IntegralType):
        raise ValueError(f"{id_col} must be of an integral type: windows are judged in the order of ids")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), _row(text_col), as_bytes(text_col).alias("text"))
    n, n_bytes = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * tasks, int(n_bytes * 3 // BUCKET) + 1)  # a word travels in about three super-k-mers
    tasks = max(tasks, min(buckets // 8, MAX_TASKS))
    common = _common_pieces(rows, n, width)
    common = docs.sparkSession.sparkContext.broadcast(common) if common else None
    sent = rows.mapInArrow(_map(buckets, width, common), "bucket int, kind int, doc long, row long, data binary")
    found = sent.repartition(tasks, "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(_reduce(width), "doc long, row long, ranges binary")
    return found.groupBy("doc", "row").agg(F.collect_list("ranges").alias("parts"))


def covered_words(n_words: int, parts: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Mask of the words that the windows cover."""
    edge = np.zeros(n_words + 1, np.int64)
    for part in parts or ():
        r = np.frombuffer(part, np.int64).reshape(-1, 2)
        np.add.at(edge, r[:, 0], 1)
        np.add.at(edge, r[:, 1] + width - 1, -1)
    return edge[:n_words].cumsum() > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``kept`` (the words that stay, joined by a space).

    Each word covered by a window whose words also start earlier (smaller id, or earlier in the row) goes;
    windows are judged on the input. Null text has no words; null ids count as last; rows alike in id and
    text do not count as earlier than each other; no rows give none. Ids must be of an integral type.
    """
    return _applied(docs, id_col, text_col, width, lambda words: b" ".join(words).decode("utf-8", "replace"), "kept string", pa.string())


def removal_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """As :func:`remove_repeats`, with ``kept_sha256`` (lowercase hex) in place of the text."""
    return _applied(docs, id_col, text_col, width, lambda words: hashlib.sha256(b" ".join(words)).hexdigest(), "kept_sha256 string", pa.string())


def _applied(docs, id_col, text_col, width, make, column, kind) -> DataFrame:
    """Only rows that may hold repeats shuffle to meet their marks; the others pass through the scan."""
    marks = stage(repeated_windows(docs, id_col, text_col, width), "substring-marks")
    id_type = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), _row(text_col), as_bytes(text_col).alias("text"))
    slot, shared = bitmap_of(marks, "doc", "row")
    whole = rows.select("id", "text", slot.alias("slot"))
    both = rows.where(maybe_of(slot, shared)).join(marks, ["doc", "row"], "left").select("id", "text", "parts")

    def unmarked(batches):  # the test and the work in one worker, for memory
        for batch in batches:
            own = batch.filter(pa.array(~in_bitmap(shared.value, batch.column("slot").to_numpy())))
            yield from run([pa.RecordBatch.from_arrays([own.column("id"), own.column("text"), pa.nulls(own.num_rows, pa.list_(pa.binary()))], ["id", "text", "parts"])])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                total, gone, made = [], [], []
                for text, parts in rows_of([part.select(["text", "parts"])]):
                    words = text.split()
                    out = covered_words(len(words), parts, width) if parts else np.zeros(len(words), bool)
                    total.append(len(words))
                    gone.append(int(out.sum()))
                    made.append(make([w for w, x in zip(words, out.tolist(), strict=True) if not x] if parts else words))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(made, kind)], ["id", "n_words", "n_removed", column.split()[0]])

    schema = f"id {id_type}, n_words long, n_removed long, {column}"
    return whole.mapInArrow(unmarked, schema).unionByName(both.mapInArrow(run, schema)).withColumnRenamed("id", id_col)
