"""SimHash near-dedup by pigeonhole blocks.

Fingerprints within ``distance`` bits agree on at least one of ``distance + 1`` blocks, so pairs are
sought among equal blocks only and verified by Hamming distance. Copies meet as one fingerprint. A
block that too many fingerprints share is split again by the same rule on its remaining bits, until
its groups are small enough for one task's memory: no candidate is dropped at any size. Each group
yields a spanning set of its links, never all pairs; components follow from those. Near copies of lesser
similarity differ in more bits than blocks can bear, so the near-copy stage seeks candidates by bands of
MinHash values as well and verifies the shingles of both kinds: each node's nearest fingerprint and the
least node of each of its bands first, then every other pair of a band that no verified link connects.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, join_groups, maybe_in, rows_of, scratch, stage
from .graph import connected_components

#: Most fingerprints that are compared with each other in one group.
GROUP = 4096
#: The near-copy stage: bits in which fingerprints of candidates differ at most; the share of common word shingles of a near copy.
STAGE_DISTANCE, STAGE_SHARE = 3, 0.8
#: The near-copy stage: equal bands of MinHash values make a candidate as well; at similarity 0.8 no band is
#: equal with a chance of (1 - 0.8 ** 4) ** 40, under one in 10 ** 9.
BANDS, BAND_ROWS = 40, 4
#: Of a pair's MinHash values so many must agree (in their low byte) before its shingles are compared; at
#: similarity 0.8 fewer do with a chance under one in 10 ** 9.
AGREE = 96
#: Rows up to which the documents to verify are found by a broadcast of their ids (16 bytes each).
BROADCAST_ROWS = 500_000
#: Links of a group that are held before they are folded into its components.
_HELD = 1 << 20
_ALL = (1 << 64) - 1


def _bits(total: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def _remixed(h: np.ndarray) -> np.ndarray:
    """Another 64-bit hash of each shingle, from the first."""
    x = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


_MIX = np.random.default_rng(7).integers(0, 1 << 64, (2, BANDS * BAND_ROWS), np.uint64) | np.uint64(1)


def _bands(hashes: list[np.ndarray]) -> tuple[list[int], bytes]:
    """A signed 64-bit key for each band of MinHash values over the shingles' hashes, and the low byte of each value."""
    least = np.full(BANDS * BAND_ROWS, _ALL, np.uint64)
    for h in hashes:
        for at in range(0, len(h), 1024):
            least = np.minimum(least, ((h[at : at + 1024, None] ^ _MIX[0]) * _MIX[1]).min(0))
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_ROWS).T:
        key = _remixed(key ^ column)
    return key.view(np.int64).tolist(), _remixed(least).astype(np.uint8).tobytes()


def _shingle_hashes(text: bytes, width: int):
    """Hashes of the word shingles of A-Z lower-cased UTF-8 text, repeats included, in arrays of bounded size.

    Words are runs without white space; fewer words than ``width`` make one shingle; no word gives none.
    """
    words = text.lower().split()
    if not words:
        return
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    width = min(width, len(words))
    starts = np.concatenate(([0], ends[:-width])).tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    for at in range(0, len(starts), 1 << 16):
        yield np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)], strict=True)], np.uint64)


def _simhash(hashes) -> int:
    """The fingerprint of shingle hashes: a bit is 1 if set in over half of them; 0 for none."""
    total, n = np.zeros(64, np.int64), 0
    for h in hashes:
        total += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        n += len(h)
    return _bits(total, n) if n else 0


def fingerprint(text: bytes, width: int = 3) -> int:
    """64-bit SimHash over the word shingles of a text, unsigned."""
    return _simhash(_shingle_hashes(text, width))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): the signed 64-bit fingerprint of every row's whole text; null text counts as empty."""
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t or b"", width) for (t,) in rows_of([batch.select(["text"])], 64)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps.view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(row, id, fp, own, bands, low): the hash of id and text, the fingerprint, a hash of all shingles with their
    repeats, the keys of the MinHash bands, the low bytes of the MinHash values."""
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for (text,) in rows_of([batch.select(["text"])], 64):
                hashes = list(_shingle_hashes(text, width))
                out.append((_simhash(hashes), sum(int(_remixed(h).sum(dtype=np.uint64)) for h in hashes) & _ALL, *_bands(hashes)))
            numbers = [pa.array(np.array([r[k] for r in out], np.uint64).view(np.int64)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), *numbers, pa.array([r[2] for r in out], pa.list_(pa.int64())), pa.array([r[3] for r in out], pa.binary())], ["row", "id", "fp", "own", "bands", "low"])

    rows = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    return rows.mapInArrow(run, f"row long, id {kind}, fp long, own long, bands array<long>, low binary")


def _split(mask: int, parts: int) -> list[int]:
    """``mask`` extended by one of ``parts`` runs of the bits that it leaves free."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in run.tolist()) for run in np.array_split(np.array(free), parts) if len(run)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(masks: list[int]):
    return F.explode(F.array(*(F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for m in masks))).alias("k")


def _links_in(distance: int, direct: bool):
    """Per group of equal (mask, key), rows in that order: links that connect whatever near pairs would."""

    def fold(root, us, vs):
        """Roots of all links so far; the earlier ones live on as links to their roots."""
        u, v = np.concatenate((np.arange(len(root)), *us)), np.concatenate((root, *vs))
        while True:
            low = np.minimum(root[u], root[v])
            was = root.copy()
            np.minimum.at(root, u, low)
            np.minimum.at(root, v, low)
            root = root[root]
            if (root == was).all():
                return root

    def solve(mask, key, node, fp):
        new = np.flatnonzero(np.concatenate(([True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]))))
        group = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(fp))))
        a = fp.view(np.uint64)
        root, at = np.arange(len(fp)), np.arange(len(fp))
        us, vs, held = [], [], 0
        best, mate = np.full(len(fp), 255, np.uint8), np.arange(len(fp))
        for d in range(1, len(fp)):
            at = at[: np.searchsorted(at, len(fp) - d)]
            at = at[group[at] == group[at + d]]
            if not len(at):
                break
            bits = np.bitwise_count(a[at] ^ a[at + d])
            near, bits = at[bits <= distance], bits[bits <= distance]
            if not len(near):
                continue
            if direct:  # each one's nearest earlier neighbour, a pair that can be verified
                closer = bits < best[near + d]
                best[near[closer] + d], mate[near[closer] + d] = bits[closer], near[closer]
                continue
            us.append(near)
            vs.append(near + d)
            held += len(near)
            if held > _HELD:
                root, us, vs, held = fold(root, us, vs), [], [], 0
        if us:
            root = fold(root, us, vs)
        root = mate if direct else root
        own = np.flatnonzero(root != np.arange(len(fp)))
        return node[own], node[root[own]]

    def run(batches):
        def out(cols):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in solve(*cols)], ["u", "v"])

        held = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in range(4)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            m, k = held[:2]
            last = np.flatnonzero((m != m[-1]) | (k != k[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            for part in _cuts(m[:cut], k[:cut]):
                yield out([x[part] for x in held])
            held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield out(held)

    return run


def _cuts(mask, key, size: int = 1 << 13):
    """Slices of about ``size`` rows that end where a group ends."""
    if not len(mask):
        return
    ends = np.append(np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1, len(mask))
    at = 0
    while at < len(mask):
        stop = int(ends[min(np.searchsorted(ends, at + size), len(ends) - 1)])
        yield slice(at, stop)
        at = stop


def near_links(nodes: DataFrame, distance: int = 3, group: int = GROUP, direct: bool = False) -> DataFrame:
    """Links (u, v) between ``nodes`` (node, fp) that connect all pairs whose ``fp`` differ in at most
    ``distance`` bits: not every near pair appears, but any two that do are joined by a chain of near pairs.

    With ``direct`` every link is a near pair itself: each node's nearest earlier one in every block it is in.
    """
    parts, masks = distance + 1, _split(0, distance + 1)
    rows = nodes.select("node", "fp", _keys(masks)).select("k.mask", "k.key", "node", "fp")
    found = None
    while True:
        heavy = stage(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > group), "simhash-heavy")
        hot = [r["mask"] & _ALL for r in heavy.select("mask").distinct().collect()]  # masks, a handful by construction
        light = rows.join(heavy, ["mask", "key"], "left_anti") if hot else rows
        links = light.select(*rows.columns).repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(_links_in(distance, direct), "u long, v long")
        found = links if found is None else found.unionByName(links)
        if not hot:
            return found
        subs = nodes.sparkSession.createDataFrame([(_signed(m), _signed(x)) for m in hot for x in _split(m, parts)], "mask long, sub long")
        rows = rows.join(heavy, ["mask", "key"], "left_semi").join(F.broadcast(subs), "mask").select(F.col("sub").alias("mask"), F.col("fp").bitwiseAND(F.col("sub")).alias("key"), "node", "fp")
        rows = stage(rows, "simhash-split")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, shingles): the distinct word shingles of each row's whole text as 32-bit hashes."""

    def run(batches):
        for batch in batches:
            sets = []
            for (text,) in rows_of([batch.select(["text"])], 64):
                words = text.lower().split()
                k = min(width, len(words))
                sets.append(sorted({xxhash.xxh32_intdigest(b" ".join(words[i : i + k])) - (1 << 31) for i in range(len(words) - k + 1)}) if words else [])
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int32()))], ["node", "shingles"])

    return docs.select("node", "text").mapInArrow(run, "node long, shingles array<int>")


def sets_of(links: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(node, low, shingles) of the nodes of ``links``, from the row that stands for each."""
    used = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    reps = stage(used.join(nodes, "node").select("node", F.col("least.row").alias("row")), "simhash-reps")
    texts = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), as_bytes(text_col).alias("text"))
    texts = texts.join(F.broadcast(reps), "row") if reps.count() <= BROADCAST_ROWS else texts.where(maybe_in(reps, "row")).join(reps, "row")
    return stage(shingle_sets(texts, width).dropDuplicates(["node"]).join(nodes.select("node", "low"), "node"), "simhash-shingles")


def verified(links: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """The links whose documents share at least ``share`` of their word shingles."""
    side = lambda name, set_: sets.select(F.col("node").alias(name), F.col("shingles").alias(set_))
    pairs = links.join(side("u", "a"), "u").join(side("v", "b"), "v")
    common = F.size(F.array_intersect("a", "b"))
    return pairs.where(common >= F.lit(share) * (F.size("a") + F.size("b") - common)).select("u", "v")


def _rest_in(share: float):
    """Per group of equal (key, tile): every pair that no link joins yet and whose MinHash values agree enough, verified in place."""

    def solve(rows):
        node, root = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        low = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1)
        sets, sizes = [r[3] for r in rows], np.array([len(r[3]) for r in rows])
        for d in range(1, len(rows)):
            near = (root[:-d] != root[d:]) & (np.minimum(sizes[:-d], sizes[d:]) >= share * np.maximum(sizes[:-d], sizes[d:]))
            near = np.flatnonzero(near)
            for at in range(0, len(near), 4096):
                part = near[at : at + 4096]
                for i in part[(low[part] == low[part + d]).sum(1) >= AGREE].tolist():
                    if root[i] == root[i + d]:
                        continue
                    common = len(np.intersect1d(sets[i], sets[i + d], assume_unique=True))
                    if common >= share * (sizes[i] + sizes[i + d] - common):
                        root[root == root[i + d]] = root[i]
                        yield int(node[i + d]), int(node[i])

    def run(batches):
        def out(rows):
            links = list(solve(rows))
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["u", "v"])

        now, held = None, []
        for batch in batches:
            ids, low = [batch.column(c).to_numpy().tolist() for c in range(4)], batch.column(4).to_pylist()
            sets, ends = batch.column(5).flatten().to_numpy(), np.cumsum(batch.column(5).value_lengths().to_numpy()).tolist()
            for k, (key, tile, node, root) in enumerate(zip(*ids, strict=True)):
                if (key, tile) != now:
                    if held:
                        yield out(held)
                    now, held = (key, tile), []
                held.append((node, root, low[k], sets[ends[k - 1] if k else 0 : ends[k]]))
        if held:
            yield out(held)

    return run


def band_links(nodes: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Candidates (u, v) that lead each node to the least of each band key it has, and the keys (key, v, n)."""
    keys = nodes.select("node", F.explode("bands").alias("key"))
    groups = stage(keys.groupBy("key").agg(F.min("node").alias("v"), F.count("*").alias("n")).where("n > 1"), "simhash-bands")
    return join_groups(keys, groups, "key", "n", rows).where("node <> v").select(F.col("node").alias("u"), "v"), groups


def rest_of_bands(groups: DataFrame, nodes: DataFrame, sets: DataFrame, roots: DataFrame, share: float, rows: int, group: int = GROUP) -> DataFrame:
    """The verified links that the stars of :func:`band_links` lack: all pairs of equal band keys whose ends have
    other ``roots`` so far. Groups beyond ``group`` are dealt in parts, and every two parts meet."""
    keys = nodes.select("node", F.explode("bands").alias("key"))
    many = groups.where("n > 2").select("key", "n")
    met = stage(join_groups(keys, many, "key", "n", rows).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "simhash-band-rows")
    apart = stage(met.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("m")).where("a <> b").select("key", "m"), "simhash-band-apart")
    open_rows = join_groups(met, apart, "key", "m", rows)
    parts = F.ceil(F.col("n") / (group // 2)).cast("long")
    own = F.pmod(F.xxhash64("node"), parts)
    tiles = F.when(F.col("n") <= group, F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda p: F.least(p, own) * parts + F.greatest(p, own)))
    dealt = open_rows.select("key", F.explode(tiles).alias("tile"), "node", "root").join(sets, "node").select("key", "tile", "node", "root", "low", "shingles")
    return dealt.repartition("key", "tile").sortWithinPartitions("key", "tile", "node").mapInArrow(_rest_in(share), "u long, v long")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits), ``component_id``.

    Rows link when their fingerprints differ in at most ``distance`` bits; ``component_id`` is the
    smallest id reachable over links. Null text counts as empty; texts without words have fingerprint
    zero and link like any other; null ids never become a component id unless a component has no other.
    Repeated rows share their component; no rows in, no rows out.
    """
    with scratch() as keep:
        rows = keep(stage(fingerprints(docs, id_col, text_col, width), "simhash-fp"))
        n = rows.count()
        distinct = stage(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")).withColumn("node", F.col("fp")), "simhash-distinct")
        roots = connected_components(stage(near_links(distinct, distance), "simhash-links"))
        linked = stage(distinct.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "simhash-roots")
        least = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
        named = keep(stage(join_groups(linked.select("fp", "root", "n"), least, "root", "members", n).select("fp", "n", "component_id"), "simhash-named"))
    found = join_groups(rows, named, "fp", "n", n)
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, distance: int = STAGE_DISTANCE, share: float = STAGE_SHARE) -> DataFrame:
    """One document of ``docs`` for each group of near copies, with its own columns.

    Documents link that share ``share`` of their distinct word shingles (texts without words have none, and link
    with each other); of each group the row of least id stays, null ids last, of equal ids the one of least hash.
    Rows alike in id and text are one document: they stay or go together. Only rows that may go shuffle their text.
    No rows in, no rows out.
    """
    with scratch() as keep:
        rows = stage(signatures(docs, id_col, text_col, width).withColumn("node", F.xxhash64("fp", "own")), "simhash-signatures")
        least = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "row")).alias("least")
        distinct = stage(rows.groupBy("node", "fp").agg(least, F.min_by("bands", "row").alias("bands"), F.min_by("low", "row").alias("low")), "simhash-distinct")
        nearest = stage(near_links(distinct, distance, direct=True), "simhash-candidates")
        band_rows = distinct.count() * BANDS
        stars, groups = band_links(distinct, band_rows)
        both = stage(nearest.unionByName(stars).distinct(), "simhash-pairs")
        sets = sets_of(both, distinct, docs, id_col, text_col, width)
        links = stage(verified(both, sets, share), "simhash-nearest")
        roots = stage(connected_components(links), "simhash-nearest-roots")
        links = stage(links.unionByName(rest_of_bands(groups, distinct, sets, roots, share, band_rows)), "simhash-links")
        roots = connected_components(links)
        linked = distinct.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        stay = linked.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.row").alias("row"))
        gone = keep(stage(rows.select("row").distinct().join(stay, "row", "left_anti"), "simhash-gone"))
    wide = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row")).withColumn("maybe", maybe_in(gone, "row"))
    kept = wide.where(~F.col("maybe")).select("d").unionByName(wide.where("maybe").join(gone, "row", "left_anti").select("d"))
    return kept.select(*(F.col(f"d.`{c}`") for c in docs.columns))
