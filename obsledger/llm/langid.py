"""Language identification by rank-order n-gram profiles (out-of-place distance).

A profile is a language's most frequent 1- to 3-grams in order. A document's own most frequent n-grams
are compared with it: each costs the difference of its two ranks, or the most where the profile lacks it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import stage

#: N-grams in a profile and in a document's ranking.
TOP = 400
#: Expected number of training rows of each language: the bound of the sample that profiles are fitted on.
TRAIN_PER_LANG = 1500
UNKNOWN = "und"
#: Languages up to which their row counts are broadcast.
BROADCAST_ROWS = 10_000
#: Letters fall on 4093 classes by code point (prime): those of an alphabet keep apart, some five Han characters share one.
_CLASSES, _BITS = 4093, 12
#: Bits of a gram's letters, and of a gram with its length in front.
_LETTERS, _GRAM = 3 * _BITS, 3 * _BITS + 2
_MASK = (1 << _GRAM) - 1
#: Code points that are counted at a time, and bits of the number of a text among those ranked at a time.
_CHUNK, _DOC_BITS = 1 << 19, 9
_DOCS = 1 << _DOC_BITS


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point: 0 for what is no letter, else by its lower-case form."""
    out = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = 1 + ord(low if len(low) == 1 else ch) % _CLASSES
    return out


def _grams(classes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """doc << _GRAM | gram for every n-gram; a non-letter counts as a word's edge and never inside a gram."""
    c, d = classes.astype(np.int64), doc.astype(np.int64) << _GRAM
    one = c > 0
    same = doc[1:] == doc[:-1]
    two = same & (one[1:] | one[:-1])
    three = same[1:] & same[:-1] & one[1:-1]
    uni = (d | 2 << _LETTERS | c)[one]
    bi = (d[1:] | 1 << _LETTERS | c[:-1] << _BITS | c[1:])[two]
    tri = (d[2:] | c[:-2] << 2 * _BITS | c[1:-1] << _BITS | c[2:])[three]
    return np.concatenate((uni, bi, tri))


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(doc << _GRAM | gram, count) over whole texts, sorted; long texts are counted in pieces."""
    table = _classes()
    keys, counts = [], []
    buffer, size = [], 0

    def flush():
        nonlocal buffer, size
        if buffer:
            classes = np.concatenate([x for _, x in buffer])
            doc = np.repeat(np.array([k for k, _ in buffer]), [len(x) for _, x in buffer])
            k, n = _counted(_grams(classes, doc))
            keys.append(k)
            counts.append(n)
        buffer, size = [], 0

    for k, text in enumerate(texts):
        if not text:
            continue
        points = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        points = np.concatenate(([0], points, [0])).astype(np.uint16)
        for at in range(0, max(1, len(points) - 2), _CHUNK):
            piece = points[at : at + _CHUNK + 2]  # two more, for the grams that begin in this piece
            if at + _CHUNK < len(points) - 2 or at:
                flush()
                k3, n3 = _counted(_piece(piece, k, at + _CHUNK >= len(points) - 2))
                keys.append(k3)
                counts.append(n3)
            else:
                buffer.append((k, piece))
                size += len(piece)
                if size >= _CHUNK:
                    flush()
    flush()
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(n, first)


def _piece(piece: np.ndarray, k: int, last: bool) -> np.ndarray:
    """Grams of a piece of a long text, each beginning inside the piece (the last one keeps its end)."""
    c = piece.astype(np.int64)
    own = len(c) if last else _CHUNK
    at = np.arange(len(c))
    one = c > 0
    uni = (2 << _LETTERS | c)[one & (at < own)]
    bi = (1 << _LETTERS | c[:-1] << _BITS | c[1:])[(one[1:] | one[:-1]) & (at[:-1] < own)]
    tri = (c[:-2] << 2 * _BITS | c[1:-1] << _BITS | c[2:])[one[1:-1] & (at[:-2] < own)]
    return (k << _GRAM) | np.concatenate((uni, bi, tri))


def ranked(texts: list[str], top: int = TOP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, gram, rank) of each text's ``top`` most frequent grams; ties by gram."""
    key, n = gram_counts(texts)
    if not len(key):
        return key, key, key
    doc, gram = key >> _GRAM, key & _MASK
    cap = (1 << (63 - _GRAM - _DOC_BITS)) - 1
    if n.max() <= cap:  # ranks sort as single integers
        packed = np.sort(doc << (63 - _DOC_BITS) | (cap - n) << _GRAM | gram)
        doc, gram = packed >> (63 - _DOC_BITS), packed & _MASK
    else:
        order = np.lexsort((gram, -n, doc))
        doc, gram = doc[order], gram[order]
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    rank = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
    keep = rank < top
    return doc[keep], gram[keep], rank[keep]


def fit_profiles(train: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", top: int = TOP, per_lang: int = TRAIN_PER_LANG) -> dict[str, np.ndarray]:
    """The ``top`` grams of each language of ``train``, most frequent first.

    Rows are drawn by the hash of their id at a rate that gives about ``per_lang`` rows a language (all of
    a smaller one); their gram counts are summed on the cluster and only the profiles reach the driver.
    """
    train = train.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = stage(train.groupBy("lang").agg(F.count("*").alias("rows")), "lang-sizes")
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    drawn = F.pmod(F.xxhash64("id", F.lit(4)), F.lit(1 << 30)) < (F.lit(float(per_lang)) / F.col("rows")) * (1 << 30)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _DOCS):
                part = batch.slice(at, _DOCS)
                langs = part.column("lang").to_pylist()
                names = sorted(set(langs))
                index = np.array([names.index(x) for x in langs])
                key, n = gram_counts(part.column("text").to_pylist())
                if not len(key):
                    continue
                k2 = index[key >> _GRAM] << _GRAM | key & _MASK
                order = np.argsort(k2, kind="stable")
                k2, n = k2[order], n[order]
                first = np.flatnonzero(np.concatenate(([True], k2[1:] != k2[:-1])))
                yield pa.RecordBatch.from_arrays([pa.array([names[x] for x in k2[first] >> _GRAM], pa.string()), pa.array(k2[first] & _MASK), pa.array(np.add.reduceat(n, first))], ["lang", "gram", "n"])

    counts = train.join(sizes, "lang").where(drawn).select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).orderBy("lang", "rank").collect()
    out: dict[str, list[int]] = {}
    for r in rows:
        out.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, np.int64) for k, v in out.items()}


def predict(texts: list[str | None], profiles: dict[str, np.ndarray], top: int = TOP) -> tuple[list[str], np.ndarray]:
    """Language and score of each text. ``und`` (score 0) for null, no letter, or nothing learned."""
    names = sorted(profiles)
    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not names:
        return lang, score
    vocab = np.unique(np.concatenate([profiles[x] for x in names]))
    place = np.full((len(vocab) + 1, len(names)), top, np.int64)
    for k, x in enumerate(names):
        place[np.searchsorted(vocab, profiles[x]), k] = np.arange(len(profiles[x]))
    known = place < top
    for at in range(0, len(texts), _DOCS):
        doc, gram, rank = ranked([t or "" for t in texts[at : at + _DOCS]], top)
        if not len(doc):
            continue
        pos = np.minimum(np.searchsorted(vocab, gram), len(vocab) - 1)
        pos = np.where(vocab[pos] == gram, pos, len(vocab))
        cost = np.where(known[pos], np.abs(place[pos] - rank[:, None]), top)
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        total = np.add.reduceat(cost, first, axis=0)
        best = total.argmin(1)
        order = np.sort(total, axis=1)
        worst = np.diff(np.append(first, len(doc))) * float(top)
        margin = (order[:, 1] - order[:, 0]) / np.maximum(order[:, 1], 1) if len(names) > 1 else 1 - order[:, 0] / worst
        for d, b, m in zip(doc[first], best, margin, strict=True):
            lang[at + d], score[at + d] = names[b], min(max(float(m), 0.0), 1.0)
    return lang, score


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text", top: int = TOP, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (or other ``names``) appended (names that clash are replaced).

    Reads whole texts and nothing else of a row. Null text or text without a letter gives ``und``, 0.
    """
    own = [c for c in docs.columns if c.lower() not in names]
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # ``top`` grams a language
    kept = docs.select(*(F.col(f"`{c}`") for c in own))
    at_text = own.index(text_col)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _DOCS):
                part = batch.slice(at, _DOCS)
                lang, score = predict(part.column(at_text).to_pylist(), shared.value, top)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score)], [*own, *names])

    return kept.mapInArrow(run, StructType([*kept.schema, StructField(names[0], StringType()), StructField(names[1], DoubleType())]))
