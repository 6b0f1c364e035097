"""Secret scan by one combined deterministic automaton.

Every rule is a head, up to the first byte of its tail, and a tail: the run of a byte class that begins
there. All heads, and the literals that tell where heads of varying length begin, are compiled into a single
minimal byte automaton (:mod:`automaton`). One pass over the bytes yields every position where a head ends;
spans follow from those positions and from the bytes that end a run, without reading the text again.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Automaton
from .common import as_bytes


@dataclass(frozen=True)
class Rule:
    """``head``: expression up to and with the first byte of the tail, ``size`` bytes before that one, or 0 where
    one of the literals ``marks`` (expression -> bytes) begins it. ``tail``: the byte class whose run it is,
    none for a head that is the whole match. ``least``: bytes of the match, or of the tail if ``of_tail``."""

    head: str
    tail: str
    least: int
    size: int = 0
    of_tail: bool = False
    marks: dict[str, int] = field(default_factory=dict)


_NAMES = {"password": 8, "passwd": 6, "secret": 6, "token": 5, "api_key": 7, "apikey": 6}
_VALUE, _WORD, _URL = "A-Za-z0-9+/_.=-", "A-Za-z0-9", "A-Za-z0-9_-"
#: The first three are the base kinds (fixed values).
RULES: dict[str, Rule] = {
    "assign": Rule(rf"""(?i:{"|".join(_NAMES)})["']?\x20*[:=]\x20*["']?[{_VALUE}]""", _VALUE, 12, of_tail=True, marks={f"(?i:{k})": n for k, n in _NAMES.items()}),
    "access": Rule(r"AKIA[A-Z0-9]", "A-Z0-9", 18, 4),
    "hex": Rule(r"[0-9a-f]{16}", "0-9a-f", 16),
    "github": Rule(rf"gh[oprsu]_[{_WORD}]", _WORD, 24, 4),
    "slack": Rule(r"xox[abprs]-[A-Za-z0-9-]", "A-Za-z0-9-", 15, 5),
    "stripe": Rule(rf"[rs]k_live_[{_WORD}]", _WORD, 24, 8),
    "google": Rule(rf"AIza[{_URL}]", _URL, 24, 4),
    "jwt": Rule(rf"eyJ[{_URL}]+\.[{_URL}]+\.[{_URL}]", _URL, 36, marks={"eyJ": 3}),
    "pem": Rule(r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "", 1, marks={"-----BEGIN ": 11}),
}
BASE = ("assign", "access", "hex")
#: Bytes that are stepped at a time.
_CHUNK = 1 << 22


@lru_cache(maxsize=1)
def _compiled():
    """The automaton; for each kind its rule, bit, (bit, bytes) of its literals, and the bytes outside its tail."""
    heads = [r.head for r in RULES.values()]
    marks = sorted({x for r in RULES.values() for x in r.marks.items()})
    machine = Automaton(heads + [m for m, _ in marks])
    bit = {m: 1 << (len(heads) + k) for k, (m, _) in enumerate(marks)}
    plans = []
    for k, (kind, r) in enumerate(RULES.items()):
        inside = np.zeros(256, bool)
        if r.tail:
            one = Automaton([f"[{r.tail}]"])
            inside = one.rules[one.step[:256]] > 0
        plans.append((kind, r, 1 << k, [(bit[m], n) for m, n in r.marks.items()], ~inside))
    return machine, plans


def find_secrets(texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
    """Spans (kind, start, end) of each UTF-8 text in code points, by start, then kind as listed."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        size, stop = 0, at
        while stop < len(texts) and (size < _CHUNK or stop == at):
            size += len(texts[stop]) + 1
            stop += 1
        _scan(texts[at:stop], out, at)
        at = stop
    return out


def _starts(rule: Rule, hit: np.ndarray, outside: np.ndarray, spot: np.ndarray, mask: np.ndarray, marks) -> np.ndarray:
    """Where the matches begin whose heads end on the bytes ``hit``; ``outside``: bytes that end a run of the tail."""
    if rule.size:
        return hit - rule.size
    if not marks:  # the whole match is a run
        return outside[np.searchsorted(outside, hit) - 1] + 1
    begins = np.sort(np.concatenate([spot[mask & b > 0] + 1 - n for b, n in marks]))
    if rule.tail != _URL:  # the literal next before
        return begins[np.searchsorted(begins, hit) - 1]
    dots = np.searchsorted(outside, hit) - 1  # the first literal in the run before the run before
    return begins[np.searchsorted(begins, outside[dots - 2] + 1)]


def _scan(texts: list[bytes], out: list, base: int) -> None:
    machine, plans = _compiled()
    joined = b"\x00" + b"\x00".join(texts) + b"\x00"  # a reset byte for these rules, so texts stay apart
    data = np.frombuffer(joined, np.uint8)
    cuts = np.flatnonzero(machine.resets[data])
    starts, stops = cuts[:-1] + 1, cuts[1:]
    some = stops > starts
    spot, mask = machine.scan(data, starts[some], stops[some])
    spans = []
    for k, (_, rule, own, marks, not_tail) in enumerate(plans):
        hit = spot[mask & own > 0]
        if not len(hit):
            continue
        outside = np.flatnonzero(not_tail[data])
        ends = outside[np.searchsorted(outside, hit)] if rule.tail else hit + 1
        done = 0
        for s, h, e in zip(_starts(rule, hit, outside, spot, mask, marks).tolist(), hit.tolist(), ends.tolist(), strict=True):
            if s >= done:  # leftmost, non-overlapping; a match that is too short takes its place as well
                done = e
                if e - (h if rule.of_tail else s) >= rule.least:
                    spans.append((s, k, e))
    begins = np.concatenate(([1], 1 + np.cumsum([len(t) + 1 for t in texts])))
    spans.sort()
    owner = (np.searchsorted(begins, [s for s, *_ in spans], side="right") - 1).tolist()
    by: dict[int, list] = {}
    for d, x in zip(owner, spans, strict=True):
        by.setdefault(d, []).append(x)
    for d, own in by.items():
        first = int(begins[d])
        points = np.concatenate(([0], np.cumsum((data[first : int(begins[d + 1]) - 1] & 0xC0) != 0x80)))
        out[base + d] = [(plans[k][0], int(points[s - first]), int(points[e - first])) for s, k, e in own]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``secrets``, an array of (kind, start, end) over the whole text.

    Null and empty texts give an empty array; repeated rows are scanned each for itself.
    """
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                spans = find_secrets(part.column("text").to_pylist())
                secrets = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
                yield pa.RecordBatch.from_arrays([part.column("id"), secrets], ["id", "secrets"])

    found = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text")).mapInArrow(run, f"id {kind}, secrets array<struct<kind:string,start:long,end:long>>")
    return found.select(F.col("id").alias(id_col), "secrets")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the first wins."""
    parts, at = [], 0
    for kind, s, e in spans:
        if s >= at:
            parts += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join(parts) + text[at:]


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans if k in BASE).encode()).hexdigest()
