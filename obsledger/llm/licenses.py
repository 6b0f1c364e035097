"""License scan by a positional rare-token index.

The index holds, for each licence template, the positions of its rarest words (highest IDF over the
templates). Of a file, its words of highest IDF among the licence words, those that the index holds, are looked
up; postings whose position in the file agrees with their position in the template vote for the same start. Short
phrases need every word; templates need a share of their rare words in place, give or take a drift that grows
with their length, and then their mandatory key phrases near that start. Templates are notices as well as the
running text of whole licences.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, rows_of

#: Base phrases and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Templates by label: text, and the key phrases without which the label is not given.
TEMPLATES: dict[str, tuple[str, tuple[str, ...]]] = {
    "mit": ("released under the mit license", ("mit license",)),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        ("permission is hereby granted", "free of charge"),
    ),
    "apache-2.0": ("licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ("general public license", "version 3")),
    "gpl-2.0": ("under the terms of the gnu general public license version 2", ("general public license", "version 2")),
    "lgpl": ("under the terms of the gnu lesser general public license", ("lesser general public license",)),
    "agpl": ("under the terms of the gnu affero general public license", ("affero general public license",)),
    "cc-by-4.0": ("licensed under cc by 4 0", ("cc by 4 0",)),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    "cc-by-text": ("licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    "cc0": ("cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    "apache-2.0-text": (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing "
        "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing "
        "permissions and limitations under the license",
        ("in compliance with the license", "without warranties or conditions of any kind"),
    ),
    "gpl-text": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or "
        "at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
        ("general public license", "free software foundation"),
    ),
    "bsd-text": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        ("redistributions of source code", "redistributions in binary form"),
    ),
    "zlib": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use "
        "this software for any purpose including commercial applications and to alter it and redistribute it freely",
        ("alter it and redistribute it freely",),
    ),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use", "source and binary forms")),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "hereby granted")),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    "unlicense": ("this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    "proprietary": ("proprietary and confidential unauthorized copying of this file via any medium is strictly prohibited", ("proprietary and confidential",)),
}
#: Rare words indexed for each template, at least and for each so many of its words; the share of them that must
#: agree; words of drift allowed, at least and for each so many words of the template.
RARE, RARE_PER, AGREE, DRIFT, DRIFT_PER = 5, 4, 0.6, 2, 20

#: Everything that is no word byte becomes a space, A-Z lower case: words are then what split() gives.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]")
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if _WORD.match(bytes([b])) else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


@lru_cache(maxsize=1)
def _index():
    """word -> [(phrase number, position)], and the phrases: (label, words, key phrases or None, votes needed, drift)."""
    phrases = [(label, tuple(p.split()), None) for p, label in BASE.items()]
    phrases += [(label, tuple(t.split()), tuple(tuple(k.split()) for k in keys)) for label, (t, keys) in TEMPLATES.items()]
    df = Counter(w for _, words, _ in phrases for w in set(words))
    idf = {w: math.log((1 + len(phrases)) / (1 + n)) for w, n in df.items()}
    post, out = defaultdict(list), []
    for k, (label, words, keys) in enumerate(phrases):
        rare = max(RARE, len(words) // RARE_PER)
        at = range(len(words)) if keys is None else sorted(range(len(words)), key=lambda i: (-idf[words[i]], i))[:rare]
        for i in at:
            post[words[i]].append((k, i))
        out.append((label, words, keys, len(words) if keys is None else math.ceil(AGREE * len(at)), max(DRIFT, len(words) // DRIFT_PER)))
    return dict(post), out


@lru_cache(maxsize=1)
def _as_bytes():
    """The index over words as bytes."""
    post, phrases = _index()
    enc = lambda words: tuple(w.encode() for w in words)
    return {w.encode(): x for w, x in post.items()}, [(label, enc(words), keys and tuple(map(enc, keys)), need, drift) for label, words, keys, need, drift in phrases]


def _has(words: list[bytes], phrase: tuple, low: int, high: int) -> bool:
    n = len(phrase)
    return any(tuple(words[i : i + n]) == phrase for i in range(max(low, 0), min(high, len(words) - n + 1)))


def scan(text: bytes) -> tuple[int, list[tuple[int, str]], dict[str, float]]:
    """Number of words, base places (start, label), and label -> score (share of template words in place)."""
    post, phrases = _as_bytes()
    words = words_of(text)
    votes: dict[int, Counter] = defaultdict(Counter)
    for at, w in enumerate(words):
        if w in post:
            for k, i in post[w]:
                votes[k][at - i] += 1
    places, labels = [], {}
    for k, starts in votes.items():
        label, own, keys, need, drift = phrases[k]
        if keys is None:
            places += [(s, label) for s, n in starts.items() if n >= need and s >= 0]
            continue
        if sum(starts.values()) < need:
            continue
        order, total = sorted(starts), {}
        low = high = held = 0
        for s in order:  # votes from s - drift to s + drift
            while high < len(order) and order[high] <= s + drift:
                held += starts[order[high]]
                high += 1
            while order[low] < s - drift:
                held -= starts[order[low]]
                low += 1
            total[s] = held
        for s in order:
            first, last = s - drift, s + len(own) + drift
            if total[s] >= need and all(_has(words, p, first, last) for p in keys):
                near = set(words[max(first, 0) : max(last, 0)])
                labels[label] = max(labels.get(label, 0.0), sum(w in near for w in own) / len(own))
    for _, label in places:
        labels[label] = 1.0
    return len(words), sorted(places), labels


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_words``, ``places`` (start, label of base phrases), ``labels`` (label -> score).

    Null text counts as empty: no words, places or labels. Repeated rows are scanned each for itself.
    """
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    place, label = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())])), pa.map_(pa.string(), pa.float64())

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [scan(t) for (t,) in rows_of([part.select(["text"])])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([f[0] for f in found], pa.int64()), pa.array([[{"start": s, "label": x} for s, x in f[1]] for f in found], place), pa.array([sorted(f[2].items()) for f in found], label)],
                    ["id", "n_words", "places", "labels"],
                )

    out = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_words long, places array<struct<start:long,label:string>>, labels map<string,double>")
    return out.withColumnRenamed("id", id_col)
