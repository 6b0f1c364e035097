"""Zoning names (F21): what a cell says, as canonical zones and what could not be read."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: The zones of the planning law and the ways to say that there is none (fixed values).
CANON = [
    "第一種低層住居専用地域", "第二種低層住居専用地域", "第一種中高層住居専用地域", "第二種中高層住居専用地域",
    "第一種住居地域", "第二種住居地域", "準住居地域", "田園住居地域", "近隣商業地域", "商業地域", "準工業地域", "工業地域", "工業専用地域",
    "市街化調整区域", "市街化区域", "用途地域の指定のない区域",
]


def _short_forms() -> dict[str, str]:
    """Every accepted spelling: the full name, without 地域, and the low- and mid-rise zones cut shorter."""
    out = {}
    for zone in CANON:
        forms = {zone, zone.removesuffix("地域")}
        if "層住居専用" in zone:
            forms |= {zone.removesuffix("専用地域"), zone.removesuffix("住居専用地域")}
        out.update(dict.fromkeys(forms, zone))
    return out


_FORMS = _short_forms()


def zone_of(part: str) -> str | None:
    """One spelling as its zone; numbers in 第1種 count as kanji. Prefixes are never enough."""
    t = re.sub(r"\s", "", unicodedata.normalize("NFKC", part))
    return _FORMS.get(t.replace("第1種", "第一種").replace("第2種", "第二種"))


def zones(value: str | None) -> tuple[list[str], list[str]]:
    """(zones, unread parts), each once and in order. A line break may part two zones or one word, so two
    neighbouring parts are tried as one first."""
    parts = [p for p in map(str.strip, re.split(r"[、,､\n/／・]", value or "")) if p]
    found, unread, skip = {}, {}, False
    for part, after in zip(parts, [*parts[1:], None], strict=False):
        if skip:
            skip = False
            continue
        joined = zone_of(part + after) if after else None
        skip = joined is not None
        zone = joined or zone_of(part)
        (found if zone else unread)[zone or part] = True
    return list(found), list(unread)


@F.pandas_udf(StructType([StructField("zones", ArrayType(StringType())), StructField("unread", ArrayType(StringType()))]))
def normalize_zoning(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([zones(x) for x in s], columns=["zones", "unread"])
