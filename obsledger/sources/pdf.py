"""Text of PDF files (S9, W15): Flate streams, ToUnicode maps, glyph positions gathered into rows. A UDTF over bytes."""

from __future__ import annotations

import re
import zlib

from pyspark.sql.functions import udtf

_TOKEN = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/<>\[\]()]+|[-+]?[0-9]*\.?[0-9]+|[A-Za-z'\"*]+", re.S)


def streams(raw: bytes) -> list[bytes]:
    """The content streams of a file, inflated where that works."""
    out = []
    for m in re.finditer(rb"stream\r?\n(.*?)\r?\nendstream", raw, re.S):
        try:
            out.append(zlib.decompress(m[1]))
        except zlib.error:
            out.append(m[1])
    return out


def unicode_map(stream: bytes) -> dict[int, str]:
    """Code -> text of a ToUnicode map: single characters and ranges."""
    text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
    out = {}
    for block in re.findall(rb"beginbfchar(.*?)endbfchar", stream, re.S):
        out.update({int(a, 16): text(b) for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block)})
    for block in re.findall(rb"beginbfrange(.*?)endbfrange", stream, re.S):
        for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            low, base = int(a, 16), text(c)
            out.update({low + k: base[:-1] + chr(ord(base[-1]) + k) for k in range(int(b, 16) - low + 1)})
    return out


def _shown(token: bytes, codes: dict[int, str]) -> str:
    if token[:1] == b"<":
        h = re.sub(rb"\s", b"", token[1:-1])
        return "".join(codes.get(int(h[i : i + 4], 16), "") for i in range(0, len(h) - len(h) % 4, 4))
    plain = re.sub(rb"\\([0-7]{1,3})", lambda m: bytes([int(m[1], 8) & 255]), token[1:-1])
    return re.sub(rb"\\(.)", rb"\1", plain).decode("latin-1")


def pieces(stream: bytes, codes: dict[int, str]) -> list[tuple[float, float, str]]:
    """(y, x, text) of everything a content stream shows."""
    out, stack, x, y, lead = [], [], 0.0, 0.0, 0.0
    for token in _TOKEN.findall(stream):
        if not (token[:1].isalpha() or token in (b"'", b'"')):
            stack.append(token)
            continue
        numbers = [float(t) for t in stack if re.fullmatch(rb"[-+]?[0-9]*\.?[0-9]+", t)]
        if token == b"Tm" and len(numbers) >= 6:
            x, y = numbers[-2:]
        elif token in (b"Td", b"TD") and len(numbers) >= 2:
            x, y = x + numbers[-2], y + numbers[-1]
            lead = -numbers[-1] if token == b"TD" else lead
        elif token == b"TL" and numbers:
            lead = numbers[-1]
        elif token in (b"T*", b"'"):
            y -= lead
        elif token == b"BT":
            x = y = 0.0
        if token in (b"Tj", b"TJ", b"'"):
            text = "".join(_shown(t, codes) for t in stack if t[:1] in (b"(", b"<"))
            if text.strip():
                out.append((y, x, text))
        stack = []
    return out


def rows(raw: bytes, tolerance: float = 3.0) -> list[list[str]]:
    """The rows of a file from top to bottom: pieces whose height is within ``tolerance`` of the row's first."""
    inflated = streams(raw)
    codes: dict[int, str] = {}
    for s in inflated:
        if b"beginbfchar" in s or b"beginbfrange" in s:
            codes.update(unicode_map(s))
    out = []
    for s in inflated:
        line, top = [], None
        for y, x, text in sorted(pieces(s, codes) if b"BT" in s else [], key=lambda p: (-p[0], p[1])):
            if top is not None and top - y > tolerance:
                out.append([t for _, t in sorted(line)])
                line, top = [], None
            top = y if top is None else top
            line.append((x, text))
        if line:
            out.append([t for _, t in sorted(line)])
    return out


@udtf(returnType="row_no int, cells array<string>")
class pdf_rows:  # noqa: N801
    def eval(self, content: bytes):
        yield from enumerate(rows(bytes(content)))
