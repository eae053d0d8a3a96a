"""Secret scan with recursive unwrapping of encoded layers.

Every text is scanned for three kinds of secrets. Then a worklist unwraps it: runs of ``%XX`` (URL),
runs with ``\\uXXXX`` or ``\\xXX`` escapes (Unicode), base64 (standard or URL alphabet, also wrapped in
lines) and, after base64, zlib, gzip, bzip2, xz or zstd data. Each decoded layer is scanned and unwrapped
again until no layer gives a new one; a layer whose text was seen before at the same place of this document
is not unwrapped again, so cycles end and copies at other places are found. Every finding is mapped back to code points of the original text: escapes map
character by character, base64 and compressed data map to the whole encoded run.

A decoded layer counts only when it is valid UTF-8 without control characters. Decompression streams
into at most ``MAX_LAYER`` bytes; a layer beyond that is left and counted in ``n_oversized``.

Defined cases: a null text is an empty one (no spans, the SHA-256 of the empty string); ties are ordered
by start, kind as listed, end; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame

from labelloom.llm.inputs import pieces

# The kinds in their order and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a maximal run, 18 characters or more
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")  # a maximal run, 16 characters or more
URL_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPED = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]{16,})*(?:\r?\n[A-Za-z0-9+/_-]{1,15}(?![A-Za-z0-9+/_-]))?={0,2}")
CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
MAX_LAYER = 64 << 20
CHUNK = 1 << 20


class Oversized(Exception):
    pass


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), ordered by start and kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return ordered(found)


def ordered(spans) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _readable(data: bytes) -> str | None:
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and not CONTROL.search(text) else None


def _stream(decoder, data: bytes) -> bytes:
    out, size = [], 0
    for at in range(0, len(data), 1 << 12):
        part = decoder.decompress(data[at:at + (1 << 12)])
        out.append(part)
        size += len(part)
        if size > MAX_LAYER:
            raise Oversized
        if getattr(decoder, "eof", False):
            break
    return b"".join(out)


def _inflate(data: bytes) -> bytes | None:
    """The content of compressed data, recognised by its first bytes."""
    if data[:2] == b"\x1f\x8b" or (data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0):
        decoder = zlib.decompressobj(47)
    elif data[:3] == b"BZh":
        decoder = bz2.BZ2Decompressor()
    elif data[:6] == b"\xfd7zXZ\x00":
        decoder = lzma.LZMADecompressor()
    elif data[:4] == b"\x28\xb5\x2f\xfd":
        decoder = zstandard.ZstdDecompressor().decompressobj()
    else:
        return None
    try:
        return _stream(decoder, data)
    except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
        return None


def _from_bytes(data: bytes) -> str | None:
    """Text in the bytes, after peeling any number of compressed layers."""
    seen = set()
    while (inner := _inflate(data)) is not None and inner not in seen:
        seen.add(data)
        data = inner
    return _readable(data)


def _base64_text(run: str) -> str | None:
    run = re.sub(r"[\r\n]", "", run).rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        run = run[:-1]
    try:
        data = base64.b64decode(run + "=" * (-len(run) % 4))
    except ValueError:
        return None
    return _from_bytes(data)


# A layer: its text, and for each of its characters the span of the original that it stands for.
Layer = tuple[str, list[tuple[int, int]]]


def _piecewise(text: str, pattern: re.Pattern, decode, origin) -> Layer | None:
    """Replace matches, mapping each decoded character to its match and all others to themselves."""
    out, spans, at, changed = [], [], 0, False
    for m in pattern.finditer(text):
        new = decode(m)
        if new is None:
            continue
        changed = True
        out.append(text[at:m.start()])
        spans += [origin(i, i + 1) for i in range(at, m.start())]
        out.append("".join(c for c, _, _ in new))
        spans += [origin(m.start() + a, m.start() + b) for _, a, b in new]
        at = m.end()
    if not changed:
        return None
    out.append(text[at:])
    spans += [origin(i, i + 1) for i in range(at, len(text))]
    return "".join(out), spans


def _url(m: re.Match) -> list[tuple[str, int, int]] | None:
    data = bytes.fromhex(m[0].replace("%", ""))
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    out, at = [], 0
    for c in text:
        end = at + 3 * len(c.encode("utf-8"))
        out.append((c, at, end))
        at = end
    return out


def _escape(m: re.Match) -> list[tuple[str, int, int]] | None:
    point = int(next(g for g in m.groups() if g), 16)
    if point > 0x10FFFF or 0xD800 <= point < 0xE000:
        return None
    return [(chr(point), 0, len(m[0]))]


def _lines_with(pattern: re.Pattern, text: str) -> Iterator[tuple[int, str]]:
    """(start, line) of the lines that hold a match."""
    at = 0
    while m := pattern.search(text, at):
        start = text.rfind("\n", 0, m.start()) + 1
        end = text.find("\n", m.end())
        end = len(text) if end < 0 else end
        yield start, text[start:end]
        at = end


def _unwrap(text: str, origin) -> Iterator[Layer | None]:
    """The layers directly inside a layer; None stands for one that is too large."""
    for mark, pattern, decode in (("%", URL_BYTES, _url), ("\\", ESCAPED, _escape)):
        if mark in text:
            for start, line in _lines_with(pattern, text):
                def inside(a, b, at=start):
                    return origin(at + a, at + b)
                if layer := _piecewise(line, pattern, decode, inside):
                    yield layer
    for m in BASE64.finditer(text):
        runs = [(m.start(), m.end())]
        try:
            inner = _base64_text(m[0])
            if inner is None and "\n" in m[0]:
                runs = [(m.start() + r.start(), m.start() + r.end()) for r in re.finditer(r"[^\r\n]{16,}", m[0])]
            for start, end in runs:
                inner = inner if len(runs) == 1 else _base64_text(text[start:end])
                if inner is not None:
                    yield inner, [origin(start, end)] * len(inner)
        except Oversized:
            yield None


def scan(text: str) -> tuple[list, list, int, int]:
    """(base spans, all spans, number of decoded layers, number of oversized layers)."""
    base = base_spans(text)
    every, layers, large = set(base), 0, 0
    # A layer's text and place. Spans are in order, so equal ends mean that all characters have one span.
    seen: set[tuple] = set()
    work: list[tuple[str, object]] = [(text, lambda a, b: (a, b))]
    while work:
        current, origin = work.pop()
        for layer in _unwrap(current, origin):
            if layer is None:
                large += 1
                continue
            decoded, spans = layer
            layers += 1
            for start, end, kind in base_spans(decoded):
                every.add((spans[start][0], spans[end - 1][1], kind))
            key = decoded, spans[0] if spans[0] == spans[-1] else tuple(spans)
            if key not in seen:
                seen.add(key)
                work.append((decoded, lambda a, b, s=spans: (s[a][0], s[b - 1][1])))
    return base, ordered(every), layers, large


def written(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SCHEMA = ("doc_id {}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
          "n_layers bigint, n_oversized bigint")


def scan_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its counts, digest and all spans. No row moves."""
    rows = docs.selectExpr(f"`{doc_id}` as doc_id", f"cast(`{text}` as string) as text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in pieces(frames, 512):
            out = []
            for t in frame["text"]:
                base, every, layers, large = scan(t if isinstance(t, str) else "")
                n = [sum(k == kind for _, _, k in base) for kind in KINDS]
                out.append((*n, hashlib.sha256(written(base).encode()).hexdigest(), written(every), layers, large))
            made = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans",
                                              "n_layers", "n_oversized"])
            made.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield made

    return rows.mapInPandas(run, SCHEMA.format(rows.schema["doc_id"].dataType.simpleString()))


def hide(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span, merged where they overlap, replaced by ``mark``."""
    out, at, upto = [], 0, -1
    for start, end, _ in scan(text)[1]:
        if start >= upto:
            out += [text[at:start], mark]
        upto = max(upto, end)
        at = upto
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """Pipeline stage: all documents and columns, with secrets replaced and ``n_chars`` counted anew."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in pieces(frames, 512):
            texts = [hide(t) if isinstance(t, str) else None for t in frame["text"]]
            more = {"n_chars": [None if t is None else len(t) for t in texts]} if "n_chars" in frame else {}
            if more:
                more = {"n_chars": pd.array(more["n_chars"], dtype="Int64")}
            yield frame.assign(text=texts, **more)

    return docs.mapInPandas(run, docs.schema)
