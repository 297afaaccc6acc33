"""The payload and secret detector: raw text inside the JVM, decoded forms in one Arrow function."""

from __future__ import annotations

import binascii
import re
import unicodedata
from collections.abc import Collection, Iterator
from contextlib import suppress
from functools import lru_cache, reduce
from itertools import pairwise
from operator import and_, or_
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.catalogue import ENTITIES, ODD, RAW_BYTES, Search, decides, searches

SCAN = "classes array<string>, via array<string>, normalises_differently boolean, over_budget boolean"


def once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def raw_classes(text: Column, extra: dict[str, list[str]] | None = None, only: Collection[str] | None = None) -> Column:
    """Names of the classes that match a text as it is, in the catalogue's order; null text has none. ``only`` these classes are looked for.

    Literal tokens are looked for byte by byte, and only where a character that
    few texts hold is there. A pattern runs only on texts that hold all that it
    needs, and none of them reads a text more than once.
    """
    wanted = searches(extra, only)
    gates = sorted({s.gate for found in wanted.values() for s in found} - {""})

    def one(cell: Column, s: Search) -> Column:
        tests = [cell["gates"][gates.index(s.gate)]] if s.gate else []
        odd, body = cell["odd"], cell["low"] if s.folded else cell["text"]
        if s.starts:
            tests.append(F.startswith(cell["text"], F.lit(s.pieces[0])) | F.contains(cell["text"], F.lit("\n" + s.pieces[0])))
        elif s.wide:
            tests.append(cell["wide"])
        pieces = [F.contains(body, F.lit(x)) for x in s.pieces if x != s.gate and not s.starts]
        matches = cell["text"].rlike(f"(?mdU){s.pattern}")
        if decides(s):
            tests += [reduce(and_, pieces) | (odd & matches)] if s.folded and pieces else pieces
        else:
            tests += [odd | reduce(and_, pieces)] if s.folded and pieces else pieces
            tests.append(matches)
        return reduce(and_, tests)

    def classes(cell: Column) -> Column:
        tests = [F.when(reduce(or_, [one(cell, s) for s in sorted(found, key=lambda s: (not decides(s), bool(s.pieces) and s.pieces[0] != s.gate))]), F.lit(name)) for name, found in wanted.items()]
        return F.filter(F.array(*tests), lambda x: x.isNotNull())

    def looked(cell: Column) -> Column:
        wide = F.octet_length(cell) != F.length(cell)
        odd = F.when(wide, cell.rlike(f"[{ODD}]")).otherwise(F.lit(False))
        return F.struct(cell.alias("text"), F.lower(cell).alias("low"), wide.alias("wide"), odd.alias("odd"), F.array(*(F.contains(cell, F.lit(g)) for g in gates)).alias("gates"))

    return once(looked(text), classes)


def sample_hex(value: Column, most: int = 64) -> Column:
    """Lower-case hex of the first bytes of a value."""
    return F.lower(F.hex(F.substring(F.encode(value, "UTF-8"), 1, most)))


_BEYOND = "".join(chr(c) for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000)


class _Plan:
    """The searches by the byte that each of them needs, for values of one set of incident literals."""

    def __init__(self, extra: tuple[tuple[str, tuple[str, ...]], ...]) -> None:
        self.names: list[str] = []
        self.by_gate: dict[int, list[tuple]] = {}
        self.ungated: list[tuple] = []
        self.wide: list[tuple[int, set[bytes], re.Pattern]] = []
        for i, (name, found) in enumerate(searches({k: list(v) for k, v in extra}).items()):
            self.names.append(name)
            plain = all(x.isascii() for s in found for x in (*s.pieces, s.pattern or ""))
            for s in found:
                text = re.compile(s.pattern, re.MULTILINE) if s.pattern else None
                if s.wide:
                    # The first bytes of the characters it finds.
                    self.wide.append((i, {c.encode()[:2] for c in text.findall(_BEYOND)}, text))
                    continue
                data = re.compile(s.pattern.encode(), re.MULTILINE) if s.pattern and plain else None
                entry = (i, plain, s.folded, s.starts, decides(s), tuple(x.encode() for x in s.pieces if x != s.gate or s.starts), text, data)
                (self.by_gate.setdefault(ord(s.gate), []) if s.gate else self.ungated).append(entry)
        self.raw = [(self.names.index(name), x) for name, tokens in RAW_BYTES.items() for x in tokens]
        self.harmless = bytes(b for b in range(256) if b not in self.by_gate)
        self.odd = [c.encode() for c in ODD]


_plan = lru_cache(maxsize=8)(_Plan)


def match_bytes(value: bytes, extra: tuple = ()) -> list[str]:
    """Classes in a value: by characters if it is UTF-8, else by bytes."""
    plan = _plan(extra)
    tests = plan.ungated
    for gate in set(value.translate(None, plan.harmless)):
        tests = tests + plan.by_gate[gate]
    text, odd = None, False
    if value.isascii():
        ascii_only = valid = True
    else:
        ascii_only = False
        try:
            text, valid = value.decode(), True
            odd = any(x in value for x in plan.odd)
        except UnicodeDecodeError:
            valid = False
    low, hits = value.lower(), set()
    for i, plain, folded, starts, decided, pieces, pattern, data in tests:
        if i in hits or not (valid or plain):
            continue
        if starts:
            if value.startswith(pieces[0]) or b"\n" + pieces[0] in value:
                hits.add(i)
            continue
        body = low if folded else value
        there = True
        for x in pieces:
            if x not in body:
                there = False
                break
        if there and decided:
            hits.add(i)
        elif there or (folded and odd):
            if not valid:
                found = data.search(value)
            else:
                if text is None:
                    text = value.decode()
                found = pattern.search(text)
            if found:
                hits.add(i)
    if not ascii_only:
        if valid:
            hits.update(i for i, leads, pattern in plan.wide if any(x in value for x in leads) and pattern.search(text))
        else:
            hits.update(i for i, x in plan.raw if x in value)
    return [plan.names[i] for i in sorted(hits)]


def decode_entities(text: str) -> str:
    """Numeric entities and the names of :data:`ENTITIES`, each at most nine characters between ``&`` and ``;``."""

    def one(m: re.Match) -> str:
        name = m[1]
        if name in ENTITIES:
            return ENTITIES[name]
        number = re.fullmatch(r"#(?:[xX]\+?([0-9a-fA-F]+)|\+?([0-9]+))", name, re.ASCII)
        code = -1 if number is None else int(number[1], 16) if number[1] else int(number[2])
        return chr(code) if 0 <= code < 0x110000 and not 0xD800 <= code < 0xE000 else m[0]

    return re.sub(r"&([^;]{0,9});", lambda m: one(m) if len(m[1].encode()) <= 9 else m[0], text) if "&" in text else text


def decode_escapes(text: str) -> str:
    r"""``\uXXXX``, pairs of surrogates as one character; a lone surrogate stays."""

    def one(m: re.Match) -> str:
        if m[1]:
            return chr(0x10000 + ((int(m[1], 16) - 0xD800) << 10) + int(m[2], 16) - 0xDC00)
        code = int(m[3], 16)
        return m[0] if 0xD800 <= code < 0xE000 else chr(code)

    return re.sub(r"\\u([dD][89abAB][0-9a-fA-F]{2})\\u([dD][c-fC-F][0-9a-fA-F]{2})|\\u([0-9a-fA-F]{4})", one, text) if "\\u" in text else text


def strict_base64(run: bytes) -> bytes | None:
    """A canonical encoding in the plain or the URL alphabet, padded or not; None for anything else."""
    body = run.rstrip(b"=")
    over = len(body) % 4
    if not body or over == 1 or (len(run) != len(body) and len(run) % 4):
        return None
    # The last letter's bits beyond whole bytes are zero.
    if (over == 2 and body[-1] not in b"AQgw") or (over == 3 and body[-1] not in b"AEIMQUYcgkosw048") or not _ALPHABET(body):
        return None
    if b"-" in body or b"_" in body:
        if b"+" in body or b"/" in body:
            return None
        body = body.replace(b"-", b"+").replace(b"_", b"/")
    return binascii.a2b_base64(body + b"=" * (-over % 4))


_ALPHABET = re.compile(rb"[A-Za-z0-9+/_-]+").fullmatch
#: Values of up to so many bytes are remembered: words and what they decode to come again and again.
SHORT = 64


class _Decoded(dict):
    """What runs decode to, b"" for nothing; at most so many short ones are kept."""

    def __missing__(self, run: bytes) -> bytes:
        out = strict_base64(run) or b""
        if len(run) <= SHORT:
            if len(self) >= 1 << 16:
                self.clear()
            self[run] = out
        return out


_decoded = _Decoded()


class OverBudget(Exception):
    """A value unfolds into more than its bounds allow; a finding, never a failed task."""


def _forms(current: bytes, with_base64: bool, longest: int) -> list[tuple[str, bytes]]:
    """What one value decodes to in one step, itself and nothing left out."""
    forms: list[tuple[str, bytes]] = []
    if b"%" in current:
        forms.append(("percent", unquote_to_bytes(current)))
    if b"&" in current or b"\\u" in current:
        with suppress(UnicodeDecodeError):
            text = current.decode()
            forms += [("html_entity", decode_entities(text).encode()), ("unicode_escape", decode_escapes(text).encode())]
    if with_base64:
        found = list(filter(None, map(_decoded.__getitem__, _runs(current, longest))))
        if len(found) > 256:
            raise OverBudget
        forms += [("base64", d) for d in found]
    return [(via, form) for via, form in forms if form and form != current]


_ALL_RUNS = re.compile(rb"[A-Za-z0-9+/=_-]{2,}").findall
_IN_RUN = np.array([re.match(rb"[A-Za-z0-9+/=_-]", bytes([c])) is not None for c in range(256)])
#: As the last of a run: 1 may follow two over, 2 three over a multiple of four, 4 is padding.
_LAST = np.array([(c in b"AQgw") + 2 * (c in b"AEIMQUYcgkosw048") + 4 * (c in b"=") for c in range(256)], np.uint8)


def _runs(current: bytes, longest: int) -> list[bytes]:
    """Runs of the base64 alphabets, of a long value only those whose length and last byte allow a canonical encoding."""
    if len(current) <= SHORT:
        return [x for x in _ALL_RUNS(current) if len(x) <= longest]
    data = np.frombuffer(current, np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_RUN[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    size = ends - starts
    over, last = size & 3, _LAST[data[ends - 1]]
    able = ((over == 0) | ((over == 2) & (last & 1 > 0)) | ((over == 3) & (last & 2 > 0)) | (last & 4 > 0)) & (size <= longest)
    return [current[i:j] for i, j in zip(starts[able].tolist(), ends[able].tolist(), strict=True)]


_short_forms = lru_cache(maxsize=1 << 14)(_forms)


def decodings(value: bytes, rounds: int = 3, ratio: int = 8, with_base64: bool = True) -> Iterator[tuple[str, bytes]]:
    """Decoded forms of a value, breadth first, each once, within max(64, ratio x length) bytes in all."""
    budget, seen, frontier, total = max(64, len(value) * ratio), {value}, [value], 0
    for _ in range(rounds):
        following = []
        for current in frontier:
            forms = _short_forms(current, with_base64, SHORT) if len(current) <= SHORT else _forms(current, with_base64, budget)
            for via, form in forms:
                if len(form) > budget or form in seen:
                    continue
                total += len(form)
                if total > budget or len(seen) >= 1024:
                    raise OverBudget
                seen.add(form)
                yield via, form
                following.append(form)
        frontier = following


def _judged(data: bytes, extra: tuple) -> tuple[list[str], list[tuple[str, list[str]]], bool]:
    """Classes in a form, in its normalised forms where they differ, and whether NFC changes it."""
    hits = match_bytes(data, extra)
    if data.isascii():
        return hits, [], False
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return hits, [], False
    forms = [(kind, form) for kind in ("nfc", "nfkc") if (form := unicodedata.normalize(kind.upper(), text)) != text]
    return hits, [(kind, match_bytes(form.encode(), extra)) for kind, form in forms], any(kind == "nfc" for kind, _ in forms)


_short_judged = lru_cache(maxsize=1 << 14)(_judged)


def scan(value: bytes, *, rounds: int = 3, ratio: int = 8, with_base64: bool = True, extra: tuple = ()) -> tuple[list[str], list[str], bool, bool]:
    """(classes, forms they were found in, whether NFC changes a form, whether the bounds were passed) of one value."""
    classes: dict[str, None] = {}
    via: dict[str, None] = {}
    differs = over = False

    def record(form: str, data: bytes) -> None:
        nonlocal differs
        hits, normalised, changed = _short_judged(data, extra) if len(data) <= SHORT else _judged(data, extra)
        for kind, found in ((form, hits), *normalised):
            if found:
                via[kind] = None
                classes.update(dict.fromkeys(found))
        differs |= changed

    record("raw", value)
    try:
        for form, data in decodings(value, rounds, ratio, with_base64):
            record(form, data)
    except OverBudget:
        over = True
    return list(classes), list(via), differs, over


def may_hold(text: Column) -> Column:
    """False only for texts whose :func:`scan` finds nothing: up to one letter, digit, space, comma or point, in which no form can be encoded."""
    return ~text.rlike(r"\A[A-Za-z0-9 ,.]?\z")


@lru_cache(maxsize=1)
def unstable() -> str:
    """Java's class of the characters that NFC may change, move or join to what stands before them."""
    second = {int(x, 16) for c in _BEYOND if (d := unicodedata.decomposition(c)) and not d.startswith("<") for x in d.split()[1:]}
    second |= {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    ranges: list[list[int]] = []
    for c in _BEYOND:
        code = ord(c)
        if code in second or unicodedata.combining(c) or not unicodedata.is_normalized("NFC", c):
            if ranges and code - ranges[-1][1] <= 16:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    # The widest gaps are left out first: most letters are read once, not once a range.
    gaps = sorted(((b[0] - a[1], a[1] + 1, b[0] - 1) for a, b in pairwise(ranges)), reverse=True)[:6]
    spell = lambda pairs: "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in pairs)
    return f"[[^{spell([(0, ranges[0][0] - 1), *(g[1:] for g in gaps)])}]&&[{spell(ranges)}]]"


def nfc_differs(text: Column) -> Column:
    """Whether NFC changes a text. Only the parts that it may change go to Python, each with the character before it."""
    found = unstable()

    @F.arrow_udf("boolean")
    def differs(parts: pa.Array) -> pa.Array:
        return pa.array([v is not None and not unicodedata.is_normalized("NFC", v) for start in range(0, len(parts), 64) for v in parts.slice(start, 64).to_pylist()], pa.bool_())

    parts = F.array_join(F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s).?{found}+"), F.lit(0))), "\n")
    return differs(F.when(text.rlike(found), parts))


@lru_cache(maxsize=1 << 12)
def _short_scan(value: bytes, rounds: int, ratio: int, with_base64: bool, extra: tuple) -> tuple[list[str], list[str], bool, bool]:
    return scan(value, rounds=rounds, ratio=ratio, with_base64=with_base64, extra=extra)


def decoded_scan(value: Column, *, rounds: int = 3, ratio: int = 8, with_base64: bool = True, extra: dict[str, list[str]] | None = None) -> Column:
    """:func:`scan` of a text or binary column as a struct; null scans as empty. One Arrow batch function, few texts of a batch at a time."""
    more = tuple((k, tuple(v)) for k, v in (extra or {}).items())

    @F.arrow_udf(SCAN)
    def run(values: pa.Array) -> pa.Array:
        data = values.cast(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()) if not pa.types.is_large_binary(values.type) else values
        rows = []
        for start in range(0, len(data), 64):
            for v in data.slice(start, 64).to_pylist():
                v = v or b""
                rows.append(_short_scan(v, rounds, ratio, with_base64, more) if len(v) <= SHORT else scan(v, rounds=rounds, ratio=ratio, with_base64=with_base64, extra=more))
        names = pa.list_(pa.string())
        kinds = {"classes": names, "via": names, "normalises_differently": pa.bool_(), "over_budget": pa.bool_()}
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], names=list(kinds))

    return run(value)
