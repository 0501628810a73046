"""Byte ranges of one flat JSON array, for ``id_map_scan``.

Outside strings a quotation mark opens one and a comma parts two elements;
inside, a backslash takes the next byte with it.  So a range's marks and commas
can be counted before it is known whether it begins inside a string.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa

from atelier.sources.storage import open_fs

_MARKS = re.compile(rb'\\.|"|,', re.DOTALL)
_TOKENS = re.compile(rb'"(?:[^"\\]|\\.)*"|,|[{}\[\]]|[^\s",{}\[\]]+', re.DOTALL)
_SPACE = b" \t\r\n"
_READ = 8 << 20


def _escaped(file, begin: int) -> bool:
    """Whether the byte at ``begin`` follows a backslash that takes it along."""
    n, size = 0, 64
    while True:
        low = max(0, begin - size)
        behind = file.read_at(begin - low, low)
        n = len(behind) - len(behind.rstrip(b"\\"))
        if n < len(behind) or low == 0:
            return n % 2 == 1
        size *= 4


def _open(path: str):
    fs, at = open_fs(path)
    return fs.open_input_file(at)


def count(path: str, split: int, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Quotation marks of each range, and its commas outside strings if the
    range begins outside or inside one."""
    file = _open(path)
    for batch in batches:
        rows: dict[str, list[int]] = {k: [] for k in ("id", "begin", "quotes", "outside", "inside")}
        for key, begin in zip(batch["id"].to_pylist(), batch["begin"].to_pylist(), strict=True):
            at = begin + _escaped(file, begin)
            end, commas, quotes = min(begin + split, size), [0, 0], 0
            while at < end:
                data = file.read_at(min(_READ, end - at), at)
                last = 0
                for m in _MARKS.finditer(data):
                    mark = m.group()
                    if mark == b'"':
                        quotes += 1
                    elif mark == b",":
                        commas[quotes % 2] += 1
                    last = m.end()
                # a backslash at the end of what was read is read again with the next byte
                at += len(data) - 1 if data.endswith(b"\\") and last < len(data) and at + len(data) < end else len(data)
            for name, value in zip(rows, (key, begin, quotes, *commas), strict=True):
                rows[name].append(value)
        yield pa.RecordBatch.from_pydict(rows)


def elements(path: str, split: int, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and text of the elements that begin in each range."""
    file = _open(path)
    schema = pa.schema([("pos", pa.int64()), ("elem_id", pa.string())])
    for batch in batches:
        for begin, odd, pos in zip(*(batch[c].to_pylist() for c in ("begin", "odd", "first")), strict=True):
            made: list[tuple[int, str | None]] = []
            for place, token in _tokens(file, begin, min(begin + split, size), size, bool(odd)):
                if token == b",":
                    pos += 1
                elif token in b"{}" or (token == b"[" and place > 0 and _before(file, place)):
                    raise ValueError(f"{path}: not a flat array, at byte {place}")
                elif token not in b"[]":
                    value = json.loads(token)
                    made.append((pos, value if value is None or isinstance(value, str) else token.decode()))
                if len(made) == 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], schema=schema)
                    made = []
            if made:
                positions, values = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(positions, pa.int64()), pa.array(values, pa.string())], schema=schema)


def _before(file, place: int) -> bool:
    """Whether anything but white space stands before a bracket."""
    return bool(file.read_at(min(place, 4096), max(0, place - 4096)).strip(_SPACE + b"\xef\xbb\xbf"))


def _tokens(file, begin: int, end: int, size: int, inside: bool) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the tokens that begin in ``[begin, end)``; a range
    that begins inside a string or a plain value starts behind it."""
    at = begin
    if inside:
        at += _escaped(file, begin)
        while at < size:
            data = file.read_at(min(_READ, size - at), at)
            closing = next((m for m in _MARKS.finditer(data) if m.group() == b'"'), None)
            if closing:
                at += closing.end()
                break
            at += len(data) - (data.endswith(b"\\") and at + len(data) < size)
    elif begin:
        ends = _SPACE + b',"[]{}'
        if file.read_at(1, begin - 1) not in [bytes([c]) for c in ends]:
            while at < size and file.read_at(1, at) not in [bytes([c]) for c in ends]:
                at += 1
    held, base, more = b"", at, at
    while base < end:
        if more < size:
            held += file.read_at(min(_READ, size - more), more)
            more = base + len(held)
        done = 0
        for m in _TOKENS.finditer(held):
            if base + m.start() >= end:
                return
            if m.end() == len(held) and more < size or m.group()[:1] == b'"' and len(m.group()) < 2:
                break  # may go on in what is read next
            gap = held[done : m.start()].strip(_SPACE)
            if gap:
                break  # a string that is not closed yet
            yield base + m.start(), m.group()
            done = m.end()
        if more >= size:
            rest = held[done:].strip(_SPACE + b"\xef\xbb\xbf")
            if rest and base + done < end:
                raise ValueError(f"broken JSON at byte {base + done}")
            return
        held, base = held[done:], base + done
