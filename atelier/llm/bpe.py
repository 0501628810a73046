"""Byte-pair encoding by backtracking over longest matches, and decoding.

A text is cut into pieces by the tokenizer's split pattern, and the distinct
pieces of a slice are encoded together.  In each piece the encoder takes the
longest token that starts where it stands (an Aho-Corasick automaton over the
reversed tokens has found it for every position) and keeps it if the pair with
the token before it is one that the merges leave apart; else it tries the next
shorter token that is a prefix, or steps back over the token before.  A
position that led nowhere is never entered again, so the work is linear in the
piece.  The result is that of the merges in order of rank.

Tokens are numbered by rank here: the symbols first, then one number for each
merge.  Decoding copies each token's bytes out of one array by a table of
offsets.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.llm import common as C

#: Bytes of text that are encoded at once, and ids that are decoded at once.
IDS = 1 << 20
SLICE = 1 << 20
LETTER, NUMBER, SPACE, OTHER = range(4)
#: Ends that the split pattern cuts off behind an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_chars() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: the
    printable ones of Latin-1 as themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + i)
    return [out[b] for b in range(256)]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indexes ``starts[i] ... starts[i] + counts[i] - 1`` of all i in a row."""
    end = np.cumsum(counts)
    total = int(end[-1]) if len(end) else 0
    kind = np.int32 if total + int(starts.max(initial=0)) < 2**31 else np.int64
    out = np.repeat((starts - (end - counts)).astype(kind), counts)
    out += np.arange(total, dtype=kind)
    return out


class Automaton:
    """Aho-Corasick automaton over words of symbols, for many texts at a time.

    Transitions are complete: a state without children shares the row of the
    state that it falls back to, and symbols of single tokens only lead to the
    start.
    """

    def __init__(self, symbols: int, words: list[str]):
        node, parent, via, level = {"": 0}, [0], [0], [0]
        left = words
        for size in range(1, max(map(len, words)) + 1):
            left = [w for w in left if len(w) >= size]
            for w in left:
                if w[:size] not in node:
                    node[w[:size]] = len(parent)
                    parent.append(node[w[: size - 1]])
                    via.append(ord(w[size - 1]))
                    level.append(size)
        parent, via, level = np.array(parent), np.array(via), np.array(level)
        self.depth = int(level.max())
        self.token = np.full(len(parent), -1, np.int32)  # the longest word that ends in a state
        self.token[[node[w] for w in words]] = np.arange(len(words))
        used = np.unique([ord(c) for w in words if len(w) > 1 for c in w])
        self.column = np.full(symbols, len(used), np.int32)
        self.column[used] = np.arange(len(used))
        inner = np.unique(parent)
        self.row = np.zeros(len(parent), np.int32)
        self.row[inner] = np.arange(len(inner))
        self.next = np.zeros((len(inner), len(used) + 1), np.int32)
        leaf = np.ones(len(parent), bool)
        leaf[inner] = False
        back = np.zeros(len(parent), np.int32)
        for k in range(1, self.depth + 1):
            at = np.flatnonzero(level == k)  # numbered level by level, so the rows of lower levels are done
            if k > 1:
                back[at] = self.next[self.row[back[parent[at]]], self.column[via[at]]]
            none = at[self.token[at] < 0]
            self.token[none] = self.token[back[none]]
            self.row[at[leaf[at]]] = self.row[back[at[leaf[at]]]]
            grown = at[~leaf[at]]
            self.next[self.row[grown]] = self.next[self.row[back[grown]]]
            if k == 1:
                self.next[0, self.column[via[at]]] = np.where(self.column[via[at]] < len(used), at, 0)
                self.next[self.row[grown]] = self.next[0]
            child = np.flatnonzero((level == k + 1))
            self.next[self.row[parent[child]], self.column[via[child]]] = child

    def longest(self, symbols: np.ndarray, off: np.ndarray, window: int = 1 << 12) -> np.ndarray:
        """For the symbols of each text, read from its end: the longest word
        that ends there.  Long texts are read in windows side by side, each
        from ``depth`` symbols before it."""
        size = np.diff(off)
        parts = np.maximum(1, -(-size // window))
        stop = np.repeat(off[1:], parts) - ragged(np.zeros(len(size), np.int64), parts) * window  # reads down from here
        low = np.maximum(np.repeat(off[:-1], parts), stop - window)
        begin = np.minimum(stop + self.depth, np.repeat(off[1:], parts))
        order = np.argsort(low - begin, kind="stable")  # longest first
        begin, stop, low = begin[order], stop[order], low[order]
        out = symbols.astype(np.int32)  # a single token has its symbol's number
        column = self.column[symbols]
        wide = column < self.next.shape[1] - 1
        lengths, row, flat = begin - low, np.zeros(len(begin), np.int32), self.next.ravel()
        for k in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -k, "left"))
            at = begin[:n] - 1 - k
            state = flat[row[:n].astype(np.int64) * self.next.shape[1] + column[at]]
            row[:n] = self.row[state]
            good = wide[at] & (at < stop[:n])
            out[at[good]] = self.token[state[good]]
        return out


class Merges:
    """Encodes words over a small alphabet of symbols.

    ``pieces``: the string of symbols (``chr(symbol)``) of every token by
    number; the first ``symbols`` are single.  ``pairs``: the numbers of the
    left and right part of every other token.
    """

    #: Symbols from which on a word is encoded by itself.
    LONG = 2000

    def __init__(self, symbols: int, pieces: list[str], pairs: list[tuple[int, int]]):
        self.symbols, n = symbols, len(pieces)
        by_piece = {p: i for i, p in enumerate(pieces)}
        if len(by_piece) != n:
            raise ValueError("two merges make the same token")
        self.length = np.array([len(p) for p in pieces], np.int32)
        # the longest token that is a proper prefix, -1 for none
        self.shorter = np.full(n, -1, np.int32)
        for i, p in enumerate(pieces):
            self.shorter[i] = next((by_piece[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in by_piece), -1)
        # split table: what a token was merged from
        parts = np.array(pairs, np.int32).reshape(-1, 2)
        base = np.arange(symbols, dtype=np.int32)
        self.left, self.right = np.concatenate([base, parts[:, 0]]), np.concatenate([base, parts[:, 1]])
        # pair table: which token two tokens merge to; open addressing, at most a quarter full
        self.slots = 1 << (4 * max(1, len(parts))).bit_length()
        self.pair_key, self.pair_token = np.full(self.slots, -1, np.int64), np.full(self.slots, n, np.int32)
        keys = parts[:, 0].astype(np.int64) * n + parts[:, 1]
        todo, at = np.arange(len(parts)), self._slot(keys)
        while len(todo):
            free = self.pair_key[at[todo]] < 0
            one = todo[free][np.unique(at[todo[free]], return_index=True)[1]]
            self.pair_key[at[one]], self.pair_token[at[one]] = keys[one], one + symbols
            todo = todo[self.pair_key[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) % self.slots
        self.lengths, self.prefixes = self.length.tolist(), self.shorter.tolist()
        self.automaton = Automaton(symbols, [p[::-1] for p in pieces])
        self.fits = lru_cache(1 << 16)(lambda a, b: bool(self.compatible(np.array([a]), np.array([b]))[0]))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - self.slots.bit_length())).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that a and b merge to, or a number above all tokens."""
        key = a.astype(np.int64) * len(self.length) + b
        at = self._slot(key)
        held = self.pair_key[at]
        out = self.pair_token[at]
        todo = np.flatnonzero((held != key) & (held >= 0))
        out[held != key] = len(self.length)
        while len(todo):
            at[todo] = (at[todo] + 1) % self.slots
            held = self.pair_key[at[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.pair_token[at[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave tokens a and b side by side.

        Undoes the later of the two at their border, step by step: a merge
        across the border must not come before one that was undone; of equal
        merges the left one comes first.
        """
        ok = np.ones(len(a), bool)
        todo = np.arange(len(a))
        limit = np.full(len(a), len(self.length), np.int64)
        while len(todo):
            fine = self.merged(a, b) >= limit
            ok[todo[~fine]] = False
            on = fine & (np.maximum(a, b) >= self.symbols)
            todo, a, b = todo[on], a[on], b[on]
            by_left = a > b
            limit = np.where(by_left, a, b + 1)
            a, b = np.where(by_left, self.right[a], a), np.where(by_left, b, self.left[b])
        return ok

    def encode(self, symbols: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words: flat numbers, and how many each word has."""
        n, words = len(symbols), len(off) - 1
        longest = self.automaton.longest(symbols, off)
        # places: a word of k symbols has k + 1, from its first symbol to its end
        base = off[:-1] + np.arange(words)
        stop = off[1:] + np.arange(words)
        closed = np.zeros(n + words, bool)  # places that lead nowhere
        came = np.full(n + words, -1, np.int32)  # the token that ends at a place
        size = np.diff(off)
        alone = [(w, self._walk(longest[off[w] : off[w + 1]].tolist())) for w in np.flatnonzero(size > self.LONG)]
        live = np.flatnonzero((size > 0) & (size <= self.LONG))
        at, token = base[live], longest[off[:-1][live]]
        while len(live):
            to = at + self.length[token]
            last = came[at]
            fits = ~closed[to]
            check = np.flatnonzero(fits & (last >= 0))
            fits[check] = self.compatible(last[check], token[check])
            came[to[fits]] = token[fits]
            shorter = self.shorter[token]
            back = ~fits & (shorter < 0)
            closed[at[back]] = True
            at = np.where(fits, to, np.where(back, at - self.length[np.maximum(last, 0)] * (last >= 0), at))
            token = np.where(back, last, np.where(fits, token, shorter))
            on = at < stop[live]
            live, at, token, fits = live[on], at[on], token[on], fits[on]
            token[fits] = longest[(at - live)[fits]]
        # walk back from the end of each word
        out, counts = [], np.zeros(words, np.int64)
        for w, made in alone:
            counts[w] = len(made)
        live = np.flatnonzero(size <= self.LONG)
        at = stop[live]
        while len(live):
            on = at > base[live]
            live, at = live[on], at[on]
            token = came[at]
            out.append((live, token))
            counts[live] += 1
            at = at - self.length[token]
        flat = np.empty(int(counts.sum()), np.int32)
        end = np.cumsum(counts)
        for k, (words_of, token) in enumerate(out):
            flat[end[words_of] - 1 - k] = token
        for w, made in alone:
            flat[end[w] - len(made) : end[w]] = made
        return flat, counts


    def _walk(self, longest: list[int]) -> list[int]:
        """The tokens of one word, step by step."""
        n, made, closed = len(longest), [], bytearray(len(longest) + 1)
        length, shorter = self.lengths, self.prefixes
        at, token = 0, longest[0]
        while at < n:
            to = at + length[token]
            if not closed[to] and (not made or self.fits(made[-1], token)):
                made.append(token)
                at = to
                token = longest[at] if at < n else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                closed[at] = 1
                token = made.pop()
                at -= length[token]
        return made


def char_classes(pre_tokenizer) -> np.ndarray:
    """Letter, number, white space or other, of every code point, as the
    tokenizer's own pattern sees it: over all code points in order it cuts runs
    of one class, and a run is what stays with a letter, digit or full stop."""
    code = np.array([*range(32), *range(33, 0xD800), *range(0xE000, 0x110000)])
    out = np.full(0x110000, SPACE, np.uint8)
    for part in np.split(code, range(1 << 14, len(code), 1 << 14)):
        for _, (s, e) in pre_tokenizer.pre_tokenize_str("".join(map(chr, part))):
            for kind, mark in ((LETTER, "a"), (NUMBER, "1"), (OTHER, ".")):
                if len(pre_tokenizer.pre_tokenize_str(mark + chr(part[s]))) == 1:
                    out[part[s:e]] = kind
    return out


class ByteBpe:
    """A byte-level BPE tokenizer file: split, encode, decode."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or model.get("ignore_merges"):
            raise ValueError(f"{path}: not a plain byte-level BPE")
        chars = byte_chars()
        byte_of = {c: b for b, c in enumerate(chars)}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        written = [*chars, *(a + b for a, b in merges)]
        number = {t: i for i, t in enumerate(written)}
        self.merges = Merges(256, ["".join(chr(byte_of[c]) for c in t) for t in written], [(number[a], number[b]) for a, b in merges])
        self.id_of = np.array([model["vocab"][t] for t in written], np.uint32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # offset table of the ids' bytes
        bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in model["vocab"].items()} | {i: t.encode() for t, i in self.special.items()}
        ordered = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)]
        self.size = np.array([len(b) for b in ordered], np.int32)
        self.offset = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(ordered), np.uint8)
        self.classes = char_classes(Tokenizer.from_file(path).pre_tokenizer)
        self.ascii = self.classes[:256]

    def starts(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where the pieces of the split pattern begin.  ``first``: where a run
        of text begins (bytes, ascending); pieces end there."""
        place = None
        if (data < 128).all():
            char, kind = data, self.ascii[data]
        else:
            place = np.flatnonzero((data & 0xC0) != 0x80)
            char = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
            kind = self.classes[char]
        n = len(char)
        head = np.zeros(n + 3, bool)  # a run begins; also behind the text
        head[first if place is None else np.searchsorted(place, first)] = True
        head[n:] = True
        start = head[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # the last of some white space is apart, and goes with what follows if it is a blank
        space = kind == SPACE
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~head[1:n]
        start |= last
        start[1:] &= ~(last[:-1] & (char[:-1] == 32))
        # contractions
        quote = np.flatnonzero((char == 39) & start)
        quote = quote[~head[quote + 1]]
        for end in CONTRACTIONS:
            hit = quote
            for k, c in enumerate(end, 1):
                hit = hit[~head[hit + k]]
                hit = hit[char[hit + k] == ord(c)]
            start[hit + 1] = False
            after = hit + 1 + len(end)
            start[after[after < n]] = True
        at = np.flatnonzero(start)
        return at if place is None else place[at]

    def encode(self, data: np.ndarray, off: np.ndarray, special: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts (bytes and offsets): flat, and how many
        each text has.  With ``special`` the strings of special tokens are
        those tokens, else ordinary text."""
        raw = data.tobytes()
        marks = self._special(raw, off) if special else []
        first = off[:-1][np.diff(off) > 0]
        if marks:
            first = np.unique(np.concatenate([first, *[[s, e] for s, e, _ in marks]]))
            first = first[first < len(data)]
        start = self.starts(data, first) if len(data) else np.zeros(0, np.int64)
        own = np.zeros(len(start), np.int64) - 1
        if marks:
            inside = np.zeros(len(data) + 1, bool)
            for s, e, _ in marks:
                inside[s + 1 : e] = True
            start = start[~inside[start]]
            own = np.zeros(len(start), np.int64) - 1
            own[np.searchsorted(start, [s for s, _, _ in marks])] = [i for _, _, i in marks]
        end = np.append(start[1:], len(data))
        ids, counts = self._pieces(data, start, end, own, False)
        if not np.array_equal(self.decode(ids)[0], data):  # two pieces of one hash
            ids, counts = self._pieces(data, start, end, own, True)
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(total[np.searchsorted(start, off)])

    def _special(self, raw: bytes, off: np.ndarray) -> list[tuple[int, int, int]]:
        """Start, end and id of the special tokens' strings in the texts."""
        import re

        if not any(t.encode() in raw for t in self.special):
            return []
        pattern = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(self.special, key=len, reverse=True)))
        out = []
        for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            out += [(m.start(), m.end(), self.special[m.group().decode()]) for m in pattern.finditer(raw, s, e)]
        return out

    def _pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, own: np.ndarray, by_bytes: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces: each distinct one is encoded once."""
        if by_bytes:
            raw, seen = data.tobytes(), {}
            mark = np.array([seen.setdefault(raw[s:e], len(seen)) for s, e in zip(start.tolist(), end.tolist(), strict=True)], np.int64)
        else:
            text = C.Text(data, np.array([0, len(data)]))
            mark = text.hashes(text.sums(C.BYTE_CODE), start, end)
        _, one, which = np.unique(mark, return_index=True, return_inverse=True)
        s, size = start[one], (end - start)[one]
        numbers, n = self.merges.encode(data[ragged(s, size)], np.concatenate([[0], np.cumsum(size)]))
        ids, counts = self.id_of[numbers], n[which]
        out = ids[ragged((np.cumsum(n) - n)[which], counts)]
        named = np.flatnonzero(own >= 0)
        if len(named):  # special tokens have one id
            keep = np.ones(len(out), bool)
            at = np.cumsum(counts) - counts
            out[at[named]] = own[named]
            keep[ragged(at[named] + 1, counts[named] - 1)] = False
            out, counts[named] = out[keep], 1
        return out, counts

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, and how many each has; unknown ids have none."""
        known = ids < len(self.size)
        if not known.all():
            ids = np.where(known, ids, 0)
        size = self.size[ids] * known
        return self.blob[ragged(self.offset[ids], size)], size


def tokenizer(path: str) -> ByteBpe:
    """The tables of a tokenizer file, made once in a worker."""
    return C.kept(("bytes", path), lambda: ByteBpe(path))


def cuts(data: np.ndarray, most: int) -> np.ndarray:
    """Where a long text can be cut so that its pieces stay as they are: at a
    single blank between ASCII letters or digits, about every ``most`` bytes."""
    if len(data) <= 2 * most:
        return np.array([0, len(data)])
    plain = np.zeros(256, bool)
    plain[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
    blank = np.flatnonzero(data[1:-1] == 32) + 1
    blank = blank[plain[data[blank - 1]] & plain[data[blank + 1]]]
    some = blank[np.flatnonzero(np.diff(blank // most, prepend=0))]
    return np.concatenate([[0], some, [len(data)]])


def encoded(bpe: ByteBpe, column: pa.Array, special: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of a string column and how many each row has."""
    ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for part in C.texts(column, SLICE):
        if part.n == 1:
            at = cuts(part.data, SLICE)
            some = [bpe.encode(part.data[s:e], np.array([0, e - s]), special) for s, e in zip(at[:-1], at[1:], strict=True)]
            ids += [i for i, _ in some]
            counts.append(np.array([sum(int(n[0]) for _, n in some)]))
        elif part.n:
            i, n = bpe.encode(part.data, part.off, special)
            ids.append(i)
            counts.append(n)
    return np.concatenate(ids), np.concatenate(counts)


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column of the bytes of each row's run of ``values``."""
    off = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * values.itemsize, out=off[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(values))])


def decoded(bpe: ByteBpe, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A string column from flat ids and how many each row has; what is no
    UTF-8 is replaced by U+FFFD."""
    parts = [bpe.decode(flat[i : i + IDS]) for i in range(0, len(flat), IDS)]
    data = np.concatenate([np.zeros(0, np.uint8), *[d for d, _ in parts]])
    total = np.concatenate([[0], *[n for _, n in parts]], dtype=np.int64).cumsum()
    del parts
    out = binaries(data, np.diff(total[np.concatenate([[0], np.cumsum(counts)])]))
    try:
        return out.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([b.decode("utf-8", "replace") for b in out.to_pylist()], pa.large_string())


def encode_column(path: str, text: Column, special: bool = True) -> Column:
    """``struct<n_tokens: bigint, ids: binary>`` of a text column: the ids as
    little-endian unsigned 32-bit integers.  Null and empty texts have none."""

    def run(column: pa.Array) -> list[pa.Array]:
        ids, counts = encoded(tokenizer(path), column, special)
        return [pa.array(counts, pa.int64()), binaries(ids.astype("<u4", copy=False), counts).cast(pa.binary())]

    return C.arrow_struct(run, T.StructType().add("n_tokens", "long").add("ids", "binary"), tables=True)(text.cast("string"))


def decode_column(path: str, ids: Column) -> Column:
    """The text of a column of ids as ``encode_column`` gives them.  Null ids
    give null; ids that the vocabulary lacks give nothing."""

    def run(column: pa.Array) -> pa.Array:
        column = column.cast(pa.large_binary())
        filled = column.fill_null(b"")
        off = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1] if len(filled) else np.zeros(1, np.int64)
        raw = filled.buffers()[2]
        flat = np.frombuffer(raw, "<u4", int(off[-1] - off[0]) // 4, int(off[0])) if raw is not None and raw.size else np.zeros(0, "<u4")
        out = decoded(tokenizer(path), flat, np.diff(off) // 4)
        return pa.compute.if_else(column.is_valid(), out, pa.scalar(None, pa.large_string())).cast(pa.string())

    return F.arrow_udf(run, T.StringType()).asNondeterministic()(ids)


def bpe_round_trip(docs: DataFrame, path: str, text: str = "text", out: str = "bpe", special: bool = True) -> DataFrame:
    """``docs`` with ``out``: ``n_tokens``, ``ids`` (binary, little-endian
    unsigned 32-bit) and ``decoded``, the text of these ids.

    ``path`` names a tokenizer file on every machine.  Null texts count as
    empty: no ids, empty text.  Rows are independent: ties, repeated rows and
    null keys have their own results, an empty table gives none; a column named
    as ``out`` is replaced.  No row is shuffled; a task holds a slice of 1 MiB
    of text at a time, or a longer text in pieces, besides its Arrow batch.
    """

    def run(column: pa.Array) -> list[pa.Array]:
        bpe = tokenizer(path)
        ids, counts = encoded(bpe, column, special)
        ids = ids.astype("<u4", copy=False)
        return [pa.array(counts, pa.int64()), binaries(ids, counts).cast(pa.binary()), decoded(bpe, ids, counts).cast(pa.string())]

    schema = T.StructType().add("n_tokens", "long").add("ids", "binary").add("decoded", "string")
    return C.with_struct(docs, out, C.arrow_struct(run, schema, tables=True)(F.col(f"`{text}`").cast("string")))
