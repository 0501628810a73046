"""Token files of independent zstandard frames.

A shard holds one frame per document (more for one of over a million ids), an
index of its documents, and a trailing seek table with each frame's sizes and
checksum, so that a reader fetches and decompresses only the documents it
wants.  Index and seek table are skippable frames: any zstandard tool can
decompress the shard as a whole.

Layout, all little-endian:

* frames of unsigned 32-bit ids, each with zstandard's own checksum too;
* skippable frame 0x184D2A50: documents (u64), then per document its key
  (i64), whether the key is null (u8) and its number of frames (u32);
* skippable frame 0x184D2A5E: per frame compressed size, size and the low 32
  bits of the XXH64 of the content (u32 each); frames (u32), 0x80, 0x8F92EAB1.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atelier.llm import common as C
from atelier.llm.bpe import Merges, byte_chars, ragged

INDEX, SEEK, FOOT = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FRAME_IDS = 1 << 20
#: Bytes of text that are encoded at once, and of a shard's texts at most (a longer text apart).
SLICE, SHARD_BYTES = 2 << 20, 512 << 20
#: Words of letters that are encoded as one text, and bytes that are read at once.
RUN, READ_BYTES = 200, 8 << 20
LEVEL = 3
#: Endings that the tokenizer's split pattern cuts off behind an apostrophe.
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


#: Code points below this are handled here: two bytes at most, and nothing composes among them.
SIMPLE = 0x280
LETTER, DIGIT, OTHER, ODD = range(4)


def _simple_chars(tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """Kind and folded form of the code points below ``SIMPLE``, as the
    tokenizer's normalizer and pattern have them; odd are those that fold to
    another length or to white space."""
    kind, low = np.full(SIMPLE, OTHER, np.uint8), np.arange(SIMPLE)
    for c in range(SIMPLE):
        n = tokenizer.normalizer.normalize_str(chr(c))
        if len(n) != 1 or (ord(n) < 128) != (c < 128) or ord(n) >= SIMPLE:
            kind[c] = ODD
            continue
        low[c] = ord(n)
        behind = [[end for _, (_, end) in tokenizer.pre_tokenizer.pre_tokenize_str(mark + n)] for mark in "a!"]
        kind[c] = LETTER if behind[0] == [2] else ODD if behind[0] == [1] else OTHER if behind[1] == [2] else DIGIT
    return kind, low


class WordEncoder:
    """Encodes texts word by word with a BPE of word ends whose tokenizer
    folds case and drops white space.

    As neither its normalizer nor its split joins anything across ASCII white
    space, a text's ids are those of its words one after the other, and each
    distinct word of a slice is encoded once: those in Latin letters by the
    merges, a word's last symbol being another than the same one inside; the
    others by the tokenizer.  So are whole texts that may hold a special token's string.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        end, chars = model["end_of_word_suffix"], byte_chars()
        written = [*chars, *(c + end for c in chars)]
        number = {t: i for i, t in enumerate(written)}
        pieces, pairs = [chr(i) for i in range(512)], []
        for left, right in (m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            pairs.append((number[left], number[right]))
            number[left + right] = len(pieces)
            pieces.append(pieces[number[left]] + pieces[number[right]])
            written.append(left + right)
        self.merges = Merges(512, pieces, pairs)
        self.id_of = np.array([model["vocab"][t] for t in written], np.uint32)
        self.last = np.zeros(max(model["vocab"].values()) + 1, bool)  # ids that end a word of letters
        self.last[[i for t, i in model["vocab"].items() if t.endswith(end)]] = True
        self.kinds, self.low = _simple_chars(self.tokenizer)

    def _pieces(self, char: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where the pieces of words begin: letters, single digits, and others,
        with contractions cut off.  ``first``: where words begin."""
        n, kind = len(char), self.kinds[char]
        head = np.zeros(n + 3, bool)
        head[first] = head[n:] = True
        start = head[:n] | (kind == DIGIT)
        start[1:] |= kind[1:] != kind[:-1]
        quote = np.flatnonzero((char == 39) & start)
        for end in CONTRACTIONS:
            hit = quote
            for k, c in enumerate(end, 1):
                hit = hit[~head[hit + k]]
                hit = hit[char[hit + k] == c]
            start[hit + 1] = False
            after = hit + 1 + len(end)
            start[after[after < n]] = True
        return np.flatnonzero(start)

    def _odd(self, data: np.ndarray) -> np.ndarray:
        """Bytes that begin a code point which is not handled here."""
        odd = data >= 0xC0 | SIMPLE >> 6
        two = np.flatnonzero((data >= 0xC2) & ~odd)
        odd[two] = self.kinds[(data[two] & 0x1F).astype(np.int64) << 6 | data[two + 1] & 0x3F] == ODD
        return odd

    def _simple(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of words without odd code points and how many each has."""
        place = np.flatnonzero((data & 0xC0) != 0x80)
        char = self.low[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")]
        two = char >= 128
        data[place[~two]] = char[~two]
        data[place[two]], data[place[two] + 1] = 0xC0 | char[two] >> 6, 0x80 | char[two] & 0x3F
        start = place[self._pieces(char, np.searchsorted(place, off[:-1]))]
        end = np.append(start[1:], len(data))
        symbols = data.astype(np.uint16)
        symbols[end - 1] += 256
        text = C.Text(data, np.array([0, len(data)]))
        _, one, which = np.unique(text.hashes(text.sums(C.BYTE_CODE), start, end), return_index=True, return_inverse=True)
        size = (end - start)[one]
        numbers, n = self.merges.encode(symbols[ragged(start[one], size)], np.concatenate([[0], np.cumsum(size)]))
        counts = n[which]
        total = np.concatenate([[0], np.cumsum(counts)])
        return self.id_of[numbers][ragged((np.cumsum(n) - n)[which], counts)], np.diff(total[np.searchsorted(start, off)])

    def _others(self, words: list[str]) -> list[np.ndarray]:
        """Words of letters are mostly one piece each to the tokenizer; they
        are encoded in runs, which the last ids of the pieces cut again if
        there is one for each word.  Others are encoded one by one."""
        out: list = [None] * len(words)
        letters = [i for i, w in enumerate(words) if w.isalpha()]
        for k in range(0, len(letters), RUN):
            run = letters[k : k + RUN]
            ids = np.array(self.tokenizer.encode(" ".join(words[i] for i in run), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(run):
                for i, made in zip(run, np.split(ids, ends[:-1]), strict=True):
                    out[i] = made
        rest = [i for i, made in enumerate(out) if made is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, "<u4")
        return out

    def _words(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of words of case-folded text and how many each has."""
        text = C.Text(data, np.array([0, len(data)]))
        _, one, which = np.unique(text.hashes(text.sums(C.BYTE_CODE), s, e), return_index=True, return_inverse=True)
        s1, size = s[one], (e - s)[one]
        if not np.array_equal(size[which], e - s) or not np.array_equal(data[ragged(s1[which], size[which])], data[ragged(s, e - s)]):  # two words of one hash
            made = self._others([data[i:j].tobytes().decode() for i, j in zip(s.tolist(), e.tolist(), strict=True)])
            return np.concatenate(made), np.array([len(m) for m in made])
        odd = np.concatenate([[0], np.cumsum(self._odd(data))])
        plain = odd[s1 + size] == odd[s1]
        ids, n = [np.zeros(0, np.uint32)], np.zeros(len(one), np.int64)
        p, q = np.flatnonzero(plain), np.flatnonzero(~plain)
        if len(p):
            flat, n[p] = self._simple(data[ragged(s1[p], size[p])], np.concatenate([[0], np.cumsum(size[p])]))
            ids.append(flat)
        made = self._others([data[s1[i] : s1[i] + size[i]].tobytes().decode() for i in q])
        ids += made
        n[q] = [len(m) for m in made]
        at = np.empty(len(one), np.int64)
        order = np.concatenate([p, q])
        at[order] = np.cumsum(n[order]) - n[order]
        return np.concatenate(ids)[ragged(at[which], n[which])], n[which]

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        for view in C.texts(column, SLICE):
            if not view.n:
                continue
            raw, off = view.data.tobytes(), view.off.tolist()
            s, e, row = view.words()
            own = [i for i in range(view.n) if raw.find(b"<|", off[i], off[i + 1]) >= 0] if b"<|" in raw else []
            if own:
                keep = ~np.isin(row, own)
                s, e, row = s[keep], e[keep], row[keep]
            ids, n = self._words(_FOLD[view.data], s, e) if len(s) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            flat = ids.astype("<u4").tobytes()
            stop = (4 * np.cumsum(np.bincount(row, n, view.n).astype(np.int64))).tolist()
            special = dict(zip(own, self.tokenizer.encode_batch_fast([raw[off[i] : off[i + 1]].decode() for i in own], add_special_tokens=False), strict=True))
            at = 0
            for i, to in enumerate(stop):
                yield np.array(special[i].ids, "<u4").tobytes() if i in special else flat[at:to]
                at = to


def word_encoder(path: str) -> WordEncoder:
    """The tables of a tokenizer file, made once in a worker."""
    return C.kept(("words", path), lambda: WordEncoder(path))


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a URI, or of an absolute local path."""
    return pa.fs.FileSystem.from_uri(quote(path, safe="/:@%") if "://" in path or path.startswith("file:") else path)


class ShardWriter:
    def __init__(self, path: str):
        import zstandard

        fs, at = _open(path)
        fs.create_dir(at.rpartition("/")[0], recursive=True)
        self.file = fs.open_output_stream(at, compression=None)
        self.zip = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.seek, self.keys, self.nulls, self.frames = bytearray(), array("q"), bytearray(), array("I")
        self.ids = 0

    def add(self, key: int | None, ids: bytes) -> None:
        import xxhash

        parts = [ids[i : i + 4 * FRAME_IDS] for i in range(0, len(ids), 4 * FRAME_IDS)] or [b""]
        for part in parts:
            frame = self.zip.compress(part)
            self.file.write(frame)
            self.seek += struct.pack("<III", len(frame), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF)
        self.keys.append(key or 0)
        self.nulls.append(key is None)
        self.frames.append(len(parts))
        self.ids += len(ids) // 4

    def close(self) -> None:
        index = struct.pack("<Q", len(self.keys)) + self.keys.tobytes() + bytes(self.nulls) + self.frames.tobytes()
        self.file.write(struct.pack("<II", INDEX, len(index)) + index)
        table = bytes(self.seek) + struct.pack("<IBI", len(self.seek) // 12, 0x80, FOOT)
        self.file.write(struct.pack("<II", SEEK, len(table)) + table)
        self.file.close()


class ShardReader:
    """Reads a shard; only the frames of wanted documents are fetched."""

    def __init__(self, path: str):
        import zstandard

        fs, at = _open(path)
        self.path, self.file, self.unzip = path, fs.open_input_file(at), zstandard.ZstdDecompressor()
        end = self.file.size()
        n, _, foot = struct.unpack("<IBI", self._at(end - 9, 9))
        if foot != FOOT:
            raise ValueError(f"{path}: no seek table")
        self.seek = np.frombuffer(self._at(end - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.where = np.concatenate([[0], np.cumsum(self.seek[:, 0], dtype=np.int64)])
        kind, size = struct.unpack("<II", self._at(int(self.where[-1]), 8))
        index = self._at(int(self.where[-1]) + 8, size)
        docs = struct.unpack_from("<Q", index)[0]
        if kind != INDEX or len(index) != 8 + 13 * docs:
            raise ValueError(f"{path}: broken index")
        self.keys = np.frombuffer(index, "<i8", docs, 8)
        self.nulls = np.frombuffer(index, np.uint8, docs, 8 + 8 * docs).astype(bool)
        self.frames = np.frombuffer(index, "<u4", docs, 8 + 9 * docs)
        self.first = np.concatenate([[0], np.cumsum(self.frames, dtype=np.int64)])

    def _at(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def document(self, i: int) -> bytes:
        """The ids of the shard's i-th document; raises if a checksum fails."""
        return next(self.documents(i, i + 1))

    def documents(self, start: int, stop: int) -> Iterator[bytes]:
        """The ids of consecutive documents, read in ranges of ``READ_BYTES``
        or of one longer document."""
        while start < stop:
            low = int(self.where[self.first[start]])
            end = self.where[self.first[start + 1 : stop + 1]]
            some = max(1, int(np.searchsorted(end, low + READ_BYTES, "right")))
            held = memoryview(self._at(low, int(end[some - 1]) - low))
            for i in range(start, start + some):
                parts = [self._frame(k, held[int(self.where[k]) - low : int(self.where[k + 1]) - low]) for k in range(int(self.first[i]), int(self.first[i + 1]))]
                yield parts[0] if len(parts) == 1 else b"".join(parts)
            start += some

    def _frame(self, k: int, raw: memoryview) -> bytes:
        import xxhash

        _, plain, check = (int(x) for x in self.seek[k])
        part = self.unzip.decompress(raw, max_output_size=plain) if plain else b""
        if len(part) != plain or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != check:
            raise ValueError(f"{self.path}: frame {k} is damaged")
        return part


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 1, shards: int | None = None) -> DataFrame:
    """Writes the token files of ``docs`` in ascending order of ``key`` and
    returns their written manifest: ``shard, path, docs, ids``.

    Ids are those of the tokenizer file ``tokenizer`` (a path on every
    machine) without special tokens, then ``end_id``.  Null text counts as
    empty; null keys come first; rows of one key are ordered by their text's
    hash and may share out over shards, so that a hot key is no hot shard.
    There are as many shards as shuffle partitions, or more if these would hold
    over ``SHARD_BYTES`` of text on average.
    The manifest names only files of tasks that succeeded: what a lost or
    repeated task leaves behind is never read.  An empty table gives an empty
    manifest.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    if not shards:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(shards, F.col("key").asc_nulls_first(), "h").sortWithinPartitions(F.col("key").asc_nulls_first(), "h")
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer = TaskContext.get().partitionId(), None
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.zst"
        encoder, count = word_encoder(tokenizer), 0
        for batch in batches:
            for k, ids in zip(batch["key"].to_pylist(), encoder.encode(batch["text"]), strict=True):
                writer = writer or ShardWriter(path)
                writer.add(k, ids + end)
                count += 1
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "docs": [count], "ids": [writer.ids]}, pa.schema([("shard", pa.int64()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

    return C.written(rows.select("key", "text").mapInArrow(write, "shard long, path string, docs long, ids long"), "manifest")


def read_token_files(manifest: DataFrame, key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Every document of the files: ``key``, ``start`` (ids of all documents
    before it), ``n_tokens``, ``ids_crc32`` (of the little-endian unsigned
    32-bit ids) and, with ``keep_ids``, the ``ids``.  Checksums are verified;
    a damaged file raises.  Null keys come back as null, repeated rows each
    have their own, an empty text has its end id alone; an empty manifest gives
    no rows.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    files = C.written(manifest.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")), "shards")
    n = max(1, min(files.count(), int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    fields = [("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * keep_ids
    schema = pa.schema(fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["base"].to_pylist(), strict=True):
                shard = ShardReader(path)
                for lo in range(0, len(shard.keys), 500):
                    hi = min(lo + 500, len(shard.keys))
                    cols: list[list] = [[] for _ in fields]
                    for i, raw in enumerate(shard.documents(lo, hi), lo):
                        values = (None if shard.nulls[i] else int(shard.keys[i]), start, len(raw) // 4, zlib.crc32(raw), np.frombuffer(raw, "<u4").astype(np.int64))
                        for c, v in zip(cols, values, strict=False):
                            c.append(v)
                        start += len(raw) // 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    ddl = "key long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * keep_ids
    return files.repartition(n).mapInArrow(read, ddl).withColumnRenamed("key", key)
