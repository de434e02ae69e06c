"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash cuts texts where their content says so, so shared passages give equal chunks. Each
task encodes a chunk once and keeps its ids (within a bound). Where two chunks meet, the text around
the join is encoded anew: from the last whole word of the left chunk to the first whole word of the
right one, whose ids must come out as the chunks have them. If they do, the ids between them replace
what the chunks lack; if not, the window grows by a word a side, and at last to the whole text.

Chunks need a tokenizer whose tokens never reach over ASCII white space; that is read off its file
(``Layout``), and with any other file each text goes to the library whole. Runs of characters outside
``PLAIN`` (or special strings) go to the library, the rest through its model piece by piece. Reuse is
by task: a global exchange of chunks would shuffle all texts and all ids (see README).
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geogrid.llm.session import bounded_batches
from geogrid.llm.text_arrays import U, Texts, bounded, powers

#: Chunks are cut where the hash of the last WINDOW bytes has its top CUT_BITS bits 0: 2**CUT_BITS bytes on average.
WINDOW, CUT_BITS, LEAST = 32, 10, 128
#: A task keeps chunks of so many bytes of text, and so many pieces, then starts anew.
CHUNK_CACHE_BYTES, PIECE_CACHE = 4 << 20, 250_000
#: Words of each neighbour that a join's window holds at most before the whole text is encoded.
REPAIR_WORDS = 4
#: Characters for which normalization works one by one and white space is ASCII's.
PLAIN = "".join(chr(c) for c in range(0x180) if c not in (0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x130))
_NOT_PLAIN = re.compile(f"[^{re.escape(PLAIN)}]")
_LETTERS = "".join(re.escape(c) for c in PLAIN if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(re.escape(c) for c in PLAIN if unicodedata.category(c)[0] == "N")
#: The split that ``Layout`` looks for, and what it is for PLAIN characters.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^ \t-\r{_LETTERS}{_NUMBERS}]+")
_WORDS = re.compile(rb"[^ \t-\r]+")
#: Byte-level units: visible Latin-1 characters stand for their own byte, others for 256 onward.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_UNITS = dict(zip(sorted({*range(256)} - _VISIBLE), range(256, 512)))


class Layout:
    """What a tokenizer file says of its steps; ``chunked`` if texts may be cut at ASCII white space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        model = spec["model"]
        lowered = [x.get("type") for x in steps] == ["NFC", "Replace", "Lowercase"] and steps[1].get("pattern") == {"Regex": r"\s+"}
        removed = [x.get("type") for x in splits] == ["Split", "ByteLevel"] and splits[0].get("pattern") == {"Regex": SPLIT} and splits[0].get("behavior") == "Removed" and splits[0].get("invert") is True
        units = removed and not splits[1].get("add_prefix_space") and not splits[1].get("use_regex")
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        apart = not any(_WORDS.fullmatch(t.encode()) is None for t in self.special) and not any(t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens", []))
        self.chunked = bool(lowered and removed and units and apart and model.get("type") == "BPE" and not model.get("dropout"))
        self.decoder = spec.get("decoder")
        vocab = {**model["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens", [])}}
        self.tokens: list[str | None] = [None] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token


class Chunk:
    """A chunk's ids between its first and last ASCII white space, what lies before and after, and its words."""

    __slots__ = ("head", "ids", "inner", "tail")

    def __init__(self, data: bytes, encode):
        first = _SPACE.search(data)
        if first is None:
            self.head, self.inner, self.ids, self.tail = data, None, b"", b""
            return
        last = max(data.rfind(c) for c in b" \t\n\v\f\r")
        self.head, self.inner, self.tail = data[: first.start()], data[first.start() : last], data[last:]
        self.ids = encode(self.inner)


_SPACE = re.compile(rb"[ \t-\r]")


class Encoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)``, chunk by chunk."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.layout = Layout(path)
        special = [re.escape(t) for t in self.layout.special]
        self.odd = re.compile("|".join([_NOT_PLAIN.pattern, *special]))
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[bytes, Chunk] = {}
        self.kept = self.reused = self.encoded = self.widened = 0

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32).tobytes()

    def plain(self, text: str) -> bytes:
        pieces = _PIECES.findall(text.lower())
        new = list(set(pieces).difference(self.pieces))
        if new:
            if len(self.pieces) + len(new) > PIECE_CACHE:
                self.pieces.clear()
                new = list(set(pieces))
            tokenize = self.model.tokenize
            for piece in new:
                units = piece.encode().decode("latin-1").translate(_BYTE_UNITS)
                self.pieces[piece] = b"".join([t.id.to_bytes(4, "little") for t in tokenize(units)])
        return b"".join(map(self.pieces.__getitem__, pieces))

    def part(self, data: bytes) -> bytes:
        """The ids (int32 bytes) of a part of a text that ASCII white space, or the text's end, bounds."""
        text = data.decode()
        if not self.odd.search(text):
            return self.plain(text)
        out, at = [], 0
        for m in re.finditer(r"[^ \t-\r]+", text):
            if self.odd.search(m.group()):
                out += [self.plain(text[at : m.start()]), self.library(m.group())]
                at = m.end()
        return b"".join([*out, self.plain(text[at:])])

    def chunk(self, data: bytes) -> Chunk:
        found = self.chunks.get(data)
        if found is not None:
            self.reused += 1
            return found
        self.encoded += 1
        found = Chunk(data, self.part)
        self.kept += len(data)
        if self.kept > CHUNK_CACHE_BYTES:
            self.chunks.clear()
            self.kept = len(data)
        self.chunks[data] = found
        return found

    def joined(self, left: bytes, window: bytes, right: bytes) -> bytes | None:
        """The ids of ``window``, which lies between the encoded parts ``left`` and ``right`` of a text: encoded with
        words of both, until their ids come out as they are known; None if they never do."""
        for n in range(1, REPAIR_WORDS + 1):
            before, after = b" ".join(left.rsplit(None, n)[-n:]), b" ".join(right.split(None, n)[:n])
            known_left, known_right = self.part(before), self.part(after)
            found = self.part(before + b" " + window + b" " + after)
            if len(found) >= len(known_left) + len(known_right) and found.startswith(known_left) and found.endswith(known_right):
                return found[len(known_left) : len(found) - len(known_right)]
            self.widened += 1
        return None

    def encode(self, data: bytes, cuts: np.ndarray) -> bytes:
        """The ids of a text, cut at ``cuts``."""
        if not self.layout.chunked:
            return self.library(data.decode())
        out, window, left = [], b"", b""
        for c in map(self.chunk, split_chunks(data, cuts)):
            window += c.head
            if c.inner is None:
                continue
            ids = self.joined(left, window, c.inner)
            if ids is None:
                return self.library(data.decode())
            out += [ids, c.ids]
            window, left = c.tail, c.inner
        ids = self.joined(left, window, b"")
        return self.library(data.decode()) if ids is None else b"".join([*out, ids])


@functools.lru_cache(1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@functools.lru_cache(1)
def _layout(path: str) -> Layout:
    return Layout(path)


def chunk_cuts(t: Texts) -> list[np.ndarray]:
    """For each text, the offsets within it where chunks end (the text's end not among them)."""
    n = len(t.b)
    if n <= WINDOW:
        return [np.zeros(0, np.int64)] * t.n
    _, down = powers(n)
    prefix = t.prefix(t.b, 3)
    rolled = (prefix[WINDOW:] - prefix[:-WINDOW]) * down[: n - WINDOW + 1] * U(0x9E3779B97F4A7C15)
    ends = np.flatnonzero(rolled >> U(64 - CUT_BITS) == 0) + WINDOW
    ends = ends[(ends < n)]
    ends = ends[(t.b[ends] & 0xC0) != 0x80]
    text = np.searchsorted(t.offs, ends, "right") - 1
    inside = (ends - t.offs[text] >= WINDOW) & (ends < t.offs[text + 1])
    ends, text = ends[inside], text[inside]
    return np.split(ends - t.offs[text], np.searchsorted(text, np.arange(1, t.n)))


def split_chunks(data: bytes, cuts: np.ndarray) -> list[bytes]:
    out, at = [], 0
    for cut in cuts.tolist():
        if cut - at >= LEAST:
            out.append(data[at:cut])
            at = cut
    out.append(data[at:])
    return out


def _lists(ids: list[bytes]) -> pa.ListArray:
    offs = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
    encoder = _encoder(path)
    for batch, t in bounded(batches, most=MOST):
        data, cuts = t.b.tobytes(), chunk_cuts(t)
        yield batch, _lists([encoder.encode(data[t.offs[i] : t.offs[i + 1]], cuts[i]) for i in range(t.n)])


def _decoded(lists: pa.ListArray, tokens: list[str | None]) -> pa.Array:
    offs, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    out = []
    for i, null in enumerate(lists.is_null().to_pylist()):
        words = map(tokens.__getitem__, flat[offs[i] : offs[i + 1]].tolist())
        out.append(None if null else " ".join([w for w in words if w is not None]))
    return pa.array(out, pa.string())


def _decodable(path: str) -> list[str | None]:
    layout = _layout(path)
    if layout.decoder is not None:
        raise ValueError("the tokenizer has a decoder of its own")
    return layout.tokens


#: Bytes of text in one slice of a batch.
MOST = 1 << 19


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array<int>) for each row; null and empty texts give no ids.

    Repeated rows give repeated rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lists in _encoded(batches, tokenizer_path):
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return bounded_batches(rows, run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``encoded`` ids with ``decoded``: ``Tokenizer.decode(ids, skip_special_tokens=False)``.

    The tokenizer file must have no decoder: tokens are then joined by a blank, ids without a token
    left out. Null ids give null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _decodable(tokenizer_path)
        for batch in batches:
            lists = batch.column("ids")
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists, _decoded(lists, tokens)], ["id", "ids", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return bounded_batches(rows, run, f"id {kind}, ids array<int>, decoded string").toDF(id_col, ids_col, "decoded")


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` by one Python worker a task instead of two, which halves what workers hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _decodable(tokenizer_path)
        for batch, lists in _encoded(batches, tokenizer_path):
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists, _decoded(lists, tokens)], ["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return bounded_batches(rows, run, f"id {kind}, ids array<int>, decoded string").toDF(id_col, "ids", "decoded")
