"""Motion-JPEG in AVI: store bytes as frames, parse RIFF indexes, decode intra frames, find shots.

``to_avi`` stores a payload as grey frames of 64 samples a row, coded by JPEG's lossless process
(SOF3, each row a restart interval). ``read_avi`` follows the RIFF chunks of all parts (AVI and AVIX,
``rec `` lists) and their indexes (indx with ix## chunks, or idx1) and decodes frames of that process or of the baseline DCT one (SOF0; grey or YCbCr, luma returned). Both
decoders run over all restart intervals of all frames at once, one symbol a step, so small files
share the cost. ``shots`` cuts where the histogram difference of two frames stands out from those
around it, and gives timed clips.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geogrid.llm.session import bound_batches
from geogrid.llm.text_arrays import bounded, groups, text_bytes

WIDTH, MAX_ROWS, FPS = 64, 64, 25
BINS, CUT_FLOOR, CUT_SIGMAS, CUT_SPAN = 16, 0.12, 3.0, 8
#: Code lengths of the difference categories 0..8 in frames written here.
CATEGORY_BITS = (4, 5, 4, 4, 4, 3, 2, 2, 5)


def _canonical(bits: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and length of each symbol (256 entries), from a DHT's counts and values."""
    code, length = np.zeros(256, np.int64), np.zeros(256, np.int64)
    c = k = 0
    for size, count in enumerate(bits, 1):
        for _ in range(count):
            code[values[k]], length[values[k]] = c, size
            c, k = c + 1, k + 1
        c <<= 1
    return code, length


def _own_table() -> tuple[np.ndarray, np.ndarray]:
    order = sorted(range(9), key=lambda s: (CATEGORY_BITS[s], s))
    return np.array([sum(b == n for b in CATEGORY_BITS) for n in range(1, 17)]), np.array(order)


BITS, VALUES = _own_table()
CODE, LENGTH = _canonical(BITS, VALUES)
CATEGORY = np.array([0, *(int(v).bit_length() for v in range(1, 256))])


def _marker(code: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, code, len(body) + 2) + body


def _head(rows: int) -> bytes:
    dht = _marker(0xC4, bytes([0, *BITS, *VALUES]))
    sof = _marker(0xC3, struct.pack(">BHHB3B", 8, rows, WIDTH, 1, 1, 0x11, 0))
    return b"\xff\xd8" + dht + sof + _marker(0xDD, struct.pack(">H", WIDTH)) + _marker(0xDA, bytes([1, 1, 0, 1, 0, 0]))


def code_rows(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes of rows of 64 samples, each on whole bytes and stuffed, and their ends."""
    n = len(samples)
    diff = np.diff(samples.astype(np.int32), axis=1, prepend=128)
    size = CATEGORY[np.abs(diff)]
    extra = np.where(diff < 0, diff + (1 << size) - 1, diff)
    length = LENGTH[size] + size
    code = (CODE[size] << size) | extra
    row_bits = length.sum(axis=1)
    row_bytes = (row_bits + 7) // 8
    row_start = np.concatenate([[0], np.cumsum(row_bytes)])
    at = (np.cumsum(length, axis=1) - length + row_start[:-1, None] * 8).ravel()
    shifted = code.ravel() << (24 - (at & 7) - length.ravel())  # at most 13 + 7 bits, in three bytes
    byte, total = at >> 3, int(row_start[-1])
    out = np.zeros(total + 3)
    for k in range(3):
        out += np.bincount(byte + k, (shifted >> (16 - 8 * k)) & 255, total + 3)
    out = out[:total].astype(np.uint8)
    out[row_start[1:] - 1] |= ((1 << (row_bytes * 8 - row_bits)) - 1).astype(np.uint8)  # rows end with ones
    stuffed = out == 255
    before = np.concatenate([[0], np.cumsum(stuffed)])
    final = np.zeros(total + int(before[-1]), np.uint8)
    final[np.arange(total) + before[:-1]] = out
    return final, (row_start + before[row_start])[1:] if n else np.zeros(0, np.int64)


def _riff(kind: bytes, body: bytes) -> bytes:
    return kind + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def _avi(frames: list[bytes], rows: int, size: int) -> bytes:
    """An AVI file; the stream's private data (strd) holds the payload's size."""
    longest = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FPS, longest * FPS, 0, 0x10, len(frames), 0, 1, longest, WIDTH, rows, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIIIhhhh", b"vids", b"MJPG", 0, 0, 0, 0, 1, FPS, 0, len(frames), longest, 0xFFFFFFFF, 0, 0, 0, WIDTH, rows)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, rows, 1, 8, b"MJPG", WIDTH * rows, 0, 0, 0, 0)
    strl = b"strl" + _riff(b"strh", strh) + _riff(b"strf", strf) + _riff(b"strd", struct.pack("<Q", size))
    hdrl = b"hdrl" + _riff(b"avih", avih) + _riff(b"LIST", strl)
    movi, index = [b"movi"], []
    at = 4
    for f in frames:
        chunk = _riff(b"00dc", f)
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        movi.append(chunk)
        at += len(chunk)
    return _riff(b"RIFF", b"AVI " + _riff(b"LIST", hdrl) + _riff(b"LIST", b"".join(movi)) + _riff(b"idx1", b"".join(index)))


def write_avis(payloads: list[bytes]) -> list[bytes]:
    """Each payload (bytes, a positive multiple of 64) as an AVI file."""
    shapes, padded = [], []
    for p in payloads:
        rows = len(p) // WIDTH
        height = min(rows, MAX_ROWS)
        n = -(-rows // height)
        shapes.append((height, n, len(p)))
        padded.append(p + b"\0" * (n * height * WIDTH - len(p)))
    coded, ends = code_rows(np.frombuffer(b"".join(padded), np.uint8).reshape(-1, WIDTH))
    coded, ends = coded.tobytes(), [0, *ends.tolist()]
    restarts = [bytes([0xFF, 0xD0 + k]) for k in range(8)]
    out, row = [], 0
    for height, n, size in shapes:
        head, frames = _head(height), []
        for _ in range(n):
            parts = [head]
            for k in range(height):
                parts.append(coded[ends[row + k] : ends[row + k + 1]])
                parts.append(restarts[k & 7])
            parts[-1] = b"\xff\xd9"
            frames.append(b"".join(parts))
            row += height
        out.append(_avi(frames, height, size))
    return out


def _chunks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        kind, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        yield kind, at + 8, min(at + 8 + size, end)
        at += 8 + size + (size & 1)


def _movi_frames(data: bytes, lo: int, hi: int) -> Iterator[bytes]:
    """Video chunks in file order, those in ``rec `` lists too."""
    for kind, a, z in _chunks(data, lo, hi):
        if kind == b"LIST" and data[a : a + 4] == b"rec ":
            yield from _movi_frames(data, a + 4, z)
        elif _is_video(kind):
            yield data[a:z]


def _is_video(kind: bytes) -> bool:
    return kind[2:] in (b"dc", b"db")


def _standard_index(data: bytes, lo: int, hi: int) -> list[bytes]:
    """Frames by an ``indx`` chunk: an index of ``ix##`` chunks (type 0), or one of frames itself (type 1)."""
    per, kind, n = struct.unpack_from("<HxBI", data, lo)
    if kind == 0:
        out = []
        for k in range(n):
            at, _, _ = struct.unpack_from("<QII", data, lo + 24 + 16 * k)
            size = struct.unpack_from("<I", data, at + 4)[0]
            out += _standard_index(data, at + 8, at + 8 + size)
        return out
    base = struct.unpack_from("<Q", data, lo + 12)[0]
    entries = [struct.unpack_from("<II", data, lo + 24 + 4 * per * k) for k in range(n)]
    return [data[base + off : base + off + (size & 0x7FFFFFFF)] for off, size in entries]


def parse_avi(data: bytes) -> tuple[list[bytes], float, int | None]:
    """Frames in index order (in file order without an index), frames a second, payload size or None.

    An idx1 tells of the first RIFF part alone: frames of further parts follow in file order.
    """
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("no AVI file")
    rate, size, movis, index, standard = float(FPS), None, [], None, None
    parts = [(lo + 4, hi) for kind, lo, hi in _chunks(data, 0, len(data)) if kind == b"RIFF" and data[lo : lo + 4] in (b"AVI ", b"AVIX")]
    stack, video = parts[::-1], False
    while stack:
        for kind, lo, hi in _chunks(data, *stack.pop()):
            if kind == b"LIST" and data[lo : lo + 4] in (b"hdrl", b"strl"):
                stack.append((lo + 4, hi))
                video = False
            elif kind == b"LIST" and data[lo : lo + 4] == b"movi":
                movis.append((lo, hi))
            elif kind == b"strh" and data[lo : lo + 4] == b"vids":
                video = True
                scale, per = struct.unpack_from("<II", data, lo + 20)
                rate = per / scale if scale and per else rate
            elif kind == b"strh":
                video = False
            elif kind == b"indx" and video:
                standard = (lo, hi)
            elif kind == b"strd" and hi - lo == 8:
                size = struct.unpack_from("<Q", data, lo)[0]
            elif kind == b"idx1" and index is None:
                index = [struct.unpack_from("<4sIII", data, k) for k in range(lo, hi - 15, 16)]
    if standard is not None:
        return _standard_index(data, *standard), rate, size
    if index is None or not movis:
        return [f for lo, hi in movis for f in _movi_frames(data, lo + 4, hi)], rate, size
    own = [(off, n) for kind, _, off, n in index if _is_video(kind)]
    first = movis[0][0]
    base = first if own and _is_video(data[first + own[0][0] : first + own[0][0] + 4]) else 0  # some files index from their start
    frames = [data[base + off + 8 : base + off + 8 + n] for off, n in own]
    return frames + [f for lo, hi in movis[1:] for f in _movi_frames(data, lo + 4, hi)], rate, size


#: The tables that motion JPEG frames without a DHT use (class and number: counts of code lengths 1 to
#: 16, and the first symbols; those that are missing follow in ascending order).
STANDARD_TABLES = {
    0x00: ("0 1 5 1 1 1 1 1 1 0 0 0 0 0 0 0", "00 01 02 03 04 05 06 07 08 09 0a 0b"),
    0x01: ("0 3 1 1 1 1 1 1 1 1 1 0 0 0 0 0", "00 01 02 03 04 05 06 07 08 09 0a 0b"),
    0x10: ("0 2 1 3 3 2 4 3 5 5 4 4 0 0 1 125", "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 23 42 b1 c1 15 52 d1 f0 24 33 62 72 82"),
    0x11: ("0 2 1 2 4 4 3 4 7 5 4 4 0 1 2 119", "00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1"),
}


def _standard_tables() -> dict[int, tuple[np.ndarray, np.ndarray]]:
    out = {}
    for number, (bits, first) in STANDARD_TABLES.items():
        values = [int(x, 16) for x in first.split()]
        every = sorted({0, 0xF0, *(run << 4 | size for run in range(16) for size in range(1, 11))}) if number & 0x10 else values
        out[number] = (np.array([int(x) for x in bits.split()], np.uint8), np.array(values + [v for v in every if v not in values], np.uint8))
    return out


_STANDARD = _standard_tables()


class Frame:
    """A JPEG frame's headers and its restart intervals, without stuffing."""

    def __init__(self, data: bytes):
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.quant: dict[int, np.ndarray] = {}
        self.restart, at, self.process = 0, 2, 0
        if data[:2] != b"\xff\xd8":
            raise ValueError("no JPEG frame")
        while True:
            if data[at] != 0xFF:
                raise ValueError("a marker is missing")
            marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xC4:
                while body:
                    bits = np.frombuffer(body[1:17], np.uint8)
                    n = int(bits.sum())
                    self.tables[body[0]] = (bits, np.frombuffer(body[17 : 17 + n], np.uint8))
                    body = body[17 + n :]
            elif marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quant[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(float)
                    body = body[65 + 64 * wide :]
            elif marker in (0xC0, 0xC1, 0xC3):
                self.process = marker
                _, self.height, self.width, n = struct.unpack_from(">BHHB", body)
                self.parts = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
            elif marker == 0xDD:
                self.restart = struct.unpack(">H", body)[0]
            elif marker == 0xDA:
                scan = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
                self.scan = [scan[c] for c, *_ in self.parts]
                self.predictor = body[1 + 2 * body[0]]
                break
            elif 0xC2 <= marker <= 0xCF and marker != 0xC8:
                raise ValueError(f"JPEG process {marker:x} is not supported")
        if not self.process or not self.parts or not self.width or not self.height:
            raise ValueError("a scan without a frame header")
        for number, table in _STANDARD.items():
            self.tables.setdefault(number, table)
        x = np.frombuffer(data, np.uint8)[at:]
        ff = np.flatnonzero(x[:-1] == 255)
        follow = x[ff + 1]
        stop = ff[(follow == 0xD9)]
        end = int(stop[0]) if len(stop) else len(x)
        ff, follow = ff[ff < end], follow[ff < end]
        keep = np.ones(end, bool)
        keep[ff[follow == 0] + 1] = False
        rst = ff[(follow >= 0xD0) & (follow <= 0xD7)]
        keep[rst] = False
        keep[rst + 1] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        self.bytes = x[:end][keep]
        self.starts = np.concatenate([[0], kept[rst]])
        self.ends = np.append(kept[rst], kept[end])


def _lookup(table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each 16 bits: symbol << 8 | code length (0: no code)."""
    code, length = _canonical(*table)
    out = np.zeros(1 << 16, np.int64)
    for s in np.flatnonzero(length):
        lo = int(code[s]) << (16 - int(length[s]))
        out[lo : lo + (1 << (16 - int(length[s])))] = s << 8 | length[s]
    return out


class _Reader:
    """Bit readers over many intervals, moved together."""

    def __init__(self, frames: list[Frame]):
        shift = np.cumsum([0, *(len(f.bytes) for f in frames)])
        b = np.concatenate([*(f.bytes for f in frames), np.full(8, 255, np.uint8)]).astype(np.uint64)
        n = len(b) - 4
        self.window = b[:n] << np.uint64(32) | b[1 : n + 1] << np.uint64(24) | b[2 : n + 2] << np.uint64(16) | b[3 : n + 3] << np.uint64(8) | b[4 : n + 4]
        self.at = np.concatenate([f.starts + s for f, s in zip(frames, shift, strict=False)]).astype(np.int64) * 8
        self.ends = np.concatenate([f.ends + s for f, s in zip(frames, shift, strict=False)]).astype(np.int64) * 8
        self.last = (n - 1) * 8

    def peek(self, rows: np.ndarray | slice, bits: int) -> np.ndarray:
        at = np.minimum(self.at[rows], self.last)
        return (self.window[at >> 3] >> (40 - bits - (at & 7)).astype(np.uint64)).astype(np.int64) & ((1 << bits) - 1)

    def symbol(self, rows: np.ndarray | slice, lookup: np.ndarray) -> np.ndarray:
        found = lookup[self.peek(rows, 16)]
        if not (found & 255).all():
            raise ValueError("a code that no table has")
        self.at[rows] += found & 255
        return found >> 8

    def value(self, rows: np.ndarray | slice, size: np.ndarray) -> np.ndarray:
        """A signed value of ``size`` further bits."""
        raw = self.peek(rows, 16) >> (16 - size)
        self.at[rows] += size
        return np.where(raw < (1 << size) >> 1, raw - (1 << size) + 1, raw)

    def finish(self) -> None:
        if (self.at > self.ends).any():
            raise ValueError("a frame ends early")


def _lossless(frames: list[Frame]) -> list[np.ndarray]:
    """SOF3 frames of one component, predictor 1, each row an interval; all of one table and width."""
    f = frames[0]
    if any(len(x.parts) != 1 or x.predictor != 1 or x.restart != x.width or len(x.starts) != x.height for x in frames):
        raise ValueError("only predictor 1 with a restart interval a row is supported")
    reader, lookup = _Reader(frames), _lookup(f.tables[f.scan[0] >> 4])
    value = np.full(len(reader.at), 128)
    out = np.empty((f.width, len(value)), np.uint8)
    every = slice(None)
    for x in range(f.width):
        size = reader.symbol(every, lookup)
        value = (value + reader.value(every, size)) & 0xFFFF
        out[x] = value
    reader.finish()
    rows = np.ascontiguousarray(out.T)
    return np.split(rows, np.cumsum([x.height for x in frames])[:-1])


def _zigzag() -> np.ndarray:
    order = sorted(range(64), key=lambda k: (k // 8 + k % 8, (k // 8 if (k // 8 + k % 8) % 2 else k % 8)))
    return np.array(order)


ZIGZAG = _zigzag()
_DCT = np.array([[np.sqrt((1 if u else 0.5) / 4) * np.cos((2 * x + 1) * u * np.pi / 16) for u in range(8)] for x in range(8)])


def _baseline(frames: list[Frame]) -> list[np.ndarray]:
    """Luma of SOF0 frames that share their tables and layout; intervals of all frames in step."""
    f = frames[0]
    reader = _Reader(frames)
    hmax, vmax = max(p[1] for p in f.parts), max(p[2] for p in f.parts)
    if len(f.parts) == 1:
        hmax = vmax = 1
    across, down = -(-f.width // (8 * hmax)), -(-f.height // (8 * vmax))
    per = f.restart or across * down
    units = [(k, v, h) for k, p in enumerate(f.parts) for v in range(p[2] if len(f.parts) > 1 else 1) for h in range(p[1] if len(f.parts) > 1 else 1)]
    lookups = {k: _lookup(t) for k, t in f.tables.items()}
    intervals = -(-across * down // per)
    if any(len(x.starts) != intervals for x in frames):
        raise ValueError("restart intervals are missing")
    mcus = np.tile(np.minimum(per, across * down - np.arange(intervals) * per), len(frames))
    previous = np.zeros((len(f.parts), len(mcus)), np.int64)
    hy, vy = (f.parts[0][1], f.parts[0][2]) if len(f.parts) > 1 else (1, 1)
    luma = np.zeros((len(mcus), per, vy, hy, 64))
    for m in range(per):
        live = np.flatnonzero(mcus > m)
        for part, v, h in units:
            dc, ac = lookups[f.scan[part] >> 4], lookups[16 | (f.scan[part] & 15)]
            block = np.zeros((len(live), 64))
            previous[part, live] += reader.value(live, reader.symbol(live, dc))
            block[:, 0] = previous[part, live]
            k = np.ones(len(live), np.int64)
            while len(open_ := np.flatnonzero(k < 64)):
                symbol = reader.symbol(live[open_], ac)
                run, size = symbol >> 4, symbol & 15
                value = reader.value(live[open_], size)
                end = (size == 0) & (run < 15)
                k[open_] = np.where(end, 64, k[open_] + run)
                put = (size > 0) & (k[open_] < 64)
                block[open_[put], ZIGZAG[k[open_[put]]]] = value[put]
                k[open_] += 1
            if part == 0:
                quant = np.zeros(64)
                quant[ZIGZAG] = f.quant[f.parts[0][3]]
                luma[live, m, v, h] = block * quant
    reader.finish()
    pixels = np.einsum("xu,...uv,yv->...xy", _DCT, luma.reshape(*luma.shape[:4], 8, 8), _DCT) + 128
    pixels = np.clip(np.rint(pixels), 0, 255).astype(np.uint8)
    pixels = pixels.reshape(len(frames), -1, vy, hy, 8, 8)[:, : across * down].reshape(len(frames), down, across, vy, hy, 8, 8)
    full = pixels.transpose(0, 1, 3, 5, 2, 4, 6).reshape(len(frames), down * vy * 8, across * hy * 8)
    return list(full[:, : -(-f.height * vy // vmax), : -(-f.width * hy // hmax)])


def decode_frames(frames: list[bytes]) -> list[np.ndarray]:
    """Samples (luma) of JPEG frames; frames of the same tables and layout are decoded together."""
    return _decode([Frame(x) for x in frames])


def _decode(parsed: list[Frame]) -> list[np.ndarray]:
    kinds: dict[tuple, list[int]] = {}
    for i, f in enumerate(parsed):
        tables = tuple(sorted((k, a.tobytes(), b.tobytes()) for k, (a, b) in f.tables.items()))
        quant = tuple(sorted((k, q.tobytes()) for k, q in f.quant.items()))
        height = f.height if f.process != 0xC3 else 0
        kinds.setdefault((f.process, f.width, height, f.restart, tuple(f.parts), tuple(f.scan), tables, quant), []).append(i)
    out: list[np.ndarray] = [np.zeros((0, 0), np.uint8)] * len(parsed)
    for key, rows in kinds.items():
        for i, x in zip(rows, (_lossless if key[0] == 0xC3 else _baseline)([parsed[i] for i in rows]), strict=True):
            out[i] = x
    return out


def shots(frames: list[np.ndarray], rate: float) -> list[dict]:
    """Timed clips: a cut before frame t where its histogram difference passes the floor and the mean
    of the CUT_SPAN differences on each side by CUT_SIGMAS deviations."""
    n = len(frames)
    if n == 0:
        return []
    hist = np.stack([np.bincount(f.ravel() >> 4, minlength=BINS) / max(f.size, 1) for f in frames])
    cuts = []
    if n > 1:
        diff = np.abs(np.diff(hist, axis=0)).sum(axis=1) / 2
        c, c2 = (np.concatenate([[0], np.cumsum(x)]) for x in (diff, diff * diff))
        t = np.arange(n - 1)
        lo, hi = np.maximum(t - CUT_SPAN, 0), np.minimum(t + CUT_SPAN + 1, n - 1)
        others = np.maximum(hi - lo - 1, 1)
        mean = (c[hi] - c[lo] - diff) / others
        sigma = np.sqrt(np.maximum((c2[hi] - c2[lo] - diff * diff) / others - mean * mean, 0))
        cuts = (np.flatnonzero(diff > np.maximum(CUT_FLOOR, mean + CUT_SIGMAS * sigma)) + 1).tolist()
    level = hist @ (np.arange(BINS) * 16 + 7.5)
    edges = [0, *cuts, n]
    return [{"first_frame": a, "last_frame": b - 1, "start_s": a / rate, "end_s": b / rate, "mean_level": round(float(level[a:b].mean()), 6)} for a, b in zip(edges, edges[1:], strict=False)]


CLIP_TYPE = "array<struct<first_frame:int,last_frame:int,start_s:double,end_s:double,mean_level:double>>"
_CLIPS = pa.list_(pa.struct([("first_frame", pa.int32()), ("last_frame", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("mean_level", pa.float64())]))


def to_avi(rows: DataFrame, id_col: str = "doc_id", payload_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` and ``media``: each text's (or binary's) bytes as an AVI file.

    The payload is the bytes with zeros up to a positive multiple of 64; null counts as empty. Equal
    payloads give equal files. Other columns are not read.
    """
    bound_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in bounded(batches, "payload"):
            data = t.b.tobytes()
            own = [data[t.offs[i] : t.offs[i + 1]] for i in range(t.n)]
            avis = write_avis([p + b"\0" * (-len(p) % WIDTH if p else WIDTH) for p in own])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(p) for p in own], pa.int64()), pa.array(avis, pa.binary())], ["id", "n_bytes", "media"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(F.col(id_col).alias("id"), F.col(payload_col).alias("payload")).mapInArrow(run, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


#: What parsing and decoding raise on damaged files.
_DAMAGE = (ValueError, KeyError, IndexError, struct.error)


def _reason(e: Exception) -> str:
    return str(e) if type(e) is ValueError and "operands" not in str(e) else f"damaged: {type(e).__name__}"


def _parsed(media: bytes | None) -> tuple[list[Frame], float, int | None, str | None] | None:
    """(frames, rate, payload size, error) of a file; None for null."""
    if media is None:
        return None
    try:
        frames, rate, size = parse_avi(media)
        return [Frame(f) for f in frames], rate, size, None
    except _DAMAGE as e:
        return [], 0.0, None, _reason(e)


def read_avi(rows: DataFrame, id_col: str = "doc_id", media_col: str = "media", carry: tuple[str, ...] = ()) -> DataFrame:
    """What each AVI file holds: ``payload`` (its samples, up to the stored size), ``n_frames``,
    ``clips`` and the digests ``payload_sha256``, ``tail_crc32`` (last 64 bytes), ``media_sha256``.

    Null media give nulls. A file that is damaged, or whose frames are of another process, gives nulls but for
    ``media_sha256``, and says why in ``error`` (null for others). Repeated rows give repeated rows.
    """
    bound_batches(rows.sparkSession)
    extra = [f"c{k}" for k in range(len(carry))]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        media = batch.column("media").to_pylist()
        read = [_parsed(m) for m in media]
        sound = [r for r in read if r is not None and r[3] is None]
        try:
            decoded = iter(_decode([f for r in sound for f in r[0]]))
            pixels = [[next(decoded) for _ in r[0]] if r is not None and r[3] is None else None for r in read]
        except _DAMAGE:  # of one of them: each by itself
            pixels = []
            for k, r in enumerate(read):
                try:
                    pixels.append(_decode(r[0]) if r is not None and r[3] is None else None)
                except _DAMAGE as e:
                    pixels.append(None)
                    read[k] = (*r[:3], _reason(e))
        out: dict[str, list] = {k: [] for k in ("payload", "n_frames", "clips", "payload_sha256", "tail_crc32", "media_sha256", "error")}
        for m, r, frames in zip(media, read, pixels, strict=True):
            row: dict = dict.fromkeys(out)
            if m is not None:
                row["media_sha256"], row["error"] = hashlib.sha256(m).hexdigest(), r[3]
            if frames is not None:
                payload = b"".join(f.tobytes() for f in frames)[: r[2]]
                row |= {"payload": payload, "n_frames": len(frames), "clips": shots(frames, r[1]), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-64:])}
            for k, v in row.items():
                out[k].append(v)
        kinds = (pa.binary(), pa.int32(), _CLIPS, pa.string(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)), *(batch.column(c) for c in extra)], ["id", *out, *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offs = text_bytes(batch.column("media"))
            for i, j in groups(offs, 1 << 20):
                yield one(batch.slice(i, j - i))

    kind = rows.schema[id_col].dataType.simpleString()
    more = "".join(f", {c} {rows.schema[n].dataType.simpleString()}" for c, n in zip(extra, carry, strict=True))
    got = rows.select(F.col(id_col).alias("id"), F.col(media_col).alias("media"), *(F.col(n).alias(c) for c, n in zip(extra, carry, strict=True)))
    names = ["payload", "n_frames", "clips", "payload_sha256", "tail_crc32", "media_sha256", "error"]
    return got.mapInArrow(run, f"id {kind}, payload binary, n_frames int, clips {CLIP_TYPE}, payload_sha256 string, tail_crc32 long, media_sha256 string, error string{more}").toDF(id_col, *names, *carry)


def clip_rows(read: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each clip: number from 0, frames, seconds and mean level."""
    return read.select(id_col, F.posexplode("clips").alias("clip", "c")).select(id_col, "clip", "c.*")
