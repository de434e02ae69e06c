"""Texts of one Arrow batch as byte arrays: words, lines, hashes and counts without a loop per text.

A batch is ``(b, offs)``: all texts' UTF-8 bytes end to end, and where each starts and ends. Nulls
count as empty texts. Hashes are polynomials modulo 2**64 over a table of random values, so the
hash of any byte range comes from two prefix sums; a finalizer spreads the bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE, SALT = U(0x9E3779B97F4A7C15 | 1), U(0xD6E8FEB86659FD93)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i in 0..n, kept for the largest size so far."""
    size = max((k for k in _POWERS), default=0)
    if size < n + 1:
        size = 1 << max(16, int(n + 1).bit_length())
        _POWERS.clear()
        inverse = U(pow(int(BASE), -1, 1 << 64))
        both = []
        for p in (BASE, inverse):
            x = np.full(size, p, U)
            x[0] = 1
            both.append(np.cumprod(x))
        _POWERS[size] = tuple(both)
    up, down = _POWERS[size]
    return up[: n + 1], down[: n + 1]


def table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * SALT + U(seed))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    large = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(large)
    if column.null_count:
        column = column.fill_null(b"" if large == pa.large_binary() else "")
    _, where, data = column.buffers()
    offs = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    b = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return b, offs - offs[0]


def groups(offs: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes each; a longer text is a range of its own."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Texts:
    """Some texts of a batch, with what is derived from them on demand."""

    def __init__(self, b: np.ndarray, offs: np.ndarray):
        self.b, self.offs, self.n = b, offs - offs[0], len(offs) - 1

    def total(self, mask: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        c = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=c[1:])
        return c[self.offs[1:]] - c[self.offs[:-1]]

    def words(self) -> None:
        """Sets the words' starts and ends, the texts' word offsets, and each word's text."""
        space = SPACE[self.b]
        before, after = np.ones(len(space), bool), np.ones(len(space), bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        full = self.offs[1:] > self.offs[:-1]
        before[self.offs[:-1][full]] = True
        after[self.offs[1:][full] - 1] = True
        self.space = space
        self.start, self.end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
        self.word_offs = np.searchsorted(self.start, self.offs)
        self.word_text = np.repeat(np.arange(self.n), np.diff(self.word_offs))

    def lower(self) -> np.ndarray:
        """The bytes with A-Z in lower case."""
        return self.b + (((self.b >= 65) & (self.b <= 90)).astype(np.uint8) << 5)

    def prefix(self, b: np.ndarray, seed: int) -> np.ndarray:
        up, _ = powers(len(b))
        out = np.zeros(len(b) + 1, U)
        np.cumsum(table(seed)[b] * up[: len(b)], out=out[1:])
        return out

    @staticmethod
    def ranges(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges, the same wherever the bytes stand."""
        _, down = powers(len(prefix) - 1)
        return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U) * SALT)


def shingles(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each k consecutive word hashes (over text borders too: the caller masks those)."""
    if len(words) < k:
        return np.zeros(0, U)
    odd = mix(np.arange(1, k + 1, dtype=U) * SALT + U(seed)) | U(1)
    out = np.zeros(len(words) - k + 1, U)
    for j in range(k):
        out += words[j : len(words) - k + 1 + j] * odd[j]
    return mix(out)


def repeated_words(t: Texts, word_hash: np.ndarray, k: int = 8) -> np.ndarray:
    """For each text, its words that stand in a window of k words found twice or more in it."""
    hashes = shingles(word_hash, k)
    cover = np.zeros(len(word_hash) + 1, np.int32)
    at = np.flatnonzero(t.word_text[: len(hashes)] == t.word_text[k - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    if len(at):
        key = mix(hashes[at] + mix(t.word_text[at].astype(U) + SALT))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cover[at[twice]] += 1
        cover[at[twice] + k] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return covered[t.word_offs[1:]] - covered[t.word_offs[:-1]]


def repeated_lines(t: Texts, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text, its lines that have a word, and those of them that equal an earlier line."""
    breaks = np.flatnonzero(t.b == 10)
    start = np.unique(np.concatenate([t.offs[:-1], breaks + 1]))
    start = start[start < len(t.b)]
    text = np.searchsorted(t.offs, start, "right") - 1
    stops = np.append(breaks, len(t.b))
    end = np.minimum(stops[np.searchsorted(breaks, start)], t.offs[text + 1])
    worded = np.searchsorted(t.start, end) > np.searchsorted(t.start, start)
    start, end, text = start[worded], end[worded], text[worded]
    lines = np.bincount(text, minlength=t.n)
    key = mix(Texts.ranges(prefix, start, end) + mix(text.astype(U) + SALT))
    _, first = np.unique(key, return_index=True)
    return lines, lines - np.bincount(text[first], minlength=t.n)


def bounded(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of batches of about ``most`` bytes of text, with their texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        b, offs = text_bytes(batch.column(text))
        for i, j in groups(offs, most):
            yield batch.slice(i, j - i), Texts(b[offs[i] : offs[j]], offs[i : j + 1])
