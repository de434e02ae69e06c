"""Quality rules by distribution divergence.

Each text gives two histograms: the classes of its characters and its common words (function words
of a few languages, and one bin for all others). References are the mean histograms of all texts of
a language that are long enough and don't fail the base rules. A text whose Jensen-Shannon distance to
every reference passes a limit is dropped; shorter texts are not judged, as their histograms are too
rough. The limit for common words follows from the distances of a language's texts to its reference and
stays below the distance of a text without any of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geogrid.llm.session import bounded_batches
from geogrid.llm.text_arrays import SPACE, Texts, bounded, repeated_lines, repeated_words

#: Function words by language.
COMMON_WORDS = {
    "en": "the of and to in is it that for on with as was at by be this are from or an",
    "de": "der die das und in zu den nicht von sich mit auf für ist im dem ein eine",
    "fr": "le la les de des du et en un une que qui pour sur dans par au",
    "es": "el la los de que y en un una se del con su para al las por",
}
WORDS = sorted({w for words in COMMON_WORDS.values() for w in words.split()})
LANGUAGES = [*sorted(COMMON_WORDS), "other"]
#: Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "break", "stop", "comma", "bang", "mark", "symbol", "quote", "control", "letter2", "letter3", "letter4", "tail")


def _classes() -> np.ndarray:
    out = np.full(256, CLASSES.index("mark"), np.int64)
    for name, chars in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("control", [*range(32), 127]), ("space", b" \t"), ("break", b"\n\r\v\f"), ("stop", b"."), ("comma", b",;:"), ("bang", b"!?"), ("symbol", SYMBOLS), ("quote", b"'\"`"), ("tail", range(128, 192)), ("letter2", range(192, 224)), ("letter3", range(224, 240)), ("letter4", range(240, 256))):
        out[list(chars)] = CLASSES.index(name)
    return out


CLASS_OF = _classes()
N_CHARS, N_WORDS = len(CLASSES) - 1, len(WORDS) + 1
#: The word limit is the outer quartile fence of a language's distances, within these shares of the distance of a text without common words.
FENCE, LEAST_SHARE, MOST_SHARE = 3.0, 0.5, 0.85
#: Bins of distances from 0 to 1.
BINS = 1000
#: Shares are summed in whole units of 1 / UNIT, so that sums don't depend on the order of rows.
UNIT = 1 << 32


class Reference(NamedTuple):
    chars: np.ndarray
    words: np.ndarray
    #: Largest distance of common words; none if the language has no list of them.
    word_limit: float | None = None


def _word_table() -> tuple[np.ndarray, np.ndarray]:
    t = Texts(np.frombuffer(" ".join(WORDS).encode(), np.uint8), np.array([0, len(" ".join(WORDS).encode())]))
    t.words()
    hashes = Texts.ranges(t.prefix(t.b, 1), t.start, t.end)
    order = np.argsort(hashes)
    return hashes[order], order


WORD_HASHES, WORD_ORDER = _word_table()


def _strip(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words without one trailing punctuation mark."""
    last = t.b[t.end - 1]
    return t.start, t.end - (((last == 46) | (last == 44)) & (t.end - t.start > 1))


def histograms(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Per text: counts of character classes, and of common words with all others last."""
    text = np.repeat(np.arange(t.n), np.diff(t.offs))
    chars = np.bincount(text * len(CLASSES) + CLASS_OF[t.b], minlength=t.n * len(CLASSES)).reshape(t.n, -1)[:, :N_CHARS]
    start, end = _strip(t)
    hashes = Texts.ranges(t.prefix(t.lower(), 1), start, end)
    at = np.minimum(np.searchsorted(WORD_HASHES, hashes), len(WORD_HASHES) - 1)
    word = np.where(WORD_HASHES[at] == hashes, WORD_ORDER[at], len(WORDS))
    words = np.bincount(t.word_text * N_WORDS + word, minlength=t.n * N_WORDS).reshape(t.n, -1)
    return chars.astype(float), words.astype(float)


def share(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) between each row of p and q."""
    m = (p + q) / 2

    def part(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0).sum(axis=-1)

    return np.sqrt(np.maximum((part(p) + part(q)) / 2, 0))


def language_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_words: int = 50) -> dict[str, Reference]:
    """Mean histograms and word limits of each language over all documents with ``min_words`` or more that pass the base rules.

    Languages without function words here (null too) are pooled as "other". What reaches the driver
    is one row for each language and bin, bounded by this module's lists and ``BINS``.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for batch, t in bounded(batches):
            t.words()
            sound = (np.diff(t.word_offs) >= min_words) & ~_base_rules(t)[1]
            lang = np.array([LANGUAGES.index(x) if x in COMMON_WORDS else len(LANGUAGES) - 1 for x in batch.column("lang").to_pylist()], np.int64)
            chars, words = histograms(t)
            yield lang[sound], share(chars)[sound], share(words)[sound]

    def summed(totals: np.ndarray) -> pa.RecordBatch:
        where = np.nonzero(totals)
        return pa.RecordBatch.from_arrays([pa.array(where[0], pa.int32()), pa.array(where[1], pa.int32()), pa.array(totals[where])], ["lang", "bin", "total"])

    def collected(count, n: int) -> np.ndarray:
        sums = np.zeros((len(LANGUAGES), n))
        parts = bounded_batches(rows, count, "lang int, bin int, total long").withColumn("total", F.col("total").cast("decimal(20,0)"))
        for r in parts.groupBy("lang", "bin").agg(F.sum("total").alias("total")).collect():
            sums[r["lang"], r["bin"]] = float(r["total"])
        return sums

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(LANGUAGES), 1 + N_CHARS + N_WORDS), np.int64)
        for lang, chars, words in judged(batches):
            np.add.at(totals, lang, np.rint(np.hstack([np.ones((len(lang), 1)), chars, words]) * UNIT).astype(np.int64))
        yield summed(totals)

    sums = collected(count, 1 + N_CHARS + N_WORDS)
    means = share(sums[:, 1 + N_CHARS :])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(LANGUAGES), BINS), np.int64)
        for lang, _, words in judged(batches):
            far = np.minimum((js_distance(words, means[lang]) * BINS).astype(np.int64), BINS - 1)
            np.add.at(totals, (lang, far), 1)
        yield summed(totals)

    far = collected(spread, BINS)
    return {x: Reference(share(s[1 : 1 + N_CHARS]), m, _word_limit(m, d) if x in COMMON_WORDS else None) for x, s, m, d in zip(LANGUAGES, sums, means, far, strict=True) if s[0] > 0}


def _word_limit(mean: np.ndarray, counts: np.ndarray) -> float:
    """The upper fence of the distances counted by bin, kept below the distance of a text without common words."""
    low, high = (np.searchsorted(np.cumsum(counts), q * counts.sum()) + 1 for q in (0.25, 0.75))
    none = js_distance(np.eye(N_WORDS)[-1:], mean)[0]
    return float(np.clip((high + FENCE * (high - low)) / BINS, LEAST_SHARE * none, MOST_SHARE * none))


def _base_rules(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Words in repeated runs, and whether a text has too few words or too many repeated ones."""
    n_words = np.diff(t.word_offs)
    repeats = repeated_words(t, Texts.ranges(t.prefix(t.b, 1), t.start, t.end))
    return repeats, (n_words < 20) | (100 * repeats > 30 * n_words)


def divergence_rules(
    docs: DataFrame,
    references: dict[str, Reference],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    max_chars: float = 0.32,
    max_words: float = 0.42,
) -> DataFrame:
    """Counts, distances and the verdict for each document.

    ``char_distance`` is the least over the references, ``word_distance`` over those with a list of common
    words (over all if none has one). ``kept`` is false if the base rules fail, or for ``min_words`` or more
    if ``char_distance`` passes its limit or no such reference is within ``max_words`` and its own limit;
    texts of other languages thus need a listed one's common words, where any document has a listed one. Null
    and empty texts have no words: they fail the base rules and have distance 0. Repeated rows give
    repeated rows; other columns are not read.
    """
    refs = list(references.values())
    listed = [r for r in refs if r.word_limit is not None] or refs
    limits = np.array([[max_words if r.word_limit is None else min(max_words, r.word_limit)] for r in listed])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in bounded(batches):
            t.words()
            n_words = np.diff(t.word_offs)
            prefix = t.prefix(t.b, 1)
            chars = t.total(~SPACE[t.b] & ((t.b & 0xC0) != 0x80))
            _, dup_lines = repeated_lines(t, prefix)
            repeats, failed = _base_rules(t)
            chars_of, words_of = (share(x) for x in histograms(t))
            if refs:
                by_words = np.array([js_distance(words_of, r.words) for r in listed])
                far = [np.min([js_distance(chars_of, r.chars) for r in refs], axis=0), by_words.min(axis=0)]
                near = (by_words <= limits).any(axis=0) | (n_words < min_words)
            else:
                far, near = [np.zeros(t.n)] * 2, np.ones(t.n, bool)
            far = [np.where(n_words >= min_words, x, 0.0) for x in far]
            kept = ~failed & (far[0] <= max_chars) & near
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(x.astype(np.int64)) for x in (n_words, chars, t.total(symbol[t.b]), dup_lines, repeats)), pa.array(failed), pa.array(kept), pa.array(far[0]), pa.array(far[1])],
                ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = bounded_batches(rows, judge, f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, char_distance double, word_distance double")
    return out.withColumnRenamed("id", id_col)
