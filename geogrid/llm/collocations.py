"""Collocations by top-order marginalisation: only the longest windows are counted, ROLLUP sums their prefixes.

Each word opens a window of ``longest`` words, its columns the word and the next ones of its piece, padded with nulls
where the piece ends. Windows are counted once, and ``ROLLUP(lang, w1, ..., w5)`` sums them over ever shorter
prefixes: the sum of all windows that begin with a phrase is the number of its occurrences, of any length, and
the sum over a language is its number of words.

Most windows are seen once. As no phrase is more frequent than the pairs of words within it, a first pass counts pairs
by 64-bit hashes, and a window ends where its next pair is rarer than ``min_count``. Pairs that may be frequent travel as a
bitmap of bounded size (``most_bits``): hashes that meet only keep a window longer, so all counts stay exact,
and beyond that size more windows stay long, with the same result.

Counts are of all documents, texts without null or empty ones; a null ``lang`` is ``und``. Words may be of any length.
Phrases that occur in repeated rows count each time. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geogrid.llm.session import bounded_batches, cut
from geogrid.llm.text_arrays import Texts, U, bounded, mix

#: Candidates: phrases of 2 to LONGEST words with at least MIN_COUNT occurrences.
LONGEST, MIN_COUNT = 5, 100
#: The most bits of the bitmap of frequent pairs (8 MiB).
MOST_BITS = 26
#: Ranks of a language are found among the first of each of so many parts of its phrases.
PARTS = 64
#: Up to so many languages their numbers of words are sent to all tasks.
MOST_LANGS = 10000
#: Bytes of text that are taken apart at once.
SLICE = 2 << 20
BREAK, BLANK = np.zeros(256, bool), np.zeros(256, bool)
BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
BLANK[list(b" \t")] = True


class Words:
    """The words of some texts: codes into ``names``, the language of each, and whether the next is in the same piece."""

    def __init__(self, t: Texts, langs: pa.Array):
        b = t.lower()
        at_break = BREAK[b]
        inside = ~(at_break | BLANK[b])
        border = np.zeros(len(b) + 1, bool)
        border[t.offs] = True
        start = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]])[: len(b)] | inside & border[:-1])
        end = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]])[: len(b)] | border[1:])) + 1
        offsets = np.concatenate([[0], np.cumsum(end - start)])
        values = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(b[inside].tobytes()))
        coded = values.dictionary_encode()
        self.names, self.codes = coded.dictionary, coded.indices.to_numpy()
        breaks = np.cumsum(at_break, dtype=np.int32)
        text = np.searchsorted(t.offs, start, "right") - 1
        self.next = np.zeros(len(start), bool)
        self.next[:-1] = (breaks[start[1:]] == breaks[start[:-1]]) & (text[1:] == text[:-1])
        named = langs.fill_null("und").dictionary_encode()
        self.langs, self.lang = named.dictionary, named.indices.to_numpy()[text]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Where pairs of one piece begin, and their hashes (with their language)."""
        at = np.flatnonzero(self.next)
        size = np.frombuffer(self.names.buffers()[1], np.int64)[: len(self.names) + 1]
        data = np.frombuffer(self.names.buffers()[2] or b"", np.uint8)
        own = Texts(data, np.array([0, len(data)]))
        word = Texts.ranges(own.prefix(data, 12), size[:-1], size[1:]) if len(self.names) else np.zeros(0, U)
        lang = mix(np.array([zlib.crc32(x.encode()) for x in self.langs.to_pylist()], U) + U(7))
        return at, mix(word[self.codes[at]] * U(0x9E3779B97F4A7C15) + word[self.codes[at + 1]] + lang[self.lang[at]])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch, t in bounded(batches, most=SLICE):
        yield Words(t, batch.column("lang"))


def frequent_pairs(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(pair): hashes of the pairs of neighbouring words with ``min_count`` occurrences or more in a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _slices(batches):
            key, n = np.unique(w.pairs()[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["pair", "n"])

    pairs = bounded_batches(docs.select("text", "lang"), run, "pair long, n long")
    return pairs.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select("pair")


def bitmap(pairs: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """A bit for each of the hashes: 16 to 32 bits a hash, 2**most_bits at most, as bytes."""
    pairs = cut(pairs)
    bits = min(max((16 * pairs.count()).bit_length(), 16), most_bits)
    place = F.shiftrightunsigned("pair", 64 - bits)
    words = pairs.select(place.alias("p")).groupBy(F.shiftrightunsigned("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("set"))
    held = words.toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[held.column("word").to_numpy()] = held.column("set").to_numpy()
    return out


def windows(docs: DataFrame, known: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(lang, w1, ..., w5, n): how often each padded window opens in a slice of the texts."""
    sent = docs.sparkSession.sparkContext.broadcast(known)
    names = [f"w{k}" for k in range(1, longest + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        bits = U(64 - 6 - (len(held).bit_length() - 1))
        for w in _slices(batches):
            at, key = w.pairs()
            place = (key >> bits).astype(np.int64)
            good = np.zeros(len(w.codes) + longest, bool)
            good[at[(held[place >> 6] >> (place & 63)) & 1 == 1]] = True
            codes = np.concatenate([w.codes, np.full(longest, -1, w.codes.dtype)])
            leads, open_ = [w.codes], np.ones(len(w.codes), bool)
            for k in range(1, longest):
                open_ = open_ & good[k - 1 : len(w.codes) + k - 1]
                leads.append(np.where(open_, codes[k : len(w.codes) + k], -1))
            table = pa.table([pa.array(w.lang), *map(pa.array, leads)], names=["lang", *names]).group_by(["lang", *names]).aggregate([([], "count_all")])
            columns = [w.langs.take(table.column("lang").combine_chunks())]
            for c in names:
                index = table.column(c).combine_chunks()
                columns.append(w.names.take(pc.if_else(pc.less(index, 0), pa.scalar(None, index.type), index)).cast(pa.string()))
            full = pa.RecordBatch.from_arrays([*(c.cast(pa.string()) for c in columns), table.column("count_all").combine_chunks()], ["lang", *names, "n"])
            for i in range(0, full.num_rows, 1 << 16):
                yield full.slice(i, 1 << 16)

    return bounded_batches(docs.select("text", "lang"), run, ", ".join(f"{c} string" for c in ["lang", *names]) + ", n long")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, most_bits: int = MOST_BITS) -> DataFrame:
    """(lang, k, phrase, f): all phrases of up to ``longest`` words with ``f >= min_count`` occurrences; k = 0, an empty
    phrase, has the number of all words of the language."""
    names = [f"w{k}" for k in range(1, longest + 1)]
    known = bitmap(frequent_pairs(docs, min_count), most_bits)
    counted = windows(docs, known, longest).groupBy("lang", *names).agg(F.sum("n").alias("n"))
    summed = counted.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    k = F.lit(longest) - F.bit_count("level")
    last = F.get(F.array(F.lit(""), *names), F.col("k"))
    kept = summed.withColumn("k", k).where((F.col("k") >= 0) & last.isNotNull() & ((F.col("k") == 0) | (F.col("f") >= min_count)))
    return kept.select("lang", "k", F.concat_ws(" ", *names).alias("phrase"), "f")


def _part(first: Column, count: Column | int) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


def score(a: Column, n: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000 * a * n / (l * r)), exact: products of decimals of 38 digits, divided as integers."""
    whole = [x.cast("decimal(19,0)") for x in (a, n, l, r)]
    return F.call_function("div", whole[0] * whole[1] * F.lit(1000).cast("decimal(4,0)"), whole[2] * whole[3])


def collocations(docs: DataFrame, top: int = 2000, min_count: int = MIN_COUNT, longest: int = LONGEST, most_bits: int = MOST_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language by score, a (both descending), phrase.

    The cut of a phrase with the lowest score counts, ties to the shortest first part. A phrase within a longer candidate
    that occurs as often is dropped.
    """
    counts = cut(phrase_counts(docs, min_count, longest, most_bits))
    words = counts.where("k >= 2").withColumn("words", F.split("phrase", " "))
    cuts = words.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("at"))
    cuts = cuts.select("lang", "phrase", "a", "at", _part(F.lit(1), F.col("at")).alias("first"), _part(F.col("at") + 1, F.lit(longest)).alias("rest"))
    for part, f in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.where("k >= 1").select("lang", F.col("phrase").alias(part), F.col("f").alias(f)), ["lang", part])
    totals = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    few = totals.limit(MOST_LANGS + 1).count() <= MOST_LANGS
    cuts = cuts.join(F.broadcast(totals) if few else totals, "lang")
    scored = cuts.withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "at", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.score", "b.a", "b.l", "b.r", "b.n")
    inner = words.where("k >= 3").select("lang", "words", "k", "f", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "words", "size", "f", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    longer = inner.select("lang", _part(F.col("at"), F.col("size")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a")))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    some = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
