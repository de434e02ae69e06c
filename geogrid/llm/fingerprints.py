"""Document fingerprints: sketches of word shingles by a fixed threshold, mergeable, with containment estimates.

A fingerprint holds every shingle hash below a fixed fraction of all values, so its size follows the document's and
two fingerprints of very unequal documents can be compared: among the values both cover, the share of the
smaller one's hashes that the other has estimates how much of the smaller text stands in the larger. A document
with fewer than ``least`` such hashes keeps its ``least`` smallest ones, all of them if there are no more, so that
short texts have fingerprints too. Both parts survive merging: the fingerprint of several texts' shingles comes
from their fingerprints alone.

Hashes are the first 16 hexadecimal digits of MD5, as text, in ascending order. Shingles are five words
(``[^\\x20\\x09-\\x0D]+``, lower-cased), all words of a text with fewer. Null texts and texts without words have an empty
fingerprint. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of a shingle, the fraction of hashes that is kept, and how many are kept at least.
WORDS, FRACTION, LEAST = 5, 1 / 8, 32
HEX = 16
#: Above all hashes.
ALL = "g"
#: Blocks of neighbouring documents for each shuffle partition, and at most.
BLOCKS, MOST_BLOCKS = 8, 1 << 14


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _limit(fraction: float) -> str:
    """Hashes below this text are the kept fraction."""
    return ALL if fraction >= 1 else f"{int(fraction * 2**32):08x}"


def _trimmed(hashes: Column, fraction: float, least: int) -> Column:
    """Of ascending hashes those below the limit, and the first ones in any case."""
    return F.filter(hashes, lambda h, i: (h < _limit(fraction)) | (i < least))


def sketch(text: Column, words: int = WORDS, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """A text's fingerprint as an ascending array of hashes."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    split = F.array_remove(F.split(lowered, r"[\x20\x09-\x0D]+"), "")

    def hashed(shingle: Column) -> Column:
        return F.substring(F.md5(shingle.cast("binary")), 1, HEX)

    def made(w: Column) -> Column:
        n = F.size(w)
        whole = F.array(hashed(F.array_join(w, " ")))
        many = F.transform(F.sequence(F.lit(1), F.greatest(n - (words - 1), F.lit(1))), lambda i: hashed(F.array_join(F.slice(w, i, words), " ")))
        return F.when(n == 0, F.array().cast("array<string>")).when(n <= words, whole).otherwise(many)

    def kept(hashes: Column) -> Column:
        below = F.array_distinct(F.filter(hashes, lambda h: h < _limit(fraction)))
        return _let(below, lambda b: F.when(F.size(b) >= least, F.sort_array(b)).otherwise(F.slice(F.sort_array(F.array_distinct(hashes)), 1, least)))

    return _let(_let(split, made), kept)


def merged(sketches: Column, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """The fingerprint of all texts of an array of fingerprints."""
    return _trimmed(F.sort_array(F.array_distinct(F.flatten(sketches))), fraction, least)


def _covered(a: Column, fraction: float, least: int) -> Column:
    """Up to here a fingerprint has every hash of its text."""
    return F.when(F.size(a) < least, F.lit(ALL)).otherwise(F.greatest(F.lit(_limit(fraction)), F.element_at(a, -1)))


def containment(a: Column, b: Column, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """The estimated share of the smaller text's shingles that the other text has, 0 to 1.

    Equal fingerprints, empty ones too, give 1, an empty one against another 0; so does a short text whose few
    hashes are all above what the other covers.
    """

    def shared(upto: Column) -> Column:
        x, y = (F.filter(s, lambda h: h <= upto) for s in (a, b))
        both, smaller = F.size(F.array_intersect(x, y)), F.least(F.size(x), F.size(y))
        return F.when(smaller > 0, both / smaller).otherwise(0.0)

    return F.when(a == b, 1.0).otherwise(_let(F.least(_covered(a, fraction, least), _covered(b, fraction, least)), shared))


def text_of(sketched: Column) -> Column:
    """A fingerprint as text."""
    return F.array_join(sketched, "")


def of_text(text: Column) -> Column:
    """A fingerprint from its text."""
    return F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(HEX)), lambda i: F.substr(text, i, F.lit(HEX))), lambda h: h != "")


def _doubles(values: list[float]) -> Column:
    """A constant array, as one literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>") if values else F.array().cast("array<double>")


def with_next(rows: DataFrame, order: str, columns: list[str], ties: list[str], blocks: int | None = None) -> DataFrame:
    """``rows`` with ``next_<column>`` of the next row by ``order``, then ``ties`` (nulls first); the last row's next is the first.

    Quantiles of ``order`` bound blocks of about equally many rows. The first row of each block also goes to the block before
    (of the first block: to the last), behind its rows, so one shuffle by block is enough. Rows with one value of ``order``
    share a block.
    """
    key = F.coalesce(F.col(order).cast("double"), F.lit(float("-inf")))
    blocks = blocks or min(BLOCKS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_BLOCKS)
    shares = _doubles([i / blocks for i in range(1, blocks)])
    found = rows.select(key.alias("k")).agg(F.min("k").alias("least"), F.percentile_approx("k", shares, max(10000, 20 * blocks)).alias("bounds")).first()
    bounds = sorted({x for x in found["bounds"] or [] if x > found["least"]}) if blocks > 1 else []
    step = max(1, int(len(bounds) ** 0.5))
    starts = _doubles([found["least"] or 0.0, *bounds])
    upto = lambda array, k: F.size(F.filter(array, lambda x: x <= k))
    coarse = upto(_doubles(bounds[::step]), F.col("_k"))
    block = F.when(coarse == 0, 0).otherwise(_let(coarse, lambda c: (c - 1) * step + upto(F.slice(_doubles(bounds), (c - 1) * step + 1, step), F.col("_k"))))
    before = F.when(F.col("_b") == 0, len(bounds)).otherwise(F.col("_b") - 1)
    place = lambda b, ghost: F.struct(b.alias("block"), F.lit(ghost).alias("ghost"))
    places = F.when(F.col("_k") == F.get(starts, F.col("_b")), F.array(place(F.col("_b"), False), place(before, True))).otherwise(F.array(place(F.col("_b"), False)))
    dealt = rows.withColumn("_k", key).withColumn("_b", block).withColumn("_at", F.explode(places))
    in_order = Window.partitionBy("_at.block").orderBy("_at.ghost", *[F.asc_nulls_first(c) for c in (order, *ties)])
    led = dealt.select("*", *[F.lead(c).over(in_order).alias(f"next_{c}") for c in columns])
    return led.where(~F.col("_at.ghost")).drop("_k", "_b", "_at")


def edited(text: Column, n_chars: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many (or all) of the following one."""
    half = F.floor(n_chars / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n_chars - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, fraction: float = FRACTION, least: int = LEAST, blocks: int | None = None) -> DataFrame:
    """(doc_id, n_chars, text, edited, sketch, edited_sketch, near_edited, near_next) of every document.

    The next document is by ascending ``doc_id`` (nulls first; rows of one id by text), after the last the first; a single
    document is its own next one. Repeated rows stay; an empty table gives an empty result; extra columns are ignored.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("print", text_of(sketch(F.col("text"), WORDS, fraction, least)))
    rows = with_next(own, "doc_id", ["text", "print"], ["text"], blocks)
    rows = rows.withColumn("n_chars", F.length("text"))
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("n_chars"), F.col("next_text")))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), WORDS, fraction, least))
    rows = rows.withColumn("sketch", of_text(F.col("print"))).withColumn("next_sketch", of_text(F.col("next_print")))
    near = {n: containment(F.col("sketch"), F.col(other), fraction, least) for n, other in (("near_edited", "edited_sketch"), ("near_next", "next_sketch"))}
    return rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "text", "edited", "sketch", "edited_sketch", *[c.alias(n) for n, c in near.items()])
