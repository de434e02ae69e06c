"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document's set is its distinct word shingles, as 64-bit hashes. Sets of equal hash are one class,
so copies take part once. In a global order of shingles (frequent ones last), two sets whose overlap
is large enough share l shingles within their prefixes of length size - need + l, for every l. Each
class lengthens its prefix by the cost its prefix shingles promise (their counts among frequent
ones), and must then share as many more before a pair is verified.

Links are found in two steps, as only components are asked for. Stars: each class is verified against
the class that leads most of its prefix shingles. Then all pairs that share enough prefix shingles
and are still in different components are verified, so no link between components is lost, and a
large group of near copies costs one pair a member instead of all pairs.

Sets are compared by 64-bit hashes of their shingles: two shingles count as equal if those agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geogrid.llm.components import components
from geogrid.llm.session import bounded_batches, cut, merged
from geogrid.llm.text_arrays import Texts, U, bounded, mix, shingles

#: Links: 100 * intersection >= PERCENT * union.
PERCENT, WORDS = 75, 5
#: Frequent shingles known to all tasks (a bound on what is broadcast), and the counts from which a prefix grows.
FREQUENT, COST, MOST_MATCHES = 1 << 16, 64, 8
#: Size of the bitmap of classes whose sets are compared.
SKETCH_BITS = 22
#: Bytes of text whose sets are made at once. A worker holds several arrays of 8 bytes for each, and keeps what it once had.
SLICE = 1 << 19


class Sets:
    """The shingle sets of some texts: sorted hashes, end to end."""

    def __init__(self, t: Texts, k: int = WORDS):
        b = t.lower()
        t.words()
        words = Texts.ranges(t.prefix(b, 11), t.start, t.end)
        n_words = np.diff(t.word_offs)
        windows = shingles(words, k)
        at = np.flatnonzero(t.word_text[: len(windows)] == t.word_text[k - 1 :]) if len(windows) else np.zeros(0, np.int64)
        text, value = [t.word_text[at]], [windows[at]]
        for n in range(1, k):  # fewer words: the whole sequence as one
            own = np.flatnonzero(n_words == n)
            if len(own):
                text.append(own)
                value.append(shingles(words, n, 1000 + n)[t.word_offs[own]])
        text, value = np.concatenate(text), np.concatenate(value)
        order = np.lexsort((value, text))
        text, value = text[order], value[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
        self.text, self.value = text[new], value[new]
        self.offs = np.searchsorted(self.text, np.arange(t.n + 1))
        self.size = np.diff(self.offs)
        sums = np.concatenate([[U(0)], np.cumsum(mix(self.value ^ U(0x5851F42D4C957F2D)))])
        self.key = mix(sums[self.offs[1:]] - sums[self.offs[:-1]] + self.size.astype(U)).view(np.int64)

    def firsts(self) -> np.ndarray:
        """One text for each distinct non-empty set."""
        _, at = np.unique(self.key, return_index=True)
        return np.sort(at[self.size[at] > 0])


def sets_and_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One pass over the texts: rows (id, n_shingles, key), the size and hash of each document's set (key is null for
    empty sets), and rows (shingle, n), how many sets of a batch hold a shingle, where over 3 do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            seen, values = set(), []
            for batch, t in bounded([whole], most=SLICE):
                s = Sets(t)
                none = pa.nulls(t.n, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(s.size.astype(np.int64)), pa.array(s.key, mask=s.size == 0), none, none], names)
                new = [i for i in s.firsts() if s.key[i] not in seen]
                seen.update(s.key[new].tolist())
                values += [s.value[s.offs[i] : s.offs[i + 1]].copy() for i in new]
            shingle, n = np.unique(np.concatenate(values or [np.zeros(0, U)]), return_counts=True)
            own = [pa.array(shingle[n > 3].view(np.int64)), pa.array(n[n > 3])]
            none = pa.nulls(len(own[0]), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(own[0]), whole.column("id").type), none, none, *own], names)

    names = ["id", "n_shingles", "key", "shingle", "n"]
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return bounded_batches(rows, run, f"id {kind}, n_shingles long, key long, shingle long, n long")


def frequent_shingles(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most counted shingles, sorted, and their counts: a lower bound, as batches where few sets hold a shingle
    don't count it. It orders shingles; any order gives right results."""
    top = counts.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    shingle, n = (top.column(c).to_numpy() for c in ("shingle", "n"))
    order = np.argsort(shingle.astype(np.int64).view(U))
    return shingle.astype(np.int64).view(U)[order], n[order].astype(np.int64)


def prefix_index(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(shingle, key, packed): the prefixes of all classes, size, place and matches in one number; equal rows may
    repeat."""
    frequent = texts.sparkSession.sparkContext.broadcast(frequent_shingles(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = frequent.value
        for _, t in bounded(batches, most=SLICE):
            s = Sets(t)
            keep = np.zeros(t.n, bool)
            keep[s.firsts()] = True
            rows = np.flatnonzero(keep[s.text])
            text, value = s.text[rows], s.value[rows]
            if not len(rows):
                continue
            count = np.zeros(len(value), np.int64)
            if len(known):
                spot = np.minimum(np.searchsorted(known, value), len(known) - 1)
                count = np.where(known[spot] == value, counts[spot], 0)
            # By text and count; the values, which are hashes, are in order already.
            order = np.argsort(text << 32 | np.minimum(count, (1 << 32) - 1), kind="stable")
            text, value, count = text[order], value[order], count[order]
            start = np.searchsorted(text, np.arange(t.n + 1))
            at = np.arange(len(text)) - start[text]
            size = np.diff(start)
            base = size - -(-PERCENT * size // 100) + 1
            cost = np.bincount(text[at < base[text]], count[at < base[text]], t.n)
            matches = np.clip(1 + np.ceil(np.log2(np.maximum(cost, 1) / COST)), 1, MOST_MATCHES).astype(np.int64)
            matches = np.minimum(matches, np.maximum(size - base + 1, 1))
            inside = at < (base + matches - 1)[text]
            text, value, at = text[inside], value[inside], at[inside]
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(s.key[text]), pa.array(size[text] << 32 | at << 4 | matches[text])], ["shingle", "key", "packed"])

    return texts.mapInArrow(run, "shingle long, key long, packed long")


def unpacked(index: DataFrame) -> DataFrame:
    p = F.col("packed")
    return index.select("shingle", "key", F.shiftright(p, 32).cast("int").alias("size"), (F.shiftright(p, 4) % (1 << 28)).cast("int").alias("at"), (p % 16).cast("int").alias("matches"))


def shared_postings(index: DataFrame) -> DataFrame:
    """The index rows whose shingle has two classes or more; each (shingle, key) once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, and whether its shingle was seen before it
        before = None

        def select(table: pa.Table, last: bool) -> tuple[pa.Table, pa.Table | None, int | None]:
            sh, key = (table.column(c).to_numpy() for c in ("shingle", "key"))
            fresh = np.ones(len(sh), bool)
            fresh[1:] = (sh[1:] != sh[:-1]) | (key[1:] != key[:-1])
            table, sh = table.filter(pa.array(fresh)), sh[fresh]
            same = sh[1:] == sh[:-1]
            keep = np.zeros(len(sh), bool)
            keep[1:] |= same
            keep[:-1] |= same
            if before is not None:
                keep[0] |= sh[0] == before
            if last:
                return table.filter(pa.array(keep)), None, None
            rest = table.slice(len(sh) - 1)
            past = int(sh[-1]) if keep[-1] else None
            return table.slice(0, len(sh) - 1).filter(pa.array(keep[:-1])), rest, past

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            out, held, before = select(table, False)
            yield from out.to_batches()
        if held is not None:
            yield from select(held, True)[0].to_batches()

    return index.repartition("shingle").sortWithinPartitions("shingle", "key").mapInArrow(run, index.schema)


def _bucket(key: np.ndarray) -> np.ndarray:
    return (mix(key.view(U)) >> U(64 - SKETCH_BITS)).astype(np.int64)


def class_sets(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(key, members) of the classes in ``pairs`` (a, b): sorted shingle hashes.

    A bitmap of 2**SKETCH_BITS buckets of the classes, of fixed size, keeps most other sets from being
    shuffled; the join decides.
    """

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SKETCH_BITS, bool)
        for batch in batches:
            seen[_bucket(batch.column("key").to_numpy())] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen).astype(np.int32))], ["bucket"])

    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    held = wanted.mapInArrow(buckets, "bucket int").distinct().toArrow().column("bucket").to_numpy()
    sketch = np.zeros(1 << SKETCH_BITS, bool)
    sketch[held] = True
    sent = texts.sparkSession.sparkContext.broadcast(np.packbits(sketch))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(sent.value).astype(bool)
        for _, t in bounded(batches, most=SLICE):
            s = Sets(t)
            rows = s.firsts()
            rows = rows[known[_bucket(s.key[rows])]]
            members = s.value.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(s.key[rows]), pa.array([members[8 * s.offs[i] : 8 * s.offs[i + 1]] for i in rows], pa.binary())], ["key", "members"])

    sets = merged(texts.mapInArrow(run, "key long, members binary"), wanted, "key", "left_semi")
    return sets.dropDuplicates(["key"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)):
                both = len(np.intersect1d(np.frombuffer(x, U), np.frombuffer(y, U), assume_unique=True))
                good[i] = 100 * both >= PERCENT * (len(x) // 8 + len(y) // 8 - both)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))], ["a", "b"])

    one = merged(pairs.select("a", "b"), sets.select(F.col("key").alias("a"), F.col("members").alias("x")), "a")
    both = merged(one, sets.select(F.col("key").alias("b"), F.col("members").alias("y")), "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a long, b long")


def _alike(size_a: Column, size_b: Column) -> Column:
    return (F.least(size_a, size_b) * 100) >= (F.greatest(size_a, size_b) * PERCENT)


def _plausible(x: str, y: str) -> Column:
    """Whether a shared shingle at these places of two sets leaves room for a link."""
    size_x, size_y, at_x, at_y = (F.col(f"{c}_{s}") for c in ("size", "at") for s in (x, y))
    ahead = F.least(at_x, at_y) + F.least(size_x - at_x, size_y - at_y)
    return _alike(size_x, size_y) & (ahead * (100 + PERCENT) >= (size_x + size_y) * PERCENT)


def _enough(n: Column) -> Column:
    """Whether n shared prefix shingles can lead to a link: those after the shorter of two prefixes, in the
    global order, add at most the longer of the two rests. Never fewer than both sets' matches."""
    rest = lambda s: F.ceil(F.col(f"size_{s}") * (PERCENT / 100)) - F.col(f"matches_{s}")
    needed = F.ceil((F.col("size_x") + F.col("size_y")) * PERCENT / (100 + PERCENT))
    return (n >= needed - F.greatest(rest("x"), rest("y"))) & (n >= F.least("matches_x", "matches_y"))


def _named(postings: DataFrame, suffix: str) -> DataFrame:
    return postings.select("shingle", *[F.col(c).alias(f"{c}_{suffix}") for c in postings.columns if c != "shingle"])


def _counted(pairs: DataFrame) -> DataFrame:
    """(a, b, n) of pairs of postings (x and y) that may link, by the shingles they share."""
    same = [F.first(f"{c}_{s}").alias(f"{c}_{s}") for c in ("size", "matches") for s in "xy"]
    counts = pairs.where(_plausible("x", "y")).groupBy(F.col("key_x").alias("a"), F.col("key_y").alias("b")).agg(F.count("*").alias("n"), *same)
    return counts.where(_enough(F.col("n"))).select("a", "b", "n")


def open_components(postings: DataFrame) -> DataFrame:
    """(a, b): pairs of components whose members may link. All shingles that stand in prefixes of both bound what
    any two members share, so a large component is met once, not once for each member. a is the smaller one."""
    names = ("root", "lo", "hi", "at", "rest", "matches", "rows")
    held = postings.groupBy("shingle", "root").agg(F.min("size").alias("lo"), F.max("size").alias("hi"), F.max("at").alias("at"), F.max(F.col("size") - F.col("at")).alias("rest"), F.min("matches").alias("matches"), F.count("*").alias("rows"))
    a, b = (held.select("shingle", *[F.col(c).alias(f"{c}_{s}") for c in names]) for s in "ab")
    # As for two sets at these places, with the most that any member allows.
    room = (F.least("at_a", "at_b") + F.least("rest_a", "rest_b")) * (100 + PERCENT) >= (F.col("lo_a") + F.col("lo_b")) * PERCENT
    alike = (F.col("hi_a") * 100 >= F.col("lo_b") * PERCENT) & (F.col("hi_b") * 100 >= F.col("lo_a") * PERCENT)
    met = merged(a, b, (a["shingle"] == b["shingle"]) & (F.col("root_a") < F.col("root_b")) & room & alike).groupBy("root_a", "root_b")
    met = met.agg(F.count("*").alias("n"), F.min(F.least("lo_a", "lo_b")).alias("lo"), F.max(F.greatest("hi_a", "hi_b")).alias("hi"), F.min(F.least("matches_a", "matches_b")).alias("matches"), (F.sum("rows_a") <= F.sum("rows_b")).alias("first"))
    # (size_x + size_y) * 3/7 - 3/4 of the larger, at its least: the smallest size with the largest that is alike.
    large = F.least(F.col("hi"), F.col("lo") * 100 / PERCENT)
    least = (F.col("lo") + large) * PERCENT / (100 + PERCENT) - large * (PERCENT / 100) + F.col("matches") - 1
    return met.where(F.col("n") >= F.greatest(least, F.col("matches"))).select(F.when(F.col("first"), F.col("root_a")).otherwise(F.col("root_b")).alias("a"), F.when(F.col("first"), F.col("root_b")).otherwise(F.col("root_a")).alias("b"))


def cross_candidates(left: DataFrame, apart: DataFrame) -> DataFrame:
    """(a, b), a < b: classes of the component pairs ``apart`` that may link.

    Of the n prefix shingles that class x shares with any member of component b, a member must share l or more,
    so it has one of any n - l + 1 of them: the ones that stand in the fewest members of b are looked up, and
    pairs met there are counted in full. A large group of near copies is thus not paired with all that is like it.
    """
    held = left.groupBy("shingle", F.col("root").alias("other")).agg(F.count("*").alias("rows"))
    bounds = cut(left.groupBy(F.col("root").alias("other")).agg(F.min("size").alias("lo"), F.max("size").alias("hi"), F.min("matches").alias("least")))
    asked_of = cut(merged(apart.select(F.col("a").alias("root_x"), F.col("b").alias("other")), bounds, "other"))
    ahead = merged(merged(_named(left, "x"), asked_of, "root_x"), held, ["shingle", "other"])
    size = F.col("size_x")
    lo, hi = F.greatest(F.col("lo"), size * (PERCENT / 100)), F.least(F.col("hi"), size * (100 / PERCENT))
    # What ``_enough`` asks of a pair, at its least for a size of b from lo to hi.
    asked = lambda s: (size + s) * (PERCENT / (100 + PERCENT)) - F.greatest(size, s) * (PERCENT / 100) + F.least("matches_x", "least") - 1
    needed = F.greatest(F.ceil(F.least(asked(lo), asked(hi)) - 1e-6), F.least("matches_x", "least"))
    own = Window.partitionBy("key_x", "other")
    placed = ahead.where(lo <= hi).withColumn("n", F.count("*").over(own)).withColumn("rank", F.row_number().over(own.orderBy("rows", "shingle")))
    looked = placed.where(F.col("rank") <= F.col("n") - needed + 1).select("shingle", "other", *[f"{c}_x" for c in ("key", "size", "at", "matches")])
    behind = _named(left, "y").withColumn("other", F.col("root_y"))
    met = cut(merged(looked, behind, ["shingle", "other"]).where(_plausible("x", "y")).select("key_x", "key_y").distinct())
    lists = cut(left.groupBy("key").agg(F.first("size").alias("size"), F.first("matches").alias("matches"), F.collect_list("shingle").alias("held")))
    one, two = (lists.select(*[F.col(c).alias(f"{c}_{s}") for c in lists.columns]) for s in "xy")
    full = merged(merged(met, one, "key_x"), two, "key_y").where(_enough(F.size(F.array_intersect("held_x", "held_y"))))
    return full.select(F.least("key_x", "key_y").alias("a"), F.greatest("key_x", "key_y").alias("b")).distinct()


def class_links(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(node, root): the components of classes that have a link to another class."""
    postings = cut(unpacked(shared_postings(prefix_index(texts, counts))))
    # A shingle's lead is the class that shares most of its prefix: the original of edited copies shares all of it.
    shared = postings.groupBy("key").agg((F.count("*") / F.first("size")).alias("share"))
    lead = merged(postings, shared, "key").groupBy("shingle").agg(F.max(F.struct("share", "key", "size", "at", "matches")).alias("lead"))
    lead = lead.select("shingle", *[F.col(f"lead.{c}").alias(f"{c}_x") for c in ("key", "size", "at", "matches")])
    # The best lead of each class; that one lead's count may fall short only puts a pair off to the second step.
    star = _counted(merged(_named(postings, "y"), lead, "shingle").where("key_x <> key_y"))
    star = cut(star.groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a")))
    links = cut(verified(star, class_sets(texts, star)))
    roots = components(links)
    # What is left: shingles that stand in several components.
    placed = merged(postings, roots.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    open_ = placed.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("shingle")
    left = cut(merged(placed, open_, "shingle", "left_semi"))
    apart = cut(open_components(left))
    pairs = cross_candidates(left, apart)
    known = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = cut(merged(pairs, known, ["a", "b"], "left_anti"))
    if rest.isEmpty():
        return roots
    return components(links.unionByName(verified(rest, class_sets(texts, rest))))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` for each row.

    Null and empty texts, and rows with a null id, are linked with nothing: their component is their
    own id. Copies share a component; repeated rows give repeated rows. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    both = cut(sets_and_counts(docs, "id"))
    own = both.where("shingle is null").select("id", "n_shingles", "key")
    texts = docs.where("id is not null").select("id", "text")
    roots = class_links(texts, both.where("shingle is not null").select("shingle", "n"))
    placed = merged(own, roots.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    # Apart from its aggregation, so that Spark can split the rows of a large component.
    least = cut(placed.where("root is not null and id is not null").groupBy("root").agg(F.min("id").alias("component_id")))
    out = merged(placed, least, "root", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that lead their component (the smallest id).

    Rows that share an id are one document: of repeated rows one stays, of differing ones always the same, the
    first by a hash of all columns. Documents without words and rows with a null id stay.
    """
    found = jaccard_components(docs, id_col, text_col)
    leads = found.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("lead")).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("own"), F.struct(*columns).alias("whole"), F.xxhash64(*columns).alias("h"))
    led = merged(rows, leads, F.col("own") == F.col("lead"), "left_semi").groupBy("own").agg(F.min_by("whole", "h").alias("whole"))
    return led.select(*[F.col("whole").getField(c).alias(c) for c in docs.columns]).unionByName(docs.where(F.col(id_col).isNull()))
