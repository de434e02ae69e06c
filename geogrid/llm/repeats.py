"""Exact repeats by an enhanced suffix array over content-defined anchors.

A string of LENGTH bytes that stands twice has the same anchor in both places: its least hashed GRAM
bytes (leftmost of equal ones). The windows that share an anchor form a segment.

1. Each task lists its segments. Of equal segments in a slice of the input only the first travels;
   the others are repeats already.
2. Segments meet by anchor. All but the first of equal segments are repeats. Anchors whose segments
   differ go on, one occurrence for each different segment.
3. The occurrences' contexts are cut from the texts and sorted by anchor and right context: an
   enhanced (sparse) suffix array. A stack scan of its common prefixes walks the interval tree; in
   each interval, sorting by left context and a second scan tell where left extensions differ. That
   gives the maximal repeats with all their occurrences, of which all but the first are repeats.
   ``maximal_repeat_groups`` returns those groups as rows.

An anchor in more than HOT different segments would gather too much in one task. Its windows of LENGTH
bytes travel one by one, by their own hash, and meet in a stream: the leaves of its interval tree, one
level deep, which tell the same repeats.

No text is compared with another one by one, and equal segments, however many, are met in streams.
Strings are equal here if 128 bits of two hashes agree (anchor and segment, or two of a window); strings
in one interval are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geogrid.llm.session import bound_batches, bounded_batches, cut
from geogrid.llm.text_arrays import U, Texts, bounded, mix

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM  # a window holds SPAN + 1 grams
#: Different segments of one anchor that a task gathers at most.
HOT = 256


def segments(t: Texts) -> tuple[np.ndarray, ...]:
    """(text, anchor position, first and last window start, anchor hash, segment hash) of each segment."""
    n = len(t.b)
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, U), np.zeros(0, U))
    if n < LENGTH:
        return none
    prefix = t.prefix(t.b, 21)
    at = np.arange(n - GRAM + 1)
    gram = Texts.ranges(prefix, at, at + GRAM)
    # Hash above, position below: the least value is the leftmost least gram.
    least = (gram & U(0xFFFFFFFF00000000)) | at.astype(U)
    width = 1
    while width * 2 <= SPAN + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPAN + 1 - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    start = np.arange(len(least))
    text = np.searchsorted(t.offs, start, "right") - 1
    inside = start + LENGTH <= t.offs[text + 1]
    start, text, anchor = start[inside], text[inside], (least[inside] & U(0xFFFFFFFF)).astype(np.int64)
    if not len(start):
        return none
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    lo, hi, anchor, text = start[first], start[last], anchor[first], text[first]
    whole = mix(Texts.ranges(t.prefix(t.b, 22), lo, hi + LENGTH) + (anchor - lo).astype(U))
    return text, anchor, lo, hi, gram[anchor], whole


def _union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans sorted by start, overlapping and touching ones joined."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(start)) - 1]


#: Rows between the steps, narrow as there are many. A segment: its anchor's and its own hash, and in
#: ``place`` the anchor's offset with the distances back to its first and last window. A repeat: an odd
#: ``place``, which holds its start; its end is in ``whole``.
_ROW = "anchor long, whole long, doc long, place long"


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == U else c.astype(np.int64)) for c in columns], ["anchor", "whole", "doc", "place"])


def _pack(at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return (at << 14 | (at - lo) << 7 | (at - hi)) << 1


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = place >> 15
    return at, at - (place >> 8 & 127), at - (place >> 1 & 127)


def _repeat_rows(anchor: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    return _rows(anchor, hi, doc, lo << 1 | 1)


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1."""
    for batch, t in bounded(batches, most=2 << 20):
        text, anchor, lo, hi, key, whole = segments(t)
        if not len(text):
            continue
        docs = batch.column("doc").to_numpy().astype(np.int64)
        base = t.offs[text]
        at, lo, hi, doc = anchor - base, lo - base, hi - base, docs[text]
        order = np.lexsort((at, doc, whole, key))
        again = np.zeros(len(order), bool)
        k, w = key[order], whole[order]
        again[1:] = (k[1:] == k[:-1]) & (w[1:] == w[:-1])
        one = order[~again]
        yield _rows(key[one], whole[one], doc[one], _pack(at[one], lo[one], hi[one]))
        two = order[again]
        if len(two):  # repeats within this slice, joined into runs
            limit = np.int64(1) << 40
            number = np.unique(doc[two], return_inverse=True)
            shift = number[1] * limit
            a, z = _union(lo[two] + shift, hi[two] + LENGTH + shift)
            own = number[0][a // limit]
            yield _repeat_rows(mix(own.astype(U) + a.astype(U)), own, a % limit, z % limit)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2, over rows sorted by anchor, segment, document and place.

    Kept from slice to slice are the last anchor's different segments, up to HOT. In what goes on, ``whole`` is 1
    where the anchor has more than HOT of them.
    """
    kept: pa.Table | None = None  # different segments of the last anchor, unless it is hot already
    past: tuple[int, int] | None = None  # anchor and segment of the last row
    hot = False

    def sent(table: pa.Table, is_hot: np.ndarray) -> list[pa.RecordBatch]:
        return table.set_column(1, "whole", pa.array(is_hot.astype(np.int64))).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        span = batch.column("place").to_numpy() & 1 == 1
        if span.any():
            yield batch.filter(pa.array(span))
        table = pa.Table.from_batches([batch.filter(pa.array(~span))])
        if not table.num_rows:
            continue
        a, w, doc = (table.column(c).to_numpy() for c in ("anchor", "whole", "doc"))
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1])
        goes_on = past is not None and a[0] == past[0]
        if goes_on:
            new[0] = w[0] != past[1]
        past = (int(a[-1]), int(w[-1]))
        two = ~new  # repeats of a whole segment
        if two.any():
            _, lo, hi = _unpack(table.column("place").to_numpy()[two])
            yield _repeat_rows(a[two], doc[two], lo, hi + LENGTH)
        table = table.filter(pa.array(new))
        if kept is not None:
            table = pa.concat_tables([kept, table])
        own = table.column("anchor").to_numpy()
        if not len(own):
            continue
        first = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
        counts = np.diff(np.append(first, len(own)))
        is_hot = counts > HOT
        if goes_on and hot:
            is_hot[0] |= own[0] == a[0]
        last_open = own[-1] == a[-1]
        out = np.repeat((counts > 1) | is_hot, counts)
        if last_open and not is_hot[-1]:
            out[first[-1] :] = False
            kept = table.slice(int(first[-1])).combine_chunks()
        else:
            kept = None
        hot = bool(last_open and is_hot[-1]) or bool(not last_open and goes_on and hot and a[0] == a[-1])
        yield from sent(table.filter(pa.array(out)), np.repeat(is_hot, counts)[out])
    if kept is not None and kept.num_rows > 1:
        yield from sent(kept, np.zeros(kept.num_rows, bool))


def _common(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    lo, hi = 0, n
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if x[:mid] == y[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan of neighbours' common prefixes: (length, first, last) of each interval of the tree
    with length at least ``least`` and two members or more."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            length, first = stack.pop()
            yield length, first, i
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def maximal_repeats(left: list[bytes], right: list[bytes], least: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of ``least`` bytes or more among contexts around a common point.

    ``left`` holds what precedes the point, reversed. Yields (bytes to the left, bytes to the right,
    all members): members of an interval of the right-sorted array, split by left extension; where the
    next bytes to the left are all equal, the string is not maximal and the longer one is given.
    """
    order = sorted(range(len(right)), key=right.__getitem__)
    lcp = [_common(right[i], right[j]) for i, j in zip(order, order[1:], strict=False)]
    longest = max(map(len, left))
    for r, first, last in intervals(lcp, max(GRAM, least - longest)):
        members = sorted(order[first : last + 1], key=left.__getitem__)
        back = [_common(left[i], left[j]) for i, j in zip(members, members[1:], strict=False)]
        for k, lo, hi in intervals(back, max(0, least - r)):
            yield k, r, members[lo : hi + 1]


def _group_repeats(doc: np.ndarray, at: np.ndarray, lo: np.ndarray, context: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(doc, start, end) of what repeats at each occurrence of one anchor: all maximal repeats of which it is
    not the first occurrence. They all hold the anchor, so they make one span."""
    cutat = (at - lo).tolist()
    left = [c[:k][::-1] for c, k in zip(context, cutat, strict=True)]
    right = [c[k:] for c, k in zip(context, cutat, strict=True)]
    place = list(zip(doc.tolist(), at.tolist(), strict=True))
    reach: dict[int, tuple[int, int]] = {}
    for k, r, members in maximal_repeats(left, right):
        first = place[min(members, key=place.__getitem__)]
        for m in members:
            if place[m] != first:
                back, ahead = reach.get(m, (0, 0))
                reach[m] = (max(back, k), max(ahead, r))
    for m, (back, ahead) in reach.items():
        yield place[m][0], place[m][1] - back, place[m][1] + ahead


def _by_anchor(batches: Iterator[pa.RecordBatch], column: str = "anchor") -> Iterator[pa.Table]:
    """Tables of whole anchors, from batches sorted by anchor."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        a = table.column(column).to_numpy()
        border = int(np.flatnonzero(a != a[-1])[-1]) + 1 if (a != a[-1]).any() else 0
        held = table.slice(border)
        if border:
            yield table.slice(0, border).combine_chunks()
    if held is not None:
        yield held.combine_chunks()


def _edges(a: np.ndarray) -> list[tuple[int, int]]:
    edge = [0, *(np.flatnonzero(a[1:] != a[:-1]) + 1).tolist(), len(a)]
    return list(zip(edge, edge[1:], strict=False))


def _scan_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3, over contexts and windows sorted by anchor, ``lo``, document and place: the repeats (doc, lo, hi)."""
    names = ["doc", "lo", "hi"]
    windows: list[pa.RecordBatch] = []

    def contexts() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            single = batch.column("context").is_null().to_numpy(zero_copy_only=False)
            if single.any():
                windows.append(batch.filter(pa.array(single)))
            yield batch.filter(pa.array(~single))

    past: tuple[int, int] | None = None

    def met() -> Iterator[pa.RecordBatch]:
        nonlocal past
        while windows:
            a, other, doc, at = (windows[0].column(c).to_numpy() for c in ("anchor", "lo", "doc", "at"))
            windows.pop(0)
            same = np.zeros(len(a), bool)
            same[1:] = (a[1:] == a[:-1]) & (other[1:] == other[:-1])
            same[0] = past == (int(a[0]), int(other[0]))
            past = (int(a[-1]), int(other[-1]))
            if same.any():
                yield pa.RecordBatch.from_arrays([pa.array(doc[same]), pa.array(at[same]), pa.array(at[same] + LENGTH)], names)

    for table in _by_anchor(contexts()):
        yield from met()
        a, doc, at, lo = (table.column(c).to_numpy() for c in ("anchor", "doc", "at", "lo"))
        context = table.column("context").to_pylist()
        out = [s for i, j in _edges(a) for s in _group_repeats(doc[i:j], at[i:j], lo[i:j], context[i:j])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)
    yield from met()


#: A context, or (context null) a window: its hashes in ``anchor`` and ``lo``, its start in ``at``.
_CONTEXT = "anchor long, doc long, at long, lo long, context binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of the texts' ``edges``; of hot anchors the windows."""
    for batch, t in bounded(batches):
        data, out, spots = t.b.tobytes(), [[], [], [], [], []], []
        docs = batch.column("doc").to_pylist()
        for i, own in enumerate(batch.column("edges").to_pylist()):
            base = int(t.offs[i])
            for e in own:
                if e["hot"]:
                    spots.append((docs[i], base, e["lo"], e["hi"]))
                    continue
                for column, v in zip(out, (e["anchor"], docs[i], e["at"], e["lo"], data[base + e["lo"] : base + e["hi"] + LENGTH]), strict=True):
                    column.append(v)
        yield _context_rows(*out)
        if spots:
            yield from _windows(t, np.array(spots, np.int64))


def _context_rows(anchor, doc, at, lo, context) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (anchor, doc, at, lo)), pa.array(context, pa.binary())], ["anchor", "doc", "at", "lo", "context"])


def _windows(t: Texts, spots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The windows of ``spots`` (document, text offset, first and last start)."""
    doc, base, lo, hi = spots.T
    n = hi - lo + 1
    start = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
    doc, at = np.repeat(doc, n), start + np.repeat(base, n)
    one, two = (Texts.ranges(t.prefix(t.b, seed), at, at + LENGTH).view(np.int64) for seed in (23, 24))
    yield _context_rows(one, doc, start, two, pa.nulls(len(at), pa.binary()))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, spans): for each document with repeats, the byte spans (lo, hi) of strings of LENGTH bytes
    that start earlier too: in a smaller id, or earlier in the same text. Spans may overlap.

    Ids are integers and name one text each; rows with a null id take no part, repeated rows count once.
    """
    bound_batches(docs.sparkSession)
    named = _named(docs, id_col, text_col).distinct()
    return _spans_of(named.repartition("doc"), named)


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))


def _numbered(named: DataFrame) -> DataFrame:
    """Rows (doc, text) with ``number``: one for each different text of an id, in ascending order of ids. Texts of one id
    follow each other by hash. Only ids and hashes are sorted."""
    hashed = named.withColumn("h", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    ids = hashed.select("doc", "h").distinct().repartitionByRange("doc", "h").sortWithinPartitions("doc", "h")
    return hashed.join(cut(ids.withColumn("number", F.monotonically_increasing_id())), ["doc", "h"]).drop("h")


def _spans_of(keyed: DataFrame, texts: DataFrame) -> DataFrame:
    """``keyed`` holds ``texts`` dealt by document; contexts and results are both cut from it, so the plan
    shuffles the texts once."""
    found = texts.mapInArrow(_segment_rows, _ROW)
    met = found.repartition("anchor").sortWithinPartitions("anchor", "whole", "doc", "place").mapInArrow(_meet, _ROW)
    at, place = F.shiftright("place", 15), F.col("place")
    repeat = place.bitwiseAND(1) == 1
    met = cut(
        met.select(
            "doc",
            F.when(~repeat, F.col("anchor")).alias("anchor"),
            (F.col("whole") == 1).alias("hot"),
            F.when(~repeat, at).alias("at"),
            F.when(repeat, F.shiftright(place, 1)).otherwise(at - F.shiftright(place, 8).bitwiseAND(127)).alias("lo"),
            F.when(repeat, F.col("whole")).otherwise(at - F.shiftright(place, 1).bitwiseAND(127)).alias("hi"),
        )
    )
    edges = met.where("anchor is not null").groupBy("doc").agg(F.collect_list(F.struct("anchor", "at", "lo", "hi", "hot")).alias("edges"))
    around = keyed.join(edges, "doc").mapInArrow(_contexts, _CONTEXT)
    partial = around.repartition("anchor").sortWithinPartitions("anchor", "lo", "doc", "at").mapInArrow(_scan_arrays, "doc long, lo long, hi long")
    spans = partial.unionByName(met.where("anchor is null").select("doc", "lo", "hi"))
    return spans.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _all_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, t in bounded(batches):
        text, anchor, lo, hi, key, whole = segments(t)
        doc, base = batch.column("doc").to_numpy().astype(np.int64)[text], t.offs[text]
        yield _rows(key, whole, doc, _pack(anchor - base, lo - base, hi - base))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, k, r, doc, at): members of the maximal repeats around each anchor, k bytes before its place and r from it."""
    for table in _by_anchor(batches):
        a, doc, at, lo = (table.column(c).to_numpy() for c in ("anchor", "doc", "at", "lo"))
        context, out = table.column("context").to_pylist(), []
        for i, j in _edges(a):
            cut_at = (at[i:j] - lo[i:j]).tolist()
            left, right = ([f(c, k) for c, k in zip(context[i:j], cut_at, strict=True)] for f in (lambda c, k: c[:k][::-1], lambda c, k: c[k:]))
            for number, (k, r, members) in enumerate(maximal_repeats(left, right)):
                group = int(mix(np.array([a[i]]).view(U) + U(number) * U(0x9E3779B97F4A7C15)).view(np.int64)[0])
                out += [(group, k, r, int(doc[i + m]), int(at[i + m])) for m in members]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["group", "k", "r", "doc", "at"])


def maximal_repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(group, length, doc, start, end): the maximal repeats of LENGTH bytes or more around each anchor, one row an
    occurrence, all occurrences listed (equal segments too).

    A repeat is maximal within the bytes that its anchor's windows cover; a longer one comes as several
    overlapping groups. Anchors in more than HOT different segments give groups of LENGTH bytes. Null, empty and
    shorter texts, and rows with a null id, are in no group. Ids are integers and name one text each.
    """
    named = _named(docs, id_col, text_col)
    at, place = F.shiftright("place", 15), F.col("place")
    every = bounded_batches(named, _all_segments, _ROW)
    every = cut(every.select("anchor", "whole", "doc", at.alias("at"), (at - F.shiftright(place, 8).bitwiseAND(127)).alias("lo"), (at - F.shiftright(place, 1).bitwiseAND(127)).alias("hi")))
    kinds = every.groupBy("anchor", "whole").agg(F.min(F.struct("doc", "at", "lo", "hi")).alias("f"), F.count("*").alias("n"))
    kinds = cut(kinds.select("anchor", "whole", "n", "f.*"))
    sizes = cut(kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("n").alias("times")).where("times > 1"))
    cold = kinds.join(sizes.where(f"kinds between 2 and {HOT}"), "anchor").select("doc", F.struct("anchor", "at", "lo", "hi", F.lit(False).alias("hot")).alias("e"))
    hot = every.join(sizes.where(f"kinds > {HOT}"), "anchor").select("doc", F.struct("anchor", "at", "lo", "hi", F.lit(True).alias("hot")).alias("e"))
    edges = cold.unionByName(hot).groupBy("doc").agg(F.collect_list("e").alias("edges"))
    around = cut(named.dropDuplicates(["doc"]).join(edges, "doc").mapInArrow(_contexts, _CONTEXT))
    tree = around.where("context is not null").repartition("anchor").sortWithinPartitions("anchor", "doc", "at").mapInArrow(_groups, "group long, k long, r long, doc long, at long")
    # Segments that stand often are groups too, unless the tree has them with others.
    own = kinds.where("n > 1").join(sizes.where(f"kinds <= {HOT}"), "anchor", "left_semi")
    own = own.select(F.xxhash64("anchor", "whole").alias("group"), (F.col("at") - F.col("lo")).alias("k"), (F.col("hi") + LENGTH - F.col("at")).alias("r"), "doc", "at")
    tree = cut(tree)
    found = tree.unionByName(own.join(tree, ["doc", "at", "k", "r"], "left_anti").select(*tree.columns))
    named_by = kinds.select("anchor", "whole", "doc", "at")
    members = found.join(named_by, ["doc", "at"]).select("group", "k", "r", "anchor", "whole")
    spread = members.join(every.select("anchor", "whole", "doc", "at"), ["anchor", "whole"])
    out = spread.select("group", (F.col("k") + F.col("r")).alias("length"), "doc", (F.col("at") - F.col("k")).alias("start"), (F.col("at") + F.col("r")).alias("end"))
    windows = around.where("context is null").select("anchor", "lo", "doc", F.col("at").alias("start"))
    twice = windows.groupBy("anchor", "lo").agg(F.count("*").alias("n")).where("n > 1")
    single = windows.join(twice, ["anchor", "lo"]).select(F.xxhash64("anchor", "lo").alias("group"), F.lit(LENGTH).cast("long").alias("length"), "doc", "start", (F.col("start") + LENGTH).alias("end"))
    return out.unionByName(single)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``removed`` (array of start, end in bytes, apart and sorted) and ``kept`` (the
    remaining bytes) for each row, ``kept_sha256`` of them.

    Null and empty texts have no bytes; texts below LENGTH bytes stay whole; rows with a null id too.
    Repeated rows (same id and text) count as one text, and each of them loses the same bytes. Different texts of one
    id are documents that follow each other, in an order by hash.
    Other columns are not read. The remaining bytes may cut a character in two, so ``kept`` is binary.
    """
    bound_batches(docs.sparkSession)
    named = _named(docs, id_col, text_col)
    if named.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        rows, own = named.repartition("doc"), "doc"
        spans = _spans_of(rows, named)
    else:
        numbered = _numbered(named).select(F.col("number").alias("doc"), "text", F.col("doc").alias("own"))
        texts = numbered.select("doc", "text").dropDuplicates(["doc"])
        rows, spans, own = numbered, _spans_of(texts.repartition("doc"), texts), "own"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, kept, sha = [], [], [], []
            lists = batch.column("spans")
            for i, text in enumerate(batch.column("text").to_pylist()):
                b = (text or "").encode()
                own = lists[i].values
                if own is None or not len(own):
                    lo = hi = np.zeros(0, np.int64)
                else:
                    lo, hi = _union(own.field("lo").to_numpy(), np.array(own.field("hi")))
                at = [0, *np.stack([lo, hi], axis=1).ravel().tolist(), len(b)]
                rest = b"".join(b[at[k] : at[k + 1]] for k in range(0, len(at), 2))
                size.append(len(b))
                removed.append([{"start": x, "end": y} for x, y in zip(lo.tolist(), hi.tolist(), strict=True)])
                kept.append(rest)
                sha.append(hashlib.sha256(rest).hexdigest())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary()), pa.array(sha, pa.string())], ["id", "n_bytes", "removed", "kept", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = rows.join(spans, "doc", "left").select(F.col(own).cast(kind).alias("id"), "text", "spans")
    unnamed = docs.where(F.col(id_col).isNull()).select(F.lit(None).cast(kind).alias("id"), F.col(text_col).alias("text"), F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    schema = f"id {kind}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary, kept_sha256 string"
    return rows.mapInArrow(run, schema).unionByName(unnamed.mapInArrow(run, schema)).withColumnRenamed("id", id_col)
