"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, in hash order, form one stream of words, cut into blocks of equal size.
Slot t of the schedule takes the golden-ratio point frac(t / phi); the cumulative shares of the
sources tell whose slot it is, so every stretch of slots holds each source in its share. The r-th
slot of a source takes its r-th block, and starts over when the stream ends (never past twice).
"""

from __future__ import annotations

from decimal import Decimal, getcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geogrid.llm.session import cut

BLOCK_WORDS = 512
WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2.0
#: Documents in one hash bucket, buckets in one range, slots in one chunk, and cells of the equi-join from points to sources.
BUCKET_ROWS, RANGE_BUCKETS, CHUNK_SLOTS, CELLS = 256, 1024, 1 << 11, 1024
getcontext().prec = 50
_GOLDEN = (Decimal(5).sqrt() - 1) / 2
_STEP, _LEAP = float(_GOLDEN), float(_GOLDEN * (1 << 20) % 1)


def count_words(text: Column) -> Column:
    """Runs of other than ASCII white space; null has none. No array of words is built."""
    one = F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(one), F.lit(0)).cast("long")


def _frac(c: Column) -> Column:
    return c - F.floor(c)


def golden_point(t: Column) -> Column:
    """frac(t / phi), with t in two parts, so that the products stay exact enough."""
    return _frac(_frac(F.shiftright(t, 20) * F.lit(_LEAP)) + _frac(t.bitwiseAND((1 << 20) - 1) * F.lit(_STEP)))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(sid, source, length, target, take) for each source, null last; one row a source.

    Targets split ``share`` of all words by weight; none passes ``most`` times its source, and what
    is over goes to the others by weight: target = min(most * length, level * weight) for one level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("length"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", F.row_number().over(order) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))).withColumn("cap", F.col("length") * F.lit(most))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.sum("length").over(everything) * F.lit(share) - before) / rest)
    free = F.col("level") * F.col("weight") <= F.col("cap")
    per = per.withColumn("level", F.min_by(F.when(free, F.col("level")), F.when(free, F.struct(F.col("cap") / F.col("weight"), F.col("sid")))).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return per.select("sid", "source", "length", target.alias("target"), F.round(target).cast("long").alias("take"))


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, sid, epoch, block, words): which block each slot takes, and how much of it.

    As many slots are drawn as all sources have blocks. By the points' discrepancy (below 3 + 2 ln n) a
    source is few blocks short or over then: what is over is left out, what is short follows after the
    last slot, one block of each such source in turn.
    """
    spark = targets.sparkSession
    # A stream starts over with a block of its own, so its last block may be a short one each time.
    blocks = F.floor(F.col("take") / F.col("length")) * F.ceil(F.col("length") / F.lit(block_words)) + F.ceil((F.col("take") % F.col("length")) / F.lit(block_words))
    need = targets.where("take > 0").withColumn("need", blocks.cast("long"))
    n = need.agg(F.sum("need").alias("n")).first()["n"] or 0
    running = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    shares = need.withColumn("hi", F.sum("need").over(running) / F.lit(float(max(n, 1)))).withColumn("lo", F.col("hi") - F.col("need") / F.lit(float(max(n, 1))))
    shares = shares.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("sid")), F.lit(0.0)))
    cells = F.sequence(F.floor(F.col("lo") * CELLS), F.floor(F.col("hi") * CELLS))
    by_cell = shares.select("*", F.explode(cells).alias("cell"))
    points = spark.range(n).withColumnRenamed("id", "slot").withColumn("point", golden_point(F.col("slot"))).withColumn("cell", F.floor(F.col("point") * CELLS))
    held = points.join(by_cell, "cell").where("point >= lo and point < hi").select("slot", "sid", "length", "take", "need", F.floor(F.col("slot") / CHUNK_SLOTS).alias("chunk"))
    counts = held.groupBy("sid", "chunk").agg(F.count("*").alias("here"))
    counts = counts.withColumn("before", F.sum("here").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("here"))
    ranked = held.withColumn("rank", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1)
    ranked = ranked.join(counts.select("sid", "chunk", "before"), ["sid", "chunk"]).withColumn("rank", F.col("rank") + F.col("before"))
    drawn = counts.groupBy("sid").agg(F.sum("here").alias("drawn"))
    short = need.join(drawn, "sid", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0))).where("drawn < need")
    late = short.select("sid", "length", "take", "need", "drawn", F.explode(F.sequence("drawn", F.col("need") - 1)).alias("rank"))
    late = late.withColumn("turn", F.col("rank") - F.col("drawn"))
    late = late.withColumn("slot", F.lit(n) + F.row_number().over(Window.orderBy("turn", "sid")) - 1)
    same = ["slot", "sid", "length", "take", "rank"]
    ranked = ranked.select(*same).unionByName(late.select(*same))
    per_epoch = F.ceil(F.col("length") / F.lit(block_words)).cast("long")
    ranked = ranked.withColumn("epoch", F.floor(F.col("rank") / per_epoch)).withColumn("block", F.col("rank") % per_epoch)
    start = F.col("epoch") * F.col("length") + F.col("block") * block_words
    words = F.least(F.lit(block_words), F.col("length") - F.col("block") * block_words, F.col("take") - start)
    return ranked.select("slot", "sid", "epoch", "block", words.cast("long").alias("words")).where("words > 0")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_words: int = BLOCK_WORDS, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``id_col``, ``size``, ``source``, ``source_size``, ``target``, ``taken`` and ``first_slot`` for each row.

    ``size`` counts words, ``taken`` the words the mix takes of the row (repeats counted). Rows
    without words have taken 0 and no first slot; null sources are a source, the last; repeated rows
    count each. The order of a stream depends on ids and sizes alone, so reruns agree.
    """
    hashed = F.xxhash64(F.col(id_col), F.lit(17))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), count_words(F.col(text_col)).alias("size"), hashed.alias("h"))
    rows = cut(rows)
    targets = cut(source_targets(rows, weights, share, most))
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    spread = F.least(F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * buckets), F.lit(buckets - 1))
    rows = rows.withColumn("bucket", spread)
    keyed = rows.join(targets.select("sid", F.col("source").alias("s"), "length", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # Words before each bucket, from those of whole ranges of buckets and those within the range.
    sums = keyed.groupBy("sid", "bucket").agg(F.sum("size").alias("words")).withColumn("range", F.floor(F.col("bucket") / RANGE_BUCKETS))
    ranges = sums.groupBy("sid", "range").agg(F.sum("words").alias("all"))
    ranges = ranges.select("sid", "range", (F.sum("all").over(Window.partitionBy("sid").orderBy("range")) - F.col("all")).alias("first"))
    sums = sums.withColumn("base", F.sum("words").over(Window.partitionBy("sid", "range").orderBy("bucket")) - F.col("words"))
    sums = sums.join(ranges, ["sid", "range"]).select("sid", "bucket", (F.col("base") + F.col("first")).alias("base"))
    within = Window.partitionBy("sid", "bucket").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed.withColumn("upto", F.sum("size").over(within)).join(sums.select("sid", "bucket", "base"), ["sid", "bucket"])
    placed = cut(placed.withColumn("start", F.col("base") + F.col("upto") - F.col("size")).select("id", "source", "sid", "size", "length", "target", "start"))
    worded = placed.where("size > 0")
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    pieces = worded.select("sid", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    lo = F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0))
    hi = F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.lit(block_words))
    used = pieces.join(schedule(targets, block_words), ["sid", "block"]).withColumn("part", F.least(hi, F.col("words")) - lo).where("part > 0")
    taken = used.groupBy("sid", "start").agg(F.sum("part").alias("taken"), F.min("slot").alias("first_slot"))
    full = worded.join(taken, ["sid", "start"], "left").unionByName(placed.where("size = 0").select("*", F.lit(None).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot")))
    return full.select(F.col("id").alias(id_col), "size", "source", F.col("length").alias("source_size"), "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents as the mix takes them: each row ``round(taken / size)`` times, 0 to 2.

    Rows without words stay once. Rows that share id, source and size are taken alike.
    """
    mixed = mix_sources(docs, id_col, text_col, source_col)
    times = mixed.groupBy(F.col(id_col).alias("id"), F.col("source").alias("from"), F.col("size").alias("n")).agg(
        F.when(F.col("n") > 0, F.round(F.avg("taken") / F.first("size"))).otherwise(1).cast("int").alias("times")
    )
    # The rows travel as one column, so no name of theirs can clash.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = docs.select(whole, F.col(id_col).alias("own"), F.col(source_col).cast("string").alias("source"), count_words(F.col(text_col)).alias("size"))
    joined = rows.join(times, F.col("own").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("from")) & (F.col("size") == F.col("n")))
    copies = joined.where("times > 0").select("whole", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return copies.select(*[F.col("whole").getField(c).alias(c) for c in docs.columns])
