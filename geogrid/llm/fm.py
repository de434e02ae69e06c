"""Factorisation machines over hashed terms and structure statistics.

A text's features are the distinct hashed terms it holds (value 1, or for the quality model its
share) and a few statistics. The model is

    w0 + sum w_i x_i + 1/2 sum_f [ (sum v_if x_i)^2 - sum v_if^2 x_i^2 ]

whose second part is the sum over all pairs of <v_i, v_j> x_i x_j in linear time. It is fitted by
AdaGrad on a bounded sample of labelled rows; scoring runs over all rows, in batches.

Features are terms whose presence differs between the classes, and common terms of which a pair does
though each alone does not. A fifth of the sample, by a hash of the row, is kept apart: its loss tells
how many passes to make and how sure a term must be; then all of it is fitted so. Rows that are not in the given labels play no part in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from geogrid.llm.session import bounded_batches, cut
from geogrid.llm.text_arrays import Texts, U, bounded, mix, repeated_lines, repeated_words

BUCKETS = 1 << 18
#: Standard errors by which a term's shares in the two classes must differ: the first, and each later one as long as it
#: brings the loss of the checked fifth below BETTER of what it was.
CHOICES, BETTER = (4.0, 3.0, 2.0), 0.95
#: Common terms whose pairs are looked at, and the standard errors by which a pair must differ.
PAIR_TERMS, PAIR_Z = 512, 6.0
#: Every fit makes this many passes at least, and stops when the checked rows have not improved for PATIENCE passes.
LEAST_PASSES, PATIENCE = 20, 6
CHECKED = 5


@dataclass(frozen=True)
class Spec:
    """What a model reads. prefixes: byte lengths of word beginnings that are terms too."""

    prefixes: tuple[int, ...] = ()
    statistics: bool = False
    #: Terms kept, by association with the label in the sample; rank of the interactions.
    n_terms: int = 2048
    rank: int = 6
    #: Most passes over the sample.
    epochs: int = 120
    #: Sampled labelled rows of each class.
    per_class: int = 4000


STATISTICS = ("upper", "digit", "space", "wide", "symbol", "stop", "bang", "bar", "word_length", "log_words", "dup_lines", "repeats", "log_chars", "no_chars")


def terms(t: Texts, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each term: words in lower case without edge punctuation, and beginnings."""
    b = t.lower()
    alnum = ((b >= 97) & (b <= 122)) | ((b >= 48) & (b <= 57)) | (b >= 128)
    start, end = t.start.copy(), t.end.copy()
    for _ in range(2):
        end -= (~alnum[end - 1]) & (end - start > 1)
        start += (~alnum[np.minimum(start, len(b) - 1)]) & (end - start > 1)
    prefix = t.prefix(b, 7)
    text, bucket = [t.word_text], [Texts.ranges(prefix, start, end)]
    for k in spec.prefixes:
        at = np.flatnonzero(end - start > k)
        text.append(t.word_text[at])
        bucket.append(Texts.ranges(prefix, start[at], start[at] + k) ^ U(k))
    return np.concatenate(text), (np.concatenate(bucket) & U(BUCKETS - 1)).astype(np.int64)


def statistics(t: Texts, n_chars: np.ndarray) -> np.ndarray:
    """Structure of each text and its metadata (``n_chars``, NaN where null), scaled to about 0..1."""
    size = np.maximum(np.diff(t.offs), 1)
    n_words = np.diff(t.word_offs)
    one = lambda mask: t.total(mask) / size
    b = t.b
    lines, dup = repeated_lines(t, t.prefix(b, 1))
    repeats = repeated_words(t, Texts.ranges(t.prefix(b, 1), t.start, t.end))
    symbol = np.zeros(256, bool)
    symbol[list(b"#*$%&<>")] = True
    columns = [one((b >= 65) & (b <= 90)) * 2, one((b >= 48) & (b <= 57)) * 4, one(t.space) * 2, one(b >= 192) * 2, one(symbol[b]) * 4, one(b == 46) * 8, one((b == 33) | (b == 63)) * 4, one(b == 124) * 8]
    columns += [np.minimum((size - t.total(t.space)) / np.maximum(n_words, 1) / 16, 2), np.log1p(n_words) / 10, dup / np.maximum(lines, 1), repeats / np.maximum(n_words, 1)]
    known = ~np.isnan(n_chars)
    columns += [np.log1p(np.maximum(np.where(known, n_chars, 0), 0)) / 12, (~known).astype(float)]
    return np.stack(columns, axis=1)


def distinct(text: np.ndarray, feature: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(text * n_features + feature)
    return key // n_features, key % n_features


@dataclass
class Model:
    spec: Spec
    bucket_feature: np.ndarray  # feature of a bucket, or -1
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def score(self, t: Texts, n_chars: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each text; a text without known terms gets the bias's."""
        text, bucket = terms(t, self.spec)
        feature = self.bucket_feature[bucket]
        text, feature = distinct(text[feature >= 0], feature[feature >= 0], len(self.weight))
        value = np.ones(len(text))
        if self.spec.statistics:
            x = statistics(t, n_chars)
            text = np.concatenate([text, np.repeat(np.arange(t.n), x.shape[1])])
            feature = np.concatenate([feature, np.tile(np.arange(x.shape[1]) + len(self.weight) - x.shape[1], t.n)])
            value = np.concatenate([value * 0.25, x.ravel()])
        return 1 / (1 + np.exp(-np.clip(self.margin(text, feature, value, t.n)[0], -30, 30)))

    def margin(self, text: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        out = self.bias + np.bincount(text, self.weight[feature] * value, n)
        sums = np.zeros((n, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            vx = self.factors[feature, f] * value
            sums[:, f] = np.bincount(text, vx, n)
            out += (sums[:, f] ** 2 - np.bincount(text, vx * vx, n)) / 2
        return out, sums


def _sample(docs: DataFrame, labels: DataFrame, label: str, spec: Spec, id_col: str) -> DataFrame:
    """At most ``per_class`` labelled rows of each class, the first by a hash of their id."""
    rows = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")).dropDuplicates(["id"])
    by_hash = [rows.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(spec.per_class) for k in (0, 1)]
    return docs.join(F.broadcast(by_hash[0].unionByName(by_hash[1])), "id")


def _inputs(docs: DataFrame, id_col: str, text_col: str, chars_col: str | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, text, n_chars (null where it is no number) and the carried columns as c0, c1, …"""
    chars = F.lit(None).cast("double")
    if chars_col and chars_col in docs.columns and isinstance(docs.schema[chars_col].dataType, (NumericType, StringType)):
        chars = F.col(f"`{chars_col}`").try_cast("double")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), chars.alias("n_chars"), *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carry)))


def _chars(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("n_chars").to_numpy(zero_copy_only=False).astype(float)


def _chosen_terms(sample: DataFrame, spec: Spec) -> tuple[dict[int, float], list[int]]:
    """Buckets with their standard errors, by association with the label (at most ``n_terms``), and the most common
    ones (at most ``PAIR_TERMS``). Counting is done by Spark; only these reach the driver."""
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return {}, []
    ones, zeros = float(sizes[1]), float(sizes[0])
    counts = sample.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.sum("label").alias("in1"), F.count("*").alias("n"))
    in1, in0 = F.col("in1"), F.col("n") - F.col("in1")
    odds = F.log((in1 + 0.5) / (ones + 1)) - F.log((in0 + 0.5) / (zeros + 1))
    apart, both = F.abs(in1 / ones - in0 / zeros), F.col("n") / (ones + zeros)
    error = F.sqrt(both * (F.lit(1.0) - both) * (1 / ones + 1 / zeros))
    rated = cut(counts.where("n >= 3").select("bucket", "n", (F.abs(odds) * apart).alias("gain"), F.try_divide(apart, error).alias("z")))
    strong = rated.where((F.col("z") > min(CHOICES)) & (F.col("gain") > 0)).orderBy(F.desc("gain"), "bucket").limit(spec.n_terms)
    common = rated.where(F.col("n") < 0.9 * (ones + zeros)).orderBy(F.desc("n"), "bucket").limit(PAIR_TERMS)
    return {r["bucket"]: r["z"] for r in strong.collect()}, sorted(r["bucket"] for r in common.collect())


def _paired(held: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which terms (columns of ``held``, 0/1) are in a pair whose joint presence tells the classes apart by ``PAIR_Z``
    standard errors and twice as surely as either term alone."""
    def sure(p1: np.ndarray, p0: np.ndarray) -> np.ndarray:
        ones, zeros = y.sum(), len(y) - y.sum()
        both = (p1 * ones + p0 * zeros) / len(y)
        return np.abs(p1 - p0) / np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / ones + 1 / zeros))

    x1, x0 = held[y == 1], held[y == 0]
    alone = sure(x1.mean(axis=0), x0.mean(axis=0))
    pair = sure(x1.T @ x1 / len(x1), x0.T @ x0 / len(x0))
    found = (pair > PAIR_Z) & (pair > 2 * np.maximum(alone[:, None], alone[None, :]))
    np.fill_diagonal(found, False)
    return found.any(axis=1)


def _descend(model: Model, data: tuple[np.ndarray, ...], y: np.ndarray, checked: np.ndarray | None, passes: int = 0) -> tuple[float, int]:
    """Fits ``model`` in place on the rows that are not ``checked``: (least loss on those, the pass that had it); with
    None on all rows, ``passes`` times."""
    text, feature, value = data
    n, (d, rank) = len(y), model.factors.shape
    offs = np.searchsorted(text, np.arange(n + 1))
    rng = np.random.default_rng(11)
    gw, gv, gb = np.full(d, 1e-6), np.full((d, rank), 1e-6), 1e-6
    everything = np.arange(n)
    own = everything if checked is None or checked.all() else np.flatnonzero(~checked)
    judged = own if checked is None or not checked.any() else np.flatnonzero(checked)
    best, at_best, since = np.inf, 0, 0

    def rows_of(part: np.ndarray) -> tuple[np.ndarray, ...]:
        at = np.concatenate([np.arange(offs[r], offs[r + 1]) for r in part]) if len(part) else np.zeros(0, np.int64)
        return np.repeat(np.arange(len(part)), offs[part + 1] - offs[part]), feature[at], value[at]

    apart = rows_of(judged)
    for done in range(passes or model.spec.epochs):
        order = rng.permutation(own)
        for lo in range(0, len(order), 256):
            part = order[lo : lo + 256]
            tx, f, v = rows_of(part)
            margin, sums = model.margin(tx, f, v, len(part))
            err = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[part]) / len(part)
            ev = err[tx] * v
            dw = np.bincount(f, ev, d) + 1e-5 * model.weight
            gw += dw * dw
            model.weight -= 0.15 * dw / np.sqrt(gw)
            for k in range(rank):
                dv = np.bincount(f, ev * (sums[tx, k] - model.factors[f, k] * v), d) + 1e-4 * model.factors[:, k]
                gv[:, k] += dv * dv
                model.factors[:, k] -= 0.03 * dv / np.sqrt(gv[:, k])
            gb += err.sum() ** 2
            model.bias -= 0.1 * err.sum() / np.sqrt(gb)
        margin = np.clip(model.margin(*apart, len(judged))[0], -30, 30)
        loss = float(np.mean(np.log1p(np.exp(np.where(y[judged] == 1, -margin, margin)))))
        if loss < best - 1e-4:
            best, at_best, since = loss, done + 1, 0
        else:
            since += 1
        if not passes and done + 1 >= LEAST_PASSES and since >= PATIENCE:
            break
    return best, at_best


def fit(docs: DataFrame, labels: DataFrame, label: str, spec: Spec, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> Model:
    """A model of ``labels[label]`` from at most 2 * per_class rows.

    Terms are counted by Spark; the driver gets the chosen ones (at most n_terms + PAIR_TERMS) and which rows
    of the sample hold them. Without rows of both classes the model answers the share of label 1 (1/2
    without any row). ``chars_col`` may be missing or of any type: what is no number counts as null.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in bounded(batches, most=1 << 19):
            t.words()
            text, bucket = terms(t, spec)
            text, bucket = distinct(text, bucket, BUCKETS)
            offs = np.searchsorted(text, np.arange(t.n + 1)).astype(np.int32)
            x = statistics(t, _chars(batch)) if spec.statistics else np.zeros((t.n, 0))
            stats = pa.ListArray.from_arrays(pa.array(np.arange(t.n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.ListArray.from_arrays(pa.array(offs), pa.array(bucket.astype(np.int32))), stats], ["id", "label", "buckets", "stats"])

    kind = docs.schema[id_col].dataType.simpleString()
    sample = _sample(_inputs(docs, id_col, text_col, chars_col if spec.statistics else None), labels, label, spec, id_col)
    sample = cut(bounded_batches(sample, features, f"id {kind}, label int, buckets array<int>, stats array<double>"))
    strong, common = _chosen_terms(sample, spec)
    wanted = np.array(sorted({*strong, *common}), np.int64)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            offs, own = lists.offsets.to_numpy(), np.isin(lists.values.to_numpy(), wanted)
            upto = np.concatenate([[0], np.cumsum(own)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.ListArray.from_arrays(pa.array(upto[offs]), pa.array(lists.values.to_numpy()[own])), batch.column("stats")], ["id", "label", "buckets", "stats"])

    got = sample.mapInArrow(reduced, sample.schema).toArrow().sort_by("id")
    y = got.column("label").to_numpy()
    n, n_stats = len(y), len(STATISTICS) if spec.statistics else 0
    if n == 0 or y.min() == y.max():
        share = float(np.mean(y)) if n else 0.5
        bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return Model(spec, np.full(BUCKETS, -1), bias, np.zeros(1 + n_stats), np.zeros((1 + n_stats, spec.rank)))
    lists = got.column("buckets").combine_chunks()
    text, bucket = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy().astype(np.int64)
    stats = np.array(got.column("stats").combine_chunks().flatten()).reshape(n, n_stats)
    checked = mix(np.arange(n, dtype=U) + U(5)) % U(CHECKED) == 0
    held = np.zeros((n, len(common)), np.float32)
    column = np.minimum(np.searchsorted(common, bucket), max(len(common) - 1, 0)) if common else np.zeros(len(bucket), np.int64)
    inside = np.array(common)[column] == bucket if common else np.zeros(len(bucket), bool)
    held[text[inside], column[inside]] = 1
    pairs = [b for b, ok in zip(common, _paired(held, y), strict=True) if ok] if common else []
    def prepared(z: float) -> tuple[Model, tuple[np.ndarray, ...]]:
        return _prepared(spec, sorted({*(b for b, own in strong.items() if own > z), *pairs}), text, bucket, stats, y)

    best, passes, sure = np.inf, 1, CHOICES[0]
    for z in CHOICES:
        loss, at = _descend(*prepared(z), y, checked)
        if loss >= BETTER * best:
            break
        best, passes, sure = loss, at, z
    model, data = prepared(sure)
    _descend(model, data, y, None, max(passes, 1))
    return model


def _prepared(spec: Spec, chosen: list[int], text: np.ndarray, bucket: np.ndarray, stats: np.ndarray, y: np.ndarray) -> tuple[Model, tuple[np.ndarray, ...]]:
    """An untrained model of the chosen buckets, and the rows' (text, feature, value) sorted by text."""
    n, n_stats = stats.shape
    bucket_feature = np.full(BUCKETS, -1)
    bucket_feature[chosen] = np.arange(len(chosen))
    feature = bucket_feature[bucket]
    text, feature = text[feature >= 0], feature[feature >= 0]
    value = np.full(len(text), 0.25 if n_stats else 1.0)
    text = np.concatenate([text, np.repeat(np.arange(n), n_stats)])
    feature = np.concatenate([feature, np.tile(np.arange(n_stats) + len(chosen), n)])
    value = np.concatenate([value, stats.ravel()])
    d = max(len(chosen) + n_stats, 1)
    model = Model(spec, bucket_feature, float(np.log(y.sum() / (n - y.sum()))), np.zeros(d), np.random.default_rng(12).normal(0, 0.02, (d, spec.rank)))
    order = np.argsort(text, kind="stable")
    return model, (text[order], feature[order], value[order])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, ``score`` and ``predicted`` for each row; ``carry`` names input columns to keep."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    more = [f"c{k}" for k in range(len(carry))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, t in bounded(batches, most=1 << 19):
            t.words()
            p = sent.value.score(t, _chars(batch))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), *(batch.column(c) for c in more)], ["id", "score", "predicted", *more])

    rows = _inputs(docs, id_col, text_col, chars_col if model.spec.statistics else None, carry)
    kind = docs.schema[id_col].dataType.simpleString()
    kinds = "".join(f", {n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(more, carry, strict=True))
    out = bounded_batches(rows, run, f"id {kind}, score double, predicted int{kinds}")
    names = [id_col, "score", "predicted"]
    return out.toDF(*(n if n not in carry else f"{n}_model" for n in names), *carry)
