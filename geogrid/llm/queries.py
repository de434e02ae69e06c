"""Registered queries of the training-data operators; SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geogrid.llm import bpe, collocations, divergence, fingerprints, licenses, media, mixing, ngram_join, oracles, pii, quality_fm, repeats, toxicity, turn_repair


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _held_out(modulus: int, rest: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % modulus == rest


def op1_mjpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.to_avi(_docs(spark, sf_dir)).withColumn("media_bytes", F.length("media").cast("long"))
    read = media.read_avi(stored, carry=("n_bytes", "media_bytes"))
    clips = F.transform("clips", lambda c: F.concat(c["first_frame"], F.lit("-"), c["last_frame"], F.lit("@"), c["start_s"], F.lit(":"), c["mean_level"]))
    feature = F.concat(F.lit("frames="), F.col("n_frames"), F.lit(";clips="), F.array_join(clips, "|"))
    return read.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        "payload_sha256",
        "tail_crc32",
        "media_bytes",
        "media_sha256",
        feature.alias("feature"),
        F.size("clips").alias("n_clips"),
    )


def op2_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode_decode(_docs(spark, sf_dir), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return divergence.divergence_rules(docs, divergence.language_references(docs))


def op4_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    found = licenses.scan(docs, licenses.document_frequencies(docs))
    return found.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        "base_labels",
        "labels",
        "score",
    )


def op5_interval_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("removed")
    size = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return repeats.remove_repeats(_docs(spark, sf_dir)).select("doc_id", "n_bytes", size.alias("n_removed"), F.size(spans).cast("long").alias("n_spans"), "kept_sha256")


def op6_golden_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op7_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    model = quality_fm.quality_model(docs, quality_fm.training_rows(_labels(spark, sf_dir), 3, 1))
    return quality_fm.score_quality(docs, model).select("doc_id", _held_out(3, 1).alias("held_out"), "score", "predicted")


def op8_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    found = pii.redactions(docs, pii.train(docs))
    base = F.filter("spans", lambda s: s["kind"] < len(pii.BASE))
    counts = [pii.count_kind(F.col("spans"), k).alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.span_text(base).cast("binary"), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op9_adaptive_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_docs(spark, sf_dir))


def op10_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    model = toxicity.toxicity_model(docs, quality_fm.training_rows(_labels(spark, sf_dir), 5, 0))
    return toxicity.score_toxicity(docs, model).select("doc_id", _held_out(5, 0).alias("held_out"), "score", "predicted")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turn_repair.report(turn_repair.damage(conversations))


def op12_top_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_docs(spark, sf_dir))


def op13_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprints(_docs(spark, sf_dir))
    prints = [fingerprints.text_of(F.col(c)).alias(n) for c, n in (("sketch", "fingerprint"), ("edited_sketch", "edited_fingerprint"))]
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), *prints, "near_edited", "near_next")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mjpeg": op1_mjpeg,
    "op2_chunked_bpe": op2_chunked_bpe,
    "op3_divergence": op3_divergence,
    "op4_license_index": op4_license_index,
    "op5_interval_tree": op5_interval_tree,
    "op6_golden_mix": op6_golden_mix,
    "op7_quality_fm": op7_quality_fm,
    "op8_boosted_pii": op8_boosted_pii,
    "op9_adaptive_jaccard": op9_adaptive_jaccard,
    "op10_toxicity_fm": op10_toxicity_fm,
    "op11_turn_repair": op11_turn_repair,
    "op12_top_marginals": op12_top_marginals,
    "op13_scaled_sketch": op13_scaled_sketch,
}
ORACLES: dict[str, str] = {"op11_turn_repair": oracles.TURN_REPAIR, "op12_top_marginals": oracles.COLLOCATIONS, "op13_scaled_sketch": oracles.SCALED_SKETCH}
