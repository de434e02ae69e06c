"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Statistics are shares of character kinds, word length, repeated lines and windows, and size; the
metadata is ``n_chars`` (null is a value of its own). Language, source and id are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geogrid.llm import fm

SPEC = fm.Spec(prefixes=(), statistics=True, n_terms=1024, rank=6, per_class=3000)


def quality_model(docs: DataFrame, labels: DataFrame, spec: fm.Spec = SPEC, id_col: str = "doc_id", text_col: str = "text") -> fm.Model:
    """Fits on at most ``2 * spec.per_class`` rows of ``labels.quality``; without labels it answers 1/2."""
    return fm.fit(docs, labels, "quality", spec, id_col, text_col)


def score_quality(docs: DataFrame, model: fm.Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` (0 to 1) and ``predicted`` for each row, repeated rows included.

    Null and empty texts get the score of a text without words.
    """
    return fm.score(docs, model, id_col, text_col)


def training_rows(labels: DataFrame, modulus: int, held_out: int, id_col: str = "doc_id") -> DataFrame:
    return labels.where(F.crc32(F.col(id_col).cast("string")) % modulus != held_out)
