"""Toxicity: a factorisation machine over hashed terms.

Terms are words in lower case and word beginnings, so inflected insults share weights; the pairwise
part learns what an additive model misses, as an insult next to a mention of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geogrid.llm import fm

SPEC = fm.Spec(prefixes=(4, 5, 6), statistics=False, n_terms=2048, rank=6, per_class=4000)


def toxicity_model(docs: DataFrame, labels: DataFrame, spec: fm.Spec = SPEC, id_col: str = "doc_id", text_col: str = "text") -> fm.Model:
    """Fits on at most ``2 * spec.per_class`` rows of ``labels.toxic``; without labels it answers 1/2."""
    return fm.fit(docs, labels, "toxic", spec, id_col, text_col)


def score_toxicity(docs: DataFrame, model: fm.Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, ``score`` (0 to 1) and ``predicted`` for each row, repeated rows included.

    Null and empty texts have no terms and get the score of the bias alone.
    """
    return fm.score(docs, model, id_col, text_col, carry=carry)


def drop_toxic(docs: DataFrame, model: fm.Model, limit: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``limit``."""
    scored = score_toxicity(docs, model, id_col, text_col, carry=tuple(docs.columns))
    name = "score" if "score" not in docs.columns else "score_model"
    return scored.where(F.col(name) < limit).select(*(F.col(f"`{c}`") for c in docs.columns))
