from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer

from geogrid.llm import bpe
from geogrid.llm.queries import op2_chunked_bpe
from geogrid.llm.text_arrays import Texts
from tests.llm.cases import SCHEMA, clashing, prose, rows

PATH = public_tokenizers.path("word_bpe_49k.json")
MORE = ["x <|endoftext|> y", "'" + "re" * 900, "a'", "'s't've 'LL 12½³", "á combining", "ΣΑΣ İ", "a b\u0085c\x1cd", " lead", "trail ", "don'" + "t" * 600, "é" * 3000 + " " + "ü" * 3000]


def test_same_as_the_library(spark):
    texts = [r[1] for r in rows()] + MORE
    df = clashing(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    tokenizer = Tokenizer.from_file(PATH)
    for r in bpe.decode(bpe.encode(df, PATH), PATH).collect():
        want = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == want, texts[r["doc_id"]]
        assert r["decoded"] == tokenizer.decode(want, skip_special_tokens=False)


def test_any_cut_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(bpe, "LEAST", 1)
    encoder, rng = bpe.Encoder(PATH), random.Random(5)
    for text in [prose(rng, 80), "it's we've they'll!' 're'd", "nospace" * 40, "a  b\n\nc\t" * 9, "!?'s" * 30, "x <|endoftext|> y’s 😀 é" * 6, "\u3000a\u00a0b c\u0301 d" * 5]:
        data = text.encode()
        want = encoder.library(text)
        for _ in range(30):
            cuts = [c for c in sorted(rng.sample(range(1, len(data)), min(6, len(data) - 1))) if data[c] & 0xC0 != 0x80]
            assert encoder.encode(data, np.array(cuts, np.int64)) == want


def _cut(text):
    b = np.frombuffer(text.encode(), np.uint8)
    return bpe.chunk_cuts(Texts(b, np.array([0, len(b)])))[0]


def test_shared_chunks_are_encoded_once():
    encoder, rng = bpe.Encoder(PATH), random.Random(6)
    shared = prose(rng, 900)
    for head in ("one two", "three four five", "“quoted” — and 日本 語"):
        text = f"{head} {shared}"
        assert encoder.encode(text.encode(), _cut(text)) == encoder.library(text)
    assert encoder.reused >= 4 and encoder.widened == 0


def test_joins_are_widened_until_the_ids_agree():
    """With chunks whose ids are wrong near a join, the comparison fails and the whole text is encoded."""
    encoder, text = bpe.Encoder(PATH), prose(random.Random(8), 400)
    right = encoder.part

    def wrong(data: bytes) -> bytes:  # a lone word, as a join's neighbours are, comes out as in no context
        return b"\1\0\0\0" if data and b" " not in data.strip() else right(data)

    encoder.part = wrong
    assert encoder.encode(text.encode(), _cut(text)) == encoder.library(text) and encoder.widened > 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_tokenizers_go_to_the_library_whole(spark, name):
    path = public_tokenizers.path(name)
    texts = [r[1] for r in rows(20)] + MORE
    tokenizer = Tokenizer.from_file(path)
    assert not bpe.Layout(path).chunked and bpe.Layout(PATH).chunked
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in bpe.encode(df, path).collect():
        assert r["ids"] == tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids


def test_repeated_rows_and_the_fused_stage(spark):
    data = [(1, "the same words 'twice'"), (1, "the same words 'twice'"), (2, None), (3, "")]
    df = clashing(spark.createDataFrame(data, "doc_id long, text string"))
    one = sorted(map(str, bpe.encode_decode(df, PATH).collect()))
    assert one == sorted(map(str, bpe.decode(bpe.encode(df, PATH), PATH).collect())) and len(one) == 4


def test_query_and_empty(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(PATH)
    texts = {r[0]: r[1] or "" for r in rows()}
    for r in op2_chunked_bpe(spark, str(tmp_path)).collect():
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0
