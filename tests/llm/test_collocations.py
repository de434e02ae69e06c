"""Collocations against counts of all phrases one by one."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from geogrid.llm import collocations, queries
from tests.llm.cases import SCHEMA, ascii_lower, clashing, prose, rows

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def plain(data, least, top=2000, longest=5):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in data:
        lang = "und" if lang is None else lang
        for piece in PIECE.split(ascii_lower(text)):
            words = tuple(WORD.findall(piece))
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(words[i : i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            inside = (q for q, b in candidates.items() if len(q) > len(p) and 100 * b >= 100 * a)
            if any(q[i : i + len(p)] == p for q in inside for i in range(len(q) - len(p) + 1)):
                continue
            cuts = [(1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def corpus():
    rng = random.Random(8)
    common = ["alpha", "Beta", "gamma", "deltaé", "x" * 400, "Ωμ", "a\x1cb", " ", " q"]
    data = rows(60)
    for i in range(100, 180):
        words = [rng.choice(common[: rng.randint(2, 9)]) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "\r\n", " - "]) for w in words)
        data.append((i, text, rng.choice(["en", "de", None, "und", "", "ü"]), "a", None))
    data += [(500 + i, "the same words again and again the same words again", "en", "b", None) for i in range(40)]
    data += [(600, " ".join(["loop"] * 3000), "en", "b", 1), (600, " ".join(["loop"] * 3000), "en", "b", 1), (None, "alpha beta " * 30, None, None, None)]
    data += [(700, "", "en", None, None), (701, None, None, None, None), (702, " \t ", "fr", None, 0), (703, "alpha", "fr", None, 0)]
    return data


@pytest.mark.parametrize(("least", "top", "bits"), [(2, 2000, 26), (3, 10, 7), (12, 2000, 26), (100, 2000, 26), (10**6, 2000, 26)])
def test_against_plain_counts(spark, monkeypatch, least, top, bits):
    monkeypatch.setattr(collocations, "PARTS", 3)
    data = corpus()
    df = clashing(spark.createDataFrame(data, SCHEMA)).selectExpr("*", "1 as k", "2 as n", "3 as w1", "4 as phrase", "5 as f").repartition(5)
    got = collocations.collocations(df, top=top, min_count=least, most_bits=bits)
    assert sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()) == plain(data, least, top)


def test_shorter_windows(spark):
    data = corpus()
    got = collocations.collocations(spark.createDataFrame(data, SCHEMA), min_count=5, longest=3).collect()
    assert sorted(tuple(r) for r in got) == plain(data, 5, longest=3)


def test_slices_of_texts_make_no_difference(spark, monkeypatch):
    data = corpus()
    df = spark.createDataFrame(data, SCHEMA)
    want = sorted(tuple(r) for r in collocations.phrase_counts(df, 4).collect())
    monkeypatch.setattr(collocations, "SLICE", 1)
    assert sorted(tuple(r) for r in collocations.phrase_counts(df, 4).collect()) == want


def test_exact_scores(spark):
    rng = random.Random(4)
    numbers = [(10**16 + 7, 3 * 10**17, 10**16 + 9, 10**16 + 8), (1, 1, 1, 1), (2**53 + 1, 2**53 + 3, 2**53 + 1, 2**53 + 1)]
    for _ in range(300):
        n = rng.randint(10**3, 10**17)
        l, r = rng.randint(100, n), rng.randint(100, n)  # noqa: E741
        numbers.append((rng.randint(100, max(100, min(l, r))), n, l, r))
    numbers = [(a, n, l, r) for a, n, l, r in numbers if 1000 * a * n // (l * r) < 2**63]
    numbers += [(l * r // n + d, n, l, r) for n, l, r in ((10**9, 10**8 + 7, 10**8 + 9), (10**15, 10**14 + 3, 10**13 + 1)) for d in (0, 1)]
    df = spark.createDataFrame(numbers, "a long, n long, l long, r long")
    got = df.select("a", "n", "l", "r", collocations.score(*(F.col(c) for c in "anlr")).alias("s")).collect()
    assert all(x["s"] == 1000 * x["a"] * x["n"] // (x["l"] * x["r"]) for x in got) and len(got) == len(numbers)


def test_query_and_empty(spark, tmp_path):
    rng = random.Random(6)
    data = [(i, prose(rng, 30) + " in the end. " * 3, ("en", None)[i % 2], "a", 1) for i in range(120)]
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op12_top_marginals(spark, str(tmp_path))
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in out.collect()) == plain(data, 100) != []
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).collect() == []
