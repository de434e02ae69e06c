"""Fingerprints against plain sets of hashes."""

from __future__ import annotations

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from geogrid.llm import fingerprints, oracles, queries
from tests.llm.cases import SCHEMA, WORD, clashing, edited, prose, rows


def hashes(text):
    words = WORD.findall((text or "").lower())
    spans = [words] if 0 < len(words) <= 5 else [words[i : i + 5] for i in range(len(words) - 4)]
    return sorted({hashlib.md5(" ".join(s).encode()).hexdigest()[:16] for s in spans})


def sketched(all_hashes, fraction=1 / 8, least=32):
    limit = f"{int(fraction * 2**32):08x}" if fraction < 1 else "g"
    return [h for i, h in enumerate(all_hashes) if h < limit or i < least]


def likeness(a, b, fraction=1 / 8, least=32):
    if a == b:
        return 1.0
    limit = f"{int(fraction * 2**32):08x}" if fraction < 1 else "g"
    upto = min("g" if len(s) < least else max(limit, s[-1]) for s in (a, b))
    x, y = ({h for h in s if h <= upto} for s in (a, b))
    return len(x & y) / min(len(x), len(y)) if x and y else 0.0


def plain(data, fraction=1 / 8, least=32):
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for i, r in enumerate(order):
        text, other = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + other[:half]
        own, new, following = (sketched(hashes(t), fraction, least) for t in (text, changed, other))
        out.append((r[0], len(text), hashlib.sha256(changed.encode()).hexdigest(), "".join(own), "".join(new), likeness(own, new, fraction, least), likeness(own, following, fraction, least)))
    return sorted(map(str, out))


def corpus():
    rng = random.Random(11)
    data = rows(80)
    long = prose(rng, 6000)
    data += [(1000 + 7 * i, t, None, None, None) for i, t in enumerate([long, long[: len(long) // 9], "😀" * 301, "é" * 7, " \x0b\x1c ", "A B C D E", "a b c d e f", edited(rng, long, 50), long])]
    data += [(-5, prose(rng, 200), None, None, None), (2**40, prose(rng, 300), None, None, None), (2**62, "end", None, None, None)]
    data += [(2000, "tie b", None, None, None), (2000, "tie a", None, None, None), (2000, "tie a", None, None, None), (None, "no id", None, None, None), (None, None, None, None, None)]
    return data


@pytest.mark.parametrize("blocks", [1, 2, 7, 40, 500])
def test_query_against_plain_sets(spark, tmp_path, monkeypatch, blocks):
    data = corpus()
    random.Random(blocks).shuffle(data)
    df = clashing(spark.createDataFrame(data, SCHEMA)).selectExpr("*", "1 as print", "2 as edited", "3 as next_text", "4 as _k", "5 as sketch")
    df.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(fingerprints, "MOST_BLOCKS", blocks)
    monkeypatch.setattr(fingerprints, "BLOCKS", 1000)
    got = [tuple(r) for r in queries.op13_scaled_sketch(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == plain(data)
    if blocks == 1:
        con = duckdb.connect()
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        sql = con.sql(oracles.SCALED_SKETCH).fetchall()
        assert sorted(map(str, sql)) == plain(data)


@pytest.mark.parametrize(("fraction", "least"), [(1, 4), (1 / 64, 3), (0.3, 1)])
def test_other_fractions(spark, fraction, least):
    data = corpus()
    out = fingerprints.fingerprints(spark.createDataFrame(data, SCHEMA), fraction, least, 5)
    got = out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256), F.array_join("sketch", ""), F.array_join("edited_sketch", ""), "near_edited", "near_next").collect()
    assert sorted(map(str, map(tuple, got))) == plain(data, fraction, least)


def test_merged_fingerprint_is_that_of_all_shingles(spark):
    rng = random.Random(3)
    texts = [[prose(rng, rng.choice([3, 20, 90, 900])) for _ in range(rng.randint(1, 5))] for _ in range(40)] + [["", " "], [""]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, texts array<string>")
    got = df.select("i", fingerprints.merged(F.transform("texts", lambda t: fingerprints.sketch(t))).alias("m")).collect()
    for r in got:
        assert r["m"] == sketched(sorted({h for t in texts[r["i"]] for h in hashes(t)}))


def test_containment_of_unequal_documents(spark):
    rng = random.Random(9)
    pairs, want = [], []
    for k in range(60):
        small = prose(rng, 400)
        words = small.split(" ")
        share = k / 59
        cut = int(len(words) * share)
        big = " ".join(words[:cut]) + " " + prose(rng, 20000 if k % 6 == 0 else 1500)
        a, b = set(hashes(small)), set(hashes(big))
        pairs.append((small, big))
        want.append(len(a & b) / len(a))
    df = spark.createDataFrame(pairs, "a string, b string").select(fingerprints.containment(fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))).alias("c"))
    errors = [abs(r["c"] - w) for r, w in zip(df.collect(), want, strict=True)]
    assert sum(errors) / len(errors) < 0.06 and max(errors) < 0.25


def test_edges(spark):
    assert fingerprints.fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
    (one,) = fingerprints.fingerprints(spark.createDataFrame([(7, "abcdef", None, None, None)], SCHEMA)).collect()
    assert (one["n_chars"], one["edited"], one["near_next"]) == (6, "abcabc", 1.0)
    plan = fingerprints.fingerprints(spark.createDataFrame([(7, "abcdef", None, None, None)], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
