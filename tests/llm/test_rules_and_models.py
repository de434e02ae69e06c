from __future__ import annotations

import dataclasses
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from geogrid.llm import divergence, fm, quality_fm, queries, toxicity
from geogrid.llm.text_arrays import Texts, repeated_words, text_bytes
from tests.llm.cases import SCHEMA, WORD, clashing, prose, rows


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, places = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            for i in at:
                places.update(range(i, i + 8))
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    failed = len(words) < 20 or 100 * len(places) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(places), failed


def test_divergence_counts_and_guards(spark):
    df = clashing(spark.createDataFrame(rows(), SCHEMA))
    refs = divergence.language_references(df)
    got = divergence.divergence_rules(df, refs).collect()
    texts = {r[0]: r[1] for r in rows()}
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[1:7]) == plain_counts(texts[r["doc_id"]])
        if r["n_words"] < 50:
            assert r["char_distance"] == r["word_distance"] == 0 and r["kept"] == (not r["base_failed"])


def test_junk_diverges_from_prose(spark):
    rng = random.Random(1)
    data = [(i, prose(rng, 200), "en", "a", 1) for i in range(40)]
    data += [(100, " ".join("ABCDEFG!!" + str(i) for i in range(200)), "en", "a", 1)]
    df = spark.createDataFrame(data, SCHEMA)
    kept = {r["doc_id"]: r["kept"] for r in divergence.divergence_rules(df, divergence.language_references(df)).collect()}
    assert not kept[100] and sum(kept.values()) == 40


def test_no_rows_no_references(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert divergence.language_references(empty) == {}
    assert divergence.divergence_rules(empty, {}).count() == 0
    some = spark.createDataFrame(rows(), SCHEMA)
    assert all(r["kept"] != r["base_failed"] for r in divergence.divergence_rules(some, {}).collect())


def test_js_distance_against_its_definition():
    p, q = np.array([[0.5, 0.5, 0.0]]), np.array([0.0, 0.5, 0.5])
    assert abs(divergence.js_distance(p, q)[0] - np.sqrt(0.5)) < 1e-12
    assert divergence.js_distance(p, p[0])[0] == 0


def _labelled(n=400):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        text = prose(rng, 40)
        bad = i % 4 == 0
        if bad:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum"]))
            text = " ".join(words)
        docs.append((i, text, "en", "a", len(text)))
        labels.append((i, int(not bad), int(bad)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = _labelled()
    d, lab = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.toxicity_model(d, quality_fm.training_rows(lab, 5, 0))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(clashing(d), model).collect()}
    right = sum(got[i]["predicted"] == t for i, _, t in labels)
    assert right >= 0.97 * len(labels) and all(0 <= r["score"] <= 1 for r in got.values())
    kept = toxicity.drop_toxic(clashing(d), model)
    assert kept.columns == clashing(d).columns and abs(kept.count() - 300) <= 8


def test_quality_reads_structure(spark):
    docs, labels = _labelled()
    docs = [(i, t.upper() + "!!" * 9 if i % 4 == 0 else t, la, s, n) for i, t, la, s, n in docs]
    d, lab = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality_fm.quality_model(d, quality_fm.training_rows(lab, 3, 1))
    got = {r["doc_id"]: r["predicted"] for r in quality_fm.score_quality(d, model).collect()}
    assert sum(got[i] == q for i, q, _ in labels) >= 0.97 * len(labels)


def test_models_without_labels_and_awkward_rows(spark):
    df = clashing(spark.createDataFrame(rows() + rows()[:3], SCHEMA))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(0, 1, 0), (1, None, None), (None, 1, 0), (0, 1, 0)], "doc_id long, quality int, toxic int")
    for labels, low, high in ((none, 0.49, 0.51), (one, 0.0, 1.0)):
        for model, score in ((quality_fm.quality_model(df, labels), quality_fm.score_quality), (toxicity.toxicity_model(df, labels), toxicity.score_toxicity)):
            got = score(df, model).collect()
            assert len(got) == len(rows()) + 3 and all(low <= r["score"] <= high for r in got)
    assert quality_fm.score_quality(spark.createDataFrame([], SCHEMA), fm.Model(quality_fm.SPEC, np.full(fm.BUCKETS, -1), 0.0, np.zeros(20), np.zeros((20, 6)))).count() == 0


def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    w, v = rng.normal(size=5), rng.normal(size=(5, 3))
    model = fm.Model(fm.Spec(rank=3), np.full(fm.BUCKETS, -1), 0.3, w, v)
    x = rng.normal(size=5)
    want = 0.3 + w @ x + sum(v[i] @ v[j] * x[i] * x[j] for i in range(5) for j in range(i))
    got, _ = model.margin(np.zeros(5, int), np.arange(5), x, 1)
    assert abs(got[0] - want) < 1e-9


def test_repeated_words_over_text_borders():
    import pyarrow as pa

    b, offs = text_bytes(pa.array(["a b c d e f g h", "a b c d e f g h", None, "a b c d e f g h a b c d e f g h"]))
    t = Texts(b, offs)
    t.words()
    hashes = Texts.ranges(t.prefix(t.b, 1), t.start, t.end)
    assert repeated_words(t, hashes).tolist() == [0, 0, 0, 16]


def test_texts_without_common_words_are_dropped(spark):
    rng = random.Random(4)
    common = divergence.COMMON_WORDS["en"].split()

    def text(n, part):
        return " ".join(rng.choice(common) if rng.random() < part else "".join(rng.choices("bdfglmnprstvw", k=3)) + rng.choice("aeiou") + str(rng.choice("xyz")) for _ in range(n))

    data = [(i, text(rng.randint(80, 300), 0.25), ("en", "en", None)[i % 3], "a", 1) for i in range(300)]
    data += [(1000 + i, text(200, 0), ("en", None)[i % 2], "a", 1) for i in range(40)]
    data += [(2000 + i, text(200, 0), "it", "a", 1) for i in range(200)]
    # Texts that fail the base rules do not move the references.
    data += [(3000 + i, "same words again and again until the end " * 40, "en", "a", 1) for i in range(300)]
    df = spark.createDataFrame(data, SCHEMA)
    refs = divergence.language_references(df)
    got = {r["doc_id"]: r for r in divergence.divergence_rules(df, refs).collect()}
    assert sum(got[i]["kept"] for i in range(300)) >= 297
    assert not any(r["kept"] for i, r in got.items() if i >= 1000)
    none = divergence.js_distance(np.eye(divergence.N_WORDS)[-1:], refs["en"].words)[0]
    assert refs["en"].word_limit < none and refs["other"].word_limit is None
    sound = spark.createDataFrame([r for r in data if r[0] < 3000], SCHEMA)
    assert np.allclose(divergence.language_references(sound)["en"].words, refs["en"].words)


def _pairs(n=900):
    """Toxic only if an insult meets its own group: each word alone, and each other pair, is as common in clean texts."""
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        insult, group = rng.choice(["vermin", "parasite"]), rng.choice(["northerners", "southerners"])
        toxic = (insult == "vermin") == (group == "northerners")
        words = prose(rng, 25).split()
        words.insert(rng.randrange(len(words)), insult)
        words.insert(rng.randrange(len(words)), group)
        docs.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_pairs_that_no_additive_model_tells_apart(spark):
    docs, labels = _pairs()
    d, lab = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.toxicity_model(d, quality_fm.training_rows(lab, 5, 0))
    out = {zlib.crc32(str(i).encode()) % 5 == 0: [] for i in range(9)}
    for r in toxicity.score_toxicity(d, model).collect():
        out[zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0].append(r["predicted"] == labels[r["doc_id"]][2])
    assert np.mean(out[True]) > 0.95
    linear = dataclasses.replace(model, factors=np.zeros_like(model.factors))
    flat = [r["predicted"] == labels[r["doc_id"]][2] for r in toxicity.score_toxicity(d, linear).collect()]
    assert np.mean(flat) < 0.7


def test_any_type_of_n_chars_and_clashing_names(spark):
    docs, labels = _labelled(200)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    d = spark.createDataFrame(docs, SCHEMA).withColumn("label", F.lit(1)).withColumn("buckets", F.lit("x")).withColumn("a.b", F.lit(2))
    for chars in (F.lit("many"), F.array(F.lit(1)), F.col("n_chars").cast("string"), F.lit(None)):
        e = d.withColumn("n_chars", chars)
        assert quality_fm.score_quality(e, quality_fm.quality_model(e, lab)).count() == 200
    kept = toxicity.drop_toxic(d.withColumn("score", F.lit("s")), toxicity.toxicity_model(d, lab))
    assert kept.columns == [*d.columns, "score"] and {(r["a.b"], r["score"]) for r in kept.collect()} == {(2, "s")}


@pytest.mark.parametrize("name,modulus,rest,label", [("op7_quality_fm", 3, 1, 1), ("op10_toxicity_fm", 5, 0, 2)])
def test_model_queries(spark, tmp_path, name, modulus, rest, label):
    docs, labels = _labelled()
    extra = [(1000 + i, t, None, None, None) for i, t in enumerate(["", None, " \n", "x" * 5000, prose(random.Random(1), 3000)])]
    # Held-out labels are wrong on purpose: nothing may be learnt from them.
    held = lambda i: zlib.crc32(str(i).encode()) % modulus == rest
    wrong = [(i, 1 - q if held(i) else q, 1 - t if held(i) else t) for i, q, t in labels]
    spark.createDataFrame(docs + extra + extra[:1], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(wrong, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in docs + extra + extra[:1])
    right = []
    for r in got:
        assert r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] < 1000:
            right.append(r["predicted"] == labels[r["doc_id"]][label])
    assert np.mean(right) > 0.95


def test_query_op3_is_the_plain_one(spark, tmp_path):
    data = rows() + [(1000, "Le mot de la fin. " * 400, "fr", "a", 1), (1001, None, None, None, None)]
    spark.createDataFrame(data + data[:4], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_divergence(spark, str(tmp_path))
    refs = divergence.language_references(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    texts = {r[0]: r[1] for r in data}
    got = got.collect()
    assert len(got) == len(data) + 4
    for r in got:
        n, *_, failed = plain_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_counts(texts[r["doc_id"]])
        far = plain_distances(texts[r["doc_id"]], refs) if n >= 50 else None
        if far is not None:
            assert abs(r["char_distance"] - far[0]) < 1e-9 and abs(r["word_distance"] - far[1]) < 1e-9
        assert r["kept"] == (not failed and (far is None or (far[0] <= 0.32 and far[2])))


def plain_distances(text, refs):
    """Distances by their definition, one text and one reference at a time."""

    def distance(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
        part = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m, strict=True) if a > 0)
        return math.sqrt(max((part(p) + part(q)) / 2, 0))

    chars = [0] * len(divergence.CLASSES)
    for b in text.encode():
        chars[divergence.CLASS_OF[b]] += 1
    chars = chars[: divergence.N_CHARS]
    words = [0] * divergence.N_WORDS
    for w in WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)):
        w = w[:-1] if w[-1] in ".," and len(w) > 1 else w
        words[divergence.WORDS.index(w) if w in divergence.WORDS else len(divergence.WORDS)] += 1
    p, q = [c / sum(chars) for c in chars], [w / sum(words) for w in words]
    listed = [r for r in refs.values() if r.word_limit is not None] or list(refs.values())
    near = [distance(q, r.words) for r in listed]
    limits = [0.42 if r.word_limit is None else min(0.42, r.word_limit) for r in listed]
    return min(distance(p, r.chars) for r in refs.values()), min(near), any(a <= b for a, b in zip(near, limits, strict=True))


def test_references_do_not_depend_on_the_order_of_rows(spark):
    df = spark.createDataFrame(rows(90), SCHEMA)
    one, two = (divergence.language_references(x) for x in (df.repartition(7), df.orderBy(F.desc("doc_id")).coalesce(1)))
    assert set(one) == set(two)
    for k in one:
        assert (one[k].chars == two[k].chars).all() and (one[k].words == two[k].words).all() and one[k].word_limit == two[k].word_limit
