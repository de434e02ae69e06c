from __future__ import annotations

import hashlib
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from geogrid.llm import mixing, ngram_join, pii, quality_fm, queries, toxicity
from tests.llm.cases import SCHEMA, WORD, clashing, edited, prose, rows


def plain_targets(lengths):
    """Water filling by repetition: sources by code point, null last."""
    order = sorted(lengths, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(lengths.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(2 * lengths[s] for s in full)
        level = left / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if level * weight[s] > 2 * lengths[s] + 1e-9]
        if not over:
            return {s: 2 * lengths[s] if s in full else level * weight[s] for s in order}
        full.update(over)


@pytest.mark.parametrize("block", [1, 7, 512])
def test_mix_reaches_its_targets(spark, block):
    data = rows(90)
    df = clashing(spark.createDataFrame(data, SCHEMA))
    got = mixing.mix_sources(df, block_words=block).collect()
    again = mixing.mix_sources(df.repartition(3, "source"), block_words=block).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(data)
    sizes = {r[0]: len(WORD.findall(r[1] or "")) for r in data}
    lengths, taken = defaultdict(int), defaultdict(int)
    for r in data:
        lengths[r[3]] += sizes[r[0]]
    want = plain_targets(lengths)
    for r in got:
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == lengths[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1


def test_schedule_interleaves(spark):
    sizes = spark.createDataFrame([("a", 6000), ("b", 6000), ("c", 6000)], "source string, size long")
    slots = mixing.schedule(mixing.source_targets(sizes), 10).orderBy("slot").collect()
    shares = Counter(r["sid"] for r in slots)
    first = Counter(r["sid"] for r in slots[: len(slots) // 4])
    for s in shares:
        assert abs(first[s] / sum(first.values()) - shares[s] / len(slots)) < 0.03
    ranks = defaultdict(list)
    for r in slots:
        ranks[r["sid"]].append(r["epoch"] * 600 + r["block"])
    assert all(v == list(range(len(v))) for v in ranks.values())


def test_a_tiny_source_among_large_ones(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 400_000), ("c", 300_000), ("d", 25)], "source string, size long")
    targets = mixing.source_targets(sizes)
    want = {r["sid"]: r["take"] for r in targets.collect()}
    slots = mixing.schedule(targets, 10).collect()
    got = Counter()
    for r in slots:
        got[r["sid"]] += r["words"]
    assert dict(got) == want and 0 <= len(slots) - sum(-(-w // 10) for w in want.values()) <= 4
    assert len(slots) == len({r["slot"] for r in slots})
    # No slot is far beyond the number of blocks: few are drawn to no use.
    assert max(r["slot"] for r in slots) < len(slots) + 50


def test_repeated_rows_of_a_mix_and_op6(spark, tmp_path):
    data = rows(90)
    spark.createDataFrame(data + data[:5] + [(None, "no id here", "en", "a", 1)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op6_golden_mix(spark, str(tmp_path)).collect()
    assert len(got) == len(data) + 6
    sizes = [(r[3], len(WORD.findall(r[1] or ""))) for r in data + data[:5]] + [("a", 3)]
    lengths, taken = defaultdict(int), defaultdict(int)
    for s, n in sizes:
        lengths[s] += n
    want = plain_targets(lengths)
    by = defaultdict(list)
    for s, n in sizes:
        by[n].append(s)
    for r in got:
        assert r["source_size"] in lengths.values() and 0 <= r["taken"] <= 2 * r["size"]
        source = next(s for s, v in lengths.items() if v == r["source_size"])
        assert abs(r["target"] - want[source]) < 1e-6
        taken[source] += r["taken"]
    assert all(abs(taken[s] - t) <= 1 for s, t in want.items())
    assert sorted(map(str, got)) == sorted(map(str, queries.op6_golden_mix(spark, str(tmp_path)).collect()))


def test_mix_of_little(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_sources(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", None, 0)], SCHEMA)
    assert {(r["doc_id"], r["taken"], r["target"]) for r in mixing.mix_sources(blank).collect()} == {(1, 0, 0.0), (2, 0, 0.0)}
    assert mixing.mixed_documents(blank).count() == 2


def test_mixed_documents_follow_the_mix(spark):
    df = clashing(spark.createDataFrame(rows(90), SCHEMA)).withColumns({"times": F.lit(7), "__times": F.lit(8), "a.b": F.lit(9), "whole": F.lit("w")})
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and {(r["times"], r["__times"], r["a.b"], r["whole"], r["__n"], r["n_words"]) for r in out.collect()} == {(7, 8, 9, "w", 1, 1)}
    texts = {r[0]: r[1] for r in rows(90)}
    assert all(r["text"] == texts[r["doc_id"]] for r in out.collect())
    times = Counter(r["doc_id"] for r in out.collect())
    for r in mixing.mix_sources(df).collect():
        want = int(r["taken"] / r["size"] + 0.5) if r["size"] else 1
        assert times[r["doc_id"]] == want


def test_golden_points_are_spread(spark):
    p = sorted(r[0] for r in spark.range(1000).select(mixing.golden_point(F.col("id"))).collect())
    gaps = [b - a for a, b in zip(p, p[1:], strict=False)]
    assert max(gaps) < 3 / 1000 and min(gaps) > 0.3 / 1000
    far = spark.range(10**9, 10**9 + 5).select(mixing.golden_point(F.col("id")).alias("p"), "id").collect()
    from decimal import Decimal

    for r in far:
        assert abs(float(mixing._GOLDEN * Decimal(r["id"]) % 1) - r["p"]) < 1e-9


DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(10**6, "", "en", "a", 0), (10**6 + 1, None, None, None, None)], docs.schema)).cache()
    names = [n for n, _ in c.STAGES]
    assert len(names) == 5 and c.ORACLE_SQL is None
    # toxicity: what goes is what the model scores 1/2 or more
    kept = c.STAGES[0][1](spark, docs, DATA).cache()
    model = toxicity.toxicity_model(docs, quality_fm.training_rows(spark.read.parquet(f"{DATA}/labels.parquet"), 5, 0))
    bad = {r["doc_id"] for r in toxicity.score_toxicity(docs, model).where("score >= 0.5").collect()}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - bad
    # near duplicates: the least of each component
    lone = c.STAGES[1][1](spark, kept, DATA).cache()
    least = {r["component_id"] for r in ngram_join.jaccard_components(kept).collect()}
    assert lone.columns == docs.columns and {r["doc_id"] for r in lone.collect()} == least
    # personal data: no base span is left, other texts are as they were
    clean = c.STAGES[2][1](spark, lone, DATA).cache()
    spans = {r["doc_id"]: r["spans"] for r in pii.redactions(lone, pii.train(lone)).collect()}
    before = {r["doc_id"]: r["text"] for r in lone.collect()}
    for r in clean.collect():
        assert (r["text"] == before[r["doc_id"]]) == (not spans[r["doc_id"]])
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    # mixing and encoding
    mixed = c.STAGES[3][1](spark, clean, DATA).cache()
    assert mixed.columns == docs.columns
    coded = c.STAGES[4][1](spark, mixed, DATA)
    assert coded.columns == ["doc_id", "ids", "decoded"] and coded.count() == mixed.count()
    assert prose  # keeps the import used by other cases


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as c

    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = {f for f in os.listdir(shared) if f.startswith("pipeline-")}
    assert c.run(spark, str(tmp_path)).count() == 0
    new = {f for f in os.listdir(shared) if f.startswith("pipeline-")} - before
    assert [sorted(os.listdir(f"{shared}/{f}")) for f in new] == [["3"]]


def _corpus(spark, path):
    """Documents with labels, near copies, secrets and awkward rows, under extra columns with clashing names."""
    rng = random.Random(12)
    texts = [prose(rng, rng.randint(25, 90)) for _ in range(160)]
    labels = []
    for i in range(0, 160, 5):
        words = texts[i].split()
        for _ in range(3):
            words.insert(rng.randrange(len(words)), rng.choice(["scum", "idiot", "moron"]))
        texts[i] = " ".join(words)
    for i in range(1, 40, 5):
        texts[i] += f' token = "{hashlib.sha256(str(i).encode()).hexdigest()[:40]}" mail a{i}@b.org'
    texts += [texts[2], edited(rng, texts[3], 30), "", None, prose(rng, 6000), "é “x” 😀 " * 5]
    labels = [(i, 1, int(i % 5 == 0)) for i in range(160)]
    data = [(i, t, "en", "abc"[i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    docs = clashing(spark.createDataFrame(data + data[7:9], SCHEMA)).withColumns({"__found": F.lit(1), "__times": F.lit(2), "whole": F.lit(3), "label": F.lit(4), "predicted": F.lit(5)})
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return {i: t for i, t, *_ in data}


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    import corpus_pipeline as c

    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    texts = _corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    outs = []
    for k, (_, stage) in enumerate(c.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k + 1 < len(c.STAGES):
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        outs.append(docs)
    clashes = {tuple(r) for r in outs[3].select("__n", "__found", "__times", "whole", "label", "predicted", "score", "size", "kind").distinct().collect()}
    assert clashes == {(1, 1, 2, 3, 4, 5, 1, 1, 1)}
    # Toxic documents go, clean ones stay (repeated rows too).
    ids = Counter(r["doc_id"] for r in outs[0].select("doc_id").collect())
    toxic = set(range(0, 160, 5))
    assert len(toxic & set(ids)) <= 2 and len(set(texts) - toxic - set(ids)) <= 2 and ids[7] == 2
    # One of each group: copies, near copies and repeated rows.
    kept = Counter(r["doc_id"] for r in outs[1].select("doc_id").collect())
    least = {r["component_id"] for r in ngram_join.jaccard_components(outs[0]).collect()}
    assert set(kept) == least and max(kept.values()) == 1 and not {160, 161} & set(kept)
    # Personal data goes, other texts are as they were.
    clean = {r["doc_id"]: r["text"] for r in outs[2].collect()}
    for i, t in clean.items():
        if i % 5 == 1 and i < 40:
            assert "[email]" in t and "[secret]" in t and hashlib.sha256(str(i).encode()).hexdigest()[:40] not in t
        elif t is not None and i < 160:
            assert t == texts[i]
    # Mixed: as often as the schedule says; encoded: as the library does.
    times = Counter(r["doc_id"] for r in outs[3].collect())
    for r in mixing.mix_sources(outs[2]).collect():
        assert times[r["doc_id"]] == (int(r["taken"] / r["size"] + 0.5) if r["size"] else 1)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coded = outs[4].collect()
    assert Counter(r["doc_id"] for r in coded) == times
    for r in coded:
        ids = tokenizer.encode(clean[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)


def test_redaction_stage_without_a_size_column(spark):
    import corpus_pipeline as c

    docs = spark.createDataFrame([(1, "mail me at a@b.org now", "en", "a")], "doc_id long, text string, lang string, source string")
    assert [tuple(r) for r in c.STAGES[2][1](spark, docs, "").collect()] == [(1, "mail me at [email] now", "en", "a")]
