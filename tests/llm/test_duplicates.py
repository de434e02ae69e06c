from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from geogrid.llm import ngram_join, queries, repeats
from geogrid.llm.components import components
from tests.llm.cases import SCHEMA, WORD, ascii_lower, clashing, edited, prose, rows


def plain_components(data):
    sets = {}
    for i, text in data:
        w = WORD.findall(ascii_lower(text))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def families(seed, n=5):
    """Groups of near copies around the limit, chains, and a passage in many documents."""
    rng = random.Random(seed)
    texts = []
    passage = prose(rng, 70)
    for _ in range(n):
        base = prose(rng, rng.randint(30, 120))
        texts += [base, base, edited(rng, base, 20), edited(rng, base, 35), edited(rng, base, 60)]
        step = base
        for k in range(4):
            step = edited(rng, step, 45 + k)
            texts.append(step)
        texts.append(f"{prose(rng, 30)} {passage} {prose(rng, 30)}")
        texts.append(f"{passage} {prose(rng, rng.randint(5, 20))}")
    return texts


@pytest.mark.parametrize("seed", [1])
def test_components_are_the_plain_ones(spark, seed):
    data = [(r[0], r[1]) for r in rows(20, seed)] + [(500 + i, t) for i, t in enumerate(families(seed))]
    df = clashing(spark.createDataFrame(data, "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(df).collect()}
    assert got == plain_components(data)


def test_one_of_each_keeps_columns_nulls_and_leads(spark):
    data = rows() + [(0, rows()[0][1], "en", "b", 1), (None, "null id text", "en", "b", 1), (None, None, None, None, None)]
    df = clashing(spark.createDataFrame(data, SCHEMA))
    out = ngram_join.one_of_each(df)
    assert out.columns == df.columns
    ids = [r["doc_id"] for r in out.collect()]
    want = plain_components([(r[0], r[1]) for r in rows()])
    assert sorted(i for i in ids if i is not None) == sorted(i for i, (_, c) in want.items() if i == c)
    assert ids.count(None) == 2


def test_join_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_join.jaccard_components(empty).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, None), (3, " ")], "doc_id long, text string")
    assert {tuple(r) for r in ngram_join.jaccard_components(blank).collect()} == {(1, 0, 1), (2, 0, 2), (3, 0, 3)}


def test_longer_prefixes_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "COST", 1)
    data = [(i, t) for i, t in enumerate(families(3) + [f"{prose(random.Random(k), 8)} shared words that many texts hold in the very same order here" for k in range(30)])]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(df).collect()}
    assert got == plain_components(data)


def test_chain_and_star_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(200 + i, 200) for i in range(1, 50)] + [(300, 300)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(31)) and all(got[200 + i] == 200 for i in range(50)) and 300 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_join_goes_through_the_driver(spark):
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(30_000)
    before = {x.executionId() for x in _listed(store)}
    texts = families(4, 2)
    df = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], SCHEMA)
    assert {r["doc_id"] for r in ngram_join.one_of_each(df).collect()} == {c for _, c in plain_components(list(enumerate(texts))).values()}
    bus.waitUntilEmpty(30_000)
    plans = [x.physicalPlanDescription() for x in _listed(store) if x.executionId() not in before]
    assert any("SortMergeJoin" in p for p in plans)
    assert sum("Broadcast" in p for p in plans) == 0


def _listed(store):
    found = store.executionsList()
    return [found.apply(i) for i in range(found.size())]


def plain_removal(data):
    seen, out = set(), {}
    for i, text in sorted(data):
        b = (text or "").encode()
        covered = bytearray(len(b))
        for k in range(len(b) - 99):
            w = b[k : k + 100]
            if w in seen:
                covered[k : k + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, z in zip(b, covered, strict=True) if not z)
        runs = sum(1 for k in range(len(b)) if covered[k] and (k == 0 or not covered[k - 1]))
        out[i] = (len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return out


def _texts(seed):
    rng = random.Random(seed)
    p = prose(rng, 30) + " é ok? 😀 yes."
    out = [r[1] for r in rows(25, seed)] + families(seed, 2)
    out += ["x" * 150, p, "abc" + p[:99], "q" + p[5:120] + "zz" + p[:100], "", None, "ab" * 120, p + p, "z" * 99, "z" * 100, "z" * 100]
    for k in range(12):  # one passage after many different beginnings, before many different ends
        out.append(prose(rng, 12) + p[k : 110 + k] + prose(rng, 12))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_are_the_plain_ones(spark, seed):
    data = list(enumerate(_texts(seed)))
    df = clashing(spark.createDataFrame(data, "doc_id long, text string"))
    want = plain_removal(data)
    got = repeats.remove_repeats(df).collect()
    assert len(got) == len(data)
    for r in got:
        removed = sum(s["end"] - s["start"] for s in r["removed"])
        assert (r["n_bytes"], removed, len(r["removed"]), r["kept_sha256"]) == want[r["doc_id"]]


@pytest.mark.parametrize("most", [2, 5])
def test_hot_anchors_give_the_same(spark, monkeypatch, most):
    """With a tiny HOT nearly all repeats are found by windows."""
    data = list(enumerate(_texts(4)))
    want = plain_removal(data)
    monkeypatch.setattr(repeats, "HOT", most)

    def bounded_meet(batches, meet=repeats._meet):  # in the worker too
        repeats.HOT = most
        return meet(batches)

    monkeypatch.setattr(repeats, "_meet", bounded_meet)
    for r in repeats.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect():
        removed = sum(s["end"] - s["start"] for s in r["removed"])
        assert (r["n_bytes"], removed, len(r["removed"]), r["kept_sha256"]) == want[r["doc_id"]]


@pytest.mark.parametrize("most", [1, 3, 256])
def test_repeats_in_small_slices(monkeypatch, most):
    """Steps 2 and 3 give the same for any split of their sorted input."""
    monkeypatch.setattr(repeats, "HOT", most)
    data = [(i, t) for i, t in enumerate(_texts(5)[-40:]) if t]
    column = {"doc": pa.array([i for i, _ in data], pa.int64()), "text": pa.array([t for _, t in data])}
    rows_ = pa.Table.from_batches(list(repeats._segment_rows(iter(pa.table(column).to_batches()))))
    spread = [pa.table({"doc": pa.array([i]), "text": pa.array([t])}).to_batches()[0] for i, t in data]
    rows_ = pa.concat_tables([rows_.slice(0, 0), pa.Table.from_batches(list(repeats._segment_rows(iter(spread))))])
    rows_ = rows_.sort_by([(c, "ascending") for c in ("anchor", "whole", "doc", "place")])
    results = []
    for size in (1, 7, 10_000):
        out = pa.Table.from_batches(list(repeats._meet(iter(rows_.combine_chunks().to_batches(max_chunksize=size)))))
        results.append(sorted(map(tuple, (r.values() for r in out.to_pylist()))))
    assert all(r == results[0] for r in results)
    sent = [r for r in results[0] if not r[3] & 1]
    kinds = {(a, w) for a, w, _, p in map(tuple, (r.values() for r in rows_.to_pylist())) if not p & 1}
    by_anchor = Counter(a for a, _ in kinds)
    assert len(sent) == sum(n for n in by_anchor.values() if n > 1)
    assert all((w == 1) == (by_anchor[a] > most) for a, w, _, _ in sent)


def plain_groups(data):
    """{string: its (doc, start) places} of all 100-byte strings that stand twice."""
    at = defaultdict(set)
    for i, text in data:
        b = (text or "").encode()
        for k in range(len(b) - 99):
            at[b[k : k + 100]].add((i, k))
    return {w: p for w, p in at.items() if len(p) > 1}


@pytest.mark.parametrize("most", [256, 2])
def test_groups_hold_all_occurrences_of_all_repeats(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "HOT", most)
    data = list(enumerate(_texts(6)[-45:]))
    texts = {i: (t or "").encode() for i, t in data}
    groups = defaultdict(set)
    for r in repeats.maximal_repeat_groups(clashing(spark.createDataFrame(data, "doc_id long, text string"))).collect():
        assert r["length"] == r["end"] - r["start"] >= 100
        groups[r["group"]].add((r["doc"], r["start"], r["end"]))
    strings = {}
    for g, places in groups.items():
        held = {texts[d][a:z] for d, a, z in places}
        assert len(held) == 1 and len(places) > 1
        strings[g] = held.pop()
    # Every repeated window lies in a group, with all its places; each group lists all places of its string.
    covered = defaultdict(set)
    for g, places in groups.items():
        for k in range(len(strings[g]) - 99):
            covered[strings[g][k : k + 100]].update((d, a + k) for d, a, _ in places)
    assert covered == plain_groups(data)
    for g, places in groups.items():
        s = strings[g]
        assert places == {(d, k, k + len(s)) for d, b in texts.items() for k in range(len(b) - len(s) + 1) if b[k : k + len(s)] == s}
    assert repeats.maximal_repeat_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_op5_is_the_plain_one(spark, tmp_path):
    data = [(i, t, "en", "a", 1) for i, t in enumerate(_texts(3))]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_removal([(r[0], r[1]) for r in data])
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op5_interval_tree(spark, str(tmp_path)).collect()}
    assert got == want


def test_query_op9_is_the_plain_one(spark, tmp_path):
    data = rows(20) + [(500 + i, t, "en", "a", 1) for i, t in enumerate(families(7, 2))]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op9_adaptive_jaccard(spark, str(tmp_path)).collect()}
    assert got == plain_components([(r[0], r[1]) for r in data])


def test_rows_that_share_an_id_but_differ(spark):
    rng = random.Random(4)
    data = [(1, prose(rng, 30), "en", s, k) for k, s in enumerate("abc")] + [(2, prose(rng, 30), "en", "a", 1)]
    one, two = (ngram_join.one_of_each(spark.createDataFrame(d, SCHEMA)).collect() for d in (data, data[::-1]))
    assert sorted(map(str, one)) == sorted(map(str, two)) and sorted(r["doc_id"] for r in one) == [1, 2]


def test_repeats_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repeats.remove_repeats(empty).count() == 0
    p = "long enough " * 20
    data = [(None, p), (None, p), (1, p), (1, p), (2, p)]
    got = defaultdict(list)
    for r in repeats.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect():
        got[r["doc_id"]].append(sum(s["end"] - s["start"] for s in r["removed"]))
    assert got[None] == [0, 0] and got[2] == [240] and got[1] == [228, 228]


def test_repeats_of_rows_that_share_an_id(spark):
    rng = random.Random(21)
    fresh = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    x, y, z = fresh(400), fresh(500), fresh(300)
    data = [(5, x), (5, x), (2, y), (2, x[:150] + z), (2, None), (9, z[100:] + y[:120]), (-1, "short"), (-1, "short")]
    got = defaultdict(list)
    for r in repeats.remove_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(4)).collect():
        got[r["doc_id"], r["n_bytes"]].append([(s["start"], s["end"]) for s in r["removed"]])
    # The rows of id 5 lose what id 2 has, not each other's bytes; the other text of id 2 loses nothing.
    assert got == {(5, 400): [[(0, 150)], [(0, 150)]], (2, 500): [[]], (2, 450): [[]], (2, 0): [[]], (9, 320): [[(0, 320)]], (-1, 5): [[], []]}
    copies = [(7, x), (7, x[:200] + y), (7, x[:200] + y)]
    lost = sorted(sum(s["end"] - s["start"] for s in r["removed"]) for r in repeats.remove_repeats(spark.createDataFrame(copies, "doc_id long, text string")).collect())
    assert lost in ([0, 0, 200], [0, 200, 200])


def test_interval_tree_and_left_extension():
    assert sorted(repeats.intervals([1, 3, 3, 0, 2], 1)) == [(1, 0, 3), (2, 4, 5), (3, 1, 3)]
    left, right = [b"ba", b"ba", b"bx"], [b"Q" * 40 + b"1", b"Q" * 40 + b"2", b"Q" * 40 + b"3"]
    got = {(k, r, tuple(sorted(m))) for k, r, m in repeats.maximal_repeats(left, right, 33)}
    # (0, 40) of all three is not maximal: all have b before it, so (1, 40) is given
    assert got == {(1, 40, (0, 1, 2)), (2, 40, (0, 1))}


def test_windows_share_the_least_gram():
    rng = np.random.default_rng(2)
    b = rng.integers(97, 100, 700).astype(np.uint8)
    from geogrid.llm.text_arrays import Texts

    t = Texts(b, np.array([0, 300, 350, 700]))
    text, anchor, lo, hi, _, _ = repeats.segments(t)
    covered = sorted(s for a, z in zip(lo, hi, strict=True) for s in range(a, z + 1))
    assert covered == [*range(0, 201), *range(350, 601)]
    assert ((anchor >= hi) & (anchor - lo <= repeats.SPAN)).all() and set(text.tolist()) == {0, 2}


def test_sets_of_a_batch_are_made_in_small_slices(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "bounded_batches", lambda rows, run, schema: run)
    run = ngram_join.sets_and_counts(spark.createDataFrame([(0, "a")], "doc_id long, text string"))
    rng = random.Random(5)
    often = "these five words stand often"
    texts = [f"{prose(rng, 900)} {often if i % 150 == 0 else ''}" for i in range(600)]
    texts += texts[:2]
    held, size = [], ngram_join.Sets
    monkeypatch.setattr(ngram_join, "Sets", lambda t: held.append(len(t.b)) or size(t))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    out = pa.Table.from_batches(run(iter([batch])))
    assert sum(held) == sum(map(len, texts)) > 2 << 20 and max(held) <= 1 << 19
    assert out.column("id").drop_null().to_pylist() == list(range(len(texts)))
    # Counted over the whole batch, and the copy in another slice once.
    found = Counter()
    for text in dict.fromkeys(texts):
        w = WORD.findall(ascii_lower(text))
        found.update({tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    assert found[tuple(often.split())] == 4
    assert sorted(out.column("n").drop_null().to_pylist()) == sorted(n for n in found.values() if n > 3)
