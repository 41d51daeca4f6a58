"""Set join, components and vector links against brute force."""

import random
import re

import numpy as np
import pytest

from tripstrata.llm import graph_index as gi
from tripstrata.llm import set_join as sj
from tripstrata.llm import vector_links as vl
from tripstrata.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    rows = sorted(rows, key=lambda r: r[0])
    sets = [shingles(r[1]) for r in rows]
    pairs = [(i, j) for j, y in enumerate(sets) for i, x in enumerate(sets[:j])
             if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    return {rows[i][0]: (len(s), rows[r][0]) for i, (s, r) in enumerate(zip(sets, roots(len(rows), pairs), strict=True))}


def copies(seed, base, n, edits):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def corpus():
    rnd = random.Random(3)
    texts = [None, "", " \t\n", "One two", "one TWO", "one two three four five", "É a b c d", "é a b c d", "x y a b c d"]
    for size, n, edits in ((120, 40, 5), (60, 25, 3), (30, 20, 2), (400, 15, 30)):
        texts += copies(size, [f"b{size}w{k}" for k in range(size)], n, edits)
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [" ".join(f"u{i}w{k}" for k in range(rnd.randint(1, 90))) + " " + passage for i in range(60)]
    texts += [" ".join(rnd.choice(["a", "b"]) for _ in range(rnd.randint(1, 60))) for _ in range(30)]
    texts += rnd.sample([t for t in texts if t], 20)
    rnd.shuffle(texts)
    return [(7 * i + 3, t, f"x{i}", i) for i, t in enumerate(texts)]


@pytest.mark.parametrize("frequent, bucket, block", [(8, 400_000, 512), (10 ** 9, 300, 3)])
def test_set_join_equals_brute_force(spark, monkeypatch, frequent, bucket, block):
    """With and without frequent shingles last, with one bucket and with many, so that short, long and split lists all occur."""
    for name, value in (("FREQUENT", frequent), ("BUCKET", bucket), ("BLOCK", block)):
        monkeypatch.setattr(sj, name, value)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, sig string, n int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in sj.jaccard_components(docs).collect()}
    assert got == brute(rows)


def test_one_of_each_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1), (2, "a b c d e f", 2), (3, None, 3), (4, "", 4), (3, None, 5)],
                                 "doc_id long, text string, component_id int")
    kept = sj.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.component_id for r in kept.collect()) == [1, 3, 4, 5]
    assert sj.jaccard_components(docs.limit(0)).count() == 0


def test_one_of_each_with_null_and_repeated_keys(spark):
    a, b, c = "a b c d e f", "g h i j k l", "m n o p q r"
    docs = spark.createDataFrame([
        (None, a, 1), (None, b, 2), (5, b, 3), (6, c, 4), (6, c, 5), (7, "s t u v w x", 6), (7, c, 7), (None, None, 8), (8, a, 9)],
        "doc_id long, text string, n int")
    kept = sj.one_of_each(docs)
    got = {r.n for r in kept.collect()}
    assert kept.columns == docs.columns and kept.count() == 5
    assert {1, 2, 6, 8} < got and len(got & {4, 5}) == 1


def test_components(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(500, k) for k in range(501, 560)] + [(7, 7), (900, 901), (901, 900), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(500, 560), 500), 900: 900, 901: 900}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 16))
    base[n // 3:n // 2] = base[0] + rng.normal(scale=0.05, size=(n // 2 - n // 3, 16))  # a hot group
    for k in range(n // 2, n // 2 + 40, 2):
        base[k + 1] = base[k] + rng.normal(scale=0.02, size=16)
    return base.astype(np.float32)


@pytest.mark.parametrize("shard", [2048, 150])
def test_vector_links_equal_brute_force(spark, shard):
    x = vectors(600, 5)
    rows = [(i, v.tolist(), int(i % 7 == 0), "x") for i, v in enumerate(x)]
    rows += [(1000 + i, x[i].tolist(), int(i % 7 == 0), "y") for i in range(0, 30, 3)]  # copies
    odd = [(2000, None, 0), (2001, [], 0), (2002, [0.0] * 16, 0), (2003, [float("nan")] * 16, 0), (2004, x[1].tolist(), None),
           (2005, [None] * 16, 0), (2006, [float("inf")] + [0.0] * 15, 0), (2007, x[1][:8].tolist(), 0), (2008, (x[1] * 2).tolist(), 0)]
    df = spark.createDataFrame(rows + [(*o, "z") for o in odd], "vec_id long, embedding array<float>, label int, copies string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vl.vector_links(df, shard=shard).collect()}
    good = [r for r in rows] + [(*odd[-1], "z")]
    want = {o[0]: (0, o[0], True) for o in odd[:-1]}
    for label in (0, 1):
        own = sorted((r for r in good if r[2] == label), key=lambda r: r[0])
        m = np.array([r[1] for r in own], np.float64)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        link = m @ m.T >= 0.98
        np.fill_diagonal(link, False)
        root = roots(len(own), zip(*np.nonzero(link), strict=True))
        want |= {r[0]: (int(link[i].sum()), own[root[i]][0], root[i] == i) for i, r in enumerate(own)}
    assert got.keys() == want.keys()
    wrong = {k for k in got if got[k] != want[k]}
    assert not wrong, [(k, got[k], want[k]) for k in list(wrong)[:5]]


@pytest.mark.parametrize("n", [3, 40, 250, 1500])
def test_graphs_are_searched_at_every_size(monkeypatch, n):
    """The audit passes with a beam narrower than the shard, and what it reports is what brute force confirms."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(max(1, n // 3), 16))[rng.integers(0, max(1, n // 3), n)] + rng.normal(scale=0.02, size=(n, 16))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph, searched = gi.build(x), []
    search = gi.Graph.search
    monkeypatch.setattr(gi.Graph, "search", lambda self, q, beam: searched.append(len(q)) or search(self, q, beam))
    audit = gi.audited(graph, x, 0.98, 0.98, 64)
    q, f = gi.near(graph, x, 0.98, audit.beam)
    truth = x @ x.T >= 0.98
    assert audit.beam < n and audit.hits >= 0.98 * audit.truths > 0
    assert searched.count(n) >= 1 and truth[q, f].all() and len(q) >= 0.98 * truth.sum()


def test_recall_is_returned(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(60, 8)))] + [(None, None, 0)]
    got = vl.vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert all(r.recall >= 0.9 for r in got if r.vec_id is not None)
    assert [(r.recall, r.kept) for r in got if r.vec_id is None] == [(None, True)]


def test_empty_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vl.vector_links(df).count() == 0


def test_graph_finds_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    queries = x[:200] + rng.normal(scale=0.05, size=(200, 24)).astype(np.float32)
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    graph = gi.build(x)
    assert len(graph.levels) > 1
    ids, _ = graph.search(queries, 32)
    assert np.mean(ids[:, 0] == (queries @ x.T).argmax(1)) >= 0.95
    for n in (1, 2, 3):
        assert gi.build(x[:n]).search(x[:n], 4)[0][:, 0].tolist() == list(range(n))
