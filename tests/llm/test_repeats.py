"""Substring dedup against a brute-force version."""

import hashlib
import random
import re

import pytest

from tripstrata.llm import repeats as rp


def plain(rows, width=13):
    """{(position in rows): (n_words, n_removed, sha)} by windows as tuples."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    order = [rp.LAST_KEY if k is None else k for k, _ in rows]
    least = {}
    for k, w in zip(order, words):
        for i in range(len(w) - width + 1):
            x = tuple(w[i:i + width])
            least[x] = min(k, least.get(x, k))
    out = []
    for k, w in zip(order, words):
        gone = {i + j for i in range(len(w) - width + 1) if least[tuple(w[i:i + width])] < k for j in range(width)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "b", "é", "É", "ß", "x-y", "一", "long" * 9] + [f"w{i}" for i in range(40)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 40))] for _ in range(8)]
    rows = []
    for k in range(n):
        w = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) - 1)
            w += p[a:a + rng.randint(1, 40)] if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 30))]
        rows.append((k * 3 - 20, rng.choice([" ", "\n", "\t ", "\x0b"]).join(w)))
    rows += [(None, rows[5][1]), (None, None), (400, None), (401, ""), (402, " \n "), (rows[3][0], rows[4][1]), rows[7], rows[7],
             (500, "same " * 300), (499, "same " * 14), (rp.LAST_KEY, "same " * 20), (-2**63, "first " * 13), (7000, "first " * 20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width, shard_bytes, bucket_bytes", [(13, 300, 500), (13, 10**7, 10**7), (4, 1000, 2000), (1, 700, 900)])
def test_equals_brute_force(spark, width, shard_bytes, bucket_bytes):
    rows = corpus(width)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = rp.dedup_substrings(docs, width=width, shard_bytes=shard_bytes, bucket_bytes=bucket_bytes).collect()
    assert sorted((rp.LAST_KEY if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain(rows, width)
    for r in got:
        assert sum(s["last"] - s["first"] + 1 for s in r.spans) == r.n_removed
        if r.n_removed:
            assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256


def test_clashing_columns_types_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame(
        [(1, text, "s", [1, None], "x", 5), (2, text, None, None, "y", 6)],
        "c0 int, text string, shard string, c1 array<int>, spans string, n_words int")
    out = rp.dedup_substrings(docs, key="c0")
    assert out.columns == ["c0", "text", "shard", "c1", "n_words", "n_removed", "kept_sha256", "spans"]
    assert [(r.c0, r.text, r.shard, r.c1, r.n_words, r.n_removed, [tuple(s) for s in r.spans]) for r in out.orderBy("c0").collect()] == [
        (1, text, "s", [1, None], 20, 0, []), (2, "", None, None, 20, 20, [(0, 19)])]
    assert rp.dedup_substrings(docs.limit(0), key="c0").collect() == []
    with pytest.raises(ValueError):
        rp.dedup_substrings(docs, key="shard")


def test_values_survive_packing():
    import numpy as np

    for kind, values in (("u4", [0, 1, 2**32 - 1]), ("u8", [2**64 - 1, 5]), ("i8", [-2**63, 2**63 - 1, 0]), ("u8", [])):
        own = np.array(values, kind)
        assert rp.unpacked(rp.packed(own), kind).tolist() == own.tolist()
