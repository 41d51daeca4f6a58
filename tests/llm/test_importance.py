"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tripstrata.llm import importance as im

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, buckets):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), Counter(zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1))


def plain(docs, target, buckets=10_000, percent=5):
    own, wanted = [features(t, buckets) for _, t in docs], sum((features(t, buckets)[1] for t in target), Counter())
    s = sum((c for _, c in own), Counter())
    total, goal = sum(s.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1.0) * (total + buckets) / ((s[b] + 1.0) * (goal + buckets)))) for b in range(buckets)]
    out = []
    for (k, _), (n, c) in zip(docs, own):
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * m for b, m in c.items())
        out.append([k, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((x for x in out if x[5] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for rank, x in enumerate(fit[:len(fit) * percent // 100]):
        x[4] = rank + 1
    return sorted((tuple(x[:5]) for x in out), key=repr)


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["A", "é", "É", "x1", "über", "longword" * 9, "一二"] + [f"W{i}" for i in range(50)]
    lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9))) for _ in range(30)] + ["", " - ", "one"]
    return [rng.choice(["\n", "\r\n", "\n\n"]).join(rng.choice(lines) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("buckets", [10_000, 37])
def test_equals_plain_version(spark, buckets):
    docs = list(enumerate(texts(1, 90))) + [(None, "word " * 30), (200, None), (201, ""), (202, "\n"), (203, "x" * 5000 + " y"), (204, "z " * 19)]
    docs += [(1, docs[1][1]), (5, docs[9][1])]
    target = texts(2, 10) + [None, ""]
    frame = spark.createDataFrame([(*d, "s", 1) for d in docs], "doc_id long, text string, line string, n int").repartition(3)
    got = im.importance_resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), buckets=buckets, percent=40)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, target, buckets, 40)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = docs.limit(0)
    assert im.importance_resample(none, docs).collect() == []
    row = im.importance_resample(docs, none).first()
    assert (row.n_features, row["rank"], row.weight) == tuple(plain([(1, "a b")], [])[0][i] for i in (1, 4, 2))


def test_checksums_of_joined_words():
    data = b"a word " + "ünï".encode() + b" " + b"q" * 300 + b" z "
    words = im.Words(np.frombuffer(data, np.uint8), np.array([0]))
    own = [data[a:a + n] for a, n in zip(words.begin, words.size)]
    assert own == data.split()
    assert im.word_crcs(words.data, words.begin, words.size).tolist() == [zlib.crc32(w) for w in own]
    spaced = im.word_crcs(words.data, words.begin, words.size, b" ")
    left = im.word_crcs(words.data, words.begin, words.size)
    assert im.joined(left[:-1], spaced[1:], words.size[1:] + 1).tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(own, own[1:])]
