"""Hard negatives against plain integers."""

import math
import random

import numpy as np
import pytest

from tripstrata.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<double>"


def plain(rows):
    own = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows
           if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, l, v in own:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in own if j != i and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == l][:5]:
            below = [x for x in scored if x[2] != l and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(below)]
    return sorted(out)


def vectors(seed, n, dim, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(3)]
    return [(i * 5, rng.randrange(3), [scale * (0.6 * c + rng.gauss(0, 0.5)) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("scale, blocks", [(1.0, {}), (1.0, {"row_block": 20, "anchor_block": 3}), (1e5, {"row_block": 30})])
def test_equals_plain_integers(spark, scale, blocks):
    rows = vectors(7, 150, 5, scale) + vectors(8, 12, 3, scale)[1:] + [
        (1000, None, [1.0] * 5), (None, 1, [1.0] * 5), (1050, 1, None), (1100, 1, [1.0, None, 1.0, 1.0, 1.0]),
        (1150, 1, [float("nan")] * 5), (1200, 2, [float("inf")] * 5), (1250, 1, [0.0] * 5), (1251, 1, [0.0] * 5), (1252, 2, [0.0] * 5),
        (1300, 0, []), (1301, 0, []), (1302, 1, [])]
    rows += [(2000 + k, k % 2, [scale * 0.5] * 5) for k in range(60)]  # ties
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = hn.hard_negatives(docs, **blocks)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows)


def test_residues_give_exact_scores():
    rng = np.random.default_rng(1)
    for dim, top in ((700, 2**15), (1, 2**30), (3, 2**29), (64, 1), (0, 5)):
        a, b = (rng.integers(-top, top + 1, (4, dim)) for _ in range(2))
        a[0], b[0] = -top, top
        primes = hn.primes_for(max(1, dim * top * top))
        assert (hn.scores(hn.residues(a, primes), hn.residues(b, primes), primes) == a @ b.T).all()


def test_repeated_rows_empty_tables_and_other_columns(spark):
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.75, 0.0]), (2, 2, [0.75, 0.0])]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA + ", id string, block int")
    got = sorted(tuple(r) for r in hn.hard_negatives(docs).collect())
    assert got == sorted([(0, 1, k, 2, 65536, 49152) for k in (1, 2)] * 4)
    assert hn.hard_negatives(docs.limit(0)).collect() == []
    huge = spark.createDataFrame([(0, 1, [1e9, 1e9]), (50, 1, [1e9, 1e9])], SCHEMA)
    with pytest.raises(OverflowError):
        hn.hard_negatives(huge)
