"""Hard-negative mining with exact integer scores from a residue number system.

Vectors become integers, ``floor(scale * x)``; an anchor's score with a row is their inner product. It is computed modulo
several primes below 512 by float32 matrix products: residues are centred, so that sums over ``DEPTH`` components stay
below 2**24 and float32 holds them exactly, and the signed score comes back by Chinese remaindering with balanced
digits. The number of primes follows from the largest norms of the table.

Rows and anchors are dealt to blocks of bounded size. Every block of rows meets every block of anchors, many pairs of
blocks to a task, which keeps the best candidates per anchor only. The first pass finds the positives within labels, the
second selects negatives in the windows that the positives' scores set; window functions then merge the tasks.

Defined results: rows whose key, label or vector is NULL, and vectors that hold NULL or values that are not finite,
take no part; vectors of different length have no score with each other; a row with an anchor's key is the anchor
itself and never its positive or negative; rows that repeat are candidates of their own and anchors of their own; ties
go to the smaller key; an anchor without positives, or a positive without rows in its window, gives no row; empty tables
give an empty result; extra columns are not read. Scores that do not fit 62 bits raise an OverflowError.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripstrata.sources.staging import stage_table

SCALE = 256
EVERY = 50
POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive's score between which a negative's lies.
LOWEST, HIGHEST = 50, 95
ROWS, ANCHORS = 4096, 2048
#: Anchors whose scores with a block are held at once.
CHUNK = 256
#: Components summed in one float32 product; centred residues of primes below 512 keep the sum under 2**24.
DEPTH = 256


def primes_for(bound: int) -> list[int]:
    """Primes below 512, largest first, whose product exceeds all values from -bound to bound."""
    found, product, n = [], 1, 511
    while product <= 2 * bound + 1:
        if all(n % k for k in range(2, math.isqrt(n) + 1)):
            found.append(n)
            product *= n
        n -= 1
    return found


def centred(values: np.ndarray, p: int) -> np.ndarray:
    """Residues from -(p // 2) to p // 2."""
    r = values % p
    return np.where(r > p // 2, r - p, r)


def residues(values: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [centred(values, p).astype(np.float32) for p in primes]


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of ``left`` with all of ``right``, given their residues."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        a, b = left[k], right[k]
        total = np.zeros((len(a), len(b)), np.int32)
        for at in range(0, a.shape[1], DEPTH):
            total = (total + (a[:, at:at + DEPTH] @ b[:, at:at + DEPTH].T).astype(np.int32)) % p
        for q, digit in zip(primes[:k], digits, strict=True):  # take the lower digits off and divide by their primes
            total = (total - digit) * pow(q, -1, p) % p
        digits.append(centred(total, p))
    value = np.zeros(digits[0].shape, np.int64)
    for p, digit in zip(reversed(primes), reversed(digits), strict=True):
        value = value * p + digit
    return value


def blocks_of(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Staged blocks of about ``size`` rows of one dimension, in the order of keys, and the number of classes they are dealt to.

    A block's number is its class, then its dimension in the lower 32 bits.
    """
    count = max(1, -(-rows.count() // size))
    dealt = rows.withColumn("class", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)))

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        ids = np.asarray(table.column("id"))
        order = np.argsort(ids, kind="stable")
        flat = np.asarray(table.column("vector").combine_chunks().flatten())
        dim = key[1].as_py()
        vectors = flat.reshape(len(ids), dim)[order]
        kind = smallest(vectors)
        return pa.table({
            "block": pa.array([key[0].as_py() << 32 | dim]), "dim": pa.array([dim], pa.int32()),
            "norm": [float((vectors.astype(np.float64) ** 2).sum(axis=1).max())],
            "ids": pa.array([ids[order]], pa.list_(pa.int64())),
            "labels": pa.array([np.asarray(table.column("label"), object)[order].tolist()], pa.list_(pa.string())),
            "vectors": [vectors.astype(kind).tobytes()], "width": pa.array([kind.itemsize], pa.int32())})

    return stage_table(dealt.groupBy("class", F.size("vector").alias("dim")).applyInArrow(
        gather, "block long, dim int, norm double, ids array<long>, labels array<string>, vectors binary, width int"), "blocks"), count


def smallest(values: np.ndarray) -> np.dtype:
    """The narrowest integers that hold the values."""
    return np.min_scalar_type(-max(1, int(np.abs(values).max(initial=0))))


class Block:
    def __init__(self, row: dict) -> None:
        self.ids = np.array(row["ids"], np.int64)
        self.labels = np.array(row["labels"], object)
        self.vectors = np.frombuffer(row["vectors"], f"i{row['width']}").reshape(len(self.ids), row["dim"]).astype(np.int64)


def pairs(anchors: DataFrame, classes: int, rows: DataFrame) -> DataFrame:
    """(anchors, rows): every block of rows beside every block of anchors of the same dimension."""
    n_rows, wide = rows.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(n_rows, -(-4 * wide // classes)))
    tasks = max(1, min(classes * parts, 4 * wide))
    left = anchors.select("block", F.struct(*anchors.columns).alias("anchors"), F.explode(
        F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")).repartition(tasks, "block", "part")
    right = rows.select(
        F.struct(*rows.columns).alias("rows"), F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"), "dim",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(classes - 1).cast("long"))).alias("class")).select(
        "rows", "part", F.shiftleft("class", 32).bitwiseOR(F.col("dim").cast("long")).alias("block")).repartition(
        tasks, "block", "part")
    return left.join(right, ["block", "part"]).select("anchors", "rows")


def best(found: np.ndarray, keep: int) -> np.ndarray:
    """Of rows (anchor, window, score, id, ...) the first ``keep`` of each window by score, then by id."""
    order = np.lexsort((found[:, 3], -found[:, 2], found[:, 1], found[:, 0]))
    found = found[order]
    new = np.concatenate((np.ones(min(1, len(found)), bool), np.any(found[1:, :2] != found[:-1, :2], axis=1)))
    first = np.flatnonzero(new)
    return found[np.arange(len(found)) - np.repeat(first, np.diff(np.append(first, len(found)))) < keep]


def by_task(select, keep: int):
    """Run ``select`` on each pair of blocks and keep the best per anchor and window, for pairs of one block in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, np.zeros((0, 4), np.int64)

        def done() -> pa.RecordBatch:
            columns = [pa.array(np.full(len(held), block, np.int64))] + [pa.array(held[:, k]) for k in range(4)]
            return pa.RecordBatch.from_arrays(columns, ["block", "anchor", "window", "score", "id"])

        for batch in batches:
            for anchors, rows in zip(batch.column(0), batch.column(1), strict=True):
                own = anchors.as_py()
                if own["block"] != block:
                    if len(held):
                        yield done()
                    block, held = own["block"], np.zeros((0, 4), np.int64)
                held = best(np.concatenate([held, *select(own, Block(rows.as_py()))]), keep)
        if len(held):
            yield done()

    return run


def label_groups(labels: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    for label in sorted(set(labels.tolist())):
        yield label, np.flatnonzero(labels == label)


def positives_in(primes: list[int], keep: int):
    def select(own: dict, rows: Block) -> Iterator[np.ndarray]:
        anchors = Block(own)
        for label, at in label_groups(anchors.labels):
            among = np.flatnonzero(rows.labels == label)
            right = residues(rows.vectors[among], primes)
            for chunk in (at[i:i + CHUNK] for i in range(0, len(at), CHUNK)):
                if not len(among):
                    break
                value = scores(residues(anchors.vectors[chunk], primes), right, primes)
                order = np.argsort(-value, axis=1, kind="stable")
                for row, anchor in enumerate(chunk.tolist()):
                    first = order[row, :keep + 1]
                    first = first[rows.ids[among[first]] != anchors.ids[anchor]]
                    if len(first) < keep < len(among):  # several rows have the anchor's key
                        first = order[row][rows.ids[among[order[row]]] != anchors.ids[anchor]]
                    first = first[:keep]
                    yield np.stack([np.full(len(first), anchor), np.zeros(len(first), np.int64), value[row, first],
                                    rows.ids[among[first]]], axis=1)

    return select


def negatives_in(primes: list[int], keep: int, lowest: int, highest: int):
    def select(own: dict, rows: Block) -> Iterator[np.ndarray]:
        anchors = Block(own)
        windows: dict[int, list[tuple[int, int]]] = {}
        for w in own["windows"]:
            windows.setdefault(w["anchor"], []).append((w["window"], w["score"]))
        for label, at in label_groups(anchors.labels):
            among = np.flatnonzero(rows.labels != label)
            at = np.array([k for k in at.tolist() if k in windows], np.int64)
            right = residues(rows.vectors[among], primes)
            for chunk in (at[i:i + CHUNK] for i in range(0, len(at), CHUNK)):
                if not len(among):
                    break
                value = scores(residues(anchors.vectors[chunk], primes), right, primes)
                order = np.argsort(-value, axis=1, kind="stable")
                falling = np.take_along_axis(value, order, axis=1)
                for row, anchor in enumerate(chunk.tolist()):
                    for window, score in windows[anchor]:
                        low, high = -(-lowest * score // 100), highest * score // 100
                        a, b = np.searchsorted(-falling[row], (-high, -low + 1))
                        first = order[row, a:max(a, b)]
                        first = first[rows.ids[among[first[:keep]]] != anchors.ids[anchor]] if len(first) <= keep else \
                            first[rows.ids[among[first]] != anchors.ids[anchor]]
                        first = first[:keep]
                        yield np.stack([np.full(len(first), anchor), np.full(len(first), window), value[row, first],
                                        rows.ids[among[first]]], axis=1)

    return select


FOUND = "block long, anchor long, window long, score long, id long"


def usable(vectors: DataFrame, key: str, label: str, vector: str, scale: int) -> DataFrame:
    """(id, label, vector): rows that take part, with integer components."""
    x: Column = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.filter(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull() & x.isNotNull() & ~bad).select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
        F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("vector"))


def hard_negatives(vectors: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding",
                   every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST,
                   highest: int = HIGHEST, scale: int = SCALE, row_block: int = ROWS, anchor_block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose key ``every`` divides; their positives are their best ``positives`` other rows of the same label. For
    each, the best ``negatives`` rows of another label whose score is from ``lowest`` to ``highest`` percent of the positive's.
    """
    own = usable(vectors, key, label, vector, scale)
    rows, _ = blocks_of(own, row_block)
    anchors, classes = blocks_of(own.filter(F.col("id") % every == 0), anchor_block)
    norms = [x.agg(F.max("norm")).first()[0] or 0.0 for x in (rows, anchors)]
    bound = math.ceil(math.sqrt(norms[0]) * math.sqrt(norms[1]) * (1 + 1e-9)) + 1
    if bound >= 1 << 62:
        raise OverflowError("scores do not fit 62 bits")
    primes = primes_for(bound)

    found = pairs(anchors, classes, rows).mapInArrow(by_task(positives_in(primes, positives), positives), FOUND)
    place = F.row_number().over(W.partitionBy("block", "anchor").orderBy(F.desc("score"), "id"))
    top = stage_table(found.withColumn("window", place.cast("long")).filter(F.col("window") <= positives), "positives")
    windows = top.groupBy("block").agg(F.collect_list(F.struct("anchor", "window", "score")).alias("windows"))
    asked = stage_table(anchors.join(windows, "block").select(*anchors.columns, "windows"), "windows")
    below = pairs(asked, classes, rows).mapInArrow(by_task(negatives_in(primes, negatives, lowest, highest), negatives), FOUND)
    rank = F.row_number().over(W.partitionBy("block", "anchor", "window").orderBy(F.desc("score"), "id"))
    ranked = below.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    names = anchors.select("block", F.posexplode("ids").alias("anchor", "anchor_id")).withColumn("anchor", F.col("anchor").cast("long"))
    return ranked.select("block", "anchor", "window", "rank", F.col("id").alias("negative_id"),
                         F.col("score").alias("negative_score")).join(
        top.select("block", "anchor", "window", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        ["block", "anchor", "window"]).join(names, ["block", "anchor"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
