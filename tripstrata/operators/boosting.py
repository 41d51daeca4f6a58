"""Boosted regression trees on binned columns, grown leaf by leaf.

Columns are cut into at most 255 bins once and stored as blocks of bytes. A tree needs one pass over the blocks for each round of
its growth: a pass sums residuals per (fit, leaf, column, bin) inside its tasks, and the driver, which sees nothing but these
sums, picks the splits. Only the smaller child of a split is summed, the larger one is its parent less it. Leaves are split
best first, up to ``max_leaves``; to need fewer passes, a round also looks into the children of all leaves that could still be
split, which changes no result. Labels split by sorted mean residual, the best of all subsets for squared error.

Several fits (settings, forward windows) share the blocks and the passes: a fit is a set of settings and the day up
to which rows belong to it. Raw predictions of all rows stay beside the blocks, on the executors; every ``REBASE`` trees
they are written to the scratch folder and read back, so that a lost executor costs the passes since then. Where a
task can hold the rows of a fit, :func:`validate` grows each fit whole in a task of its own instead, by the same steps.

Defined results: NULL and NaN magnitudes have a bin of their own, that goes to the better side, labels that are NULL or were not
seen in the fit share one; bins without rows in a node go to its larger side. A leaf of fewer than ``2 * min_rows`` rows is not
split, nor one without gain. Without rows the fit fails with a ValueError.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.session import share_package
from tripstrata.sources.staging import drop_stage, stage_table

MAX_BINS = 255
BLOCK_ROWS = 40_000
REBASE = 50
#: Partitions above which sums are added up on executors before the driver sees them.
WIDE = 64
#: Rows of a partition below which another one costs more, in sums sent to the driver, than its task saves.
SPREAD_ROWS = 16_384
#: Memory for the rows of a fit up to which it is grown whole in one task; fits on more rows share passes over all blocks.
TASK_BYTES = 256 << 20
#: Rows whose bins a task counts at once: their places stay in the processor's cache.
COUNTED_ROWS = 8192
QUANTILE_ERROR = 5e-4


@dataclass(frozen=True)
class BoostingParams:
    """One point of the search grid. Without a depth only ``max_leaves`` limits a tree."""

    max_depth: int | None = 6
    max_iter: int = 100
    learning_rate: float = 0.1
    max_leaves: int = 31
    min_rows: int = 20


@dataclass(frozen=True)
class Fit:
    """Settings, and the day (exclusive) up to which rows take part; None: all of them."""

    params: BoostingParams
    until: int | None = None


@dataclass(frozen=True)
class Bins:
    """Cuts of the magnitudes (a value belongs to the first cut it does not exceed) and the known labels."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    labels: tuple[tuple[str, ...], ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def sizes(self) -> list[int]:
        """Bins per column, the last for missing or unknown values."""
        return [len(c) + 2 for c in self.cuts] + [len(c) + 1 for c in self.labels]

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.sizes)))

    def encode(self, columns: Sequence) -> np.ndarray:
        """Bins of numpy or pandas columns in the order of :attr:`columns`, one row per column."""
        out = np.empty((len(columns), len(columns[0])), np.uint8)
        for k, cuts in enumerate(self.cuts):
            x = np.asarray(columns[k], np.float64)
            out[k] = np.where(np.isnan(x), len(cuts) + 1, np.searchsorted(np.array(cuts), x))
        for k, labels in enumerate(self.labels, len(self.cuts)):
            found = pd.Index(labels, dtype=object).get_indexer(pd.Index(columns[k], dtype=object))
            out[k] = np.where(found < 0, len(labels), found)
        return out


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; the children of a leaf are the leaf itself. ``goes_left`` has a row of bins per node."""

    column: np.ndarray
    goes_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        # Flat places: several times faster than indexes of two dimensions.
        bins = np.ascontiguousarray(bins)
        rows, node = np.arange(bins.shape[1]), np.zeros(bins.shape[1], np.intp)
        first, width = self.column.astype(np.intp) * bins.shape[1], self.goes_left.shape[1]
        flat, side = bins.ravel(), self.goes_left.ravel().view(np.uint8)
        child = np.column_stack((self.right, self.left)).astype(np.intp).ravel()
        for _ in range(self.depth):
            own = flat.take(first.take(node) + rows)
            node = child.take(2 * node + side.take(node * width + own))
        return node


def distinct_or_quantiles(rows: DataFrame, columns: Sequence[str], most: int = MAX_BINS) -> list[tuple[float, ...]]:
    """Cuts per column: between all values where they are few, else at the quantiles."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray | None] = [np.zeros(0) for _ in columns]
        for batch in batches:
            for k, x in enumerate(batch.columns):
                if found[k] is not None:
                    own = np.unique(np.append(found[k], np.asarray(x.drop_null(), np.float64)))
                    own = own[~np.isnan(own)]
                    found[k] = own if len(own) <= most else None
        yield pa.RecordBatch.from_arrays([pa.array(range(len(columns)), pa.int32()), pa.array(
            [None if x is None else x.tolist() for x in found], pa.list_(pa.float64()))], ["c", "found"])

    own = rows.select(*[F.col(c).cast("double") for c in columns])
    merged: list[set | None] = [set() for _ in columns]
    for r in own.mapInArrow(values, "c int, found array<double>").groupBy("c").agg(
            F.bool_or(F.col("found").isNull()).alias("many"), F.array_distinct(F.flatten(F.collect_list("found"))).alias("found")).collect():
        merged[r["c"]] = None if r["many"] or len(r["found"]) > most else set(r["found"])
    many = [c for c, x in zip(columns, merged, strict=True) if x is None]
    at = [k / most for k in range(1, most)]
    quantiles = dict(zip(many, own.approxQuantile(many, at, QUANTILE_ERROR), strict=True)) if many else {}
    out = []
    for c, x in zip(columns, merged, strict=True):
        known = np.array(sorted(x)) if x is not None else None
        out.append(tuple(np.unique(quantiles[c]).tolist()) if known is None else tuple(((known[1:] + known[:-1]) / 2).tolist()))
    return out


def fit_bins(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], most: int = MAX_BINS) -> Bins:
    """Bins for the columns; of labels the ``most`` most frequent, whatever is rarer counts as unknown."""
    labels = []
    for c in categorical:
        found = rows.filter(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("label")).count()
        labels.append(tuple(sorted(r["label"] for r in found.orderBy(F.desc("count"), "label").limit(most).collect())))
    return Bins(tuple(numeric), tuple(categorical), tuple(distinct_or_quantiles(rows, numeric, most)), tuple(labels))


def binned_blocks(rows: DataFrame, bins: Bins, target: str, day: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(bins, y, day): staged blocks of rows; days count from 1970-01-01."""
    share_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def block(table: pa.Table) -> pa.RecordBatch:
            columns = [x.to_pandas() for x in table.columns]
            y, days = np.asarray(columns[-2], np.float64), np.asarray(columns[-1].fillna(0), np.int32)
            known = ~np.isnan(y)
            encoded = bins.encode(columns[:-2])[:, known]
            return pa.RecordBatch.from_arrays([pa.array([encoded.tobytes()]), pa.array([y[known].tobytes()]), pa.array([days[known].tobytes()])],
                                              ["bins", "y", "day"])

        for batch in batches:
            kept.append(batch)
            while sum(b.num_rows for b in kept) >= block_rows:
                table = pa.Table.from_batches(kept)
                yield block(table.slice(0, block_rows))
                kept = table.slice(block_rows).to_batches()
        if sum(b.num_rows for b in kept):
            yield block(pa.Table.from_batches(kept))

    days = F.unix_date(F.col(day).cast("date")) if day else F.lit(0)
    own = rows.select(*[F.col(c).cast("double") for c in bins.numeric], *[F.col(c).cast("string") for c in bins.categorical],
                      F.col(target).cast("double").alias("_y"), days.alias("_day"))
    return stage_table(own.mapInArrow(run, "bins binary, y binary, day binary"), "binned")


def best_splits(n: np.ndarray, s: np.ndarray, bins: Bins, min_rows: np.ndarray) -> list[dict | None]:
    """For each row of sums (rows and residuals per bin of all columns) its best split, or None."""
    starts, sizes = bins.starts.tolist(), bins.sizes
    total_n, total_s = n[:, :sizes[0]].sum(axis=1), s[:, :sizes[0]].sum(axis=1)
    least, base = min_rows[:, None], (total_s ** 2 / np.maximum(total_n, 1))[:, None]
    # Labels by their mean; then all columns are cut side by side, each after any of its bins but the last.
    sorted_n, sorted_s, orders = n.copy(), s.copy(), {}
    for k in range(len(bins.cuts), len(sizes)):
        own = slice(starts[k], starts[k + 1])
        mean = np.where(n[:, own] > 0, s[:, own] / np.maximum(n[:, own], 1), np.inf)
        orders[k] = np.argsort(mean, axis=1, kind="stable")
        sorted_n[:, own], sorted_s[:, own] = (np.take_along_axis(x[:, own], orders[k], axis=1) for x in (n, s))
    left_n, left_s = np.empty(n.shape), np.empty(s.shape)
    for k in range(len(sizes)):
        own = slice(starts[k], starts[k + 1])
        np.cumsum(sorted_n[:, own], axis=1, out=left_n[:, own])
        np.cumsum(sorted_s[:, own], axis=1, out=left_s[:, own])
    last = np.array(starts[1:]) - 1

    def gains(left_n: np.ndarray, left_s: np.ndarray) -> np.ndarray:
        right_n, right_s = total_n[:, None] - left_n, total_s[:, None] - left_s
        gain = left_s ** 2 / np.maximum(left_n, 1) + right_s ** 2 / np.maximum(right_n, 1) - base
        gain = np.where((left_n >= least) & (right_n >= least), gain, -1.0)
        gain[:, last] = -1.0
        return gain

    sides = [(left_n, left_s, gains(left_n, left_s))]
    missing = last[:len(bins.cuts)]
    if n[:, missing].any():
        # The second half of the candidates takes missing values to the left; labels have no such candidates.
        widths, end = sizes[:len(bins.cuts)], starts[len(bins.cuts)]
        more_n, more_s = (np.concatenate((x[:, :end] + np.repeat(own[:, missing], widths, axis=1), x[:, end:]), axis=1)
                          for x, own in ((left_n, n), (left_s, s)))
        gain = gains(more_n, more_s)
        gain[:, end:] = -1.0
        sides.append((more_n, more_s, gain))
    highest = np.maximum.reduce([np.maximum.reduceat(gain, starts[:-1], axis=1) for _, _, gain in sides])
    best_gain, best_column = np.zeros(len(n)), np.full(len(n), -1)
    for k in range(len(sizes)):
        better = highest[:, k] > best_gain + 1e-9 * np.abs(best_gain) + 1e-12
        best_gain, best_column = np.where(better, highest[:, k], best_gain), np.where(better, k, best_column)
    out: list[dict | None] = []
    for i, k in enumerate(best_column.tolist()):
        if k < 0:
            out.append(None)
            continue
        own, left, regular = slice(starts[k], starts[k + 1]), np.zeros(MAX_BINS + 2, bool), sizes[k] - 1
        at, half = max(((int(gain[i, own].argmax()), h) for h, (_, _, gain) in enumerate(sides)),
                       key=lambda x: (sides[x[1]][2][i, starts[k] + x[0]], -x[1]))
        own_n, a_n, a_s = n[i, own], sides[half][0][i, starts[k] + at], sides[half][1][i, starts[k] + at]
        if k < len(bins.cuts):
            left[:at + 1] = True
            left[regular] = half == 1
            open_bins = np.array([regular] if not own_n[-1] else [], int)
        else:
            left[orders[k][i, :at + 1]] = True
            open_bins = np.flatnonzero(own_n == 0)
        left[open_bins] = a_n >= total_n[i] - a_n
        out.append({"gain": float(best_gain[i]), "column": k, "left": left, "n": (float(a_n), float(total_n[i] - a_n)),
                    "s": (float(a_s), float(total_s[i] - a_s))})
    return out


class Growing:
    """A tree while it grows: all nodes opened so far, and their best splits as far as they are known."""

    def __init__(self, params: BoostingParams) -> None:
        self.params = params
        self.children: dict[int, tuple[int, int]] = {}
        self.split: dict[int, dict | None] = {}
        self.sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.level, self.rows, self.total = [0], [0.0], [0.0]
        self.asked = [0]  # nodes whose sums the next pass computes
        self.order: list[int] | None = None  # nodes that are split, once the tree is complete

    def may_split(self, node: int) -> bool:
        deep = self.params.max_depth is not None and self.level[node] >= self.params.max_depth
        return not deep and self.rows[node] >= 2 * self.params.min_rows

    def open(self, node: int) -> None:
        split = self.split[node]
        self.children[node] = (len(self.level), len(self.level) + 1)
        for side in range(2):
            self.level.append(self.level[node] + 1)
            self.rows.append(split["n"][side])
            self.total.append(split["s"][side])

    def replay(self) -> tuple[list[int], list[int], int]:
        """Splits in the order best first, as far as gains are known; the leaves then, best first, and the splits left."""
        done, leaves, left = [], [0], self.params.max_leaves - 1
        while left:
            known = [k for k in leaves if self.split.get(k)]
            if not known:
                return done, [], 0
            top = max(known, key=lambda k: (self.split[k]["gain"], -k))
            if left == 1 and top not in self.children:
                self.open(top)
            if top not in self.children:
                return done, sorted(known, key=lambda k: (-self.split[k]["gain"], k)), left
            done.append(top)
            left -= 1
            leaves = [k for k in leaves if k != top] + list(self.children[top])
            if any(k not in self.split and self.may_split(k) for k in self.children[top]) and left:
                return done, [], -1
        return done, [], 0

    def next_round(self) -> None:
        """Open all leaves that could still be split, and ask for the smaller child of each, until the tree is complete."""
        self.asked = []
        while not self.asked:
            done, known, left = self.replay()
            if not left:
                self.order = done
                return
            unopened = [k for k, split in self.split.items() if split and k not in self.children]
            unopened.sort(key=lambda k: (-self.split[k]["gain"], k))
            for node in known[:left] if left > 0 else unopened[:self.params.max_leaves - 1 - len(done)]:
                if node not in self.children:
                    self.open(node)
            for a, b in self.children.values():
                if a not in self.split and b not in self.split:
                    if self.may_split(a) or self.may_split(b):
                        self.asked.append(a if self.rows[a] <= self.rows[b] else b)
                    else:
                        self.split[a] = self.split[b] = None

    def answer(self, sums: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Nodes whose splits can be searched now, with their sums."""
        out = []
        parent = {c: p for p, own in self.children.items() for c in own}
        for node, own in zip(self.asked, sums, strict=True):
            nodes = [(node, own)]
            if node:
                a, b = self.children[parent[node]]
                rest = tuple(x - y for x, y in zip(self.sums.pop(parent[node]), own, strict=True))
                nodes.append((b if node == a else a, rest))
            for k, x in nodes:
                if k and not self.may_split(k):
                    self.split[k] = None
                else:
                    self.sums[k] = x
                    out.append((k, *x))
        return out

    def tree(self, nodes: list[int] | None = None) -> Tree:
        """The nodes opened so far, or only the splits of ``nodes``, with the values of the leaves."""
        split = set(self.children) if nodes is None else set(nodes)
        kept, at = [0], 0
        while at < len(kept):
            kept += self.children[kept[at]] if kept[at] in split else ()
            at += 1
        number = {k: i for i, k in enumerate(kept)}
        self.number = number
        column, left, right = np.zeros(len(kept), np.int32), np.arange(len(kept), dtype=np.int32), np.arange(len(kept), dtype=np.int32)
        goes_left = np.zeros((len(kept), MAX_BINS + 2), bool)
        for k in kept:
            if k in split:
                column[number[k]], goes_left[number[k]] = self.split[k]["column"], self.split[k]["left"]
                left[number[k]], right[number[k]] = (number[c] for c in self.children[k])
        value = np.array([self.params.learning_rate * self.total[k] / max(self.rows[k], 1.0) for k in kept])
        return Tree(column, goes_left, left, right, value, max(self.level[k] for k in kept))


def _decode(columns: int, fits: int):
    def run(row) -> tuple:
        y = np.frombuffer(row["y"], np.float64)
        raw = np.frombuffer(row["raw"], np.float64).reshape(fits, -1) if "raw" in row else None
        return np.frombuffer(row["bins"], np.uint8).reshape(columns, -1), y, np.frombuffer(row["day"], np.int32), raw

    return run


def _members(day: np.ndarray, until: int | None) -> np.ndarray:
    return np.ones(len(day), bool) if until is None else day < until


def total_of(parts: RDD) -> np.ndarray:
    """The sum of arrays, one per partition."""
    if parts.getNumPartitions() > WIDE:
        return parts.treeReduce(np.add, 2)
    return sum(parts.collect())


def packed_counts(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the smallest type that holds them, and residuals: what a task sends."""
    return sums[0].astype(np.min_scalar_type(int(sums[0].max(initial=0)))), sums[1]


def add_counts(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0].astype(float) + b[0], a[1] + b[1]


def _sums(blocks: RDD, todo: list[tuple], starts: list[int]) -> np.ndarray:
    """(2, slots, bins): rows and residuals of the asked nodes of all fits, fit after fit."""

    def run(part: Iterator[tuple]) -> Iterator[np.ndarray]:
        width = starts[-1]
        total = np.zeros((2, sum(len(nodes) for _, _, _, nodes in todo), width))
        begin = np.array(starts[:-1], np.int64)[:, None]
        for bins, y, day, raw in part:
            first, known = 0, {}
            for fit, until, tree, nodes in todo:
                if until not in known:
                    members = np.flatnonzero(_members(day, until))
                    known[until] = members, bins if len(members) == len(y) else bins[:, members]
                members, own = known[until]
                slot_of = np.full(len(tree.column), -1, np.int64)
                slot_of[nodes] = np.arange(len(nodes))
                slot = slot_of[tree.node_of(own)]
                asked = np.flatnonzero(slot >= 0)
                rows = members[asked]
                # All columns are counted at once: a bin of a column has its own place in the row of a node.
                key = (own[:, asked] + begin + slot[asked] * width).ravel()
                residual = np.tile((y - raw[fit])[rows], len(own))
                for i, weights in enumerate((None, residual)):
                    total[i, first:first + len(nodes)] += np.bincount(key, weights, len(nodes) * width).reshape(len(nodes), width)
                first += len(nodes)
        yield packed_counts(total)

    parts = blocks.mapPartitions(run)
    wide = parts.getNumPartitions() > WIDE
    return np.stack(parts.treeReduce(add_counts, 2) if wide else reduce(add_counts, parts.collect())).astype(float)


def search(asked: Sequence[tuple[Growing, list[tuple[np.ndarray, np.ndarray]]]], bins: Bins) -> None:
    """Take the sums that growing trees asked for, find the splits, and let the trees ask for more."""
    searched = [(g, *x) for g, sums in asked for x in g.answer(sums)]
    if searched:
        splits = best_splits(np.stack([x[2] for x in searched]), np.stack([x[3] for x in searched]), bins,
                             np.array([x[0].params.min_rows for x in searched], float))
        for (g, node, n, s), split in zip(searched, splits, strict=True):
            g.split[node] = split
            if not node:
                # Every column sums to the whole of a node; the first one stands for it.
                size = bins.sizes[0]
                g.rows[0], g.total[0] = float(n[:size].sum()), float(s[:size].sum())
    for g, _ in asked:
        g.next_round()


def grow(blocks: RDD, bins: Bins, fits: Sequence[Fit], active: Sequence[int]) -> dict[int, Tree]:
    """The next tree of each active fit."""
    growing = {k: Growing(fits[k].params) for k in active}
    starts = bins.starts.tolist()
    while waiting := {k: g for k, g in growing.items() if g.asked}:
        todo = []
        for k, g in waiting.items():
            tree = g.tree()
            todo.append((k, fits[k].until, tree, [g.number[node] for node in g.asked]))
        sums, first, asked = _sums(blocks, todo, starts), 0, []
        for g in waiting.values():
            own = sums[:, first:first + len(g.asked)]
            first += len(g.asked)
            asked.append((g, [(own[0, i], own[1, i]) for i in range(len(g.asked))]))
        search(asked, bins)
    return {k: g.tree(g.order) for k, g in growing.items()}


class HeldRows:
    """Rows of one fit that a task holds; those of a node of the growing tree stand together in ``order``."""

    #: Bytes a row besides twice its bins: residual, place, and what a split of all rows needs for a while.
    OWN_BYTES = 40

    def __init__(self, encoded: np.ndarray, residual: np.ndarray, bins: Bins) -> None:
        self.bins, self.columns, self.rows, self.residual = bins, encoded, np.ascontiguousarray(encoded.T), residual
        self.first, self.width = bins.starts[:-1], int(bins.starts[-1])

    def sums(self, node: int) -> tuple[np.ndarray, np.ndarray]:
        n, s = np.zeros(self.width), np.zeros(self.width)
        begin, end = self.span[node]
        for at in range(begin, end, COUNTED_ROWS):
            own = self.order[at:min(end, at + COUNTED_ROWS)]
            key = (self.rows.take(own, axis=0) + self.first).ravel()
            n += np.bincount(key, None, self.width)
            s += np.bincount(key, self.residual.take(own).repeat(len(self.first)), self.width)
        return n, s

    def part(self, node: int, split: dict, children: tuple[int, int]) -> None:
        begin, end = self.span[node]
        own = self.order[begin:end]
        left = split["left"].take(self.columns[split["column"]].take(own))
        first, second = own[left], own[~left]
        self.order[begin:begin + len(first)], self.order[begin + len(first):end] = first, second
        self.span |= {children[0]: (begin, begin + len(first)), children[1]: (begin + len(first), end)}

    def grow(self, params: BoostingParams) -> Tree:
        """The next tree; its values leave the residuals."""
        g, parted = Growing(params), set()
        self.order, self.span = np.arange(len(self.residual), dtype=np.int32), {0: (0, len(self.residual))}

        def follow() -> None:
            for node in g.children.keys() - parted:
                parted.add(node)
                self.part(node, g.split[node], g.children[node])

        while g.asked:
            search([(g, [self.sums(node) for node in g.asked])], self.bins)
            follow()
        tree = g.tree(g.order)
        for node, at in g.number.items():
            if tree.left[at] == at:
                begin, end = self.span[node]
                self.residual[self.order[begin:end]] -= tree.value[at]
        return tree


def train(blocks: DataFrame, bins: Bins, fits: Sequence[Fit]) -> tuple[list[BoostedTrees], RDD]:
    """The models of all fits, and the blocks with the raw predictions of each (persisted: unpersist after use)."""
    spark, columns = blocks.sparkSession, len(bins.columns)
    share_package(spark)
    size = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("y")), F.lit(0))).first()
    count = size[0]
    rows = blocks.rdd.map(_decode(columns, len(fits)))
    # A pass sums all its fits in a task, so each of them counts as rows of its own.
    wanted = -(-size[1] // 8 // SPREAD_ROWS)
    spread = max(1, min(count, wanted, spark.sparkContext.defaultParallelism))
    if rows.getNumPartitions() < spread:
        rows = rows.repartition(spread)
    untils = [f.until for f in fits]

    def first(part: Iterator[tuple]) -> Iterator[np.ndarray]:
        out = np.zeros((2, len(untils)))
        for _, y, day, _ in part:
            for k, until in enumerate(untils):
                own = _members(day, until)
                out[:, k] += own.sum(), y[own].sum()
        yield out

    found = total_of(rows.mapPartitions(first)) if count else np.zeros((2, len(fits)))
    if not (np.asarray(found)[0] > 0).all():
        raise ValueError("a fit has no rows")
    base = (found[1] / found[0]).tolist()
    state = rows.map(lambda b: (b[0], b[1], b[2], np.repeat(np.array(base)[:, None], len(b[1]), axis=1)))
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[list[Tree]] = [[] for _ in fits]
    stages, sent, before = [], [], []
    for number in range(max(f.params.max_iter for f in fits)):
        active = [k for k, f in enumerate(fits) if f.params.max_iter > number]
        grown = grow(state, bins, fits, active)
        for x in before:
            x.unpersist()
        before = []
        for k, tree in grown.items():
            trees[k].append(tree)
        shared = spark.sparkContext.broadcast(grown)
        sent.append(shared)

        def add(block: tuple, shared=shared) -> tuple:
            encoded, y, day, raw = block
            raw = raw.copy()
            for k, tree in shared.value.items():
                raw[k] += tree.value[tree.node_of(encoded)]
            return encoded, y, day, raw

        # The next pass computes it, and only then can the one before it go.
        before, state = before + [state], state.map(add).persist(StorageLevel.MEMORY_AND_DISK)
        if (number + 1) % REBASE == 0:
            written = stage_table(spark.createDataFrame(
                state.map(lambda b: (b[0].tobytes(), b[1].tobytes(), b[2].tobytes(), b[3].tobytes())),
                "bins binary, y binary, day binary, raw binary"), "boosted")
            for x in (*before, state):
                x.unpersist()
            for x in sent:
                x.destroy()
            for x in stages:
                drop_stage(x)
            state = written.rdd.map(_decode(columns, len(fits)))
            state = (state.repartition(spread) if state.getNumPartitions() < spread else state).persist(StorageLevel.MEMORY_AND_DISK)
            before, sent, stages = [], [], [written]
    state.count()
    for x in before:
        x.unpersist()
    models = [BoostedTrees(bins, base[k], tuple(trees[k]), fits[k].params) for k in range(len(fits))]
    return models, state


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model; ``transform`` adds ``pred_log``."""

    bins: Bins
    base: float
    trees: tuple[Tree, ...]
    params: BoostingParams
    output: str = "pred_log"

    def raw(self, encoded: np.ndarray) -> np.ndarray:
        out = np.full(encoded.shape[1], self.base)
        for tree in self.trees:
            out += tree.value[tree.node_of(encoded)]
        return out

    def exchanged(self, encoded: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Raw predictions: those of the rows first, then for each column with its bins taken from ``other``."""
        out = np.full((1 + len(encoded), encoded.shape[1]), self.base)
        for tree in self.trees:
            used = np.unique(tree.column[tree.left != np.arange(len(tree.left))])
            several = np.tile(encoded, 1 + len(used)).reshape(len(encoded), 1 + len(used), -1)
            several[used, np.arange(1, 1 + len(used))] = other[used]
            value = tree.value[tree.node_of(several.reshape(len(encoded), -1))].reshape(1 + len(used), -1)
            out[1 + used] += value[1:] - value[0]
            out += value[0]
        return out

    def transform(self, rows: DataFrame) -> DataFrame:
        share_package(rows.sparkSession)
        shared = rows.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            model = shared.value
            for own in parts:
                yield pd.Series(model.raw(model.bins.encode(own)))

        return rows.withColumn(self.output, score(
            *[F.col(c).cast("double") for c in self.bins.numeric], *[F.col(c).cast("string") for c in self.bins.categorical]))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row with the model as JSON."""
        trees = [{"column": t.column.tolist(), "left": t.left.tolist(), "right": t.right.tolist(), "value": t.value.tolist(),
                  "depth": t.depth, "goes_left": [np.flatnonzero(x).tolist() for x in t.goes_left]} for t in self.trees]
        whole = json.dumps({"bins": asdict(self.bins), "base": self.base, "params": asdict(self.params), "trees": trees, "output": self.output})
        spark.createDataFrame([(whole,)], "model string").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        own = json.loads(spark.read.parquet(path).first()["model"])
        bins = Bins(*[tuple(map(tuple, own["bins"][c])) if c in ("cuts", "labels") else tuple(own["bins"][c])
                      for c in ("numeric", "categorical", "cuts", "labels")])
        trees = []
        for t in own["trees"]:
            goes_left = np.zeros((len(t["column"]), MAX_BINS + 2), bool)
            for row, places in zip(goes_left, t["goes_left"], strict=True):
                row[places] = True
            trees.append(Tree(np.array(t["column"], np.int32), goes_left, np.array(t["left"], np.int32), np.array(t["right"], np.int32),
                              np.array(t["value"], float), t["depth"]))
        return BoostedTrees(bins, own["base"], tuple(trees), BoostingParams(**own["params"]), own["output"])


def fit_boosting(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
                 params: BoostingParams = BoostingParams()) -> BoostedTrees:
    """One fit on all rows; rows without a target take no part."""
    bins = fit_bins(rows, numeric, categorical)
    blocks = binned_blocks(rows, bins, target)
    models, state = train(blocks, bins, [Fit(params)])
    state.unpersist()
    drop_stage(blocks)
    return models[0]


def validate(blocks: DataFrame, bins: Bins, fits: Sequence[Fit], checks: Sequence[tuple[int, int]], low: float, high: float,
             task_bytes: int = TASK_BYTES) -> tuple[list, list[float]]:
    """What :func:`forward_errors` says of the fits, without their models.

    Passes are small jobs, thousands for a grid, that mostly wait. So where a task can hold the rows of a fit, each fit is grown whole in a task
    of its own, all in one job; only fits on more rows share passes. Both ways grow the same trees.
    """
    share_package(blocks.sparkSession)
    columns, fits, checks = len(bins.columns), list(fits), list(checks)

    def count(part: Iterator[tuple]) -> Iterator[np.ndarray]:
        out = np.zeros((2, len(fits)))
        for _, y, day, _ in part:
            for k, (fit, (start, end)) in enumerate(zip(fits, checks, strict=True)):
                own = _members(day, fit.until)
                out[:, k] += own.sum(), (own | (day >= start) & (day < end)).sum()
        yield out

    rows, held = np.broadcast_to(total_of(blocks.rdd.map(_decode(columns, 0)).mapPartitions(count)), (2, len(fits)))
    if not (rows > 0).all():
        raise ValueError("a fit has no rows")
    if held.max() * (2 * columns + HeldRows.OWN_BYTES) > task_bytes:
        _, state = train(blocks, bins, fits)
        found = forward_errors(state, checks, low, high)
        state.unpersist()
        return found

    def whole(k: int):
        fit, (start, end) = fits[k], checks[k]

        def run(part: Iterator[tuple]) -> Iterator[tuple[int, int, float]]:
            own, later = [], []
            for encoded, y, day, _ in part:
                for kept, chosen in ((own, _members(day, fit.until)), (later, (day >= start) & (day < end))):
                    kept.append((encoded[:, chosen], y[chosen]))
            (encoded, y), (asked, real) = ([np.concatenate(x, axis=-1) for x in zip(*kept, strict=True)] for kept in (own, later))
            del own, later
            base = float(y.sum() / len(y))
            held = HeldRows(encoded, y - base, bins)
            trees = tuple(held.grow(fit.params) for _ in range(fit.params.max_iter))
            model, squares = BoostedTrees(bins, base, trees, fit.params), 0.0
            for at in range(0, len(real), BLOCK_ROWS):
                raw = np.clip(model.raw(asked[:, at:at + BLOCK_ROWS]), np.log1p(low), np.log1p(high))
                squares += float(((raw - real[at:at + BLOCK_ROWS]) ** 2).sum())
            yield k, len(real), squares

        return run

    one = blocks.coalesce(1).rdd.map(_decode(columns, 0))
    # The longest first, so that the last ones to end are short.
    longest = sorted(range(len(fits)), key=lambda k: -rows[k] * fits[k].params.max_iter)
    found = {k: x for k, *x in blocks.sparkSession.sparkContext.union([one.mapPartitions(whole(k)) for k in longest]).collect()}
    n, squares = np.array([found[k] for k in range(len(fits))]).T
    return n.tolist(), np.sqrt(squares / np.maximum(n, 1)).tolist()


def forward_errors(state: RDD, checks: Sequence[tuple[int, int]], low: float, high: float) -> tuple[list, list[float]]:
    """Rows, and root mean squared error of each fit on the log scale, from its first day to its last (exclusive).

    Predictions are held between ``low`` and ``high`` on the plain scale.
    """

    def run(part: Iterator[tuple]) -> Iterator[np.ndarray]:
        out = np.zeros((2, len(checks)))
        for _, y, day, raw in part:
            for k, (start, end) in enumerate(checks):
                own = (day >= start) & (day < end)
                miss = np.clip(raw[k][own], np.log1p(low), np.log1p(high)) - y[own]
                out[:, k] += own.sum(), (miss ** 2).sum()
        yield out

    n, squares = total_of(state.mapPartitions(run))
    return n.tolist(), np.sqrt(squares / np.maximum(n, 1)).tolist()
