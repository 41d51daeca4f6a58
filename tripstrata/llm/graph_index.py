"""A hierarchical navigable small-world graph over one shard of unit vectors, searched many queries at a time.

Levels are built from the top: each holds a geometric share of the vectors, and the nodes of a level enter
its graph in batches, through the nodes that the levels above it lead to. A node keeps diverse
neighbours first (each nearer to it than to one already kept) and fills up with its nearest ones, so
that dense clusters stay connected to the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LINKS = 12
BEAM = 32
BATCH = 256
#: A beam that is full of links grows by this factor.
WIDEN = 4


def beam_search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int,
                wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (or -1) and similarities of the best ``beam`` that each query reaches, best first."""
    count, n = len(queries), len(vectors)
    seen = np.zeros((count, n), bool)
    ids = np.full((count, beam), -1, np.int64)
    sims = np.full((count, beam), -np.inf, np.float32)
    spent = np.ones((count, beam), bool)
    rows = np.arange(count)
    ids[:, 0], sims[:, 0], spent[:, 0] = entry, np.einsum("ij,ij->i", vectors[entry], queries), False
    seen[rows, entry] = True
    active = rows
    while len(active):
        open_ = ~spent[active]
        r, c = np.nonzero(open_ & (np.cumsum(open_, 1) <= wide))
        r = active[r]
        spent[r, c] = True
        near = links[ids[r, c]]
        key = (r[:, None] * n + near)[near >= 0]
        key = np.unique(key)
        r, f = key // n, key % n
        fresh = ~seen[r, f]
        r, f = r[fresh], f[fresh]
        seen[r, f] = True
        s = np.einsum("ij,ij->i", vectors[f], queries[r])
        good = s > sims[r, -1]
        r, f, s = r[good], f[good], s[good]
        if len(r):
            some, first, size = np.unique(r, return_index=True, return_counts=True)
            place = np.arange(len(r)) - np.repeat(first, size)
            line = np.repeat(np.arange(len(some)), size)
            more = (len(some), int(size.max()))
            new_ids, new_sims, new_spent = np.full(more, -1, np.int64), np.full(more, -np.inf, np.float32), np.ones(more, bool)
            new_ids[line, place], new_sims[line, place], new_spent[line, place] = f, s, False
            all_sims = np.concatenate((sims[some], new_sims), 1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[some] = np.take_along_axis(np.concatenate((ids[some], new_ids), 1), best, 1)
            spent[some] = np.take_along_axis(np.concatenate((spent[some], new_spent), 1), best, 1)
            sims[some] = np.take_along_axis(all_sims, best, 1)
        active = active[~spent[active].all(1)]
    return ids, sims


def choose(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Of candidates sorted by falling similarity (-1: none), ``keep`` neighbours for each row: diverse ones, then the nearest."""
    width = ids.shape[1]
    own = vectors[np.maximum(ids, 0)]
    between = np.einsum("bcd,bed->bce", own, own)
    taken = np.zeros(ids.shape, bool)
    for c in range(width):
        rival = np.where(taken, between[:, c], -np.inf).max(1)
        taken[:, c] = (ids[:, c] >= 0) & (sims[:, c] > rival) & (taken.sum(1) < max(1, keep * 3 // 4))
    rank = np.where(ids < 0, 2, np.where(taken, 0, 1))
    order = np.argsort(rank, axis=1, kind="stable")[:, :keep]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1) if out.shape[1] < keep else out


def ranked(vectors: np.ndarray, node: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of each node sorted by falling similarity, repeats and the node itself dropped."""
    sims = np.einsum("bcd,bd->bc", vectors[np.maximum(ids, 0)], vectors[node])
    sims = np.where((ids < 0) | (ids == node[:, None]), -np.inf, sims)
    order = np.lexsort((ids, -sims))
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    again = np.concatenate((np.zeros((len(ids), 1), bool), ids[:, 1:] == ids[:, :-1]), 1) | np.isinf(sims)
    ids, sims = np.where(again, -1, ids), np.where(again, -np.inf, sims)
    order = np.argsort(again, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


@dataclass
class Graph:
    """Unit vectors (32 bits for the search), and from the top level down each level's links (-1: none) and its entry node."""

    vectors: np.ndarray
    levels: list[np.ndarray]
    entry: int

    def start(self, queries: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        at = np.full(len(queries), self.entry)
        for links in levels:
            at = beam_search(self.vectors, links, queries, at, 1)[0][:, 0]
        return at

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        return beam_search(self.vectors, self.levels[-1], queries, self.start(queries, self.levels[:-1]), beam)


def build(vectors: np.ndarray, links: int = LINKS, beam: int = BEAM * 2, batch: int = BATCH) -> Graph:
    """Graph over ``vectors``; the same vectors in the same order give the same graph."""
    n = len(vectors)
    level = np.floor(-np.log(1 - np.random.default_rng(n).random(n)) / np.log(links)).astype(int)
    graph = Graph(vectors, [], int(np.argmax(level)))
    for depth in range(int(level.max()), -1, -1):
        nodes = np.flatnonzero(level >= depth)
        nodes = nodes[np.lexsort((nodes, -level[nodes]))]  # those that lead here first
        keep = links * 2 if depth == 0 else links
        table = np.full((n, keep), -1, np.int64)
        at = 0
        while at < len(nodes):
            new = nodes[at:at + min(batch, max(32, at))]
            inner = vectors[new] @ vectors[new].T
            np.fill_diagonal(inner, -np.inf)
            mates = np.argsort(-inner, axis=1, kind="stable")[:, :keep]
            found = [np.where(np.isinf(np.take_along_axis(inner, mates, 1)), -1, new[mates])]
            if at:
                start = graph.start(vectors[new], graph.levels)
                start = np.where(np.isin(start, nodes[:at]), start, nodes[0])
                found.append(beam_search(vectors, table, vectors[new], start, beam)[0])
            table[new] = choose(vectors, *ranked(vectors, new, np.concatenate(found, 1)), keep)
            # Neighbours link back, and choose anew among old and new ones.
            ends, owner = table[new].ravel(), np.repeat(new, keep)
            owner, ends = owner[ends >= 0], ends[ends >= 0]
            order = np.lexsort((owner, ends))
            ends, owner = ends[order], owner[order]
            some, first, size = np.unique(ends, return_index=True, return_counts=True)
            for low in range(0, len(some), batch):  # bounded steps, whatever the number of ends
                pick = slice(low, low + batch)
                width = int(size[pick].max())
                back = np.full((len(some[pick]), width), -1, np.int64)
                line = np.repeat(np.arange(len(back)), size[pick])
                inside = slice(first[low], first[low] + int(size[pick].sum()))
                back[line, np.arange(len(line)) - np.repeat(np.cumsum(size[pick]) - size[pick], size[pick])] = owner[inside]
                ids, sims = ranked(vectors, some[pick], np.concatenate((table[some[pick]], back), 1))
                table[some[pick]] = choose(vectors, ids[:, :keep * 3], sims[:, :keep * 3], keep)
            at += len(new)
        graph.levels.append(table)
    return graph


def near(graph: Graph, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of similarity ``least`` or more: beams that are full of such nodes are widened until they are not."""
    n, found, nodes = len(graph.vectors), [], []
    todo = np.arange(len(queries))
    while len(todo):
        if beam >= n:  # every node could be kept: the queries that are left are scored against all
            q, f = np.nonzero(queries[todo] @ graph.vectors.T >= least)
            found.append(todo[q])
            nodes.append(f)
            break
        ids, sims = graph.search(queries[todo], beam)
        full = sims[:, -1] >= least
        q, c = np.nonzero((sims >= least) & ~full[:, None])
        found.append(todo[q])
        nodes.append(ids[q, c])
        todo, beam = todo[full], beam * WIDEN
    return (np.concatenate(found), np.concatenate(nodes)) if found else (np.zeros(0, int), np.zeros(0, int))


@dataclass
class Audit:
    """The beam that passed, and of the audit queries' true links and nearest nodes how many the search found with it."""

    beam: int
    hits: int
    truths: int


def audited(graph: Graph, queries: np.ndarray, least: float, target: float, sample: int) -> Audit:
    """The beam at which evenly spread audit queries find ``target`` of their true links and nearest nodes.

    It starts at :data:`BEAM` (half the shard where that is smaller) and doubles after each failed audit; where the
    widest beam fails too it is the whole shard. Queries whose beam is full are widened as :func:`near` does.
    """
    own = queries[np.unique(np.linspace(0, len(queries) - 1, min(sample, len(queries))).astype(int))]
    n = len(graph.vectors)
    sims = own @ graph.vectors.T
    truth = (sims >= least) | (sims == sims.max(1, keepdims=True))
    total, beam = int(truth.sum()), max(1, min(BEAM, n // 2))
    while beam < n:
        ids, got = graph.search(own, beam)
        hit = np.zeros(truth.shape, bool)
        q, c = np.nonzero(ids >= 0)
        hit[q, ids[q, c]] = True
        full = np.flatnonzero(got[:, -1] >= least)
        if len(full):
            q, c = near(graph, own[full], least, beam * WIDEN)
            hit[full[q], c] = True
        hits = int((hit & truth).sum())
        if hits >= target * total:
            return Audit(beam, hits, total)
        beam *= 2
    return Audit(n, total, total)
