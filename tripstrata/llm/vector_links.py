"""Near-duplicate vectors by navigable small-world graphs per shard.

Vectors of one label are compared. Equal vectors become one with a count of copies. Each label is
dealt by hash into shards of about ``shard`` vectors; a task builds the graph of one shard and writes it as
one binary row. Then every shard queries every shard of its label: a task holds two graphs, searches
each with the vectors of the other, widens the beam until an audit against exact scores passes, and
verifies candidates by cosine in double precision. It sends back one count per vector and the
edges of a spanning forest, never the pairs, so a cluster of a third of all rows costs no more than its
vectors times shards. Components come from the forests.

Defined results: vectors that are NULL, empty, zero, or hold NULL or non-finite components, and rows
with a NULL label, link with nothing; vectors of different lengths do not link; copies link with each
other; keys must identify rows; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm import graph_index as gi
from tripstrata.llm.components import connected_components
from tripstrata.sources.staging import stage_table

COSINE = 0.98
SHARD = 2048
AUDIT, RECALL = 64, 0.98
#: What 32-bit scores may be off by.
SLACK = 1e-4
#: Queries that one step searches with.
STEP = 512


def usable(vector: str) -> Column:
    """Whether a vector has a direction."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def unit(flat: np.ndarray, n: int) -> np.ndarray:
    x = flat.astype(np.float64).reshape(n, -1)
    x = x / np.abs(x).max(1, keepdims=True)  # keeps squares within range
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def graph_rows(table: pa.Table) -> pa.Table:
    """One binary row for the vectors of a shard."""
    table = table.sort_by("rep")
    n = table.num_rows
    exact = unit(np.asarray(table.column("embedding").combine_chunks().flatten()), n)
    graph = gi.build(exact.astype(np.float32))
    data = pickle.dumps((np.asarray(table.column("rep")), np.asarray(table.column("copies")), exact, graph.levels,
                         graph.entry), protocol=5)
    return pa.table({**{c: table.column(c).slice(0, 1) for c in ("label", "dim", "shard", "shards")}, "graph": pa.array(
        [data], pa.binary())})


def found_by(graph: gi.Graph, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, gi.Audit]:
    """(query, node) of all candidates for a link, and the audit of the beam that found them."""
    audit = gi.audited(graph, queries, COSINE, RECALL, AUDIT)
    parts = [(at, gi.near(graph, queries[at:at + STEP], COSINE - SLACK, audit.beam)) for at in range(0, len(queries), STEP)]
    return np.concatenate([q + at for at, (q, _) in parts]), np.concatenate([f for _, (_, f) in parts]), audit


def search_both(left: pa.Table, right: pa.Table) -> pa.Table:
    """(rep, links, root, hits, truths): copies linked to each vector of two shards (or one), a vector it is connected
    to, and what the audits of the two searches found of how much.

    A link found from either end counts for both; a shard's size bounds the pairs that are held.
    """
    same = left.column("shard")[0] == right.column("shard")[0]
    one = pickle.loads(left.column("graph")[0].as_py())
    two = one if same else pickle.loads(right.column("graph")[0].as_py())
    n, m = len(one[0]), len(two[0])
    graphs = [gi.Graph(x[2].astype(np.float32), x[3], x[4]) for x in (one, two)]
    x, y, audit = found_by(graphs[1], graphs[0].vectors)
    v, u, other = (x, y, audit) if same else found_by(graphs[0], graphs[1].vectors)
    keys = np.unique(np.concatenate((x * m + y, u * m + v)))
    x, y = keys // m, keys % m
    if same:
        x, y = x[x < y], y[x < y]
    keep = [np.einsum("ij,ij->i", one[2][x[at:at + 65536]], two[2][y[at:at + 65536]]) >= COSINE
            for at in range(0, len(x), 65536)]
    sure = np.concatenate(keep) if keep else np.zeros(0, bool)
    x, y = x[sure], y[sure]
    first = np.bincount(x, weights=two[1][y], minlength=n).astype(np.int64)
    second = np.bincount(y, weights=one[1][x], minlength=m).astype(np.int64)
    if same:
        ids, links, root = one[0], first + second, joined(np.arange(n), x, y)
    else:
        ids, links = np.concatenate((one[0], two[0])), np.concatenate((first, second))
        root = joined(np.arange(n + m), x, n + y)
    hits, truths = (a if same else a + b for a, b in ((audit.hits, other.hits), (audit.truths, other.truths)))
    return pa.table({"rep": pa.array(ids), "links": pa.array(links), "root": pa.array(ids[root]),
                     "hits": pa.array(np.full(len(ids), hits)), "truths": pa.array(np.full(len(ids), truths))})


def search_shards(left: pa.Table, right: pa.Table) -> pa.Table:
    out = search_both(left, right)
    return out.add_column(0, "label", pa.repeat(left.column("label")[0], out.num_rows))


def joined(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest number that each node reaches once the links x - y are added."""
    while len(x):
        a, b = root[x], root[y]
        apart = a != b
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, nxt := root[root]):
            root = nxt
    return root


def vector_links(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 shard: int = SHARD) -> DataFrame:
    """(key, n_links, component_id, kept, recall): one row per vector.

    ``recall`` is the share of true links and nearest vectors that the audits of the searches around the vector's shard
    found; NULL for vectors that are not compared.
    """
    own = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("embedding"),
                         (F.col(label).isNotNull() & usable(vector)).alias("good"))
    print_ = F.concat(F.hex(F.xxhash64("embedding")), F.hex(F.xxhash64(F.lit(1), "embedding")))
    good = own.filter("good").withColumn("print", print_)
    members = stage_table(good.select("key", "label", "print"), "vector-members")
    reps = stage_table(good.groupBy("label", "print").agg(
        F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("dim", F.size("embedding")), "distinct-vectors")
    sizes = reps.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    dealt = reps.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("rep"), "shards").cast("int"))
    kind = dict(own.dtypes)
    index = stage_table(dealt.select("label", "dim", "shard", "shards", "rep", "copies", "embedding").groupBy(
        "label", "dim", "shard").applyInArrow(
        graph_rows, f"label {kind['label']}, dim int, shard int, shards int, graph binary"), "graphs")
    unit_of = ["label", "dim", "i", "j"]
    left = index.withColumn("i", F.col("shard")).withColumn("j", F.explode(F.expr("sequence(shard, shards - 1)")))
    right = index.withColumn("j", F.col("shard")).withColumn("i", F.explode(F.expr("sequence(0, shard)")))
    found = stage_table(left.groupBy(unit_of).cogroup(right.groupBy(unit_of)).applyInArrow(
        search_shards, f"label {kind['label']}, rep {kind['key']}, links long, root {kind['key']}, hits long, truths long"),
        "vector-links")
    parts = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    by_rep = found.groupBy("rep").agg(F.sum("links").alias("links"), (F.sum("hits") / F.sum("truths")).alias("recall"))
    known = stage_table(reps.select("label", "print", "rep", "copies").join(by_rep, "rep", "left").join(
        parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "print", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"), "recall"), "vector-results")
    out = members.join(known, ["label", "print"]).select("key", "n_links", "component_id", "recall").unionByName(
        own.filter("not good").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id")),
        allowMissingColumns=True)
    return out.select(F.col("key").alias(key), "n_links", "component_id",
                      F.col("key").eqNullSafe(F.col("component_id")).alias("kept"), "recall")
