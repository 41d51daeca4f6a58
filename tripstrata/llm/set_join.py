"""Exact Jaccard self-join of the documents' shingle sets, with skipping by set relations.

1. ``signatures``: equal sets become one, by a 128-bit signature, so copies cost one row each from
   here on. The same pass counts locally frequent shingles; the most frequent of all come last in the
   common order of shingles, so that passages which many documents share stay out of the prefixes.
2. ``postings``: each distinct set lists the shingles of its prefix (what two similar sets cannot both
   miss) with its size and the position; the lists go to buckets of hashes as binary blocks.
3. ``list_pairs``: a bucket merges its blocks into inverted lists. A short list yields all its pairs
   that pass the size filter; a pair stays a candidate if its prefixes share enough in all. A long list is not paired out: its members are linked
   to the member with most copies and to their neighbour in the order of sizes, the sets most like them.
4. Pairs are verified by their exact overlap, and the verified links joined into components.
5. ``late_links``: where the members of a leader are in one component already, their answers follow from it and the group
   is skipped. Else the members meet block by block, blocks of sizes that allow no link are skipped, and a task
   returns a spanning forest of the links between components that it finds by exact overlap.

No link between different sets is lost: every similar pair meets in a list, and there either as a
candidate or through members that are connected already. Shuffled are prefixes (a quarter of the hashes),
pairs, and the sets that take part in a pair, which a bitmap of fixed size picks in the map task.

Defined results: NULL, empty and blank texts have no shingle, link with nothing and are a component of
their own; fewer words than a shingle are one shingle; repeated rows are copies; the smallest key names a
component; an empty table gives an empty result. Columns beside key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.components import connected_components
from tripstrata.llm.line_chunks import row_of
from tripstrata.llm.shingles import shingle_sets, signature
from tripstrata.llm.text import fresh
from tripstrata.sources.staging import drop_stage, stage_table

#: Similarity as a fraction, exact in integers.
PART, WHOLE = 3, 4
SHINGLE = 5
#: Lists up to so many sets are paired out.
SHORT_LIST = 6
#: Distinct shingles that a chunk of a task counts at a time, sets that make one frequent there, and how many are sent.
CHUNK, FREQUENT, MOST_FREQUENT = 2_000_000, 4, 200_000
#: Bits of the table of frequent shingles and of the table of wanted sets.
TABLE_BITS = 24
#: Posting entries per bucket, about.
BUCKET = 400_000
#: Sets in a block whose overlaps one task computes, and shingles that it takes at a time.
BLOCK, COLUMNS = 512, 2048
#: Classes beside the buckets in which what these tell meets again.
CLASSES = 11
#: Every set lists its shingles below this hash (bar frequent ones), so what two sets share there is known exactly.
BELOW = np.uint64((1 << 64) // WHOLE * (WHOLE - PART))
SIG = np.dtype([("a", "<u8"), ("b", "<u8")])
PAIRS = "a binary, b binary"


def least_overlap(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Shared members that sets of ``n`` and ``m`` need: PART/WHOLE of the union or more."""
    return -(-(n + m) * PART // (PART + WHOLE))


def probe_prefix(n: np.ndarray) -> np.ndarray:
    return n - -(-n * PART // WHOLE) + 1


def index_prefix(n: np.ndarray) -> np.ndarray:
    """Prefix that is enough for the smaller set of a pair."""
    return n - -(-2 * n * PART // (PART + WHOLE)) + 1


def signatures(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, sig) of each document, and rows (h, n) of locally frequent shingles with NULL ``sig``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def frequent() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(list(held.values())), return_counts=True)
            often = counts >= FREQUENT
            return rows([None] * int(often.sum()), counts[often], [None] * int(often.sum()), values[often].view("<i8"))

        def rows(keys, n, sigs, h) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, kind), pa.array(n, pa.int64()), pa.array(sigs, pa.binary()), pa.array(h, pa.int64())],
                ["key", "n", "sig", "h"])

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            sigs, n = [], []
            for own in shingle_sets(batch.column(1), SHINGLE):
                sigs.append(sig := signature(own) if len(own) else b"")
                n.append(len(own))
                if len(own) and sig not in held:
                    held[sig] = own
                    size += len(own)
                if size > CHUNK:
                    yield frequent()
                    held, size = {}, 0
            yield rows(batch.column(0).to_pylist(), n, sigs, [None] * len(n))
        if held:
            yield frequent()

    own = documents.select(key, text)
    return own.mapInArrow(run, f"key {dict(own.dtypes)[key]}, n long, sig binary, h long")


def table_of(hashes: np.ndarray) -> np.ndarray:
    """Bitmap of fixed size of the leading bits of ``hashes``."""
    flags = np.zeros(1 << TABLE_BITS, bool)
    flags[(hashes.view("<u8") >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
    return np.packbits(flags)


def flagged(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def postings(documents: DataFrame, text: str, late: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, block): entries of the distinct sets of each chunk of a task, as binary arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def blocks() -> pa.RecordBatch:
            sigs = np.frombuffer(b"".join(held), SIG)
            n, low = np.array([v[0] for v in held.values()], "<i8"), np.array([v[3] for v in held.values()], "<i8")
            copies = np.array([v[2] for v in held.values()], "<i8")
            each = np.array([len(v[1]) for v in held.values()])
            h = np.concatenate([v[1] for v in held.values()])
            node = np.repeat(np.arange(len(each)), each)
            pos = np.arange(len(h)) - np.repeat(np.cumsum(each) - each, each)
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            numbers, packed = [], []
            for k in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[k]:cuts[k + 1]]
                some, at = np.unique(node[own], return_inverse=True)
                head = np.array([len(some), len(own)], "<i8").tobytes()
                numbers.append(k)
                packed.append(b"".join((head, sigs[some].tobytes(), n[some].astype("<i4").tobytes(),
                                        copies[some].astype("<i4").tobytes(), low[some].astype("<i4").tobytes(), h[own].astype("<u8").tobytes(),
                                        at.astype("<i4").tobytes(), pos[own].astype("<i4").tobytes())))
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(packed, pa.binary())],
                                              ["bucket", "block"])

        for batch in batches:
            for own in shingle_sets(batch.column(0), SHINGLE):
                if not len(own):
                    continue
                sig = signature(own)
                if sig in held:
                    held[sig][2] += 1
                    continue
                last = flagged(late, own)
                ordered = np.concatenate((own[~last], own[last])) if last.any() else own
                low = int(np.searchsorted(own[~last], BELOW))
                prefix = ordered[:max(probe_prefix(len(own)), low)].copy()
                held[sig] = [len(own), prefix, 1, low]
                size += len(prefix)
                if size > CHUNK // 2:
                    yield blocks()
                    held, size = {}, 0
        if held:
            yield blocks()

    return documents.select(text).mapInArrow(run, "bucket long, block binary")


def merged(blocks: list[bytes]) -> tuple[np.ndarray, ...]:
    """Nodes (sigs, n, copies, listed below BELOW) and entries (h, node, pos) of a bucket, equal sets merged, sorted by h, n, node."""
    parts = []
    for block in blocks:
        k, m = np.frombuffer(block, "<i8", 2)
        at, out = 16, []
        for kind, count in ((SIG, k), ("<i4", k), ("<i4", k), ("<i4", k), ("<u8", m), ("<i4", m), ("<i4", m)):
            out.append(np.frombuffer(block, kind, count, at))
            at += out[-1].nbytes
        parts.append(out)
    shift = np.cumsum([0, *(len(p[0]) for p in parts)])
    sigs, first, node = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
    n = np.concatenate([p[1] for p in parts])[first].astype(np.int64)
    copies = np.bincount(node, weights=np.concatenate([p[2] for p in parts])).astype(np.int64)
    low = np.concatenate([p[3] for p in parts])[first].astype(np.int64)
    h = np.concatenate([p[4] for p in parts])
    own = node[np.concatenate([p[5] + s for p, s in zip(parts, shift[:-1], strict=True)])]
    pos = np.concatenate([p[6] for p in parts]).astype(np.int64)
    order = np.lexsort((own, n[own], h))
    h, own, pos = h[order], own[order], pos[order]
    keep = np.concatenate(([True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])))
    return sigs, n, copies, low, h[keep], own[keep], pos[keep]


#: What a bucket tells of a set: signature, size, shingles below ``BELOW``, entries in lists of two or more, in long ones.
COUNTS = np.dtype([("sig", SIG), ("n", "<i4"), ("low", "<i4"), ("shared", "<i4"), ("long", "<i4")])
#: Of a candidate: both sets with sizes and numbers listed below, and the short lists that they share.
CANDIDATE = np.dtype([("a", SIG), ("b", SIG), ("shared", "<i4"), ("n_a", "<i4"), ("n_b", "<i4"), ("low_a", "<i4"), ("low_b", "<i4")])
#: Of a set of a long list: its signature and that of the list's leader.
MEMBER = np.dtype([("sig", SIG), ("lead", SIG)])


def by_class(kind: str, told: np.ndarray, classes: int) -> list[tuple[str, int, bytes]]:
    """(kind, class, bytes): the records by a class of the signatures that they begin with."""
    if not len(told):
        return []
    words = np.frombuffer(told.tobytes(), "<u8" if not told.dtype.itemsize % 8 else "<u4").reshape(len(told), -1)
    heads = np.zeros(len(told), np.uint64)
    for k in range(words.shape[1] if kind == "member" else 32 // words.itemsize if kind == "pair" else 16 // words.itemsize):
        heads = (heads ^ words[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    heads = (heads >> np.uint64(32)) % np.uint64(classes)
    order = np.argsort(heads, kind="stable")
    cuts = np.searchsorted(heads[order], np.arange(classes + 1))
    return [(kind, int(k), told[order[cuts[k]:cuts[k + 1]]].tobytes()) for k in np.flatnonzero(np.diff(cuts))]


def list_pairs(blocks: DataFrame, classes: int) -> DataFrame:
    """(kind, class, told): what a bucket tells, packed, so that its rows do not grow with its sets.

    ``pair``    candidates, :data:`CANDIDATE`
    ``counts``  sets with an entry in a list of two or more, :data:`COUNTS`
    ``member``  sets of long lists with their leaders, :data:`MEMBER`

    ``shared`` and the counts take only shingles below ``BELOW``.
    """

    def run(frame: pa.Table) -> pa.Table:
        sigs, n, copies, low, h, node, pos = merged(frame.column("block").to_pylist())
        start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        length = np.diff(np.append(start, len(h)))
        below = h[start] < BELOW
        found, told = [np.zeros((0, 2), np.int64)], [np.zeros((0, 2), np.int64)]
        counts = [np.zeros(0, np.int64)]
        short = (length > 1) & (length <= SHORT_LIST)
        for i in range(SHORT_LIST):
            for j in range(i + 1, SHORT_LIST):
                here = short & (length > j)
                found.append(np.column_stack((node[start[here] + i], node[start[here] + j])))
                counts.append(below[here].astype(np.int64))
        # Of a similar pair the smaller set has a shared shingle in its shorter prefix: a list without such a member is skipped.
        reached = np.add.reduceat(pos < index_prefix(n[node]), start) > 0
        of = np.repeat(np.arange(len(start)), length)
        shared = np.bincount(node[((length > 1) & below)[of]], minlength=len(n))
        in_long = np.bincount(node[((length > SHORT_LIST) & below)[of]], minlength=len(n))
        members, leaders = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, k in zip(start[(length > SHORT_LIST) & reached], length[(length > SHORT_LIST) & reached], strict=True):
            own = node[a:a + k]
            lead = own[np.lexsort((own, -copies[own]))[0]]
            members.append(own)
            leaders.append(np.full(k, lead))
            told.append(np.column_stack((own[own != lead], np.full(k - 1, lead))))
            told.append(np.column_stack((own[:-1], own[1:])))
        first, second = (np.concatenate(x) for x in (found, told))
        both = np.sort(np.concatenate((first, second)), axis=1)  # by signature: nodes are numbered in its order
        counted = np.concatenate((np.concatenate(counts), np.zeros(len(second), np.int64)))
        small, large = np.minimum(n[both[:, 0]], n[both[:, 1]]), np.maximum(n[both[:, 0]], n[both[:, 1]])
        near = small * WHOLE >= large * PART
        pairs, at = np.unique(both[near], axis=0, return_inverse=True)
        together = np.bincount(at.ravel(), weights=counted[near], minlength=len(pairs)).astype(np.int64)
        own = np.unique(np.column_stack((np.concatenate(members), np.concatenate(leaders))), axis=0)
        some = np.unique(node[(length > 1)[of]])  # also those that share only beyond BELOW: their size and rest count
        counts_of, pairs_of, members_of = (np.zeros(len(x), kind) for x, kind in ((some, COUNTS), (pairs, CANDIDATE), (own, MEMBER)))
        for name, values in zip(COUNTS.names, (sigs, n, low, shared, in_long), strict=True):
            counts_of[name] = values[some]
        for side, end in enumerate(("a", "b")):
            pairs_of[end], pairs_of[f"n_{end}"], pairs_of[f"low_{end}"] = (x[pairs[:, side]] for x in (sigs, n, low))
        pairs_of["shared"] = together
        members_of["sig"], members_of["lead"] = sigs[own[:, 0]], sigs[own[:, 1]]
        rows = by_class("pair", pairs_of, classes) + by_class("counts", counts_of, classes) + by_class("member", members_of, classes)
        kinds, numbers, packed = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table([pa.array(kinds, pa.string()), pa.array(numbers, pa.int64()), pa.array(packed, pa.binary())], ["kind", "class", "told"])

    return blocks.groupBy("bucket").applyInArrow(run, "kind string, class long, told binary")


def distinct_told(table: pa.Table, kind: np.dtype, ends: int) -> tuple[np.ndarray, np.ndarray]:
    """The records of all buckets, ordered by the ``ends`` signatures that they begin with, and where each new one starts."""
    told = np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column("told")])
    keys = [told[name][half] for name in kind.names[:ends] for half in ("a", "b")]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(told), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return told[order], np.flatnonzero(new)


def named(sigs: np.ndarray) -> pa.Array:
    raw = sigs.tobytes()
    return pa.array([raw[i:i + SIG.itemsize] for i in range(0, len(raw), SIG.itemsize)], pa.binary())


def told_rows(listed: DataFrame, kind: str, run, schema: str) -> DataFrame:
    return listed.filter(f"kind = '{kind}'").select("class", "told").groupBy("class").applyInArrow(run, schema)


def set_counts(listed: DataFrame) -> DataFrame:
    """(sig, n, rest, listed, long): size, shingles that are not below ``BELOW``, entries in lists of two or more, in long ones.

    A set has one row, however many buckets tell of it.
    """

    def run(table: pa.Table) -> pa.Table:
        told, first = distinct_told(table, COUNTS, 1)
        n, low = (told[c][first].astype(np.int64) for c in ("n", "low"))
        listed, long = (np.add.reduceat(told[c].astype(np.int64), first) for c in ("shared", "long"))
        return pa.table([named(told["sig"][first]), *[pa.array(x) for x in (n, n - low, listed, long)]],
                        ["sig", "n", "rest", "listed", "long"])

    return told_rows(listed, "counts", run, "sig binary, n long, rest long, listed long, long long")


def candidate_pairs(listed: DataFrame) -> DataFrame:
    """(a, b, shared, n_a, n_b, low_a, low_b): one row per candidate, with the short lists that it shares in all buckets."""

    def run(table: pa.Table) -> pa.Table:
        told, first = distinct_told(table, CANDIDATE, 2)
        shared = np.add.reduceat(told["shared"].astype(np.int64), first)
        sizes = ("n_a", "n_b", "low_a", "low_b")
        return pa.table([named(told["a"][first]), named(told["b"][first]), pa.array(shared),
                         *[pa.array(told[c][first].astype(np.int64)) for c in sizes]], ["a", "b", "shared", *sizes])

    return told_rows(listed, "pair", run, "a binary, b binary, shared long, n_a long, n_b long, low_a long, low_b long")


def list_members(listed: DataFrame) -> DataFrame:
    """(sig, lead): one row per set of a long list and leader."""

    def run(table: pa.Table) -> pa.Table:
        told, first = distinct_told(table, MEMBER, 2)
        return pa.table([named(told["sig"][first]), named(told["lead"][first])], ["sig", "lead"])

    return told_rows(listed, "member", run, "sig binary, lead binary")


def likely_pairs(listed: DataFrame, counts: DataFrame) -> DataFrame:
    """(a, b): the candidates that share enough below ``BELOW``.

    Beyond it two sets share no more than the smaller rest. Below it, shared short lists are counted, and of long
    ones there are at most as many as the one of the two has that has fewer.
    """
    pairs = candidate_pairs(listed)
    for end in ("a", "b"):
        pairs = pairs.join(counts.filter("long > 0").select(F.col("sig").alias(end), F.col("long").alias(f"long_{end}")), end, "left")
    need = F.ceil((F.col("n_a") + F.col("n_b")) * PART / (PART + WHOLE))
    rest = F.least(F.col("n_a") - F.col("low_a"), F.col("n_b") - F.col("low_b"))
    more = F.least(F.coalesce("long_a", F.lit(0)), F.coalesce("long_b", F.lit(0)))
    return pairs.filter(F.col("shared") + more + rest >= need).select("a", "b")


def wanted_table(pairs: DataFrame) -> np.ndarray:
    """Bitmap of fixed size of the sets that take part in ``pairs``; words of it are or-ed before they reach the driver."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("sig"))
    bits = ends.select(F.conv(F.hex(F.substring("sig", 1, TABLE_BITS // 8)), 16, 10).cast("long").alias("bit"))
    words = bits.select(F.shiftright("bit", 5).alias("w"), F.expr("shiftleft(1L, int(bit % 32))").alias("bits")).groupBy(
        "w").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros((1 << TABLE_BITS) // 32, np.uint32)
    for r in words.toLocalIterator():
        out[r["w"]] = r["bits"]
    return out


def sets_in(documents: DataFrame, text: str, wanted: np.ndarray) -> DataFrame:
    """(sig, own array<long>) of the distinct sets that ``wanted`` has, once per task or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            sigs, sets = [], []
            for own in shingle_sets(batch.column(0), SHINGLE):
                if not len(own):
                    continue
                sig = signature(own)
                bit = int.from_bytes(sig[:TABLE_BITS // 8], "big")
                if wanted[bit >> 5] >> np.uint32(bit & 31) & np.uint32(1) and sig not in seen:
                    seen.add(sig)
                    sigs.append(sig)
                    sets.append(own)
            if sigs:
                flat = np.concatenate(sets).view("<i8")
                cuts = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(
                    cuts, pa.array(flat))], ["sig", "own"])

    return documents.select(text).mapInArrow(run, "sig binary, own array<long>")


def verified(pairs: DataFrame, documents: DataFrame, text: str) -> DataFrame:
    """(a, b, shared, n_a, n_b) for each of ``pairs``, by exact overlap of the two sets; a staged table."""
    sets = stage_table(sets_in(documents, text, wanted_table(pairs)).groupBy("sig").agg(
        F.first("own").alias("own")), "sets")
    left = sets.select(F.col("sig").alias("a"), F.col("own").alias("own_a"))
    right = sets.select(F.col("sig").alias("b"), F.col("own").alias("own_b"))
    checked = stage_table(pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size(F.array_intersect("own_a", "own_b")).cast("long").alias("shared"),
        F.size("own_a").cast("long").alias("n_a"), F.size("own_b").cast("long").alias("n_b")), "checked")
    drop_stage(sets)
    return checked


def linked(checked: DataFrame) -> DataFrame:
    return checked.filter(f"shared * {WHOLE} >= (n_a + n_b - shared) * {PART}").select("a", "b")


def split_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with their component, of the leaders whose members are not all in one component yet."""
    named = stage_table(members.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "component", F.coalesce("component", "sig")), "list-members")
    split = stage_table(named.groupBy("lead").agg(
        F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("lead"), "split-lists")
    return named.join(split, "lead")


def meetings(members: DataFrame) -> DataFrame:
    """``members`` once for each pair of blocks (``meet``) that they are in.

    A block is a class of sizes within a factor of 4/3 or, where a class is large, a part of it. It meets itself, the
    other parts of its class, and the parts of both neighbouring classes; all others are skipped.
    """
    rows = members.withColumn("kind", F.floor(F.log("n") / F.log(F.lit(WHOLE / PART * (1 + 1e-9)))).cast("int"))
    parts = stage_table(rows.groupBy("lead", "kind").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")), "block-parts")
    placed = rows.join(parts, ["lead", "kind"]).withColumn("part", F.pmod(F.xxhash64("sig"), "parts").cast("int"))
    after = parts.select("lead", (F.col("kind") - 1).alias("kind"), F.col("parts").alias("more"))
    before = parts.select("lead", (F.col("kind") + 1).alias("kind"), F.col("parts").alias("less"))
    met = placed.join(after, ["lead", "kind"], "left").join(before, ["lead", "kind"], "left")

    def block(kind, part):
        return F.struct(kind.cast("int").alias("kind"), part.cast("int").alias("part"))

    own = block(F.col("kind"), F.col("part"))

    def some(count, kind, first):
        each = F.when(F.coalesce(count, F.lit(0)) > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(each, lambda p: F.struct(block(kind, p), own) if first else F.struct(own, block(kind, p)))

    same = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(
        block(F.col("kind"), F.least(p, F.col("part"))), block(F.col("kind"), F.greatest(p, F.col("part")))))
    meets = F.concat(same, some(F.col("more"), F.col("kind") + 1, False), some(F.col("less"), F.col("kind") - 1, True))
    return met.select(*members.columns, F.explode(meets).alias("meet"))


def promising(members: DataFrame) -> DataFrame:
    """(lead, sig, n, component) of the members that sizes and counts allow a link to another component."""

    def run(table: pa.Table) -> pa.Table:
        n, rest, listed = (np.asarray(table.column(c)).astype(np.int64) for c in ("n", "rest", "listed"))
        component = np.unique(np.array(table.column("component").to_pylist(), object), return_inverse=True)[1]
        may = (np.minimum(listed[:, None], listed) + np.minimum(rest[:, None], rest) >= least_overlap(n[:, None], n)) & (
            component[:, None] != component) & (np.minimum(n[:, None], n) * WHOLE >= np.maximum(n[:, None], n) * PART)
        return table.select(["lead", "sig", "n", "component"]).filter(pa.array(may.any(1)))

    return meetings(members).groupBy("lead", "meet").applyInArrow(
        run, "lead binary, sig binary, n long, component binary").distinct()


def late_links(members: DataFrame, documents: DataFrame, text: str) -> DataFrame:
    """(a, b): links between different components among the members of one leader, as many as a spanning forest has.

    A task holds two blocks with their sets, computes all overlaps and returns edges of a forest, so neither pairs nor a
    whole group leave or enter it.
    """
    rows = stage_table(members, "late-members")
    wanted = wanted_table(rows.select(F.col("sig").alias("a"), F.col("sig").alias("b")))
    sets = stage_table(sets_in(documents, text, wanted).groupBy("sig").agg(F.first("own").alias("own")), "sets")
    ready = meetings(rows).join(sets, "sig").select("lead", "meet", "sig", "component", "own")

    def run(table: pa.Table) -> pa.Table:
        sig = np.array(table.column("sig").to_pylist(), object)
        component = np.unique(np.array(table.column("component").to_pylist(), object), return_inverse=True)[1]
        lists = table.column("own").combine_chunks()
        n = np.asarray(lists.value_lengths()).astype(np.int64)
        h, node = np.asarray(lists.flatten()), np.repeat(np.arange(len(n)), n)
        column = np.unique(h, return_inverse=True)[1]
        common = np.bincount(column)[column] > 1
        column, node = np.unique(column[common], return_inverse=True)[1], node[common]
        shared = np.zeros((len(n), len(n)), np.float32)
        order = np.argsort(column, kind="stable")
        column, node = column[order], node[order]
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            here = slice(*np.searchsorted(column, [low, low + COLUMNS]))
            part = np.zeros((len(n), COLUMNS), np.float32)
            part[node[here], column[here] - low] = 1
            shared += part @ part.T
        x, y = np.nonzero(np.triu(shared * WHOLE >= (n[:, None] + n[None, :] - shared) * PART, 1))
        apart = component[x] != component[y]
        x, y = x[apart], y[apart]
        # A forest over components is enough.
        root, keep = np.arange(component.max() + 1), []
        for i, (a, b) in enumerate(zip(component[x].tolist(), component[y].tolist(), strict=True)):
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            if a != b:
                root[max(a, b)] = min(a, b)
                keep.append(i)
        return pa.table({"a": pa.array(sig[x[keep]], pa.binary()), "b": pa.array(sig[y[keep]], pa.binary())})

    found = stage_table(ready.groupBy("lead", "meet").applyInArrow(run, PAIRS), "late-links")
    for done in (sets, rows):
        drop_stage(done)
    return found


def jaccard_components(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id): each document's set size and the smallest key it reaches by links."""
    rows = stage_table(signatures(documents, key, text), "signatures")
    own = rows.filter("h is null").select("key", "n", "sig")
    often = rows.filter("h is not null").groupBy("h").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "h").limit(MOST_FREQUENT).select("h")
    late = table_of(np.array([r["h"] for r in often.collect()], "<i8"))  # at most MOST_FREQUENT rows
    entries = own.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, int(entries * (WHOLE - PART) / WHOLE / BUCKET))
    listed = stage_table(list_pairs(postings(documents, text, late, buckets), buckets + CLASSES), "list-pairs")
    counts = stage_table(set_counts(listed), "set-counts")
    pairs = stage_table(likely_pairs(listed, counts), "pairs")
    checked = verified(pairs, documents, text)
    labels = stage_table(connected_components(linked(checked)), "labels")
    members = list_members(listed).join(counts, "sig")
    found = late_links(promising(split_members(members, labels)), documents, text)
    if found.limit(1).count():
        joins = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found)
        labels = stage_table(connected_components(joins), "labels")
    for done in (listed, pairs, checked, counts):
        drop_stage(done)
    named = own.filter("n > 0").join(labels.withColumnRenamed("node", "sig"), "sig", "left").select(
        "key", "n", F.coalesce("component", "sig").alias("component"))
    named = stage_table(named, "named")
    first = stage_table(named.groupBy("component").agg(F.min("key").alias("component_id")), "first-keys")
    return named.join(first, "component").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id").unionByName(
        own.filter("n = 0").select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                                   F.col("key").alias("component_id")))


def one_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each group of links the document that comes first by key (NULL before all) and text hash, and all without links.

    Rows that share only the key are documents of their own; of rows that repeat in key and text one stays. All rows whose
    texts have no words stay.
    """
    (row,) = fresh(documents, "_row")
    rows = documents.withColumn(row, row_of(key, text))
    found = stage_table(jaccard_components(rows, row, text).filter(F.col(row) == F.col("component_id")).groupBy(
        row).agg(F.count(F.lit(1)).alias("_copies"), F.max("n_shingles").alias("_n")), "kept-rows")
    once = found.filter("_copies = 1 or _n = 0").select(row)
    again = found.filter("_copies > 1 and _n > 0").select(row)
    return rows.join(once, row, "left_semi").unionByName(
        rows.join(again, row, "left_semi").dropDuplicates([row])).select(documents.columns)
