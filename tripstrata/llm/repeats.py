"""Substring dedup with fixed-block anchors: runs of ``width`` words that an earlier document has are cut.

Every text is cut into blocks of ``(width + 1) // 2`` words that do not overlap; their hashes are the index. Any run of
``width`` words holds one whole block of whatever document it is compared with, so every rolling window of a block's
length probes the index, and only around hits there can be repeats. A hit is then extended in both directions, window
by window of ``width`` words: 96 bits stand for a window, the smallest key that has it is found over all documents,
and the windows that touch or overlap make up the maximal repeat.

The corpus is cut into shards of about ``shard_bytes`` of text, each one row of a staged table. A shard sends each of
its hashes once, however many of its documents have it, so that a passage in a third of all documents costs one entry
per shard. Entries are dealt by hash to buckets whose number follows the size of the corpus; a bucket answers each
shard with the hashes that count. Neither pairs of documents nor lists of their places are ever made.

Defined results: NULL and empty texts have no words; texts of fewer than ``width`` words lose nothing; documents with
equal keys do not cut each other, and a NULL key comes after all others; copies within one document stay unless an
earlier document has them too; an empty table gives an empty result. Keys are integers (others raise a ValueError).
Extra columns pass unchanged, except for those named like a result column, which the result replaces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField, StructType

from tripstrata.llm.quality import in_steps, power_tables
from tripstrata.llm.shingles import SPACE, mix
from tripstrata.sources.staging import stage_table

WIDTH = 13
SHARD_BYTES = 4_000_000
#: Bytes of text whose hashes share a bucket.
BUCKET_BYTES = 12_000_000
LEAST_BUCKETS = 8
LAST_KEY = np.iinfo(np.int64).max
RESULT = "n_words long, n_removed long, kept_sha256 string, spans array<struct<first: int, last: int>>"

#: One 64-bit value per byte, and an odd multiplier per place of a window.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def rising(values: np.ndarray) -> bytes:
    """Sorted integers as their packed differences."""
    return packed(np.diff(values, prepend=np.zeros(1, values.dtype)))


def risen(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(unpacked(data, kind), dtype=kind)


def multipliers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


def packed(values: np.ndarray) -> bytes:
    """Integers as compressed planes of their bytes."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).reshape(-1).view(kind)


#: How the windows of a shard travel: 64 bits in rising order, 32 more, and the smallest key.
PARTS = (("first", "u8", risen), ("second", "u4", unpacked), ("least", "i8", unpacked))


class Shard:
    """Words of a shard's texts: two hashes each, and for every word the end of its text."""

    def __init__(self, body: bytes, text: int, key: int) -> None:
        self.rows = pa.ipc.open_stream(body).read_all().combine_chunks()
        texts = self.rows.column(text).combine_chunks()
        keys = self.rows.column(key).combine_chunks()
        self.keys = np.asarray(keys.fill_null(LAST_KEY)).astype(np.int64)
        self.data, self.ends, begins, stops, cuts, words = [], [], [], [], [0], 0
        for _, _, data, starts, _ in in_steps(texts):
            space = SPACE[data]
            before = np.concatenate(([True], space[:-1]))
            begin, stop = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
            cuts.extend((np.append(np.searchsorted(begin, starts), len(begin))[1:] + words).tolist())
            begins.append(begin)
            stops.append(stop)
            self.data.append(data)
            words += len(begin)
        self.begins, self.stops = begins, stops
        self.cuts = np.array(cuts)
        self.row = np.repeat(np.arange(len(self.keys)), np.diff(self.cuts))
        self.place = np.arange(len(self.row)) - self.cuts[self.row]
        self.left = self.cuts[self.row + 1] - np.arange(len(self.row))  # words to the end of the text, this one included

    def hashes(self, values: np.ndarray) -> np.ndarray:
        """A hash of each word, from a value for each byte."""
        out = [np.zeros(0, np.uint64)]
        for data, begin, stop in zip(self.data, self.begins, self.stops, strict=True):
            powers, inverse = power_tables(len(data))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[data] * powers[:len(data)])))
            out.append(mix((sums[stop] - sums[begin]) * inverse[begin] + (stop - begin).astype(np.uint64)))
        return np.concatenate(out)

    @cached_property
    def first(self) -> np.ndarray:
        return self.hashes(np.arange(1, 257, dtype=np.uint64))

    @cached_property
    def second(self) -> np.ndarray:
        return self.hashes(BYTE_VALUES)

    def starts(self, size: int) -> np.ndarray:
        """Words at which ``size`` words of one text begin."""
        return np.flatnonzero(self.left >= size)

    def runs(self, hashes: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
        total = np.zeros(len(at), np.uint64)
        for k, m in enumerate(multipliers(size, seed)):
            total += hashes[at + k] * m
        return mix(total)

    def codes(self, block: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Where blocks can begin, and 48 bits for each: its bucket, then 32 bits within the bucket."""
        at = self.starts(block)
        return at, ((self.runs(self.first, at, block, 1) >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(16)

    def windows(self, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """96 bits for each window."""
        return self.runs(self.first, at, width, 2), (self.runs(self.second, at, width, 3) >> np.uint64(32)).astype(np.uint32)


def member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    k = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[k] == values


def anchored(shard: Shard, hits: np.ndarray, block: int, buckets: int, width: int) -> np.ndarray:
    """Starts of the windows that hold a block which hits the index, of other shards (``hits``) or of this one."""
    at, codes = shard.codes(block, buckets)
    own = np.unique(codes[shard.place[at] % block == 0])
    values, counts = np.unique(codes, return_counts=True)
    hit = member(codes, hits) | member(codes, own[member(own, values[counts > 1])])
    upto = np.zeros(len(shard.row) + 1, np.int64)
    upto[at + 1] = hit
    upto = np.cumsum(upto)
    starts = shard.starts(width)
    return starts[upto[starts + width - block + 1] > upto[starts]]


def split_by(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, end) of the runs of a sorted array."""
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(buckets)])), strict=True):
        if b > a:
            yield int(buckets[a]), int(a), int(b)


def to_batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def cut_shards(documents: DataFrame, text: str, key: str, shard_bytes: int) -> DataFrame:
    """(shard, n_bytes, body): staged; a body holds whole rows, in columns by number, and last the key."""
    at = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, kept, held = TaskContext.get().partitionId() << 32, [], 0

        def shard() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kept[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 5))) as out:
                for x in kept:
                    out.write_batch(x)
            return to_batch([(number, held, sink.getvalue().to_pybytes())], ["shard", "n_bytes", "body"],
                            [pa.int64(), pa.int64(), pa.binary()])

        for batch in batches:
            lengths = np.asarray(pa.compute.binary_length(batch.column(at)).fill_null(0)).astype(np.int64)
            upto, row = np.cumsum(lengths), 0
            while row < batch.num_rows:
                before = upto[row] - lengths[row]
                end = max(row + 1, int(np.searchsorted(upto, before + shard_bytes - held, "right")))
                kept.append(batch.slice(row, end - row))
                held, row = held + int(upto[end - 1] - before), end
                if held >= shard_bytes or row < batch.num_rows:
                    yield shard()
                    number, kept, held = number + 1, [], 0
        if kept:
            yield shard()

    import pyarrow.compute  # noqa: F401

    own = documents.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(documents.columns)],
                           F.col(f"`{key}`").cast("long").alias("key"))
    return stage_table(own.mapInArrow(run, "shard long, n_bytes long, body binary"), "shards")


def with_answers(shards: DataFrame, answers: DataFrame) -> DataFrame:
    """Each shard with the list of its answers, of whatever bucket."""
    gathered = answers.groupBy("shard").agg(F.collect_list("answer").alias("answers"))
    return shards.select("shard", "body").join(gathered, "shard", "left")


def block_hits(shards: DataFrame, text: int, key: int, block: int, buckets: int) -> DataFrame:
    """(shard, answer): those rolling windows of a shard that other shards have too, if a block of the index is among them."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard, rows = Shard(body.as_py(), text, key), []
                at, codes = shard.codes(block, buckets)
                probes = np.unique(codes)
                index = member(probes, np.unique(codes[shard.place[at] % block == 0]))
                for bucket, a, b in split_by(probes >> np.uint64(32)):
                    values = probes[a:b].astype(np.uint32)  # the lower 32 bits, in rising order
                    rows.append((bucket, number, rising(values),
                                 np.packbits(index[a:b]).tobytes()))
                yield to_batch(rows, ["bucket", "shard", "probes", "index"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    def meet(bucket: tuple, table: pa.Table) -> pa.Table:
        shards_here = table.column("shard").to_pylist()
        probes = [risen(x.as_py(), "u4") for x in table.column("probes")]
        blocks = [v[np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(v)).astype(bool)]
                  for v, x in zip(probes, table.column("index"), strict=True)]
        values, counts = np.unique(np.concatenate(probes), return_counts=True)
        hot = np.unique(np.concatenate(blocks))
        hot = hot[member(hot, values[counts > 1])]
        top, rows = np.uint64(bucket[0].as_py() << 32), []
        for number, own in zip(shards_here, probes, strict=True):
            found = own[member(own, hot)].astype(np.uint64)
            if len(found):
                rows.append((number, rising(found + top)))
        return pa.Table.from_batches([to_batch(rows, ["shard", "answer"], [pa.int64(), pa.binary()])])

    rows = shards.select("shard", "body").mapInArrow(entries, "bucket int, shard long, probes binary, index binary")
    return rows.groupBy("bucket").applyInArrow(meet, "shard long, answer binary")


def window_answers(shards: DataFrame, hits: DataFrame, text: int, key: int, block: int, buckets: int,
                   width: int) -> DataFrame:
    """(shard, answer): the windows of a shard that an earlier document has, with the smallest key that has them."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body, answers in zip(*(batch.column(i) for i in range(3)), strict=True):
                shard, rows = Shard(body.as_py(), text, key), []
                known = [risen(x, "u8") for x in answers.as_py() or []]
                at = anchored(shard, np.sort(np.concatenate([np.zeros(0, np.uint64), *known])), block, buckets, width)
                first, second = shard.windows(at, width)
                keys = shard.keys[shard.row[at]]
                order = np.lexsort((keys, second, first))
                first, second, keys = first[order], second[order], keys[order]
                head = np.flatnonzero(np.concatenate((np.ones(min(1, len(first)), bool), (first[1:] != first[:-1]) | (second[1:] != second[:-1]))))
                tail = np.concatenate((head[1:], [len(first)]))[:len(head)] - 1
                least, several = keys[head], keys[tail] > keys[head]
                first, second = first[head], second[head]
                for bucket, a, b in split_by(((first >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(48)):
                    rows.append((bucket, int(number.as_py()), rising(first[a:b]), packed(second[a:b]), packed(least[a:b]),
                                 np.packbits(several[a:b]).tobytes()))
                yield to_batch(rows, ["bucket", "shard", "first", "second", "least", "several"],
                               [pa.int32(), pa.int64()] + [pa.binary()] * 4)

    def meet(table: pa.Table) -> pa.Table:
        first, second, least = ([read(x.as_py(), kind) for x in table.column(name)] for name, kind, read in PARTS)
        several = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(v)).astype(bool)
                                  for x, v in zip(table.column("several"), first, strict=True)])
        sizes = np.array([len(v) for v in first])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        first, second, least = np.concatenate(first), np.concatenate(second), np.concatenate(least)
        order = np.lexsort((least, second, first))
        new = np.concatenate(([True], (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)))
        lowest = np.empty(len(order), np.int64)
        lowest[order] = least[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        told, rows = np.flatnonzero((lowest < least) | several), []
        for number, a, b in split_by(owner[told]):
            own = told[a:b]
            rows.append((table.column("shard")[number].as_py(), {
                "first": rising(first[own]), "second": packed(second[own]), "least": packed(lowest[own])}))
        return pa.Table.from_batches([to_batch(rows, ["shard", "answer"], [
            pa.int64(), pa.struct([(name, pa.binary()) for name, _, _ in PARTS])])])

    rows = with_answers(shards, hits).mapInArrow(
        entries, "bucket int, shard long, first binary, second binary, least binary, several binary")
    return rows.groupBy("bucket").applyInArrow(
        meet, "shard long, answer struct<first: binary, second: binary, least: binary>")


def covered_words(shard: Shard, answers: list[dict], width: int) -> np.ndarray:
    """Whether each word is in a window that an earlier document has."""
    covered = np.zeros(len(shard.row) + 1, np.int64)
    if answers:
        first, second, least = (np.concatenate([read(x[name], kind) for x in answers]) for name, kind, read in PARTS)
        order = np.lexsort((second, first))
        first, second, least = first[order], second[order], least[order]
        at = shard.starts(width)
        a, b = shard.windows(at, width)
        k = np.searchsorted(first, a)
        while len(at):  # once, unless different windows share their first 64 bits
            here = k < len(first)
            here[here] = first[k[here]] == a[here]
            at, a, b, k = at[here], a[here], b[here], k[here]
            gone = at[(second[k] == b) & (least[k] < shard.keys[shard.row[at]])]
            covered[gone] += 1
            covered[gone + width] -= 1
            more = second[k] != b
            at, a, b, k = at[more], a[more], b[more], k[more] + 1
    return np.cumsum(covered)[:-1] > 0


def kept_texts(shard: Shard, gone: np.ndarray) -> list[bytes]:
    """The words of each text that stay, joined by one blank."""
    data = np.concatenate([np.zeros(0, np.uint8), *shard.data])
    base = np.cumsum([0, *map(len, shard.data)])
    begin, stop = (np.concatenate([np.zeros(0, np.int64), *(x + b for x, b in zip(own, base))])
                   for own in (shard.begins, shard.stops))
    keep = np.flatnonzero(~gone)
    marks = np.zeros(len(data) + 1, np.int8)
    marks[begin[keep]] += 1
    marks[stop[keep]] -= 1
    inside = np.cumsum(marks[:-1], dtype=np.int8).astype(bool)
    rows = shard.row[keep]
    gap = stop[keep][:-1][rows[1:] == rows[:-1]]  # one byte after a word that is not the last of its text
    data[gap] = 32
    inside[gap] = True
    out, sizes = data[inside].tobytes(), np.bincount(rows, stop[keep] - begin[keep] + 1, len(shard.keys)).astype(np.int64)
    ends = np.cumsum(np.maximum(sizes - 1, 0))
    return [out[a:b] for a, b in zip(np.concatenate(([0], ends[:-1])), ends, strict=True)]


def spans_of(gone: np.ndarray, row: np.ndarray, place: np.ndarray, n: int) -> list[list[dict]]:
    """Per text the stretches of words that go, as (first, last) counted from 0."""
    at = np.flatnonzero(gone)
    out: list[list[dict]] = [[] for _ in range(n)]
    if len(at):
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(row[at]) != 0))
        for a, b in zip(at[np.concatenate(([0], cut + 1))].tolist(), at[np.concatenate((cut, [len(at) - 1]))].tolist(), strict=True):
            out[row[a]].append({"first": int(place[a]), "last": int(place[b])})
    return out


def dedup_substrings(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                     shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``documents`` without repeated runs of ``width`` words, and n_words, n_removed, kept_sha256 and spans.

    Of a text that loses words the others stay, joined by one blank; other texts stay as they are. ``kept_sha256`` is
    of the words that stay, joined by one blank; ``spans`` are the repeats that went, as numbers of their words.
    """
    if not isinstance(documents.schema[key].dataType, IntegralType):
        raise ValueError(f"{key}: an integer key is needed to tell which document comes first")
    shards = cut_shards(documents, text, key, shard_bytes)
    total = shards.agg(F.sum("n_bytes")).first()[0] or 0
    buckets, block = min(max(LEAST_BUCKETS, -(-total // bucket_bytes)), 1 << 16), (width + 1) // 2
    at, last = documents.columns.index(text), len(documents.columns)
    hits = block_hits(shards, at, last, block, buckets)
    answers = window_answers(shards, hits, at, last, block, buckets, width)

    result = StructType.fromDDL(RESULT)
    own = {f.name.lower() for f in result}
    fields = [(i, f) for i, f in enumerate(documents.schema) if f.name.lower() not in own or i == at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, answers in zip(batch.column(1), batch.column(2), strict=True):
                shard = Shard(body.as_py(), at, last)
                gone = covered_words(shard, answers.as_py() or [], width)
                n = len(shard.keys)
                words, removed = (np.bincount(x, minlength=n) for x in (shard.row, shard.row[gone]))
                kept = kept_texts(shard, gone)
                texts = shard.rows.column(at).to_pylist()
                columns = [pa.array([k.decode() if r else t for t, k, r in zip(texts, kept, removed.tolist(), strict=True)], pa.string())
                           if i == at else shard.rows.column(i).combine_chunks() for i, _ in fields]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(words), pa.array(removed), pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                               pa.array(spans_of(gone, shard.row, shard.place, n),
                                        pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))],
                    [f"c{i}" for i, _ in fields] + list(result.names))

    schema = StructType([StructField(f"c{i}", f.dataType) for i, f in fields] + list(result))
    return with_answers(shards, answers).mapInArrow(run, schema).toDF(*[f.name for _, f in fields], *result.names)
