"""Best-two-fit packing of token sequences.

Each document's ids, with an end id, are cut only where they are longer than a sequence. Full pieces
are sequences of their own. The others are dealt by a hash into groups of a few thousand, and each
group is packed by itself: a bin is filled greedily, largest piece first; then its smallest piece
gives way to two unpacked pieces that fit the widened gap more tightly, as long as that helps. Pieces of up to
a quarter of a sequence come last, each into the smallest gap that takes it, and the rest like the others. A
group leaves about one bin that is not full, so what grouping costs is below one in a thousand,
and no task holds more than a group whatever the size of the table.

Defined results: NULL and empty texts are the end id alone; keys that repeat are pieces like others;
an empty table gives an empty result; columns beside key and text are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.tokens import encoder

END_ID = 1
CAPACITY = 4096
GROUP = 4096
#: Pieces of at most this part of a sequence wait until the larger ones are packed.
SMALL_PART = 4
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long"


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text",
           end_id: int = END_ID) -> DataFrame:
    """One row per piece of at most ``capacity`` ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = encode.pack([end_id])
        for batch in batches:
            rows: list[tuple] = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(encode.encode(value.as_py()) + end, encode.dtype).astype("<u4")
                rows += [(doc, n, a, len(part := ids[a:a + capacity]), zlib.crc32(part.tobytes()))
                         for n, a in enumerate(range(0, len(ids), capacity))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                        pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select(F.col(key).cast("long"), text).mapInArrow(cut, PIECES).withColumnRenamed("doc_id", key)


class Stock:
    """Unpacked pieces by length."""

    def __init__(self, lengths: np.ndarray, capacity: int) -> None:
        self.count = np.bincount(lengths, minlength=capacity + 1)
        self.kinds = [int(x) for x in np.flatnonzero(self.count)]

    def take(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            del self.kinds[bisect_right(self.kinds, length) - 1]

    def put(self, length: int) -> None:
        if not self.count[length]:
            self.kinds.insert(bisect_right(self.kinds, length), length)
        self.count[length] += 1

    def largest(self, room: int) -> int:
        """The largest length that fits; 0 if none does."""
        k = bisect_right(self.kinds, room)
        return self.kinds[k - 1] if k else 0

    def best_two(self, room: int) -> tuple[int, int]:
        """The two lengths with the largest sum that fits; (0, 0) if no two fit."""
        small = np.array(self.kinds[:bisect_right(self.kinds, room)])
        if not len(small):
            return 0, 0
        k = np.searchsorted(small, room - small, "right") - 1
        other = np.where(k >= 0, small[np.maximum(k, 0)], 0)
        single = (other == small) & (self.count[small] < 2)  # needs two of a length that is there once
        other = np.where(single, np.where(k > 0, small[np.maximum(k - 1, 0)], 0), other)
        sums = np.where(other > 0, small + other, 0)
        i = int(np.argmax(sums))
        return (int(small[i]), int(other[i])) if sums[i] else (0, 0)


def fill_two_fit(stock: Stock, capacity: int) -> list[list[int]]:
    """Bins of all of ``stock``: greedy in falling order, then two for the smallest while that is tighter."""
    bins = []
    while stock.kinds:
        own, room = [], capacity
        while x := stock.largest(room):
            stock.take(x)
            own.append(x)
            room -= x
        while room and stock.kinds:
            least = own[-1]  # filled in falling order
            a, b = stock.best_two(room + least)
            if a + b <= least:
                break
            own.pop()
            stock.take(a)
            stock.take(b)
            stock.put(least)
            own = sorted([*own, a, b], reverse=True)
            room += least - a - b
        bins.append(own)
    return bins


def pack(lengths: np.ndarray, capacity: int = CAPACITY, small_part: int = SMALL_PART) -> list[list[int]]:
    """Bins as lists of lengths: best-two-fit of the larger pieces, then small ones, largest first, where they fit best."""
    small = lengths * small_part <= capacity
    bins = fill_two_fit(Stock(lengths[~small], capacity), capacity)
    rooms = sorted((capacity - sum(own), n) for n, own in enumerate(bins))
    left = []
    for x in np.sort(lengths[small])[::-1].tolist():
        k = bisect_left(rooms, (x, -1))
        if k == len(rooms):
            left.append(x)
            continue
        room, n = rooms.pop(k)
        bins[n].append(x)
        insort(rooms, (room - x, n))
    return bins + fill_two_fit(Stock(np.array(left, int), capacity), capacity)


def place(group: int, frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Sequence and offset of each piece of a group; pieces of equal length go in the order of their rows."""
    lengths = frame["length"].to_numpy()
    order = np.argsort(lengths, kind="stable")
    starts = np.searchsorted(lengths[order], np.arange(capacity + 2))
    used = starts[:-1].copy()
    rows, sequence, offset = [], [], []
    for number, own in enumerate(pack(lengths, capacity)):
        at = 0
        for x in own:
            rows.append(order[used[x]])
            used[x] += 1
            sequence.append((group << 32) + number)
            offset.append(at)
            at += x
    out = frame.iloc[rows].copy()
    out["sequence_id"], out["offset"] = sequence, offset
    return out


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id",
                   text: str = "text", end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """One row per piece with its sequence and its offset there, gapless from 0."""
    groups = max(1, -(-documents.count() // group))
    own = pieces(documents, tokenizer, capacity, key, text, end_id).withColumnRenamed(key, "doc_id").withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))

    def run(k: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        return place(int(k[0]), frame, capacity).drop(columns="_group")

    return own.groupBy("_group").applyInPandas(run, PLACED).withColumnRenamed("doc_id", key)
