"""Importance resampling towards a target distribution, on hashed n-gram features.

A text's features are its runs of 1 to ``ORDERS`` consecutive words, dealt by CRC-32 to ``buckets``. Texts are cut into
segments at line ends, which separate words anyway: the features of a distinct line are counted and weighed once,
and stand for all its occurrences; runs of words that cross a line end are counted per document beside them. With
the sums over source and target every bucket has a gain, a document's weight is the sum of its features' gains,
and a keyed Gumbel draw on top of it samples without replacement.

Lines are grouped in the map task first, so one that a third of all documents hold is a few rows of the exchange; a
line is joined to the documents by a 128-bit hash, and the distinct side of that join has one row per line, so the
other can be split. Only the sums per bucket, a number that the parameters fix, reach the driver.

Defined results: NULL and empty texts have no features, weight 0 and are never drawn, as all texts of fewer than
``least_words`` words; a NULL key draws with the empty string and loses ties; rows that repeat in key and text are rows
of their own with equal scores; an empty target counts as no features; an empty table gives an empty result. Only
key and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.quality import in_steps
from tripstrata.operators.ordering import running_total
from tripstrata.sources.staging import stage_table

ORDERS = 3
BUCKETS = 10_000
PERCENT = 5
LEAST_WORDS = 20
#: Words up to so many bytes are hashed together, place by place; longer ones one by one.
SHORT_WORD = 48
POLYNOMIAL = 0xEDB88320


def word_bytes() -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte belongs to a word (digits, letters, not ASCII), and each byte with A-Z in lower case."""
    code = np.arange(256)
    upper = (code >= 65) & (code <= 90)
    return ((code >= 48) & (code <= 57)) | upper | ((code >= 97) & (code <= 122)) | (code >= 128), np.where(
        upper, code + 32, code).astype(np.uint8)


IN_WORD, LOWERED = word_bytes()


def byte_table() -> np.ndarray:
    """The remainder that each byte leaves."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = (c >> np.uint32(1)) ^ np.where(c & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return c


REMAINDER = byte_table()
_SHIFTS: dict[int, np.ndarray] = {}


def shift_table(n: int) -> np.ndarray:
    """What each value of each of the four bytes of a remainder becomes after ``n`` zero bytes."""
    if n not in _SHIFTS:
        c = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]).ravel()
        for _ in range(n):
            c = REMAINDER[c & np.uint32(255)] ^ (c >> np.uint32(8))
        if n > SHORT_WORD:
            return c.reshape(4, 256)
        _SHIFTS[n] = c.reshape(4, 256)
    return _SHIFTS[n]


def joined(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of concatenated strings from those of their parts and the length of the right part."""
    short = np.stack([shift_table(n) for n in range(SHORT_WORD + 1)])
    known = np.minimum(size, SHORT_WORD)
    out = right.copy()
    for k in range(4):
        out ^= short[known, k, (left >> np.uint32(8 * k)) & np.uint32(255)]
    for i in np.flatnonzero(size > SHORT_WORD).tolist():
        table, c = shift_table(int(size[i])), int(left[i])
        out[i] = right[i] ^ np.bitwise_xor.reduce([table[k, c >> 8 * k & 255] for k in range(4)])
    return out


def word_crcs(data: np.ndarray, begin: np.ndarray, size: np.ndarray, lead: bytes = b"") -> np.ndarray:
    """CRC-32 of ``lead`` and each word."""
    order = np.argsort(-size, kind="stable")
    starts, sizes = begin[order], size[order]
    state = np.full(len(order), zlib.crc32(lead) ^ 0xFFFFFFFF, np.uint32)
    long = int(np.searchsorted(-sizes, -SHORT_WORD))
    for i in range(long):
        word = data[starts[i]:starts[i] + sizes[i]].tobytes()
        state[i] = zlib.crc32(word, zlib.crc32(lead)) ^ 0xFFFFFFFF
    upto = np.searchsorted(-sizes, -np.arange(SHORT_WORD), "left")  # words longer than each place
    for k in range(int(sizes[long]) if long < len(sizes) else 0):
        own = slice(long, int(upto[k]))
        now = state[own]
        state[own] = REMAINDER[(now ^ data[starts[own] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


class Words:
    """The words of some texts: where they are, and the text and line of each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray) -> None:
        self.data = LOWERED[data]
        inside = IN_WORD[data]
        before = np.concatenate(([False], inside[:-1]))
        self.begin = np.flatnonzero(inside & ~before)
        self.size = np.flatnonzero(~inside & before) - self.begin
        self.cuts = np.append(np.searchsorted(self.begin, starts), len(self.begin))
        self.text = np.repeat(np.arange(len(starts)), np.diff(self.cuts))
        self.line = np.searchsorted(np.flatnonzero(data == 10), self.begin)

    def features(self, orders: int, buckets: int, crossing: bool) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) of each run of words; with ``crossing`` only of those that cross a line end."""
        n, texts, found = len(self.begin), [], []
        near = np.ones(n, bool)
        if crossing:  # words of runs across a line end lie less than ``orders`` words from one
            cut = np.flatnonzero(self.line[1:] != self.line[:-1])
            near[:] = False
            for k in range(-orders + 2, orders):
                near[np.clip(cut + k, 0, n - 1)] = True
        own = np.flatnonzero(near)
        plain, spaced = (np.zeros(n, np.uint32) for _ in range(2))
        plain[own] = word_crcs(self.data, self.begin[own], self.size[own])
        spaced[own] = word_crcs(self.data, self.begin[own], self.size[own], b" ")
        at, crc = own, plain[own]
        for length in range(1, orders + 1):
            if length > 1:
                end = at + length - 1
                whole = end < n
                whole[whole] = self.text[end[whole]] == self.text[at[whole]]
                whole[whole] = near[end[whole]]
                at, crc = at[whole], crc[whole]
                end = at + length - 1
                crc = joined(crc, spaced[end], self.size[end] + 1)
            kept = self.line[at] != self.line[at + length - 1] if crossing else slice(None)
            texts.append(self.text[at][kept])
            found.append((crc[kept] % np.uint32(buckets)).astype(np.int32))
        text, bucket = np.concatenate(texts), np.concatenate(found)
        order = np.argsort(text, kind="stable")
        return text[order], bucket[order]


def distinct_lines(texts: DataFrame, text: str) -> DataFrame:
    """(line, n): the distinct lines of the texts and how often each occurs."""
    lines = texts.select(F.explode(F.split(F.col(f"`{text}`"), "\n")).alias("line")).filter("line <> ''")
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def skeletons(texts: DataFrame, key: str, text: str, orders: int, buckets: int) -> DataFrame:
    """(key, n_words, n_features, lines, crossing): digests of a text's lines, and the buckets of runs across line ends."""
    own = texts.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    empty_line = re.compile(b"[^\n]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            for row, end, data, starts, ends in in_steps(batch.column(1)):
                words = Words(data, starts)
                n = end - row
                at, bucket = words.features(orders, buckets, True)
                cuts = np.searchsorted(at, np.arange(n + 1)).astype(np.int32)
                whole = data.tobytes()
                digests = [[hashlib.md5(x.group()).digest() for x in empty_line.finditer(whole, a, b - 1)]
                           for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                count = np.diff(words.cuts)
                runs = sum(np.maximum(count - k, 0) for k in range(orders))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(count), pa.array(runs),
                     pa.array(digests, pa.list_(pa.binary())), pa.ListArray.from_arrays(cuts, pa.array(bucket))],
                    ["key", "n_words", "n_features", "lines", "crossing"])

    return own.mapInArrow(run, f"key {own.schema['key'].dataType.simpleString()}, n_words long, n_features long, "
                               "lines array<binary>, crossing array<int>")


def bucket_sums(lines: DataFrame, texts: DataFrame, orders: int, buckets: int) -> np.ndarray:
    """Features per bucket: of each distinct line times its occurrences, and of the runs across line ends."""

    def summed(total: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            times = np.asarray(batch.column(1))
            for row, _, data, starts, _ in in_steps(batch.column(0)):
                at, bucket = Words(data, starts).features(orders, buckets, False)
                np.add.at(total, bucket, times[row + at])
        yield summed(total)

    def of_crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column(0).flatten()), minlength=buckets)
        yield summed(total)

    parts = lines.select("line", "n").mapInArrow(of_lines, "bucket int, n long").unionByName(
        texts.select("crossing").mapInArrow(of_crossings, "bucket int, n long"))
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floor of 1000 times the logarithm of its smoothed share in the target over that in the source."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    ratio = ((target + 1.0) * (s + n)) / ((source + 1.0) * (t + n))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def line_weights(lines: DataFrame, gain: np.ndarray, orders: int) -> DataFrame:
    """(digest, line_weight) of each distinct line."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            out = np.zeros(batch.num_rows, np.int64)
            for row, _, data, starts, _ in in_steps(batch.column(1)):
                at, bucket = Words(data, starts).features(orders, buckets, False)
                np.add.at(out, row + at, gain[bucket])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["digest", "line_weight"])

    return lines.select(F.unhex(F.md5("line")).alias("digest"), "line").mapInArrow(run, "digest binary, line_weight long")


def importance_weights(documents: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
                       target_text: str = "text", orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """(row, key, n_words, n_features, weight) of every document; ``row`` tells rows apart. Staged."""
    lines = stage_table(distinct_lines(documents, text), "distinct-lines")
    own = stage_table(skeletons(documents, key, text, orders, buckets).withColumn(
        "row", F.monotonically_increasing_id()), "skeletons")
    wanted = bucket_sums(distinct_lines(target, target_text), skeletons(target, target_text, target_text, orders, buckets),
                         orders, buckets)
    gain = gains(bucket_sums(lines, own, orders, buckets), wanted)

    def crossing_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = np.asarray(batch.column(4).offsets)
            upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(gain[np.asarray(batch.column(4).values)])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(upto[cuts[1:]] - upto[cuts[:-1]])],
                ["row", "key", "n_words", "n_features", "crossing_weight"])

    base = own.select("row", "key", "n_words", "n_features", "crossing").mapInArrow(
        crossing_weights, f"row long, key {own.schema['key'].dataType.simpleString()}, n_words long, n_features long, crossing_weight long")
    placed = own.select("row", F.explode("lines").alias("digest"))
    of_lines = placed.join(line_weights(lines, gain, orders), "digest").groupBy("row").agg(F.sum("line_weight").alias("lines_weight"))
    return stage_table(base.join(of_lines, "row", "left").select(
        "row", "key", "n_words", "n_features",
        (F.col("crossing_weight") + F.coalesce("lines_weight", F.lit(0))).alias("weight")), "weights")


def importance_resample(documents: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
                        target_text: str = "text", orders: int = ORDERS, buckets: int = BUCKETS, percent: int = PERCENT,
                        least_words: int = LEAST_WORDS, seed: int = 42) -> DataFrame:
    """(key, n_features, weight, score, rank): every document; ``rank`` from 1 for those drawn, else NULL.

    ``percent`` of the documents with at least ``least_words`` words are drawn, highest scores first, ties to smaller keys.
    """
    weighed = importance_weights(documents, target, key, text, target_text, orders, buckets)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    draw = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.withColumn("score", (F.col("weight") + draw).cast("long"))
    fit = scored.filter(F.col("n_words") >= least_words)
    order = [F.desc("score"), F.asc_nulls_last("key"), F.asc("row")]
    drawn = fit.count() * percent // 100
    ranks = running_total(fit.select("row", "key", "score", F.lit(1).cast("long").alias("one")), order, "one", "rank").filter(
        F.col("rank") <= drawn).select("row", "rank")
    return scored.join(ranks, "row", "left").select(F.col("key").alias(key), "n_features", "weight", "score", "rank")
