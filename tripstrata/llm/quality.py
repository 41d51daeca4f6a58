"""Document quality by a regularised quadratic discriminant over transformed text statistics.

``statistics`` turns each whole text into some twenty shares, means and logarithms, all computed
on byte arrays inside the tasks. ``fit`` needs two aggregates of Spark over the labelled rows: per class the
count, the mean and the cross products. Each class covariance is shrunk towards the pooled one and
towards a multiple of the identity, and its Cholesky factor is kept in the model. ``score`` is the
logistic function of the difference of the log densities, which are Mahalanobis distances by
triangular solves, plus the log ratio of the class shares.

Defined results: NULL and empty texts have statistics of zero and are scored like others; labels
that are NULL or neither 0 nor 1 are left out of the fit; without labels of both classes every score
is the share of label 1 (0.5 without any label); rows that repeat are scored alike and each
counts in the fit; an empty table gives an empty result. Columns beside key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAMES = ("words", "chars_per_word", "word_length_spread", "long_words", "upper", "digits", "ends", "commas", "shouts",
         "symbols", "bars", "quotes", "lines", "capital_words", "all_upper_words", "repeated_next", "repeated_any",
         "marked_words", "wide_bytes", "other_controls")
POOLED, IDENTITY = 0.15, 0.05
THRESHOLD = 0.3
#: Bytes that one step of the statistics holds arrays for.
STEP = 2_000_000
UPPER, LOWER, DIGIT, END, COMMA, SHOUT, SYMBOL, BAR, QUOTE, BLANK, CONTROL, WIDE = range(1, 13)


def byte_classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for name, chars in ((UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (LOWER, "abcdefghijklmnopqrstuvwxyz"), (DIGIT, "0123456789"),
                        (END, ".?"), (COMMA, ",;:"), (SHOUT, "!"), (SYMBOL, "#$%&*+/<=>@\\^_`~[]{}"), (BAR, "|"),
                        (QUOTE, "\"'()-"), (BLANK, " \t\n\r\v\f")):
        table[[ord(c) for c in chars]] = name
    table[[b for b in range(32) if chr(b) not in "\t\n\r\v\f"] + [127]] = CONTROL
    table[128:] = WIDE
    return table


CLASSES = byte_classes()


def measure(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The statistics of texts that lie in ``data`` at ``starts`` .. ``ends``, without gaps, each ending in a blank."""
    n = len(starts)
    kind = CLASSES[data]
    doc = np.repeat(np.arange(n), ends - starts)
    counts = np.bincount(doc * 13 + kind, minlength=13 * n).reshape(n, 13).astype(float)
    blank = kind == BLANK
    before = np.concatenate(([True], blank[:-1]))
    begin, stop = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    owner = doc[begin]
    words = np.bincount(owner, minlength=n).astype(float)
    some = np.maximum(words, 1)

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=n) / some

    # Characters, not bytes: bytes that continue a character are not counted.
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    length = (chars[stop] - chars[begin]).astype(float)
    mean = per_word(length)
    spread = np.sqrt(np.maximum(per_word(length ** 2) - mean ** 2, 0))
    uppers = np.concatenate(([0], np.cumsum(kind == UPPER)))
    lowers = np.concatenate(([0], np.cumsum(kind == LOWER)))
    has_upper, has_lower = uppers[stop] > uppers[begin], lowers[stop] > lowers[begin]
    odd = np.concatenate(([0], np.cumsum((kind == SYMBOL) | (kind == SHOUT) | (kind == BAR))))
    # A hash of each word from prefix sums of byte times power, brought to a common power by the inverse one.
    powers, inverse = power_tables(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)])))
    word = (sums[stop] - sums[begin]) * inverse[begin]
    again = np.concatenate(([False], (word[1:] == word[:-1]) & (owner[1:] == owner[:-1]))) if len(word) else np.zeros(0, bool)
    order = np.lexsort((word, owner))
    same = (word[order][1:] == word[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    repeats = np.bincount(owner[order][1:][same], minlength=n) if len(order) else np.zeros(n)
    size = np.maximum(counts.sum(1), 1)
    lines = np.bincount(doc[data == 10], minlength=n)

    def share(*names: int) -> np.ndarray:
        return np.sqrt(sum(counts[:, x] for x in names) / size)

    return np.column_stack((
        np.log1p(words), np.log1p(mean), np.log1p(spread), np.sqrt(per_word(length > 20)), share(UPPER), share(DIGIT),
        share(END), share(COMMA), share(SHOUT), share(SYMBOL), share(BAR), share(QUOTE), np.sqrt(lines / some),
        np.sqrt(per_word(has_upper)), np.sqrt(per_word(has_upper & ~has_lower & (length > 1))), np.sqrt(per_word(again)),
        np.sqrt(repeats / some), np.sqrt(per_word(odd[stop] > odd[begin])), share(WIDE), share(CONTROL)))


_POWERS: list[np.ndarray] = []
#: An odd multiplier and its inverse modulo 2**64.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n`` of each, kept by the worker."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, STEP + STEP // 4)
        _POWERS[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, f, np.uint64))))
                      for f in (FACTOR, INVERSE)]
    return _POWERS[0], _POWERS[1]


def in_steps(texts: pa.Array, step: int = STEP) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices (first row, end row, bytes, starts, ends) of a text column, each text followed by a blank."""
    column = texts.fill_null("").cast(pa.large_binary())
    lengths = np.asarray(pa.compute.binary_length(column)) + 1
    upto = np.cumsum(lengths)
    row = 0
    while row < len(lengths):
        base = upto[row] - lengths[row]
        end = max(row + 1, int(np.searchsorted(upto, base + step, "right")))
        data = np.frombuffer(b"".join(x.as_py() + b" " for x in column[row:end]), np.uint8)
        ends = upto[row:end] - base
        yield row, end, data, ends - lengths[row:end], ends
        row = end


def statistics(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x array<double>): one row per document."""
    import pyarrow.compute  # noqa: F401

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            if batch.num_rows:
                x = np.concatenate([measure(data, a, b) for _, _, data, a, b in in_steps(batch.column(1))])
                flat = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), flat], [key, "x"])

    own = documents.select(key, text)
    return own.mapInArrow(run, f"`{key}` {dict(own.dtypes)[key]}, x array<double>")


@dataclass(frozen=True)
class Model:
    """Class shares, centre and scale of the statistics, and per class the mean, the Cholesky factor and log determinant."""

    share: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: tuple = ()
    factors: tuple = ()

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.centre is None:
            return np.full(len(x), self.share)
        z = (x - self.centre) / self.scale
        dense = []
        for mean, factor in zip(self.means, self.factors, strict=True):
            y = np.linalg.solve(factor, (z - mean).T)
            dense.append(-0.5 * (y ** 2).sum(0) - np.log(np.diag(factor)).sum())
        odds = np.log(self.share) - np.log1p(-self.share) + dense[1] - dense[0]
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def fit(statistics: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
        pooled: float = POOLED, identity: float = IDENTITY) -> Model:
    """Model from all rows of ``labels`` whose key is in ``statistics``; two small aggregates reach the driver."""
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).alias("y"))
    rows = statistics.join(known, statistics[key] == F.col("_key")).select("y", "x")
    d = len(NAMES)
    sums = {r["y"]: r for r in rows.groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.get("x", F.lit(i))) for i in range(d)]).alias("s")).collect()}
    total = sum(r["n"] for r in sums.values())
    if len(sums) < 2:
        return Model(sum(y * r["n"] for y, r in sums.items()) / total if total else 0.5)
    centre = sum(np.array(r["s"]) for r in sums.values()) / total
    # Products of centred values keep their digits.
    centred = rows.select("y", *[(F.get("x", F.lit(i)) - float(centre[i])).alias(f"c{i}") for i in range(d)])
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    products = {r["y"]: r["p"] for r in centred.groupBy("y").agg(
        F.array(*[F.sum(F.col(f"c{i}") * F.col(f"c{j}")) for i, j in pairs]).alias("p")).collect()}
    scatter, means = {}, {}
    for y, r in sums.items():
        full = np.zeros((d, d))
        for (i, j), value in zip(pairs, products[y], strict=True):
            full[i, j] = full[j, i] = value
        means[y] = np.array(r["s"]) / r["n"] - centre
        scatter[y] = full - r["n"] * np.outer(means[y], means[y])
    within = sum(scatter.values()) / total
    scale = np.sqrt(np.maximum(np.diag(within), 1e-12))
    scale[np.diag(within) < 1e-10] = 1.0
    factors = []
    for y in (0, 1):
        own = scatter[y] / sums[y]["n"] / np.outer(scale, scale)
        mixed = (1 - pooled) * own + pooled * within / np.outer(scale, scale)
        mixed = (1 - identity) * mixed + identity * max(np.trace(mixed) / d, 1e-6) * np.eye(d)
        factors.append(np.linalg.cholesky(mixed))
    return Model(sums[1]["n"] / total, centre, scale, (means[0] / scale, means[1] / scale), tuple(factors))


def with_scores(statistics: DataFrame, model: Model, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(key, score, predicted) for each row of ``statistics``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, len(NAMES))
                score = model.score(x)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(
                    (score >= threshold).astype(np.int32))], [key, "score", "predicted"])

    return statistics.select(key, "x").mapInArrow(
        run, f"`{key}` {dict(statistics.dtypes)[key]}, score double, predicted int")


def keep_good(documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that the model does not reject, scored and filtered in one pass."""
    place = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            if batch.num_rows:
                x = np.concatenate([measure(data, a, b) for _, _, data, a, b in in_steps(batch.column(place))])
                yield batch.filter(pa.array(model.score(x) >= threshold))

    return documents.mapInArrow(run, documents.schema)


def held_out(key: str):
    """Whether a row is kept for testing: crc32 of its key as text is a multiple of five."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 0
