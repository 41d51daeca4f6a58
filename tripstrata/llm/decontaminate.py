"""Benchmark decontamination with a broadcast hash set of test n-grams.

Benchmark items become windows of ``width`` words, an item of fewer words one window. The hashes
of the windows are a broadcast hash table; each document's own windows are hashed and probed in
the scan, and a probe that hits counts only after the words themselves compare equal. Nothing of
a document moves but its hits.

Defined results: NULL and empty texts have no words and hit nothing; benchmark items without words
are ignored; equal items and equal windows each count once; an empty benchmark hits nothing; an
empty document table gives an empty result. Columns other than the key and the text are not read,
so their names cannot clash. Repeated keys: for ``contamination`` their rows are one document, NULL keys too; for
``decontaminate`` each row counts by its own text, whatever its key, so rows without words always stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.line_chunks import row_of
from tripstrata.llm.text import fresh, let, lower_az, split_words

#: All characters but digits, a-z (A-Z is in lower case by then) and what is not ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
NOT_WORD_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WIDTH = 10
#: Window hashes that go into the scan as a set of constants, and windows that may be a broadcast table.
SET_WINDOWS = 20_000
BROADCAST_WINDOWS = 1_000_000


def words_of(text: Column) -> Column:
    return split_words(lower_az(text), NOT_WORD)


def run_hash(hashes: Column, first: Column, width: int) -> Column:
    """Hash of ``width`` word hashes from ``first`` (from 0) on."""
    return F.xxhash64(*[F.get(hashes, first + k) for k in range(width)])


def run_starts(words: Column, width: int, among: list[int] | None) -> Column:
    """Where runs of ``width`` words start (from 0); with ``among`` only those whose hash is in it."""
    starts = F.when(F.size(words) >= width, F.sequence(F.lit(0), F.size(words) - width)).otherwise(
        F.array().cast("array<int>"))
    if among is None:
        return starts
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: F.filter(
        starts, lambda i: run_hash(hashes, i, width).isin(among)))


def item_windows(benchmark: DataFrame, width: int = WIDTH, key: str = "item_id", text: str = "text") -> DataFrame:
    """(h, width, window, items): the distinct windows of a benchmark and the items that have them."""
    items = benchmark.select(F.col(key).cast("string").alias("item"), words_of(F.col(text)).alias("words")).filter(
        "size(words) > 0").withColumn("width", F.least(F.size("words"), F.lit(width)))
    starts = items.withColumn("at", F.explode(F.expr("sequence(1, size(words) - width + 1)")))
    windows = starts.select("item", "width", F.expr("slice(words, at, width)").alias("window"))
    return windows.groupBy("width", "window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def window_hits(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, key: str = "doc_id",
                text: str = "text", item_key: str = "item_id", item_text: str = "text",
                set_windows: int = SET_WINDOWS, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(key, n_words, first, last, items): verified hits, and at least one row for each document.

    ``first`` and ``last`` count words from 0. Up to ``set_windows`` windows their hashes are constants of
    the scan, so only probes that hit become rows; up to ``broadcast_windows`` every window of a document
    probes a broadcast table; beyond that the same join shuffles.
    """
    table = item_windows(benchmark, width, item_key, item_text)
    by_width = {r["width"]: r["count"] for r in table.groupBy("width").count().collect()}  # at most ``width`` rows
    total = sum(by_width.values())
    base = documents.select(F.col(key), words_of(F.col(text)).alias("words"))

    def scan(of: int, lead: bool) -> DataFrame:
        own = table.filter(F.col("width") == of).select("window", "items")
        among = None
        if total <= set_windows:
            hashes = F.transform("window", lambda w: F.xxhash64(w))
            among = [r["h"] for r in own.select(run_hash(hashes, F.lit(0), of).alias("h")).distinct().collect()]
        starts = run_starts(F.col("words"), of, among)
        windows = F.transform(starts, lambda i: F.struct(
            i.cast("long").alias("first"), F.array(*[F.get("words", i + k) for k in range(of)]).alias("window")))
        probes = base.select(key, F.size("words").cast("long").alias("n_words"), (
            F.explode_outer if lead else F.explode)(windows).alias("p")).select(key, "n_words", "p.first", "p.window")
        hits = probes.join(F.broadcast(own) if total <= broadcast_windows else own, "window", "left" if lead else "inner")
        found = F.col("items").isNotNull()
        return hits.select(key, F.col("n_words") if lead else F.lit(None).cast("long").alias("n_words"),
                           F.when(found, F.col("first")).alias("first"),
                           F.when(found, F.col("first") + of - 1).alias("last"), "items")

    widths = sorted(by_width, reverse=True) or [width]
    return reduce(DataFrame.unionByName, [scan(w, w == widths[0]) for w in widths])


def covered(spans: Column) -> Column:
    """Words in any of the (first, last) ``spans``."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("upto"))
    return F.aggregate(
        F.sort_array(spans), start,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), s["last"] - F.greatest(s["first"] - 1, a["upto"]))).alias("n"),
            F.greatest(a["upto"], s["last"]).cast("long").alias("upto")),
        lambda a: a["n"])


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, key: str = "doc_id",
                  text: str = "text", **more) -> DataFrame:
    """One row per document: words, hit words, items, and the hit spans (of word numbers from 0)."""
    hits = window_hits(documents, benchmark, width, key, text, **more)
    found = hits.groupBy(key).agg(
        F.max("n_words").alias("n_words"),
        F.collect_set(F.when(F.col("first").isNotNull(), F.struct("first", "last"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return found.withColumn("n_hit", covered(F.col("spans"))).select(
        key, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "items", "spans")


def decontaminate(documents: DataFrame, benchmark: DataFrame, remove: str = "documents", width: int = WIDTH,
                  key: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """``documents`` without benchmark passages, its columns unchanged.

    ``remove="documents"`` drops contaminated documents; ``"spans"`` cuts out the hit words together
    with the separators that follow them.
    """
    row, hit_key, spans = fresh(documents, "_hit_row", "_hit_key", "_hit_spans")
    rows = documents.withColumn(row, row_of(key, text))
    found = contamination(rows, benchmark, width, row, text, **more).filter("contaminated")
    if remove == "documents":
        return rows.join(found.select(row), row, "left_anti").select(documents.columns)
    if remove != "spans":
        raise ValueError("remove: documents or spans")
    marks = found.select(F.col(row).alias(hit_key), F.col("spans").alias(spans))
    joined = rows.join(marks, rows[row] == marks[hit_key], "left")
    own = documents[text]
    parts = F.struct(F.array_remove(F.split(own, f"{NOT_WORD_RAW}+"), "").alias("words"),
                     F.split(own, f"{NOT_WORD_RAW.replace('[', '[^', 1)}+").alias("gaps"))

    def cut(p: Column) -> Column:
        kept = F.filter(F.sequence(F.lit(0), F.size(p["words"]) - 1), lambda i: ~F.exists(
            spans, lambda s: i.between(s["first"], s["last"])))
        return F.concat(F.element_at(p["gaps"], 1), F.array_join(F.transform(kept, lambda i: F.concat(
            F.get(p["words"], i), F.get(p["gaps"], i + 1))), ""))

    return joined.select(*[
        F.when(F.col(hit_key).isNull(), own).otherwise(let(parts, cut)).alias(c) if c == text else documents[c]
        for c in documents.columns])
