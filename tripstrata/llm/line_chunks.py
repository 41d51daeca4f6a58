"""Line dedup by content-defined chunks of lines.

A rolling hash runs over the hashes of each two adjacent lines that hold ``least_words`` words or more together. A
place closes a chunk, its two lines, where its rolling hash is not above one of its neighbours', where it has no such
neighbour, or where the two lines hold ``long_line`` words; so of two places next to each other one is always chosen,
by the lines around it alone, whatever comes before. A line of ``long_line`` words or more holds several wrapped lines and
is a chunk of its own, which others do not reach into. A chunk that repeats anywhere is also
taken with the line before it and with the line after it. All these spans are compared by hash over all documents; where a hash
repeats, the span that comes first by key and place stays, and every other goes once its bytes equal those of the first.

A run of lines that an earlier document has goes whole, wherever its lines stand: if it has three lines or more, each of six words or more,
or two lines of ``long_line`` words together, or one such line. Of others only lines of few words, next to such ones, can stay. Spans
are judged on the input, not on what is left: the first copy of a span can lose lines that another span, itself repeated, has.

Only (hash, key, place) of the chunks is grouped, reduced in the map task first. Texts move twice,
by key: to take out the spans that need the byte comparison, and to cut the removed ones. A
chunk that a third of all rows have is one row of the grouped side, so its other side can be split.

Defined results: NULL stays NULL and has no chunk; an empty text is one empty line, never removed;
empty lines count as lines like others; lines end at ``\\n`` only; copies within one document go
as well; rows that repeat in key and text are one document and stay alike, rows that share only the key
are documents of their own. A text of which everything goes becomes empty. Extra columns pass
unchanged, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.text import fresh, let
from tripstrata.sources.staging import stage_table

LONG_LINE = 50
LEAST_WORDS = 12
#: Multiplier and modulus of the rolling hash; line hashes are below the modulus, products below 2**63.
BASE, PRIME = 1_000_003, 4_294_967_291


def line_hash(line: Column) -> Column:
    """The first 32 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    """Runs of characters between blanks."""
    return F.size(F.array_remove(F.split(text, " "), ""))


def rolling(hashes: Column, counts: Column, long_line: int, least_words: int) -> Column:
    """Per line the hash of it and the line before; NULL where the two are no chunk."""
    def one(h: Column, i: Column) -> Column:
        own, before = F.get(counts, i), F.get(counts, i - 1)
        return F.when((i > 0) & (own < long_line) & (before < long_line) & (own + before >= least_words),
                      F.pmod(F.get(hashes, i - 1) * F.lit(BASE) + h, F.lit(PRIME)))

    return F.transform(hashes, one)


def chunks_of(lines: Column, long_line: int, least_words: int) -> Column:
    """The chunks (first, last, h) of ``lines``, with ``before`` and ``after``: the hashes of those grown by a line, or NULL."""
    def chunk(named: Column, first: Column, last: Column) -> Column:
        before, after = F.get(named, first - 1), F.get(named, last + 1)
        # NULLs are passed over, so the hash of a span is that of its lines alone.
        own = [F.get(named, first), F.when(last > first, F.get(named, last))]
        return F.struct(
            (first + 1).alias("first"), (last + 1).alias("last"), F.xxhash64(*own).alias("h"),
            F.when(before.isNotNull(), F.xxhash64(before, *own)).alias("before"),
            F.when(after.isNotNull(), F.xxhash64(*own, after)).alias("after"))

    def cut(counts: Column, rolled: Column, named: Column) -> Column:
        def one(own: Column, i: Column) -> Column:
            left, right, words = F.get(rolled, i - 1), F.get(rolled, i + 1), F.get(counts, i) + F.get(counts, i - 1)
            chosen = left.isNull() | right.isNull() | (own <= left) | (own <= right) | (words >= long_line)
            return F.when(F.get(counts, i) >= long_line, i).when(own.isNotNull() & chosen, i - 1)

        firsts = F.transform(rolled, one)
        return F.filter(F.transform(firsts, lambda first, i: F.when(first.isNotNull(), chunk(named, first, i))),
                        lambda c: c.isNotNull())

    return let(F.transform(lines, word_count), lambda counts: let(
        rolling(F.transform(lines, line_hash), counts, long_line, least_words), lambda rolled: let(
            F.transform(lines, lambda line: F.xxhash64(line)), lambda named: cut(counts, rolled, named))))


def grown(c: Column) -> Column:
    """The spans (first, last, h, side) of a repeated chunk: the chunk (side 0), with the line before (-1) and the one after (1)."""
    def span(first: Column, last: Column, h: Column, side: int) -> Column:
        return F.when(h.isNotNull(), F.struct(first.alias("first"), last.alias("last"), h.alias("h"), F.lit(side).alias("side")))

    return F.filter(F.array(span(c["first"] - 1, c["last"], c["before"], -1), span(c["first"], c["last"], c["h"], 0),
                            span(c["first"], c["last"] + 1, c["after"], 1)), lambda s: s.isNotNull())


def enough(spans: Column) -> Column:
    """Those of a text's spans (start, end of their chunk, side, h), sorted, that together have every line the spans have.

    A grown span is left out where its chunk is there and another chunk has the line it adds; such a chunk is one of
    two at most, with three spans each.
    """
    def needed(s: Column, i: Column) -> Column:
        line = F.when(s["side"] < 0, s["start"] - 1).otherwise(s["end"] + 1)
        has = F.lit(False)
        for k in range(1, 7):
            other = F.get(spans, F.when(s["side"] < 0, i - k).otherwise(i + k))
            has = has | F.coalesce((other["side"] == 0) & (other["start"] <= line) & (other["end"] >= line), F.lit(False))
        beside = F.get(spans, i - s["side"])
        own = F.coalesce((beside["side"] == 0) & (beside["start"] == s["start"]) & (beside["end"] == s["end"]), F.lit(False))
        return (s["side"] == 0) | ~own | ~has

    return F.filter(spans, needed)


def row_of(key: str, text: str) -> Column:
    """What tells documents apart, in the order of keys."""
    return F.struct(F.col(key), F.xxhash64(F.col(text)).alias("h"))


def chunks(documents: DataFrame, key: str = "doc_id", text: str = "text", long_line: int = LONG_LINE,
           least_words: int = LEAST_WORDS) -> DataFrame:
    """(row, chunks): the chunks of each text that is not NULL."""
    return documents.filter(F.col(text).isNotNull()).select(row_of(key, text).alias("row"), let(
        F.split(text, "\n"), lambda lines: chunks_of(lines, long_line, least_words)).alias("chunks"))


def repeated_chunks(documents: DataFrame, key: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """(row, first, last): the spans to remove, each equal in bytes to one that comes before it."""
    rows = stage_table(chunks(documents, key, text, **rules).select("row", F.explode("chunks").alias("c")).select(
        "row", "c.*"), "chunks")
    # Staged, so that both sides of the join come straight from an exchange and a chunk of very many rows can be split.
    again = stage_table(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "repeated")
    spans = stage_table(rows.join(again, "h").select("row", F.explode(grown(F.struct(
        "first", "last", "h", "before", "after"))).alias("s")).select("row", "s.*"), "spans")
    kept = stage_table(spans.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first", "last")).alias("kept"))
                       .filter("n > 1").select("h", "kept"), "kept")
    later = spans.join(kept, "h").filter(F.struct("row", "first", "last") != F.col("kept")).groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct(
            (F.col("first") + (F.col("side") < 0).cast("int")).alias("start"),
            (F.col("last") - (F.col("side") > 0).cast("int")).alias("end"), "side", "h"))).alias("spans"))
    later = stage_table(later.select("row", F.explode(enough(F.col("spans"))).alias("s")).select(
        "row", (F.col("s.start") - (F.col("s.side") < 0).cast("int")).alias("first"),
        (F.col("s.end") + (F.col("s.side") > 0).cast("int")).alias("last"), "s.h"), "later")
    firsts = kept.join(later.select("h").distinct(), "h", "left_semi").select("kept.*", "h", F.lit(True).alias("is_kept"))
    asked = firsts.unionByName(later.withColumn("is_kept", F.lit(False))).groupBy("row").agg(
        F.collect_set(F.struct("first", "last", "h", "is_kept")).alias("asked"))
    texts = documents.select(row_of(key, text).alias("row"), F.col(text).alias("text")).join(asked, "row")
    bodies = stage_table(texts.select("row", F.split("text", "\n").alias("lines"), F.explode("asked").alias("a")).select(
        "row", "a.*", F.array_join(F.slice("lines", F.col("a.first"), F.col("a.last") - F.col("a.first") + 1), "\n")
        .alias("body")), "chunk-bodies", partition_by="is_kept")
    firsts = stage_table(bodies.filter("is_kept").select("h", F.col("body").alias("kept_body")).distinct(), "first-bodies")
    return bodies.filter("not is_kept").join(firsts, "h").filter("body = kept_body").select("row", "first", "last")


def marks(places: Column) -> Column:
    """For sorted numbers of lines: "1" at these, "0" before and between."""
    return F.split(F.array_join(F.transform(places, lambda p, i: F.concat(
        F.repeat(F.lit("0"), p - F.coalesce(F.get(places, i - 1), F.lit(0)) - 1), F.lit("1"))), ""), "")


def dedup_lines(documents: DataFrame, key: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """``documents`` with repeated chunks cut from ``text``, and ``n_lines``, ``n_removed`` (lines) added."""
    row, out_of, places = fresh(documents, "_row", "_gone_row", "_gone")
    gone = repeated_chunks(documents, key, text, **rules).groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(
        F.collect_set(F.sequence("first", "last"))))).alias(places)).withColumnRenamed("row", out_of)
    joined = documents.withColumn(row, row_of(key, text)).join(gone, F.col(row) == F.col(out_of), "left")
    lines = F.split(documents[text], "\n")
    kept = let(marks(F.col(places)), lambda out: F.array_join(F.filter(
        lines, lambda s, i: ~F.get(out, i).eqNullSafe("1")), "\n"))
    return joined.select(
        *[F.when(F.col(places).isNull(), documents[c]).otherwise(kept).alias(c) if c == text else documents[c]
          for c in documents.columns],
        F.when(documents[text].isNotNull(), F.size(lines)).otherwise(0).cast("long").alias("n_lines"),
        F.when(F.col(places).isNull(), 0).otherwise(F.size(places)).cast("long").alias("n_removed"))
