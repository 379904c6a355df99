"""Lines that many documents share, kept in one of them.

Line hashes are range-partitioned together with a stretch of document ids and sorted by hash,
document and position, so the occurrences of a line stream by in order, however many there are,
and a common line lies in several partitions. A stretch hands on only how many documents it saw;
the first occurrence is that of the line's last stretch. The result is a bitmap of kept lines for
each document, in run lengths; texts are not part of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.shared import Stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = " \t\n\x0b\x0c\r"
_STRETCHES = 256  # parts that the occurrences of one line can be split into


def key_of(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _runs(dropped: Column, n_lines: Column) -> Column:
    """Lengths of runs of kept and dropped lines in turn, a kept run first, from the sorted
    places of dropped lines."""
    def at(i: Column) -> Column:
        return F.get(dropped, i)

    starts = F.filter(dropped, lambda x, i: (i == 0) | (at(i - 1) != x - 1))
    ends = F.filter(dropped, lambda x, i: (i == F.size(dropped) - 1) | (at(i + 1) != x + 1))
    pairs = F.transform(
        starts,
        lambda s, i: F.array(s - F.coalesce(F.get(ends, i - 1) + 1, F.lit(0)), F.get(ends, i) - s + 1),
    )
    return F.concat(F.flatten(pairs), F.array(n_lines - 1 - F.element_at(ends, -1)))


def _stretch(docs: DataFrame) -> Column:
    """The number of the range of ids that ``doc_id`` lies in, of at most ``_STRETCHES`` ranges
    with about as many documents each; -1 for a null id."""
    shares = [k / _STRETCHES for k in range(1, _STRETCHES)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 10_000).alias("bounds")).first()["bounds"]
    below = F.array(*(F.lit(b) for b in sorted(set(bounds or ()))))
    return F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(below, lambda b: b < F.col("doc_id"))))


def in_order(seen: DataFrame) -> DataFrame:
    """The occurrences (``key``, ``stretch``, ``doc_id``, ``pos`` and more) as they stream by.

    They are dealt by ranges of the hash and the stretch of ids, and sorted by them, the document
    (largest first) and the position. ``opens`` marks the first occurrence in each document and
    ``place`` counts the documents of the stretch so far, so the largest has place 1. A key's
    stretches lie in any number of tasks; what they need of each other is which of them is last.
    """
    stream = Window.partitionBy("key", "stretch").orderBy(F.desc("doc_id"), "pos")
    before = F.lag("doc_id").over(stream)
    opens = F.col("doc_id").isNotNull() & (before.isNull() | (before != F.col("doc_id")))
    so_far = F.sum(F.col("opens").cast("int")).over(stream.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return seen.repartitionByRange("key", "stretch").withColumn("opens", opens).withColumn("place", so_far)


def keep_bitmaps(docs: DataFrame, min_length: int = 40, min_docs: int = 5) -> DataFrame:
    """The kept lines of every distinct (``doc_id``, text) that loses any.

    Returns ``doc_id``, ``text_key`` (of the text), ``n_lines``, ``n_dropped`` and ``keep_runs``,
    the bitmap as run lengths: kept, dropped, kept and so on. A line whose key has ``min_length``
    code points and is found under ``min_docs`` different ids is dropped everywhere but under the
    largest of them. Ids are integers; a null id counts for nothing and keeps none of these lines.
    """
    stored = Stored(docs.sparkSession, "lines")
    split = docs.select(
        "doc_id", _stretch(docs).alias("stretch"), _text_key(F.col("text")).alias("text_key"), _lines(F.col("text")).alias("lines")
    )
    exploded = split.select(
        "doc_id", "stretch", "text_key", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line")
    )
    long_lines = exploded.withColumn("line", F.btrim("line", F.lit(_SPACE))).where(F.char_length("line") >= min_length)
    # Stored, as the bounds of the ranges take a look at the rows before they are dealt.
    seen = stored.write(
        long_lines.select(
            F.unhex(F.md5(key_of(F.col("line")))).alias("key"), "stretch", "doc_id", "pos", "n_lines", "text_key"
        )
    )
    streamed = stored.write(in_order(seen))
    stored.drop(seen)
    shared = stored.write(
        streamed.where("opens")
        .groupBy("key")
        .agg(F.count("*").alias("n_docs"), F.max("stretch").alias("last"))
        .where(F.col("n_docs") >= min_docs)
        .select("key", "last")
    )
    dropped = (
        streamed.join(shared, "key")
        .where("not (stretch = last and place = 1)")
        .groupBy("doc_id", "text_key", "n_lines")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )
    return dropped.select(
        "doc_id", "text_key", F.col("n_lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
        _runs(F.col("dropped"), F.col("n_lines")).alias("keep_runs"),
    )


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The lines that the bitmap keeps, joined by line ends; all of them if it is null."""
    flags = F.flatten(F.transform(keep_runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    kept = F.filter(_lines(text), lambda x, i: F.get(flags, i))
    return F.when(keep_runs.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(kept, "\n"))


def _with_bitmaps(docs: DataFrame, options: dict) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``text``, ``n_lines``, ``n_dropped``, ``keep_runs``
    (null where no line is dropped)."""
    found = keep_bitmaps(docs.select("doc_id", "text"), **options).select(
        F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"), "n_dropped", "keep_runs"
    )
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text", _text_key(F.col("text")).alias("text_key"))
    own = (F.col("text_key") == F.col("found_key")) & F.col("doc_id").eqNullSafe(F.col("found_id"))
    return rows.join(found, own, "left").select(
        "row", "doc_id", "text",
        F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        "keep_runs",
    )


def line_digests(docs: DataFrame, **options) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with its bitmap.

    Returns ``doc_id``, ``n_lines``, ``n_dropped``, ``kept_sha256`` of the text that stays and
    ``keep_runs``, the bitmap as run lengths of kept and dropped lines in turn. Null and empty
    texts are one empty line. Rows that repeat stay and share a bitmap. Without rows the result
    is empty. ``options`` are those of ``keep_bitmaps``.
    """
    rows = _with_bitmaps(docs.select("doc_id", "text"), options)
    return rows.select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(kept_text(F.col("text"), F.col("keep_runs")).cast("binary"), 256).alias("kept_sha256"),
        F.coalesce("keep_runs", F.array(F.col("n_lines").cast("int"))).alias("keep_runs"),
    )


def without_shared_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all its rows and columns, with the lines dropped from ``text``; a column
    ``n_chars`` is counted anew. A null text without dropped lines stays null."""
    rows = _with_bitmaps(docs, options)
    text = F.when(F.col("keep_runs").isNull(), F.col("text")).otherwise(kept_text(F.col("text"), F.col("keep_runs")))
    changed = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return rows.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
