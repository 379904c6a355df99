"""Passages of many words that stand in several documents, removed from all but the first.

Level by level: runs of half the window's length that are repeated are the only ones extended to
the full length. On the first level a window is represented by one of the shorter runs in it,
the one whose hash is smallest, so that equal windows have equal runs and only about two of
every window's places are looked at; windows whose run is not repeated cannot be repeated either.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import Stored, workers_find_package
from larder.llm.words import run_hashes, word_hashes

WINDOW = 50


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged."""
    return text.encode().split() if text else []


def chosen_runs(hashes: np.ndarray, size: int, window: int) -> np.ndarray:
    """For each window the place of the run of ``size`` words with the smallest hash in it, the
    first of equals. ``hashes`` are those of all runs."""
    span = window - size + 1
    if len(hashes) < span:
        return np.zeros(0, np.int64)
    places = np.arange(len(hashes) - span + 1)
    return places + np.lib.stride_tricks.sliding_window_view(hashes, span).argmin(axis=1)


def _rows(batch: pa.RecordBatch, rows: list[np.ndarray], **columns: list[np.ndarray]) -> pa.RecordBatch:
    at = pa.array(np.concatenate(rows))
    found = [pa.array(np.concatenate(values)) for values in columns.values()]
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"].take(at), batch["text_key"].take(at), *found], names=["doc_id", "text_key", *columns]
    )


def _runs(half: int, window: int):
    """Rows (document, run): the runs that stand for a document's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes = [], []
            for k, text in enumerate(batch["text"]):
                own = run_hashes(word_hashes(words_of(text.as_py())), half)
                kept = np.unique(own[np.unique(chosen_runs(own, half, window))])
                rows.append(np.full(len(kept), k))
                hashes.append(kept.view(np.int64))
            if rows:
                yield _rows(batch, rows, run=hashes)

    return run


def _windows(half: int, window: int):
    """Rows (document, hash, start) of the windows whose run is one of the document's ``runs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes, starts, waiting = [], [], [], 0
            for k, (text, known) in enumerate(zip(batch["text"], batch["runs"])):
                words = word_hashes(words_of(text.as_py()))
                own = run_hashes(words, half)
                runs_of = own[chosen_runs(own, half, window)]
                known = np.sort(np.asarray(known.values).view(np.uint64))
                at = np.minimum(np.searchsorted(known, runs_of), len(known) - 1)
                places = np.flatnonzero(known[at] == runs_of)
                rows.append(np.full(len(places), k))
                hashes.append(run_hashes(words, window)[places].view(np.int64))
                starts.append(places.astype(np.int32))
                waiting += len(places)
                if waiting > 200_000:
                    yield _rows(batch, rows, hash=hashes, start=starts)
                    rows, hashes, starts, waiting = [], [], [], 0
            if rows:
                yield _rows(batch, rows, hash=hashes, start=starts)

    return run


def repeated_spans(docs: DataFrame, firsts: DataFrame, stored: Stored, window: int = WINDOW) -> DataFrame:
    """The words to remove from the documents of ``firsts`` (``doc_id``, ``text_key``), as sorted
    arrays ``starts`` and ``ends`` of spans. ``docs`` has these columns and ``text``."""
    half = -(-window // 2)
    runs = docs.mapInArrow(_runs(half, window), "doc_id long, text_key binary, run long")
    half_runs = stored.write(runs.join(firsts, ["doc_id", "text_key"], "left_semi"))
    repeated = half_runs.groupBy("run").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    candidates = (
        half_runs.join(stored.write(repeated.select("run")), "run", "left_semi")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("run").alias("runs"))
    )
    texts = docs.join(candidates, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "runs")
    full = stored.write(
        texts.mapInArrow(_windows(half, window), "doc_id long, text_key binary, hash long, start int")
    )
    stored.drop(half_runs)
    # Stored, so that the join below is one that can split a window that very many documents hold.
    first = full.groupBy("hash").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    first = stored.write(first.where("first_id < last_id").select("hash", "first_id"))
    later = full.join(first, "hash").where("doc_id > first_id")
    found = stored.write(
        later.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("start")).alias("all"))
    )
    stored.drop(full)

    def at(i):
        return F.get("all", i)

    opens = F.filter("all", lambda x, i: (i == 0) | (x > at(i - 1) + window))
    closes = F.filter("all", lambda x, i: (i == F.size("all") - 1) | (at(i + 1) > x + window))
    return found.select(
        "doc_id", "text_key", opens.alias("starts"), F.transform(closes, lambda x: x + window).alias("ends")
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with the words that stay.

    Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of the words that stay,
    joined by spaces, and the removed spans as ``starts`` and ``ends`` (word numbers, ends
    excluded). A word goes if it lies in ``window`` words that also start in a document with a
    smaller id; windows are those of the input. Windows within one document, or in rows with the
    same id, don't count as repeats. Null and empty texts have no words. Rows without an id stay
    as they are and hold nothing for others; repeated rows get the same result each. Without rows
    the result is empty. A text that a smaller id holds as a whole goes without a search, as each
    of its windows is repeated.
    """
    spark = docs.sparkSession
    workers_find_package(spark)
    stored = Stored(spark, "passages")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"),
        "text",
    )
    ids = stored.write(keyed.where("doc_id is not null").select("doc_id", "text_key").distinct())
    firsts = stored.write(ids.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text_key"))
    spans = repeated_spans(keyed, firsts, stored, window).withColumn("copy", F.lit(False))
    none = F.lit(None).cast("array<int>")
    copies = ids.join(firsts, ["doc_id", "text_key"], "left_anti").select(
        "doc_id", "text_key", none.alias("starts"), none.alias("ends"), F.lit(True).alias("copy")
    )
    marked = keyed.join(spans.unionByName(copies), ["doc_id", "text_key"], "left")
    return marked.select("doc_id", "text", "copy", "starts", "ends").mapInArrow(_digests(window), _SCHEMA)


_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, starts array<int>, ends array<int>"


def _digests(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, copy, starts, ends in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "copy", "starts", "ends"))):
                words = words_of(text)
                n = len(words)
                if copy and n >= window:
                    starts, ends = [0], [n]
                spans = list(zip(starts or (), ends or ()))
                removed = 0
                for a, b in reversed(spans):
                    del words[a:b]
                    removed += b - a
                digest = hashlib.sha256(b" ".join(words)).hexdigest()
                rows.append((doc_id, n, removed, digest, [a for a, _ in spans], [b for _, b in spans]))
            if not rows:
                continue
            kinds = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.int32())] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "starts", "ends"],
            )

    return run
