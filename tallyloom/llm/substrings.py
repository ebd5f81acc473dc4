"""Removal of word passages that occur elsewhere, with an FM-index per shard.

Two equal windows have the same anchor: the least hash among the word groups
inside. Anchors are chosen in one pass over the texts, and only those that occur
twice go on, with the passage of all windows they stand for. Passages are made
distinct, dealt into shards by anchor and indexed; the passages of a shard are
streamed against its index, whose matching statistics tell the windows that occur
more than once. So equal windows always meet, and a shard is compared with itself
only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.fmindex import FMIndex
from tallyloom.llm.texts import only, settle, slices

#: An odd number for rolling hashes, and one to mix them (fixed values without meaning).
ROLL, MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)

KEY = ["key1", "key2"]


def _content_key() -> list:
    """128 bits of the text's content: copies share it, and it does not rely on ids."""
    return [F.xxhash64("text").alias("key1"), F.xxhash64(F.lit(1), "text").alias("key2")]


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))


def _groups(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words (a power of two)."""
    now, width, factor = hashes, 1, ROLL
    while width < size:
        now = now[:-width] * np.uint64(factor) + now[width:]
        factor = factor * factor % (1 << 64)
        width *= 2
    now = (now ^ (now >> np.uint64(32))) * MIX
    return now ^ (now >> np.uint64(29))


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, where its least one is; of equals the leftmost."""
    best, at, size = values, np.arange(len(values)), 1

    def join(best, at, shift):
        left = best[:-shift] <= best[shift:]
        return np.where(left, best[:-shift], best[shift:]), np.where(left, at[:-shift], at[shift:])

    while 2 * size <= width:
        best, at = join(best, at, size)
        size *= 2
    if size < width:
        best, at = join(best, at, width - size)
    return at


def anchors(hashes: np.ndarray, window: int, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor hash, first window, number of windows)``: each window of the text belongs to one anchor."""
    if len(hashes) < window:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    values = _groups(hashes, group)
    at = _leftmost_least(values, window - group + 1)
    first = np.flatnonzero(np.concatenate([[True], np.diff(at) != 0]))
    return values[at[first]].view(np.int64), first, np.diff(np.concatenate([first, [len(at)]]))


def _anchor_table(texts: DataFrame, window: int, group: int) -> DataFrame:
    """``(key1, key2, anchor, first, windows)`` of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found, taken = [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                got = anchors(word_hashes((text or "").encode("utf-8", "replace").split()), window, group)
                found.append(got)
                taken.append(np.full(len(got[0]), i))
            rows = pa.array(np.concatenate(taken))
            columns = [pa.array(np.concatenate(c).astype(kind)) for c, kind in zip(zip(*found), ("i8", "i4", "i4"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("key1").take(rows), part.column("key2").take(rows), *columns], names=[*KEY, "anchor", "first", "windows"]
            )

    return texts.mapInArrow(run, "key1 long, key2 long, anchor long, first int, windows int")


def _passages(candidates: DataFrame, window: int) -> DataFrame:
    """``(key1, key2, first, passage, id, route, copies)`` for texts with their ``runs`` of candidate windows.

    A passage holds the words of all windows of an anchor and is routed by it. The windows of a hot anchor
    become passages of their own, routed by their content: its texts differ around a common part, and so they
    spread over shards while equal windows still meet.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for part in slices(batches, "text", 1 << 20):
            rows = []
            for key1, key2, text, copies, runs in zip(*(part.column(c).to_pylist() for c in (*KEY, "text", "copies", "runs"))):
                words = text.encode("utf-8", "replace").split()
                for r in runs:
                    first, last = r["first"], r["first"] + r["windows"]
                    for a, b in [(w, w + window) for w in range(first, last)] if r["hot"] else [(first, last + window - 1)]:
                        passage = b" ".join(words[a:b])
                        name = digest(passage)
                        route = int.from_bytes(name[:8], "little", signed=True) if r["hot"] else r["anchor"]
                        rows.append((key1, key2, a, passage, name, route, copies))
            columns = zip(*rows) if rows else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*KEY, "first", "passage", "id", "route", "copies"]
            )

    return candidates.mapInArrow(run, "key1 long, key2 long, first int, passage binary, id binary, route long, copies long")


def covered(repeated: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Intervals of words that lie in a window marked in ``repeated``."""
    starts = np.flatnonzero(repeated)
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > window)
    begins, ends = starts[np.concatenate([[0], breaks + 1])], starts[np.concatenate([breaks, [len(starts) - 1]])] + window
    return list(zip(begins.tolist(), ends.tolist()))


def _shard_search(window: int):
    """Index the passages of one shard, stream them against it, and report what occurs more than once."""

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        split = pc.split_pattern(pa.array(shard["passage"], pa.large_binary()), b" ")
        numbers = split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
        index = FMIndex(numbers, pc.list_value_length(split).to_numpy(), shard["copies"].to_numpy(), window)
        names, begins, ends = [], [], []
        for name, weights in zip(shard["id"], index.occurrences(window)):
            for a, b in covered(weights > 1, window):
                names.append(name)
                begins.append(a)
                ends.append(b)
        return pd.DataFrame({"id": names, "begin": pd.Series(begins, dtype="int32"), "end": pd.Series(ends, dtype="int32")})

    return run


def repeated_spans(docs: DataFrame, window: int = 35, group: int = 16, hot: int = 1000, shard_words: int = 1 << 16, text_col: str = "text") -> DataFrame:
    """``(key1, key2, spans)``: word intervals of each text content that lie in windows occurring more than once.

    ``group``: words per anchor group, a power of two below ``window``. ``hot``: an anchor that occurs more often
    is split by window. ``shard_words``: about how many words an index holds. Copies of a text are one content
    with a weight; they are counted before the texts are shuffled.
    """
    texts = only(docs, text=text_col).select(*_content_key(), F.coalesce("text", F.lit("")).alias("text"))
    table = settle(_anchor_table(texts, window, group), "anchors")
    # Stored on its own, so that the join below has a shuffle on either side and Spark can split a hot anchor's rows.
    twice = settle(table.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "twice")
    runs = (
        table.join(twice, "anchor").select(*KEY, F.struct("first", "windows", "anchor", (F.col("n") > hot).alias("hot")).alias("run"))
        .distinct().groupBy(*KEY).agg(F.collect_list("run").alias("runs"))
    )
    runs = settle(runs, "runs")
    contents = texts.groupBy(*KEY).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    passages = settle(_passages(contents.join(runs, KEY), window), "passages")
    distinct = passages.groupBy("id", "route").agg(F.first("passage").alias("passage"), F.sum("copies").alias("copies"))
    total = passages.agg(F.sum(F.length("passage"))).first()[0] or 0
    shards = max(1, total // (6 * shard_words))
    found = (
        distinct.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards))).groupBy("shard")
        .applyInPandas(_shard_search(window), "id binary, begin int, end int")
    )
    placed = passages.select(*KEY, "first", "id").join(settle(found, "matches"), "id")
    span = F.struct((F.col("first") + F.col("begin")).alias("begin"), (F.col("first") + F.col("end")).alias("end"))
    return placed.groupBy(*KEY).agg(F.collect_list(span).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` per row: ``kept`` are the words left, joined by one space.

    A word goes if a window of ``window`` words over it occurs anywhere else, in the same document too; windows are
    judged on the input. Texts shorter than a window, null and empty texts lose nothing. Copies of a long enough
    text all lose everything, so do repeated rows. An empty table gives an empty result; further columns are not
    read, and neither are ids, which may be null or repeat.
    """
    spans = repeated_spans(docs, window, text_col=text_col, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            counts, removed, kept = [], [], []
            for text, found in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                words = text.encode("utf-8", "replace").split()
                left = words
                if found:
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(gone, [s["begin"] for s in found], 1)
                    np.add.at(gone, [s["end"] for s in found], -1)
                    left = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                counts.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    rows = only(docs, doc_id=id_col, text=text_col).select("doc_id", *_content_key(), F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    joined = rows.join(spans, KEY, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")
