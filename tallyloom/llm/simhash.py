"""Near duplicates by SimHash: meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 r`` bits have a common neighbour that
differs from each in at most ``r`` bits. So every distinct fingerprint emits all
variants within ``r`` bits, variants meet in one shuffle, and colliding pairs are
verified. With ``r = 1`` a variant has at most 65 emitters, whatever the data:
no bucket needs a cap, and copies never meet because fingerprints are made
distinct first.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.components import connected
from tallyloom.llm.texts import only, slices
from tallyloom.sources.tables import stage

BITS = 64


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of one text over its word shingles, repeats included; 0 without a word.

    A-Z are lower-cased; a text of fewer words than a shingle counts as one shingle.
    """
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)))) if len(parts) >= words else [b" ".join(parts)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, 1 << 14):
        block = hashes[start:start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def text_keys(text: Column) -> tuple[Column, Column]:
    """128 bits that address a text, null as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, key1, key2, fp)`` for every row; ``fp`` holds the 64 bits as a signed long. A null text has no words: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            fps = [fingerprint(t, words, seed) for t in part.column("text").to_pylist()]
            signed = np.array(fps, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "key1", "key2")), pa.array(signed)], names=["doc_id", "key1", "key2", "fp"]
            )

    key1, key2 = text_keys(F.col("text"))
    source = only(docs, doc_id=id_col, text=text_col).select("doc_id", key1.alias("key1"), key2.alias("key2"), "text")
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, key1 long, key2 long, fp long")


def _masks(radius: int) -> list[int]:
    """Every word of 64 bits with at most ``radius`` ones, as signed longs."""
    masks = (sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``(a, b)``, ``a > b``, that join all fingerprints within ``max_bits`` of each other into components.

    ``fps`` has distinct values in ``fp``. Each variant links its emitters to the least of them, so a bucket
    of n emitters gives n - 1 links and not all pairs. Emitters of one variant may lie up to
    ``2 * ceil(max_bits / 2)`` bits apart, so links are verified; where that bound is ``max_bits`` itself
    (even numbers) none is refused, and for odd numbers pairs within a bucket are compared one by one.
    """
    radius = -(-max_bits // 2)
    masks = F.array(*(F.lit(m).cast("long") for m in _masks(radius)))
    balls = fps.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    in_ball = Window.partitionBy("variant").orderBy("fp")
    if max_bits % 2 == 0:
        pairs = balls.select(F.col("fp").alias("a"), F.first("fp").over(in_ball).alias("b"))
    else:
        left = balls.select("variant", F.col("fp").alias("a"))
        pairs = left.join(balls.withColumnRenamed("fp", "b"), "variant").select("a", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return pairs.filter((F.col("a") > F.col("b")) & near).distinct()


def _rooted(marked: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, root, least)`` per distinct fingerprint: its component, and the least ``doc_id`` that has it."""
    roots = connected(links(marked.select("fp").distinct(), max_bits))
    # Names are found over distinct fingerprints; documents, of which a third may share one, only look theirs up.
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2, seed: int = 42
) -> DataFrame:
    """One row per document: ``(doc_id, key1, key2, fp, component_id)``.

    ``component_id`` is the least ``doc_id`` that can be reached over links, its own included. Texts without
    words (null, empty, white space) have fingerprint 0 and link like any other. Repeated rows stay repeated.
    Rows without an id join components by their text and do not name one; a component of such rows only has
    a null id. ``key1`` and ``key2`` address the text, null as empty. An empty table gives an empty result; further
    columns of ``docs`` are not read.
    """
    marked = stage(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    return _named(marked, max_bits).drop("root")


def _named(marked: DataFrame, max_bits: int) -> DataFrame:
    rooted = stage(_rooted(marked, max_bits), "rooted")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "key1", "key2", "fp", "root", "component_id")


def one_per_component(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2, seed: int = 42
) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``: that of the least id, then of the least text key.

    A row with an id goes before rows without. All columns stay as they are; of rows that agree in id and text one
    stays. Fingerprints decide alone. Only the rows that stay meet their texts again, in one shuffle.
    """
    marked = stage(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("blank"), "doc_id", "key1", "key2")
    # Copies are one row per text before the components are reduced.
    texts = _named(marked, max_bits).select("root", "doc_id", "key1", "key2").distinct()
    kept = texts.groupBy("root").agg(F.min(order).alias("row"))
    name = lambda i, a, b: F.concat_ws("/", F.coalesce(i.cast("string"), F.lit("")), F.hex(a), F.hex(b))
    kept = kept.select(name(F.col("row.doc_id"), F.col("row.key1"), F.col("row.key2")).alias("_name"))
    named = docs.withColumn("_name", name(F.col(f"`{id_col}`"), *text_keys(F.col(f"`{text_col}`"))))
    return named.join(kept, "_name", "left_semi").dropDuplicates(["_name"]).select(*docs.columns)
