"""Best-fit packing of documents into token sequences, by linear grouping.

Lengths are whole numbers up to the capacity, so their histogram is small however
many documents there are. Large lengths are put into groups of equal cardinality
and rounded up to the largest of their group; a few sizes are left, for which the
configurations of a sequence are optimised (column generation). Actual documents
take the places of the rounded ones, which leaves some room, and everything that
remains is placed best-fit, longest first. The plan says how many sequences are
filled with which lengths; the documents of a length are numbered by Spark, and a
number finds its sequence in the plan.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.texts import only, slices
from tallyloom.sources.tables import stage

#: Words whose ids a worker keeps; what comes later is encoded each time it is met.
KEPT_WORDS = 500_000

#: White space beyond ASCII, and control characters some libraries count as white space.
#: Texts with one of them are encoded whole.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

#: A space beside other white space.
EDGES = [pair for c in "\t\n\v\f\r" for pair in (f" {c}", f"{c} ")] + ["  "]

#: ASCII punctuation that the tokenizer keeps in one run. The apostrophe begins contractions and is left out.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Encoder:
    """Token ids of a byte-level BPE tokenizer, as little-endian 32-bit numbers.

    A single space belongs to the run behind it and no token holds white space behind another character, so a
    text falls apart at single spaces; ids of runs are kept for reuse. Texts with other white space at a run's
    edge, or with a special token, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.merge = self.whole.model.tokenize
        #: What sends a text to the tokenizer whole.
        self.whole_only = (*EDGES, *(t.content for t in self.whole.get_added_tokens_decoder().values()))
        # Bytes that print stand for themselves, the others for characters from 256 on, in order.
        prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in prints]
        self.letters = {b: chr(256 + k) for k, b in enumerate(others)}
        # Ids of runs behind a space, of runs behind nothing, and of the punctuation that ends a run.
        self.spaced: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}
        self.newline = self._encode("\n")

    def _ids(self, ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode(self, text: str) -> bytes:
        return self._ids(self.whole.encode(text, add_special_tokens=False).ids)

    def _one(self, run: str) -> bytes:
        """A run that the tokenizer does not split: straight to its merges."""
        if run.isascii() and run.isprintable():
            # Of these only the space is spelled otherwise.
            spelled = run.replace(" ", self.letters[32])
        else:
            spelled = run.encode("utf-8").decode("latin-1").translate(self.letters)
        return self._ids([t.id for t in self.merge(spelled)])

    def _run(self, part: str, lead: str, known: dict[str, bytes]) -> bytes:
        """Ids of ``lead`` (a space or nothing) and a part without spaces."""
        got = known.get(part)
        if got is not None:
            return got
        word = part.rstrip(PUNCTUATION)
        if word.isalpha():
            end = part[len(word):]
            if end:
                tail = self.ends.get(end)
                if tail is None:
                    tail = self._one(end)
                    if len(self.ends) < 10_000:
                        self.ends[end] = tail
                return self._run(word, lead, known) + tail
            got = self._one(lead + part)
        elif "\n" in part and len(lines := part.split("\n")) and all(lines):
            # A single line break between other characters is a token of its own.
            return self.newline.join([self._run(lines[0], lead, known), *(self._run(x, "", self.bare) for x in lines[1:])])
        else:
            got = self._encode(lead + part)
        if len(known) < KEPT_WORDS and len(part) <= 64:
            known[part] = got
        return got

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if (
            text[0].isspace() or text[-1].isspace()
            or any(s in text for s in self.whole_only)
            or ODD_SPACE.search(text)
        ):
            return self._encode(text)
        parts = text.split(" ")
        tables = list(map(self.spaced.get, parts))
        tables[0] = self._run(parts[0], "", self.bare)
        if None in tables:
            tables = [self._run(p, " ", self.spaced) if t is None else t for p, t in zip(parts, tables)]
        return b"".join(tables)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One encoder per worker, with the ids it keeps."""
    return Encoder(path)


def token_pieces(
    docs: DataFrame, capacity: int = 1024, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: every document as ids and ``end_id``, cut where longer than ``capacity``.

    All pieces of a document but the first are full. A null or empty text is the end id alone.
    """
    def cut(ids: bytes) -> Iterator[tuple[int, int, int, int]]:
        total = len(ids) // 4
        head = total % capacity or capacity
        begins = [0, *range(head, total, capacity)]
        for k, (a, b) in enumerate(zip(begins, [*begins[1:], total])):
            yield k, a, b - a, zlib.crc32(memoryview(ids)[4 * a:4 * b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encoder = _encoder(public_tokenizers.path(tokenizer))
        end = np.array([end_id], dtype="<u4").tobytes()
        for part in slices(batches, "text"):
            rows, taken = [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                for piece in cut(encoder.encode(text or "") + end):
                    taken.append(i)
                    rows.append(piece)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(taken, pa.int64())), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    source = only(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


# --- The plan: from a histogram of lengths to filled sequences. ---


def group_sizes(counts: dict[int, int], least: int, groups: int) -> dict[int, int]:
    """The rounded size of each large length: the largest length of its group of (nearly) equal cardinality."""
    large = sorted((s for s in counts if s >= least), reverse=True)
    share = max(1, -(-sum(counts[s] for s in large) // groups))
    rounded, seen, top = {}, 0, 0
    for s in large:
        if seen == 0 or seen >= share:
            top, seen = s, 0
        rounded[s] = top
        seen += counts[s]
    return rounded


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable multiset of sizes that fits the capacity (unbounded knapsack)."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(int(sizes.min()), capacity + 1):
        fits = np.flatnonzero(sizes <= room)
        gains = value[room - sizes[fits]] + worth[fits]
        k = int(gains.argmax())
        if gains[k] > value[room - 1] + 1e-12:
            value[room], choice[room] = gains[k], fits[k]
        else:
            value[room] = value[room - 1]
    taken, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        taken[choice[room]] += 1
        room -= int(sizes[choice[room]])
    return taken


def configurations(demand: dict[int, int], capacity: int, rounds: int = 2000) -> list[tuple[dict[int, int], int]]:
    """How many whole sequences to fill with which sizes: the linear program of the few sizes, rounded down.

    Column generation: a basis of one configuration per size, improved by the most valuable configuration at
    the present prices until none is worth more than one sequence.
    """
    if not demand:
        return []
    sizes = np.array(sorted(demand), dtype=np.int64)
    need = np.array([demand[int(s)] for s in sizes], dtype=float)
    basis = np.diag((capacity // sizes).astype(float))
    used = need / np.diag(basis)
    for _ in range(rounds):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        fresh = _best_configuration(sizes, worth, capacity)
        if worth @ fresh <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, fresh)
        limits = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        leaves = int(limits.argmin())
        basis[:, leaves] = fresh
        used = np.maximum(np.linalg.solve(basis, need), 0)
    out, left = [], need.astype(np.int64)
    for k in np.argsort(-used):
        column = basis[:, k].astype(np.int64)
        has = column > 0
        times = min(int(used[k] + 1e-6), int((left[has] // column[has]).min()))
        if times > 0:
            left -= times * column
            out.append(({int(sizes[i]): int(column[i]) for i in np.flatnonzero(has)}, times))
    return out


class _Bins:
    """Sequences of equal content as one entry, by free room."""

    def __init__(self) -> None:
        self.by_room: dict[int, Counter] = defaultdict(Counter)
        self.rooms: list[int] = []

    def add(self, content: tuple[int, ...], room: int, times: int) -> None:
        if times:
            if not self.by_room[room]:
                insort(self.rooms, room)
            self.by_room[room][content] += times

    def take(self, room: int, times: int) -> tuple[tuple[int, ...], int]:
        content, have = next(iter(self.by_room[room].items()))
        got = min(have, times)
        self.by_room[room][content] -= got
        if got == have:
            del self.by_room[room][content]
            if not self.by_room[room]:
                self.rooms.remove(room)
        return content, got

    def tightest(self, size: int) -> int | None:
        at = bisect_left(self.rooms, size)
        return self.rooms[at] if at < len(self.rooms) else None


def pack_histogram(counts: dict[int, int], capacity: int, groups: int = 128) -> list[tuple[tuple[int, ...], int]]:
    """Filled sequences ``(lengths, times)`` that hold every length as often as ``counts`` says.

    What counts as large is a choice: rounding costs room that only small documents can fill. Lengths above
    a half and above a quarter of the capacity are both tried, and the plan with fewer sequences is taken.
    """
    plans = [fill(counts, capacity, capacity // part + 1, groups) for part in (2, 4)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def fill(counts: dict[int, int], capacity: int, least: int, groups: int) -> list[tuple[tuple[int, ...], int]]:
    """Linear grouping of lengths from ``least`` on, then best fit of the rest."""
    rounded = group_sizes(counts, least, groups)
    demand, stock = Counter(), defaultdict(list)
    for s in sorted(rounded):
        demand[rounded[s]] += counts[s]
        stock[rounded[s]].append([s, counts[s]])
    bins = _Bins()
    for shape, times in configurations(demand, capacity):
        places = [size for size in sorted(shape, reverse=True) for _ in range(shape[size])]
        while times:
            # As many sequences as can be filled alike: each place takes the longest left of its group.
            wanted: list[list] = []
            for size in places:
                wanted.append(stock[size][-1])
            alike = Counter(id(entry) for entry in wanted)
            n = min(times, *(entry[1] // alike[id(entry)] for entry in wanted))
            if n == 0:
                # A length runs out within one sequence: fill a single one from what there is.
                n, content = 1, []
                for size in places:
                    entry = stock[size][-1]
                    entry[1] -= 1
                    content.append(entry[0])
                    if not entry[1]:
                        stock[size].pop()
            else:
                content = [entry[0] for entry in wanted]
                for entry in wanted:
                    entry[1] -= n
                for size in set(places):
                    while stock[size] and not stock[size][-1][1]:
                        stock[size].pop()
            bins.add(tuple(content), capacity - sum(content), n)
            times -= n
    left = {s: n for s, n in counts.items() if s not in rounded}
    left |= {s: n for entries in stock.values() for s, n in entries if n}
    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            room = bins.tightest(size)
            if room is None:
                content, room, have = (), capacity, n
            else:
                content, have = bins.take(room, n)
            # A sequence stays the tightest until it is full; so it takes as many as fit.
            each = min(room // size, n)
            full = min(have, n // each)
            bins.add(content + (size,) * each, room - each * size, full)
            if content:
                bins.add(content, room, have - full)
            n -= full * each
    return [(content, times) for room in bins.rooms for content, times in bins.by_room[room].items()]


def slots(filled: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[str, np.ndarray]:
    """Where the documents of a length go: runs of numbers ``first..`` of ``length`` lie in sequences ``sequence..`` at ``offset``."""
    rows, used, sequence = [], Counter(), 0
    for content, times in filled:
        offset = 0
        for length in content:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "first": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def _numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` (stored, with ``_block`` and ``_row``) with ``number``, 0.. within each length.

    Rows are numbered within their length and block, and blocks within a length by running totals; so no task
    holds all documents of a length.
    """
    sizes = pieces.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begin = sizes.select("length", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    inside = F.row_number().over(Window.partitionBy("length", "_block").orderBy("_row")) - 1
    return pieces.withColumn("_inside", inside).join(begin, ["length", "_block"]).withColumn("number", F.col("_begin") + F.col("_inside"))


def pack(
    docs: DataFrame, capacity: int = 1024, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2, groups: int = 128,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece of each document.

    A document stays whole unless it is longer than ``capacity``. Every row is packed: repeated rows take a
    place each, a null or empty text is its end id alone, and a null id is kept. An empty table gives an empty
    result; further columns are not read. The driver sees the histogram of lengths (``capacity`` numbers at most)
    and the plan made from it, whose size does not depend on the number of documents.
    """
    pieces = token_pieces(docs, capacity, tokenizer, end_id, id_col, text_col)
    stored = stage(
        pieces.withColumns({"_block": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "pieces"
    )
    counts = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = slots(pack_histogram(counts, capacity, groups=groups), capacity)
    # One sorted key for a look-up by length and number.
    keys = plan["length"] * (1 << 48) + plan["first"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if not part.num_rows:
                continue
            length, number = (part.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            at = np.searchsorted(keys, length * (1 << 48) + number, side="right") - 1
            sequence = plan["sequence"][at] + number - plan["first"][at]
            kept = [part.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(plan["offset"][at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = stored.schema["doc_id"].dataType.simpleString()
    return _numbered(stored).select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
