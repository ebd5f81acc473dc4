"""Exact token counts at every prefix of a text, by dynamic programming.

The vocabulary is a byte-pair model with a rank for each piece. The encoding of a
prefix ends in exactly one piece, and that piece is the one whose predecessor -
the last piece of the shorter prefix - stands beside it unmerged when the two are
encoded together. So one pass over a text yields the last piece and the token
count of every prefix, and truncation or budget questions are look-ups.

No piece holds a space after another character, so a text falls apart into units
(spaces, then a run of other characters) whose tables add up. The punctuation
behind a unit is a part of its own where it stands beside the character before it
in no piece, since no merge can cross there. Tables of units and of their parts
are held for reuse within a worker, which begins anew when they are too many.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import only, slices

#: Stands for a space in pieces.
SPACE = "▁"

#: ASCII punctuation that may follow a word.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: Units, prefixes and pairs of pieces a worker holds, each; a table that is full is cleared, so what is frequent comes back.
HELD = 600_000


class PrefixCounter:
    """Token counts at every prefix for one sentencepiece BPE model.

    ``bounds(text)[j]`` is the number of tokens of the first ``j`` code points.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ordinary = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        #: The better its score, the earlier a piece is merged: rank 0 comes first.
        self.rank = {model.id_to_piece(i): r for r, i in enumerate(sorted(ordinary, key=lambda i: -model.get_score(i)))}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.rank):
            raise ValueError("the model has pieces that cross a space; its texts do not fall apart into units")
        #: How each piece that can come out of an encoding is made: its last merge. Single characters are not merged.
        self.made: dict[str, tuple[str, str] | None] = {}
        for piece in self.rank:
            parts, last = self.merge(piece)
            if len(parts) == 1:
                self.made[piece] = last
        #: The longest piece by its last two characters; no piece that ends so reaches back further.
        self.reach: dict[str, int] = {}
        for piece in self.made:
            self.reach[piece[-2:]] = max(len(piece), self.reach.get(piece[-2:], 1))
        #: Characters that stand beside each other in some piece.
        self.joined = {piece[i:i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        self.prefixes: dict[str, tuple[int, int]] = {}
        self.units: dict[str, bytes] = {}
        self.counts: dict[str, int] = {}
        self.parts: dict[str, bytes] = {}
        self.pairs: dict[str, bool] = {}

    def merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The pieces of a short text, and the last merge: the best-ranked neighbours merge first, the leftmost of equals."""
        parts, rank, last = list(text), self.rank, None
        while len(parts) > 1:
            ranks = [rank.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 30:
                break
            at = ranks.index(best)
            last = (parts[at], parts[at + 1])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def beside(self, left: str, right: str) -> bool:
        """Whether two pieces stay as they are when encoded together.

        Undo their merges, the latest first. At each point the two inner neighbours must not have a merge
        that comes before the one just undone; of equal merges the one further left comes first.
        """
        rank, made = self.rank, self.made
        # The merge undone last: its rank, and whether a merge across of the same rank comes before it.
        undone, across_first = 1 << 30, False
        while True:
            across = rank.get(left + right)
            if across is not None and (across < undone or across_first and across == undone):
                return False
            from_left, from_right = made.get(left), made.get(right)
            if from_left is None and from_right is None:
                return True
            if from_right is None or from_left is not None and rank[left] > rank[right]:
                undone, across_first = rank[left], False
                left = from_left[1]
            else:
                undone, across_first = rank[right], True
                right = from_right[0]

    def _beside(self, left: str, right: str) -> bool:
        """``beside``, from the table of pairs already judged."""
        pair = left + " " + right
        stays = self.pairs.get(pair)
        if stays is None:
            stays = self.beside(left, right)
            if len(self.pairs) >= HELD:
                self.pairs.clear()
            self.pairs[pair] = stays
        return stays

    def table(self, unit: str) -> bytes:
        """Token counts of the prefixes of one unit, as 32-bit numbers. Prefixes met before are not worked out again."""
        prefixes, n = self.prefixes, len(unit)
        if len(prefixes) >= HELD:
            prefixes.clear()
        start, count = [0] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            if i > 24:
                known = self._last(unit, i, start, count)
            else:
                prefix = unit[:i]
                known = prefixes.get(prefix)
                if known is None:
                    known = prefixes[prefix] = self._last(unit, i, start, count)
            start[i], count[i] = known
        return array("i", count[1:]).tobytes()

    def _last(self, unit: str, i: int, start: list[int], count: list[int]) -> tuple[int, int]:
        """Where the last piece of ``unit[:i]`` begins, and the tokens up to its end."""
        made, beside = self.made, self._beside
        # From the longest piece that can end here; a single character always can.
        for j in range(max(0, i - self.reach.get(unit[i - 2:i] if i > 1 else unit[:1], 1)), i):
            piece = unit[j:i]
            if (piece in made or j == i - 1) and (j == 0 or beside(unit[start[j]:j], piece)):
                # A character outside the vocabulary falls back to its bytes.
                return j, count[j] + (1 if piece in made else len(piece.encode("utf-8")))
        raise ArithmeticError(f"no last piece for {unit[:i]!r}")

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            got = self.table(part)
            if len(self.parts) >= HELD:
                self.parts.clear()
            if len(part) <= 64:
                self.parts[part] = got
        return got

    def _halves(self, unit: str) -> tuple[str, str]:
        """A unit without the punctuation behind it, and that punctuation, if no merge can cross in between."""
        stem = unit.rstrip(PUNCTUATION)
        n = len(stem)
        return (stem, unit[n:]) if 0 < n < len(unit) and unit[n - 1:n + 1] not in self.joined else (unit, "")

    def _table_of(self, part: str) -> bytes:
        """The table of a unit, from those of its halves."""
        stem, tail = self._halves(SPACE + part)
        got = self._part(stem)
        if tail:
            before = got[-4:]
            more = array("i", self._part(tail))
            add = int.from_bytes(before, "little")
            got += array("i", [add + n for n in more]).tobytes()
        if len(self.units) >= HELD:
            self.units.clear()
        if len(part) <= 64:
            self.units[part] = got
        return got

    def _count_of(self, part: str) -> int:
        """The tokens of a unit."""
        stem, tail = self._halves(SPACE + part)
        count = int.from_bytes(self._part(stem)[-4:], "little") + (int.from_bytes(self._part(tail)[-4:], "little") if tail else 0)
        if len(self.counts) >= 2 * HELD:
            self.counts.clear()
        if len(part) <= 64:
            self.counts[part] = count
        return count

    @staticmethod
    def _units(text: str) -> list[str]:
        """What stands between single spaces; further spaces go in front of the next unit, at the end they stand alone."""
        parts = text.replace(SPACE, " ").split(" ")
        if "" in parts:
            joined, spaces = [], ""
            for part in parts[:-1]:
                if part:
                    joined.append(spaces + part)
                    spaces = ""
                else:
                    spaces += SPACE
            parts = [*joined, spaces + parts[-1]]
        return parts

    def bounds(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(1, dtype=np.int64)
        parts = self._units(text)
        tables = list(map(self.units.get, parts))
        if None in tables:
            tables = [self._table_of(part) if table is None else table for part, table in zip(parts, tables)]
        flat = np.frombuffer(b"".join(tables), dtype="i4").astype(np.int64)
        sizes = np.fromiter(map(len, tables), dtype=np.int64, count=len(tables)) >> 2
        before = np.cumsum(flat[np.cumsum(sizes) - 1])
        flat[sizes[0]:] += np.repeat(before[:-1], sizes[1:])
        # The model puts one space before a text; the empty prefix has none of it.
        flat[0] = 0
        return flat

    def budget(self, text: str, limit: int) -> tuple[int, int]:
        """The last of ``bounds``, and the last place at which they are within ``limit``.

        Whole units are added up by their tokens; only the unit in which the limit is passed is looked at by prefix.
        """
        if not text:
            return 0, 0
        parts = self._units(text)
        counts = list(map(self.counts.get, parts))
        if None in counts:
            counts = [self._count_of(part) if n is None else n for part, n in zip(parts, counts)]
        total = sum(counts)
        if total <= limit:
            return total, len(text)
        so_far = at = 0
        for part, n in zip(parts, counts):
            if so_far + n > limit:
                break
            so_far, at = so_far + n, at + len(part) + 1
        within = [so_far + t for t in array("i", self._table_of(part))]
        if at == 0:
            within[0] = 0
        fits = [i for i, t in enumerate(within) if t <= limit]
        return total, at + fits[-1] if fits else at - 1


@lru_cache(maxsize=2)
def _counter(model_file: str) -> PrefixCounter:
    """One counter per worker, with its tables."""
    return PrefixCounter(model_file)


def _model_path(model: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(model)


def prefix_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, counts)``: ``counts[j]`` is the number of tokens of the first ``j`` code points of the text.

    The table to store when texts are asked about again and again: ``tokens_of`` and ``longest_prefix`` answer
    from it. A null or empty text has the single count 0. Repeated rows stay; further columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(_model_path(model))
        for part in slices(batches, "text", 1 << 20):
            rows = [counter.bounds(t or "") for t in part.column("text").to_pylist()]
            offsets = np.cumsum([0, *map(len, rows)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(rows).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "counts"])

    source = only(docs, doc_id=id_col, text=text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, counts array<int>")


def tokens_of(counts: str, chars: str):
    """Tokens of the first ``chars`` code points, from a column of ``prefix_counts``."""
    return F.element_at(counts, F.expr(f"int({chars}) + 1"))


def longest_prefix(counts: str, limit: int):
    """The most code points whose tokens fit ``limit``, from a column of ``prefix_counts``."""
    return F.array_max(F.expr(f"filter(transform({counts}, (n, j) -> if(n <= {limit}, j, null)), j -> j IS NOT NULL)"))


def budgets(
    docs: DataFrame, limit: int = 4096, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit, fit_chars)`` per row, each read off the prefix table of the whole text.

    ``fit_chars``: the most code points whose tokens fit ``limit``. A null or empty text has 0 of everything.
    Repeated rows stay; an empty table gives an empty result; further columns are not read. Nothing is shuffled,
    and memory follows the longest text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(_model_path(model))
        for part in slices(batches, "text"):
            out = []
            for text in part.column("text").to_pylist():
                total, fits = counter.budget(text or "", limit)
                out.append((len((text or "").encode("utf-8")), total, total > limit, fits))
            columns = zip(*out)
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    source = only(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
