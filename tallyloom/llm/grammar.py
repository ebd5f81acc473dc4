"""Token ids in grammar-compressed files (Re-Pair), with random access.

Documents are sorted by id, encoded, and their ids strung together in blocks of about a million. Within a block the
most frequent pairs of neighbours are replaced by a new symbol, again and again, until that saves little. A block
is one row of a Parquet file: the rules in the order they were made, the number of ids that each rule expands to,
the symbols that are left, and the ids and lengths of the block's documents. The lengths say which symbols hold
ids ``a`` to ``b``, so a document or any slice is decoded by expanding those symbols alone.

A round replaces many pairs at once: those with at least a sixth of the greatest count (in the first round, of the
greatest count of a hash, which pairs may share), where two overlap the more frequent one. This is what the one-by-one
order comes to, but for ties and overlaps of nearly equal count, and it takes whole arrays at a time.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.texts import FREE_SHUFFLES, only, slices

#: Ids of a block at which it is closed. A document is never parted, so a block is at least one document.
BLOCK_IDS = 1 << 20

#: Runs, and words, whose ids a worker holds; it begins anew when they are too many.
HELD_WORDS = 600_000

#: New runs that one call of the library takes, so that its results do not grow with the text.
CALL_RUNS = 1 << 16

#: A round replaces pairs down to this part of the count that the round before began with.
STEP = 6

#: Bits of the hash by which pairs are counted: as many counters as stay near the processor.
SHORT = 18

#: Symbols below are token ids, symbols from here on are rules.
FIRST_RULE = 1 << 20

#: Control characters that Python takes for white space and the tokenizer does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"


#: Fixed value: the runs that the tokenizer parts a text into, for text in lower case below U+0100.
_LETTERS, _DIGITS, _SPACES = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\t-\r \x85\xa0"
APART = f"[{_DIGITS}]|[^{_LETTERS}{_DIGITS}{_SPACES}]+"
RUNS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}{_SPACES}]+")


class WordEncoder:
    """Ids of a BPE tokenizer that drops white space, as little-endian 32-bit numbers.

    No token crosses from one run of letters, digit or run of punctuation to the next, so a text in Latin letters is
    parted into runs, whose ids are held for the next time they come. Of other texts, words are encoded one by one, as
    white space ends a token; a text with a special token is encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.whole = Tokenizer.from_file(path)
        #: The merges alone: for runs already spelled, with spaces between them.
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        #: Whether a token ends a run, per id.
        vocab, suffix = self.whole.get_vocab(), self.whole.model.end_of_word_suffix
        self.ends_run = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends_run[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        # Bytes that print stand for themselves, the others for characters from 256 on, in order.
        prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.letters = np.arange(256, dtype="<u4")
        others = [b for b in range(256) if b not in prints]
        self.letters[others] = 256 + np.arange(len(others))
        # Between runs.
        self.letters[32] = 32
        self.runs: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _merge(self, runs: list[str]) -> list[bytes]:
        """The ids of each of some runs, straight from the merges: one call of the library for all of them."""
        spelled = self.letters[np.frombuffer(" ".join(runs).encode("utf-8"), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self.merges.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = ((np.flatnonzero(self.ends_run[ids]) + 1) * 4).tolist()
        if len(stops) != len(runs):
            # A vocabulary without ends, or not for every character: run by run.
            return [np.array([t.id for t in self.whole.model.tokenize(run)], dtype="<u4").tobytes() for run in spelled.split(" ") if run]
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def _tables(self, words: list[str]) -> list[bytes]:
        """The ids of each of some words of Latin text; what white space other than ASCII's holds together is parted."""
        found = list(map(self.runs.get, words))
        if None not in found:
            return found
        missing = [word for word, ids in zip(words, found) if ids is None]
        parts = {word: RUNS.findall(word) for word in missing if not word.isalpha()}
        mixed = {word: runs for word, runs in parts.items() if runs != [word]}
        fresh = list(dict.fromkeys(word for word in missing if word not in mixed))
        known: dict[str, bytes] = {}
        for i in range(0, len(fresh), CALL_RUNS):
            some = fresh[i:i + CALL_RUNS]
            known.update(zip(some, self._merge(some)))
        held = {run: ids for run, ids in islice(known.items(), HELD_WORDS) if len(run) <= 64}
        if len(self.runs) + len(held) > HELD_WORDS:
            self.runs.clear()
        self.runs.update(held)
        if mixed:
            # These are runs, and runs are not mixed.
            runs = list(dict.fromkeys(chain.from_iterable(mixed.values())))
            own = dict(zip(runs, self._tables(runs)))
            known.update((word, b"".join([own[run] for run in runs])) for word, runs in mixed.items())
        return [known[word] if ids is None else ids for word, ids in zip(words, found)]

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            got = self._encode(word)
            _hold(self.words, word, got)
        return got

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._encode(text)
        if _is_latin(text):
            return b"".join(self._tables(RUNS.findall(text.lower())))
        if any(c in text for c in SEPARATORS):
            return self._encode(text)
        parts = text.split()
        found = list(map(self.words.get, parts))
        if None in found:
            found = [self._word(part) if ids is None else ids for part, ids in zip(parts, found)]
        return b"".join(found)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and how many each has.

        The runs of all texts in Latin letters are parted and made distinct as one array, so a run costs Python's time
        once however often it occurs. An apostrophe may begin a contraction; texts with one are parted by themselves.
        """
        plain = np.array([
            _is_latin(t) and "'" not in t and not any(s in t for s in self.special) and not any(c in t for c in SEPARATORS) for t in texts
        ], dtype=bool)
        told = {i: np.frombuffer(self.encode(texts[i]), "<u4") for i in np.flatnonzero(~plain).tolist()}
        lower = pc.utf8_lower(pa.array([t for t, p in zip(texts, plain) if p], pa.string()))
        parted = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, APART, r" \0 "))
        words = parted.flatten().dictionary_encode()
        tables = self._tables(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, tables), dtype=np.int64, count=len(tables)) >> 2
        flat, starts = np.frombuffer(b"".join(tables), "<u4"), np.cumsum(sizes) - sizes
        which = words.indices.to_numpy()
        n = sizes[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(starts[which] - ends[:-1], n) + np.arange(ends[-1])]
        cuts = ends[parted.offsets.to_numpy() - parted.offsets[0].as_py()]
        lengths = np.empty(len(texts), dtype=np.int64)
        lengths[plain] = np.diff(cuts)
        for i, own in told.items():
            lengths[i] = len(own)
        if told:
            mine = iter(np.split(ids, cuts[1:-1]) if plain.any() else [])
            ids = np.concatenate([told[i] if i in told else next(mine) for i in range(len(texts))])
        return ids, lengths


def _hold(known: dict[str, bytes], text: str, ids: bytes) -> None:
    if len(known) >= HELD_WORDS:
        known.clear()
    if len(text) <= 64:
        known[text] = ids


def _is_latin(text: str) -> bool:
    """Whether all characters lie below U+0100."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """One encoder per worker, with the words it holds."""
    return WordEncoder(path)


# --- The grammar of one block. ---


def _shortened(x: np.ndarray, spread: int) -> np.ndarray:
    """A short hash of each pair of neighbours; ``spread`` is an odd number."""
    return ((x[:-1] * np.uint32(spread) ^ x[1:] * np.uint32(2246822519)) >> np.uint32(32 - SHORT)).astype(np.int64)


def _frequent(x: np.ndarray, short: np.ndarray, shared: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The positions of pairs that occur ``least`` times, the number of the pair at each, and the pairs' counts.

    Pairs are told apart by their short hash, which occurs ``shared`` times: of pairs that share one, one is counted
    and the others wait for a round with another hash.
    """
    at = np.flatnonzero((shared >= least).take(short))
    short, codes = short.take(at), x.take(at).astype(np.uint64) << np.uint64(32) | x.take(at + 1)
    held = np.zeros(1 << SHORT, dtype=np.uint64)
    held[short] = codes
    same = held.take(short) == codes
    at, pair = at[same], short[same]
    counts = np.bincount(pair, minlength=1 << SHORT)
    keep = counts >= least
    kept = keep.take(pair)
    return at[kept], (np.cumsum(keep) - 1).take(pair[kept]), counts[keep]


def _chosen(at: np.ndarray, pair: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which of the positions are replaced: of overlapping pairs the more frequent, of a run of one pair every other."""
    if not len(at):
        return np.zeros(0, dtype=bool)
    order = np.argsort(counts, kind="stable")
    weight = np.empty(len(counts), dtype=np.int64)
    weight[order] = np.arange(len(counts))
    w = weight[pair]
    beside = np.diff(at) == 1
    starts = np.flatnonzero(np.concatenate([[True], ~beside | (np.diff(w) != 0)]))
    sizes = np.diff(np.append(starts, len(at)))
    run_weight, begin, end = w[starts], at[starts], at[starts] + sizes
    touches = begin[1:] == end[:-1]
    wins = np.ones(len(starts), dtype=bool)
    wins[1:] &= ~touches | (run_weight[1:] > run_weight[:-1])
    wins[:-1] &= ~touches | (run_weight[:-1] > run_weight[1:])
    inside = np.arange(len(at)) - np.repeat(starts, sizes)
    return np.repeat(wins, sizes) & (inside % 2 == 0)


def compress(ids: np.ndarray, least: int = 8, gain: float = 0.005) -> tuple[np.ndarray, list[np.ndarray]]:
    """The symbols that stand for ``ids``, and the rules by rounds: pairs of symbols, numbered from ``FIRST_RULE`` on.

    A rule names earlier rules only. ``least`` is how often a pair occurs to be worth a rule; the work ends with the
    first round down to that count that shortens what is left by less than the part ``gain``.
    """
    x, rounds, made = ids.astype(np.uint32), [], FIRST_RULE
    threshold, spread = 0, 2654435761
    while len(x) > 1:
        short = _shortened(x, spread)
        shared = np.bincount(short, minlength=1 << SHORT)
        if not threshold:
            # No pair occurs more often than its hash.
            threshold = max(least, int(shared.max()) // STEP)
        at, pair, counts = _frequent(x, short, shared, threshold)
        taken = _chosen(at, pair, counts)
        at, pair = at[taken], pair[taken]
        # Overlaps may leave a pair too few places for a rule.
        enough = np.bincount(pair, minlength=len(counts)) >= least
        held = enough[pair]
        at, pair = at[held], (np.cumsum(enough) - 1)[pair[held]]
        if len(at):
            first = np.empty(int(enough.sum()), dtype=np.int64)
            first[pair[::-1]] = at[::-1]
            rounds.append(np.stack([x[first], x[first + 1]], axis=1))
            gone = np.zeros(len(x), dtype=bool)
            gone[at + 1] = True
            x[at] = (made + pair).astype(np.uint32)
            x = x[~gone]
            made += len(first)
        if threshold == least and len(at) <= gain * len(x):
            break
        spread = (spread * 69069 | 1) % (1 << 32)
        threshold = max(least, threshold // STEP)
    return x, rounds


class Grammar:
    """A block to read from: ``ids(a, b)`` are the ids at places ``a`` to ``b``."""

    def __init__(self, symbols: np.ndarray, rounds: list[np.ndarray], spans: np.ndarray | None = None):
        self.symbols = symbols
        n = sum(map(len, rounds))
        #: What each rule expands to, one after the other.
        self.flat = np.zeros(0, dtype=np.uint32)
        self.begin, self.span = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        at = 0
        for rules in rounds:
            sizes = self._spans(rules).sum(1)
            self.span[at:at + len(rules)] = sizes
            ends = np.cumsum(sizes)
            expanded = self.expand(rules.ravel())
            self.begin[at:at + len(rules)] = len(self.flat) + ends - sizes
            self.flat = np.concatenate([self.flat, expanded])
            at += len(rules)
        if spans is not None and not np.array_equal(spans, self.span):
            raise ValueError("a block's expansion lengths do not fit its rules")
        self.ends = np.cumsum(self._spans(symbols))

    def _spans(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        out = np.ones(symbols.shape, dtype=np.int64)
        rules = symbols >= FIRST_RULE
        out[rules] = self.span[symbols[rules] - FIRST_RULE]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        spans = self._spans(symbols)
        starts = np.cumsum(spans) - spans
        out = np.empty(int(spans.sum()), dtype=np.uint32)
        rules = symbols >= FIRST_RULE
        out[starts[~rules]] = symbols[~rules]
        sizes, rule = spans[rules], symbols[rules] - FIRST_RULE
        # Each place of a rule's expansion, less its place within all of them.
        before = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum()))
        out[np.repeat(starts[rules] - before, sizes) + place] = self.flat[np.repeat(self.begin[rule] - before, sizes) + place]
        return out

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.zeros(0, dtype=np.uint32)
        first, last = np.searchsorted(self.ends, [a, b - 1], side="right")
        before = int(self.ends[first - 1]) if first else 0
        return self.expand(self.symbols[first:last + 1])[a - before:b - before]


# --- Files. ---

#: A block: which part of the sorted table it belongs to, its number there, the part's ids before it, its documents,
#: the rules with the number of rules per round and the ids each expands to, and the symbols.
BLOCK = (
    "part int, block int, part_start long, n_ids long, doc_ids array<{kind}>, lengths array<long>, "
    "rounds array<int>, rules binary, spans binary, symbols binary"
)


def _block(part: int, number: int, start: int, doc_ids: list[pa.Array], held: list[bytes], least: int) -> pa.RecordBatch:
    lengths = [len(b) // 4 for b in held]
    ids = np.frombuffer(b"".join(held), dtype="<u4")
    symbols, rounds = compress(ids, least)
    rules = np.concatenate(rounds) if rounds else np.zeros((0, 2), dtype=np.uint32)
    spans = Grammar(np.zeros(0, dtype=np.uint32), rounds).span
    names = pa.concat_arrays(doc_ids)
    one = lambda a, kind: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a, kind))
    columns = {
        "part": pa.array([part], pa.int32()), "block": pa.array([number], pa.int32()), "part_start": pa.array([start], pa.int64()),
        "n_ids": pa.array([len(ids)], pa.int64()),
        "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
        "lengths": one(lengths, pa.int64()), "rounds": one([len(r) for r in rounds], pa.int32()),
        "rules": pa.array([rules.astype("<u4").tobytes()], pa.binary()), "spans": pa.array([spans.astype("<u4").tobytes()], pa.binary()),
        "symbols": pa.array([symbols.astype("<u4").tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def write_ids(
    docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, least: int = 8, block_ids: int = BLOCK_IDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the ids of all documents, each with ``end_id`` behind it, in ascending order of document id.

    A null id comes first; equal ids follow each other by their text's hash. A null or empty text is the end id
    alone. An empty table writes no block. Columns other than the two are not read. A task holds a block at a time,
    and a block follows the longest text where that is longer than ``block_ids``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encoder = _encoder(public_tokenizers.path(tokenizer))
        end = np.array([end_id], dtype="<u4").tobytes()
        part, number, start = TaskContext.get().partitionId(), 0, 0
        names: list[pa.Array] = []
        held: list[bytes] = []
        waiting = 0
        for batch in slices(batches, "text", 4 << 20):
            ids, begin = batch.column("doc_id"), 0
            found, lengths = encoder.encode_all([t or "" for t in batch.column("text").to_pylist()])
            cuts = np.concatenate([[0], np.cumsum(lengths)]).tolist()
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                held.append(found[a:b].tobytes() + end)
                waiting += b - a + 1
                if waiting >= block_ids:
                    names.append(ids.slice(begin, i + 1 - begin))
                    yield _block(part, number, start, names, held, least)
                    number, start, begin, waiting, names, held = number + 1, start + waiting, i + 1, 0, [], []
            if begin < batch.num_rows:
                names.append(ids.slice(begin))
        if held:
            yield _block(part, number, start, names, held, least)

    spark, source = docs.sparkSession, only(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    # Equal ids, also of many equal rows, still tell apart, so no range is larger than another.
    keys = ["doc_id", F.xxhash64("text"), "_row"]
    rows = source.withColumn("_row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        ordered.mapInArrow(run, BLOCK.format(kind=kind)).write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def _grammar(row: dict) -> Grammar:
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    rounds = np.split(rules, np.cumsum(row["rounds"])[:-1]) if row["rounds"] else []
    return Grammar(np.frombuffer(row["symbols"], "<u4"), rounds, np.frombuffer(row["spans"], "<u4"))


def _part_starts(blocks: DataFrame) -> dict[int, int]:
    """The ids of all earlier parts, per part: as many numbers as the sorted table has partitions."""
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    starts, at = {}, 0
    for part, n in sorted(sums):
        starts[part] = at
        at += n
    return starts


def read_ids(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` per document, from the files: ids as little-endian 32-bit numbers.

    ``start`` counts the ids of all documents before it.
    """
    blocks = spark.read.parquet(path)
    starts = _part_starts(blocks)
    kind = blocks.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("doc_ids")
            for i, row in enumerate(batch.drop_columns(["doc_ids"]).to_pylist()):
                grammar = _grammar(row)
                ends = np.cumsum(row["lengths"])
                begins = ends - row["lengths"]
                # All documents of the block are wanted, so it is expanded once.
                ids = grammar.ids(0, int(ends[-1])).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        names.slice(i, 1).flatten(), pa.array(begins + starts[row["part"]] + row["part_start"]), pa.array(row["lengths"], pa.int64()),
                        pa.array([ids[4 * a:4 * b] for a, b in zip(begins.tolist(), ends.tolist())], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    rows = blocks.drop("n_ids").mapInArrow(run, f"doc_id {kind.simpleString()}, start long, n_tokens long, ids binary")
    return rows.withColumnRenamed("doc_id", id_col)


def slice_ids(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """``(start, ids)``: the ids at places ``start`` to ``stop`` of the whole table, one row per block that holds some.

    Only these blocks are read, and of them only the symbols that cover the slice are expanded.
    """
    blocks = spark.read.parquet(path)
    starts = _part_starts(blocks)
    parts = sorted(starts, key=starts.get)
    # Parts that end before the slice or begin behind it fall out by their number.
    wanted = [p for p, nxt in zip(parts, [*parts[1:], None]) if starts[p] < stop and (nxt is None or starts[nxt] > start)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = starts[row["part"]] + row["part_start"]
                a, b = max(start, at), min(stop, at + row["n_ids"])
                if a < b:
                    ids = _grammar(row).ids(a - at, b - at).astype("<u4").tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([a], pa.int64()), pa.array([ids], pa.binary())], names=["start", "ids"])

    held = blocks.filter(F.col("part").isin(wanted)).drop("doc_ids", "lengths")
    return held.mapInArrow(run, "start long, ids binary")
