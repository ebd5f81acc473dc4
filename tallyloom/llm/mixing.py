"""Mixing to target weights with soft domain membership.

A classifier, trained on a bounded number of labelled documents, gives every
document the posterior of each domain. The expected tokens of a domain are then
sums over documents, and nonnegative rates per document are fitted so that they
meet the targets: distributed projected gradient on least squares, of which only
one total per domain comes to the driver in each step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.texts import only, slices
from tallyloom.sources.tables import stage

#: Domains as the label table tells them apart.
DOMAINS = ("clean", "low", "toxic")


def domain(quality: Column, toxic: Column) -> Column:
    """The domain number of a label row; null where a label is missing."""
    return F.when(toxic == 1, F.lit(2)).when(quality == 1, F.lit(0)).when(quality == 0, F.lit(1))


# --- Features and classifier ---

HASH_BITS = 18
DENSE = 6


def features(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """``(word features, dense features, words)`` of one text: hashed distinct words without case and edge signs, and shares."""
    words = text.encode("utf-8", "replace").split()
    n = max(1, len(words))
    joined = b"".join(words)
    size = max(1, len(joined))
    distinct = set(words)
    digest = xxhash.xxh3_64_intdigest
    stripped = {w.strip(b".,;:!?()[]{}\"'#*$%&|<>").lower() for w in distinct} - {b""}
    hashed = np.fromiter((digest(w) & ((1 << HASH_BITS) - 1) for w in stripped), dtype=np.int64, count=len(stripped))
    signs = sum(joined.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))
    upper = len(joined) - len(joined.translate(None, bytes(range(65, 91))))
    digits = len(joined) - len(joined.translate(None, b"0123456789"))
    dense = np.array([
        np.log1p(len(words)) / 10, signs / n, 4 * upper / size, 4 * digits / size, len(distinct) / n, joined.count(b"!") / n,
    ])
    return hashed, dense, len(words)


@dataclass
class Classifier:
    """Softmax regression over hashed words and dense features."""

    words: np.ndarray  # per domain, by hashed word
    dense: np.ndarray  # per domain
    bias: np.ndarray

    def posterior(self, hashed: np.ndarray, dense: np.ndarray) -> np.ndarray:
        score = self.bias + self.dense @ dense
        if len(hashed):
            # Words count as a sum: one telling word in a long text must not drown.
            score = score + self.words[:, hashed].sum(axis=1)
        score = np.exp(score - score.max())
        return score / score.sum()


def fit(rows: list[tuple[np.ndarray, np.ndarray]], domains: np.ndarray, least_docs: int = 3, epochs: int = 200) -> Classifier:
    """Train on labelled feature rows.

    A word takes part if it tells domains apart: in ``least_docs`` documents, and far more often in one domain than
    in the others. Weights of words are log ratios of their document shares, which needs no iteration and does not
    overfit rare words; the dense part and the overall weight are then fitted by gradient steps. Without rows every
    domain is equally likely.
    """
    k = len(DOMAINS)
    if not rows:
        return Classifier(np.zeros((k, 1 << HASH_BITS)), np.zeros((k, DENSE)), np.zeros(k))
    counts, docs = np.zeros((k, 1 << HASH_BITS)), np.bincount(domains, minlength=k).astype(float)
    for (hashed, _), d in zip(rows, domains):
        np.add.at(counts[d], hashed, 1)
    share = (counts + 0.5) / (docs[:, None] + 1)
    rest = (counts.sum(axis=0) - counts + 0.5) / (docs.sum() - docs[:, None] + 1)
    ratio = np.log(share / rest)
    telling = (counts >= least_docs) & (ratio > 2.0)
    words = np.where(telling, ratio, 0.0)
    dense = np.array([d for _, d in rows]).reshape(-1, DENSE)
    sums = np.array([words[:, h].sum(axis=1) if len(h) else np.zeros(k) for h, _ in rows]).reshape(-1, k)
    truth = np.eye(k)[domains]
    # Per domain: a scale for the words' evidence, dense weights and a bias.
    scale, weights, bias = np.full(k, 0.5), np.zeros((k, DENSE)), np.log((docs + 1) / (docs.sum() + k))
    middle, spread = dense.mean(axis=0), dense.std(axis=0) + 1e-9
    unit = (dense - middle) / spread
    moment = [np.zeros_like(scale), np.zeros_like(weights), np.zeros_like(bias)]
    n = max(1, len(rows))
    for _ in range(epochs):
        score = sums * scale + unit @ weights.T + bias
        score = np.exp(score - score.max(axis=1, keepdims=True))
        error = score / score.sum(axis=1, keepdims=True) - truth
        slopes = [(error * sums).sum(axis=0) / n, error.T @ unit / n + 1e-4 * weights, error.mean(axis=0)]
        for k_, (m, s) in enumerate(zip(moment, slopes)):
            moment[k_] = 0.9 * m + s
        scale, weights, bias = scale - 0.05 * moment[0], weights - 0.5 * moment[1], bias - 0.5 * moment[2]
    scale = np.maximum(scale, 0)
    return Classifier(words * scale[:, None], weights / spread, bias - (weights / spread) @ middle)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """A classifier from at most ``max_labelled`` labelled documents, those of the least hashed ids.

    A label row without a text, or with a null label, takes no part; of several labels of one document each counts.
    Texts are turned into features where they lie; a document sends its distinct hashed words to the driver.
    """
    told = labels.select(F.col("doc_id").alias("_id"), domain(F.col("quality"), F.col("toxic")).alias("domain")).filter("domain IS NOT NULL AND _id IS NOT NULL")
    picked = stage(told.orderBy(F.xxhash64("_id"), "_id", "domain").limit(max_labelled), "labelled")
    texts = only(docs, _id=id_col, text=text_col).filter("text IS NOT NULL").join(picked, "_id").select("_id", "domain", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = [features(t)[:2] for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), part.column("domain"), pa.array([h.astype("<i4").tobytes() for h, _ in rows], pa.binary()),
                 pa.array([d.astype("<f8").tobytes() for _, d in rows], pa.binary())],
                names=["_id", "domain", "hashed", "dense"],
            )

    kind = texts.schema["_id"].dataType.simpleString()
    # At most so many rows however often an id repeats.
    rows = texts.mapInArrow(run, f"_id {kind}, domain int, hashed binary, dense binary").orderBy(F.xxhash64("_id"), "_id", "domain", "hashed").limit(max_labelled).collect()
    data = [(np.frombuffer(r["hashed"], "<i4").astype(np.int64), np.frombuffer(r["dense"], "<f8")) for r in rows]
    return fit(data, np.array([r["domain"] for r in rows], dtype=np.int64))


def memberships(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key1, key2, n_tokens, p_<domain>...)`` per row. Tokens are words; a null or empty text has none.

    ``key1`` and ``key2`` address the content, so that decisions can be joined back without relying on ids.
    """
    names = [f"p_{d}" for d in DOMAINS]
    model = docs.sparkSession.sparkContext.broadcast(classifier)  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            made = [features(t or "") for t in part.column("text").to_pylist()]
            shares = np.array([model.value.posterior(h, d) for h, d, _ in made]).reshape(-1, len(DOMAINS))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key1"), part.column("key2"), pa.array([n for _, _, n in made], pa.int64()),
                 *(pa.array(shares[:, k]) for k in range(len(DOMAINS)))],
                names=["doc_id", "key1", "key2", "n_tokens", *names],
            )

    source = only(docs, doc_id=id_col, text=text_col).select("doc_id", *content_key("text"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, key1 long, key2 long, n_tokens long, " + ", ".join(f"{n} double" for n in names))


def content_key(text_col: str) -> list[Column]:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return [F.xxhash64(text).alias("key1"), F.xxhash64(F.lit(1), text).alias("key2")]


# --- Rates ---


@dataclass
class Rates:
    """Rates as the fold of all gradient steps taken, from 1 on: no state is kept per document."""

    targets: np.ndarray
    ridge: float
    most: float
    #: What each step has weighted the domains with.
    slopes: list[np.ndarray] = field(default_factory=list)

    def of(self, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates of documents with the given posteriors (documents x domains), and the point of the next step."""
        rate = point = np.ones(len(shares))
        for t, slope in enumerate(self.slopes):
            before, rate = rate, np.clip(point - (shares @ slope + self.ridge * (point - 1)) / (1 + self.ridge), 0.0, self.most)
            point = rate + t / (t + 3) * (rate - before)
        return rate, point


def fit_rates(
    members: DataFrame, targets: dict[str, float], steps: int = 60, ridge: float = 2e-4, most: float = np.inf, near: float = 0.002
) -> Rates:
    """Rates from 0 to ``most`` by accelerated projected gradient on least squares.

    Minimised are the squares of expected domain tokens minus ``targets``, weighted by the inverse of the matrix of
    domain overlaps, and ``ridge`` times the squares of ``r - 1``, weighted by tokens: of the many rates that meet the
    targets those that treat documents most alike. Under this weight overlapping domains do not slow each other down:
    where no rate is cut off, one step meets the targets. A document's gradient is divided by its tokens, so rates
    depend on posteriors alone. Each step reads the stored memberships and returns one total per domain; rates are
    worked out anew from the steps so far, so a lost task costs its own rows only. The work ends when every total
    lies within ``near`` of its target, when a step moves none by a quarter of that, or after ``steps``.
    """
    k, names = len(DOMAINS), [f"p_{d}" for d in DOMAINS]
    pairs = [F.sum(F.col("n_tokens") * F.col(a) * F.col(b)).alias(f"m{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names)]
    row = members.agg(*pairs, *(F.sum(F.col("n_tokens") * F.col(n)).alias(n) for n in names)).first()
    supply = np.array([row[n] or 0.0 for n in names])
    fitted = Rates(np.array([float(targets.get(d, 0.0)) for d in DOMAINS]), ridge, most)
    if not supply.sum():
        return fitted
    gram = np.array([[row[f"m{i}_{j}"] or 0.0 for j in range(k)] for i in range(k)])
    # A domain that hardly occurs has no overlap to speak of, and nothing to divide by.
    weight = np.linalg.inv(gram + 1e-9 * np.trace(gram) * np.eye(k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * k)
        for part in batches:
            shares = np.stack([part.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)
            tokens = part.column("n_tokens").to_numpy(zero_copy_only=False)
            total += np.concatenate([(tokens * r) @ shares for r in fitted.of(shares)])
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], names=columns)

    columns = [*names, *(f"point_{n}" for n in names)]
    totals = reached = supply
    scale = np.where(fitted.targets > 0, fitted.targets, supply)
    for _ in range(steps):
        fitted.slopes.append(weight @ (totals - fitted.targets))
        sums = members.select("n_tokens", *names).mapInArrow(run, ", ".join(f"{n} double" for n in columns))
        got = sums.agg(*(F.sum(n).alias(n) for n in columns)).first()
        before = reached
        reached, totals = (np.array([got[n] or 0.0 for n in part]) for part in (columns[:k], columns[k:]))
        if (np.abs(reached - fitted.targets) <= near * fitted.targets).all() or (np.abs(reached - before) <= near / 4 * scale).all():
            break
    return fitted


def targets_from(members: DataFrame, weights: dict[str, float]) -> dict[str, float]:
    """Tokens per domain: each domain's expected supply times its weight."""
    row = members.agg(*(F.sum(F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in DOMAINS)).first()
    return {d: (row[d] or 0.0) * weights.get(d, 0.0) for d in DOMAINS}


def with_rates(members: DataFrame, fitted: Rates) -> DataFrame:
    """``members`` with ``rate``."""
    names = [f"p_{d}" for d in DOMAINS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            shares = np.stack([part.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fitted.of(shares)[0])], names=[*part.schema.names, "rate"])

    return members.mapInArrow(run, T.StructType([*members.schema.fields, T.StructField("rate", T.DoubleType())]))


def mix(
    docs: DataFrame, labels: DataFrame, weights: dict[str, float], max_labelled: int = 4000, most: float = np.inf,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, key1, key2, n_tokens, p_<domain>..., rate)`` per row of ``docs``.

    ``weights``: how much of each domain's expected tokens is wanted; 1 keeps it, 0 leaves it out, 2 doubles it.
    A rate is how often a document is to be taken on average, ``most`` at most; targets that such rates cannot meet
    are approached. Without any labels every domain is equally likely.
    Null and empty texts have no tokens and get a rate like other texts of their posterior. Repeated rows stay, with
    the same rate; an empty table gives an empty result; further columns are not read.
    """
    classifier = train(docs, labels, max_labelled, id_col, text_col)
    members = stage(memberships(docs, classifier, id_col, text_col), "memberships")
    return with_rates(members, fit_rates(members, targets_from(members, weights), most=most))


#: Contents that are drawn side by side, one after the other.
_TURN = 4096


def copies(mixed: DataFrame) -> DataFrame:
    """``(key1, key2, copies)`` per content: how often it is taken, its rate rounded up or down.

    Rates are added up along the contents of a bucket, by likeliest domain and by tokens, and a content is taken as
    often as the sum passes a whole number. So long and short texts of a domain are taken in equal parts, where draws
    on their own would stray by the square root of their number. Buckets and order are hashes of the content:
    the same rows stay in every run, and a bucket holds about ``_TURN`` contents.
    """
    contents = stage(
        mixed.groupBy("key1", "key2").agg(F.first("rate").alias("rate"), F.sum("n_tokens").alias("tokens"), *(F.first(f"p_{d}").alias(f"p_{d}") for d in DOMAINS)), "contents"
    )
    n = contents.count() // _TURN + 1
    place = F.xxhash64(F.lit(2), "key1", "key2")
    likeliest = F.array_position(F.array(*(F.col(f"p_{d}") for d in DOMAINS)), F.greatest(*(F.col(f"p_{d}") for d in DOMAINS)))
    dealt = contents.withColumns({"_bucket": F.pmod(place, F.lit(n)), "_domain": likeliest, "_place": F.xxhash64(F.lit(3), "key1", "key2")})
    along = Window.partitionBy("_bucket").orderBy("_domain", "tokens", "_place", "key1", "key2").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Each bucket begins somewhere between two whole numbers. Sums are in whole millionths, so they do not depend on rounding.
    begin = F.pmod(F.xxhash64(F.lit(4), "_bucket"), F.lit(1_000_000))
    share = F.round(F.col("rate") * 1_000_000).cast("long")
    passed = F.sum(share).over(along) + begin
    whole = lambda c: (c - F.pmod(c, F.lit(1_000_000))) / 1_000_000
    return dealt.select("key1", "key2", (whole(passed) - whole(passed - share)).cast("int").alias("copies"))


def draw(docs: DataFrame, mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` as often as the rates ask for (``copies``): rows that are not taken go, rows taken twice come twice.

    Rows of one content are taken alike. Only the contents that are not taken just once are looked up.
    """
    odd = copies(mixed).filter("copies <> 1").select(F.col("key1").alias("_key1"), F.col("key2").alias("_key2"), F.col("copies").alias("_copies"))
    marked = docs.withColumns(dict(zip(("_key1", "_key2"), content_key(text_col))))
    taken = marked.join(odd, ["_key1", "_key2"], "left").withColumn("_copies", F.coalesce("_copies", F.lit(1)))
    return taken.filter("_copies > 0").withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).select(*docs.columns)
