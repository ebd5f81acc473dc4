"""Quality rules with adaptive thresholds, in DataFrame functions only.

Measures of each text are taken in one pass without a shuffle. Their distribution
per language and source goes into mergeable KLL sketches, one row per group; the
sketches give each group its own fences, which replace fixed cutoffs, and a join
brings the fences back to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import SPACE_CLASS, let, only
from tallyloom.sources.tables import stage

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Measures under adaptive fences: two quantiles of the group, how often their distance is allowed around the median,
#: and the least that is allowed around it, in thousandths: well below what groups spread, for groups that hardly do.
FENCES = {
    "word_len": (0.25, 0.75, 4, 250),
    # Most texts have no symbols at all, and few have repeated lines, so quartiles would tell nothing there.
    "symbol_rate": (0.1, 0.9, 4, 25),
    "dup_line_rate": (0.01, 0.99, 2, 100),
}

WINDOW = 5


def _covered(starts: Column, width: int) -> Column:
    """How many words lie in windows of ``width`` that begin at the ascending ``starts``."""
    begin = F.struct(F.lit(-width).alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(width), x - a["last"])).alias("n"))
    return F.aggregate(starts, begin, step, lambda a: a["n"])


def _repeat_words(words: Column, n: Column) -> Column:
    """Words in windows that are found twice or more in the text, the first included.

    Windows are compared by 64-bit hashes. Only a text with a repeated window sorts its windows.
    """
    heads = F.slice(words, F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0)))
    hashes = F.transform(heads, lambda _, i: F.xxhash64(F.slice(words, i + 1, F.lit(WINDOW))))

    def repeated(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda x, k, d: F.coalesce(F.get(s, k + d)["h"] == x["h"], F.lit(False))
            twins = F.filter(s, lambda x, k: same(x, k, -1) | same(x, k, 1))
            return _covered(F.sort_array(F.transform(twins, lambda x: x["i"])), WINDOW)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(placed, starts))

    return let(hashes, repeated)


def _measured(text: Column) -> Column:
    """All measures of a text as one struct, each part of the text parted once."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACE_CLASS + "+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w, n).alias("n_repeat_words"),
        )

    def of_lines(x: Column) -> Column:
        n = F.size(x)
        return F.struct(n.cast("long").alias("n_lines"), (n - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    signs = F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols")
    return let(
        F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("l"), signs),
        lambda m: F.struct(*(m[part][name].alias(name) for part, name in (
            ("w", "n_words"), ("w", "word_chars"), ("w", "n_repeat_words"), ("l", "n_lines"), ("l", "n_dup_lines"))), m["n_symbols"].alias("n_symbols")),
    )


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(doc_id, lang, source, n_words, word_chars, n_repeat_words, n_lines, n_dup_lines, n_symbols)`` per row.

    A null text has no words and no lines. Every count is over the whole text.
    """
    rows = only(docs, doc_id=id_col, lang=lang_col, source=source_col, text=text_col)
    return rows.select("doc_id", "lang", "source", _measured(F.col("text")).alias("m")).select("doc_id", "lang", "source", "m.*")


def base_failed(m: Column | None = None, min_words: int = 10, max_repeat_pct: int = 20) -> Column:
    """Rules that need no distribution: too few words, or too many of them in repeated windows."""
    at = F.col if m is None else m.__getitem__
    return (at("n_words") < min_words) | (100 * at("n_repeat_words") > max_repeat_pct * at("n_words"))


def _rates(m: Column | None = None) -> dict[str, Column]:
    """Whole thousandths, so that sketches hold exact numbers."""
    at = F.col if m is None else m.__getitem__

    def per(part: str, whole: str) -> Column:
        # A remainder is taken off first, so the quotient is whole.
        n = 1000 * at(part)
        return F.when(at(whole) > 0, ((n - n % at(whole)) / at(whole)).cast("long")).otherwise(F.lit(0).cast("long"))

    return {"word_len": per("word_chars", "n_words"), "symbol_rate": per("n_symbols", "n_words"), "dup_line_rate": per("n_dup_lines", "n_lines")}


def _sketched(rates: DataFrame, k: int) -> DataFrame:
    # A group of which every row fails the base rules has no values, and needs no fences.
    some = F.count(next(iter(FENCES))).alias("_n")
    made = rates.groupBy("lang", "source").agg(some, *(F.kll_sketch_agg_bigint(name, k).alias(name) for name in FENCES))
    return made.filter("_n > 0").drop("_n")


def sketches(measured: DataFrame, k: int = 4096) -> DataFrame:
    """One row per language and source with a KLL sketch of each measure over rows that pass the base rules.

    Sketches of several batches merge with ``merge_sketches``; one holds a bounded number of values.
    """
    return _sketched(measured.filter(~base_failed()).withColumns(_rates()), k)


def sketches_of_texts(docs: DataFrame, k: int = 4096, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``sketches`` straight from texts, each measured once: rows that fail the base rules send no value instead of being filtered."""
    rows = only(docs, lang=lang_col, source=source_col, text=text_col)
    passed = let(_measured(F.col("text")), lambda m: F.when(~base_failed(m), F.struct(*(c.alias(n) for n, c in _rates(m).items()))))
    return _sketched(rows.select("lang", "source", passed.alias("r")).select("lang", "source", "r.*"), k)


def merge_sketches(batches: DataFrame, k: int = 4096) -> DataFrame:
    """Sketches of several batches as one row per language and source."""
    return batches.groupBy("lang", "source").agg(*(F.kll_merge_agg_bigint(name, k).alias(name) for name in FENCES))


def fences(sketched: DataFrame) -> DataFrame:
    """Per group and measure the ``middle_*``, its median, the ``reach_*`` around it, and whether that ``is_sketched_*``.

    The reach follows ``FENCES``: a multiple of the distance of two quantiles of the group, or the least reach where
    the group hardly spreads.
    """
    at = lambda name, q: F.kll_sketch_get_quantile_bigint(name, F.lit(q))
    columns = []
    for name, (low, high, times, least) in FENCES.items():
        spread = times * (at(name, high) - at(name, low))
        columns += [
            at(name, 0.5).alias(f"middle_{name}"), F.greatest(F.lit(least).cast("long"), spread).alias(f"reach_{name}"),
            (spread >= least).alias(f"is_sketched_{name}"),
        ]
    return sketched.select("lang", "source", *columns)


def _outside(rates: dict[str, Column]) -> dict[str, Column]:
    """Whether each measure lies outside its fence; a group without fences has none to break."""
    return {
        name: F.coalesce(F.abs(rate - F.col(f"middle_{name}")) > F.col(f"reach_{name}"), F.lit(False)) for name, rate in rates.items()
    }


def _any(conditions) -> Column:
    found = F.lit(False)
    for c in conditions:
        found = found | c
    return found


def judge(docs: DataFrame, k: int = 4096, **columns: str) -> DataFrame:
    """The measures of every row with ``base_failed``, ``kept`` and ``by_sketch``.

    ``kept``: the base rules pass and every measure lies within the fences of the row's language and source.
    ``by_sketch``: a fence that the group's own spread has set rejects the row. Rows of a null language or source form
    groups of their own. A null or empty text has no words and is not kept. Repeated rows are judged alike; an empty
    table gives an empty result; further columns are not read. Measures are written once to the shared folder, as both
    the sketches and the verdict need them. The fences join is left to Spark: it is as large as there are groups, and
    a hot group's rows can be split.

    Quantiles are exact up to some thousands of rows per group. Beyond, a sketch of ``k`` is off by about 0.1 % of the
    group's ranks and chooses what it forgets at random, so a row right at a fence may be judged otherwise in another run.
    """
    measured = stage(measures(docs, **columns), "quality_measures")
    limits = stage(fences(sketches(measured, k)), "quality_fences")
    rows, group = measured.alias("r"), limits.alias("g")
    on = F.col("r.lang").eqNullSafe(F.col("g.lang")) & F.col("r.source").eqNullSafe(F.col("g.source"))
    bad, outside = base_failed(), _outside(_rates())
    by_sketch = _any(c & F.col(f"is_sketched_{n}") for n, c in outside.items())
    return rows.join(group, on, "left").select(
        "r.*", bad.alias("base_failed"), (~bad & ~_any(outside.values())).alias("kept"), (~bad & F.coalesce(by_sketch, F.lit(False))).alias("by_sketch")
    )


def keep(docs: DataFrame, k: int = 4096, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` without the rows that ``judge`` does not keep, all columns as they are.

    Texts are measured twice, once for the fences and once for the verdict, instead of being shuffled to meet their
    verdicts, so ids play no part. The verdict is one condition on rows that have their fences already: no part of
    it can be tested on its own, which would measure the text again.
    """
    limits = stage(fences(sketches_of_texts(docs, k, text_col, lang_col, source_col)), "quality_fences")
    limits = limits.select(*(F.col(c).alias(f"_g_{c}" if c in ("lang", "source") else c) for c in limits.columns))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    named = {"_text": text_col, "_lang": lang_col, "_source": source_col}
    rows = docs.select(whole.alias("_row"), *(F.col(f"`{c}`").alias(n) for n, c in named.items()))
    on = F.col("_lang").eqNullSafe(F.col("_g_lang")) & F.col("_source").eqNullSafe(F.col("_g_source"))
    fine = let(_measured(F.col("_text")), lambda m: ~base_failed(m) & ~_any(_outside(_rates(m)).values()))
    return rows.join(limits, on, "left").filter(fine).select("_row.*")
