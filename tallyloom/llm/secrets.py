"""Secret scans over an incremental ledger of blobs.

Every version of a text is addressed by the SHA-256 of its content. The ledger
holds one row per blob and rule version, with the findings (an empty list if
there are none). A scan reads only pairs of blob and rule version that the ledger
does not hold, appends them, and joins findings back to all paths of a blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.texts import only, slices
from tallyloom.sources.tables import stage, work_folder

LEDGER = "blob binary, rule string, version int, spans array<struct<start:long, stop:long>>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds spans, leftmost and without overlap; those whose ``group`` is shorter than ``least`` are dropped."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.finditer(self.pattern, text, re.ASCII)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


#: The patterns of the base rules. A run shorter than its least length cannot hold a longer one, so the
#: lengths of ``access`` and ``hex`` stand in the pattern; a short ``assign`` match takes its characters, so its length does not.
BASE_RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)

#: A private key: up to its END line, before the next BEGIN; without one, over the header fields and base64 runs that
#: follow, the last of which may be short if it has a line of its own or ends in padding.
_BREAK = r"""(?:[\s"'>|#,;+]|\\[rn])+"""
PEM = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]{0,40}PRIVATE KEY-----"
    rf"|(?:\s*(?:Proc-Type|DEK-Info): [^\n]*)*(?:{_BREAK}[A-Za-z0-9+/]{{16,}}={{0,2}})*"
    rf"(?:(?<=[A-Za-z0-9+/=])(?<!-----){_BREAK}(?:[A-Za-z0-9+/]+={{1,2}}|(?<=\n)[A-Za-z0-9+/]+(?=[^\S\n]*(?:\n|\Z))))?)"
)

#: Rules beside the base: whole private keys and prefixed personal tokens.
MORE_RULES = (
    Rule("pem", 2, PEM),
    Rule("prefixed", 1, r"\b(?:gh[pousr]_|glpat-|xox[abprs]-)[A-Za-z0-9_-]{20,}"),
)

RULES = BASE_RULES + MORE_RULES


def _scan(unseen: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows for ``(blob, text, todo)``, ``todo`` being the names of the rules to run."""
    by_name = {rule.name: rule for rule in rules}
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            out = [
                (blob, name, by_name[name].version, [{"start": a, "stop": b} for a, b in by_name[name].spans(text)])
                for blob, text, todo in zip(*(part.column(c).to_pylist() for c in ("blob", "text", "todo")))
                for name in todo
            ]
            blobs, names, versions, found = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(blobs, pa.binary()), pa.array(names, pa.string()), pa.array(versions, pa.int32()), pa.array(found, spans)],
                names=["blob", "rule", "version", "spans"],
            )

    return unseen.mapInArrow(run, LEDGER)


def _is_there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _current(book: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The ledger's findings of the given rules in the given versions, one row per blob and rule.

    A scan that ran again, or beside another one, leaves the same row twice.
    """
    version = F.create_map(*(x for r in rules for x in (F.lit(r.name), F.lit(r.version))))
    return book.filter((F.col("version") == version[F.col("rule")]) & (F.size("spans") > 0)).dropDuplicates(["blob", "rule"])


def update_ledger(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Scan what the ledger folder has not seen and return the ledger. Without a folder, or one that is there, a new one is begun.

    A null text counts as the empty text. Copies are one blob: they are reduced to one text before and after
    the shuffle on the address, so a group of copies is scanned once however large it is.
    """
    spark = docs.sparkSession
    texts = only(docs, text=text_col).select(F.coalesce("text", F.lit("")).alias("text"))
    blobs = texts.select(F.unhex(F.sha2("text", 256)).alias("blob"), "text").dropDuplicates(["blob"])
    wanted = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules))
    if ledger is None or not _is_there(spark, ledger):
        ledger = ledger or work_folder(spark, "ledger")
        unseen = blobs.select("blob", "text", F.array(*(F.lit(r.name) for r in rules)).alias("todo"))
    else:
        # A ledger row is found again by blob; what it lacks is what is left to do.
        seen = (
            spark.read.schema(LEDGER).parquet(ledger)
            .groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("seen"))
        )
        left = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<struct<rule:string,version:int>>")))
        unseen = (
            blobs.join(seen, "blob", "left").select("blob", "text", F.transform(left, lambda x: x["rule"]).alias("todo"))
            .filter(F.size("todo") > 0)
        )
    _scan(unseen, rules).write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger)


def find_secrets(
    docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, blob, found)`` per row; ``found`` lists ``(start, rank, kind, stop)`` by start, then rule order.

    Positions are code points, ends exclusive. A row without findings, or with a null or empty text, has an
    empty list. Repeated rows stay repeated; an empty table gives an empty result; further columns are not read.
    Only findings of the versions given in ``rules`` are joined back, older ones stay in the ledger.
    """
    book = update_ledger(docs, ledger, rules, text_col)
    rank = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))))
    spans = (
        _current(book, rules).withColumn("rank", rank[F.col("rule")])
        .select("blob", F.expr("transform(spans, s -> struct(s.start AS start, rank, rule AS kind, s.stop AS stop))").alias("found"))
        .groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
    )
    paths = only(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("blob")
    )
    none = F.array().cast(spans.schema["found"].dataType)
    return paths.join(spans, "blob", "left").select("doc_id", "blob", F.coalesce("found", none).alias("found"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]", ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``mask``; overlapping spans are replaced as one. Other columns stay.

    The spans of a text are joined to it by its address, so rows are never matched by an id that may repeat.
    """
    book = update_ledger(docs, ledger, rules, text_col)
    spans = (
        _current(book, rules).groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("_spans"))
    )
    blob = F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256))
    joined = docs.withColumn("_blob", blob).join(spans.withColumnRenamed("blob", "_blob"), "_blob", "left")
    # Walk the spans by start: keep the text between the furthest end so far and the next start.
    cut = F.expr(f"""aggregate(_spans, struct('' AS done, 0L AS at), (a, s) ->
        if(s.stop <= a.at, a, struct(
            concat(a.done, if(s.start < a.at, '', concat(substring(`{text_col}`, int(a.at) + 1, int(s.start - a.at)), '{mask}'))) AS done,
            s.stop AS at)),
        a -> concat(a.done, substring(`{text_col}`, int(a.at) + 1)))""")
    return joined.withColumn(text_col, F.when(F.col("_spans").isNull(), F.col(f"`{text_col}`")).otherwise(cut)).select(*docs.columns)
