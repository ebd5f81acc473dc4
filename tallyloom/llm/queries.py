"""Registered queries of the operators, and the DuckDB statements that check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import chat, clusters, grammar, html, merkle, mixing, packing, quality, secrets, simhash, substrings, tokens, topk
from tallyloom.llm.texts import SPACE_CLASS, importable
from tallyloom.sources.tables import work_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of repeated 35-word windows."""
    rows = substrings.remove_repeats(_table(spark, sf_dir, "documents"), window=35)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE_CLASS}+'), lambda x: x <> '') AS w
    FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
twin AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY g) > 1),
gone AS (SELECT DISTINCT r, i + k AS i FROM twin, range(35) t(k)),
word AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents against a budget of 4096."""
    return tokens.budgets(_table(spark, sf_dir, "documents"), limit=4096, model="piece_bpe_32k.model")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all other vectors for every twentieth vector."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


OP3_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), capacity=1024, tokenizer="byte_bpe_50k.json", end_id=2)


#: How much of each domain's expected tokens is wanted.
MIX_WEIGHTS = {"clean": 1.5, "low": 0.5, "toxic": 0.1}


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors and rates of all documents."""
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), MIX_WEIGHTS).drop("key1", "key2")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, 2 bits."""
    rows = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, max_bits=2)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs of all conversations: each against the answer to the next one."""
    rows = chat.format_preferences(chat.pairs_with_next(_table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s["start"], F.lit(":"), s["stop"])), ",").alias(c)
    return rows.select("pair_id", "n_common", "prompt", "chosen", "rejected", spans("chosen_mask"), spans("rejected_mask"))


OP7_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM t),
a AS (SELECT conv_id, max(i) AS last FROM n WHERE role = 'assistant' GROUP BY conv_id),
c AS (SELECT n.conv_id, n.i, n.role, n.text, a.last FROM n JOIN a USING (conv_id) WHERE n.i <= a.last),
ans AS (SELECT conv_id - 1 AS conv_id, text AS other FROM c WHERE i = last),
r AS (SELECT c.conv_id, i, last, role, text, CASE WHEN i = last THEN coalesce(other, '') ELSE text END AS rtext FROM c LEFT JOIN ans USING (conv_id)),
k AS (SELECT conv_id, last, CASE WHEN bool_and(text = rtext) THEN last ELSE last - 1 END AS n_common FROM r GROUP BY conv_id, last),
p AS (SELECT conv_id, string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY i) AS prompt
      FROM r JOIN k USING (conv_id) WHERE i <= n_common GROUP BY conv_id),
e AS (SELECT r.conv_id, '<|assistant|>' || chr(10) || text || '<|end|>' || chr(10) AS chosen,
             '<|assistant|>' || chr(10) || rtext || '<|end|>' || chr(10) AS rejected
      FROM r JOIN k USING (conv_id) WHERE i > n_common)
SELECT k.conv_id AS pair_id, CAST(n_common AS INTEGER) AS n_common, coalesce(prompt, '') AS prompt,
       coalesce(chosen, '') AS chosen, coalesce(rejected, '') AS rejected,
       CASE WHEN chosen IS NULL THEN '' ELSE '14:' || length(chosen) END AS chosen_mask,
       CASE WHEN rejected IS NULL THEN '' ELSE '14:' || length(rejected) END AS rejected_mask
FROM k LEFT JOIN p USING (conv_id) LEFT JOIN e USING (conv_id)
"""


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    rows = html.extract(_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _spans_text(found: str) -> str:
    return f"array_join(transform({found}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of a first scan of all documents."""
    rows = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    base = ", ".join(f"'{r.name}'" for r in secrets.BASE_RULES)
    count = lambda kind: F.expr(f"CAST(size(filter(found, s -> s.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}")
    return rows.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(F.expr(_spans_text(f"filter(found, s -> s.kind IN ({base}))")), 256).alias("base_sha256"),
        F.expr(_spans_text("found")).alias("spans"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of all documents under adaptive fences."""
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{SPACE_CLASS}+'), lambda x: x <> '') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
twin AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twin, range(5) t(k) GROUP BY r),
m AS (SELECT w.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(translate(text, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
             len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep USING (r)),
x AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END AS word_len,
             CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbol_rate,
             CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_line_rate FROM m),
s AS (SELECT lang, source, {', '.join(
    f"quantile_disc({n}, 0.5) AS m_{n}, greatest({least}, {times} * (quantile_disc({n}, {high}) - quantile_disc({n}, {low}))) AS d_{n}"
    for n, (low, high, times, least) in quality.FENCES.items())}
      FROM x WHERE NOT base_failed GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({' AND '.join(f'abs({n} - m_{n}) <= d_{n}' for n in quality.FENCES)}, true) AS kept
FROM x LEFT JOIN s ON x.lang IS NOT DISTINCT FROM s.lang AND x.source IS NOT DISTINCT FROM s.source
"""

def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to grammar-compressed files and read back."""
    path = work_folder(spark, "token_files")
    grammar.write_ids(_table(spark, sf_dir, "documents"), path, tokenizer="word_bpe_49k.json", end_id=1)
    return grammar.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors around 40 centroids, after five rounds."""
    return clusters.cluster(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, scale=256, dims=64, salt="2")


def _nearest_sql(centroids: str) -> str:
    return f"""
    SELECT r, arg_min(k, (d, k)) AS k, min(d) AS d
    FROM (SELECT r, c.k, list_sum(list_transform(range(1, 65), lambda i: (p.v[i] - c.v[i]) * (p.v[i] - c.v[i])))::BIGINT AS d FROM v p, {centroids} c)
    GROUP BY r"""


def _moved_sql(assigned: str, centroids: str) -> str:
    return f"""
    SELECT k, coalesce(s.v, c.v) AS v FROM {centroids} c LEFT JOIN (
        SELECT k, list((x - (x % n + n) % n) // n ORDER BY i) AS v
        FROM (SELECT k, i, sum(x)::HUGEINT AS x, count(*) AS n FROM (SELECT k, unnest(v.v) AS x, unnest(range(1, 65)) AS i FROM {assigned} JOIN v USING (r)) GROUP BY k, i)
        GROUP BY k) s USING (k)"""


OP12_SQL = f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))::HUGEINT) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS k, v
    FROM (SELECT sha256('2:' || vec_id) AS h, v FROM v ORDER BY h NULLS LAST, v LIMIT 40)),
{"".join(f"a{n} AS MATERIALIZED ({_nearest_sql(f'c{n}')}),c{n + 1} AS MATERIALIZED ({_moved_sql(f'a{n}', f'c{n}')})," for n in range(5))}
a AS MATERIALIZED ({_nearest_sql('c5')})
SELECT vec_id, a.k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM a JOIN v USING (r) JOIN c5 ON c5.k = a.k
"""


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents; every row whose id has a checksum that 7 divides is tampered with."""
    docs = _table(spark, sf_dir, "documents")
    # A null id has no checksum and is left as it is.
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = merkle.manifest(docs, changed={"n_chars": F.col("n_chars") + F.when(picked, 1).otherwise(0)})
    return merkle.verified(rows).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _leaf_sql(n_chars: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields) + ")"


#: CRC-32 by the bits: 32-bit steps of the reversed polynomial, one list fold per byte of the decimal id.
_CRC_SQL = """
list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS UBIGINT))),
            lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: CAST(0 AS UBIGINT))),
                                     lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS UBIGINT)) ELSE x // 2 END))
"""

OP13_SQL = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
           {_leaf_sql('n_chars + CASE WHEN xor(' + _CRC_SQL + ', CAST(4294967295 AS UBIGINT)) % 7 = 0 THEN 1 ELSE 0 END')} AS changed
    FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
tree(lang, lvl, i, h, n) AS (
    SELECT lang, 0, i, leaf, count(*) OVER (PARTITION BY lang) FROM leaves
    UNION ALL
    SELECT lang, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY lang, lvl, i // 2, n),
subs AS (SELECT lang, lvl AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
top(lvl, i, h, n) AS (
    SELECT 0, i, subroot, n FROM subs
    UNION ALL
    SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, i // 2, n),
-- Every node of both trees with its level and place on the way up from a leaf; a language's own tree first.
fold(r, doc_id, leaf, lang, lvl, i, s, height, node, proof, done) AS (
    SELECT r, doc_id, leaf, l.lang, 0, l.i, subs.i, height, changed, '', false FROM leaves l JOIN subs ON l.lang IS NOT DISTINCT FROM subs.lang
    UNION ALL
    SELECT r, doc_id, leaf, f.lang, f.lvl + 1, CASE WHEN f.lvl < height THEN f.i // 2 ELSE f.i END,
           CASE WHEN f.lvl < height THEN s ELSE s // 2 END, height,
           CASE WHEN f.lvl >= height AND top.n = 1 THEN node
                WHEN (CASE WHEN f.lvl < height THEN f.i ELSE s END) % 2 = 1 THEN sha256(coalesce(x.h, y.h, '') || node)
                ELSE sha256(node || coalesce(x.h, y.h, '')) END,
           proof || coalesce(x.h, y.h, ''), f.lvl >= height AND top.n = 1
    FROM fold f
    LEFT JOIN tree x ON f.lvl < height AND x.lang IS NOT DISTINCT FROM f.lang AND x.lvl = f.lvl AND x.i = xor(f.i, 1)
    LEFT JOIN top y ON f.lvl >= height AND y.lvl = f.lvl - height AND y.i = xor(s, 1)
    LEFT JOIN (SELECT DISTINCT lvl, n FROM top) top ON top.lvl = f.lvl - height
    WHERE NOT done)
SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(proof) AS proof_sha256,
       node AS folded_root, node = (SELECT h FROM top WHERE n = 1) AS verified
FROM fold JOIN subs ON fold.lang IS NOT DISTINCT FROM subs.lang WHERE done
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substrings": op1_substrings,
    "op2_token_counts": op2_token_counts,
    "op3_top_k": op3_top_k,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_chat": op7_chat,
    "op8_html": op8_html,
    "op9_secrets": op9_secrets,
    "op10_quality": op10_quality,
    "op11_token_files": op11_token_files,
    "op12_clusters": op12_clusters,
    "op13_manifest": op13_manifest,
}

SQL: dict[str, str] = {
    "op1_substrings": OP1_SQL,
    "op3_top_k": OP3_SQL,
    "op7_chat": OP7_SQL,
    "op10_quality": OP10_SQL,
    "op12_clusters": OP12_SQL,
    "op13_manifest": OP13_SQL,
}
