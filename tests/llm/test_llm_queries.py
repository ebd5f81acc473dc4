"""Registered queries of the text operators at the smallest scale: against DuckDB where SQL can say it, else brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import xxhash
from compare import connect, differences
from tokenizers import Tokenizer

import corpus_pipeline
from tallyloom.llm import mixing, packing, queries, quality, secrets

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    with connect(FOLDER) as connection:
        yield connection


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return dict(zip(table["doc_id"], table["text"]))


def collected(spark, name):
    return queries.QUERIES[name](spark, FOLDER).collect()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_statement(spark, duck, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), duck, queries.SQL[name]) is None


@pytest.mark.parametrize("name", ["op7_chat", "op10_quality"])
def test_native(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.findall("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_token_counts(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = collected(spark, "op2_token_counts")
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(model.encode(text)))
        assert r.over_limit == (r.n_tokens > 4096)
        assert len(model.encode(text[:r.fit_chars])) <= 4096


def check_packed(rows, texts, capacity=1024):
    """Every token of every document lies in exactly one place, and sequences are gapless."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = [*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2]
        at = 0
        for k, p in enumerate(sorted(pieces, key=lambda p: p.piece)):
            part = np.array(ids[at:at + p.length], dtype="<u4").tobytes()
            assert (p.piece, p.start, p.ids_crc32) == (k, at, zlib.crc32(part))
            at += p.length
            assert p.length == capacity or k == 0
        assert at == len(ids) and (len(pieces) == 1 or len(ids) > capacity)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), -(-sum(r.length for r in rows) // capacity)


def test_packing(spark, texts):
    used, least = check_packed(collected(spark, "op4_packing"), texts)
    assert used <= 1.02 * least + 1


def union_find(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, texts):
    rows = collected(spark, "op6_simhash")
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    ids = sorted(fps)
    edges = [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    wanted = union_find(ids, edges)
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {i: (fps[i], wanted[i]) for i in ids}
    assert len(edges) > 5


def plain_secrets(text):
    out = []
    patterns = {
        "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "access": r"()(AKIA[A-Z0-9]+)",
        "hex": r"()([0-9a-f]+)",
    }
    least = {"assign": 8, "access": 16, "hex": 32}
    for rank, (kind, pattern) in enumerate(patterns.items()):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(2)) >= least[kind]]
    return sorted(out)


def test_secrets(spark):
    table = pq.read_table(f"{LARGER}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    texts = dict(zip(table["doc_id"], table["text"]))
    rows, total = queries.op9_secrets(spark, LARGER).collect(), 0
    assert len(rows) == len(texts)
    for r in rows:
        found = plain_secrets(texts[r.doc_id] or "")
        base = [f"{kind}:{a}:{b}" for a, _, kind, b in found]
        kinds = Counter(kind for _, _, kind, _ in found)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) | {""}
        total += len(found)
    assert total > 3


def test_pages(spark):
    from html import unescape

    pages = pq.read_table(f"{FOLDER}/pages.parquet").to_pylist()
    wanted = {}
    for p in pages:
        article = p["html"].split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        blocks = [re.sub(r"\s+", " ", unescape(re.sub(r"</?b>", "", b))).strip() for b in re.split(r"</?(?:p|h1|br)>", article)]
        wanted[p["page_id"]] = "\n".join(b for b in blocks if b)
    rows = collected(spark, "op8_html")
    assert {r.page_id: r.text for r in rows} == wanted
    assert all(r.n_chars == len(r.text) for r in rows)


def test_mixing_meets_targets(spark):
    rows = collected(spark, "op5_mixing")
    tokens = np.array([r.n_tokens for r in rows])
    rates = np.array([r.rate for r in rows])
    shares = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in rows])
    supply = tokens @ shares
    wanted = np.array([queries.MIX_WEIGHTS[d] for d in mixing.DOMAINS]) * supply
    assert (rates >= 0).all()
    assert np.allclose(shares.sum(axis=1), 1)

    weight = np.linalg.inv((shares * tokens[:, None]).T @ shares)

    def loss(r):
        off = (tokens * r) @ shares - wanted
        return off @ weight @ off + 2e-4 * (tokens * (r - 1) ** 2).sum()

    # The same least squares, worked off to the end on one machine.
    best = np.ones(len(rows))
    for _ in range(20_000):
        best = np.maximum(0, best - 0.9 * (shares @ (weight @ ((tokens * best) @ shares - wanted)) + 2e-4 * (best - 1)))
    assert loss(rates) <= loss(best) + 1e-3 * loss(np.ones(len(rows)))
    # The query's rates are those of the table it is registered for at a larger scale: see below for how near they come.
    assert np.abs((tokens * rates) @ shares - wanted).max() <= 0.02 * np.abs(supply - wanted).max()


@pytest.mark.parametrize("weights, most", [(queries.MIX_WEIGHTS, np.inf), ({"clean": 1.0, "low": 0.5, "toxic": 0.1}, 1.0)])
def test_drawn_totals_meet_the_targets(spark, weights, most):
    """Rates within 2 % of each target and drawn rows within 5 %, on a table of 10,000 documents."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    mixed = mixing.mix(docs, labels, weights, most=most).cache()
    rows = mixed.collect()
    shares = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in rows])
    tokens, rates = np.array([r.n_tokens for r in rows]), np.array([r.rate for r in rows])
    wanted = np.array([weights[d] for d in mixing.DOMAINS]) * (tokens @ shares)
    assert np.abs((tokens * rates) @ shares / wanted - 1).max() <= 0.02
    taken = {r.key1: r.copies for r in mixing.copies(mixed).collect()}
    drawn = np.array([taken[r.key1] for r in rows])
    assert np.abs((tokens * drawn) @ shares / wanted - 1).max() <= 0.05
    assert (np.abs(drawn - rates) < 1).all()
    assert mixing.draw(docs, mixed).count() == drawn.sum()
    mixed.unpersist()


def test_pipeline_by_brute_force(spark):
    docs = {r["doc_id"]: r for r in pq.read_table(f"{LARGER}/documents.parquet").to_pylist()}
    with connect(LARGER) as duck:
        verdict = dict(duck.execute(f"SELECT doc_id, kept FROM ({queries.SQL['op10_quality']})").fetchall())
    stages, now = {}, spark.read.parquet(f"{LARGER}/documents.parquet")
    columns = now.columns
    for name, apply in corpus_pipeline.STAGES:
        now = apply(spark, now, LARGER).cache()
        stages[name] = now.collect()
        if name != "packing":
            assert now.columns == columns
    first = {r.doc_id for r in stages["quality rules"]}
    assert first == {i for i, kept in verdict.items() if kept}

    ids = sorted(first)
    fps = {i: plain_fingerprint(docs[i]["text"]) for i in ids}
    groups = union_find(ids, [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    second = {r.doc_id for r in stages["near duplicates"]}
    # One of each component: that of the least id.
    assert second == set(groups.values())

    third = {r.doc_id: r.text for r in stages["secret scans"]}
    assert set(third) == second
    for i, text in third.items():
        found = [s for rule in secrets.RULES for s in rule.spans(docs[i]["text"])]
        if not found:
            assert text == docs[i]["text"]
        for a, b in found:
            assert docs[i]["text"][a:b] not in text
    fourth = {r.doc_id: r.text for r in stages["mixing sources"]}
    assert set(fourth.items()) <= set(third.items())
    labels = {r["doc_id"]: r for r in pq.read_table(f"{LARGER}/labels.parquet").to_pylist()}
    clean = {i for i in third if i in labels and labels[i]["quality"] == 1 and not labels[i]["toxic"]}
    toxic = {i for i in third if i in labels and labels[i]["toxic"]}
    assert len(clean & set(fourth)) >= 0.95 * len(clean)
    assert len(toxic & set(fourth)) <= 0.2 * len(toxic)
    used, least = check_packed(stages["packing"], fourth)
    assert used <= 1.02 * least + 1


def test_plan_beats_plain_best_fit():
    rng = np.random.default_rng(1)
    counts = Counter(rng.integers(257, 600, 5000).tolist())
    filled = packing.pack_histogram(counts, 1024)
    plain = packing.fill(counts, 1024, 2000, 64)
    total = Counter()
    for content, times in filled:
        assert sum(content) <= 1024
        for length in content:
            total[length] += times
    assert total == counts
    assert sum(n for _, n in filled) < 0.97 * sum(n for _, n in plain)


def test_classifier_on_held_out_labels():
    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pydict()
    by_id = dict(zip(docs["doc_id"], docs["text"]))
    rows = pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()
    kinds = np.array([2 if r["toxic"] else 1 - r["quality"] for r in rows])
    made = [mixing.features(by_id[r["doc_id"]])[:2] for r in rows]
    half = len(rows) // 2
    model = mixing.fit(made[:half], kinds[:half])
    guessed = np.array([model.posterior(*m).argmax() for m in made[half:]])
    assert (guessed == kinds[half:]).mean() > 0.9


def test_all_registered(spark):
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert set(quality.FENCES)


def test_most_rejections_beyond_the_base_rules_come_from_sketches(spark):
    rejected = quality.judge(spark.read.parquet(f"{LARGER}/documents.parquet")).filter("NOT kept AND NOT base_failed")
    by_sketch = rejected.filter("by_sketch").count()
    assert by_sketch > 0.5 * rejected.count() > 0


def test_quality_stage_measures_each_text_once_per_pass(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for rows in (quality.keep(docs), quality.sketches_of_texts(docs)):
        # The hash of word windows stands in the plan as often as texts are measured.
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"xxhash64\(slice", plan)) == 1
    judged = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    assert {r.doc_id for r in quality.keep(docs).collect()} == judged
