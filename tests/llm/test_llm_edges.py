"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import chat, fmindex, html, mixing, packing, quality, secrets, simhash, substrings, tokens, topk
from tallyloom.llm.components import connected

LONG = " ".join(f"word{i % 977}x{i * i % 1013}" for i in range(40_000))
PROSE = " ".join(f"alpha{i} beta{i * 7 % 31}" for i in range(40))
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \n\t ", None, "a"),
    (4, PROSE, "en", "a"),
    (5, PROSE, "en", "a"),
    (5, PROSE, "en", "a"),
    (None, PROSE + " end", None, None),
    (6, LONG, "en", "a"),
    (7, "token: abcdefgh1234 and " + PROSE.upper(), "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names the operators use inside.
CLASH = ["fp", "root", "spans", "words", "key1", "blob", "n_tokens", "rate", "length", "_row", "piece", "content", "kept", "found"]


@pytest.fixture
def docs(rows):
    return rows(ROWS, SCHEMA).withColumns({c: F.lit(7) for c in CLASH}).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture
def nothing(docs):
    return docs.limit(0)


@pytest.fixture
def labels(rows):
    return rows([(4, 1, 0), (6, 0, 0), (7, 1, 1), (None, 1, 0), (5, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")


def brute_repeats(texts, window):
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append(b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


def test_substrings(docs, nothing):
    found = substrings.remove_repeats(docs, window=35).collect()
    wanted = brute_repeats([r[1] for r in ROWS], 35)
    assert sorted((str(r.doc_id), r.kept) for r in found) == sorted((str(r[0]), k) for r, k in zip(ROWS, wanted))
    assert substrings.remove_repeats(nothing).collect() == []


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_substrings_with_hot_passages(rows, hot):
    rng = random.Random(hot)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(30))
    passage, other = [word() for _ in range(12)], [word() for _ in range(9)]
    texts = []
    for k in range(60):
        middle = passage if k % 3 else other * (1 + k % 2)
        texts.append(" ".join([word() for _ in range(rng.randrange(12))] + middle + [word() for _ in range(rng.randrange(12))]))
    texts += ["x " * 40, "x " * 50, "y " * 5]
    data = rows(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.kept for r in substrings.remove_repeats(data, window=7, group=4, hot=hot, shard_words=64).collect()}
    assert [found[i] for i in range(len(texts))] == brute_repeats(texts, 7)


def test_index_counts_every_window():
    rng = np.random.default_rng(3)
    sequences = [rng.integers(0, 4, n) for n in (0, 3, 30, 30, 41, 5)]
    sequences[3] = sequences[2].copy()
    weights = np.array([1, 2, 1, 5, 1, 1])
    for width in (2, 3, 5, 9):
        seen = Counter()
        for s, w in zip(sequences, weights):
            for i in range(len(s) - width + 1):
                seen[tuple(s[i:i + width])] += w
        words, sizes = np.concatenate(sequences), np.array([len(s) for s in sequences])
        # Sorted in full, and by as many words as are searched for.
        found = fmindex.FMIndex(words, sizes, weights, rng.choice([None, width])).occurrences(width)
        for s, counts in zip(sequences, found):
            assert counts.tolist() == [seen[tuple(s[i:i + width])] for i in range(len(s) - width + 1)]


def test_token_budgets(docs, nothing):
    found = {(r.doc_id, r.n_bytes): r for r in tokens.budgets(docs, limit=50).collect()}
    assert found[(1, 0)].n_tokens == found[(2, 0)].n_tokens == 0
    assert found[(6, len(LONG.encode()))].over_limit and found[(6, len(LONG.encode()))].fit_chars > 0
    assert tokens.budgets(docs).count() == len(ROWS)
    assert tokens.budgets(nothing).collect() == []


def test_stored_prefix_counts_answer_questions(rows):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["a  b", "  lead", "tail  ", "▁▁x ▁", "日本語 テスト", "😀 x\ny\tz", "aaaa aaaaaaaa", "<s> </s> <unk> <0x41>", "ﬁ́ é", "supercali fragilistic", ""]
    stored = tokens.prefix_counts(rows(list(enumerate(texts)), "doc_id long, text string"))
    for r in stored.collect():
        assert r.counts == [len(model.encode(texts[r.doc_id][:j])) for j in range(len(texts[r.doc_id]) + 1)]
    fits = stored.select("doc_id", "counts", tokens.longest_prefix("counts", 3).alias("j")).select(
        "doc_id", "j", tokens.tokens_of("counts", "j").alias("n")
    )
    assert all(r.n <= 3 for r in fits.collect())


def test_top_k(rows):
    vectors = [
        (0, [0.5, 0.5]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (3, [0.5, 0.5]), (2, [-0.5, 0.25]), (40, None), (5, [None, 1.0]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (60, [1.0, 1.0, 1.0]), (80, []),
    ]
    data = rows(vectors, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("_row", "shard", "kth", "score")})
    found = topk.top_k(data, F.col("vec_id") % 20 == 0, k=2, shard_rows=2, leaf_rows=1).collect()
    by_query = Counter(r.query_id for r in found)
    assert by_query == {0: 2, 20: 4}
    assert sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == 0) == [(1, 3, 2048), (2, 20, 2048)]
    assert topk.top_k(data.limit(0), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("shard_rows, block_rows, leaf_rows", [(16, 4, 3), (1000, 1000, 128)])
def test_top_k_by_brute_force(rows, shard_rows, block_rows, leaf_rows):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(150, 8)), 2).astype(np.float32)
    x[50:90] = x[3]
    data = rows([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    found = topk.top_k(data, F.col("vec_id") % 20 == 0, k=7, shard_rows=shard_rows, block_rows=block_rows, leaf_rows=leaf_rows)
    whole = np.floor(64 * x.astype(np.float64)).astype(np.int64)
    scores = whole @ whole.T
    wanted = set()
    for q in range(0, 150, 20):
        order = sorted((i for i in range(150) if i != q), key=lambda i: (-scores[q, i], i))[:7]
        wanted |= {(q, k + 1, i, int(scores[q, i])) for k, i in enumerate(order)}
    assert {tuple(r) for r in found.collect()} == wanted


def test_packing(docs, nothing):
    found = packing.pack(docs).collect()
    assert sum(r.piece == 0 for r in found) == len(ROWS)
    assert sorted(r.length for r in found if r.doc_id in (1, 2)) == [1, 1]
    places = Counter()
    for r in found:
        for at in range(r.offset, r.offset + r.length):
            places[(r.sequence_id, at)] += 1
    assert set(places.values()) == {1}
    assert packing.pack(nothing).collect() == []


def test_encoder_equals_the_tokenizer():
    import public_tokenizers

    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    parts = ["it's", "don't", "foo,", "(bar)", "a1b2", "日本", "é", "x\ny", "\n", "  ", "\t", "<|endoftext|>", " ", "***", "'ll", "٣٤", "ªº", "\x1c", "ʰb ́c", "Z."]
    texts = ["", " ", "\n", *("".join(rng.choice([" ", " ", "", "\n"]) + rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(2000))]
    for t in texts:
        ids = encoder.whole.encode(t, add_special_tokens=False).ids
        assert encoder.encode(t) == np.array(ids, dtype="<u4").tobytes(), repr(t)


def test_mixing(docs, nothing, labels):
    mixed = mixing.mix(docs, labels, {"clean": 1.5, "low": 0.5, "toxic": 0.1})
    assert mixed.count() == len(ROWS)
    assert all(r.rate >= 0 for r in mixed.collect())
    left = mixing.draw(docs, mixed)
    # Rows of one content are taken alike, as often as their rates say.
    taken = {(r.key1, r.key2): r.copies for r in mixing.copies(mixed).collect()}
    assert left.columns == docs.columns and left.count() == sum(taken[r.key1, r.key2] for r in mixed.collect())
    assert all(abs(taken[r.key1, r.key2] - r.rate) < 1 for r in mixed.collect())
    once = mixing.mix(docs, labels, {"clean": 1.5, "low": 0.5, "toxic": 0.1}, most=1.0)
    assert all(0 <= r.rate <= 1 for r in once.collect()) and mixing.draw(docs, once).count() <= len(ROWS)
    assert mixing.draw(nothing, mixing.mix(nothing, labels, {})).collect() == []
    assert mixing.mix(nothing, labels, {}).collect() == []
    unlabelled = mixing.mix(docs, labels.limit(0), {"clean": 1.0, "low": 1.0, "toxic": 1.0}).collect()
    assert all(abs(r.rate - 1) < 1e-6 for r in unlabelled)


def test_simhash(docs, nothing):
    found = simhash.near_duplicates(docs).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(ROWS)
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1} and by_id[1].fp == 0
    assert by_id[4].component_id == by_id[5].component_id == 4
    assert simhash.near_duplicates(nothing).collect() == []


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_balls_lose_no_link(rows, bits):
    rng = random.Random(bits)
    base = [rng.getrandbits(64) for _ in range(5)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(4))) for b in base for _ in range(25)})
    signed = {f - (1 << 64) if f >> 63 else f: f for f in fps}
    roots = {r.node: r.root for r in connected(simhash.links(rows([(s,) for s in signed], "fp long"), bits)).collect()}
    group = {s: roots.get(s, s) for s in signed}
    wanted = {s: s for s in signed}
    changed = True
    while changed:
        changed = False
        for a in signed:
            for b in signed:
                if (signed[a] ^ signed[b]).bit_count() <= bits and wanted[b] < wanted[a]:
                    wanted[a], changed = wanted[b], True
    assert group == wanted


def test_components_of_a_long_chain(rows):
    chain = [(i + 1, i) for i in range(200)] + [(1000, 999), (1001, 999)]
    found = {r.node: r.root for r in connected(rows(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {1000: 999, 1001: 999}


def test_one_of_each_component(docs, nothing):
    left = simhash.one_per_component(docs)
    assert left.columns == docs.columns
    groups = {(r.key1, r.key2): r.component_id for r in simhash.near_duplicates(docs).collect()}
    found = sorted(r.doc_id for r in left.collect())
    assert found == sorted(set(groups.values()))
    assert simhash.one_per_component(nothing).collect() == []


def test_components_without_ids_keep_a_row(rows):
    data = rows([(None, "same words here"), (None, "same words here"), (None, None), (7, ""), (8, "Same Words Here"), (9, "quite another text")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in simhash.one_per_component(data).collect()), key=str) == [(7, ""), (8, "Same Words Here"), (9, "quite another text")]
    alone = rows([(None, "a b c"), (None, "a b c"), (None, "d e f")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.one_per_component(alone).collect()) == ["a b c", "d e f"]


def test_chat(rows):
    turns = rows([
        (1, 0, "user", "hi"), (1, 1, "assistant", "one"), (1, 2, "user", "bye"),
        (2, 0, "user", None), (2, None, None, "first"), (2, 1, "assistant", ""),
        (3, 0, "user", "alone"), (None, 0, "user", "x"), (5, 0, "assistant", "a"), (5, 0, "assistant", "a"),
    ], "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("other", F.lit(2))
    found = {r.pair_id: r for r in chat.format_preferences(chat.pairs_with_next(turns)).collect()}
    assert set(found) == {1, 2, 5}
    assert found[1].prompt == "<|user|>\nhi<|end|>\n" and found[1].chosen == "<|assistant|>\none<|end|>\n"
    assert [tuple(s) for s in found[1].chosen_mask] == [(14, 25)]
    assert found[1].chosen[14:25] == "one<|end|>\n"
    assert found[2].prompt.startswith("<|unknown|>\nfirst<|end|>\n<|user|>\n<|end|>\n")
    assert found[2].n_common == 3 and found[2].chosen == found[2].rejected == "" and found[2].chosen_mask == []
    assert found[5].n_common == 1
    kind = chat.TURNS
    pairs = rows([(1, None, [("user", "a")]), (2, [("user", "a"), (None, None)], [("user", "a")]), (2, [], [])], f"pair_id long, chosen {kind}, rejected {kind}")
    assert [(r.pair_id, r.n_common) for r in chat.format_preferences(pairs).collect()] == [(1, 0), (2, 1), (2, 0)]
    assert chat.format_preferences(pairs.limit(0)).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header class="site-header"><p>Site name, the daily paper. All the news, every day, for you.</p></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, as you know. Please, accept them all.</p></div>
<div id="content"><h1>Head &amp; line</h1><p>First paragraph, with <b>bold</b> words,   and a <a href="x">link</a>. It goes on, and on, for a while.</p>
<p>Second one &lt;here&gt;, which is long enough too, and has commas, too.<p>Third,<br>broken. It is not closed, as you see, but it is fine.</p><p>Ok.</p></div>
<aside><p>Read this next, it is very good, really, and long, and has commas, too.</p></aside>
<form><p>Name, please, and e-mail, and so on, and so forth.</p><input></form>
<div class="comments"><p>Great article, thanks, I loved it, and so did my cat, truly.</p></div>
<script>if (a < b) { document.write("<p>no</p>") }</script><footer>&copy; us</footer></body></html>"""


def test_html(rows):
    wanted = "\n".join([
        "Head & line", "First paragraph, with bold words, and a link. It goes on, and on, for a while.",
        "Second one <here>, which is long enough too, and has commas, too.", "Third,", "broken. It is not closed, as you see, but it is fine.", "Ok.",
    ])
    assert html.main_text(PAGE) == wanted
    pages = rows([(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>"), (4, "w", "plain, text < here. Yes, really."), (5, "x", "<" * 2000)], "page_id long, url string, html string")
    pages = pages.withColumn("text", F.lit(1)).withColumn("label", F.lit("x"))
    found = html.extract(pages).collect()
    assert Counter((r.page_id, r.text) for r in found)[(1, wanted)] == 2
    assert [r.text for r in found if r.page_id in (2, None, 3)] == ["", "", ""]
    assert [r.text for r in found if r.page_id == 4] == ["plain, text < here. Yes, really."]
    assert html.extract(pages.limit(0)).collect() == []


def test_secrets(docs, nothing, spark, tmp_path):
    found = secrets.find_secrets(docs)
    assert found.count() == len(ROWS)
    assert {r.doc_id: [s.kind for s in r.found] for r in found.collect()}[7] == ["assign"]
    assert secrets.find_secrets(nothing).collect() == []
    clean = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert clean[7].text.startswith("[secret] and ") and clean[4].text == PROSE and clean[1].text is None
    assert secrets.redact(docs).columns == docs.columns


def test_ledger_scans_only_what_it_has_not_seen(rows, tmp_path, monkeypatch):
    ledger = str(tmp_path / "ledger")
    first = rows([(1, "AKIAABCDEFGHIJKL1"), (2, "AKIAABCDEFGHIJKL1"), (3, "plain")], "doc_id long, text string")
    book = secrets.update_ledger(first.limit(0), None)
    assert book.count() == 0
    secrets._scan(first.selectExpr("unhex(sha2(text, 256)) AS blob", "text", "array('hex') AS todo").limit(0), secrets.RULES).write.parquet(ledger)
    assert secrets.update_ledger(first, ledger).count() == 2 * len(secrets.RULES)
    assert secrets.update_ledger(first, ledger).count() == 2 * len(secrets.RULES)
    more = first.unionAll(rows([(4, "a key: AKIAABCDEFGHIJKL2")], "doc_id long, text string"))
    assert secrets.update_ledger(more, ledger).count() == 3 * len(secrets.RULES)
    # A new version of one rule is run on every blob, the other rules on none.
    changed = (*secrets.RULES[:1], secrets.Rule("access", 2, r"AKIA[A-Z0-9]{12}"), *secrets.RULES[2:])
    assert secrets.update_ledger(more, ledger, changed).count() == 3 * len(secrets.RULES) + 3
    paths = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.found] for r in secrets.find_secrets(more, ledger, changed).collect()}
    assert paths == {1: [("access", 0, 16)], 2: [("access", 0, 16)], 3: [], 4: [("access", 7, 23)]}


def test_quality(docs, nothing):
    judged = quality.judge(docs).collect()
    assert len(judged) == len(ROWS)
    assert all(r.base_failed and not r.kept for r in judged if r.doc_id in (1, 2, 3))
    left = quality.keep(docs)
    assert left.columns == docs.columns
    kept = Counter((r.doc_id, r.n_words) for r in judged if r.kept)
    assert Counter((r.doc_id, len(r.text.split())) for r in left.collect()) == kept
    assert quality.judge(nothing).collect() == [] and quality.keep(nothing).collect() == []


def test_sketches_merge(rows):
    data = rows([(i, "x " * 20 + "y" * (i % 50), "en", "s") for i in range(400)], SCHEMA)
    measured = quality.measures(data)
    whole = quality.fences(quality.sketches(measured))
    halves = quality.sketches(measured.filter("doc_id % 2 = 0")).unionAll(quality.sketches(measured.filter("doc_id % 2 = 1")))
    assert quality.fences(quality.merge_sketches(halves)).collect() == whole.collect()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_anything(rows, spark, tmp_path, labels, name, stage):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = rows([(*r, len(r[1] or "")) for r in ROWS], SCHEMA + ", n_chars long")
    for df in (docs, docs.limit(0)):
        result = stage(spark, df, str(tmp_path))
        result.collect()
        if name != "packing":
            assert result.columns == docs.columns


def test_hash_is_the_published_one(rows):
    data = rows([(1, "One two THREE four")], "doc_id long, text string")
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in (b"one two three", b"two three four")]
    wanted = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 2)
    assert simhash.fingerprints(data).first().fp % (1 << 64) == wanted


@pytest.fixture(scope="module")
def counter():
    return tokens.PrefixCounter(public_tokenizers.path("piece_bpe_32k.model"))


def test_budgets_agree_with_prefix_tables_and_the_library(counter, monkeypatch):
    """Also when the tables of a worker are full all the time."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    parts = ["word", "Wort", "mot", "ab,", "x.", "(y)", "it's", "...", ",", "é", "ß.", "漢", "漢字,", "", "", "3.14", "a-b", "\n", "e.\n", "St.", "\u2581", "don't!"]
    for held in (600_000, 3):
        monkeypatch.setattr(tokens, "HELD", held)
        for _ in range(400):
            text = " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 14)))
            bounds = counter.bounds(text).tolist()
            assert bounds[-1] == len(model.encode(text)), text
            for limit in (0, 1, 3, len(text)):
                fits = max(j for j, n in enumerate(bounds) if n <= limit)
                assert counter.budget(text, limit) == (bounds[-1], fits), (text, limit)
