"""Merkle manifest, token files and centroid clusters: brute force, round trips and odd inputs."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import clusters, grammar, merkle, queries

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- Merkle manifest ---


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """Root and, per leaf, its siblings as (digest, is left)."""
    ways, own, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        above, below = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i:i + 2]
            for m in own[i]:
                ways[m].append((run[1] if len(run) == 2 else "", False))
            for m in own[i + 1] if len(run) == 2 else []:
                ways[m].append((run[0], True))
            above.append(sha("".join(run)))
            below.append(sum(own[i:i + 2], []))
        nodes, own = above, below
    return nodes[0], ways


def plain_manifest(data):
    """(doc_id, leaf) -> (lang, subroot, root, proof) by loops over the whole table."""
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in data:
        groups[lang].append((doc_id is not None, doc_id or 0, leaf_of(doc_id, source, lang, n_chars, text), doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, tops = tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        for x, way in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            out.append((x[3], g, x[2], trees[g][0], root, tuple(way + top)))
    return out


def found(rows):
    return [(r.doc_id, r.lang, r.leaf, r.subroot, r.root, tuple((s.sibling or "", s.is_left) for s in r.proof)) for r in rows]


def some_docs(n, seed):
    rng = random.Random(seed)
    langs = [None, "", "de", "é", "z"]
    return [(i * 3 % n if rng.random() < 0.97 else None, rng.choice([None, "", "a b", "ü" * i]), rng.choice(langs[:1 + seed % 5]), rng.choice([None, "s"]), rng.choice([None, i])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 255, 257, 700])
def test_manifest_by_brute_force(rows, n):
    data = some_docs(n, n)
    by = lambda x: repr(x)
    assert sorted(found(merkle.manifest(rows(data, DOCS)).collect()), key=by) == sorted(plain_manifest(data), key=by)


def test_manifest_of_more_than_two_tiers_of_blocks(spark, monkeypatch):
    # Blocks of four nodes: the same digests, whatever the block.
    monkeypatch.setattr(merkle, "BITS", 2)
    data = some_docs(90, 2)
    by = lambda x: repr(x)
    assert sorted(found(merkle.manifest(spark.createDataFrame(data, DOCS)).collect()), key=by) == sorted(plain_manifest(data), key=by)


def test_manifest_of_repeated_rows_and_clashing_columns(rows):
    same = [(7, "x", "de", "s", 1)] * 300
    got = merkle.manifest(rows([(*r, "c", 5) for r in same], DOCS + ", _g string, leaf int")).collect()
    assert len(got) == 300 and {(r.leaf, r.subroot) for r in got} == {(leaf_of(7, "s", "de", 1, "x"), tree([leaf_of(7, "s", "de", 1, "x")] * 300)[0])}


def test_manifest_of_nothing(rows):
    assert merkle.verified(merkle.manifest(rows([], DOCS))).collect() == []


def test_changed_rows_are_found_and_others_verified(rows):
    data = [(i, f"text {i}", "de", "s", 10 if i % 4 else None) for i in range(50)]
    other = {"n_chars": F.col("n_chars") + F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0)}
    got = merkle.verified(merkle.manifest(rows(data, DOCS), changed=other)).collect()
    # A null stays null, so nothing has changed there.
    assert {r.doc_id for r in got if not r.verified} == {i for i in range(50) if i % 2 == 0 and i % 4}


def test_manifest_plan_has_no_join_in_trees(spark, rows):
    nodes = rows([("=de", 3, i, f"h{i}", i) for i in range(8)], "_g string, _levels int, _rank long, _hash string, _load long")
    tiers, roots = merkle._climb(nodes, "t")
    above = roots.select("_g", F.lit("x").alias("_top"), F.array().cast(merkle.PROOF).alias("_proof"))
    plan = merkle._descend(tiers, above)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


# --- Token files ---


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def encoder():
    return grammar.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))


ODD = ["", " ", "\x1c", "a\x1fb", "<|endoftext|>", "x<|startoftext|>y", "İstanbul ΣΑΣ ß ẞ Å", "é e ́x", "don't we'll", "...'s", "a b c\u0085d", "ªº µ", "日本語 テスト", "12 3a a3", "Ǆ ǆ ŉ", "x" * 5000, "a,,,b?!", "'", "'S 'RE", "한한"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_have_the_ids_of_the_library(tokenizer, encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"abAB ,.'0 \n\t\x1c\x85\xa0", "'ll", "word ", "<|endoftext|>", "́", "漢", "ÿ", " ", "\u2003"]), max_size=12).map("".join), max_size=6))
def test_texts_encoded_together_have_the_ids_of_the_library(tokenizer, encoder, texts):
    ids, lengths = encoder.encode_all(texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(lengths)[:-1])][:len(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"abzABZßÄéñIİ ,.!?'\"-0 \n\t\x1c ", "'s", "<|endoftext|>", "<|", "word", *"\u0301\u00b5\u00b2\u00bd\u00df\u00ff\u00d7\u00f7\u00aa\x00\x7f\x85\xa0\xad"]), max_size=30).map("".join))
def test_any_text_has_the_ids_of_the_library(tokenizer, encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"abAB ,.'0 \n", "'ll", "word", "́", "Σ", "ͅ", "ŉ", "漢", "İ", "\u2003", "\u2019", "\u20ac"]), max_size=30).map("".join))
def test_any_text_beyond_latin_has_the_ids_of_the_library(tokenizer, encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_unicode_text_has_the_ids_of_the_library(tokenizer, encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_word_table_begins_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(grammar, "HELD_WORDS", 3)
    encoder, text = grammar.WordEncoder(public_tokenizers.path("word_bpe_49k.json")), "one two, three four! five six two one. "
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text + "漢"), "<u4").tolist() == tokenizer.encode(text + "漢", add_special_tokens=False).ids
    assert len(encoder.words) <= 3 and len(encoder.runs) <= 3


class Counted:
    """The library's merges, with the number of calls."""

    def __init__(self, merges):
        self.merges, self.calls = merges, 0

    def encode_batch_fast(self, *args, **options):
        self.calls += 1
        return self.merges.encode_batch_fast(*args, **options)


NEW_RUNS = [" ".join(f"{a}{b}é{c}, {c}{b}!" for b in "aeiouü") + "\xa0mid\xa0word" for a in "bcdfg" for c in "klmnpß"]


def test_new_runs_of_a_batch_take_one_call_of_the_library(tokenizer):
    encoder = grammar.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    encoder.merges = Counted(encoder.merges)
    for calls in (2, 2):
        # One for the runs between ASCII's white space, one for those between other white space; then all are held.
        ids, lengths = encoder.encode_all(NEW_RUNS)
        assert [p.tolist() for p in np.split(ids, np.cumsum(lengths)[:-1])] == [plain_ids(tokenizer, t)[:-1] for t in NEW_RUNS]
        assert encoder.merges.calls == calls


def test_new_runs_are_the_same_by_several_calls_and_run_by_run(tokenizer, monkeypatch):
    monkeypatch.setattr(grammar, "CALL_RUNS", 7)
    want = sum((plain_ids(tokenizer, t)[:-1] for t in NEW_RUNS), [])
    for marked in (True, False):
        encoder = grammar.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
        # Without marks of where runs end, each run is asked for by itself.
        encoder.ends_run &= marked
        assert encoder.encode_all(NEW_RUNS)[0].tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.integers(2, 6), st.data())
def test_grammar_round_trip_and_slices(ids, least, data):
    x = np.array(ids, dtype=np.uint32)
    symbols, rounds = grammar.compress(x, least)
    block = grammar.Grammar(symbols, rounds)
    assert block.ids(0, len(x)).tolist() == ids
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert block.ids(a, b).tolist() == ids[a:b]


def test_frequent_pairs_are_replaced_and_rules_name_earlier_ones():
    x = np.array([1, 2, 3, 4] * 1000 + [9] * 64, dtype=np.uint32)
    symbols, rounds = grammar.compress(x)
    assert len(symbols) < 100
    made = grammar.FIRST_RULE
    for rules in rounds:
        assert (rules < made).all()
        made += len(rules)
    # No symbol stands for itself, and no pair of the first round is left.
    assert not {(1, 2), (3, 4)} & set(zip(symbols[:-1].tolist(), symbols[1:].tolist()))


def test_a_block_whose_lengths_do_not_fit_is_refused():
    symbols, rounds = grammar.compress(np.array([1, 2] * 50, dtype=np.uint32))
    with pytest.raises(ValueError):
        grammar.Grammar(symbols, rounds, np.zeros(sum(map(len, rounds)), dtype=np.int64))


def plain_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_token_files_of_all_documents(spark, tokenizer):
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(queries.op11_token_files(spark, FOLDER).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == sorted(texts)
    at = 0
    for r in got:
        ids = plain_ids(tokenizer, texts[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_of_odd_tables_and_small_blocks(rows, spark, tokenizer, tmp_path):
    data = [(None, "null id", 1), (None, None, 2), (5, "", 3), (5, "word " * 3000, 4), (3, None, 5), (4, "same", 6), (4, "same", 6), (-1, "<|endoftext|>", 7)]
    docs = rows(data, "doc_id long, text string, start long").repartition(3)
    path = str(tmp_path / "files")
    grammar.write_ids(docs, path, block_ids=50)
    got = sorted(grammar.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, -1, 3, 4, 4, 5, 5]
    ids = [np.frombuffer(r.ids, "<u4").tolist() for r in got]
    assert sorted(map(str, ids)) == sorted(str(plain_ids(tokenizer, t)) for _, t, _ in data)
    assert [r.start for r in got] == np.cumsum([0, *map(len, ids)])[:-1].tolist() and [r.n_tokens for r in got] == list(map(len, ids))
    whole = sum(ids, [])
    for a, b in [(0, len(whole)), (7, 2500), (1, 2), (2, 2), (len(whole) - 1, len(whole) + 50)]:
        parts = sorted(grammar.slice_ids(spark, path, a, b).collect())
        assert [i for p in parts for i in np.frombuffer(p.ids, "<u4")] == whole[a:b]


def test_token_files_of_nothing(rows, spark, tmp_path):
    grammar.write_ids(rows([], "doc_id long, text string"), str(tmp_path / "none"))
    assert grammar.read_ids(spark, str(tmp_path / "none")).collect() == []


# --- Centroid clusters ---


def plain_clusters(data, k=40, rounds=5, scale=256):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in data if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    points = np.array([v for _, v in kept], dtype=object)
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, "" if kept[r][0] is None else sha(f"2:{kept[r][0]}"), kept[r][1]))
    centroids = [list(points[r]) for r in order[:k]]

    def assign():
        away = [[sum((a - b) ** 2 for a, b in zip(p, c)) for c in centroids] for p in points]
        return [d.index(min(d)) for d in away], [min(d) for d in away]

    for _ in range(rounds):
        own, _ = assign()
        for j in range(len(centroids)):
            mine = [p for p, o in zip(points, own) if o == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    own, away = assign()
    name = [sha(",".join(map(str, c))) for c in centroids]
    inertia = [sum(d for d, o in zip(away, own) if o == j) for j in range(len(centroids))]
    return [(i, o, d, inertia[o], sum(away), name[o]) for (i, _), o, d in zip(kept, own, away)]


VECTORS = "vec_id long, embedding array<double>"


def by_text(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("k, rounds", [(40, 5), (1, 2), (3, 0)])
def test_clusters_by_brute_force(rows, k, rounds):
    rng = np.random.default_rng(k)
    # Repeated rows, points on a coarse grid (many ties), and far ones.
    grid = [(i, (rng.integers(-1, 2, 64) / 256).tolist()) for i in range(40)]
    data = [*grid, *grid[:5], *[(100 + i, rng.normal(size=64).tolist()) for i in range(60)], (500, [300.0] * 64), (None, [0.25] * 64), (7, [1.0] * 64)]
    got = clusters.cluster(rows(data, VECTORS), k=k, rounds=rounds).collect()
    assert by_text(tuple(r) for r in got) == by_text(plain_clusters(data, k, rounds))


def test_rows_that_take_no_part(rows):
    fine = [(i, [float(i + j) for j in range(64)]) for i in range(3)]
    odd = [(10, None), (11, []), (12, [1.0] * 63), (13, [1.0] * 65), (14, [1.0] * 63 + [None]), (15, [float("nan")] * 64), (16, [float("inf")] * 64), (17, [1e300] * 64)]
    got = clusters.cluster(rows([(*r, 1, "x") for r in fine + odd], VECTORS + ", cluster int, block string")).collect()
    # Fewer vectors than centroids: each is its own.
    assert by_text(tuple(r) for r in got) == by_text(plain_clusters(fine))
    assert clusters.cluster(rows(odd, VECTORS)).collect() == [] and clusters.cluster(rows([], VECTORS)).collect() == []


def test_large_components_are_exact(rows):
    rng = np.random.default_rng(3)
    data = [(i, (rng.integers(-500_000, 500_000, 64)).astype(float).tolist()) for i in range(30)]
    got = clusters.cluster(rows(data, VECTORS), k=4, rounds=3).collect()
    assert by_text((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got) == by_text((x[0], x[1], x[2], x[5]) for x in plain_clusters(data, 4, 3))


def test_blocks_of_a_few_rows_give_the_same(rows, monkeypatch):
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=64).tolist()) for i in range(70)]
    monkeypatch.setattr(clusters, "BLOCK", 7)
    got = clusters.cluster(rows(data, VECTORS), k=5, rounds=4).collect()
    assert by_text(tuple(r) for r in got) == by_text(plain_clusters(data, 5, 4))


def test_only_expired_vectors_are_measured_and_none_is_missed():
    rng = np.random.default_rng(9)
    centres = rng.integers(-4000, 4000, (8, 64))
    points = (centres[rng.integers(0, 8, 2000)] + rng.integers(-100, 100, (2000, 64))).astype(np.int64)
    heaps, slack, centroids = clusters.Heaps(2000, 8), np.zeros(8), centres.astype(np.int64)
    measured = []
    for _ in range(6):
        heaps = clusters.Heaps.load(heaps.store(), 8) if measured else heaps
        measured.append(heaps.assign(points, centroids, slack)[1])
        assert (heaps.cluster == clusters.distances(points, centroids).argmin(1)).all()
        moved = centroids + rng.integers(-3, 4, centroids.shape)
        drift = np.sqrt(((moved - centroids) ** 2).sum(1))
        slack, centroids = slack + drift + np.array([max(np.delete(drift, j)) for j in range(8)]), moved
    assert measured[0] == 2000 and sum(measured[1:]) == 0
    # Far enough, and everything is measured again.
    assert heaps.assign(points, centroids, slack + 1e9)[1] == 2000


def test_rounds_meet_the_heaps_without_a_shuffle(rows, spark):
    buckets = clusters._Buckets(spark)
    cut = rows([(b, [b], np.zeros(64, "<i4").tobytes()) for b in range(5)], "block long, ids array<long>, points binary")
    blocks = buckets.store(cut.repartition(buckets.n, "block"), "blocks")
    centroids = np.zeros((1, 64), dtype=np.int64)
    state = buckets.store(clusters._round(blocks, None, centroids, np.zeros(1)), "heaps")
    plan = clusters._round(blocks, state, centroids, np.zeros(1))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    buckets.drop("blocks")
    buckets.drop("heaps")
    assert not buckets.paths
