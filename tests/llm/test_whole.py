"""Inputs on which a cut of an operator would show: nothing is left out beyond some size."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from linkloom.llm import dedup, langid, lm, ngram_join
from tests.llm import awkward
from tests.llm.test_brute import LOWER, WORD


def test_components_of_a_long_chain(spark):
    """A path in random node order takes rounds by its length where labels aren't hooked."""
    nodes = ngram_join.mix(np.arange(1, 3001, dtype=ngram_join.U)).view(np.int64)
    edges = spark.createDataFrame([(int(a), int(b)) for a, b in zip(nodes[:-1], nodes[1:], strict=True)], "a long, b long").repartition(4)
    got = ngram_join.components(edges, ngram_join.Workspace(spark, "chain"), "chain").collect()
    assert {r["node"] for r in got} == set(nodes.tolist()) and {r["comp"] for r in got} == {int(nodes.min())}


def test_join_links_a_long_chain(spark, tmp_path):
    """Texts of 16 words, each a word further on: neighbours have 12 of 14 shingles in common, others less than 0.85."""
    rows = [(i, " ".join(f"w{i + j}" for j in range(16)), None, None, 0, *awkward.CLASH) for i in range(1500)]
    got = ngram_join.op2_ngram_join(spark, awkward.write(spark, tmp_path, rows)).collect()
    assert len(got) == 1500 and {r["component_id"] for r in got} == {0}


def test_filter_grows_with_what_is_counted():
    """A block has bits for its own levels, and tells counts as well when it holds 50 times as many."""
    shape = lm.Shape(1)
    wrong, size = [], []
    for n in (4000, 200000):
        words = np.unique(lm.mix(np.arange(1, n + 1, dtype=lm.U)))
        counts = np.random.default_rng(2).integers(1, 200, n).astype("<u4")
        pairs = (lm.mix(words ^ lm.U(5)) & lm.U(0xFFFFFFFF)).astype("<u4")
        table = pa.table([[0], [words.tobytes()], [counts.tobytes()], [pairs.tobytes()], [lm.pack(np.ones(n, "<u4"))]], schema=lm._COUNTS)
        bits = np.frombuffer(lm.block_of(shape)(table)["block"][0].as_py(), np.uint8)
        level = lm.levels_in(0, words & lm.U(0xFFFFFFFF), bits, shape, len(bits) * 8)
        assert (level >= lm.level_of(counts, 1.5)).all() and lm.levels_in(0, pairs, bits, shape, len(bits) * 8).all()
        wrong.append(np.mean(level > lm.level_of(counts, 1.5)))
        size.append(len(bits))
    assert max(wrong) < 0.02 and 40 < size[1] / size[0] < 60


@pytest.mark.parametrize("group", [1 << 20, 500])
def test_scores_come_from_all_counts(spark, tmp_path, monkeypatch, group):
    """Scores are those of exact levels of all words, pairs and triples, single ones among them, but for one false level in 200, under the weights that suit the training texts."""
    monkeypatch.setattr(lm, "GROUP", group)
    d = awkward.write(spark, tmp_path)
    rows = lm.op6_lm_scoring(spark, d).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    words = [(i, [None, *WORD.findall((t or "").translate(LOWER)), None]) for i, t in docs]
    c = collections.Counter(tuple(t[j - n + 1 : j + 1]) for i, t in words if not held(i) for j in range(1, len(t)) for n in (1, 2, 3) if j - n + 1 >= 0)
    value = lambda g: float(lm.value_of(lm.level_of(np.array([c[g]]), 1.5), 1.5)[0]) if c[g] else 0.0
    n, v = sum(k for g, k in c.items() if len(g) == 1), sum(len(g) == 1 for g in c)

    def p(t, j, a, b, less):
        out = (max(value((t[j],)) - less, 0) + 0.5) / (n + 0.5 * (v + 1) - less)
        for size, mu in ((2, a), (3, b)):
            if j - size + 1 >= 0:
                gram = tuple(t[j - size + 1 : j + 1])
                of = value(gram[:-1])
                out = (max(min(value(gram), of) - less, 0) + mu * out) / (max(of - less, 0) + mu)
        return math.log10(out)

    fit = [sum(p(t, j, a, b, 1) for i, t in words if not held(i) for j in range(1, len(t))) for a, b in lm.WEIGHTS]
    a, b = lm.WEIGHTS[int(np.argmax(fit))]
    want = sorted((str(i), sum(p(t, j, a, b, 0) for j in range(1, len(t))) / (len(t) - 1)) for i, t in words)
    got = sorted((str(r["doc_id"]), r["score"] / r["n_tokens"]) for r in rows)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.mean([abs(x - y) < 0.02 * abs(y) for (_, x), (_, y) in zip(got, want, strict=True)]) > 0.9


def test_probabilities_of_a_context_add_up_to_one():
    """All followers of a context, at its counts, and words never seen there."""
    word, pair, triple = np.array([6.0, 3, 1, 0]), np.array([4.0, 2, 0, 0]), np.array([2.0, 0, 0, 0])
    norm = 10 + 0.5 * 4  # four words, the last of them unknown
    for x in lm.log_likelihoods([(word, word), (pair, np.full(4, 6.0)), (triple, np.full(4, 2.0))], norm, 0):
        assert math.isclose(sum(10**x), 1.0)


def test_doubled_texts_score_above_single_ones(spark, tmp_path):
    """Texts of one make, a fifth of them twice."""
    rng = np.random.default_rng(4)
    text = lambda: " ".join(f"w{w}" for w in rng.zipf(1.3, 120) % 5000)
    texts = [text() for _ in range(400)]
    rows = [(i, t, None, None, 0, *awkward.CLASH) for i, t in enumerate([*texts, *texts[:80]])]
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in lm.op6_lm_scoring(spark, awkward.write(spark, tmp_path, rows)).collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    twice = [got[i] for i in range(80) if not held(i) and not held(400 + i)]
    once = [got[i] for i in range(80, 400) if not held(i)]
    assert len(twice) > 30 and np.mean(np.array(twice) > np.quantile(once, 0.95)) > 0.95


@pytest.mark.parametrize("n, places", [(51, [25]), (100, [30, 60])])
def test_stage_drops_borderline_near_copies(spark, n, places):
    """0.8 or more by five words, less than 0.85 by four."""
    base = [f"w{i}" for i in range(n)]
    other = [f"x{i}" if i in places else w for i, w in enumerate(base)]
    for k, least, most in ((5, 0.8, 0.82), (4, 0.84, 0.85)):
        a, b = ({tuple(t[i : i + k]) for i in range(n - k + 1)} for t in (base, other))
        assert least <= len(a & b) / len(a | b) < most
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(other))], "doc_id long, text string")
    assert [r["doc_id"] for r in ngram_join.near_duplicate_stage(docs).collect()] == [1]


def test_every_label_is_learned(spark, monkeypatch):
    """70 labels: the classifier gets a class for each."""
    seen = []
    train = langid.train
    monkeypatch.setattr(langid, "train", lambda texts, labels, n, **k: seen.append((sorted(set(labels)), n)) or train(texts, labels, n, **k))
    docs = spark.createDataFrame([(i, f"text {i}", f"l{i % 70:02}") for i in range(210)], "doc_id long, text string, lang string")
    langid.identify(docs, langid.F.lit(False), steps=1)
    assert seen == [([*range(70)], 70)]


def test_sample_of_many_labels_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}", f"l{i % 70}") for i in range(700)], "doc_id long, text string, lang string")
    got = langid.sample_labelled(docs, 9, 140, 99).collect()
    assert len(got) == 140 and len({r["lang"] for r in got}) == 70


def test_made_words_have_hashes_of_their_own():
    """Thue-Morse words defeat polynomials modulo a power of two; a key gives other hashes."""
    from linkloom.llm.tokens import word_slices

    one = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    h = lambda key: next(word_slices(pa.array([f"{one} {other} {one.upper()} ab ba a\u00e9"]), key))[2].tolist()
    x, y, z, *rest = h(0)
    assert x != y and x == z and len({x, y, *rest}) == 5 and not {*h(0)} & {*h(7)}


def test_common_passage_pairs_no_unlike_documents(spark, tmp_path, monkeypatch):
    """300 unlike documents around one passage, some with near copies, in blocks of 32: links as by brute force, few pairs told."""
    import random

    from tests.llm.test_brute import brute_components, documents

    rng = random.Random(8)
    passage = awkward.sentence(rng, 120)
    rows = []
    for i in range(300):
        own = awkward.sentence(rng, 60).split()
        rows.append((3 * i, " ".join(own[:30]) + " " + passage + " " + " ".join(own[30:]), None, None, 0, *awkward.CLASH))
        if i % 10 == 0:
            own[rng.randrange(60)] = "zz"
            rows.append((3 * i + 1, " ".join(own[:30]) + " " + passage + " " + " ".join(own[30:]), None, None, 0, *awkward.CLASH))
    d = awkward.write(spark, tmp_path, rows)
    monkeypatch.setattr(ngram_join, "BLOCK", 32)
    told = []
    across = ngram_join.across
    monkeypatch.setattr(ngram_join, "across", lambda crowd, *x: told.append(crowd.where("k > 32").count()) or across(crowd, *x))
    rarest = ngram_join.rarest
    refined = []
    monkeypatch.setattr(ngram_join, "rarest", lambda docs, nodes, *x: refined.append(nodes.count()) or rarest(docs, nodes, *x))
    got = ngram_join.op2_ngram_join(spark, d)
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(documents(spark, d))
    assert refined and refined[0] > 200 and not any(told)


def test_family_in_a_crowd_tells_few_pairs(spark, tmp_path, monkeypatch):
    """200 texts that differ from each other by a little, among 200 unlike ones with their passage: one component, far fewer than all pairs."""
    import random

    from tests.llm.test_brute import brute_components, documents

    rng = random.Random(9)
    passage, base = awkward.sentence(rng, 60), awkward.sentence(rng, 60).split()
    rows = []
    for i in range(200):
        rows.append((2 * i, passage + " " + awkward.sentence(rng, 60), None, None, 0, *awkward.CLASH))
        w = list(base)
        for _ in range(2):
            w[rng.randrange(60)] = f"v{rng.randrange(10)}"
        rows.append((2 * i + 1, passage + " " + " ".join(w), None, None, 0, *awkward.CLASH))
    d = awkward.write(spark, tmp_path, rows)
    told = []
    verify = ngram_join.verify
    monkeypatch.setattr(ngram_join, "verify", lambda docs, pairs, *x: told.append(pairs.count()) or verify(docs, pairs, *x))
    got = ngram_join.op2_ngram_join(spark, d)
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(documents(spark, d))
    assert sum(told) < 200 * 199 / 2 / 3


def test_sample_is_of_rows_not_of_ids(spark):
    """3,000 rows that share an id, and copies of one row."""
    rows = [(i if i < 1000 else 7, f"text {i}", "a") for i in range(4000)] + [(9, "same", "a")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [r["text"] for r in langid.sample_labelled(docs, 400, 25600, 99).collect()]
    assert len(got) == len(set(got)) == 400
    assert got and sorted(got) == sorted(r["text"] for r in langid.sample_labelled(docs.repartition(5), 400, 25600, 99).collect())


def test_held_out_texts_score_above_the_base(spark):
    rows = lm.op6_lm_scoring(spark, "/root/testdata/sf0.001").where("held_out").collect()
    assert len(rows) > 20 and sum(r["score"] for r in rows) > 0.95 * sum(r["base_score"] for r in rows)  # both are negative


def test_dedup_stage_keeps_one_row_of_each_text(spark, tmp_path):
    docs = spark.read.parquet(f"{awkward.write(spark, tmp_path)}/documents.parquet")
    kept = dedup.dedup_stage(docs)
    bare = lambda t: "".join(WORD.findall(t or ""))
    assert sorted(bare(r["text"]) for r in kept.collect()) == sorted({bare(r[1]) for r in awkward.rows()})
