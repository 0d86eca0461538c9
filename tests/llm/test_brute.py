"""Operators that SQL can't express, against brute force, round trips or held-out rows."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import langid, lm, ngram_join, packing, secrets, sharding, warc
from tests.llm import awkward

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def documents(spark, d):
    return [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def brute_components(rows, num=85, den=100):
    sets = sorted({(d, shingles(t)) for d, t in rows}, key=lambda x: (x[0] is None, x[0] or 0))
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and den * len(a & b) >= num * len(a | b):
            x, y = top(i), top(j)
            parent[max(x, y)] = min(x, y)
    least = {}
    for i, (d, s) in enumerate(sets):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    of = {(d, s): (least.get(top(i)) if s else d) for i, (d, s) in enumerate(sets)}
    return sorted(((d, len(shingles(t)), of[d, shingles(t)]) for d, t in rows), key=str)


@pytest.mark.parametrize("doubled", [None, True, False])
def test_join_equals_brute_force(spark, tmp_path, doubled):
    d = awkward.write(spark, tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = ngram_join.jaccard_components(docs, doubled=doubled).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(documents(spark, d))


def test_join_finds_every_link_of_a_crowd(spark, tmp_path, monkeypatch):
    """Families whose copies differ from each other by about as much as links allow."""
    import random

    rng = random.Random(5)
    rows = []
    for family in range(3):
        base = awkward.sentence(rng, 90 + 40 * family).split()
        for k in range(60):
            w = list(base)
            for _ in range(k % 9):
                w[rng.randrange(len(w))] = "q" + str(rng.randrange(50))
            rows.append((family * 100 + k, " ".join(w), None, None, 0, *awkward.CLASH))
    d = awkward.write(spark, tmp_path, rows)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    got = ngram_join.op2_ngram_join(spark, d)
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(documents(spark, d))


def test_near_duplicate_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{awkward.write(spark, tmp_path)}/documents.parquet")
    out = ngram_join.near_duplicate_stage(docs)
    ids = {r["doc_id"] for r in out.collect()}
    assert out.columns == docs.columns
    assert {1, 5, 6, 7, 8, 10, 11} <= ids and not ids & {2, 3, 4, 9, 12}


def test_scheme_holds_the_pigeonhole():
    for doubled in (True, False):
        s = ngram_join.Scheme.of(85, 100, doubled)
        for n in range(1, 400):
            b = int(np.searchsorted(s.upper, n))
            assert s.most[b] >= 15 * n // 85 and s.segments[b] + s.doubled[b] > s.most[b]
            m = n * 100 // 85  # the largest set that can be similar
            assert int(np.searchsorted(s.upper, m)) <= b + 1


@pytest.mark.parametrize("where", ["awkward", SF])
def test_packing(spark, tmp_path, where):
    d = awkward.write(spark, tmp_path) if where == "awkward" else where
    rows = awkward.collect(packing.op10_best_fit_packing(spark, d))
    import public_tokenizers
    from tokenizers import Tokenizer

    named = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t in documents(spark, d):
        ids = np.array([*named.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at, k, n = 0, 0, len(ids) % 2048 or 2048
        while at < len(ids):
            n = n if k == 0 else 2048
            want[i, k, at, min(n, len(ids)), zlib.crc32(ids[at : at + n].tobytes())] += 1
            at, k = at + n, k + 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in by.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    sizes, gaps = sorted((r["length"] for r in rows), reverse=True), []
    for n in sizes:  # plain best fit, longest first
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((fit or 2048) - n)
    assert len(by) <= len(gaps) * 1.01 + 1


@pytest.mark.parametrize("blank", " \t\n")
def test_long_runs_of_blanks_encode(blank):
    """The fast library gives up on these."""
    import public_tokenizers
    from tokenizers import Tokenizer

    named = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "a" + blank * 2_000_000 + "b"
    assert packing.encoder(None)(text).tolist() == named.encode(text, add_special_tokens=False).ids


def test_packing_needs_few_supersteps(spark):
    """Lengths of every kind: all are placed once, in few more sequences than plain best fit needs."""
    rng = np.random.default_rng(3)
    for sizes in (rng.integers(1, 2049, 4000), rng.integers(1, 60, 4000), np.minimum(2048, rng.exponential(300, 4000).astype(int) + 1)):
        ws = packing.Workspace(spark, "fit")
        counts = collections.Counter(sizes.tolist())
        rules = packing.match(spark.createDataFrame([*counts.items()], "length long, n long"), 2048, 4, ws).collect()
        held, ranks = collections.Counter(), collections.Counter()
        for r in rules:
            ranks[r["size"]] += r["n"]
            for k in range(r["n"]):
                held[r["bin"] + k // r["per_bin"]] += r["size"]
        assert ranks == counts and max(held.values()) <= 2048 and sum(held.values()) == sizes.sum()
        one = packing.fit({x: (0, n) for x, n in counts.items()}, {2048: [(0, len(sizes))]}, 2048, 1)
        assert len(held) <= 1.01 * len({r[4] + k // r[5] for r in one if r[0] == packing.RULE for k in range(r[3])}) + 1
        assert sorted(held) == [*range(len(held))]


def test_plain_texts_encode_alike():
    import public_tokenizers
    from tokenizers import Tokenizer

    named = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    named.encode_special_tokens = True
    mine = packing.encoder(None)
    for c in map(chr, range(0x250)):
        for text in (f"a{c}b", f"  {c} {c}1", f"x {c}\n{c}{c}", f"'{c}s '{c}", f"it'{c} {c}'ll", f"{c}\r\n\t {c}"):
            assert list(mine(text)) == named.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("where", ["awkward", SF])
def test_sharding(spark, tmp_path, where):
    d = awkward.write(spark, tmp_path) if where == "awkward" else where
    rows = awkward.collect(sharding.op8_sharding(spark, d))
    want = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in documents(spark, d))
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < 24 and r["law"] == "bytes" and r["grown_shard"] is None
        by[r["shard"]].append(r)
    total, most = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for s in by.values():
        assert sorted(r["slot"] for r in s) == list(range(len(s)))
        assert abs(sum(r["size"] for r in s) - total / 24) <= most + total / 2400


@pytest.mark.parametrize("where", ["awkward", SF])
def test_lm(spark, tmp_path, where):
    d = awkward.write(spark, tmp_path) if where == "awkward" else where
    rows = awkward.collect(lm.op6_lm_scoring(spark, d))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    docs = [(i, [*WORD.findall((t or "").translate(LOWER)), None]) for i, t in documents(spark, d)]
    c = collections.Counter(w for i, t in docs if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(t), sum(c[w] > 0 for w in t), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for i, t in docs)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in rows) == want
    assert all(r["train_tokens"] == n and r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    if where == SF:
        out = [r for r in rows if r["held_out"]]
        assert sum(r["score"] for r in out) > 1.02 * sum(r["base_score"] for r in out)


def test_filter_counts_by_probing():
    shape = lm.Shape(4, 1 << 18)
    rng = np.random.default_rng(1)
    words = np.unique(lm.mix(rng.integers(0, 1 << 62, 3000).astype(lm.U)))
    counts = rng.integers(1, 200, len(words))
    import pyarrow as pa

    bits = np.zeros(shape.block // 8 * 4, np.uint8)
    for b, i, j in lm.split(lm.bucket_of(words, 4)):
        t = lm.block_of(shape)(pa.table([[b], [words[i:j].tobytes()], [counts[i:j].astype("<u4").tobytes()], [b""], [b""]], schema=lm._COUNTS))
        bits[b * (shape.block // 8) : (b + 1) * (shape.block // 8)] = np.frombuffer(t["block"][0].as_py(), np.uint8)
    got = lm.look_up(words, bits, shape)
    assert (got >= lm.value_of(lm.level_of(counts, 1.5), 1.5)).all()  # never too few
    assert np.mean(np.abs(np.log(got / counts)) < 0.5) > 0.9
    assert np.mean(lm.look_up(lm.mix(words), bits, shape) > 0) < 0.1


def test_language_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in langid.init(3, 4, 0).items()}
    x, y = rng.integers(0, 257, (6, 5)), rng.integers(0, 3, 5)
    _, g = langid.gradients(p, x, y)
    for k in p:
        for _ in range(4):
            i = tuple(rng.integers(0, s) for s in p[k].shape)
            i = (x[2, 1], i[1]) if k.startswith("x_") else i
            up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
            up[k][i] += 1e-3
            down[k][i] -= 1e-3
            slope = (langid.gradients(up, x, y)[0] - langid.gradients(down, x, y)[0]) / 2e-3
            assert slope == pytest.approx(float(g[k][i]), abs=2e-4)


def test_language_of_held_out_rows(spark):
    rows = langid.op4_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert len(out) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_awkward_rows(spark, tmp_path):
    d = awkward.write(spark, tmp_path)
    rows = awkward.collect(langid.op4_language_id(spark, d))
    assert len(rows) == len(awkward.rows())
    by = {r["doc_id"]: r for r in rows}
    assert [by[i]["lang_pred"] for i in (5, 6, 7, 17)] [:3] == ["und"] * 3 and by[5]["score"] == 0
    assert by[1]["lang_pred"] in {"de", "en", "fr"}


def test_secrets(spark, tmp_path):
    d = awkward.write(spark, tmp_path)
    rows = awkward.collect(secrets.op1_secret_scan(spark, d))
    assert sorted((r["doc_id"], r["finding"], r["length"], r["is_secret"]) for r in rows if r["doc_id"] == 16) == [(16, 0, 40, True), (16, 1, 16, False)]
    labelled = secrets.made_findings(spark).withColumn("fold", F.crc32("candidate") % 4)
    model = secrets.fit(labelled.where("fold > 0"))
    from pyspark.ml.feature import VectorAssembler

    test = VectorAssembler(inputCols=secrets.FEATURES, outputCol="features").transform(secrets.with_features(labelled.where("fold = 0")))
    assert model.transform(test).agg(F.avg(F.expr("cast(prediction = label as int)"))).first()[0] > 0.95


def test_warc_round_trip(spark):
    rows = awkward.collect(warc.op9_warc(spark, SF))
    assert len(rows) == 2 * spark.read.parquet(f"{SF}/pages.parquet").count()
    data = b"".join(warc.serialise(r["headers"], r["block"].encode()) for r in rows)
    parsed = warc.parse(data)
    assert len(parsed) == len(rows)
    for r, (h, block) in zip(rows, parsed, strict=True):
        assert block == r["block"].encode() and h["WARC-Block-Digest"] == warc.digest(block) == r["block_digest"]
        assert h["WARC-Refers-To"] == r["refers_to"] and h["WARC-Record-ID"] == r["record_id"] and h["WARC-Type"] == r["type"]
    assert len({r["record_id"] for r in rows}) == len(rows)


def test_warc_awkward_records(spark, tmp_path):
    page = "<html lang=\"DE\"><head><title>A &amp;\n B</title></head><body><script>x</script><p>Eins&nbsp;zwei<br>drei<!-- no --></p></body></html>"
    data = [(1, "http://a/", page), (2, None, None), (3, "http://b/", ""), (3, "http://b/", ""), (None, "u", "plain < text")]
    spark.createDataFrame(data, "page_id long, url string, html string").withColumn("headers", F.lit("x")).write.parquet(f"{tmp_path}/pages.parquet")
    rows = awkward.collect(warc.op9_warc(spark, str(tmp_path)))
    text = {r["page_id"]: r["block"] for r in rows if r["type"] == "conversion"}
    assert len(rows) == 10 and text == {1: "Eins zwei\ndrei", 2: "", 3: "", None: "plain < text"}
    [meta] = [r for r in rows if r["page_id"] == 1 and r["type"] == "metadata"]
    assert "title: A & B\r\n" in meta["block"] and "language: de\r\n" in meta["block"] and "source-header-content-type: text/html; charset=utf-8" in meta["block"]
    assert warc.derive(warc.responses(spark.read.parquet(f"{tmp_path}/pages.parquet")).withColumn("type", F.lit("request"))).count() == 0
    assert [r["target_uri"] for r in rows if r["page_id"] == 2] == [None, None] and "WARC-Target-URI" not in next(r for r in rows if r["page_id"] == 2)["headers"]


def test_warc_files_round_trip(spark, tmp_path):
    """Records of any bytes through Spark's writer and reader, plain and gzipped; derivatives of what was read."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    odd = [("WARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 9\r\n", b"\xff\x00\r\n\r\n\n\x80z")]
    records = warc.responses(pages).select("headers", "block").unionByName(spark.createDataFrame(odd, "headers string, block binary"))
    want = sorted((r["headers"], bytes(r["block"])) for r in records.collect())
    for kind in ("none", "gzip"):
        warc.write_warc(records, f"{tmp_path}/{kind}", kind)
        back = warc.read_warc(spark, f"{tmp_path}/{kind}")
        assert sorted((r["headers"], bytes(r["block"])) for r in back.collect()) == want
    texts = lambda df: sorted((r["refers_to"], r["type"], r["content_length"], r["block_digest"]) for r in df.collect())
    assert texts(warc.derive(back.where("record_id <> '<x>'"))) == texts(warc.derive(warc.responses(pages)))


def test_warc_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op9_warc(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("piece", ["<!--", "<script>", "<a", "<title", "<title>", "<html lang", "</script ", "&#99999", "<p>", "<", "<style><!--"])
def test_long_pages_of_what_never_ends(piece):
    """5 MB each, in time by their length."""
    import time

    began = time.perf_counter()
    page = piece * (5_000_000 // len(piece))
    warc.text_of(page), warc.title_of(page), warc.language_of(page)
    warc.text_of("&#" + "9" * 5_000_000 + ";")
    assert time.perf_counter() - began < 40


def slow_text(page):
    """The definition, tag by tag, for pages whose tags end."""
    page = re.sub(r"<!--.*?-->|<(script|style|noscript|template|head)\b[^>]*>.*?</\1\s*>", " ", page, flags=re.S | re.I)
    page = re.sub(rf"</?(?:{warc.BREAKS})\b[^>]*>", "\n", page, flags=re.I)
    page = re.sub(r"<[!/?a-zA-Z][^>]*>", "", page)
    import html

    lines = (" ".join(x.split()) for x in html.unescape(page).split("\n"))
    return "\n".join(x for x in lines if x)


def test_warc_text_equals_its_definition(spark):
    pages = [r["html"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    pages += ["a < b <p>c</P ><br/>d <!-- <p> --> e<script>if (a<b) x()</script >f<!doctype x>&amp;lt;", "<head><title>T</title></head>x", "1 <2 <<b>3</b>"]
    for page in pages:
        assert warc.text_of(page) == slow_text(page)
