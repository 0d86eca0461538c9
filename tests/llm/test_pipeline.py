"""The pipeline, stage by stage against brute force, over awkward, copied and ordinary rows."""

import collections
import re

import pytest

import corpus_pipeline
from linkloom.llm import packing
from tests.llm import awkward

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    plain = [(1000 + r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], *awkward.CLASH) for r in docs]
    return awkward.rows() + plain + plain[:7]


def shingles(text):
    w = WORD.findall(text.translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_groups(texts):
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def base_failed(text):
    w = WORD.findall(text or "")
    three = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {p for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    return len(w) < 50 or 2 * len(again) > len(w)


def targets(sizes):
    """Capped water-filling: 150 % of all words by weights 3, 1, 2; no source above twice its own."""
    weight = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [3, 1, 2] * len(sizes), strict=False))
    full: dict = {}
    while True:
        left, free = 1.5 * sum(sizes.values()) - sum(full.values()), [s for s in sizes if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s: 2.0 * sizes[s] for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return full | share
        full |= above


def test_every_stage(spark, tmp_path):
    d = awkward.write(spark, tmp_path, table(spark))
    docs = before = spark.read.parquet(f"{d}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, d).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out[name] = [tuple(r) for r in docs.collect()] if docs.columns == before.columns else docs.collect()
    given = collections.Counter(map(str, table(spark)))
    of = lambda rows: collections.Counter(map(str, rows))
    good, single, apart, mixed, packed = (out[n] for n, _ in corpus_pipeline.STAGES)

    assert of(good) <= given and 100 < len(good) < sum(given.values())
    assert not any(base_failed(r[1]) for r in good)

    bare = lambda t: "".join(WORD.findall(t or ""))
    groups = collections.defaultdict(list)
    for r in good:
        groups[bare(r[1])].append(r)
    best = lambda g: min((-len(r[1]), r[0] is None, r[0] or 0) for r in g)
    assert of(single) <= of(good)
    assert sorted((-len(r[1]), r[0] is None, r[0] or 0) for r in single) == sorted(best(g) for g in groups.values())

    roots = near_groups([r[1] for r in single])
    assert of(apart) <= of(single) and len(apart) == len(set(roots)) < len(single)
    root_of = {str(r): g for r, g in zip(single, roots, strict=True)}
    assert len({root_of[str(r)] for r in apart}) == len(apart)

    assert set(of(mixed)) <= set(of(apart)) and max(of(mixed).values()) <= 2
    size = lambda rows: {s: [len(WORD.findall(r[1])) for r in rows if r[3] == s] for s in {r[3] for r in rows}}
    sizes, taken = size(apart), size(mixed)
    for s, target in targets({s: sum(n) for s, n in sizes.items()}).items():
        assert abs(sum(taken.get(s, [])) - target) <= max(sizes[s])

    encode = packing.encoder(None)
    pieces = collections.defaultdict(list)
    for r in packed:
        pieces[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in pieces.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 2048
    assert collections.Counter(r["doc_id"] for r in packed if r["piece"] == 0) == collections.Counter(r[0] for r in mixed)
    assert sum(r["length"] for r in packed) == sum(len(encode(r[1])) + 1 for r in mixed)


@pytest.mark.parametrize("rows", [[], [(5, None, None, None, None, *awkward.CLASH)] * 3])
def test_nothing_to_pack(spark, tmp_path, rows):
    d = awkward.write(spark, tmp_path, rows)
    assert corpus_pipeline.run(spark, d).collect() == []
