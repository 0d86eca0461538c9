"""Secret scan: candidates against a scan by hand, words against counts by hand, verdicts on planted secrets."""

import collections
import re

import pytest

from linkloom.llm import secrets
from linkloom.llm.shared import Workspace
from tests.llm import awkward

SF = "/root/testdata/sf0.01"
ASKED = re.compile(r"(?:passw(?:or)?d|pwd|secret|token|key|credentials?|auth|bearer)[\"']?\s{0,3}[=:]\s{0,3}[\"']?", re.I | re.A)
RUN = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
ENDS = set(" \t\n\x0b\x0c\r\"'<>,;")


def candidates(text):
    """Place by place: the value after a word that asks for it, else a long run with a digit."""
    out, i = [], 0
    while i < len(text):
        j = i
        if text[i - 1 : i] and text[i - 1] in "=: \t\n\x0b\x0c\r\"'" and any(ASKED.fullmatch(text, s, i) for s in range(max(0, i - 40), i)):
            while j < len(text) and text[j] not in ENDS:
                j += 1
            j = j if j - i >= 6 else i
        if j == i and text[i] in RUN and (i == 0 or text[i - 1] not in RUN):
            while j < len(text) and text[j] in RUN:
                j += 1
            j = j if j - i >= 16 and any(c.isdigit() for c in text[i:j]) else i
        if j > i:
            out.append(text[i:j])
        i = max(j, i + 1)
    return out


MADE = [
    'password = "s3cr.t!x" and pwd: abc', "token:abcdef", "api_key='q.w:e@r&t' x", "PASSWORD   =   hunter22", "password    = hunter22", "key=a,b,c,defghi secret==doubled1", "auth: \n\n  lined-up-42",
    "nokeyhere " + "a" * 15 + "1 " + "a" * 14 + "1", "x" * 700 + "7", "token = " + "é" * 8, 'credential="' + "ab/" * 2000 + '9"', "key: token: nested-one", "monkey=banana-split", 'secret: "p@ss:w0rd!" and bearer=x.y.z.w', "pwd=___---___",
]


def test_candidates_equal_a_scan_by_hand(spark):
    rows = [(k, t, None) for k, t in enumerate([*MADE, *[r[1] for r in awkward.rows()]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.findings(df).collect()
    got = sorted((r["doc_id"], r["finding"], r["candidate"]) for r in found)
    assert got == sorted((k, i, c) for k, t, _ in rows for i, c in enumerate(candidates(t or "")))
    assert len(got) > 15
    assert secrets.with_features(secrets.findings(df)).select(*secrets.FEATURES).dropna().count() == len(got)


def test_words_are_counted_over_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = secrets.learn_words(docs, Workspace(spark, "test"), top=300)
    n = collections.Counter(w for r in docs.collect() for w in set(re.findall(r"(?<![a-z])[a-z]{4,10}(?![a-z])", (r["text"] or "").lower())))
    best = sorted((w for w in n if n[w] > 1), key=lambda w: (-n[w], w))[:300]
    pairs = collections.Counter()
    for w, k in n.items():
        for i in range(len(w) - 1):
            pairs[w[i : i + 2]] += k
    assert words == secrets.of_counts(best, pairs)


def test_features_of_words(spark):
    words = secrets.of_counts(["abcd", "cdefg"], {"ab": 100})
    row = ("abcdefgh" + "x" * 246 + "abcd", 'the big "token" = "', '" then', "docs/a/b.md")  # the last word is cut by a piece's end
    df = spark.createDataFrame([row, ("abcd1234zz", "", "", None)], "candidate string, before string, after string, path string")
    long, short = secrets.with_features(df, words).collect()
    assert long["covered"] == pytest.approx(7 / 258) and short["covered"] == pytest.approx(0.4)
    assert long["path_test"] == 1 and long["path_depth"] == 2 and long["quoted"] == 1 and short["path_depth"] == 0
    assert sum(long[f"near_{i}"] for i in range(secrets.NEAR)) == 4 and sum(short[f"near_{i}"] for i in range(secrets.NEAR)) == 0
    cost = lambda a, b: words.pairs[a * 28 + b]
    assert short["unusual"] * 10 == cost(1, 2) + cost(2, 3) + cost(3, 4) + cost(4, 27) + 3 * cost(27, 27) + cost(27, 26) + cost(26, 26)


def test_planted_secrets_are_told_from_numbers(spark):
    """All planted tokens are secrets, nothing else is."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    planted = collections.Counter((r["doc_id"], t) for r in docs.collect() for t in re.findall(r'token = "([0-9a-f]{40})"', r["text"] or ""))
    words = secrets.learn_words(docs, Workspace(spark, "test"))
    rows = secrets.scan(docs, secrets.fit(secrets.made_findings(spark), words=words), words=words).collect()
    assert collections.Counter((r["doc_id"], r["candidate"]) for r in rows if r["is_secret"]) == planted
    assert len(planted) > 5 and len(rows) > 2 * len(planted)
