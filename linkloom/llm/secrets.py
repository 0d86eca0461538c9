"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 16 or more of ``[A-Za-z0-9+/_-]`` with a digit in it, or any value of 6
or more characters other than blanks, quotes and ``<>,;`` that follows a word such as password,
token or key and a ``=`` or ``:``. Its features are its length, its character transitions
(changes of class, and how usual its pairs of letters are in the corpus), how much of it
dictionary words cover, its path (what kind of place the document's source is, slashes in the
candidate) and the neighbouring words, hashed. Dictionary and letter pairs are counted over
all documents (``learn_words``). The forest learns from labelled findings, a bounded table of
the columns ``candidate, before, after, path, label``. The test tables have no such labels,
hence ``made_findings`` makes some by kind: keys, tokens and passwords, with and without a word
that asks for them, against hashes, identifiers, card numbers, links, file names and
placeholders, with and without one. Columns of Spark functions and Spark ML only.

Defined results: a null, empty or blank text has no finding; findings are numbered from 0 in
each row of the table, so a repeated row repeats them; a null path is an empty one; an empty
table gives an empty one; other columns are ignored. A candidate of more than 256 characters is
looked up in pieces of 256, a word across two of them counts for neither.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.shared import Workspace

RUN = "A-Za-z0-9+/_-"
ASKED = r"(?i:passw(?:or)?d|pwd|secret|token|key|credentials?|auth|bearer)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
VALUE = r"[^\s\"'<>,;]"
#: Cheap looks back come first: most places in prose end there.
CANDIDATE = rf"(?<=[=:\s\"'])(?<=[=:]\s{{0,3}}[\"']?)(?<={ASKED}){VALUE}{{6,}}+|(?<![{RUN}])(?=[A-Za-z+/_-]*+[0-9])[{RUN}]{{16,}}+"
BEFORE, AFTER = 60, 20

#: What the dictionary holds besides the corpus's words.
DICTIONARY = (
    "about account admin after alpha apple archive article backup base beta block book branch build cache card change check class clean client cloud code color common "
    "config content copy core count data date default delete demo design detail device dist docs document draft edit email error event example export field file final first "
    "folder form format from github green group guide hello home host html http https icon image import index info input item java json label large last layout level library "
    "license line link list local login main manager master media message method model module month name network number object online open option order output package page "
    "path person phone photo play point post price print product project public query read record release report request result return review route sample schema screen script "
    "search section select server service session share simple size small source spark start state static status store story stream string style support system table target "
    "task template test text theme time title tool topic train type update upload user value version video view watch water week width window word work world year"
).split()
SHORTEST, LONGEST = 4, 10
NEAR = 128
FEATURES = ["length", "digits", "upper", "hex", "transitions", "unusual", "covered", "slashes", "path_test", "path_settings", "path_depth", "assigned", "quoted", *[f"near_{i}" for i in range(NEAR)]]


@dataclass(frozen=True)
class Words:
    """Dictionary words of 4 to 10 letters, and how rare each pair of 28 classes (letters, digit, other) is: -100 log10 p."""

    dictionary: tuple[str, ...]
    pairs: tuple[int, ...]


def of_counts(dictionary, pairs: dict[str, int]) -> Words:
    """From counts of two-letter strings; each class in turn has a probability per class that follows."""
    at = lambda c: ord(c) - 96 if "a" <= c <= "z" else 27 if c.isdigit() else 0
    n = [[0.5] * 28 for _ in range(28)]
    for x, k in pairs.items():
        n[at(x[0])][at(x[1])] += k
    return Words(tuple(sorted({*dictionary, *DICTIONARY})), tuple(round(-100 * math.log10(k / sum(row))) for row in n for k in row))


def plain_words() -> Words:
    """From the fixed dictionary alone."""
    return of_counts([], Counter(w[i : i + 2] for w in DICTIONARY for i in range(len(w) - 1)))


def learn_words(docs: DataFrame, ws: Workspace, top: int = 4096, text_col: str = "text") -> Words:
    """The ``top`` words by number of documents (two at least), and letter pairs of all words; both counted over all of ``docs``.

    The driver gets ``top`` words and at most 676 pairs.
    """
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(f"(?<![a-z])[a-z]{{{SHORTEST},{LONGEST}}}+(?![a-z])"), F.lit(0)))
    seen = ws.save(docs.select(F.explode(found).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")), "words")
    often = [r["w"] for r in seen.where("n > 1").orderBy(F.desc("n"), "w").limit(top).collect()]
    pairs = seen.select("n", F.explode(F.expr("transform(sequence(1, length(w) - 1), i -> substr(w, i, 2))")).alias("x")).groupBy("x").agg(F.sum("n").alias("n"))
    return of_counts(often, {r["x"]: r["n"] for r in pairs.collect()})


def findings(docs: DataFrame, text_col: str = "text", path_col: str = "source") -> DataFrame:
    """doc_id, finding, candidate, before, after, path: a row per candidate. Texts without one go by a single match."""
    docs = docs.where(F.col(text_col).rlike(CANDIDATE)).select("doc_id", F.col(text_col).alias("text"), F.coalesce(F.col(path_col), F.lit("")).alias("path"))
    parts = docs.select("doc_id", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("c"), F.split("text", CANDIDATE).alias("p"))
    found = F.transform("c", lambda c, i: F.struct(c.alias("candidate"), F.right(F.get("p", i), F.lit(BEFORE)).alias("before"), F.left(F.get("p", i + 1), F.lit(AFTER)).alias("after")))
    return parts.select("doc_id", "path", F.posexplode(found).alias("finding", "x")).select("doc_id", "finding", "x.candidate", "x.before", "x.after", "path")


def covered(words: Words) -> Column:
    """Characters of ``_pieces`` within a dictionary word, the longest at each place."""
    by: dict[int, list[str]] = {}
    for w in words.dictionary:
        if SHORTEST <= len(w) <= LONGEST:
            by.setdefault(len(w), []).append(f"'{w}'")
    longest = " ".join(f"when substr(p, i, {n}) in ({', '.join(by[n])}) then {n}" for n in sorted(by, reverse=True))
    ends = f"transform(sequence(1, length(p)), i -> named_struct('i', i, 'e', i + case {longest} else 0 end))"
    piece = f"aggregate({ends}, named_struct('r', 0, 'g', 0), (a, x) -> named_struct('r', greatest(a.r, x.e), 'g', a.g + greatest(x.e - greatest(a.r, x.i), 0)), a -> a.g)"
    return F.expr(f"aggregate(transform(_pieces, p -> {piece}), 0, (a, x) -> a + x)")


def unusual(words: Words) -> Column:
    """Sum of -100 log10 p over the transitions within ``_pieces``."""
    code = "transform(sequence(1, length(p)), i -> case when substr(p, i, 1) between 'a' and 'z' then ascii(substr(p, i, 1)) - 96 when substr(p, i, 1) between '0' and '9' then 27 else 0 end)"
    rare = f"element_at(array({', '.join(map(str, words.pairs))}), a.c * 28 + x + 1)"
    piece = f"aggregate({code}, named_struct('c', -1, 's', 0), (a, x) -> named_struct('c', x, 's', a.s + case when a.c < 0 then 0 else {rare} end), a -> a.s)"
    return F.expr(f"aggregate(transform(_pieces, p -> {piece}), 0L, (a, x) -> a + x)")


def with_features(found: DataFrame, words: Words | None = None) -> DataFrame:
    words = words or plain_words()
    c, before, path = F.col("candidate"), F.lower("before"), F.lower(F.coalesce("path", F.lit("")))
    n = F.char_length(c)
    flag = lambda x: x.cast("double")
    spelled = lambda x: F.regexp_extract_all(x, F.lit("[a-z]{2,}+"), F.lit(0))
    ahead = F.slice(F.reverse(spelled(before)), 1, 3)
    behind = F.transform(F.slice(spelled(F.lower("after")), 1, 1), lambda w: F.concat(F.lit(">"), w))
    found = found.withColumns({
        "_pieces": F.regexp_extract_all(F.lower(c), F.lit("(?s).{1,256}"), F.lit(0)),
        "_near": F.transform(F.concat(ahead, behind), lambda w: (F.crc32(w.cast("binary")) % NEAR).cast("int")),
    })
    values = {
        "length": n.cast("double"),
        "digits": F.regexp_count(c, F.lit("[0-9]")) / n,
        "upper": F.regexp_count(c, F.lit("[A-Z]")) / n,
        "hex": flag(c.rlike("^[0-9a-f]+$|^[0-9A-F]+$")),
        "transitions": F.regexp_count(c, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")) / n,
        "unusual": unusual(words) / n,
        "covered": covered(words) / n,
        "slashes": F.regexp_count(c, F.lit("/")).cast("double"),
        "path_test": flag(path.rlike("test|example|sample|doc|fixture|mock|demo|readme")),
        "path_settings": flag(path.rlike(r"env|conf|settings|deploy|secret|\.ya?ml|\.ini|\.properties")),
        "path_depth": F.regexp_count(path, F.lit("/")).cast("double"),
        "assigned": flag(before.rlike(r"[=:]\s*[\"']?$")),
        "quoted": flag(before.rlike("[\"']$") & F.col("after").rlike("^[\"']")),
    } | {f"near_{i}": flag(F.array_contains("_near", i)) for i in range(NEAR)}
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()}).drop("_pieces", "_near")


def made_findings(spark: SparkSession, each: int = 150) -> DataFrame:
    """Labelled findings by kind, ``each`` of them: bounded, and the same on each run."""
    h = lambda salt, n=64: F.substring(F.sha2(F.concat(F.col("id").cast("string"), F.lit(salt)), 256), 1, n)
    b64 = lambda salt, n: F.substring(F.regexp_replace(F.base64(F.unhex(h(salt))), "=", ""), 1, n)
    digits = lambda salt, n: F.lpad(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10**n)).cast("string"), n, "4")
    word = lambda salt: F.element_at(F.array(*map(F.lit, DICTIONARY)), F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(DICTIONARY))).cast("int") + 1)
    pick = lambda salt, *x: F.element_at(F.array(*map(F.lit, x)), F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(x))).cast("int") + 1)
    text = F.concat(word("l1"), F.lit(" "), word("l2"), F.lit(" "))
    asks = lambda *x: F.concat(text, pick("k", *x))
    letters = lambda salt, n: F.translate(h(salt, n), "0123456789abcdef", "qxzkvjwpygbmTRHN")
    folders = {1: ("deploy", "config", "settings", "src", "src", "tests"), 0: ("tests", "docs", "examples", "src", "src", "config")}
    ends = {1: (".env", ".yaml", ".ini", ".py", ".txt", ""), 0: (".md", ".py", ".txt", ".html", ".yaml", "")}
    path = lambda label: F.concat(pick("p1", *folders[label]), F.lit("/"), word("p2"), pick("p3", *ends[label]))
    kinds = [
        (h("a", 40), asks('token = "', "token: ", "access_token = '", 'auth="'), 1),
        (h("b", 32), asks('secret = "', "api_key=", 'apikey: "', "credential = "), 1),
        (b64("c", 40), asks('secret_key = "', "aws secret = ", 'password: "', "Bearer "), 1),
        (F.concat(F.lit("AKIA"), F.upper(h("d", 16))), asks("access key ", 'access_key = "', ""), 1),
        (F.concat(F.lit("ghp_"), b64("e", 36)), asks("", "token ", 'token = "'), 1),
        (F.concat(b64("f", 20), F.lit("7")), asks('password = "', "pwd: ", 'passwd="'), 1),
        (F.concat(letters("f1", 5), pick("f2", "!", ".", "@", "&", "#", "-"), b64("f3", 6)), asks('password = "', "pwd: ", "password:", "secret="), 1),
        (letters("f4", 12), asks('password = "', "token: ", "passwd=", 'secret = "'), 1),
        (b64("f5", 40), asks("", "value ", "set to ", "uses "), 1),
        (digits("g", 16), asks("", "card ", "number ", "with "), 0),
        (digits("h", 16), asks("token ", "", "order ", "key: "), 0),
        (h("i", 40), asks("commit ", "sha1 ", "revision: ", ""), 0),
        (h("j", 32), asks("md5 ", "checksum = ", "etag: ", ""), 0),
        (F.concat_ws("-", h("k", 8), h("l", 4), h("m", 4), h("n", 4), h("o", 12)), asks("uuid ", "id: ", ""), 0),
        (F.concat_ws("-", word("q"), word("r"), word("s"), digits("t", 2)), asks("", "file ", "token "), 0),
        (F.concat_ws("/", word("u"), word("v"), word("w"), digits("x", 4)), asks("href=", "see ", "src = "), 0),
        (F.concat(word("y"), word("z"), word("aa"), word("bb"), digits("cc", 2)), asks("", "the ", "auth "), 0),
        (F.concat_ws("_", word("dd"), word("ee"), digits("ff", 8)), asks("", "key ", "name = "), 0),
        (F.concat_ws("_", word("gg"), word("hh")), asks('password = "', "token: ", "secret=", 'key: "'), 0),
        (F.concat(word("ii"), F.lit("."), word("jj"), pick("kk", "", "()", "[0]")), asks("token = ", "key: ", "password=", "auth = "), 0),
    ]
    rows = None
    for k, (candidate, before, label) in enumerate(kinds):
        one = spark.range(k * each, (k + 1) * each, 1, 1).select(
            candidate.alias("candidate"), before.alias("before"), F.when(before.rlike("[\"']$"), F.regexp_extract(before, "[\"']$", 0)).otherwise(" and").alias("after"), path(label).alias("path"), F.lit(label).alias("label")
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows.where((F.char_length("candidate") >= 16) | ((F.char_length("candidate") >= 6) & F.col("before").rlike("[=:]")))


def fit(labelled: DataFrame, trees: int = 40, depth: int = 10, seed: int = 1, words: Words | None = None) -> RandomForestClassificationModel:
    """A forest on labelled findings; keep them bounded, they are held in memory."""
    ws = Workspace(labelled.sparkSession, "findings")  # written twice, so that features are planned once, not for each kind, and computed once
    rows = ws.save(with_features(ws.save(labelled.coalesce(1), "labelled"), words).select(*FEATURES, "label"), "features")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", F.col("label").cast("double").alias("label"))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=32, subsamplingRate=0.8, featureSubsetStrategy="onethird", seed=seed).fit(rows)


def scan(docs: DataFrame, model: RandomForestClassificationModel, threshold: float = 0.5, words: Words | None = None) -> DataFrame:
    """Every candidate of ``docs`` (doc_id, text, source) with its features, score and verdict."""
    found = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(findings(docs), words))
    score: Column = vector_to_array(F.col("probability"))[1]
    return model.transform(found).withColumn("score", score).withColumn("is_secret", F.col("score") >= threshold).drop("features", "rawPrediction", "probability", "prediction")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidates of all documents; the candidate itself only by digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    words = learn_words(docs, Workspace(spark, "secrets"))
    return scan(docs, fit(made_findings(spark), words=words), words=words).select("doc_id", "finding", F.sha2("candidate", 256).alias("candidate_sha256"), F.col("length").cast("long").alias("length"), "score", "is_secret")
