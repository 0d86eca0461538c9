"""Language-model scores from a log-frequency Bloom filter.

Training texts are counted as words, pairs and triples of words, over all of them. An n-gram seen c times
enters the filter with the levels 1 ... 1 + floor(log_b c); a reader probes level by level until
one is missing and takes the middle of the last level's range as the count. The filter has one
block per bucket of n-gram hashes, of so many bits a level that was counted there: it grows with
the n-grams and errs no more often at any size. Its blocks never meet in one place. Texts are
taken in groups of about a million tokens; a group sends each bucket its distinct n-grams
once, with their counts in training texts; the bucket sums them, fills its block, answers
from it, and the answers meet the group's tokens again.

P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)),  P(w | u) = (c(u w) + a P(w)) / (c(u) + a),
P(w | t u) = (c(t u w) + b P(w | u)) / (c(t u) + b)

with counts from the filter, none above its context's; the score of a text adds log10 P over its
words and one end. The first word follows an end and has no triple. Of the pairs (a, b) in
``WEIGHTS`` that one is taken under which all training texts are likeliest when each token is
left out of the counts it is judged by; so every group scores its texts under each pair, and the
choice is made between columns.

The base score needs exact counts, which lie beside the bucket's block and come with its answer.
So no bucket holds a row per use of a common word, and the driver gathers two totals only.

Defined results: a null text is empty and scores its end token; a null id belongs to training;
rows are scored one by one; without training texts N = V = 0; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.shared import Workspace, estimated_bytes, lean_group, lean_map
from linkloom.llm.tokens import U, mix, word_slices

END = U(0x5851F42D4C957F2D)
LEVEL, PROBE, THIRD = U(0x9FB21C651E98DF25), U(0xD1342543DE82EF95), U(0xA0761D6478BD642F)
#: Tokens of a group of texts that asks together, and n-grams that a bucket looks up together.
GROUP, TOGETHER = 1 << 20, 1 << 19
#: Pseudo-counts (a, b) of the shorter context, for pairs and for triples.
WEIGHTS = [(a, b) for a in (2.0, 12.0, 72.0) for b in (2.0, 12.0, 72.0)]


@dataclass(frozen=True)
class Shape:
    """Buckets (blocks), bits of the filter (None: by what is counted), probes a level, base of the levels, bits a level.

    With 16 bits and 3 probes a level that isn't there passes 0.5 % of the time.
    """

    buckets: int
    bits: int | None = None
    probes: int = 3
    base: float = 1.5
    level_bits: int = 16

    @property
    def block(self) -> int:
        return self.bits // self.buckets // 8 * 8

    def block_for(self, levels: int) -> int:
        """Bits of a block that holds so many levels."""
        return self.block if self.bits else max(64, -(-self.level_bits * levels // 8) * 8)


def with_ends(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with the end token after each document; where each document begins and ends."""
    n = np.diff(at)
    return np.insert(h, at[1:], END), np.concatenate([[0], np.cumsum(n + 1)])


def pairs_of(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; the end comes before the first."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[at[:-1]] = END
    with np.errstate(over="ignore"):
        return mix(before * PROBE + h)


def grams_of(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs, then triples, of all tokens; which tokens have a triple (all but the first of a text)."""
    pairs = pairs_of(h, at)
    inner = np.ones(len(h), bool)
    inner[at[:-1]] = False
    i = np.flatnonzero(inner)
    with np.errstate(over="ignore"):
        return np.concatenate([pairs, mix(pairs[i - 1] * THIRD + h[i])]), i


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> U(32)) * U(buckets)) >> U(32)).astype(np.int32)


def positions(bucket, low: np.ndarray, level: int, shape: Shape, block: int) -> np.ndarray:
    """Bit positions (n x probes) in the bucket's block."""
    with np.errstate(over="ignore"):
        key = mix(((np.asarray(bucket).astype(U) << U(32)) | low.astype(U)) * LEVEL + U(level))
        steps = np.arange(shape.probes, dtype=U) * (mix(key) | U(1))[:, None]
        return ((key[:, None] + steps) % U(block)).astype(np.int64)


def level_of(count: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(count) / np.log(base) + 1e-9).astype(np.int64)


def value_of(level: np.ndarray, base: float) -> np.ndarray:
    """The middle of the whole counts of a level; 0 for level 0."""
    lo, hi = np.ceil(base ** (level - 1.0) - 1e-9), np.ceil(base ** (level * 1.0) - 1e-9) - 1
    return np.where(level > 0, (lo + np.maximum(lo, hi)) / 2, 0.0)


def levels_in(bucket, low: np.ndarray, bits: np.ndarray, shape: Shape, block: int, start=0) -> np.ndarray:
    """Levels by probing one after the other; ``start``: the first bit of the n-grams' blocks."""
    level, left = np.zeros(len(low), np.uint8), np.arange(len(low))
    bucket, start = np.broadcast_to(bucket, len(low)), np.broadcast_to(start, len(low))
    for q in range(1, 256):
        at = positions(bucket[left], low[left], q, shape, block) + start[left][:, None]
        left = left[((bits[at >> 3] >> (at & 7)) & 1).all(axis=1)]
        if not len(left):
            break
        level[left] = q
    return level


def look_up(h: np.ndarray, bits: np.ndarray, shape: Shape) -> np.ndarray:
    """Counts from a filter of equal blocks."""
    bucket = bucket_of(h, shape.buckets)
    return value_of(levels_in(bucket, h & U(0xFFFFFFFF), bits, shape, shape.block, bucket.astype(np.int64) * shape.block), shape.base)


def split(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of runs of a sorted array."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    return [(int(bucket[a]), a, b) for a, b in zip([0, *cuts], [*cuts, len(bucket)], strict=True)] if len(bucket) else []


def pack(x: np.ndarray) -> bytes:
    """Byte planes under zstd, after their size."""
    if not len(x):
        return b""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes, dtype) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype)
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T.copy().view(dtype).ravel()


def groups(batches):
    """Of batches (doc_id, text, held_out): (group, tokens, where each text's begin and end, ids, held out or not)."""
    part, number = TaskContext.get().partitionId(), 0
    parts, tokens = [], 0

    def joined():
        h, n, ids, held = zip(*parts, strict=True)
        return (part << 24) + number, np.concatenate(h), np.concatenate([[0], np.cumsum(np.concatenate(n))]), pa.concat_arrays(ids), pa.concat_arrays(held)

    for batch in batches:
        ids, held = batch.column(0).cast(pa.int64()), batch.column(2)
        for a, b, h, at in word_slices(batch.column(1)):
            h, at = with_ends(h, at)
            parts.append((h, np.diff(at), ids.slice(a, b - a), held.slice(a, b - a)))
            tokens += len(h)
            if tokens > GROUP:
                yield joined()
                parts, tokens, number = [], 0, number + 1
    if parts:
        yield joined()


COUNTS = "bucket int, words binary, word_counts binary, pairs binary, pair_counts binary"
_COUNTS = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("words", "word_counts", "pairs", "pair_counts")]])
ASKED = f"{COUNTS}, batch long"
_ASKED = _COUNTS.append(pa.field("batch", pa.int64()))


def ask_rows(shape: Shape):
    """mapInArrow: by group and bucket the distinct words and longer n-grams ("pairs"), with their counts in training texts (0: asked only)."""

    def rows(batches):
        for batch, h, at, _, held in groups(batches):
            train = np.repeat(~np.array(held.to_pylist(), bool), np.diff(at))
            grams, inner = grams_of(h, at)
            of = {}
            for place, (x, counted) in enumerate(((h, train), (grams, np.concatenate([train, train[inner]])))):
                kind, back = np.unique(x, return_inverse=True)
                n = np.bincount(back[counted], minlength=len(kind)).astype("<u4")
                for b, i, j in split(bucket_of(kind, shape.buckets)):
                    k = kind[i:j].astype("<u8")
                    of.setdefault(b, [b"", b"", b"", b""])[2 * place : 2 * place + 2] = [(k & U(0xFFFFFFFF)).astype("<u4").tobytes(), pack(n[i:j])] if place else [k.tobytes(), n[i:j].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*[(b, *x, batch) for b, x in of.items()]), _ASKED.types, strict=True)], schema=_ASKED)

    return rows


BLOCKS = "bucket int, block binary, words binary, counts binary, tokens long, kinds long"
_BLOCKS = pa.schema([("bucket", pa.int32()), ("block", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()), ("tokens", pa.int64()), ("kinds", pa.int64())])


def total(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def block_of(shape: Shape):
    """applyInArrow by bucket: its block of the filter, and its words with exact counts."""

    def work(table: pa.Table) -> pa.Table:
        b = table["bucket"][0].as_py()
        read = lambda c, t: [np.frombuffer(x, t) for x in table[c].to_pylist()]
        words, counts = total(np.concatenate(read("words", "<u8")), np.concatenate(read("word_counts", "<u4")).astype(np.int64))
        words, counts = words[counts > 0], counts[counts > 0]
        pairs, n = total(np.concatenate(read("pairs", "<u4")), np.concatenate([unpack(x, "<u4") for x in table["pair_counts"].to_pylist()]).astype(np.int64))
        keep = n > 0
        low, n = np.concatenate([(words & U(0xFFFFFFFF)).astype("<u4"), pairs[keep]]), np.concatenate([counts, n[keep]])
        level = level_of(n, shape.base) if len(n) else n
        block = shape.block_for(int(level.sum()))
        bits = np.zeros(block // 8, np.uint8)
        q = 1
        while len(low):
            at = positions(b, low, q, shape, block).ravel()
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
            q += 1
            low, level = low[level >= q], level[level >= q]
        return pa.table([[b], [bits.tobytes()], [words.astype("<u8").tobytes()], [counts.astype("<i8").tobytes()], [int(counts.sum())], [len(words)]], schema=_BLOCKS)

    return work


ANSWERS = "batch long, bucket int, counts binary, levels binary, pair_levels binary, train_tokens long, train_kinds long"
_ANSWERS = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), *[(c, pa.binary()) for c in ("counts", "levels", "pair_levels")], ("train_tokens", pa.int64()), ("train_kinds", pa.int64())])


def answer(shape: Shape):
    """applyInArrow by bucket: exact counts and levels of what groups ask; a row without a batch has the bucket's totals."""
    build = block_of(shape)

    def work(table: pa.Table) -> pa.Table:
        b = table["bucket"][0].as_py()
        [own] = build(table).to_pylist()
        words, counts, bits = np.frombuffer(own["words"], "<u8"), np.frombuffer(own["counts"], "<i8"), np.frombuffer(own["block"], np.uint8)
        out, some, held = [(None, b, None, None, None, own["tokens"], own["kinds"])], [], 0

        def tell() -> None:
            w, p = [np.frombuffer(r["words"], "<u8") for r in some], [np.frombuffer(r["pairs"], "<u4") for r in some]
            cuts, pair_cuts = (np.cumsum([len(x) for x in y])[:-1] for y in (w, p))
            w, p = np.concatenate(w), np.concatenate(p)
            place = np.minimum(np.searchsorted(words, w), max(len(words) - 1, 0))
            c = np.where(words[place] == w, counts[place], 0) if len(words) else np.zeros(len(w), np.int64)
            level = levels_in(b, w & U(0xFFFFFFFF), bits, shape, len(bits) * 8)
            pair_level = levels_in(b, p, bits, shape, len(bits) * 8)
            for r, x, y, z in zip(some, np.split(c, cuts), np.split(level, cuts), np.split(pair_level, pair_cuts), strict=True):
                out.append((r["batch"], b, pack(x), pack(y), pack(z), None, None))

        for r in table.select(["batch", "words", "pairs"]).to_pylist():
            some.append(r)
            held += len(r["words"]) // 8 + len(r["pairs"]) // 4
            if held > TOGETHER:
                tell()
                some, held = [], 0
        if some:
            tell()
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), _ANSWERS.types, strict=True)], schema=_ANSWERS)

    return work


TEXTS = "batch long, bucket int, words binary, tokens binary, ends binary, ids array<long>, held array<boolean>"
_TEXTS = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), *[(c, pa.binary()) for c in ("words", "tokens", "ends")], ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))])


def text_rows(batches):
    """mapInArrow: a row per group of texts, the same groups as in ``ask_rows``."""
    for batch, h, at, ids, held in groups(batches):
        kind, back = np.unique(h, return_inverse=True)
        row = (batch, None, kind.astype("<u8").tobytes(), pack(back.astype("<u4")), pack(at.astype("<i8")), ids.to_pylist(), held.to_pylist())
        yield pa.RecordBatch.from_pylist([dict(zip(_TEXTS.names, row, strict=True))], schema=_TEXTS)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, scores array<double>, left_out array<double>"
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *[(c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")], ("base_score", pa.float64()), ("scores", pa.list_(pa.float64())), ("left_out", pa.list_(pa.float64()))])


def log_likelihoods(contexts: list[tuple[np.ndarray, np.ndarray]], norm: float, less: int):
    """log10 P of each token under each of ``WEIGHTS``; ``contexts``: counts of the n-gram and of its context, for pairs and triples, after the word's.

    ``less``: 1 leaves the token itself out of all counts.
    """
    counts = [(np.maximum(np.minimum(n, of) - less, 0), np.maximum(of - less, 0)) for n, of in contexts]
    one = (counts[0][0] + 0.5) / (norm - less)
    seen: dict[float, np.ndarray] = {}
    for a, b in WEIGHTS:
        if a not in seen:
            seen = {a: (counts[1][0] + a * one) / (counts[1][1] + a)}
        yield np.log10((counts[2][0] + b * seen[a]) / (counts[2][1] + b))


def score_groups(shape: Shape, tokens: int, kinds: int):
    """applyInArrow by batch: scores of a group's texts under each of ``WEIGHTS``, from its tokens and the buckets' answers; a last row has the sums that decide between them."""

    def work(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        [texts] = [r for r in rows if r["bucket"] is None]
        told = sorted((r for r in rows if r["bucket"] is not None), key=lambda r: r["bucket"])  # the order of the hashes
        count, level, gram_level = (np.concatenate([unpack(r[c], t) for r in told]) for c, t in (("counts", "<i8"), ("levels", np.uint8), ("pair_levels", np.uint8)))
        kind, at = np.frombuffer(texts["words"], "<u8"), unpack(texts["ends"], "<i8")
        back = unpack(texts["tokens"], "<u4")
        grams, inner = grams_of(kind[back], at)
        gram, gram_back = np.unique(grams, return_inverse=True)
        if len(count) != len(kind) or len(gram_level) != len(gram):
            raise RuntimeError("the input was read in other groups than before")
        summed = lambda x: np.add.reduceat(x, at[:-1])  # noqa: E731 - every text has its end token
        norm, n = tokens + 0.5 * (kinds + 1), np.diff(at)
        c = value_of(level.astype(np.int64), shape.base)
        longer = value_of(gram_level.astype(np.int64), shape.base)[gram_back]
        here, pair = c[back], longer[: len(back)]
        before, triple, of_triple = np.empty_like(here), np.zeros_like(here), np.zeros_like(here)
        before[1:] = here[:-1]
        before[at[:-1]] = c[np.searchsorted(kind, END)]
        triple[inner], of_triple[inner] = longer[len(back) :], pair[inner - 1]
        counts = [(here, here), (pair, before), (triple, of_triple)]
        scores = np.stack([summed(x) for x in log_likelihoods(counts, norm, 0)], axis=1)
        train = np.repeat(~np.array(texts["held"], bool), n)
        left_out = [float(x.sum()) for x in log_likelihoods([(x[train], y[train]) for x, y in counts], norm, 1)] if train.any() else None
        base = summed(np.log10((count + 0.5) / norm)[back])
        columns = (texts["ids"], texts["held"], n, summed((count > 0).astype(np.int64)[back]), np.full(len(n), tokens), base, list(scores), [None] * len(n))
        sums = pa.table([pa.array([x], t) for x, t in zip((*[None] * 7, left_out), _SCORED.types, strict=True)], schema=_SCORED)
        return pa.concat_tables([pa.table([pa.array(x, t) for x, t in zip(columns, _SCORED.types, strict=True)], schema=_SCORED), sums])

    return work


def score_texts(docs: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ws = Workspace(spark, "lm")
    shape = Shape(int(min(max(estimated_bytes(docs) // (4 << 20), 12), 1 << 16)))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))

    asked = docs.mapInArrow(lean_map(ask_rows(shape)), ASKED)
    answers = ws.save(asked.groupBy("bucket").applyInArrow(lean_group(answer(shape)), ANSWERS), "answers")
    tokens, kinds = (x or 0 for x in answers.agg(F.sum("train_tokens"), F.sum("train_kinds")).first())
    texts = docs.mapInArrow(lean_map(text_rows), TEXTS)
    answers = answers.where("batch is not null").drop("train_tokens", "train_kinds")
    both = texts.unionByName(answers, allowMissingColumns=True)
    scored = ws.save(both.groupBy("batch").applyInArrow(lean_group(score_groups(shape, tokens, kinds)), SCORED), "scored")
    ws.drop("answers")
    sums = scored.agg(*[F.sum(F.col("left_out")[i]) for i in range(len(WEIGHTS))]).first()
    best = max(range(len(WEIGHTS)), key=lambda i: sums[i] if sums[i] is not None else -i)  # without training texts the first
    return scored.where("n_tokens is not null").select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", F.col("scores")[best].alias("score"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those whose crc32 of the id isn't 1 modulo 5."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
