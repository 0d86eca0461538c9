"""Best-fit packing of token sequences in bulk-synchronous supersteps.

Documents (pieces) and gaps are held by class: a row per length and range of ranks, a row per gap
size and range of sequences. Lengths are whole numbers up to the capacity, so that these tables
stay small whatever the size of the corpus. Sizes are cut in ``parts`` ranges. A superstep:

1. From the greatest gap of each range the next gap is carried downwards, and each open class of
   documents goes to the range that holds its successor, the least gap not smaller than it.
   Documents that no open gap can hold go to a range of new sequences, as many as those documents
   need at the least by their tokens, or by how many are longer than half a sequence.
2. Each range, a task of its own, sweeps its documents and gaps in order of size. Documents that
   want the same gap go by rank, the longest first; a gap takes what fits of a class at once. What
   is left of a gap stays in the sweep if it is of this range.
3. Rules (which ranks of a length lie where), gaps as they are now and documents still open are
   written; the next superstep reads them. Supersteps end when no document is open.

A document that waits never loses a gap to a shorter one: shorter documents go to gaps that
couldn't hold it, or stand behind it in the same sweep. Ranks inside a length, their offsets
between partitions and the placing of every piece are distributed; only totals of ranges (two
rows a range) reach the driver.

Defined results: a null text is empty, one end token long; equal and repeated rows are packed
one by one; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.prefix import before_each
from linkloom.llm.shared import Workspace, lean_map

END = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
#: Here the fast library splits text as the named one does (see the tests); other texts go to the named one.
PLAIN = re.compile("[\x00-ɏ]*")
#: Rules that a join may broadcast (48 bytes each).
MOST_RULES = 1 << 18


@lru_cache(maxsize=2)
def encoder(path: str | None):
    """Text to ids (numpy), as the ``tokenizers`` library gives them.

    ``path``: a tokenizers file; None takes the public byte-level one, whose vocabulary a faster
    library shares. Texts that it might split otherwise, that hold a special token, or that it
    gives up on (a run of a million blanks, say) go to ``tokenizers``, loaded when first needed.
    """
    import public_tokenizers

    file = path or public_tokenizers.path("byte_bpe_50k.json")

    @lru_cache(maxsize=1)
    def named():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(file)

    slow = lambda text: np.array(named().encode(text, add_special_tokens=False).ids, dtype="<u4")
    if path is not None:
        return slow
    import base64

    import tiktoken

    with open(file, encoding="utf-8") as f:
        special = [x["content"] for x in json.load(f).get("added_tokens", [])]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and not any(x in text for x in special):
            try:
                return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
            except ValueError:  # its pattern needed too deep a stack
                pass
        return slow(text)

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first of a long document is shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * (first > 0) + [(at, capacity) for at in range(first, n, capacity)]


def piece_rows(path: str | None, capacity: int):
    """mapInArrow: (doc_id, text) to pieces; ``rank`` counts the task's pieces of the same length."""

    def rows(batches):
        encode, seen, part = encoder(path), defaultdict(int), TaskContext.get().partitionId()
        names = [x.split()[0] for x in PIECES.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                ids = np.append(encode(batch.column(1)[i].as_py() or ""), np.uint32(END)).astype("<u4")
                for k, (at, n) in enumerate(cut(len(ids), capacity)):
                    out.append((batch.column(0)[i].as_py(), k, at, n, zlib.crc32(ids[at : at + n].tobytes()), part, seen[n]))
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types, strict=True)], names=names)

    return lean_map(rows)


# --- supersteps over classes ------------------------------------------------------------

DOC, GAP, RULE, OPENED = 0, 1, 2, 3
#: DOC: ``n`` documents of length ``size`` from rank ``at``. GAP: ``n`` sequences from ``at`` with
#: ``size`` left. RULE: the documents of length ``size`` and ranks ``at`` to ``at + n - 1`` lie from
#: sequence ``bin`` on, ``per_bin`` in each, from place ``base``. OPENED: ``n`` new sequences.
STATE = "kind int, size long, at long, n long, bin long, per_bin long, base long"
_STATE = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("size", "at", "n", "bin", "per_bin", "base")]])


def part_of(capacity: int, parts: int):
    """The range of a size, 0 to parts - 1, as a column."""
    return F.expr(f"cast((size - 1) * {parts} div {capacity} as int)")


def fit(docs: dict[int, tuple[int, int]], held: dict[int, list[tuple[int, int]]], capacity: int, least: int) -> list[tuple]:
    """Sweeps one range: rows of STATE for rules, documents still open and gaps.

    ``docs``: (first rank, how many) by length; ``held``: ranges (first sequence, how many) by gap.
    Gaps of ``least`` and more that arise take part.
    """
    gaps, out = sorted(held), []

    def leave(gap: int, at: int, n: int) -> None:
        if gap >= max(least, 1) and n > 0:
            if gap not in held:
                insort(gaps, gap)
                held[gap] = []
            held[gap].append((at, n))
        elif gap > 0 and n > 0:
            out.append((GAP, gap, at, n, None, None, None))

    for length in sorted(docs, reverse=True):
        rank, left = docs[length]
        while left > 0:
            k = bisect_left(gaps, length)
            if k == len(gaps):
                out.append((DOC, length, rank, left, None, None, None))
                break
            gap = gaps[k]
            at, n = held[gap].pop()
            if not held[gap]:
                del held[gap], gaps[k]
            per = gap // length
            full = min(n, left // per)
            rest = left % per if full < n and left // per == full else 0
            if full:
                out.append((RULE, length, rank, full * per, at, per, capacity - gap))
                leave(gap - per * length, at, full)
            if rest:
                out.append((RULE, length, rank + full * per, rest, at + full, rest, capacity - gap))
                leave(gap - rest * length, at + full, 1)
            leave(gap, at + full + (rest > 0), n - full - (rest > 0))
            rank += full * per + rest
            left -= full * per + rest
    return out + [(GAP, gap, at, n, None, None, None) for gap in gaps for at, n in held[gap]]


def sweep(capacity: int, parts: int, opened: int):
    """applyInArrow by range: ``fit`` on its rows; the range ``parts`` opens sequences, numbered from ``opened``."""

    def work(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        docs, held, out = {}, {}, []
        for kind, size, at, n in zip(*(table[c].to_pylist() for c in ("kind", "size", "at", "n")), strict=True):
            if kind == DOC:
                docs[size] = at, n
            else:
                held.setdefault(size, []).append((at, n))
        for ranges in held.values():
            ranges.sort()  # a lost task's second run says the same
        least = part * capacity // parts + 1
        if part == parts:
            least = (parts - 1) * capacity // parts + 1
            new = max(-(-sum(x * n for x, (_, n) in docs.items()) // capacity), sum(n for x, (_, n) in docs.items() if 2 * x > capacity))
            held[capacity] = [(opened, new)]
            out.append((OPENED, capacity, opened, new, None, None, None))
        out += fit(docs, held, capacity, least)
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), _STATE.types, strict=True)], schema=_STATE)

    return work


def targets(tops: dict[int, int], capacity: int, parts: int):
    """The range in which a class of documents finds its successor, as a column; ``tops``: the greatest gap of each range that has any."""
    own = part_of(capacity, parts)
    out = F.lit(parts)
    for q in sorted(tops, reverse=True):  # at most ``parts`` branches: the least range that is above, or whose top holds it
        out = F.when((own < q) | ((own == q) & (F.col("size") <= tops[q])), F.lit(q)).otherwise(out)
    return F.when(F.col("kind") == GAP, own).otherwise(out)


def match(counts: DataFrame, capacity: int, parts: int, ws: Workspace) -> DataFrame:
    """Rules (rows of STATE) that place all of ``counts`` (length, n)."""
    spark, nothing = ws.spark, [F.lit(None).cast("long").alias(c) for c in ("bin", "per_bin", "base")]
    state = ws.save(counts.select(F.lit(DOC).alias("kind"), F.col("length").alias("size"), F.lit(0).cast("long").alias("at"), F.col("n").cast("long").alias("n"), *nothing), "step_0")
    part, opened, paths = part_of(capacity, parts), 0, []
    for step in itertools.count(1):
        # two rows a range at most
        totals = state.where(f"kind <> {RULE}").groupBy("kind", part.alias("part")).agg(F.max("size").alias("top"), F.sum("n").alias("n")).collect()
        opened += sum(r["n"] for r in totals if r["kind"] == OPENED)
        if not any(r["kind"] == DOC for r in totals):
            break
        tops = {r["part"]: r["top"] for r in totals if r["kind"] == GAP}
        open_ = state.where(f"kind in ({DOC}, {GAP})").select("kind", "size", "at", "n").withColumn("part", targets(tops, capacity, parts))
        state = ws.save(open_.groupBy("part").applyInArrow(sweep(capacity, parts, opened), STATE), f"step_{step}")
        paths.append(ws.path(f"step_{step}"))
    if not paths:
        return state
    return spark.read.schema(state.schema).parquet(*paths).where(f"kind = {RULE}")


def pack(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, parts: int = 4) -> DataFrame:
    """A row per piece of ``docs`` (doc_id, text), with its sequence and its place there; ``parts``: ranges of sizes that are swept side by side."""
    ws = Workspace(docs.sparkSession, "packing")
    pieces = ws.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(piece_rows(tokenizer, capacity), PIECES), "pieces")
    by_part = ws.save(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "by_part")
    rules = ws.save(match(by_part.groupBy("length").agg(F.sum("n").alias("n")), capacity, parts, ws), "rules")
    rules = rules.select(F.col("size").alias("length"), F.col("at").alias("first"), (F.col("at") + F.col("n") - 1).alias("last"), "bin", "per_bin", "base")
    if rules.count() <= MOST_RULES:
        rules = F.broadcast(rules)
    ranked = pieces.join(before_each(by_part, "part", ["length"], ["n"]), ["part", "length"]).withColumn("r", F.col("n_before") + F.col("rank"))
    placed = ranked.join(rules, "length").where("r between first and last")
    at = F.col("r") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("bin") + F.floor(at / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("base") + at % F.col("per_bin") * F.col("length")).cast("long").alias("offset"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
