"""N-gram Jaccard join by partitioning the universe of shingles, exact at any threshold above 1/2.

A document's set holds its distinct k-word shingles. Two sets with similarity t or more differ
in at most H = (1 - t) / t * (size of the smaller) shingles. Sets are dealt to size bands; in
the scheme of a band the universe of shingle hashes is cut into m segments, each with an
allocation of 1 (the segment's subset is indexed) or 2 (so are the subsets that lack one
shingle). As the allocations add up to more than H, a similar pair meets in one index entry at
least. A set is indexed in the scheme of its own band and of the band below, which covers all
sizes that it can be similar to. Which allocation a band uses is chosen by cost (index rows,
and collisions that would have to be verified) measured on a sample; any choice is exact.

Empty segments are worth nothing; schemes have slack for them, and a set with too many indexes
its empty segments too. Index entries travel as packed arrays by bucket of the entry's hash, so
the join is a sort in numpy. Entries shared by few sets yield all their pairs; an entry shared
by many yields pairs with one centre first, and only where its sets don't fall into one
component then, the pairs across components. An entry of more than BLOCK sets is refined before
that: its sets are indexed anew by the rarest of their shingles, as many as two similar sets
can't both lack, so that a passage common to thousands of unlike documents pairs none of them.
Pairs are verified on the whole sets.

Sets are nodes by a 64-bit hash, so copies are one node whatever their number. A second digest
tells whether two sets share a node; then all is done again under another key. Shingles are
64-bit hashes too: two in one pair of texts are taken for equal once in 2^64, whatever the texts.

Defined results: a text without words, or null, has no shingle and is linked with nothing; a
text of fewer than k words has one; rows with a null id belong to the component of their set,
whose smallest id is taken over the other rows; rows that repeat an id are judged by their own
text; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.shared import BITMAP_BITS, Workspace, bitmap, estimated_bytes, flat, lean_group, lean_map, maybe_in
from linkloom.llm.tokens import U, mix, word_slices

MULT = U(0xD6E8FEB86659FD93)
SEG, BAND, OWN = U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB), U(0x8EBC6AF09C88C6E3)
CHECK = U(0x2545F4914F6CDD1D)
LARGEST = 1 << 31
#: An index entry shared by more sets than this yields pairs with its centre first.
FEW = 8
#: Bytes of input for each bucket of the index.
BUCKET_BYTES = 8 << 20


@dataclass(frozen=True)
class Scheme:
    """By band: greatest size, H, number of segments, how many of those (the first) have allocation 2."""

    upper: np.ndarray
    most: np.ndarray
    segments: np.ndarray
    doubled: np.ndarray

    @classmethod
    def of(cls, num: int, den: int, doubled: dict[int, bool] | bool = False) -> Scheme:
        """For similarity num / den; ``doubled``: the bands that use one-deletion neighbourhoods."""
        upper = [1]
        while upper[-1] < LARGEST:
            upper.append(max(upper[-1] + 1, upper[-1] * den // num))
        most = [(den - num) * x // num for x in upper]
        segments, twice = [], []
        for b, h in enumerate(most):
            if doubled is True or (doubled and doubled.get(b)):
                m = (h + 2) // 2 + (h + 15) // 16
                segments.append(m)
                twice.append(m)
            else:
                segments.append(h + 1 + (h + 9) // 10)
                twice.append(0)
        return cls(*[np.array(x, np.int64) for x in (upper, most, segments, twice)])


def sets_of(texts: pa.Array, k: int, key: int = 0):
    """For slices of rows: (first row, shingle hashes sorted and distinct, where each row's begin, node and check digest of each row)."""
    for a, b, h, at in word_slices(texts, key):
        n = np.diff(at)
        with np.errstate(over="ignore"):
            if len(h) >= k:
                s = h[: len(h) - k + 1].copy()
                for i in range(1, k):
                    s = s * MULT + h[i : len(h) - k + 1 + i]
                doc = np.repeat(np.arange(len(n)), n)[: len(s)]
                s = mix(s)[np.arange(len(s)) + k <= at[1:][doc]]
            else:
                s = np.zeros(0, U)
            count = np.maximum(n - k + 1, 0)
            short = np.flatnonzero((n > 0) & (n < k))
            if len(short):
                own = []
                for d in short:
                    x = U(int(n[d]))
                    for w in h[at[d] : at[d + 1]]:
                        x = x * MULT + w
                    own.append(x)
                s = np.insert(s, np.cumsum(count)[short], mix(np.array(own, U) ^ OWN))  # it has no other shingle
                count[short] = 1
        ends = np.cumsum(count)
        first = np.ones(len(s), bool)
        for lo, hi in zip(ends - count, ends, strict=True):
            s[lo:hi].sort()
        first[1:] = s[1:] != s[:-1]
        first[(ends - count)[count > 0]] = True
        total = np.concatenate([[0], np.cumsum(first)])
        at = total[np.concatenate([[0], ends])]
        s = s[first]
        with np.errstate(over="ignore"):
            node, check = (
                mix((sums[at[1:]] - sums[at[:-1]]) + np.diff(at).astype(U) * BAND) for sums in (np.concatenate([np.zeros(1, U), np.cumsum(mix(s ^ by))]) for by in (SEG, CHECK))
            )
        yield a, s, at, node, check


def entries(s: np.ndarray, at: np.ndarray, scheme: Scheme):
    """Index entries of the sets: (hash, row) arrays, one pair for each of the two schemes a set is in."""
    n = np.diff(at)
    band = np.searchsorted(scheme.upper, n)
    for lower in (0, 1):
        use = band - lower
        use = np.where((n > 0) & (use >= 0) & (scheme.most[np.maximum(use, 0)] > 0), use, -1)
        rows = np.flatnonzero(use >= 0)
        if not len(rows):
            continue
        of = np.repeat(np.arange(len(n)), n)
        keep = use[of] >= 0
        x, of = s[keep], of[keep]
        b = use[of]
        m = scheme.segments[b].astype(U)
        seg = ((x >> U(32)) * m) >> U(32)
        new = np.ones(len(x), bool)
        new[1:] = (seg[1:] != seg[:-1]) | (of[1:] != of[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(x)))
        with np.errstate(over="ignore"):
            value = mix(x ^ OWN)
            sums = np.add.reduceat(value, start)
            base = seg * SEG + (b.astype(U) + U(1)) * BAND
            yield mix(sums + base[start]), of[start]
            twice = (seg < scheme.doubled[b].astype(U)) & (np.repeat(size, size) > 1)
            if twice.any():
                group = np.repeat(np.arange(len(start)), size)
                yield mix(sums[group[twice]] - value[twice] + base[twice]), of[twice]
        # sets whose full segments aren't worth more than H index the empty ones as well
        worth = np.bincount(of[start], 1 + ((seg[start] < scheme.doubled[b[start]].astype(U)) & (size > 1)), minlength=len(n))
        for d in rows[worth[rows] <= scheme.most[use[rows]]]:
            mine = start[of[start] == d]
            full = set(seg[mine].tolist())
            blank = np.array([i for i in range(scheme.segments[use[d]]) if i not in full], U)
            single = seg[mine[(size[of[start] == d] == 1) & (seg[mine] < U(scheme.doubled[use[d]]))]]
            with np.errstate(over="ignore"):
                found = mix(np.concatenate([blank, single]) * SEG + U(use[d] + 1) * BAND)
            yield found, np.full(len(found), d)


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the shingles by residue, 2 to 4 bits a shingle."""
    bits = 1 << max(6, int(2 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & U(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little")


def fold(x: np.ndarray, size: int) -> np.ndarray:
    """The sketch that fewer residues (8 * size bits) would have given."""
    while x.shape[-1] > size:
        half = x.shape[-1] // 2
        x = x[..., :half] ^ x[..., half:]
    return x


ROWS = "kind int, doc_id long, n_shingles long, node long, check long, sketch binary, bucket int, sigs binary, nodes binary, counts binary"
_ROWS = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("check", pa.int64()), ("sketch", pa.binary()), ("bucket", pa.int32()), ("sigs", pa.binary()), ("nodes", pa.binary()), ("counts", pa.binary())])


def index_rows(k: int, scheme: Scheme, buckets: int, key: int = 0):
    """mapInArrow over (doc_id, text): a row of kind 0 per document, rows of kind 1 with packed entries."""

    def packed(sig: np.ndarray, node: np.ndarray):
        bucket = ((sig >> U(32)) * U(buckets)) >> U(32)
        order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int32), kind="stable")
        sig, node, bucket = sig[order], node[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        out = []
        for lo, hi in zip([0, *cuts], [*cuts, len(sig)], strict=True):
            part = node[lo:hi]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            runs = np.diff(np.append(first, hi - lo))
            out.append((1, None, None, None, None, None, int(bucket[lo]), sig[lo:hi].astype("<u4").tobytes(), part[first].astype("<u8").tobytes(), runs.astype("<u4").tobytes()))
        return out

    def rows(batches):
        for batch in batches:
            ids = batch.column(0)
            sigs, nodes, seen = [], [], set()
            docs = []
            for a, s, at, node, check in sets_of(batch.column(1), k, key):
                n = np.diff(at)
                docs.append((n, node.view(np.int64), check.view(np.int64), [sketch(s[x:y]).tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]))
                fresh = np.array([not (x in seen or seen.add(x)) for x in node.tolist()], bool)  # copies are one node
                if not fresh.all():
                    s = s[np.repeat(fresh, n)]
                    at, node = np.concatenate([[0], np.cumsum(n[fresh])]), node[fresh]
                found = [*entries(s, at, scheme)]
                if found:
                    sig, row = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
                    order = np.argsort(row, kind="stable")
                    sigs.append(sig[order])
                    nodes.append(node[row[order]])
                if sum(map(len, sigs)) > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*packed(np.concatenate(sigs), np.concatenate(nodes))), _ROWS.types, strict=True)], schema=_ROWS)
                    sigs, nodes = [], []
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*packed(np.concatenate(sigs), np.concatenate(nodes))), _ROWS.types, strict=True)], schema=_ROWS)
            if docs:
                n, node, check = (np.concatenate([x[i] for x in docs]) for i in (0, 1, 2))
                sketches = pa.array([y for x in docs for y in x[3]], pa.binary())
                nothing = [pa.nulls(len(n), t) for t in _ROWS.types[6:]]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), ids.cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(node), pa.array(check), sketches, *nothing], schema=_ROWS)

    return rows


FOUND = "kind int, a long, b long"
_FOUND = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])


def meet(table: pa.Table) -> pa.Table:
    """Pairs (kind 0) of nodes that share an entry of a bucket; rows (entry, node) of crowded entries (kind 1)."""
    sig = flat(table["sigs"], "<u4")
    node = np.repeat(flat(table["nodes"], "<i8"), flat(table["counts"], "<u4"))  # the rows' own order holds for all three
    order = np.argsort(sig, kind="stable").astype(np.uint32 if len(sig) < 1 << 32 else np.int64)
    same = sig[order[1:]] == sig[order[:-1]]
    shared = np.zeros(len(sig), bool)
    shared[1:] |= same
    shared[:-1] |= same
    order = order[shared]  # most entries are of one set
    sig, node = sig[order], node[order]
    del order, same, shared
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    fresh = np.ones(len(sig), bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node = sig[fresh], node[fresh]
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(sig)))
    start, size = np.repeat(first, size), np.repeat(size, size)
    pairs = []
    few = size <= FEW
    for d in range(1, FEW):
        if len(sig) > d:
            i = np.flatnonzero(few[:-d] & (start[:-d] == start[d:]))
            pairs.append(np.stack([node[i], node[i + d]], 1))
    many = np.flatnonzero(~few & (np.arange(len(sig)) != start))
    pairs.append(np.stack([node[start[many]], node[many]], 1))
    pairs = np.unique(np.concatenate(pairs), axis=0)
    crowd = np.flatnonzero(~few)
    entry = (np.int64(table["bucket"][0].as_py()) << 32) | sig[crowd].astype(np.int64)
    return pa.table([np.concatenate([np.zeros(len(pairs), np.int32), np.ones(len(crowd), np.int32)]), np.concatenate([pairs[:, 0], entry]), np.concatenate([pairs[:, 1], node[crowd]])], schema=_FOUND)


def wanted_sets(k: int, bits: np.ndarray, key: int = 0):
    """mapInArrow over text: (node, shingles) of the nodes that the bitmap may hold."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def rows(batches):
        for batch in batches:
            seen = set()
            for _, s, at, node, _check in sets_of(batch.column(0), k, key):
                place = (node >> U(38)).astype(np.int64)
                take = [d for d in np.flatnonzero((bits[place >> 3] >> (place & 7)) & 1) if not (node[d] in seen or seen.add(node[d]))]
                if take:
                    offsets = np.concatenate([[0], np.cumsum(np.diff(at)[take])]).astype(np.int32)
                    flat = np.concatenate([s[at[d] : at[d + 1]] for d in take]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(node[take].view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], schema=schema)

    return rows


def node_bitmap(nodes: DataFrame) -> np.ndarray:
    """2**26 bits (8 MB) by the leading bits of the node: a bounded filter, whatever the number of nodes."""
    at = F.shiftrightunsigned("node", 38)
    found = nodes.select(at.alias("at")).groupBy(F.shiftright("at", 15).cast("int").alias("slot")).agg(F.expr(f"bitmap_construct_agg(at % {BITMAP_BITS})").alias("b"))
    bits = np.zeros(1 << 23, np.uint8)
    for r in found.toLocalIterator():
        bits[r["slot"] * 4096 : (r["slot"] + 1) * 4096] = np.frombuffer(r["b"], np.uint8)
    return bits


def near(num: int, den: int):
    """mapInArrow over (a, b, n, m, x, y): the pairs whose sketches don't rule them out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def rows(batches):
        for batch in batches:
            a, b, n, m, xs, ys = (batch.column(i) for i in range(6))
            most = (n.to_numpy() + m.to_numpy()) * (den - num) // (den + num)
            keep = np.zeros(len(most), bool)
            for i in range(len(most)):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint8) for c in (xs, ys))
                size = min(len(x), len(y))
                keep[i] = np.bitwise_count(fold(x, size) ^ fold(y, size)).sum() <= most[i]
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep)), b.filter(pa.array(keep))], schema=schema)

    return rows


def sieve(pairs: DataFrame, sets: DataFrame, num: int, den: int, ws: Workspace, name: str) -> DataFrame:
    """Pairs (a, b) less those that sizes or sketches rule out."""
    sides = [sets.select(F.col("node").alias(c), F.col("n_shingles").alias(n), F.col("sketch").alias(x)) for c, n, x in (("a", "n", "x"), ("b", "m", "y"))]
    both = pairs.join(sides[0], "a").join(sides[1], "b").where(den * F.least("n", "m") >= num * F.greatest("n", "m"))
    return ws.save(both.select("a", "b", "n", "m", "x", "y").mapInArrow(lean_map(near(num, den)), "a long, b long"), name)


def whole_sets(docs: DataFrame, nodes: DataFrame, k: int, key: int, ws: Workspace, name: str) -> DataFrame:
    """(node, s): the whole sets of ``nodes``, and of some others that their bitmap can't tell apart."""
    bits = docs.sparkSession.sparkContext.broadcast(node_bitmap(nodes))
    sets = docs.select("text").mapInArrow(lean_map(wanted_sets(k, _Late(bits), key)), "node long, shingles array<long>")
    sets = ws.save(sets.groupBy("node").agg(F.first("shingles").alias("s")), f"{name}_sets")
    bits.unpersist()
    return sets


def verify(docs: DataFrame, pairs: DataFrame, k: int, num: int, den: int, key: int, ws: Workspace, name: str) -> DataFrame:
    """Of the pairs (a, b) of nodes those whose whole sets are similar."""
    sets = whole_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), k, key, ws, name)
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
    joined = joined.select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).cast("long").alias("both"))
    linked = ws.save(joined.where(den * F.col("both") >= num * (F.col("n") + F.col("m") - F.col("both"))).select("a", "b"), name)
    ws.drop(f"{name}_sets")
    return linked


class _Late:
    """A broadcast array that is fetched where it is read."""

    def __init__(self, held):
        self.held = held

    def __getitem__(self, at):
        return self.held.value[at]


def components(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """(node, comp): comp is the least node that edges (a, b) reach.

    A round gives each node, and the node that was its label, the least label among its
    neighbours, then jumps a pointer. Rounds end when nothing moves, however many that takes:
    every round but the last lowers a label, and hooking labels keeps them about logarithmic in
    the longest chain.
    """
    both = ws.save(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}_both")
    label = ws.save(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), f"{name}_0")
    for step in itertools.count(1):
        near = both.join(label.select(F.col("node").alias("b"), F.col("comp").alias("other")), "b").groupBy("a").agg(F.min("other").alias("other"))
        low = label.join(near.withColumnRenamed("a", "node"), "node").select("node", "comp", F.least("comp", "other").alias("low"))
        hook = low.where("low < comp").select(F.col("comp").alias("node"), F.lit(None).cast("long").alias("comp"), "low")
        low = low.unionByName(hook).groupBy("node").agg(F.max("comp").alias("comp"), F.min("low").alias("low"))
        jump = label.select(F.col("node").alias("low"), F.col("comp").alias("far"))
        moved = low.join(jump, "low", "left").select("node", F.col("comp").alias("was"), F.least("low", F.coalesce("far", "low")).alias("comp"))
        moved = ws.save(moved, f"{name}_{step}")
        done = moved.where("was <> comp").isEmpty()
        ws.drop(f"{name}_{step - 1}")
        label = moved.drop("was")
        if done:
            break
    ws.drop(f"{name}_both")
    return label


#: Sets of a crowded entry that one task compares with as many others.
BLOCK = 1024
#: Least crowded entries of a set that its rows name, to tell a pair from its repetitions.
NAMED = 32


#: Partners of a set that its first comparison with a block tells, and by how much each next one raises that.
PARTNERS, MORE = 3, 64


def compare(num: int, den: int, partners: int):
    """applyInArrow by entry and pair of blocks: pairs across components that sketches don't rule out.

    Of each set's partners the likeliest ``partners`` are told; ``more`` where there are others.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("more", pa.bool_())])

    def work(table: pa.Table) -> pa.Table:
        node, comp, n, block = (table[c].to_numpy() for c in ("node", "comp", "n_shingles", "block"))
        raw = [np.frombuffer(x, np.uint8) for x in table["sketch"].to_pylist()]
        entry, named = table["entry"][0].as_py(), [*map(frozenset, table["named"].to_pylist())]
        size = min(map(len, raw))
        words = np.stack([fold(x, size) for x in raw]).view(U)
        left = np.flatnonzero(block == block.min())
        right = np.flatnonzero(block == block.max())
        out = []
        for i in left:
            j = right[(comp[right] != comp[i]) & ((node[right] > node[i]) | (block[right] != block[i]))]
            j = j[den * np.minimum(n[j], n[i]) >= num * np.maximum(n[j], n[i])]
            if len(j):
                differ = np.bitwise_count(words[j] ^ words[i]).sum(1, dtype=np.int64)
                near = differ <= (n[j] + n[i]) * (den - num) // (den + num)
                j, differ = j[near], differ[near]
                # a pair that meets in a lesser entry is told there
                here = np.array([min(named[i] & named[x], default=entry) >= entry for x in j], bool)
                j, differ = j[here], differ[here]
                more = len(j) > partners
                if more:
                    j = j[np.lexsort((node[j], differ))[:partners]]
                out.append(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), np.full(len(j), more)], 1))
        pairs = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        return pa.table([pairs[:, 0], pairs[:, 1], pairs[:, 2].astype(bool)], schema=schema)

    return work


def open_entries(crowd: DataFrame, label: DataFrame) -> DataFrame:
    """``crowd`` (entry, node) with the nodes' components and the entry's size ``k``, where there are two components or more."""
    crowd = crowd.join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    found = crowd.groupBy("entry").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("k")).where("lo <> hi").select("entry", "k")
    return crowd.join(found, "entry")


def rarest(docs: DataFrame, nodes: DataFrame, k: int, num: int, den: int, key: int, ws: Workspace) -> DataFrame:
    """(entry, node): each node of ``nodes`` under the rarest of its shingles, one more than similar sets can differ by.

    All sets rank shingles alike, by the number of these nodes that have them. Of two similar
    sets of n and m shingles at least num / den * max(n, m) are common, so the first
    n - ceil(num / den * n) + 1 of either hold one of those.
    """
    sets = whole_sets(docs, nodes, k, key, ws, "large").join(nodes, "node", "left_semi")
    each = sets.select("node", F.explode("s").alias("entry"))
    each = each.join(each.groupBy("entry").agg(F.count(F.lit(1)).alias("n")), "entry")
    ranked = each.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "entry"))).alias("s"))  # a set: no larger than its text
    first = F.size("s") - F.expr(f"cast((size(s) * {num}L + {den - 1}) div {den} as int)") + 1
    found = ws.save(ranked.select("node", F.explode(F.slice("s", F.lit(1), first)).alias("x")).where("x.n > 1").select(F.col("x.entry").alias("entry"), "node"), "rarest")
    ws.drop("large_sets")
    return found


def across(crowd: DataFrame, sets: DataFrame, num: int, den: int, partners: int) -> DataFrame:
    """(a, b, more): pairs of nodes of an open entry that aren't in one component yet and that sketches don't rule out.

    Each node tells its ``partners`` likeliest ones in a block, and ``more`` if it has others. An entry with more than BLOCK nodes is cut in blocks of about that size, and a task gets two
    of them, so no task holds a whole large entry.
    """
    crowd = crowd.withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int")).drop("k")
    named = crowd.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("entry")), 1, NAMED).alias("named"))
    crowd = crowd.join(named, "node").join(sets.select("node", "n_shingles", "sketch"), "node")
    crowd = crowd.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    crowd = crowd.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    crowd = crowd.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    found = crowd.select("entry", "lo", "hi", "node", "comp", "n_shingles", "block", "sketch", "named").groupBy("entry", "lo", "hi").applyInArrow(lean_group(compare(num, den, partners)), "a long, b long, more boolean")
    return found.groupBy("a", "b").agg(F.max("more").alias("more"))


def jaccard_components(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, doubled=None, ws: Workspace | None = None, key: int = 0) -> DataFrame:
    """(doc_id, n_shingles, node, component_id) of each row of ``docs`` (doc_id, text); ``key``: of the hashes."""
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "ngram")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scheme = Scheme.of(num, den, choose(docs, k, num, den) if doubled is None else doubled)
    buckets = int(min(max(estimated_bytes(docs) // BUCKET_BYTES, 12), 1 << 20))
    rows = docs.mapInArrow(lean_map(index_rows(k, scheme, buckets, key)), ROWS)
    rows.write.mode("overwrite").partitionBy("kind").parquet(ws.path("rows"))
    rows = spark.read.schema(rows.schema).parquet(ws.path("rows"))
    sets = rows.where("kind = 0").select("doc_id", "n_shingles", "node", "check")
    ids = sets.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("check").alias("lo"), F.max("check").alias("hi"))
    ids = ws.save(ids, "nodes")
    if not ids.where("lo <> hi").isEmpty():  # two sets on one node
        return jaccard_components(docs, k, num, den, doubled, ws, key + 1)
    found = rows.where("kind = 1").select("bucket", "sigs", "nodes", "counts").groupBy("bucket").applyInArrow(lean_group(meet), FOUND)
    found = ws.save(found, "found")
    met = ws.save(found.where("kind = 0").select("a", "b").distinct(), "met")
    crowd = found.where("kind = 1").select(F.col("a").alias("entry"), F.col("b").alias("node"))
    involved = met.select(F.explode(F.array("a", "b")).alias("node")).distinct()  # a crowded entry's nodes met its centre
    sketches = rows.where("kind = 0").select("node", "n_shingles", "sketch").join(involved, "node", "left_semi")
    sketches = ws.save(sketches.groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "sketches")
    edges = verify(docs, sieve(met, sketches, num, den, ws, "pairs"), k, num, den, key, ws, "edges")
    label = components(edges, ws, "first")
    crowd = ws.save(open_entries(crowd, label), "open")
    large = ws.save(crowd.where(F.col("k") > BLOCK).select("node").distinct(), "large")
    crowd = crowd.where(F.col("k") <= BLOCK).select("entry", "node")
    if not large.isEmpty():
        crowd = crowd.unionByName(rarest(docs, large, k, num, den, key, ws))
    # a large group of similar sets falls into one component by a few links of each, so not all of its pairs are told
    told = met
    for turn in itertools.count():
        rest = ws.save(across(open_entries(crowd, label), sketches, num, den, PARTNERS * MORE**turn), f"rest_{turn}")
        if rest.isEmpty():
            break
        more = verify(docs, rest.select("a", "b").join(told, ["a", "b"], "left_anti"), k, num, den, key, ws, f"more_{turn}")
        told = told.unionByName(rest.select("a", "b"))
        if not more.isEmpty():
            edges = edges.unionByName(more)
            label = components(edges, ws, f"turn_{turn}")
        if rest.where("more").isEmpty():
            break
    ids = ids.select("node", "least").join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = ids.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = ws.save(ids.join(least, "comp").select("node", "component_id"), "ids")
    out = sets.drop("check").join(ids, "node", "left")
    return out.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))


def choose(docs: DataFrame, k: int, num: int, den: int, sample_rows: int = 4000, seed: int = 11) -> dict[int, bool]:
    """The bands that index one-deletion neighbourhoods: where that costs less on a sample, counted up to the whole.

    The cost of a way is its entries, and 50 times the pairs that it makes meet; entries grow
    with the number of documents, pairs with its square.
    """
    n = docs.count()
    if not n:
        return {}
    part = min(1.0, sample_rows / n)
    ways = {0: Scheme.of(num, den), 1: Scheme.of(num, den, True)}

    def rows(batches):
        schema = pa.schema([("way", pa.int32()), ("band", pa.int32()), ("sig", pa.int64())])
        for batch in batches:
            for _, s, at, _node, _check in sets_of(batch.column(0), k):
                size = np.diff(at)
                band = np.searchsorted(ways[0].upper, size)
                low = band <= 24  # larger sets have segments that no other set shares by chance
                s, at, band = s[np.repeat(low, size)], np.concatenate([[0], np.cumsum(size[low])]), band[low]
                for way, scheme in ways.items():
                    for sig, row in entries(s, at, scheme):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sig), way, np.int32)), pa.array(band[row].astype(np.int32)), pa.array(sig.view(np.int64))], schema=schema)

    met = docs.sample(fraction=part, seed=seed).select("text").mapInArrow(rows, "way int, band int, sig long")
    met = met.groupBy("way", "band", "sig").agg(F.count(F.lit(1)).alias("c")).groupBy("way", "band")
    cost = {(r["way"], r["band"]): r["rows"] / part + 50 * r["pairs"] / part**2 for r in met.agg(F.sum("c").alias("rows"), F.sum(F.expr("c * (c - 1) / 2")).alias("pairs")).collect()}
    return {b: cost[1, b] < cost[0, b] for w, b in cost if w == 1 and (0, b) in cost}


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under 4-word shingle similarity of 0.85."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def near_duplicate_stage(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of each component's smallest id, with the columns of ``docs``: k-word shingles, similarity num / den or more.

    Texts without words all stay, rows without an id too; an id that repeats goes if all of its
    rows belong to components of smaller ids.
    """
    ws = Workspace(docs.sparkSession, "ngram")
    found = jaccard_components(docs, k, num, den, ws=ws)
    other = found.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.col("component_id") != F.col("doc_id")).alias("other"))
    drop = ws.save(other.where("other").select("doc_id"), "drop")
    marked = maybe_in(docs, F.coalesce(F.col("doc_id"), F.lit(-1)), bitmap(drop, "doc_id"))
    sure, rest = marked.where("not _ll_maybe").drop("_ll_maybe"), marked.where("_ll_maybe").drop("_ll_maybe").join(drop, "doc_id", "left_anti")
    return sure.unionByName(rest.select(sure.columns)).select(*[F.col(f"`{c}`") for c in docs.columns])
