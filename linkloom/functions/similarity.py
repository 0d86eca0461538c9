"""String similarity: Spark's own functions where there are any, Arrow-batched kernels elsewhere.

Kernels follow the public definitions of normalized indel similarity and its token variants.
Longest common subsequences are bit-parallel over Python's integers, so the cost is a few
operations per character of one string; a batch looks each distinct pair up once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.text import split_words


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit per character of ``a``."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows = full
    for c in b:
        hit = rows & masks.get(c, 0)
        rows = (rows + hit | rows - hit) & full
    return len(a) - rows.bit_count()


def share(distance: float, length: int) -> float:
    return 100.0 if length == 0 else 100.0 * (1 - distance / length)


def indel(a: str, b: str) -> int:
    return len(a) + len(b) - 2 * lcs(a, b)


def ratio(a: str, b: str) -> float:
    return share(indel(a, b), len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_a, only_b = x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_a or not only_b):
        return 100.0
    s = len(" ".join(sorted(both)))
    gap = 1 if s else 0
    la, lb = s + gap + len(only_a), s + gap + len(only_b)
    best = share(indel(only_a, only_b), la + lb)
    if not s:
        return best
    return max(best, share(gap + len(only_a), s + la), share(gap + len(only_b), s + lb))


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with a window of its length, or a shorter one at either end, of the longer."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    if len(a) > len(b):
        a, b = b, a
    m = len(a)

    def best(a: str, b: str) -> float:
        windows = [b[i : i + m] for i in range(len(b) - m + 1)] + [b[:i] for i in range(1, m)] + [b[-i:] for i in range(1, m)]
        return max(ratio(a, w) for w in dict.fromkeys(windows))

    return max(best(a, b), best(b, a)) if len(a) == len(b) else best(a, b)


def partial_token_ratio(a: str, b: str) -> float:
    x, y = a.split(), b.split()
    if set(x) & set(y):
        return 100.0
    bags = partial_ratio(" ".join(sorted(x)), " ".join(sorted(y)))
    return max(bags, partial_ratio(" ".join(sorted(set(x))), " ".join(sorted(set(y)))))


def weighted_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    q = max(len(a), len(b)) / min(len(a), len(b))
    if q < 1.5:
        return max(ratio(a, b), 0.95 * max(token_sort(a, b), token_set(a, b)))
    scale = 0.9 if q <= 8 else 0.6
    return max(ratio(a, b), scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def jaro_winkler(a: str, b: str) -> float:
    if not a and not b:
        return 100.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, hits_a = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits_a.append(c)
                break
    m = len(hits_a)
    if m == 0:
        return 0.0
    hits_b = [c for c, u in zip(b, used, strict=True) if u]
    swaps = sum(x != y for x, y in zip(hits_a, hits_b, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro > 0.7:
        p = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
        jaro += 0.1 * p * (1 - jaro)
    return 100.0 * jaro


KERNELS = {"ratio": ratio, "token_sort": token_sort, "token_set": token_set, "w_ratio": weighted_ratio, "jaro_winkler": jaro_winkler}


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, a row a text, and lengths."""
    n = np.array([len(x) for x in texts])
    width = max(int(n.max()), 1)
    codes = np.array(texts, dtype=f"<U{width}").view(np.uint32).reshape(len(texts), width)
    return codes, n


def jaro_winkler_all(a: list[str], b: list[str]) -> np.ndarray:
    """``jaro_winkler`` of many pairs: one step a character of the longest first text, for all pairs at once."""
    out = np.zeros(len(a))
    for k in range(0, len(a), 2048):
        out[k : k + 2048] = _jaro_winkler_block(a[k : k + 2048], b[k : k + 2048])
    return out


def _jaro_winkler_block(a: list[str], b: list[str]) -> np.ndarray:
    if max(map(len, a)) > 256 or max(map(len, b)) > 256:
        return np.array([jaro_winkler(x, y) for x, y in zip(a, b, strict=True)])
    (x, la), (y, lb) = _codes(a), _codes(b)
    if max(x.max(), y.max()) < 256:
        x, y = x.astype(np.uint8), y.astype(np.uint8)
    rows, reach = np.arange(len(a)), np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    free = np.arange(y.shape[1]) < lb[:, None]
    ends, hit = free.copy(), np.zeros(x.shape, bool)
    most = int(reach.max())
    gap = np.abs(np.arange(-x.shape[1], y.shape[1]))  # at x.shape[1] + j - i
    uniform = reach.min() == most
    for i in range(int(la.max())):
        lo, hi = max(0, i - most), min(y.shape[1], i + most + 1)
        if lo >= hi:
            break
        same = (y[:, lo:hi] == x[:, i, None]) & free[:, lo:hi]
        if not uniform:
            same &= gap[x.shape[1] + lo - i : x.shape[1] + hi - i] <= reach[:, None]
        first = same.argmax(1)
        got = same[rows, first] & (i < la)
        free[rows[got], lo + first[got]] = False
        hit[got, i] = True
    m = hit.sum(1)
    used = ends & ~free
    swaps = np.bincount(np.repeat(rows, m), weights=x[hit] != y[used], minlength=len(a)) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (m / la + m / lb + (m - swaps) / m) / 3
    width = min(4, x.shape[1], y.shape[1])
    lead = (x[:, :width] == y[:, :width]) & (np.arange(width) < np.minimum(la, lb)[:, None])
    p = np.logical_and.accumulate(lead, axis=1).sum(1)
    jaro = np.where(jaro > 0.7, jaro + 0.1 * p * (1 - jaro), jaro)
    return np.where((la == 0) & (lb == 0), 100.0, np.where(m == 0, 0.0, 100.0 * jaro))


@F.pandas_udf(T.DoubleType())
def jaro_winkler_alone(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The one kernel, where the others aren't asked for."""
    for a, b in batches:
        yield pd.Series(jaro_winkler_all(a.fillna("").tolist(), b.fillna("").tolist()), index=a.index)


def lcs_all(a: list[str], b: list[str]) -> np.ndarray:
    """``lcs`` of many pairs: one step a character of the longest text, for all pairs at once; long texts one by one."""
    out = np.zeros(len(a), np.int64)
    for k in range(0, len(a), 8192):
        out[k : k + 8192] = _lcs_block(a[k : k + 8192], b[k : k + 8192])
    return out


def _lcs_block(a: list[str], b: list[str]) -> np.ndarray:
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b, strict=True)]
    out = np.zeros(len(pairs), np.int64)
    words = np.array([-(-len(x) // 63) if len(y) <= 256 else -1 for x, y in pairs])
    for k in np.unique(words[words != 0]).tolist():
        at = np.flatnonzero(words == k)
        short, long = zip(*[pairs[i] for i in at.tolist()], strict=True)
        out[at] = _lcs_words(short, long, k) if k > 0 else [lcs(x, y) for x, y in zip(short, long, strict=True)]
    return out


def _lcs_words(short: tuple[str, ...], long: tuple[str, ...], words: int) -> np.ndarray:
    """Of texts whose shorter one takes ``words`` words of 63 bits; the last bit of a word carries to the next."""
    of, distinct = pd.factorize(np.array(short, object))
    (x, n), (y, _) = _codes(distinct.tolist()), _codes(list(long))
    letters = np.unique(x)  # the least stands for what a text hasn't, too: 0 ends the shorter ones
    letters = letters if len(letters) and letters[0] == 0 else np.concatenate([[0], letters])
    if len(distinct) * len(letters) * words > 1 << 22:
        return np.array([lcs(x, y) for x, y in zip(short, long, strict=True)])
    at = np.searchsorted(letters, x)
    masks = np.zeros((words, len(distinct), len(letters)), np.uint64)
    for i in range(x.shape[1]):
        masks[i // 63, np.arange(len(distinct)), at[:, i]] |= np.uint64(1 << i % 63)
    masks[:, :, 0] = 0
    place = np.minimum(np.searchsorted(letters, y), len(letters) - 1)
    place[letters[place] != y] = 0
    bits = np.clip(n - 63 * np.arange(words)[:, None], 0, 63).astype(np.uint64)
    full = ((np.uint64(1) << bits) - np.uint64(1))[:, of]
    rows, flat, own = full.copy(), masks.reshape(words, -1), of * len(letters)
    for j in range(y.shape[1]):
        cell, carry = own + place[:, j], np.uint64(0)
        for k in range(words):
            hit = rows[k] & flat[k, cell]
            added = rows[k] + hit + carry
            carry = added >> np.uint64(63)
            rows[k] = (added | rows[k] - hit) & full[k]
    return n[of] - np.bitwise_count(rows).sum(0).astype(np.int64)


def _shares(distance: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.where(length == 0, 100.0, 100.0 * (1 - distance / np.maximum(length, 1)))


def _lengths(texts) -> np.ndarray:
    return np.array(list(map(len, texts)), np.int64)


def partial_ratios_all(a: list[str], b: list[str]) -> np.ndarray:
    """``partial_ratio`` of many pairs, long texts one by one."""
    best = np.zeros(len(a))
    left, right, of = [], [], []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if not x or not y or max(len(x), len(y)) > 256:
            best[i] = partial_ratio(x, y)
            continue
        for s, t in ((x, y), (y, x)):
            m = len(s)
            if m <= len(t):
                windows = {t[j : j + m] for j in range(len(t) - m + 1)} | {t[:j] for j in range(1, m)} | {t[-j:] for j in range(1, m)}
                left += [s] * len(windows)
                right += windows
                of += [i] * len(windows)
    n = _lengths(left) + _lengths(right)
    np.maximum.at(best, np.array(of, np.int64), _shares(n - 2 * lcs_all(left, right), n))
    return best


def _lift(score: np.ndarray, at: np.ndarray, weight: np.ndarray, a, b, common: np.ndarray) -> None:
    """Raises ``score`` at ``at`` to ``weight`` times the partial ratio; ``common`` is what the texts share, and a window shares no more."""
    x, y = [a[i] for i in at.tolist()], [b[i] for i in at.tolist()]
    n, m = _lengths(x), _lengths(y)
    most = np.where(n + m == 0, 100.0, 200.0 * common / np.maximum(np.minimum(n, m) + common, 1))
    todo = np.flatnonzero(weight * most > score[at])
    for k in range(0, len(todo), 256):
        part = todo[k : k + 256]
        best = partial_ratios_all([x[i] for i in part.tolist()], [y[i] for i in part.tolist()])
        score[at[part]] = np.maximum(score[at[part]], weight[part] * best)


TOKEN_KERNELS = ["token_sort", "token_set", "w_ratio"]


def token_ratios_all(a: list[str], b: list[str]) -> dict[str, np.ndarray]:
    """``ratio``, ``token_sort``, ``token_set`` and ``weighted_ratio`` of many pairs; windows only where they can raise the last."""
    if not len(a):
        return {k: np.zeros(0) for k in ["ratio", *TOKEN_KERNELS]}
    words = {x: x.split() for x in {*a, *b}}
    bags, sets = {x: " ".join(sorted(w)) for x, w in words.items()}, {x: frozenset(w) for x, w in words.items()}
    la, lb = _lengths(a), _lengths(b)
    common = lcs_all(a, b)
    plain = _shares(la + lb - 2 * common, la + lb)
    sa, sb = [bags[x] for x in a], [bags[x] for x in b]
    na, nb = _lengths(sa), _lengths(sb)
    common_bags = lcs_all(sa, sb)
    token_sort = _shares(na + nb - 2 * common_bags, na + nb)

    only, other, s = [], [], np.zeros(len(a), np.int64)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        x, y = sets[x], sets[y]
        both = x & y
        s[i] = sum(map(len, both)) + max(len(both) - 1, 0)
        only.append(" ".join(sorted(x - both)))
        other.append(" ".join(sorted(y - both)))
    some = np.array([bool(sets[x]) and bool(sets[y]) for x, y in zip(a, b, strict=True)])
    oa, ob, gap = _lengths(only), _lengths(other), (s > 0).astype(np.int64)
    ta, tb = s + gap + oa, s + gap + ob
    token_set = _shares(oa + ob - 2 * lcs_all(only, other), ta + tb)
    token_set = np.where(gap == 1, np.maximum(token_set, np.maximum(_shares(gap + oa, s + ta), _shares(gap + ob, s + tb))), token_set)
    token_set = np.where((gap == 1) & ((oa == 0) | (ob == 0)), 100.0, token_set)
    token_set = np.where(some, token_set, 0.0)

    small, large = np.minimum(la, lb), np.maximum(la, lb)
    q = large / np.maximum(small, 1)
    near = np.maximum(plain, 0.95 * np.maximum(token_sort, token_set))
    scale = np.where(q <= 8, 0.9, 0.6)
    # a word on both sides makes the partial token ratio 100; a window shares no more than the whole text
    far = np.where(gap == 1, np.maximum(plain, 0.95 * scale * 100.0), plain)
    w_ratio = np.where(q < 1.5, near, far)
    more = (small > 0) & (q >= 1.5)
    at = np.flatnonzero(more)
    _lift(w_ratio, at, scale[at], a, b, common[at])
    at = np.flatnonzero(more & (gap == 0))
    _lift(w_ratio, at, 0.95 * scale[at], sa, sb, common_bags[at])
    da, db = ({i: " ".join(sorted(sets[x[i]])) for i in at.tolist()} for x in (a, b))
    at = np.array([i for i in at.tolist() if (da[i], db[i]) != (sa[i], sb[i])], np.int64)
    _lift(w_ratio, at, 0.95 * scale[at], da, db, lcs_all([da[i] for i in at.tolist()], [db[i] for i in at.tolist()]))
    w_ratio = np.where(small == 0, 0.0, w_ratio)
    return {"ratio": plain, "token_sort": token_sort, "token_set": token_set, "w_ratio": w_ratio}


@F.pandas_udf(T.StructType([T.StructField(k, T.DoubleType()) for k in TOKEN_KERNELS]))
def token_kernels(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """The token ratios, where the other kernels aren't asked for."""
    for a, b in batches:
        yield pd.DataFrame(token_ratios_all(a.fillna("").tolist(), b.fillna("").tolist()), index=a.index)[TOKEN_KERNELS]


@F.pandas_udf(T.StructType([T.StructField(k, T.DoubleType()) for k in KERNELS]))
def kernels(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """All kernels of a pair of texts in one pass between JVM and Python."""
    for a, b in batches:
        pairs = pd.DataFrame({"a": a.fillna(""), "b": b.fillna("")})
        distinct = pairs.drop_duplicates().copy()
        x, y = distinct["a"].tolist(), distinct["b"].tolist()
        for k, v in (token_ratios_all(x, y) | {"jaro_winkler": jaro_winkler_all(x, y)}).items():
            distinct[k] = v
        yield pairs.merge(distinct, on=["a", "b"], how="left")[list(KERNELS)].set_axis(a.index)


@F.pandas_udf(T.IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs(x or "", y or "") for x, y in zip(a, b, strict=True)])


def levenshtein_share(a: Column, b: Column) -> Column:
    longest = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longest == 0, 100.0).otherwise(100.0 * (1 - F.levenshtein(a, b) / longest))


def length_gap(a: Column, b: Column) -> Column:
    return F.abs(F.char_length(a) - F.char_length(b))


def length_gap_share(a: Column, b: Column) -> Column:
    return length_gap(a, b) / F.greatest(F.char_length(a), F.char_length(b), F.lit(1))


def word_gap(a: Column, b: Column) -> Column:
    return F.abs(F.size(split_words(a)) - F.size(split_words(b)))


def same_text(a: Column, b: Column) -> Column:
    return F.when((a == b) & (F.char_length(a) > 0), 1.0).otherwise(0.0)


def text_features(a: Column, b: Column, name: str, scores: Column) -> dict[str, Column]:
    """The ten features of a pair of normalized texts; ``scores`` is their ``kernels`` struct."""
    values = {k: scores[k] for k in KERNELS} | {
        "levenshtein": levenshtein_share(a, b), "len_diff": length_gap(a, b), "norm_len_diff": length_gap_share(a, b),
        "token_count_diff": word_gap(a, b), "exact_match": same_text(a, b),
    }
    return {f"{name}_{k}": v.cast("float") for k, v in values.items()}
