"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows of bytes, all windows of a slice at once: at each step two GRUs, one
from either end, take the next byte of every window, and a softmax over both states labels that
position. A document's probabilities are the means over all its positions; nothing but bytes
goes in. Training is plain numpy: cross entropy at every position, gradients by
backpropagation through time over the window, Adam. It uses a bounded sample of labelled rows,
``per_label`` for each label, fewer where all labels would have more than ``max_rows`` but one at
least, and ``window * 8`` characters of each, taken from a place in the text that the row's hash
names.

Defined results: a text that is null or has no letter gets ``und`` at 0; without any labelled
row every text does; every label of the sample's fold is learned; rows that repeat id and text
are learned once, rows without an id belong to those learned from; rows are judged one by one; an
empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.shared import lean_map, small_batches
from linkloom.runtime import make_importable

WINDOW = 64
#: Windows that step together; bounds the memory of a step.
TOGETHER = 4096


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def init(labels: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    p = {}
    for d in ("f", "b"):
        p[f"x_{d}"] = w(257, 3 * hidden, scale=0.3)  # input weights of each byte: update, reset, candidate; 256 pads
        p[f"g_{d}"] = w(hidden, 2 * hidden, scale=hidden**-0.5)
        p[f"c_{d}"] = w(hidden, hidden, scale=hidden**-0.5)
    p["out"] = w(2 * hidden, labels, scale=hidden**-0.5)
    p["bias"] = np.zeros(labels, np.float32)
    return p


def run(p: dict, d: str, x: np.ndarray, keep: bool = False):
    """States of one direction: x is (steps, windows) bytes in reading order; padding leaves the state as it is."""
    hidden = p[f"c_{d}"].shape[0]
    h = np.zeros((x.shape[1], hidden), np.float32)
    states, trace = np.empty((*x.shape, hidden), np.float32), []
    table, gates, cand = p[f"x_{d}"], p[f"g_{d}"], p[f"c_{d}"]
    real = (x < 256).astype(np.float32)[:, :, None]
    for t in range(x.shape[0]):
        e = table[x[t]]
        zr = sigmoid(e[:, : 2 * hidden] + h @ gates)
        z, r = zr[:, :hidden] * real[t], zr[:, hidden:]
        c = np.tanh(e[:, 2 * hidden :] + (r * h) @ cand)
        if keep:
            trace.append((h, z, r, c))
        h = h + z * (c - h)
        states[t] = h
    return states, trace


def back(p: dict, d: str, x: np.ndarray, trace: list, up: np.ndarray, grad: dict) -> None:
    """Backpropagation through time: ``up`` is the loss by each state."""
    hidden = p[f"c_{d}"].shape[0]
    real = (x < 256).astype(np.float32)[:, :, None]
    gates, cand = p[f"g_{d}"], p[f"c_{d}"]
    dh = np.zeros_like(up[0])
    for t in range(x.shape[0] - 1, -1, -1):
        h, z, r, c = trace[t]
        dh = dh + up[t]
        da = dh * z * (1 - c * c)
        drh = da @ cand.T
        # z already carries the mask, and so does its slope
        dz = dh * (c - h) * z * (1 - z) * real[t]
        dr = drh * h * r * (1 - r)
        dzr = np.concatenate([dz, dr], 1)
        grad[f"c_{d}"] += (r * h).T @ da
        grad[f"g_{d}"] += h.T @ dzr
        np.add.at(grad[f"x_{d}"], x[t], np.concatenate([dzr, da], 1))
        dh = dh * (1 - z) + drh * r + dzr @ gates.T


def forward(p: dict, x: np.ndarray, keep: bool = False):
    """Probabilities (steps, windows, labels) of (steps, windows) bytes."""
    f, tf = run(p, "f", x, keep)
    b, tb = run(p, "b", x[::-1], keep)
    both = np.concatenate([f, b[::-1]], 2)
    y = both @ p["out"] + p["bias"]
    y = np.exp(y - y.max(2, keepdims=True))
    y /= y.sum(2, keepdims=True)
    return (y, both, tf, tb) if keep else y


def gradients(p: dict, x: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
    """Mean cross entropy over real positions, and its gradients."""
    y, both, tf, tb = forward(p, x, keep=True)
    real = x < 256
    n = max(int(real.sum()), 1)
    pick = np.take_along_axis(y, np.broadcast_to(label[None, :, None], (*x.shape, 1)), 2)[..., 0]
    loss = float(-np.log(np.maximum(pick[real], 1e-12)).sum() / n)
    dy = y.copy()
    np.put_along_axis(dy, np.broadcast_to(label[None, :, None], (*x.shape, 1)), (pick - 1)[..., None], 2)
    dy *= real[..., None] / np.float32(n)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    grad["out"] += both.reshape(-1, both.shape[2]).T @ dy.reshape(-1, dy.shape[2])
    grad["bias"] += dy.sum((0, 1))
    up = dy @ p["out"].T
    hidden = p["c_f"].shape[0]
    back(p, "f", x, tf, up[..., :hidden], grad)
    back(p, "b", x[::-1], tb, up[::-1, :, hidden:], grad)
    return loss, grad


def train(texts: list[str], labels: list[int], n_labels: int, hidden: int = 8, steps: int = 300, batch: int = 96, rate: float = 0.02, seed: int = 5) -> dict:
    """Adam on random windows; the labels are drawn evenly."""
    rng = np.random.default_rng(seed)
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    groups = [[d for d, y in zip(data, labels, strict=True) if y == k and len(d)] for k in range(n_labels)]
    some = [k for k, g in enumerate(groups) if g]
    p = init(n_labels, hidden, seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    for step in range(1, steps + 1) if some else ():
        y = rng.choice(some, batch)
        x = np.full((WINDOW, batch), 256, np.int64)
        for j, k in enumerate(y):
            d = groups[k][rng.integers(len(groups[k]))]
            at = rng.integers(max(1, len(d) - WINDOW + 1))
            x[: min(WINDOW, len(d) - at), j] = d[at : at + WINDOW]
        _, g = gradients(p, x, y)
        norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
        now = rate * min(1.0, (steps - step + 1) / (0.4 * steps))
        for k in p:
            a = g[k] * min(1.0, 1.0 / max(norm, 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * a
            v[k] = 0.999 * v[k] + 0.001 * a * a
            p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


def pooled(p: dict, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(rows, labels) means over the positions of each row of a byte buffer; empty rows get zeros."""
    n = np.diff(at)
    windows = -(-n // WINDOW)
    of = np.repeat(np.arange(len(n)), windows)
    start = at[:-1][of] + (np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)) * WINDOW
    sums = np.zeros((len(n), p["bias"].shape[0]))
    for i in range(0, len(of), TOGETHER):
        s, o = start[i : i + TOGETHER], of[i : i + TOGETHER]
        place = s[None, :] + np.arange(WINDOW)[:, None]
        inside = place < at[1:][o][None, :]
        x = np.where(inside, data[np.minimum(place, len(data) - 1)].astype(np.int64), 256)
        y = (forward(p, x) * inside[..., None]).sum(0)
        np.add.at(sums, o, y)
    return sums / np.maximum(n, 1)[:, None]


def predict_rows(p: dict, names: list[str]):
    """mapInArrow over (doc_id, text, held_out, has a letter): doc_id, held_out, lang_pred, score."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def rows(batches):
        for batch in batches:
            texts = batch.column(1).fill_null("")
            at = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None and len(texts) else np.zeros(0, np.uint8)
            y = pooled(p, data, at) if names and len(data) else np.zeros((len(texts), max(len(names), 1)))
            best = y.argmax(1)
            letter = np.array(batch.column(3).to_pylist(), bool) & bool(names)
            lang = [names[k] if ok else "und" for k, ok in zip(best, letter, strict=True)]
            score = np.where(letter, np.minimum(y.max(1), 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(lang, pa.string()), pa.array(score)], schema=schema)

    return rows


def sample_labelled(docs: DataFrame, per_label: int, max_rows: int, chars: int) -> DataFrame:
    """(text, lang) of a bounded sample: the first ``per_label`` rows of each label by hash, fewer of each beyond ``max_rows`` in all.

    Labels are counted first, so that only about three times the rows asked for are ranked;
    rows equal in id and text count once. ``chars`` characters of a text come along, from a
    place that the hash names.
    """
    docs = docs.withColumn("_key", F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(1 << 62)))
    labels = docs.groupBy("lang").agg(F.approx_count_distinct("_key").alias("_n"))
    per_label = max(1, min(per_label, max_rows // max(1, labels.count())))
    labels = labels.select("lang", (F.lit(float(1 << 62)) * (3 * per_label + 30) / F.col("_n")).alias("_most"))
    few = docs.join(F.broadcast(labels), "lang").where(F.col("_key") < F.col("_most"))  # a row a label, as in the sample that the driver gets
    start = F.pmod("_key", F.greatest(F.char_length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    few = few.select("lang", "_key", F.substring(F.col("text"), start, F.lit(chars)).alias("text")).groupBy("lang", "_key").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_key"))
    return few.withColumn("_rank", rank).where(F.col("_rank") <= per_label).select("text", "lang")


def identify(docs: DataFrame, held_out, per_label: int = 400, max_rows: int = 25600, **training) -> DataFrame:
    """doc_id, held_out, lang_pred, score of ``docs`` (doc_id, text, lang); learns from rows that aren't held out."""
    make_importable(docs.sparkSession)
    small_batches(docs.sparkSession)
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    known = docs.where("not held_out and lang is not null and text is not null")
    rows = sample_labelled(known, per_label, max_rows, WINDOW * 8).orderBy("lang", "text").collect()
    names = sorted({r["lang"] for r in rows})
    p = train([r["text"] for r in rows], [names.index(r["lang"]) for r in rows], max(len(names), 1), **training)
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", "text", "held_out", letter.alias("letter")).mapInArrow(
        lean_map(predict_rows(p, names)), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; those whose crc32 of the id is 1 modulo 3 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
