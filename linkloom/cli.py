"""Command line: ``python -m linkloom.cli train|infer|subsample|block|merge``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession


def environment(env=os.environ) -> dict:
    """Settings of a distributed run from the environment; values that can't be read fall back, others are clamped."""

    def number(name: str, default: int) -> int:
        try:
            return int(env.get(name, default))
        except ValueError:
            return default

    count = max(1, number("MACHINE_COUNT", 1))
    return {
        "enabled": env.get("DISTRIBUTED_MODE", "").strip().lower() in {"1", "true", "yes", "on"},
        "machine_id": min(max(0, number("MACHINE_ID", 0)), count - 1), "machine_count": count,
        "chunk_size": max(1000, number("S1_CHUNK_SIZE", 25000)), "checkpoint_dir": env.get("CHECKPOINT_DIR", "output/distributed_candidates"),
    }


def parser() -> argparse.ArgumentParser:
    env = environment()
    top = argparse.ArgumentParser(prog="linkloom")
    sub = top.add_subparsers(dest="command", required=True)
    t = sub.add_parser("train")
    t.add_argument("--data-dir", default="dataset/train_sample")
    t.add_argument("--k", type=int, default=50)
    t.add_argument("--neg-ratio", type=float, default=4.0)
    t.add_argument("--seed", type=int, default=42)
    t.add_argument("--model-out", default="model")
    i = sub.add_parser("infer")
    i.add_argument("--data-dir", default="dataset/test")
    i.add_argument("--model", default="model")
    i.add_argument("--output-dir", default="output")
    i.add_argument("--k", type=int)
    i.add_argument("--threshold", type=float)
    i.add_argument("--frozen-threshold", action="store_true", help="the fixed threshold in place of the one saved with the model")
    i.add_argument("--chunk-size", type=int, default=100000, help="accepted for scripts that pass it; Spark's partitions bound memory here")
    s = sub.add_parser("subsample")
    s.add_argument("--n-s1", type=int, default=5000)
    s.add_argument("--input-dir", default="dataset/train")
    s.add_argument("--output-dir", default="dataset/train_sample")
    s.add_argument("--seed", type=int, default=42)
    for name in ("block", "merge"):
        b = sub.add_parser(name)
        b.add_argument("--data-dir", default="dataset/train_sample")
        b.add_argument("--checkpoint-dir", default=env["checkpoint_dir"])
        b.add_argument("--machine-id", type=int, default=env["machine_id"])
        b.add_argument("--machine-count", type=int, default=env["machine_count"])
        b.add_argument("--chunk-size", type=int, default=env["chunk_size"])
        b.add_argument("--k", type=int, default=50)
        b.add_argument("--output", default="output/candidate_pairs_merged.parquet")
        b.add_argument("--require-all", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    from linkloom.operators.blocking import BlockingConfig
    from linkloom.plans import pipelines
    from linkloom.sources.readers import load_source
    from linkloom.sources.writers import merge_chunks, write_chunks

    top = parser()
    a = top.parse_args(argv)
    if a.command == "block" and (a.machine_count < 1 or not 0 <= a.machine_id < a.machine_count or a.chunk_size <= 0):
        top.error("0 <= machine-id < machine-count and chunk-size > 0 must hold")
    spark = SparkSession.builder.appName("linkloom").getOrCreate()
    if a.command == "train":
        done = pipelines.train_files(spark, a.data_dir, a.model_out, a.k, a.neg_ratio, a.seed)
        for df in (done.summary, done.ranks, done.swept.orderBy("macro_f", ascending=False).limit(10), done.errors, done.importances.orderBy("splits", ascending=False).limit(10)):
            df.show(truncate=False)
    elif a.command == "infer":
        pipelines.infer_files(spark, a.data_dir, a.model, a.output_dir, a.k, pipelines.FROZEN_THRESHOLD if a.threshold is None and a.frozen_threshold else a.threshold)
    elif a.command == "subsample":
        pipelines.subsample_files(spark, a.input_dir, a.output_dir, a.n_s1, a.seed)
    elif a.command == "block":
        sources = [load_source(spark, f"{a.data_dir}/train_source{i}.tsv") for i in (1, 2, 3)]
        write_chunks(*sources, a.checkpoint_dir, a.machine_id, a.machine_count, a.chunk_size, BlockingConfig(k=a.k)).show(truncate=False)
    else:
        merge_chunks(spark, a.checkpoint_dir, a.output, a.machine_count, a.require_all, BlockingConfig(k=a.k), a.chunk_size)


if __name__ == "__main__":
    main()
