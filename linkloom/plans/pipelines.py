"""End-to-end plans: training, inference and subsampling over tab-separated tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators import metrics, model
from linkloom.operators.blocking import BlockingConfig, build_candidates, candidate_lists
from linkloom.operators.features import FEATURE_COLUMNS, compute_features
from linkloom.operators.sampling import grouped_split, parse_truth, sample_hard_negatives, stratified_sample
from linkloom.sources.readers import load_source, load_truth, read_text_table
from linkloom.sources.writers import cached, fingerprint, write_table, write_text_table

#: Used at inference only if asked for; else the threshold saved with the model holds.
FROZEN_THRESHOLD = 0.76


@dataclass
class Trained:
    model: object
    threshold: float
    macro_f05: float
    swept: DataFrame
    summary: DataFrame
    errors: DataFrame
    ranks: DataFrame
    importances: DataFrame


def train(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, work: str, config: BlockingConfig = BlockingConfig(), neg_ratio: float = 4.0, seed: int = 42, full_group_features: bool = False, key: str = "", **fit) -> Trained:
    """Block, sample, featurize, split by record, fit, sweep and attribute errors.

    Candidates and features are cached under ``work``, named by settings and ``key`` (a name
    of the data). ``full_group_features``: relative features see all candidates of a record,
    not only the sampled ones.
    """
    spark = s1.sparkSession
    true_pairs = parse_truth(truth)
    cand = cached(spark, f"{work}/candidates_{fingerprint(config, key)}", {"candidate_rank"}, lambda: build_candidates(s1, s2, s3, config))
    summary = metrics.blocking_summary(cand, true_pairs, s1)

    def make() -> DataFrame:
        pairs = sample_hard_negatives(cand, true_pairs, neg_ratio, seed=seed)
        if not full_group_features:
            return compute_features(pairs, s1, s2, s3)
        return compute_features(cand, s1, s2, s3).join(pairs.select("source1_entity_id", "candidate_entity_id", "label"), ["source1_entity_id", "candidate_entity_id"])

    feats = cached(spark, f"{work}/features_{fingerprint(config, neg_ratio, seed, full_group_features, key)}", {*FEATURE_COLUMNS, "label"}, make)
    split = grouped_split(feats, seed=seed)
    fitted = model.fit(split, validation="is_val", seed=seed, **fit)
    scored_path = f"{work}/scored_{fingerprint(config, neg_ratio, seed, full_group_features, key, sorted(fit.items()))}"
    write_table(model.score(fitted, split.where("is_val")).select("source1_entity_id", "candidate_entity_id", "label", "proba"), scored_path)
    scored = spark.read.parquet(scored_path)
    entities = scored.select("source1_entity_id").distinct()
    swept = metrics.sweep(scored, true_pairs, entities)
    best = metrics.best_threshold(swept).first()
    errors = metrics.attribution(scored, true_pairs, entities, best["threshold"])
    return Trained(fitted, best["threshold"], best["macro_f"], swept, summary, errors, metrics.rank_metrics(scored), model.importances(fitted))


def match_lists(scored: DataFrame, s1: DataFrame, threshold: float) -> DataFrame:
    """A row per source-1 record with its matches in order of rank; empty for singletons."""
    hits = scored.where(F.col("proba") >= threshold)
    return candidate_lists(hits, s1, "matched_entity_ids")


def infer(s1: DataFrame, s2: DataFrame, s3: DataFrame, score, work: str, threshold: float, config: BlockingConfig = BlockingConfig()) -> tuple[DataFrame, DataFrame]:
    """(candidate lists, match lists); candidates are written once and read by both."""
    path = f"{work}/candidates"
    write_table(build_candidates(s1, s2, s3, config), path)
    cand = s1.sparkSession.read.parquet(path)
    scored = score(compute_features(cand, s1, s2, s3)).select("source1_entity_id", "candidate_entity_id", F.col("candidate_rank").cast("long").alias("candidate_rank"), "proba")
    return candidate_lists(cand, s1), match_lists(scored, s1, threshold)


def train_files(spark: SparkSession, data: str, out: str, k: int = 50, neg_ratio: float = 4.0, seed: int = 42) -> Trained:
    s1, s2, s3 = (load_source(spark, f"{data}/train_source{i}.tsv") for i in (1, 2, 3))
    done = train(s1, s2, s3, load_truth(spark, f"{data}/train_ground_truth.tsv"), f"{out}/work", BlockingConfig(k=k), neg_ratio, seed, key=data)
    model.save(done.model, out, done.threshold, done.macro_f05, k)
    return done


def infer_files(spark: SparkSession, data: str, model_path: str, out: str, k: int | None = None, threshold: float | None = None) -> None:
    """Writes candidate_pairs.tsv and matching_results.tsv (folders of part files)."""
    fitted, meta = model.load(model_path)
    s1, s2, s3 = (load_source(spark, f"{data}/test_source{i}.tsv") for i in (1, 2, 3))
    lists, matches = infer(s1, s2, s3, lambda df: model.score(fitted, df), f"{out}/work", meta["threshold"] if threshold is None else threshold, BlockingConfig(k=k or meta["k"]))
    write_text_table(lists, f"{out}/candidate_pairs.tsv")
    write_text_table(matches, f"{out}/matching_results.tsv")


def subsample_files(spark: SparkSession, data: str, out: str, n_s1: int = 5000, seed: int = 42) -> None:
    """A smaller source 1 with its truth, mixed of records with and without matches; the pool stays whole."""
    truth = load_truth(spark, f"{data}/train_ground_truth.tsv")
    ids = stratified_sample(truth, n_s1, seed=seed).select("source1_entity_id")
    s1 = read_text_table(spark, f"{data}/train_source1.tsv")
    write_text_table(s1.join(ids.withColumnRenamed("source1_entity_id", "entity_id"), "entity_id", "left_semi"), f"{out}/train_source1.tsv")
    for i in (2, 3):
        write_text_table(read_text_table(spark, f"{data}/train_source{i}.tsv"), f"{out}/train_source{i}.tsv")
    write_text_table(truth.join(ids, "source1_entity_id", "left_semi"), f"{out}/train_ground_truth.tsv")
