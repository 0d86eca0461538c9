"""Quality rules: a short-circuit cascade ordered by measured rejection per cost.

A rule is a named boolean Column over the text; a document that any rule rejects goes.
``plan_cascade`` runs each rule alone over a sample, takes its seconds and its share of
rejections, and orders by share / seconds. ``verdict`` nests the rules in CASE branches in
that order, so that a later rule isn't evaluated where an earlier one has rejected. Which
documents stay doesn't depend on the order, hence not on the sample either.

Defined results: a null, empty or blank text has no words and is rejected by the word count;
rows are judged one by one (ties and repeated rows alike); an empty table gives an empty one;
extra columns pass through ``apply_cascade`` untouched whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.shared import NOT_SPACE, let, words

SYMBOLS = r"[#*$%&|<>]"
LETTER = r"\p{L}"


def word_chars(w: Column) -> Column:
    return F.char_length(F.array_join(w, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(NOT_SPACE))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def windows(w: Column) -> Column:
    """64-bit hashes of the 3-word windows, in order. Keep it in a projection of its own: array functions on a column are compiled, inside a lambda they aren't."""
    n = F.greatest(F.size(w) - 2, F.lit(0))
    return F.transform(F.arrays_zip(F.slice(w, 1, n).alias("a"), F.slice(w, 2, n).alias("b"), F.slice(w, 3, n).alias("c")), lambda x: F.xxhash64(x))


def n_repeat_words(h: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more, from ``windows``.

    Most texts have as many distinct windows as windows, which one hash set tells; for the
    others, equal windows meet by sorting pairs of hash and position.
    """

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda p, k, x: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
        again = let(
            pairs,
            lambda p: F.filter(
                F.transform(p, lambda x, k: F.when(same(p, k - 1, x) | same(p, k + 1, x), x["i"])),
                lambda x: x.isNotNull(),
            ),
        )
        # each window covers three words, less what the next one covers as well
        return let(
            F.sort_array(again),
            lambda a: F.aggregate(
                F.transform(a, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(a, k + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda s, x: s + x
            ),
        )

    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))


@dataclass(frozen=True)
class Rule:
    """``rejects``: a boolean Column of (text, words, prepared); what it holds for goes.

    ``prepare``, a Column of (text, words), is computed only for rows that reach the rule.
    """

    name: str
    rejects: Callable[[Column, Column, Column | None], Column]
    prepare: Callable[[Column, Column], Column] | None = None


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejection: float

    @property
    def rank(self) -> float:
        return self.rejection / max(self.seconds, 1e-9)


def default_rules() -> list[Rule]:
    return [
        Rule("too_few_words", lambda t, w, p: F.size(w) < 50),
        Rule("repeated_windows", lambda t, w, p: 100 * n_repeat_words(p) > 50 * F.size(w), lambda t, w: windows(w)),
        Rule("symbols", lambda t, w, p: 100 * n_symbols(t) > 50 * F.size(w)),
        Rule("word_length", lambda t, w, p: (p < 2 * F.size(w)) | (p > 25 * F.size(w)), lambda t, w: word_chars(w)),
        Rule("repeated_lines", lambda t, w, p: (p >= 3) & (100 * p > 40 * F.size(F.split(t, "\n"))), lambda t, w: n_dup_lines(t)),
        Rule("few_letters", lambda t, w, p: 100 * F.char_length(F.regexp_replace(t, LETTER + "+", "")) > 75 * F.char_length(t)),
    ]


def cascade(df: DataFrame, order: list[Rule], text: str, w: str, out: str) -> DataFrame:
    """Adds ``out``: the name of the first rule that rejects, null for what stays.

    One projection a rule; CASE leaves a rule out for rows that an earlier one has rejected.
    """
    df = df.withColumn(out, F.lit(None).cast("string"))
    for rule in order:
        here, p = F.col(out), None
        if rule.prepare:
            df = df.withColumn("_prepared", F.when(here.isNull(), rule.prepare(F.col(text), F.col(w))))
            p = F.col("_prepared")
        df = df.withColumn(out, F.when(here.isNotNull(), here).when(F.coalesce(rule.rejects(F.col(text), F.col(w), p), F.lit(False)), F.lit(rule.name)))
    return df.drop("_prepared")


def measure(sample: DataFrame, rules: list[Rule], text_col: str = "text") -> list[Measured]:
    """Seconds and share of rejections of each rule alone, net of what reading and splitting cost."""
    held = sample.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).select("t", words(F.col("t")).alias("w")).persist()
    try:

        def timed(rules: list[Rule]) -> tuple[float, int, int]:
            began = time.perf_counter()
            n, hits = cascade(held, rules, "t", "w", "by").agg(F.count(F.lit(1)), F.count("by")).first()
            return time.perf_counter() - began, n, hits

        timed([])
        floor, n, _ = timed([])
        out = []
        for rule in rules:
            timed([rule])  # compiles it
            took, _, hits = timed([rule])
            out.append(Measured(rule, max(took - floor, 1e-3), hits / max(n, 1)))
        return out
    finally:
        held.unpersist()


def plan_cascade(docs: DataFrame, rules: list[Rule] | None = None, text_col: str = "text", sample_rows: int = 1000, seed: int = 7) -> list[Measured]:
    """The rules by rejection per cost, from about ``sample_rows`` rows taken all over the table."""
    rules = default_rules() if rules is None else rules
    n = docs.count()
    sample = docs.select(text_col).sample(fraction=min(1.0, sample_rows / max(n, 1)), seed=seed)
    return sorted(measure(sample, rules, text_col), key=lambda m: -m.rank)


def apply_cascade(docs: DataFrame, order: list[Rule], text_col: str = "text", out_col: str = "rejected_by") -> DataFrame:
    """``docs`` with ``out_col``: the rule that rejects the document, null if none does."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_t"))
    held = cascade(held.withColumn("_w", words(F.col("_t"))), order, "_t", "_w", "_by")
    return held.select(*[F.col(f"_row.`{c}`") for c in docs.columns], F.col("_by").alias(out_col))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and whether it stays.

    The two base rules come with the columns asked for; the cascade orders the others and
    leaves out what the base has rejected.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = {"too_few_words", "repeated_windows"}
    order = [m.rule for m in plan_cascade(docs, [r for r in default_rules() if r.name not in base])]
    by_base = Rule("base", lambda t, w, p: F.col("base_failed"))
    df = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("w", words(F.col("text"))).withColumn("h", windows(F.col("w")))
    df = df.select(
        "doc_id", "text", "w", F.size("w").cast("long").alias("n_words"), word_chars(F.col("w")).alias("word_chars"), n_symbols(F.col("text")).alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"), n_repeat_words(F.col("h")).alias("n_repeat_words"),
    )
    df = df.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    df = cascade(df, [by_base, *order], "text", "w", "by")
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("by").isNull().alias("kept"))


def quality_stage(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with the columns of ``docs``.

    The row number in the filter does nothing but keep it above the cascade: pushed below, it
    would expand all projections into one expression that splits each text again and again.
    """
    order = [m.rule for m in plan_cascade(docs)]
    judged = apply_cascade(docs, order, out_col="_ll_rejected_by").withColumn("_ll_stay", F.monotonically_increasing_id())
    return judged.where("_ll_rejected_by is null and _ll_stay >= 0").select(*[F.col(f"`{c}`") for c in docs.columns])


_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
OP7_SQL = rf"""
with t as (select row_number() over () as k, doc_id, coalesce(text, '') as text, {_WORDS} as w from documents),
win as (select k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
        from (select k, w, unnest(range(1, len(w) - 1)) as i from t where len(w) > 2)),
rep as (select k, i from win qualify count(*) over (partition by k, g) > 1),
cov as (select k, count(distinct j) as n from (select k, unnest([i, i + 1, i + 2]) as j from rep) group by k),
lines as (select k, l, count(*) as c from (select k, unnest(string_split(text, chr(10))) as l from t)
          where regexp_matches(l, '[^\x20\x09-\x0D]') group by k, l),
dup as (select k, cast(sum(c - 1) as bigint) as n from lines group by k),
b as (select t.*, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
        cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        coalesce(dup.n, 0) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words
      from t left join dup using (k) left join cov using (k))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 100 * n_symbols > 50 * n_words
    or word_chars < 2 * n_words or word_chars > 25 * n_words
    or (n_dup_lines >= 3 and 100 * n_dup_lines > 40 * len(string_split(text, chr(10))))
    or 100 * length(regexp_replace(text, '\p{{L}}+', '', 'g')) > 75 * length(text)) as kept
from b
"""
