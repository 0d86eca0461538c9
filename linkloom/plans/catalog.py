"""Registered queries, each an operator of the engine over a whole table, with its SQL twin.

``QUERIES`` maps a name to (function of (spark, sf_dir), SQL or None). Scores are rounded to six
decimals in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.functions import similarity as sim
from linkloom.functions import text as tx
from linkloom.operators import blocking as bl
from linkloom.operators import features as ft
from linkloom.operators import metrics as mt
from linkloom.operators import model as md
from linkloom.operators import sampling as sp
from linkloom.plans import fixtures as fx
from linkloom.plans.fixtures import with_sql
from linkloom.plans.pipelines import match_lists
from linkloom.runtime import written
from linkloom.sources.readers import erase_na

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
S1, C = "source1_entity_id", "candidate_entity_id"
#: Parts in which a nation's addresses of source 1 are dealt out.
PARTS = 16


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in QUERIES.items() if s is not None}


def r6(*names: str):
    return {c: F.round(F.col(c).cast("double"), 6) for c in names}


def norm_a(spark, d) -> DataFrame:
    return tx.add_normalized(fx.records_a(spark, d))


def split_a(spark, d):
    df = norm_a(spark, d)
    return df.where("src = 0").drop("src"), df.where("src > 0").drop("src")


def candidates(spark, d) -> DataFrame:
    return bl.build_candidates(*fx.sources_a(spark, d))


def truth_table(spark, d) -> DataFrame:
    return written(fx.truth_a(spark, d), "truth")


def scored(spark, d, truth: DataFrame | None = None) -> DataFrame:
    """Labelled candidates with the fixed logistic scorer."""
    lab = sp.label(candidates(spark, d), fx.truth_a(spark, d) if truth is None else truth)
    return md.linear_scorer(lab, {"total_block_score": 0.06, "candidate_rank": -0.25}, -3.0).withColumn("proba", F.round("proba", 6))


def pairs_b(spark, d) -> DataFrame:
    """Source-1 and supplier records of one nation, side by side."""
    b = fx.records_b(spark, d)
    side = lambda n: [F.col("entity_id").alias(f"{n}_id"), F.col("business_name").alias(f"{n}_name"), F.col("business_address").alias(f"{n}_addr"), F.col("country")]
    x, y = b.where("src = 0").select(*side("a")), b.where("src = 2").select(*side("b"))
    return x.join(y, "country").withColumns({"a_country": F.col("country"), "b_country": F.col("country")}).drop("country")


def by_address(spark, d, values, side=lambda a: a) -> DataFrame:
    """``pairs_b`` with ``values`` of both addresses, computed once for each pair of different ones of a nation.

    ``side`` is what they take of an address, computed once for each of a nation.
    """
    b = fx.records_b(spark, d).groupBy("country", "src", "business_address").agg(F.collect_list("entity_id").alias("ids"))
    of = lambda src, n: b.where(F.col("src") == src).select("country", F.col("ids").alias(f"{n}_ids"), side(F.col("business_address")).alias(f"{n}_addr"), F.col("business_address").alias("at"))
    # few bytes make many pairs: dealt out by number, or they would be put together in one task
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left = of(0, "a").withColumn("part", F.pmod(F.xxhash64("at"), F.lit(PARTS)).cast("int")).drop("at").repartition(tasks, "country", "part")
    right = of(2, "b").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).drop("at").repartition(tasks, "country", "part")
    x = left.join(right, ["country", "part"])
    x = x.select("a_ids", "b_ids", *[F.round(v.cast("double"), 6).alias(k) for k, v in values(F.col("a_addr"), F.col("b_addr")).items()])
    names = x.columns[2:]
    return x.select(F.explode("a_ids").alias("a_id"), "b_ids", *names).select("a_id", F.explode("b_ids").alias("b_id"), *names)


# --- scans and projections -----------------------------------------------------------------


@query("select c_custkey, case when c_mktsegment = 'BUILDING' or c_mktsegment = 'MACHINERY' then '' else c_mktsegment end as segment from customer")
def sc2_na_erasure(spark, d):
    df = fx.table(spark, d, "customer").select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", "NA").when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("segment"))
    return erase_na(df)


@query(with_sql("ent", "select entity_id, src, business_name, business_address, country from ent"))
def p1_source_records(spark, d):
    return fx.records_a(spark, d)


@query(with_sql("nrm", "select entity_id, unnest(list_filter(string_split(name_norm, ' '), lambda t: length(t) >= 3)) as key from nrm"))
def p6_exploded_keys(spark, d):
    return norm_a(spark, d).select("entity_id", F.explode(tx.tokens(F.col("name_norm"))).alias("key"))


TRUTH_CELLS = "select source1_entity_id, ' ' || string_agg(candidate_entity_id, ' , ' order by candidate_entity_id) || ', ' as matched_entity_ids from truth group by source1_entity_id"


def truth_cells(spark, d) -> DataFrame:
    ids = F.array_join(F.array_sort(F.collect_list(C)), " , ")
    return fx.truth_a(spark, d).groupBy(S1).agg(F.concat(F.lit(" "), ids, F.lit(", ")).alias("matched_entity_ids"))


@query(with_sql("truth", "select source1_entity_id, candidate_entity_id from truth"))
def p7_truth_parse(spark, d):
    return sp.parse_truth(truth_cells(spark, d))


@query(with_sql("ps", "select source1_entity_id, candidate_entity_id, round(1.5 * name_idf_score + 1.5 * address_idf_score + prefix_idf_score, 6) as total from ps"))
def p3_weighted_total(spark, d):
    total = F.round(1.5 * F.col("name_idf_score") + 1.5 * F.col("address_idf_score") + F.col("prefix_idf_score"), 6)
    return bl.pair_scores(*split_a(spark, d), 2500).select(S1, C, total.alias("total"))


@query(with_sql("ent", "select country, count(*) as n from ent where country = 'en' group by country"))
def f1_country_filter(spark, d):
    return fx.records_a(spark, d).where(F.col("country") == "en").groupBy("country").agg(F.count(F.lit(1)).alias("n"))


@query(with_sql("truth", "select cast(count(*) filter (where t.source1_entity_id is not null) as bigint) as with_match, cast(count(*) filter (where t.source1_entity_id is null) as bigint) as single from (select entity_id from ent where src = 0) e left join (select distinct source1_entity_id from truth) t on e.entity_id = t.source1_entity_id"))
def f13_has_match(spark, d):
    s1 = fx.records_a(spark, d).where("src = 0").select(F.col("entity_id").alias(S1))
    cells = s1.join(truth_cells(spark, d), S1, "left").na.fill("")
    has = F.trim("matched_entity_ids") != ""
    return cells.agg(F.count_if(has).alias("with_match"), F.count_if(~has).alias("single"))


# --- normalization, tokens, addresses --------------------------------------------------------


@query(rf"select doc_id, {fx.clean_sql('text')} as cleaned from documents")
def n2_cleaned_text(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", tx.cleaned(F.col("text")).alias("cleaned"))


NAMES_B = "select c_custkey, c_name || case c_custkey % 7 when 0 then ' Pvt. Ltd.' when 1 then ' & Co., LLC' when 2 then ' Corp' when 3 then ' inc.' when 4 then '-LLP' when 5 then ' Ltd & Inc' else ' Stcorp' end as x from customer"


def names_b(spark, d):
    suffix = F.element_at(F.array(*map(F.lit, [" Pvt. Ltd.", " & Co., LLC", " Corp", " inc.", "-LLP", " Ltd & Inc", " Stcorp"])), (F.col("c_custkey") % 7 + 1).cast("int"))
    return fx.table(spark, d, "customer").select("c_custkey", F.concat("c_name", suffix).alias("x"))


@query(f"select c_custkey, {fx._expand_sql(fx.clean_sql('x'), tx.LEGAL_FORMS)} as name_norm from ({NAMES_B})")
def n3_legal_forms(spark, d):
    return names_b(spark, d).select("c_custkey", tx.normalize(F.col("x"), tx.LEGAL_FORMS).alias("name_norm"))


@query(with_sql("b", f"select entity_id, {fx._expand_sql(fx.clean_sql('business_address'), tx.ADDRESS_WORDS)} as addr_norm from b"))
def n4_address_words(spark, d):
    return fx.records_b(spark, d).select("entity_id", tx.normalize(F.col("business_address"), tx.ADDRESS_WORDS).alias("addr_norm"))


@query(f"select c_custkey, trim(regexp_replace(regexp_replace(regexp_replace({fx.clean_sql('x')}, 'l(l)?[cp]', 'form', 'g'), 'customer', ' client ', 'g'), '\\s+', ' ', 'g')) as y from ({NAMES_B})")
def n5_patterns(spark, d):
    return names_b(spark, d).select("c_custkey", tx.normalize(F.col("x"), patterns={"l(l)?[cp]": "form", "customer": "client"}).alias("y"))


@query(with_sql("nrm", "select entity_id, name_norm, addr_norm from nrm"))
def n8_normalized_columns(spark, d):
    return norm_a(spark, d).select("entity_id", "name_norm", "addr_norm")


@query(with_sql("nrm", "select entity_id, array_to_string(list_filter(string_split(addr_norm, ' '), lambda t: length(t) >= 3), '|') as toks from nrm"))
def k1_tokens(spark, d):
    return norm_a(spark, d).select("entity_id", F.array_join(tx.tokens(F.col("addr_norm")), "|").alias("toks"))


@query(with_sql("nrm", "select entity_id, array_to_string(list_transform(list_filter(string_split(name_norm, ' '), lambda t: length(t) >= 5), lambda t: t[1:4]), '|') as pre from nrm"))
def k2_prefixes(spark, d):
    return norm_a(spark, d).select("entity_id", F.array_join(tx.prefixes(F.col("name_norm")), "|").alias("pre"))


_UNITS = "list_distinct(regexp_extract_all(trim(lower(business_address)), '\\b(?:unit|suite|ste|gala|plot|villa|flat|block|door|shop|room|floor|apt|apartment|no)\\b\\s*[:.#/-]?\\s*([a-z0-9/-]+)', 1))"
_CLEAN_UNITS = f"list_distinct(list_filter(list_transform({_UNITS}, lambda u: trim(regexp_replace(u, '^(?:no|#|[:.-])+', ''))), lambda u: u <> ''))"
_NUMBERS = "list_distinct(regexp_extract_all(trim(lower(business_address)), '\\b\\d+[a-z]?(?:[/-]\\d+[a-z]?)?\\b'))"


@query(with_sql("b", f"select entity_id, array_to_string(list_sort({_UNITS}), '|') as units from b"))
def x1_raw_units(spark, d):
    return fx.records_b(spark, d).select("entity_id", F.array_join(F.array_sort(tx.raw_units(F.col("business_address"))), "|").alias("units"))


@query(with_sql("b", f"select entity_id, array_to_string(list_sort({_CLEAN_UNITS}), '|') as units from b"))
def x2_units(spark, d):
    return fx.records_b(spark, d).select("entity_id", F.array_join(F.array_sort(tx.units(F.col("business_address"))), "|").alias("units"))


@query(with_sql("b", f"select entity_id, array_to_string(list_sort({_NUMBERS}), '|') as numbers, nullif(regexp_extract(trim(lower(business_address)), '\\b\\d+[a-z]?(?:[/-]\\d+[a-z]?)?\\b'), '') as first_number from b"))
def x3_x4_numbers(spark, d):
    a = F.col("business_address")
    return fx.records_b(spark, d).select("entity_id", F.array_join(F.array_sort(tx.numbers(a)), "|").alias("numbers"), tx.first_number(a).alias("first_number"))


# --- blocking --------------------------------------------------------------------------------


@query(with_sql("wt", "select country, signal, key, cast(df as bigint) as df, round(idf, 6) as idf from wt"))
def a2_a4_idf_weights(spark, d):
    _, pool = split_a(spark, d)
    return bl.weights(pool, bl.postings(pool), None).withColumns(r6("idf"))


@query(with_sql("wt", "select country, signal, key from wt where df > 20"))
def f2_stop_keys(spark, d):
    _, pool = split_a(spark, d)
    p = bl.postings(pool)
    all_keys = p.select("country", "signal", "key").distinct()
    return all_keys.join(bl.weights(pool, p, 20), ["country", "signal", "key"], "left_anti")


def _signal(name: str):
    def f(spark, d):
        return bl.signal_scores(*split_a(spark, d), name).withColumns(r6("score"))

    f.__name__ = f"j1_a1_signal_{name}"
    return query(with_sql("sig", f"select source1_entity_id, candidate_entity_id, round(score, 6) as score from sig where signal = '{name}'"))(f)


for _name in bl.SIGNALS:
    _signal(_name)


@query(with_sql("ps", "select source1_entity_id, candidate_entity_id, round(name_idf_score, 6) as name_idf_score, round(address_idf_score, 6) as address_idf_score, round(prefix_idf_score, 6) as prefix_idf_score from ps"))
def j3_outer_stitch(spark, d):
    return bl.stitched(*split_a(spark, d)).withColumns(r6(*bl.SCORES.values()))


_CAND = ", ".join(bl.CANDIDATE_COLUMNS)


@query(with_sql("cand", f"select {_CAND} from cand"))
def c3_build_candidates(spark, d):
    return candidates(spark, d)


@query(with_sql("cand", f"select {_CAND} from cand join ent on source1_entity_id = entity_id where country = 'de'"))
def c2_candidates_of_country(spark, d):
    return bl.build_candidates_for_country(*fx.sources_a(spark, d), "de")


@query(with_sql("cand", "select source1_entity_id, candidate_entity_id from cand where candidate_rank < 5"))
def w1_t2_top_5(spark, d):
    return bl.build_candidates(*fx.sources_a(spark, d), bl.BlockingConfig(k=5), return_metadata=False)


@query(with_sql("cand", "select entity_id as source1_entity_id, coalesce(string_agg(candidate_entity_id, ',' order by candidate_rank), '') as candidate_entity_ids from (select entity_id from ent where src = 0) left join cand on entity_id = source1_entity_id group by entity_id"))
def a6_j8_candidate_lists(spark, d):
    s1, s2, s3 = fx.sources_a(spark, d)
    return bl.candidate_lists(bl.build_candidates(s1, s2, s3), s1)


@query(with_sql("cand", "select count(distinct source1_entity_id) as records, count(*) as pairs from cand"))
def a5_a19_counts(spark, d):
    return candidates(spark, d).agg(F.countDistinct(S1).alias("records"), F.count(F.lit(1)).alias("pairs"))


_CHUNKS = """, n as (select entity_id, country, row_number() over (partition by country order by entity_id) as rn from ent where src = 0),
p as (select country, cast(ceil(count(*) / 40.0) as bigint) as c from n group by country),
f as (select country, coalesce(sum(c) over (order by country rows between unbounded preceding and 1 preceding), 0) as first_chunk from p)
select country, entity_id, cast(first_chunk + floor((rn - 1) / 40.0) as bigint) as chunk_id, cast((first_chunk + floor((rn - 1) / 40.0)) % 3 as bigint) as machine_id
from n join f using (country) where country in (select country from ent where src > 0)"""


@query("with " + ", ".join(f"{n} as ({fx.SQL[n]})" for n in ("w", "ent")) + _CHUNKS)
def r6_r7_chunks(spark, d):
    s1, pool = split_a(spark, d)
    return bl.chunks(s1, pool, 40, 3)


# --- joins and sets --------------------------------------------------------------------------


@query(with_sql("cand", "select source1_entity_id, candidate_entity_id, a.business_name as a_name, b.business_name as b_name from cand join ent a on a.entity_id = source1_entity_id join ent b on b.entity_id = candidate_entity_id"))
def j4_record_lookup(spark, d):
    s1, s2, s3 = fx.sources_a(spark, d)
    both = ft.with_records(bl.build_candidates(s1, s2, s3).select(S1, C), s1, bl.pool_of(s2, s3))
    return both.select(S1, C, F.col("a.business_name").alias("a_name"), F.col("b.business_name").alias("b_name"))


@query(with_sql("cand", "select entity_id from ent where entity_id in (select candidate_entity_id from cand)"))
def j5_needed_pool(spark, d):
    return fx.records_a(spark, d).select("entity_id").join(candidates(spark, d).select(F.col(C).alias("entity_id")), "entity_id", "left_semi")


@query(with_sql("cand", "select entity_id from ent where src > 0 and entity_id not in (select candidate_entity_id from cand)"))
def j6_pool_without_candidate(spark, d):
    return fx.records_a(spark, d).where("src > 0").select("entity_id").join(candidates(spark, d).select(F.col(C).alias("entity_id")), "entity_id", "left_anti")


@query(with_sql("lab", "select source1_entity_id, candidate_entity_id, label from lab"))
def j7_labels(spark, d):
    return sp.label(candidates(spark, d), fx.truth_a(spark, d)).select(S1, C, "label")


@query(with_sql("ent", "select entity_id, business_name from ent where src = 1 union all select entity_id, business_name from ent where src = 2"))
def u1_pool_union(spark, d):
    _, s2, s3 = fx.sources_a(spark, d)
    return bl.pool_of(s2, s3).select("entity_id", "business_name")


@query(with_sql("ent", "select business_name as entity_id, min_by(entity_id, src * 1000000000 + cast(split_part(entity_id, '-', 2) as bigint)) as first_record from ent where src > 0 group by business_name"))
def a10_first_of_equal_keys(spark, d):
    pool = fx.records_a(spark, d).where("src > 0").select(F.col("business_name").alias("entity_id"), F.col("entity_id").alias("first_record"), "src")
    return ft.first_by_id(pool, ["src", F.split("first_record", "-")[1].cast("long")]).select("entity_id", "first_record")


@query(with_sql("truth", "select source1_entity_id, candidate_entity_id from truth intersect select source1_entity_id, candidate_entity_id from cand"))
def u5_found_pairs(spark, d):
    return fx.truth_a(spark, d).intersect(candidates(spark, d).select(S1, C))


@query(with_sql("truth", "select source1_entity_id, candidate_entity_id from truth except select source1_entity_id, candidate_entity_id from cand"))
def u6_missed_pairs(spark, d):
    return fx.truth_a(spark, d).exceptAll(candidates(spark, d).select(S1, C))


@query(with_sql("cand", "select distinct country from ent where src = 0"))
def a9_countries(spark, d):
    return fx.records_a(spark, d).where("src = 0").select("country").distinct()


@query(with_sql("truth", "select source1_entity_id, string_agg(candidate_entity_id, ',' order by candidate_entity_id) as ids, count(*) as n from truth group by source1_entity_id"))
def a7_a8_sets_by_record(spark, d):
    return fx.truth_a(spark, d).groupBy(S1).agg(F.array_join(F.array_sort(F.collect_set(C)), ",").alias("ids"), F.count(F.lit(1)).alias("n"))


@query(with_sql("truth", """select f.found, t.true_pairs, c.candidates, c.with_candidates, r.records, t.true_pairs - f.found as misses, f.found / greatest(t.true_pairs, 1) as recall, c.candidates / greatest(r.records, 1) as per_record
from (select count(*) as found from truth join cand using (source1_entity_id, candidate_entity_id)) f, (select count(*) as true_pairs from truth) t,
(select count(*) as candidates, count(distinct source1_entity_id) as with_candidates from cand) c, (select count(*) as records from ent where src = 0) r"""))
def a18_blocking_summary(spark, d):
    s1, s2, s3 = fx.sources_a(spark, d)
    return mt.blocking_summary(written(bl.build_candidates(s1, s2, s3), "candidates"), fx.truth_a(spark, d), s1)


# --- pair features -----------------------------------------------------------------------------


def _measure(name: str, spark_expr, sql: str | None, once: bool = False):
    def f(spark, d):
        if once:
            return by_address(spark, d, lambda a, b: {"x": spark_expr(a, b)})
        return pairs_b(spark, d).select("a_id", "b_id", F.round(spark_expr(F.col("a_addr"), F.col("b_addr")).cast("double"), 6).alias("x"))

    f.__name__ = name
    return query(with_sql("bp", f"select a_id, b_id, round(cast({sql} as double), 6) as x from bp") if sql else None)(f)


_measure("m6_levenshtein", sim.levenshtein_share, "100.0 * (1 - levenshtein(a_addr, b_addr) / greatest(length(a_addr), length(b_addr)))", once=True)
_measure("m7_length_gap", sim.length_gap, "abs(length(a_addr) - length(b_addr))")
_measure("m8_length_gap_share", sim.length_gap_share, "abs(length(a_addr) - length(b_addr)) / greatest(length(a_addr), length(b_addr), 1)")
_measure("m9_word_gap", sim.word_gap, "abs(len(list_filter(string_split(a_addr, ' '), lambda t: t <> '')) - len(list_filter(string_split(b_addr, ' '), lambda t: t <> '')))")
_measure("m10_same_text", sim.same_text, "case when a_addr = b_addr and length(a_addr) > 0 then 1 else 0 end")
_measure("m5_jaro_winkler", sim.jaro_winkler_alone, "100 * jaro_winkler_similarity(a_addr, b_addr)", once=True)

_LCS = """with recursive p as (select x.n_name as a, y.n_name as b, string_split(x.n_name, '') as ca, string_split(y.n_name, '') as cb from nation x, nation y),
dp as (select a, b, ca, cb, 0 as i, 0 as j, 0 as v from p where false),
cells as (select a, b, i, unnest(range(1, len(cb) + 1)) as j, ca[i] as x, cb from (select *, unnest(range(1, len(ca) + 1)) as i from p)),
hit as (select a, b, i, j from cells where x = cb[j]),
chain as (select a, b, i, j, 1 as n from hit union select c.a, c.b, h.i, h.j, c.n + 1 from chain c join hit h on h.a = c.a and h.b = c.b and h.i > c.i and h.j > c.j),
l as (select a, b, max(n) as n from chain group by a, b)
select p.a, p.b, coalesce(l.n, 0) as lcs, round(200.0 * coalesce(l.n, 0) / (length(p.a) + length(p.b)), 6) as ratio from p left join l using (a, b)"""


@query(_LCS.replace("dp as (select a, b, ca, cb, 0 as i, 0 as j, 0 as v from p where false),\n", ""))
def m1_ratio(spark, d):
    n = fx.table(spark, d, "nation").select("n_name")
    both = n.select(F.col("n_name").alias("a")).crossJoin(n.select(F.col("n_name").alias("b")))  # 25 nations
    return both.select("a", "b", sim.lcs_length("a", "b").cast("int").alias("lcs"), F.round(sim.kernels("a", "b")["ratio"], 6).alias("ratio"))


#: Of ``pr`` (a_id, b_id, a, b): words in order and without repeats, what both sides share, the windows of a partial
#: ratio, and subsequences by one bit per character (62 at most) of the first text.
_TOKEN_RATIOS = r"""
w as (select *, list_filter(regexp_split_to_array(a, '\s+'), lambda t: t <> '') as wa, list_filter(regexp_split_to_array(b, '\s+'), lambda t: t <> '') as wb from pr),
d as (select *, list_sort(list_distinct(wa)) as da, list_sort(list_distinct(wb)) as db from w),
t as (select *, array_to_string(list_sort(wa), ' ') as sa, array_to_string(list_sort(wb), ' ') as sb, array_to_string(da, ' ') as ua, array_to_string(db, ' ') as ub,
    array_to_string(list_filter(da, lambda t: not list_contains(db, t)), ' ') as oa, array_to_string(list_filter(db, lambda t: not list_contains(da, t)), ' ') as ob,
    length(array_to_string(list_filter(da, lambda t: list_contains(db, t)), ' ')) as s, greatest(length(a), length(b)) / least(length(a), length(b)) as q from d),
part as (select a as x, b as y from t where q >= 1.5 union select sa, sb from t where q >= 1.5 and s = 0 union select ua, ub from t where q >= 1.5 and s = 0),
side as (select x, y, x as sh, y as lo from part where length(x) <= length(y) union select x, y, y, x from part where length(y) <= length(x)),
win as (select x, y, sh, substr(lo, i::bigint, length(sh)) as v from (select *, unnest(range(1, length(lo) - length(sh) + 2)) as i from side)
    union select x, y, sh, left(lo, i::bigint) from (select *, unnest(range(1, length(sh))) as i from side)
    union select x, y, sh, right(lo, i::bigint) from (select *, unnest(range(1, length(sh))) as i from side)),
need as (select a as x, b as y from t union select sa, sb from t union select oa, ob from t union select sh, v from win),
bits as (select x, y, (1::bigint << length(x)) - 1 as f, list_transform(string_split(y, ''), lambda c: list_sum(list_transform(range(length(x)), lambda i: case when substr(x, i + 1, 1) = c then 1::bigint << i::int else 0 end))::bigint) as m
    from need where x <> '' and y <> ''),
sub as (select x, y, length(x) - bit_count(list_reduce(m, lambda r, h: ((r + (r & h)) | (r - (r & h))) & f, f)) as n from bits),
rat as (select x, y, case when length(x) + length(y) = 0 then 100.0 else 200.0 * coalesce(n, 0) / (length(x) + length(y)) end::double as r, length(x) + length(y) - 2 * coalesce(n, 0) as gap from need left join sub using (x, y)),
best as (select win.x, win.y, max(r) as r from win join rat on rat.x = sh and rat.y = v group by all),
k as (select t.*, r0.r as plain, r1.r as token_sort, r2.gap as gap, case when s > 0 then 1 else 0 end as g,
    coalesce(p0.r, 0) as p0, case when s > 0 then 100.0 else greatest(coalesce(p1.r, 0), coalesce(p2.r, 0)) end as p1 from t
    join rat r0 on r0.x = a and r0.y = b join rat r1 on r1.x = sa and r1.y = sb join rat r2 on r2.x = oa and r2.y = ob
    left join best p0 on p0.x = a and p0.y = b left join best p1 on p1.x = sa and p1.y = sb left join best p2 on p2.x = ua and p2.y = ub),
z as (select *, case when len(da) = 0 or len(db) = 0 then 0.0 when s > 0 and (oa = '' or ob = '') then 100.0 else greatest(
    100 * (1 - gap / (2 * (s + g) + length(oa) + length(ob))),
    case when s > 0 then 100 * (1 - (1 + length(oa)) / (2 * s + 1 + length(oa))) else 0 end,
    case when s > 0 then 100 * (1 - (1 + length(ob)) / (2 * s + 1 + length(ob))) else 0 end) end as token_set from k)
select a_id, b_id, round(token_sort, 6)::double as token_sort, round(token_set, 6)::double as token_set, round(case when a = '' or b = '' then 0
    when q < 1.5 then greatest(plain, 0.95 * greatest(token_sort, token_set))
    when q <= 8 then greatest(plain, 0.9 * p0, 0.95 * 0.9 * p1) else greatest(plain, 0.6 * p0, 0.95 * 0.6 * p1) end, 6)::double as w_ratio from z"""


def token_ratios(pairs: DataFrame) -> DataFrame:
    """Token ratios of (a_id, b_id, a, b)."""
    return pairs.select("a_id", "b_id", sim.token_kernels("a", "b").alias("k")).select("a_id", "b_id", *[F.round(f"k.{x}", 6).alias(x) for x in sim.TOKEN_KERNELS])


@query(with_sql("bp", ",\npr as (select a_id, b_id, a_addr as a, b_addr as b from bp)," + _TOKEN_RATIOS))
def m2_m3_m4_token_ratios(spark, d):
    return by_address(spark, d, lambda a, b: {k: sim.token_kernels(a, b)[k] for k in sim.TOKEN_KERNELS})


@query("with pr as (select x.n_name as a_id, y.n_name as b_id, replace(lower(x.n_name), 'a', ' ') as a, lower(y.n_name) as b from nation x, nation y)," + _TOKEN_RATIOS)
def m2_m3_m4_short_names(spark, d):
    """Texts of unlike lengths, mostly without a shared word: the ways through partial ratios."""
    n = fx.table(spark, d, "nation").select("n_name")
    both = n.select(F.col("n_name").alias("a_id")).crossJoin(n.select(F.col("n_name").alias("b_id")))  # 25 nations
    return token_ratios(both.select("a_id", "b_id", F.translate(F.lower("a_id"), "a", " ").alias("a"), F.lower("b_id").alias("b")))


_UA, _UB, _NA, _NB = (x.replace("business_address", c) for x in (_CLEAN_UNITS, _NUMBERS) for c in ("a_addr", "b_addr"))
_FA, _FB = (f"nullif(regexp_extract(trim(lower({c})), '\\b\\d+[a-z]?(?:[/-]\\d+[a-z]?)?\\b'), '')" for c in ("a_addr", "b_addr"))


@query(with_sql("bp", f""", q as (select *, {_UA} as ua, {_UB} as ub, {_NA} as na, {_NB} as nb, {_FA} as fa, {_FB} as fb from bp)
select a_id, b_id, case when len(ua) > 0 and len(ub) > 0 and list_has_any(ua, ub) then 1 else 0 end::double as unit_match,
case when len(ua) > 0 and len(ub) > 0 and not list_has_any(ua, ub) then 1 else 0 end::double as unit_mismatch,
coalesce(cast(fa = fb as integer), 0)::double as first_num_match, coalesce(cast(fa <> fb as integer), 0)::double as first_num_mismatch,
len(list_intersect(na, nb))::double as num_overlap_count,
round(case when len(list_distinct(list_concat(na, nb))) > 0 then len(list_intersect(na, nb)) / len(list_distinct(list_concat(na, nb))) else 0 end, 6)::double as num_jaccard from q""").replace("\n, q as", ",\nq as"))
def x7_x10_address_features(spark, d):
    return by_address(spark, d, ft.part_features, tx.address_parts)


@query("select a.n_name as a, b.n_name as b, case when lower(trim(a.n_name)) = lower(trim(b.n_name)) then 1.0 else 0.0 end::double as country_match from nation a, nation b")
def x11_country_match(spark, d):
    n = fx.table(spark, d, "nation").select("n_name")
    both = n.select(F.col("n_name").alias("a")).crossJoin(n.select(F.col("n_name").alias("b")))  # 25 nations
    padded = ft.country_match(F.concat(F.lit(" "), F.upper("a")), F.concat(F.lower("b"), F.lit("  ")))
    return both.select("a", "b", padded.cast("double").alias("country_match"))


@query("select i, j, round(case when i = 0 or j = 0 then 0 else 1.25 * (i / 10.0) * (j / 10.0) / (0.25 * i / 10.0 + j / 10.0) end, 6)::double as f from range(0, 11) a(i), range(0, 11) b(j)")
def x15_f_beta(spark, d):
    grid = spark.range(11).select(F.col("id").alias("i")).crossJoin(spark.range(11).select(F.col("id").alias("j")))  # 121 rows
    return grid.select("i", "j", F.round(mt.f_beta(F.col("i") / 10, F.col("j") / 10), 6).alias("f"))


@query("select n_nationkey, replace(replace(replace(n_name || '/' || n_regionkey || ':x', '/', '_'), ':', '_'), chr(92), '_') as safe, 'chunk_' || lpad(cast(n_nationkey as varchar), 6, '0') as chunk from nation")
def x17_x18_names(spark, d):
    n = fx.table(spark, d, "nation")
    return n.select("n_nationkey", tx.path_safe(F.concat("n_name", F.lit("/"), F.col("n_regionkey").cast("string"), F.lit(":x"))).alias("safe"), tx.chunk_name(F.col("n_nationkey")).alias("chunk"))


@query(with_sql("cand", """, f as (select source1_entity_id, candidate_entity_id, cast(total_block_score as float) as t, cast(address_idf_score as float) as a, cast(name_idf_score as float) as n from cand),
m as (select *, max(t) over w as mt, max(a) over w as ma, max(n) over w as mn from f window w as (partition by source1_entity_id))
select source1_entity_id, candidate_entity_id, round(cast(mt - t as double), 3) as block_score_diff, round(cast(cast(cast(t as double) / greatest(cast(mt as double), 1e-4) as float) as double), 4) as block_score_ratio,
case when a = ma and ma > 0 then 1.0 else 0.0 end::double as is_best_addr, case when n = mn and mn > 0 then 1.0 else 0.0 end::double as is_best_name from m""").replace("\n, f as", ",\nf as"))
def w2_w4_relative_features(spark, d):
    c = candidates(spark, d).withColumns({x: F.col(x).cast("float") for x in ("total_block_score", "address_idf_score", "name_idf_score")})
    out = ft.relative_features(c)
    return out.select(S1, C, F.round(F.col("block_score_diff").cast("double"), 3).alias("block_score_diff"), F.round(F.col("block_score_ratio").cast("double"), 4).alias("block_score_ratio"),
                      F.col("is_best_addr").cast("double").alias("is_best_addr"), F.col("is_best_name").cast("double").alias("is_best_name"))


@query(None)
def c5_pair_features(spark, d):
    s1, s2, s3 = fx.sources_a(spark, d)
    return ft.compute_features(bl.build_candidates(s1, s2, s3, bl.BlockingConfig(k=10)), s1, s2, s3)


# --- sampling ------------------------------------------------------------------------------------

_HARD = """, r as (select *, row_number() over (partition by source1_entity_id, label order by candidate_rank, candidate_entity_id) as n from lab),
h as (select *, label = 0 and n <= 2 as hard from r),
k as (select cast(floor(sum(label) * 4.0) as bigint) - count(*) filter (where hard) as need from h),
o as (select *, row_number() over (order by md5('42|' || source1_entity_id || '|' || candidate_entity_id), source1_entity_id, candidate_entity_id) as place from h where label = 0 and not hard)
select source1_entity_id, candidate_entity_id, label from h where label = 1 or hard union all select source1_entity_id, candidate_entity_id, label from o, k where place <= need"""


@query(with_sql("lab", _HARD).replace("\n, r as", ",\nr as"))
def r1_hard_negatives(spark, d):
    return sp.sample_hard_negatives(candidates(spark, d), fx.truth_a(spark, d)).select(S1, C, "label")


@query(with_sql("ents", "select source1_entity_id, row_number() over (order by md5('42|' || source1_entity_id), source1_entity_id) <= ceil(0.2 * (select count(*) from ents)) as is_val from ents"))
def r4_grouped_split(spark, d):
    return sp.grouped_split(candidates(spark, d).select(S1)).distinct()


_STRATA = """, c as (select entity_id as source1_entity_id, entity_id in (select source1_entity_id from truth) as has_match from ent where src = 0),
o as (select *, row_number() over (partition by has_match order by md5('42|' || source1_entity_id), source1_entity_id) as place from c),
n as (select least(60, count(*) filter (where has_match)) as got from c)
select source1_entity_id, has_match from o, n where case when has_match then place <= 60 else place <= 100 - got end"""


@query(with_sql("truth", _STRATA).replace("\n, c as", ",\nc as"))
def r5_stratified_sample(spark, d):
    s1 = fx.records_a(spark, d).where("src = 0").select(F.col("entity_id").alias(S1))
    return sp.stratified_sample(s1.join(truth_cells(spark, d), S1, "left").na.fill(""), 100)


# --- metrics ---------------------------------------------------------------------------------------

_SWEEP = """, th as (select i, round(i / 100.0, 2) as threshold from range(10, 100) t(i)),
tn as (select source1_entity_id, count(*) as n_true from truth group by source1_entity_id),
pr as (select th.i, source1_entity_id, count(*) as n_pred, sum(label) as hits from sco join th on proba >= threshold group by th.i, source1_entity_id),
g as (select th.i, threshold, coalesce(n_pred, 0) as p, coalesce(hits, 0) as h, coalesce(n_true, 0) as t from th cross join ents left join pr using (i, source1_entity_id) left join tn using (source1_entity_id)),
s as (select i, threshold, case when p = 0 and t = 0 then 1.0 when p = 0 or t = 0 or h = 0 then 0.0 else 1.25 * (h / p) * (h / t) / (0.25 * h / p + h / t) end as f,
  case when p = 0 and t = 0 then 1.0 when p = 0 or t = 0 then 0.0 else h / p end as pre, case when t = 0 then 1.0 when p = 0 then 0.0 else h / t end as rec from g),
sw as (select threshold, avg(f) as macro_f, avg(pre) as precision, avg(rec) as recall from s group by i, threshold)
"""


def sweep_sql(tail: str) -> str:
    return with_sql("ents", _SWEEP + tail).replace("\n, th as", ",\nth as")


def swept(spark, d) -> DataFrame:
    t = truth_table(spark, d)
    s = written(scored(spark, d, t), "scored")
    return mt.sweep(s, t, s.select(S1).distinct())


@query(sweep_sql("select cast(threshold as double) as threshold, round(macro_f, 6) as macro_f, round(precision, 6) as precision, round(recall, 6) as recall from sw"))
def l5_threshold_sweep(spark, d):
    return swept(spark, d).withColumns(r6("macro_f", "precision", "recall"))


@query(sweep_sql("select round(macro_f, 6) as macro_f, round(precision, 6) as precision, round(recall, 6) as recall from sw where threshold = 0.5"))
def l4_macro_f(spark, d):
    t = truth_table(spark, d)
    s = written(scored(spark, d, t), "scored")
    return mt.macro_f(s, t, s.select(S1).distinct(), 0.5).withColumns(r6("macro_f", "precision", "recall"))


@query(sweep_sql("select cast(threshold as double) as threshold, round(macro_f, 6) as macro_f from sw order by round(macro_f, 9) desc, threshold limit 1"))
def a14_best_threshold(spark, d):
    return mt.best_threshold(swept(spark, d)).select("threshold", F.round("macro_f", 6).alias("macro_f"))


@query(sweep_sql("select cast(threshold as double) as threshold, round(macro_f, 6) as macro_f from sw order by round(macro_f, 9) desc, threshold limit 10"))
def t3_top_thresholds(spark, d):
    return mt.best_threshold(swept(spark, d), 10).select("threshold", F.round("macro_f", 6).alias("macro_f"))


@query(with_sql("ents", """, t as (select truth.*, s.proba from truth join ents using (source1_entity_id) left join sco s using (source1_entity_id, candidate_entity_id)),
a as (select count(*) as true_matches, count(*) filter (where proba is null) as blocking_misses, count(*) filter (where proba < 0.5) as model_misses, count(*) filter (where proba >= 0.5) as correct from t),
f as (select count(*) as false_positives from sco where proba >= 0.5 and label = 0),
g as (select count(*) as singletons, count(*) filter (where source1_entity_id in (select source1_entity_id from sco where proba >= 0.5)) as singleton_false_positives from ents where source1_entity_id not in (select source1_entity_id from truth))
select a.*, f.*, g.*, round((true_matches - blocking_misses) / greatest(true_matches, 1), 6) as blocking_recall, round(correct / greatest(true_matches - blocking_misses, 1), 6) as model_recall,
round(correct / greatest(true_matches, 1), 6) as total_recall from a, f, g""").replace("\n, t as", ",\nt as"))
def l6_attribution(spark, d):
    t = truth_table(spark, d)
    s = written(scored(spark, d, t), "scored")
    return mt.attribution(s, t, s.select(S1).distinct(), 0.5).withColumns(r6("blocking_recall", "model_recall", "total_recall"))


@query(with_sql("sco", """, s as (select proba, sum(label) as pos, count(*) as n from sco group by proba),
c as (select *, sum(pos) over (order by proba desc) as cp, sum(n) over (order by proba desc) as cn, sum(pos) over () as p, sum(n - pos) over () as q from s)
select round(sum(pos * (q - (cn - cp) + (n - pos) / 2.0)) / greatest(any_value(p) * any_value(q), 1), 6)::double as roc_auc, round(sum(pos * cp / cn) / greatest(any_value(p), 1), 6)::double as average_precision from c""").replace("\n, s as", ",\ns as"))
def a16_a17_rank_metrics(spark, d):
    return mt.rank_metrics(written(scored(spark, d), "scored")).withColumns(r6("roc_auc", "average_precision"))


@query(with_sql("sco", "select entity_id as source1_entity_id, coalesce(string_agg(candidate_entity_id, ',' order by candidate_rank) filter (where proba >= 0.5), '') as matched_entity_ids from (select entity_id from ent where src = 0) left join sco on entity_id = source1_entity_id group by entity_id"))
def sk2_match_lists(spark, d):
    return match_lists(scored(spark, d), fx.sources_a(spark, d)[0], 0.5)


@query(None)
def l1_l3_boosted_trees(spark, d):
    """Probabilities of the held-out records by trees fitted on all 36 features of the others, with the defaults of ``fit``."""
    s1, s2, s3 = fx.sources_a(spark, d)
    pairs = sp.sample_hard_negatives(bl.build_candidates(s1, s2, s3), fx.truth_a(spark, d))
    feats = written(ft.compute_features(pairs, s1, s2, s3), "features")
    split = written(sp.grouped_split(feats), "split")
    if split.where("label = 1 and not is_val").isEmpty():
        return split.where("is_val").select(S1, C, "label", F.lit(0.0).alias("proba"))
    fitted = md.fit(split, validation="is_val")
    return md.score(fitted, split.where("is_val")).select(S1, C, "label", F.round("proba", 6).alias("proba"))


@query(with_sql("ent", "select country, cast(row_number() over (order by min(cast(split_part(entity_id, '-', 2) as bigint))) as bigint) as place from ent where src = 0 group by country"))
def t6_first_appearance(spark, d):
    first = fx.records_a(spark, d).where("src = 0").groupBy("country").agg(F.min(F.split("entity_id", "-")[1].cast("long")).alias("at"))
    return first.select("country", F.row_number().over(Window.orderBy("at")).cast("long").alias("place"))  # a row per country
