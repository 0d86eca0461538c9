"""Business records and truth derived from the test tables, as frames and as SQL common table expressions.

Records A come from ``documents``: words 1-6 of a text are a name, 7-18 an address, its language
a country, and the id modulo 3 the source. Records B come from ``customer`` and ``supplier``.
True matches are pairs of a source-1 and a pool record of one country whose whole texts
have 3-word shingle sets with a similarity of 0.6 or more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import ADDRESS_WORDS, LEGAL_FORMS, add_normalized, cleaned
from linkloom.operators.setjoin import jaccard_pairs, word_shingles
from linkloom.runtime import discard, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A text's first 20 words as they are written. Lower case can part a word (a capital with a dot), never join two, so 18 cleaned words are within.
LEAD = r"(?U)^(?:[^\p{L}\p{N}_]*[\p{L}\p{N}_]+){0,20}"


def words_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first words of each document, 18 at least where there are so many."""
    entity = F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select(entity.alias("entity_id"), (F.col("doc_id") % 3).cast("int").alias("src"), F.col("lang").alias("country"), F.split(cleaned(F.regexp_extract("text", LEAD, 0)), " ").alias("w"))


def records_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    return words_a(spark, sf_dir).select("entity_id", "src", part(1, 6).alias("business_name"), part(7, 12).alias("business_address"), "country")


def sources_a(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    df = add_normalized(records_a(spark, sf_dir))
    return tuple(df.where(F.col("src") == i).drop("src") for i in range(3))


def records_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    plot = lambda k, seg: F.concat(F.lit("Plot "), (F.col(k) % 97).cast("string"), F.lit(", Unit "), (F.col(k) % 13).cast("string"), F.lit(" "), seg, F.lit(" Rd."))
    c = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("entity_id"), (F.col("c_custkey") % 2).cast("int").alias("src"), F.col("c_name").alias("business_name"),
        plot("c_custkey", F.col("c_mktsegment")).alias("business_address"), F.col("n_name").alias("country"),
    )
    s = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("P-"), F.col("s_suppkey").cast("string")).alias("entity_id"), F.lit(2).alias("src"), F.col("s_name").alias("business_name"),
        plot("s_suppkey", F.lit("")).alias("business_address"), F.col("n_name").alias("country"),
    )
    return c.unionByName(s)


def truth_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source1_entity_id, candidate_entity_id); shingles meet as 64-bit hashes."""
    docs = table(spark, sf_dir, "documents").where("lang is not null")
    texts = written(docs.select(F.col("doc_id").cast("long").alias("id"), (F.col("doc_id") % 3 == 0).alias("lhs"), F.col("lang").alias("group"), cleaned(F.col("text")).alias("text")), "texts", "zstd")
    found = jaccard_pairs(texts, 3, 5, word_shingles(3))
    discard(texts)
    entity = lambda c: F.concat(F.lit("S"), (F.col(c) % 3 + 1).cast("string"), F.lit("-"), F.col(c).cast("string"))
    return found.select(entity("left_id").alias("source1_entity_id"), entity("right_id").alias("candidate_entity_id"))


def _expand_sql(x: str, words: dict[str, str]) -> str:
    cases = " ".join(f"when '{k}' then '{v}'" for k, v in words.items())
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda t: case t {cases} else t end), ' ')"


def clean_sql(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


#: Each needs those above it.
SQL = {
    "w": f"select 'S' || (doc_id % 3 + 1) || '-' || doc_id as entity_id, cast(doc_id % 3 as integer) as src, lang as country, string_split({clean_sql('text')}, ' ') as w from documents",
    "ent": "select entity_id, src, array_to_string(w[1:6], ' ') as business_name, array_to_string(w[7:18], ' ') as business_address, country from w",
    "nrm": f"select *, {_expand_sql(clean_sql('business_name'), LEGAL_FORMS)} as name_norm, {_expand_sql(clean_sql('business_address'), ADDRESS_WORDS)} as addr_norm from ent",
    "keys": """select country, src, entity_id, 'name' as signal, unnest(list_filter(string_split(name_norm, ' '), lambda t: length(t) >= 3)) as key from nrm
        union all select country, src, entity_id, 'address', unnest(list_filter(string_split(addr_norm, ' '), lambda t: length(t) >= 3)) from nrm
        union all select country, src, entity_id, 'prefix', unnest(list_transform(list_filter(string_split(name_norm, ' '), lambda t: length(t) >= 5), lambda t: t[1:4])) from nrm""",
    "npool": "select country, count(*) as n_pool from nrm where src > 0 group by country",
    "wt": "select country, signal, key, count(*) as df, ln((any_value(n_pool) + 1.0) / (count(*) + 1.0)) + 1.0 as idf from keys join npool using (country) where src > 0 group by country, signal, key",
    "sig": """select signal, a.entity_id as source1_entity_id, b.entity_id as candidate_entity_id, sum(idf) as score
        from keys a join keys b using (country, signal, key) join wt using (country, signal, key) where a.src = 0 and b.src > 0 and df <= 2500 group by all""",
    "ps": """select source1_entity_id, candidate_entity_id, coalesce(n.score, 0) as name_idf_score, coalesce(a.score, 0) as address_idf_score, coalesce(p.score, 0) as prefix_idf_score
        from (select * from sig where signal = 'name') n full join (select * from sig where signal = 'address') a using (source1_entity_id, candidate_entity_id)
        full join (select * from sig where signal = 'prefix') p using (source1_entity_id, candidate_entity_id)""",
    "cand": """select source1_entity_id, candidate_entity_id, round(name_idf_score, 6) as name_idf_score, round(address_idf_score, 6) as address_idf_score,
        round(prefix_idf_score, 6) as prefix_idf_score, total_block_score, rn - 1 as candidate_rank
        from (select *, row_number() over (partition by source1_entity_id order by total_block_score desc, candidate_entity_id) as rn
          from (select *, round(1.5 * name_idf_score + 1.5 * address_idf_score + prefix_idf_score, 6) as total_block_score from ps)) where rn <= 50""",
    "gram": "select entity_id, src, country, unnest(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as g from w where len(w) > 2",
    "gn": "select entity_id, count(*) as n from gram group by entity_id",
    "truth": """select a.entity_id as source1_entity_id, b.entity_id as candidate_entity_id from gram a join gram b using (country, g) join gn na on na.entity_id = a.entity_id
        join gn nb on nb.entity_id = b.entity_id where a.src = 0 and b.src > 0 group by a.entity_id, b.entity_id, na.n, nb.n having count(*) >= 0.6 * (na.n + nb.n - count(*))""",
    "lab": "select cand.*, cast(truth.source1_entity_id is not null as integer) as label from cand left join truth using (source1_entity_id, candidate_entity_id)",
    "sco": "select *, round(1 / (1 + exp(-(0.06 * total_block_score - 0.25 * candidate_rank - 3.0))), 6) as proba from lab",
    "ents": "select distinct source1_entity_id from cand",
    "b": """select 'C-' || c_custkey as entity_id, cast(c_custkey % 2 as integer) as src, c_name as business_name,
        'Plot ' || (c_custkey % 97) || ', Unit ' || (c_custkey % 13) || ' ' || c_mktsegment || ' Rd.' as business_address, n_name as country from customer join nation on c_nationkey = n_nationkey
        union all select 'P-' || s_suppkey, 2, s_name, 'Plot ' || (s_suppkey % 97) || ', Unit ' || (s_suppkey % 13) || '  Rd.', n_name from supplier join nation on s_nationkey = n_nationkey""",
    "bp": """select a.entity_id as a_id, b.entity_id as b_id, a.business_name as a_name, b.business_name as b_name, a.business_address as a_addr, b.business_address as b_addr,
        a.country as a_country, b.country as b_country from b a join b b on a.country = b.country and a.src = 0 and b.src = 2""",
}
_A = ["w", "ent", "nrm", "keys", "npool", "wt", "sig", "ps", "cand", "gram", "gn", "truth", "lab", "sco", "ents"]


def with_sql(upto: str, query: str) -> str:
    """``query`` after the expressions that ``upto`` needs."""
    names = ["b", "bp"][: 1 + (upto == "bp")] if upto in ("b", "bp") else _A[: _A.index(upto) + 1]
    return "with " + ",\n".join(f"{n} as ({SQL[n]})" for n in names) + "\n" + query
