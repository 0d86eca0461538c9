"""Normalization, tokens and address parsing as Column expressions; all stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Abbreviations of legal forms and of address words.
LEGAL_FORMS = {
    "pvt": "private", "ltd": "limited", "corp": "corporation", "inc": "incorporated", "co": "company",
    "llc": "limited liability company", "llp": "limited liability partnership",
}
ADDRESS_WORDS = {
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "apt": "apartment", "fl": "floor",
    "ste": "suite", "nr": "near", "opp": "opposite",
}
# Words that announce a unit, and the shape of a numeric token.
UNIT_WORDS = "unit suite ste gala plot villa flat block door shop room floor apt apartment no".split()
UNIT = rf"(?U)\b(?:{'|'.join(UNIT_WORDS)})\b\s*[:.#/-]?\s*([a-z0-9/-]+)"
NUMBER = r"(?U)\b\d+[a-z]?(?:[/-]\d+[a-z]?)?\b"
UNIT_LEAD = r"^(?:no|#|[:.-])+"


def cleaned(text: Column) -> Column:
    """Lower case, everything but letters, numbers, underscores and blanks as a blank, blanks collapsed."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]", " ")
    return F.trim(F.regexp_replace(plain, r"(?U)[\s\x1c-\x1f]+", " "))


def expand(text: Column, words: Mapping[str, str]) -> Column:
    """Whole-word replacement on cleaned text, one lookup a token."""
    table = F.create_map(*[F.lit(x) for kv in words.items() for x in kv])
    return F.array_join(F.transform(F.split(text, " "), lambda t: F.coalesce(F.element_at(table, t), t)), " ")


def normalize(text: Column, words: Mapping[str, str] | None = None, patterns: Mapping[str, str] | None = None) -> Column:
    """Cleaned text, with whole words expanded (``words``) or regular expressions applied one after the other (``patterns``)."""
    out = cleaned(text)
    if words:
        out = expand(out, words)
    if patterns:
        out = reduce(lambda c, kv: F.regexp_replace(c, *kv), patterns.items(), out)
        out = F.trim(F.regexp_replace(out, r"(?U)[\s\x1c-\x1f]+", " "))
    return out


def add_normalized(df: DataFrame) -> DataFrame:
    """Adds ``name_norm`` and ``addr_norm``; a null field counts as empty."""
    return df.withColumns({"name_norm": normalize(F.col("business_name"), LEGAL_FORMS), "addr_norm": normalize(F.col("business_address"), ADDRESS_WORDS)})


def split_words(text: Column) -> Column:
    """Words of normalized text; empty text has none."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def tokens(text: Column, min_len: int = 3) -> Column:
    return F.filter(F.split(text, " "), lambda t: F.char_length(t) >= min_len)


def prefixes(text: Column, prefix_len: int = 4, min_token_len: int = 5) -> Column:
    return F.transform(tokens(text, min_token_len), lambda t: F.left(t, F.lit(prefix_len)))


def _address(text: Column) -> Column:
    return F.trim(F.lower(F.coalesce(text, F.lit(""))))


def raw_units(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(_address(text), F.lit(UNIT), F.lit(1)))


def units(text: Column) -> Column:
    """What follows a unit word, without leading marks."""
    bare = F.transform(raw_units(text), lambda u: F.trim(F.regexp_replace(u, UNIT_LEAD, "")))
    return F.array_distinct(F.filter(bare, lambda u: u != ""))


def numbers(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(_address(text), F.lit(NUMBER), F.lit(0)))


def first_number(text: Column) -> Column:
    found = F.regexp_extract(_address(text), NUMBER, 0)
    return F.when(found != "", found)


def address_parts(text: Column) -> Column:
    return F.struct(units(text).alias("units"), numbers(text).alias("numbers"), first_number(text).alias("first_number"))


def split_ids(cell: Column) -> Column:
    """Identifiers of a comma-separated cell, trimmed, without blanks; a cell that reads ``nan`` has none."""
    cell = F.coalesce(cell, F.lit(""))
    found = F.filter(F.transform(F.split(cell, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.lower(cell) == "nan", F.array().cast("array<string>")).otherwise(found)


def path_safe(name: Column) -> Column:
    return F.regexp_replace(name, r"[/\\:]", "_")


def chunk_name(chunk_id: Column) -> Column:
    return F.concat(F.lit("chunk_"), F.lpad(chunk_id.cast("string"), 6, "0"))
