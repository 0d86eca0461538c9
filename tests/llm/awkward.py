"""Small tables with every awkward row: nulls, empties, repeats, ties, long texts, clashing columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, slot int, node long, w array<string>, h long, bucket int, part int, rank long, maybe boolean, words string"
CLASH = (7, 7, 7, ["x"], 7, 7, 7, 7, True, "w")


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def rows(seed=1):
    rng = random.Random(seed)
    base = sentence(rng, 80)
    edited = base.split()
    edited[40] = "zzz"
    long = sentence(rng, 30000)
    texts = [
        (1, base), (2, base + "\n"), (3, base.upper()), (4, " ".join(edited)), (4, " ".join(edited)), (5, None), (6, ""), (7, " \t\n\x0b\r\f"), (8, "one two three"), (9, "one two three"),
        (10, "one two three four"), (11, long), (12, long + " tail"), (None, base), (None, sentence(rng, 60)), (13, "line a\nline a\nline a\n" * 30), (14, "x y z " * 40), (15, "é" * 300),
        (16, "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" and card 4785380592391139"), (17, "# $ % & | " * 40), (17, base), (18, "don't <|endoftext|> 漢字 　 x  \n\n y"), (19, sentence(rng, 55) + " end"),
    ]
    lang = ["de", "en", None, "fr"]
    source = ["s1", "s1", None, "b", "a", "s1"]
    return [(i, t, lang[k % 4], source[k % 6], None if t is None else len(t), *CLASH) for k, (i, t) in enumerate(texts)]


def write(spark, path, table=None):
    """The path of a folder with a ``documents`` table; one row a file, or an empty table."""
    data = rows() if table is None else table
    df = spark.createDataFrame(data, SCHEMA)
    df.repartition(3).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return str(path)


def collect(df):
    return [r.asDict() for r in df.collect()]


def total(df, column):
    return df.agg(F.sum(column)).first()[0]
