"""Small tables with every awkward case, and brute-force versions of what contracts ask for."""

import random
import zlib

CLASHING = ("row", "size", "score", "part", "fp", "kept", "ids", "shard", "n", "at", "c0", "id", "lang_pred", "rank")


def words(rng, n, lang="en"):
    syllables = {"en": "the ing er on th re", "fr": "eau oux ai le é", "de": "sch ung ein ß"}[lang].split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(spark, n=60, empty=False):
    """Nulls in every column, empty and very long texts, repeated rows and ids, copies, clashing columns."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "fr", "de"])
        rows.append((i, words(rng, rng.randint(1, 300), lang), lang, f"s{i % 4}"))
    long = words(rng, 30_000)
    rows += [(100, None, None, None), (101, "", "en", None), (102, " \n\t", "en", "s0"), (103, long, "en", "s1"),
             (None, rows[3][1], None, "s1"), (None, rows[3][1], None, "s1"), (5, rows[5][1], "fr", "s1"),
             (105, rows[7][1] + " tail", "en", "é"), (106, rows[7][1], "en", ""), (107, "12 34 % 日本語 \U0001F600", None, "s3"),
             (108, "one two", "en", "s3"), (109, "a  b   c \n d ", "en", "s3"), (110, "\n".join(["same line here"] * 80), "en", "s3"),
             (111, "nul\x00 byte", "en", "s2"), (-7, "below zero", "en", "s2")]
    rows = [] if empty else [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    from pyspark.sql import functions as F
    return df.repartition(3).select("*", *(F.lit("x").alias(c) for c in CLASHING))


def stored(df, tmp, name):
    """As the driver gives tables: read from Parquet."""
    path = f"{tmp}/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def split(text):
    return (text or "").encode().lower().split()


def crc_mod(i, m):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m
