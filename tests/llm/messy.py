"""Documents with every awkward case: null and empty texts, ties, repeated rows, long texts, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLASHES = ["id", "key", "row", "h", "n", "x", "y", "a", "b", "v", "c", "sha", "size", "slice", "turn", "label", "place",
           "lost", "rep", "root", "node", "taken", "kept", "_id", "_at", "found", "gone", "r"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

EN = "the of and to in that was with for are this have from they which one were all there would been".split()
DE = "der die und das ist nicht ein zu mit sich auf für wir über können müssen schön größe weiß straße".split()


def prose(rng: random.Random, words: list[str], n: int) -> str:
    out = []
    for k in range(n):
        out.append(rng.choice(words) + rng.choice(["", "", rng.choice(words)]) + rng.choice(["", "", ".", ","]))
        if k % 12 == 11:
            out.append("\n")
    return " ".join(out)


def rows(seed: int = 7) -> list[tuple]:
    rng = random.Random(seed)
    base = [(k, prose(rng, EN if k % 3 else DE, rng.randint(1, 160)), "en" if k % 3 else "de", f"s{k % 4}") for k in range(60)]
    line = "This very line stands in many of these documents, more or less"
    base += [(100 + k, f"{prose(rng, EN, 30)}\n  {line.upper() if k % 2 else line}\t\n{prose(rng, EN, 9)}\n{line}", "en", "s0")
             for k in range(5)]
    source = prose(rng, EN, 90)
    base += [(200 + k, source, "en", "s1") for k in range(4)]
    base += [(210, source.upper(), "en", "s2"), (211, source + " tail", None, None), (212, "head " + source, "en", None)]
    long = prose(rng, DE, 30_000)
    base += [(300, long, "de", "s3"), (301, None, "en", "s0"), (302, "", "en", "s0"), (303, " \t\n\r ", None, "s1"),
             (304, "12345 ... 67 !", "en", "s1"), (305, "ÄÖÜ ß É", "de", "s1"), (306, "a", "en", "s2"),
             (307, "a b c d", "en", "s2"), (308, "A b C d", "en", "s2"), (309, "\n\n\n", "en", ""),
             (310, "x" * 900, "en", "s2"), (311, "x" * 901, "en", "s2"),
             (None, "no id at all but some words in this text", "en", "s3"), (None, None, None, None)]
    base += [base[3], base[3], base[61]]                      # whole rows repeated
    return [(*r, len(r[1] or "")) for r in base]


def documents(spark: SparkSession, data: list[tuple] | None = None) -> DataFrame:
    """With further columns whose names the operators might use themselves."""
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


def labels(spark: SparkSession) -> DataFrame:
    data = [(r[0], int(r[0] % 4 > 0), int(r[0] % 7 == 0)) for r in rows() if r[0] is not None and r[0] < 300]
    data += [(None, 1, 1), (1, None, None), (99_999, 1, 0)]
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int").withColumn("id", F.lit("own"))
