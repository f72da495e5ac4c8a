"""Small tables with everything that is awkward, shared by the operators' tests."""

import random

from pyspark.sql import functions as F

SF0001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["fp", "key", "row_key", "shard", "size", "rank", "slice", "start", "spans", "kind", "score", "label", "ids", "n",
            "bucket", "secret_spans", "component_id", "host", "token", "number", "positions", "copies", "anomaly", "mask", "root"]


def prose(n, seed=0, words=("lorem", "ipsum", "dolor", "sit", "amet", "consectetur", "Été", "façade", "ñandú", "Straße")):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        out.append(rng.choice(words) + str(rng.randrange(40)) + ("." if i % 9 == 8 else "") + ("\n" if i % 17 == 16 else ""))
    return " ".join(out)


def awkward_rows():
    long = prose(30_000, 5)
    return [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 4), (4, "one", "en", "b", 3),
        (5, "One", "en", "b", 3), (6, prose(60, 1), "fr", "a", None), (7, prose(60, 1), "fr", "c", 1), (7, prose(60, 1), "fr", "c", 1),
        (8, prose(60, 1) + " tail", "fr", "c", 1), (9, long, "en", "a", 9), (10, long + " and more", "en", None, 9),
        (None, prose(40, 2), "de", "b", 7), (None, None, None, None, None), (11, "x" * 5000, "en", "a", 1),
        (12, "le " * 400, "fr", "a", 1), (13, "\U0001f600 emoji 你好 世界 " + prose(20, 3), "zh", "d", 1), (14, "a\x0bb\x0cc\rd\x1ce\xa0f", "en", "d", 1),
    ]


def awkward(spark, clash=True, rows=None):
    df = spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)
    if clash:
        for i, c in enumerate(CLASHING):
            df = df.withColumn(c, F.lit(i if i % 2 else f"x{i}"))
    return df


def empty(spark):
    return awkward(spark, rows=[])


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def collected(df):
    return [r.asDict() for r in df.collect()]
