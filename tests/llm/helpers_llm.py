"""Fixtures and brute-force versions shared by the training-data tests."""

import re

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
CLASH = ["digest", "row", "keep_id", "kept", "content", "node", "comp", "n", "a", "b", "y", "score", "block", "payload", "passage", "_drop_id"]


def docs_of(spark, rows, clash=False):
    """rows of (doc_id, text); with clash, further columns named like the operators' own."""
    df = spark.createDataFrame(rows, DOCS)
    if clash:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit("x") for c in CLASH})
    return df


def stored(df, path):
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def shingle_set(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def least_reachable(ids, links):
    low = {i: i for i in ids}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
