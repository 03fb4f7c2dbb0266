"""Token windows, greedy packing and chunk identity."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_starts(n: Column, size: int = 512, special: int = 2, overlap: int = 64) -> Column:
    """First token of each sliding window over n tokens; one window where the whole fits."""
    body = size - special
    step = body - overlap
    last = F.ceil((n - overlap) / step).cast("int") - 1
    return F.when(n <= body, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: k * step))


def token_windows(docs: DataFrame, size: int = 512, special: int = 2, overlap: int = 64) -> DataFrame:
    """(doc, window, begin, end) from (doc, n) with n tokens."""
    rows = docs.select("doc", "n", F.posexplode(window_starts(F.col("n"), size, special, overlap)).alias("window", "begin"))
    return rows.select("doc", "window", "begin", F.least(F.col("begin") + (size - special), "n").alias("end"))


def pack_lines(docs: DataFrame, budget: int, text: str = "text") -> DataFrame:
    """(doc, part, first, last, tokens): lines packed greedily into parts of at most ``budget`` estimated tokens.

    A line costs a quarter of its length, rounded up, and one more for its end;
    a line above the budget is a part of its own. The fold is sequential within
    a document, so it runs per row, in batches of whole documents.
    """
    kind = docs.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, body in zip(pdf["doc"], pdf["t"]):
                part, first, used = 0, 0, 0
                lines = (body or "").split("\n")
                for k, line in enumerate(lines):
                    cost = -(-len(line) // 4) + 1
                    if k > first and used + cost > budget:
                        out.append((doc, part, first, k - 1, used))
                        part, first, used = part + 1, k, 0
                    used += cost
                out.append((doc, part, first, len(lines) - 1, used))
            yield pd.DataFrame(out, columns=["doc", "part", "first", "last", "tokens"])

    return docs.select("doc", F.col(text).alias("t")).mapInPandas(run, f"doc {kind}, part int, first int, last int, tokens int")


def dedup_text(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(digest, first_key, copies): one row for each different text."""
    return docs.groupBy(F.sha2(text, 256).alias("digest")).agg(F.min(key).alias("first_key"), F.count("*").alias("copies"))
