"""Packing by optimal length buckets and token budgets."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolway.llm.common import numbered, stored, words

BUCKETS = 16
BUDGET = 65_536


def boundaries(histogram: Mapping[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most ``buckets`` length ranges with the least padding in total.

    A text is padded to the bound of its range. Dynamic programming over the distinct
    lengths, exact; the cost of a range obeys the quadrangle inequality, so the best
    split of a middle length bounds those of its neighbours, and each further bucket
    takes O(n log n) steps. An empty histogram has no bounds.
    """
    import numpy as np

    lengths = np.array(sorted(histogram), np.int64)
    n = len(lengths)
    if n <= buckets:
        return lengths.tolist()
    counts = np.array([histogram[x] for x in lengths.tolist()], np.float64)
    number = np.concatenate([[0.0], np.cumsum(counts)])
    tokens = np.concatenate([[0.0], np.cumsum(counts * lengths)])

    def padding(i, j):  # of lengths i to j - 1, padded to the last
        return lengths[j - 1] * (number[j] - number[i]) - (tokens[j] - tokens[i])

    best = np.array([0.0, *(padding(0, j) for j in range(1, n + 1))])
    splits = []
    for _ in range(buckets - 1):
        after, split = best.copy(), np.zeros(n + 1, np.int64)
        todo = [(1, n, 0, n)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = best[i] + padding(i, j)
            k = int(np.argmin(cost))
            after[j], split[j] = cost[k], i[k]
            todo += [(low, j - 1, first, int(i[k])), (j + 1, high, int(i[k]), last)]
        best = after
        splits.append(split)
    bounds, j = [], n
    for split in reversed(splits):
        bounds.append(int(lengths[j - 1]))
        j = int(split[j])
        if j == 0:
            break
    if j:
        bounds.append(int(lengths[j - 1]))
    return sorted(bounds)


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """Put every document into a batch of documents of like length.

    The length is the number of words; null, empty and white-space texts have length 0.
    Bounds come from the histogram of all lengths. Its rows are the distinct lengths,
    of which there are fewer than the root of twice the corpus's words; it alone goes
    to the driver. A batch of a bucket holds as many documents as its budget of padded
    tokens allows, and one if a single document is longer.

    One row per row of ``docs``: the id, ``n_tokens``, ``bucket`` (from 0, by length),
    ``bucket_length``, ``batch`` (gapless inside the bucket), ``place`` in the batch and
    ``padding``. Rows that agree in id and length may change places. No rows give none.
    """
    sized = stored(docs.select(id_column, F.size(words(F.col(text))).cast("long").alias("n_tokens")), "lengths")
    histogram = {r[0]: r[1] for r in sized.groupBy("n_tokens").agg(F.count(F.lit(1))).collect()}
    bounds = boundaries(histogram, buckets)
    bucket, length = F.lit(len(bounds)), F.lit(0).cast("long")
    for i, bound in reversed(list(enumerate(bounds))):
        fits = F.col("n_tokens") <= bound
        bucket, length = F.when(fits, i).otherwise(bucket), F.when(fits, F.lit(bound).cast("long")).otherwise(length)
    placed = sized.withColumns({"bucket": bucket.cast("int"), "bucket_length": length})
    placed = numbered(placed, "bucket", [id_column, "n_tokens"], sum(histogram.values()))
    each = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1))))
    return placed.select(
        id_column,
        "n_tokens",
        "bucket",
        "bucket_length",
        F.floor(F.col("slot") / each).cast("long").alias("batch"),
        (F.col("slot") % each).cast("long").alias("place"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
    )
