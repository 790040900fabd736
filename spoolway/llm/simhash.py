"""Near copies by SimHash, found through an inverted index of positional bytes."""

from collections.abc import Callable
from itertools import accumulate, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.llm.common import hashable, stored, utf8
from spoolway.llm.components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 2
BLOCK = 65_536


def _fingerprint(text: bytes) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest

    found = text.lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends[:-1]]
    width = min(SHINGLE, len(found))
    total = len(found) - width + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, BLOCK):
        some = zip(starts[at : min(at + BLOCK, total)], ends[at + width - 1 : at + width - 1 + BLOCK])
        hashes = np.array([xxh64_intdigest(line[a : b - 1], SEED) for a, b in some], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add the SimHash of each whole text as a signed long; other columns stay but for ``drop``.

    A-Z are lowered; shingles are three words, repeats included, or the whole sequence
    of fewer words. A bit is 1 if it is set in over half of the shingles' XXH64. A null
    or empty text and one of white space alone give zero. The name must be a new one.
    """
    if name in docs.columns:
        raise ValueError(f"{name} is a column already")
    schema = T.StructType([*docs.drop(name, *drop).schema.fields, T.StructField(name, T.LongType())])
    names = schema.fieldNames()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            values = pa.array([_fingerprint(x) for x in utf8(batch.column(text))], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), values], names=names)

    return docs.mapInArrow(run, schema)


def shared_bytes(x: Column) -> Column:
    """How many of the eight byte positions agree, given the XOR of two fingerprints."""
    return sum(((F.shiftrightunsigned(x, 8 * i).bitwiseAND(255) == 0).cast("int") for i in range(8)), F.lit(0))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in at most ``max_bits`` (2) bits.

    Two bits touch two bytes at most, so a pair must share six of its eight positional
    bytes, and two of its four aligned byte pairs in full. The index therefore holds a
    posting for each of the six choices of two byte pairs (32 bits). Pairs that meet in
    a posting list are tallied: those with fewer than six shared bytes go, the rest are
    verified bit by bit. Both tests stand in the join's condition, so no candidate is
    written, and a pair is kept in the first list only in which it meets.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the index guarantees pairs of up to two differing bits")

    def pair(x: Column, i: int) -> Column:
        return F.shiftrightunsigned(x, 16 * i).bitwiseAND(0xFFFF)

    choices = list(combinations(range(4), 2))
    fp = F.col("fingerprint")
    keys = [F.lit(k).cast("long") * 2**32 + pair(fp, i) * 65536 + pair(fp, j) for k, (i, j) in enumerate(choices)]
    # a key holds 35 bits: the choice, then four positional bytes
    index = prints.select(fp, F.explode(F.array(*keys)).alias("key"))
    a, b = index.alias("a"), index.alias("b")
    x = F.col("a.fingerprint").bitwiseXOR(F.col("b.fingerprint"))
    first = F.lit(len(choices))
    for k, (i, j) in reversed(list(enumerate(choices))):
        first = F.when((pair(x, i) == 0) & (pair(x, j) == 0), F.lit(k)).otherwise(first)
    return a.join(
        b,
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.fingerprint") < F.col("b.fingerprint"))
        & (shared_bytes(x) >= 8 - max_bits)
        & (F.bit_count(x) <= max_bits)
        & (first == F.shiftright(F.col("a.key"), 32)),
    ).select(F.col("a.fingerprint").alias("a"), F.col("b.fingerprint").alias("b"))


def classes(marked: DataFrame, id_column: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """(fingerprint, root, component_id): one row per distinct fingerprint of ``marked``.

    ``component_id`` is the least id reachable over links; nulls count only where a
    component has no other id. Copies are met once, by their fingerprint.
    """
    prints = stored(marked.groupBy("fingerprint").agg(F.min(id_column).alias("least_id")), "prints")
    roots = components(links(prints, max_bits))
    rooted = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(least, "root").select("fingerprint", "root", "component_id")


def near_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, its ``fingerprint`` (long) and ``component_id``.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows
    come back as often as they are there. An empty table gives no rows.
    """
    marked = stored(with_fingerprint(docs.select(id_column, text), text).select(id_column, "fingerprint"), "fingerprints")
    found = classes(marked, id_column).select(F.col("fingerprint").alias("_fp"), "component_id")
    return marked.join(found, marked["fingerprint"] == found["_fp"]).drop("_fp")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Keep one whole row of each near-copy group, that of the least id (nulls last).

    Rows that share id and fingerprint are settled by a hash of their columns, but for maps
    and the like, which can't be hashed; equal rows leave one. Columns stay as they are.
    """

    def mark(df: DataFrame) -> DataFrame:
        return with_fingerprint(df, drop=("text",))

    marked = stored(mark(docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))), "fingerprints")
    return least_of_classes(docs, id_column, text, marked, classes(marked, "id"), mark)


def least_of_classes(
    docs: DataFrame, id_column: str, text: str, marked: DataFrame, found: DataFrame, mark: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The whole row of the least id of each class.

    ``marked`` has id and fingerprint of all rows, ``found`` the class of each fingerprint, and
    ``mark`` puts the fingerprint in place of the column ``text``.
    """
    row = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), F.col(text).alias("text"))
    found = found.withColumnRenamed("fingerprint", "fp")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("fingerprint").alias("fp"))
    best = (
        marked.groupBy("id", "fingerprint")
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(found, F.col("fingerprint") == F.col("fp"))
        .groupBy("component_id", "root")
        .agg(F.min(order).alias("w"), F.min_by("rows", order).alias("rows"))
        .select(F.col("w.id").alias("best_id"), F.col("w.fp").alias("best_fp"), "rows")
    )
    same = F.col("id").eqNullSafe(F.col("best_id")) & (F.col("fingerprint") == F.col("best_fp"))
    # texts are not stored but marked again: one shuffle of whole rows is all
    kept = mark(row).join(best, same).select("id", "fingerprint", "row", "rows")
    alone = kept.where("rows = 1").select("row")
    own = F.xxhash64(*hashable(docs, "row."))
    repeated = kept.where("rows > 1").groupBy("id", "fingerprint").agg(F.min_by("row", own).alias("row")).select("row")
    return alone.unionByName(repeated).select("row.*")
