"""Small helpers that the operators of this subpackage share."""

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.scratch import stored

#: A word is a run of anything but ASCII white space; ``bytes.split()`` cuts alike.
GAP = r"[\x20\x09-\x0D]+"

#: Numbering cuts a group into at most this many parts, so offsets stay a small table.
MAX_PARTS = 4096
ROWS_PER_PART = 5_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def hashable(df: DataFrame, prefix: str = "") -> list[Column]:
    """The columns that can be hashed: all but those that hold a map, a variant or the like."""

    def plain(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(plain(f.dataType) for f in kind.fields)
        if isinstance(kind, T.ArrayType):
            return plain(kind.elementType)
        return not isinstance(kind, (T.MapType, T.VariantType, T.NullType))

    return [F.col(f"{prefix}`{f.name}`") for f in df.schema.fields if plain(f.dataType)]


def unused(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def numbered(df: DataFrame, by: str, order: list[str], rows: int, name: str = "slot") -> DataFrame:
    """Number the rows of each group without gaps from 0, no group in a single task.

    ``df`` is read twice, so it should be a stored table. ``rows`` is its row count and
    the number of groups must be bounded: each is cut by a hash of the order columns
    into up to ``MAX_PARTS`` parts, whose offsets are broadcast. Rows that are equal in
    the order columns stay in one part, in any order.
    """
    parts = max(1, min(MAX_PARTS, -(-rows // ROWS_PER_PART)))
    cut = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = cut.groupBy(by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(by).alias("_by"),
        F.col("_part").alias("_at"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    here = F.row_number().over(Window.partitionBy(by, "_part").orderBy(*order))
    return (
        cut.withColumn("_here", here)
        .join(F.broadcast(offsets), F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_at")))
        .withColumn(name, F.col("_offset") + F.col("_here") - 1)
        .drop("_part", "_here", "_by", "_at", "_offset")
    )


def sampled(df: DataFrame, rows: int, key: list[str]) -> DataFrame:
    """At most ``rows`` rows of ``df``, those with the least hash of the ``key`` columns.

    The rows are counted first and a bound on the hash leaves half as many again as are
    wanted, so tasks send few rows however many there are. Equal rows share a hash.
    """
    found = df.count()
    spread = F.xxhash64(*key)
    if found > rows:
        df = df.where(spread < int(-(2**63) + min(1.0, 1.5 * rows / found) * (2**64 - 2**12)))
    return df.orderBy(spread, *key).limit(rows)


def utf8(column) -> Iterator[bytes]:
    """The values of an Arrow string column as UTF-8 bytes; null as none."""
    import pyarrow as pa

    for value in column.cast(pa.binary()).to_pylist():
        yield value or b""


__all__ = ["GAP", "hashable", "numbered", "remainder", "sampled", "stored", "table", "unused", "utf8", "words"]
