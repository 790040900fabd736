"""Substring deduplication by content-defined chunks."""

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.llm.common import utf8

#: A cut follows a position whose 16-bit gear hash, which reaches back 16 bytes, is below
#: this bound: one in 16. With the least length, chunks have some 24 bytes on average.
CUT_BELOW = 65_536 // 16
LEAST_BYTES = 8
#: Text without a cut for so long gets one at the next place where it may be cut.
MOST_BYTES = 256
#: A cut moves on to the next word start if there is one so near.
SNAP_BYTES = 32
#: A run of repeated chunks goes if it has this many words. A repeated passage loses up to
#: two chunks at its ends, about 8 words, before they fall into step: of passages of 51
#: words 99 % have such a run, of those of 60 nearly all.
MIN_WORDS = 25
#: Bytes that count as a passage where words are this long on average.
UNSPACED_BYTES, LONG_WORD = 150, 24


@lru_cache(1)
def _gear():
    import numpy as np
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(bytes([b]), 7) & 0xFFFF for b in range(256)], np.uint16)


def cuts(text: bytes) -> list[int]:
    """Chunk boundaries of a text, 0 and its length included; they depend on content only.

    The gear hash h = 2h + gear[byte] is kept to 16 bits, so bytes further back shift
    out and all positions are computed at once by doubling. A cut is moved to the start
    of a word, or of a character where no word starts nearby. An empty text has none.
    """
    import numpy as np

    size = len(text)
    if not size:
        return []
    raw = np.frombuffer(text, np.uint8)
    h = _gear()[raw]
    for step in (1, 2, 4, 8):
        older = np.zeros_like(h)
        older[step:] = h[:-step] << np.uint16(step) if step < size else older[step:]
        h = h + older
    hits = np.flatnonzero(h < CUT_BELOW) + 1
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    starts = np.append(starts, size)
    padded = np.append(raw, np.zeros(4, np.uint8))

    def snapped(at):
        word = starts[np.searchsorted(starts, at)]
        char = at.copy()
        for _ in range(3):
            char += (padded[char] & 0xC0) == 0x80
        return np.where(word - at <= SNAP_BYTES, word, np.minimum(char, size))

    out = [0]
    for p in [*np.unique(snapped(hits)).tolist(), size]:
        while p - out[-1] > MOST_BYTES + SNAP_BYTES:
            out.append(int(snapped(np.array([out[-1] + MOST_BYTES]))[0]))
        if p - out[-1] >= LEAST_BYTES and p < size:
            out.append(p)
    return [*out, size]


def chunk_digests(text: bytes) -> tuple[list[int], list[int]]:
    """Boundaries and one signed 64-bit digest for each chunk, white space at its ends left out."""
    from xxhash import xxh3_64_intdigest

    at = cuts(text)
    found = [xxh3_64_intdigest(text[a:b].strip()) for a, b in zip(at, at[1:])]
    return at, [d - (1 << 64) if d >> 63 else d for d in found]


def _long_enough(run: bytes, min_words: int) -> bool:
    """Enough words; or, in writing without spaces, enough bytes."""
    words = len(run.split())
    return words >= min_words or (len(run) >= UNSPACED_BYTES and words * LONG_WORD <= len(run))


def repeated_runs(text: bytes, known: set[int], min_words: int) -> tuple[int, int, list[tuple[int, int]]]:
    """Chunk count, repeated chunk count, and the spans (start, end) of long runs of these.

    A chunk is repeated if its digest is in ``known`` or came earlier in the text.
    """
    at, digests = chunk_digests(text)
    seen, again = set(), []
    for d in digests:
        again.append(d in known or d in seen)
        seen.add(d)
    spans, begin = [], None
    for i, dup in enumerate([*again, False]):
        if dup and begin is None:
            begin = i
        elif not dup and begin is not None:
            if _long_enough(text[at[begin] : at[i]], min_words):
                spans.append((at[begin], at[i]))
            begin = None
    return len(digests), sum(again), spans


def _place(id_column: str, text: str) -> Column:
    """The id as a long; a null id is replaced by a hash of the text above 2^62."""
    own = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).bitwiseAND(2**62 - 1) + F.lit(2**62)
    return F.coalesce(F.col(id_column).cast("long"), own)


def dedup_substrings(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, name: str = "dedup"
) -> DataFrame:
    """Cut out of each text the passages that an earlier document, or the text itself, has had.

    Each distinct digest of a text is compared over all documents: the document with
    the least id keeps it. Runs of repeated chunks with ``min_words`` words or more are
    cut out; shorter ones stay, so neither a chance match of single chunks nor a short
    stock phrase changes a text, and a false digest match alone has no effect. Where words
    have ``LONG_WORD`` bytes and more on average, as in writing without spaces,
    ``UNSPACED_BYTES`` do instead.

    Adds ``name``: struct of ``n_chunks``, ``n_dup_chunks`` (int), ``spans`` (array of
    start and end in bytes of the whole text) and ``kept_text``. All columns stay. A
    text that is repeated as a whole keeps its row and an empty text. A null text stays
    null and has no chunks. Rows of one id are one document: they lose what another
    document had first or what they repeat within a row, but nothing to each other. A
    row without id is a document of its own text, after (nearly) all others.
    """
    if name in docs.columns:
        raise ValueError(f"{name} is a column already")
    held = docs.select(F.struct("*").alias("row"), _place(id_column, text).alias("place"))

    def digest(batches):
        import pyarrow as pa

        for batch in batches:
            found = [list(dict.fromkeys(chunk_digests(x)[1])) for x in utf8(batch.column("text"))]
            lists = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("place"), lists], names=["place", "digests"])

    slim = held.select("place", F.col(f"row.{text}").alias("text"))
    lists = slim.mapInArrow(digest, "place bigint, digests array<bigint>")
    chunks = lists.select("place", F.explode("digests").alias("digest"))
    first = (
        chunks.groupBy("digest")
        .agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .where("first <> last")
        .select(F.col("digest").alias("same"), "first")
    )
    later = chunks.join(first, F.col("digest") == F.col("same")).where("place <> first")
    known = later.groupBy(F.col("place").alias("at")).agg(F.collect_set("digest").alias("known"))
    joined = held.join(known, F.col("place") == F.col("at"), "left").select("row", "known")

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    result = T.StructType(
        [
            T.StructField("n_chunks", T.IntegerType()),
            T.StructField("n_dup_chunks", T.IntegerType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("kept_text", T.StringType()),
        ]
    )
    schema = T.StructType([T.StructField("row", docs.select(F.struct("*").alias("row")).schema[0].dataType), T.StructField("dedup", result)])

    def cut(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(result)
        for batch in batches:
            rows = []
            raw = batch.column("row").field(text).cast(pa.binary()).to_pylist()
            for value, known in zip(raw, batch.column("known").to_pylist()):
                whole = value or b""
                chunks, dups, spans = repeated_runs(whole, set(known or ()), min_words)
                ends = [0, *(x for span in spans for x in span), len(whole)]
                kept = b"".join(whole[a:b] for a, b in zip(ends[::2], ends[1::2])).decode()
                marked = [{"start": a, "end": b} for a, b in spans]
                rows.append({"n_chunks": chunks, "n_dup_chunks": dups, "spans": marked, "kept_text": None if value is None else kept})
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(rows, kind)], names=["row", "dedup"])

    done = joined.mapInArrow(cut, schema)
    return done.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("dedup").alias(name))
