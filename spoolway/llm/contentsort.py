"""Exact dedup by sorting the content: equal texts become neighbours and are compared in full.

Sampled splitters range-partition the normalised texts, each task sorts its range (an
external sort, which spills), and one pass compares every text with the one before it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.llm.common import GAP, stored
from spoolway.operators.skew import broadcast_small

#: Splitters hold this many characters of a text, its digest and the id, so samples are small.
SPLITTER_CHARS = 16
#: Rows, and bytes of them, that a task holds back until their run has ended.
HELD_ROWS = 65_536
HELD_BYTES = 32 << 20


def normalised(text):
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")


def _marked(docs: DataFrame, id_column: str, text: str, carry: list[str] | None) -> DataFrame:
    """The sorted rows, each with its run of equal texts: ``row, digest, keep_id, first, size, part, run, run_text``.

    A run that may go on in another task, or that is too long to be held back, is
    open: its size is null and its first row carries the text.
    """
    kept = F.struct("*") if carry is None else F.struct(*carry)
    rows = docs.select(kept.alias("row"), F.col(id_column).alias("id"), normalised(F.col(text)).alias("norm"))
    rows = rows.withColumns({"head": F.substring("norm", 1, SPLITTER_CHARS), "digest": F.unhex(F.sha2("norm", 256))})
    by_id = F.col("id").asc_nulls_last()
    # equal texts have equal heads and digests, so a large group is cut between its ids
    ranged = rows.repartitionByRange("head", "digest", by_id).sortWithinPartitions("head", "digest", "norm", by_id)
    schema = T.StructType(
        [
            T.StructField("row", rows.schema["row"].dataType),
            T.StructField("digest", T.BinaryType()),
            T.StructField("keep_id", rows.schema["id"].dataType),
            T.StructField("first", T.BooleanType()),
            T.StructField("size", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("run", T.LongType()),
            T.StructField("run_text", T.StringType()),
        ]
    )
    return ranged.select("row", "digest", "id", "norm").mapInArrow(_runs, schema)


def _runs(batches):
    """Number the runs of equal neighbours in sorted batches; holds one run and one batch at a time."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    names = ["row", "digest", "keep_id", "first", "size", "part", "run", "run_text"]

    def out(rows, keep, first, sizes, runs, texts):
        n = rows.num_rows
        columns = [rows.column("row"), rows.column("digest"), keep, pa.array(first), sizes, pa.array(np.full(n, part, np.int32)), pa.array(runs), texts]
        return pa.RecordBatch.from_arrays(columns, names=names)

    # the run at hand: its text and least id, rows held back, rows and bytes seen, whether some were given out
    text, keep, held, rows, size, begun, run = None, None, [], 0, 0, False, -1

    def given(is_open):
        """The held rows; an open run's first row brings the text along."""
        nonlocal begun
        for piece in held:
            n = piece.num_rows
            first = np.zeros(n, bool)
            first[0] = not begun
            texts = pa.nulls(n, pa.string())
            if is_open and not begun:
                texts = pa.concat_arrays([pa.array([text], pa.string()), pa.nulls(n - 1, pa.string())])
            begun = True
            sizes = pa.nulls(n, pa.int64()) if is_open else pa.array(np.full(n, rows, np.int64))
            yield out(piece, pa.repeat(keep, n), first, sizes, np.full(n, run, np.int64), texts)
        held.clear()

    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        norm, ids = batch.column("norm"), batch.column("id")
        same = np.empty(n, bool)
        same[0] = run >= 0 and norm[0].as_py() == text
        same[1:] = pc.equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(~same)
        ends = int(starts[0]) if len(starts) else n
        if ends:
            held.append(batch.slice(0, ends))
            rows, size = rows + ends, size + held[-1].nbytes
        if len(starts):
            if run >= 0:
                # the first run of a task may have begun in the task before
                yield from given(is_open=begun or run == 0)
            lengths = np.diff(starts)
            if len(lengths):
                whole, each = batch.slice(ends, int(lengths.sum())), np.repeat(lengths, lengths)
                numbers = np.repeat(np.arange(run + 1, run + 1 + len(lengths)), lengths)
                first, texts, sizes = ~same[ends : int(starts[-1])], pa.nulls(len(each), pa.string()), pa.array(each)
                if run < 0:
                    left = int(lengths[0])
                    sizes = pa.concat_arrays([pa.nulls(left, pa.int64()), sizes.slice(left)])
                    texts = pa.concat_arrays([norm.slice(ends, 1).cast(pa.string()), texts.slice(1)])
                yield out(whole, ids.take(pa.array(np.repeat(starts[:-1], lengths))), first, sizes, numbers, texts)
            last = int(starts[-1])
            run, text, keep, begun = run + len(starts), norm[last].as_py(), ids[last], False
            held.append(batch.slice(last))
            rows, size = n - last, held[-1].nbytes
        if rows > HELD_ROWS or size > HELD_BYTES:
            yield from given(is_open=True)
    if run >= 0:
        yield from given(is_open=True)


def with_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``carry`` columns, all by default), ``keep_id, group_size, kept, text_sha256`` per row.

    Texts are equal when they are identical after every run of ASCII white space has
    become one space; a null text counts as empty, a blank one is a single space. Of
    equal texts the row with the smallest id is kept and ``keep_id`` is that id. Rows
    without id come after all others, and one of several rows with the same id and text
    is kept, whichever. ``text_sha256`` is the normalised text's digest in lower-case hex.
    An empty table gives an empty one. Columns of ``docs`` may have any name and type.

    Only runs that reach the edge of a task, or exceed what a task holds back, are met
    again: at most two for each task and one for every ``HELD_ROWS`` rows or
    ``HELD_BYTES`` bytes. Their texts are compared in full as well.
    """
    marked = stored(_marked(docs, id_column, text, carry), "runs")
    split = marked.where(F.col("size").isNull())
    heads = split.where(F.col("run_text").isNotNull()).select("part", "run", "run_text", "keep_id")
    rows = split.groupBy("part", "run").agg(F.count(F.lit(1)).alias("rows"))
    spans = stored(heads.join(rows, ["part", "run"]), "spans")
    # struct fields compare in order: the least id first, a null one last
    least = F.min(F.struct(F.col("keep_id").isNull().alias("none"), "keep_id", "part", "run")).alias("least")
    groups = spans.groupBy("run_text").agg(F.sum("rows").alias("total"), least)
    whole = stored(
        spans.select("part", "run", "run_text").join(groups, "run_text").select("part", "run", "total", "least"), "groups"
    )
    joined = split.join(broadcast_small(whole), ["part", "run"])
    leads = F.col("first") & (F.col("part") == F.col("least.part")) & (F.col("run") == F.col("least.run"))
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    done = marked.where(F.col("size").isNotNull()).select(
        "row", "keep_id", F.col("size").alias("group_size"), F.col("first").alias("kept"), sha
    )
    again = joined.select("row", F.col("least.keep_id").alias("keep_id"), F.col("total").alias("group_size"), leads.alias("kept"), sha)
    return done.unionByName(again)


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``with_groups`` keeps, with their columns."""
    return with_groups(docs, id_column, text).where("kept").select("row.*")
