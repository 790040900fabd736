"""Fetch columns of chosen records by the file and row in which they are stored."""

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway import files

#: Rows that make up one task's share; rows of one file are kept together as far as this allows.
ROWS_PER_SHARE = 100_000


def fetched(keys: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows of ``keys`` with the named columns (and their types) of the records at ``file`` and ``row``.

    Keys are dealt out by file and stretch of rows. A task opens each of its files once
    and reads only the row groups with wanted rows, so what is not wanted is not read
    and what is read is not shuffled.
    """
    kinds = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in columns.items()))
    schema = T.StructType([*keys.schema.fields, *kinds.fields])
    names = list(columns)

    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kinds)

        def of_file(path, part):
            system, inside = files.filesystem(path)
            with system.open_input_file(inside) as stream:
                file = pq.ParquetFile(stream)
                sizes = [file.metadata.row_group(i).num_rows for i in range(file.metadata.num_row_groups)]
                ends = np.cumsum(sizes)
                rows = part.column("row").to_numpy()
                group = np.searchsorted(ends, rows, side="right")
                # rows are sorted, so are their row groups
                for g in np.unique(group).tolist():
                    at = np.flatnonzero(group == g)
                    table = file.read_row_group(g, columns=names).take(pa.array(rows[at] - (ends[g] - sizes[g])))
                    mine = part.slice(int(at[0]), len(at))
                    found = [table.column(f.name).combine_chunks().cast(f.type) for f in arrow]
                    yield pa.RecordBatch.from_arrays([*mine.columns, *found], names=[*mine.schema.names, *names])

        for batch in batches:
            paths = batch.column("file").to_pylist()
            starts = [0, *(i for i in range(1, len(paths)) if paths[i] != paths[i - 1]), len(paths)]
            for a, b in zip(starts, starts[1:]):
                if b > a:
                    yield from of_file(paths[a], batch.slice(a, b - a))

    dealt = keys.repartition("file", F.floor(F.col("row") / F.lit(ROWS_PER_SHARE))).sortWithinPartitions("file", "row")
    return dealt.mapInArrow(read, schema)
