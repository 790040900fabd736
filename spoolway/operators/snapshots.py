"""Snapshots: save, delete by tombstone, the live set and loading the newest match.

A save is live unless a later save has the same sequence number or a later tombstone
matches it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolway.functions import codec
from spoolway.operators.skew import ROWS_PER_TASK, entity_keys, hot_groups, running_totals, skew_join, spread
from spoolway.schema import (
    CONTENT_TYPE,
    MANIFEST,
    MAX_LONG,
    MAX_TICKS,
    OPAQUE_TYPE,
    SERIALIZER_ID,
    SNAPSHOT_SEQ_NR,
    SNAPSHOT_TIMESTAMP,
    SNAPSHOT_TOPIC,
    TOMBSTONE_MAX_SEQ_NR,
    TOMBSTONE_MAX_TIMESTAMP,
    TOMBSTONE_MIN_SEQ_NR,
    TOMBSTONE_MIN_TIMESTAMP,
    TOMBSTONE_SEQ_NR,
    TOMBSTONE_TIMESTAMP,
)
from spoolway.scratch import stored
from spoolway.sources.located import fetched

# The tree over the ranks of an id's saves has at most this many levels above its leaves.
TREE_LEVELS = 62
# Counted node rows, of some 80 bytes each, that are still sent to every executor.
MAX_NODES_BROADCAST = 500_000
NODE = ["seq_level", "seq_node", "ticks_level", "ticks_node"]


def _record(df: DataFrame, value: Column, headers: dict[str, Column], topic: str) -> DataFrame:
    return df.withColumns(
        {
            "topic": F.lit(topic),
            "key": F.col("persistence_id"),
            "value": value,
            "headers": codec.build_headers(headers),
        }
    )


def encode_saves(snapshots: DataFrame, topic: str = SNAPSHOT_TOPIC) -> DataFrame:
    """``persistence_id, seq_nr, ticks, payload, manifest[, serializer_id, content_type]`` as records."""
    columns = snapshots.columns
    content_type = F.col("content_type") if "content_type" in columns else F.lit(OPAQUE_TYPE)
    serializer = F.col("serializer_id") if "serializer_id" in columns else F.lit(None).cast("int")
    headers = {
        CONTENT_TYPE: codec.encode_string(content_type),
        SERIALIZER_ID: codec.encode_int(serializer),
        MANIFEST: codec.encode_string(F.col("manifest")),
        SNAPSHOT_SEQ_NR: codec.encode_long(F.col("seq_nr")),
        SNAPSHOT_TIMESTAMP: codec.encode_long(F.col("ticks")),
    }
    return _record(snapshots, F.col("payload"), headers, topic)


def encode_seq_deletes(deletes: DataFrame, topic: str = SNAPSHOT_TOPIC) -> DataFrame:
    """Tombstones for one ``seq_nr``; ``ticks`` 0 means whatever its time, else it has to match."""
    headers = {
        TOMBSTONE_SEQ_NR: codec.encode_long(F.col("seq_nr")),
        TOMBSTONE_TIMESTAMP: codec.encode_long(F.col("ticks")),
    }
    return _record(deletes, F.lit(b""), headers, topic)


def encode_range_deletes(deletes: DataFrame, topic: str = SNAPSHOT_TOPIC) -> DataFrame:
    """Tombstones for inclusive ranges; a null bound is open."""
    headers = {
        TOMBSTONE_MAX_SEQ_NR: codec.encode_long(F.coalesce("max_seq", F.lit(MAX_LONG))),
        TOMBSTONE_MIN_SEQ_NR: codec.encode_long(F.coalesce("min_seq", F.lit(0))),
        TOMBSTONE_MAX_TIMESTAMP: codec.encode_long(F.coalesce("max_ticks", F.lit(MAX_TICKS))),
        TOMBSTONE_MIN_TIMESTAMP: codec.encode_long(F.coalesce("min_ticks", F.lit(0))),
    }
    return _record(deletes, F.lit(b""), headers, topic)


def decode_snapshot_log(records: DataFrame) -> DataFrame:
    """Classify snapshot records: ``save``, ``del_seq`` or ``del_range``; others are skipped.

    A save without a timestamp header takes the time of its record.
    """

    def number(name: str) -> Column:
        return codec.decode_long(codec.header(name))

    def present(name: str) -> Column:
        return codec.header(name).isNotNull()

    is_range = (
        present(TOMBSTONE_MAX_SEQ_NR)
        | present(TOMBSTONE_MIN_SEQ_NR)
        | present(TOMBSTONE_MAX_TIMESTAMP)
        | present(TOMBSTONE_MIN_TIMESTAMP)
    )
    kind = (
        F.when(present(TOMBSTONE_SEQ_NR), "del_seq")
        .when(is_range, "del_range")
        .when((F.col("size") > 0) & present(SNAPSHOT_SEQ_NR), "save")
    )
    save_ticks = F.coalesce(number(SNAPSHOT_TIMESTAMP), codec.ticks_from_timestamp(F.col("timestamp")))
    zero = F.lit(0).cast("bigint")
    by_kind = F.col("kind")
    return (
        records.withColumn("kind", kind)
        .where(by_kind.isNotNull())
        .select(
            *[name for name in ("topic", "file", "row") if name in records.columns],
            F.col("key").alias("persistence_id"),
            "partition",
            "offset",
            "kind",
            F.when(by_kind == "save", number(SNAPSHOT_SEQ_NR))
            .when(by_kind == "del_seq", number(TOMBSTONE_SEQ_NR))
            .alias("seq_nr"),
            F.when(by_kind == "save", save_ticks)
            .when(by_kind == "del_seq", F.coalesce(number(TOMBSTONE_TIMESTAMP), zero))
            .alias("ticks"),
            F.when(by_kind == "del_range", F.coalesce(number(TOMBSTONE_MIN_SEQ_NR), zero)).alias("min_seq"),
            F.when(by_kind == "del_range", F.coalesce(number(TOMBSTONE_MAX_SEQ_NR), F.lit(MAX_LONG))).alias("max_seq"),
            F.when(by_kind == "del_range", F.coalesce(number(TOMBSTONE_MIN_TIMESTAMP), zero)).alias("min_ticks"),
            F.when(by_kind == "del_range", F.coalesce(number(TOMBSTONE_MAX_TIMESTAMP), F.lit(MAX_TICKS))).alias(
                "max_ticks"
            ),
            codec.decode_string(codec.header(MANIFEST)).alias("manifest"),
            codec.content_format().alias("format"),
            F.col("value").alias("payload"),
        )
    )


def _shift(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value, level.cast("int"))


def _open_end(high: Column, last: Column) -> Column:
    """An upper bound at or past the last value goes to the next power of two: fewer nodes make it up."""
    return F.when(high >= last, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(last))) - 1).otherwise(high)


def _cover(low: Column, high: Column) -> Column:
    """The fewest tree nodes ``(level, node)`` that make up the inclusive range.

    At each level the range, rounded inwards, leaves at most one node on either side
    to be taken: a left end with an odd number and a right end with an odd number.
    """
    end = F.lit(1 << TREE_LEVELS)
    first = F.least(F.greatest(low, F.lit(0)), end)
    past = F.when(high >= end - 1, end).otherwise(high + 1)

    def at(level: Column) -> Column:
        left = _shift(first + F.call_function("shiftleft", F.lit(1).cast("bigint"), level.cast("int")) - 1, level)
        right = _shift(past, level)
        inside = left < right
        taken = F.array(
            F.when(inside & (left % 2 == 1), F.struct(level.cast("int").alias("level"), left.alias("node"))),
            F.when(inside & (right % 2 == 1), F.struct(level.cast("int").alias("level"), (right - 1).alias("node"))),
        )
        return F.filter(taken, lambda n: n.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(TREE_LEVELS).cast("bigint")), at))


def _ranked(saves: DataFrame, ranges: DataFrame, rows_per_task: int) -> DataFrame:
    """Saves by their rank within the id, by number and by ticks, and ranges by the ranks they span.

    One running count over the saves of an id, with the bounds of its ranges sorted in
    between, gives both. Rows without ``seq_nr`` are ranges; they span [low, high).
    """
    ids = entity_keys(saves, ranges)

    def point(axis: str, side: int, value: str) -> Column:
        return F.struct(F.lit(axis).alias("axis"), F.lit(side).alias("side"), F.col(value).alias("value"))

    def points(df: DataFrame, seq_nr: Column, tie: str, *of: Column) -> DataFrame:
        return df.select(*ids, seq_nr.alias("seq_nr"), "offset", F.col(tie).alias("tie"), F.inline(F.array(*of)))

    both = points(saves, F.col("seq_nr"), "seq_nr", point("seq", 1, "seq_nr"), point("ticks", 1, "ticks")).unionByName(
        points(
            ranges,
            F.lit(None).cast("bigint"),
            "offset",
            point("seq", 0, "min_seq"),
            point("seq", 2, "max_seq"),
            point("ticks", 0, "min_ticks"),
            point("ticks", 2, "max_ticks"),
        )
    )
    counted = running_totals(
        both,
        [*ids, "axis"],
        ["value", "side", "tie"],
        {"below": (F.col("side") == 1).cast("bigint")},
        rows_per_task,
    )

    def found(axis: str, side: int) -> Column:
        return F.max(F.when((F.col("axis") == axis) & (F.col("side") == side), F.col("below")))

    return counted.groupBy(*ids, "seq_nr", "offset").agg(
        (found("seq", 1) - 1).alias("seq_rank"),
        (found("ticks", 1) - 1).alias("ticks_rank"),
        found("seq", 0).alias("seq_low"),
        found("seq", 2).alias("seq_high"),
        found("ticks", 0).alias("ticks_low"),
        found("ticks", 2).alias("ticks_high"),
    )


def _range_nodes(ranges: DataFrame, saves: DataFrame, found: int, rows_per_task: int) -> DataFrame:
    """The tree nodes of all ranked ranges, each with the greatest offset it kills up to.

    ``found`` is the number of ranges and saves.
    Where an id's ticks rise with its numbers, a span of ticks is a span of numbers
    as well, and one axis does.
    """
    ids = entity_keys(saves)
    known = saves.groupBy(*ids).agg(
        F.count(F.lit(1)).alias("saved"), F.bool_and(F.col("seq_rank") == F.col("ticks_rank")).alias("rising")
    )
    hot = hot_groups(ranges, ids, limit=rows_per_task) if found > rows_per_task else []
    bounded = spread(skew_join(ranges, known, ids, hot=hot), found, *ids, "offset")
    rising, last = F.col("rising"), F.col("saved") - 1
    low = F.when(rising, F.greatest("seq_low", "ticks_low")).otherwise(F.col("seq_low"))
    high = F.when(rising, F.least("seq_high", "ticks_high")).otherwise(F.col("seq_high")) - 1
    whole = F.lit((1 << TREE_LEVELS) - 1)
    ticks_low = F.when(rising, F.lit(0)).otherwise(F.col("ticks_low"))
    ticks_high = F.when(rising, whole).otherwise(_open_end(F.col("ticks_high") - 1, last))
    return (
        bounded.select(
            *ids,
            "offset",
            _cover(low, _open_end(high, last)).alias("_seqs"),
            _cover(ticks_low, ticks_high).alias("_ticks"),
        )
        # a plain explode would have the covers computed for a filter below the join as well
        .withColumn("_seq", F.explode_outer("_seqs"))
        .withColumn("_tick", F.explode_outer("_ticks"))
        .where(F.col("_seq").isNotNull() & F.col("_tick").isNotNull())
        .select(
            *ids,
            F.col("_seq.level").alias("seq_level"),
            F.col("_seq.node").alias("seq_node"),
            F.col("_tick.level").alias("ticks_level"),
            F.col("_tick.node").alias("ticks_node"),
            "offset",
        )
        .groupBy(*ids, *NODE)
        .agg(F.max("offset").alias("killed_before"))
    )


def range_kills(saves: DataFrame, ranges: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Topic, id and ``seq_nr`` of the saves that a later range tombstone matches.

    Takes one save per (id, seq). Every tombstone becomes a few nodes of a binary tree
    over the ranks of the id's saves; of each node the greatest offset is kept. A save
    looks up the nodes above it, on the levels that its id uses. So one equi-join on
    nodes does it, and no pairs of saves and tombstones are formed.
    """
    ids = entity_keys(saves, ranges)
    ranked = stored(_ranked(saves, ranges, rows_per_task), "ranked")
    saves, ranges = ranked.where(F.col("seq_nr").isNotNull()), ranked.where(F.col("seq_nr").isNull())
    found = ranked.count()
    may_be_hot = found > rows_per_task
    nodes = stored(_range_nodes(ranges, saves, found, rows_per_task), "nodes")
    # (levels + 1)^2 pairs at most, whatever the number of tombstones
    pair = (F.col("seq_level") * 64 + F.col("ticks_level")).cast("smallint")
    used = nodes.groupBy(*ids).agg(F.collect_set(pair).alias("_pairs"))
    hot = hot_groups(saves, ids, limit=rows_per_task) if may_be_hot else []
    looking = skew_join(saves, used, ids, hot=hot)
    probes = (
        spread(looking, found, *ids, "seq_nr")
        .withColumn("_pair", F.explode("_pairs"))
        .withColumn("_pair", F.col("_pair").cast("int"))
        .withColumns({"seq_level": F.shiftright("_pair", 6), "ticks_level": F.col("_pair") % 64})
        .select(
            *ids,
            "seq_level",
            _shift(F.col("seq_rank"), F.col("seq_level")).alias("seq_node"),
            "ticks_level",
            _shift(F.col("ticks_rank"), F.col("ticks_level")).alias("ticks_node"),
            "seq_nr",
            "offset",
        )
    )
    if nodes.count() <= MAX_NODES_BROADCAST:
        met = probes.join(F.broadcast(nodes), [*ids, *NODE])
    else:
        # the rows that explode made are not in the size estimate, so no other broadcast
        nodes = nodes.hint("merge")
        # a node of level n has 2^n saves below it: only wide nodes of hot ids can be hot
        wide = F.col("seq_level") >= rows_per_task.bit_length() - 1
        if not hot:
            wide = F.lit(False)
        met = probes.where(~wide).join(nodes, [*ids, *NODE])
        if hot:
            met = met.unionByName(skew_join(probes.where(wide), nodes, [*ids, *NODE], limit=rows_per_task))
    return met.where(F.col("offset") < F.col("killed_before")).select(*ids, "seq_nr")


def live_keys(log: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """A stored table of the live snapshots: ``[topic, ]persistence_id, seq_nr, ticks, partition, offset``.

    The last save of each (id, seq) is live unless a later tombstone matches it.
    Tombstones for one sequence number are settled by aggregates: by (id, seq, ticks)
    for those with an exact time, then by (id, seq). An id is one within its topic. Where
    the log tells the ``file`` and ``row`` of its records, the table does so too.
    """
    by = [*entity_keys(log), "seq_nr"]
    where = [name for name in ("file", "row") if name in log.columns]
    save, delete = F.col("kind") == "save", F.col("kind") == "del_seq"
    any_time = F.col("ticks") == 0
    by_time = (
        log.where(save | delete)
        .groupBy(*by, "ticks", "partition")
        .agg(
            F.max(F.when(save, F.col("offset"))).alias("saved"),
            *[F.max_by(name, F.when(save, F.col("offset"))).alias(name) for name in where],
            F.max(F.when(delete & any_time, F.col("offset"))).alias("any_deleted"),
            F.max(F.when(delete & ~any_time, F.col("offset"))).alias("exact_deleted"),
        )
    )
    by_seq = by_time.groupBy(*by).agg(
        F.max_by(F.struct("ticks", "partition", "saved", "exact_deleted", *where), F.col("saved")).alias("_last"),
        F.max("any_deleted").alias("any_deleted"),
    )
    saved = F.col("_last.saved")
    kept = by_seq.where(
        saved.isNotNull()
        & (saved > F.coalesce("any_deleted", F.lit(-1)))
        & (saved > F.coalesce("_last.exact_deleted", F.lit(-1)))
    )
    last = kept.select(*by, "_last.ticks", "_last.partition", saved.alias("offset"), *[f"_last.{name}" for name in where])
    last = stored(last, "last-saves")
    ranges = log.where(F.col("kind") == "del_range")
    if ranges.isEmpty():
        return last
    return stored(last.join(range_kills(last, ranges, rows_per_task), by, "left_anti"), "live")


def with_payload(keys: DataFrame, log: DataFrame) -> DataFrame:
    """Fetch the manifest, format and payload of chosen snapshots.

    Keys that tell where their records are stored are dealt out by file, and each task
    reads the row groups that hold its records: no payload is shuffled. Others are joined.
    """
    if "file" in keys.columns:
        found = fetched(keys, {"value": "binary", "headers": "map<string,binary>"})
        return found.select(
            *[name for name in keys.columns if name not in ("file", "row")],
            codec.decode_string(codec.header(MANIFEST)).alias("manifest"),
            codec.content_format().alias("format"),
            F.col("value").alias("payload"),
        )
    where = [*entity_keys(keys, log), "partition", "offset"]
    bodies = log.where(F.col("kind") == "save").select(*where, "manifest", "format", "payload")
    return keys.join(bodies, where)


def live_snapshots(log: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    return with_payload(live_keys(log, rows_per_task), log)


def newest(live: DataFrame, criteria: DataFrame | None = None) -> DataFrame:
    """Of each topic and id the live snapshot with the highest sequence number.

    ``criteria([topic, ]persistence_id[, min_seq, max_seq, min_ticks, max_ticks])`` has one row
    per wanted id, with inclusive bounds.
    """
    where = [name for name in ("file", "row") if name in live.columns]
    if criteria is not None:
        given, on = set(criteria.columns), entity_keys(live, criteria)
        bounds = criteria.select(
            *on,
            *[
                (F.coalesce(F.col(name), F.lit(default)) if name in given else F.lit(default)).alias(f"_{name}")
                for name, default in (("min_seq", 0), ("max_seq", MAX_LONG), ("min_ticks", 0), ("max_ticks", MAX_TICKS))
            ],
        )
        live = skew_join(live, bounds, on).where(
            F.col("seq_nr").between(F.col("_min_seq"), F.col("_max_seq"))
            & F.col("ticks").between(F.col("_min_ticks"), F.col("_max_ticks"))
        )
    best = F.max(F.struct("seq_nr", "ticks", "partition", "offset", *where)).alias("_best")
    ids = entity_keys(live)
    return live.groupBy(*ids).agg(best).select(*ids, "_best.*")


def load_snapshots(log: DataFrame, criteria: DataFrame | None = None) -> DataFrame:
    """The newest live snapshot of each id with its payload; wanted ids without one keep a row of nulls."""
    found = with_payload(newest(live_keys(log), criteria), log)
    if criteria is None:
        return found
    on = entity_keys(criteria, found)
    return criteria.select(*on).join(found, on, "left")


def compact_snapshot_log(log: DataFrame) -> DataFrame:
    """The saves to keep when a snapshot log is rewritten: exactly the live set."""
    return live_snapshots(log)
