"""The prefix trie of conversations, and sums over its subtrees by an Euler tour.

Conversations with the same first turns share the nodes of that prefix. A tour enters
and leaves every node once; the arcs form one linked list. The list is ranked by
rounds of joins, so that sums over a subtree are differences at two of its arcs.
"""

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolway.llm.common import stored
from spoolway.operators.skew import numbered, running_totals, skew_join

#: A list of at most this many arcs is walked by one task; longer ones are contracted first.
WALKED_ARCS = 10_000
#: Groups that exceed twice the mean of a task's rows, and this many, are numbered in parts.
LEAST_SHARE = 1024

#: SHA-256 of nothing.
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def digested(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, digest, n_bytes`` of every turn, ``place`` counting from 0.

    Turns are in the order of ``turn``, nulls first; of rows that share a conversation
    and a turn, the order is that of a hash of role and text. Null roles and texts
    become empty. Rows without ``conv_id`` belong to no conversation and are left out.
    Texts are not needed after this, so they are not shuffled.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length of the role keeps (a, bc) and (ab, c) apart
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    turns = stored(turns.withColumn("_tie", F.xxhash64("digest")), "turns")
    placed = numbered(turns, ["conv_id"], ["turn", "_tie"], "place", _share(turns))
    return stored(placed.select("conv_id", (F.col("place") - 1).alias("place"), "digest", "n_bytes"), "placed")


def _share(df: DataFrame) -> int:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_SHARE, 2 * df.count() // tasks)


def rebuilt(turns: DataFrame, every: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations with openings shared inside blocks of ids: their turns, and all their ids.

    Conversation c starts with the first h turns of conversation c - c % ``every`` (with
    all of them if there are fewer, with none if it is absent) and goes on with its own
    turns after its first h; h is crc32 of the decimal c modulo ``modulus``. ``turns``
    comes from ``digested``.
    """
    opening = F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    known = convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("there"))
    taken = F.least(opening, F.coalesce("there", F.lit(0))).alias("taken")
    convs = stored(convs.select("conv_id", base).join(known, "base", "left").select("conv_id", "base", taken), "convs")
    columns = ["conv_id", "place", "digest", "n_bytes"]
    # fewer than modulus turns of a base, for fewer than twice ``every`` conversations
    heads = turns.where((F.col("place") < modulus - 1) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "base")
    front = convs.join(heads, "base").where(F.col("place") < F.col("taken")).select(*columns)
    own = turns.where(F.col("place") >= opening)
    moved = skew_join(own, convs.select("conv_id", "taken"), ["conv_id"])
    back = moved.withColumn("place", F.col("taken") + F.col("place") - opening).select(*columns)
    return front.unionByName(back), convs.select("conv_id")


def _key(depth: Column, sums: list[Column]) -> Column:
    text = F.concat_ws(":", depth.cast("string"), *[s.cast("string") for s in sums])
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and depth; ``key`` names the prefix and ``parent`` the one without its last turn.

    A prefix is known by its depth and the sum of 120-bit digests of its turns and
    their places. Sums run over a conversation in parts, so a very long one is spread out.
    """
    digest = F.sha2(F.concat_ws(":", F.col("place").cast("string"), F.hex("digest")), 256)
    halves = [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 16)]
    turns = stored(turns.withColumns({"f1": halves[0], "f2": halves[1]}).drop("digest"), "rebuilt")
    sums = running_totals(turns, ["conv_id"], ["place"], {"h1": F.col("f1"), "h2": F.col("f2")}, _share(turns))
    depth, whole = F.col("place") + 1, [F.col("h1"), F.col("h2")]
    before = [(F.col(f"h{i}") - F.col(f"f{i}")) for i in (1, 2)]
    found = sums.select(
        "conv_id", depth.alias("depth"), _key(depth, whole).alias("key"), _key(F.col("place"), before).alias("parent"), "n_bytes"
    )
    zero = F.lit(0).cast("long")
    top = convs.select(
        "conv_id",
        zero.alias("depth"),
        _key(zero, [zero, zero]).alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        zero.alias("n_bytes"),
    )
    return stored(found.unionByName(top), "prefixes")


def _ends(prefixes: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the digest of the ids of all conversations that end at a node, ascending.

    Ids are sorted over all tasks; a task turns the ids of a node into its digest, or,
    where the node may go on elsewhere, into pieces of joined text, which few tasks then read in order.
    """
    last = prefixes.groupBy("conv_id").agg(F.max_by("key", "depth").alias("key"))
    ranged = last.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def join(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            keys, ids = batch.column("key"), batch.column("conv_id")
            new = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            at = [0, *(np.flatnonzero(new) + 1).tolist(), n]
            text = pc.cast(ids, pa.string()).to_pylist()
            rows = []
            for i, (a, b) in enumerate(zip(at, at[1:])):
                joined, edge = ",".join(text[a:b]), i in (0, len(at) - 2)
                rows.append((keys[a].as_py(), ids[a].as_py(), None if edge else hashlib.sha256(joined.encode()).hexdigest(), joined if edge else None))
            names = ["key", "first_id", "ends_sha256", "piece"]
            kinds = [pa.binary(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    found = stored(
        ranged.select("key", F.col("conv_id").cast("long").alias("conv_id")).mapInArrow(
            join, "key binary, first_id bigint, ends_sha256 string, piece string"
        ),
        "ends",
    )

    def hashed(batches):
        import hashlib

        import pyarrow as pa

        key, state, done = None, None, []
        for batch in batches:
            for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
                if k == key:
                    state.update(b"," + piece.encode())
                else:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(piece.encode())
        if key is not None:
            done.append((key, state.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["key", "ends_sha256"]
        )

    pieces = found.where(F.col("piece").isNotNull()).select("key", "first_id", "piece")
    edges = pieces.repartition("key").sortWithinPartitions("key", "first_id").select("key", "piece").mapInArrow(hashed, "key binary, ends_sha256 string")
    return found.where(F.col("piece").isNull()).select("key", "ends_sha256").unionByName(edges)


def list_rank(arcs: DataFrame, weights: list[str], walked: int = WALKED_ARCS) -> DataFrame:
    """``id`` and, for each weight, its sum from that arc to the end of the list.

    ``arcs`` is a stored table of ``id, next`` (null at the end) and the weights, and one list.
    Every round takes out arcs whose coin fell on heads while that of the next arc fell on tails, a quarter
    of them, none next to another, and hands their weights to the arc before. So the
    rounds shrink like a geometric series. What is left in the end is walked, and the
    arcs taken out get their sums back to front from the arc they pointed at.
    """
    columns = ["id", "next", *weights]
    alive, taken, turn = arcs.select(*columns), [], 0
    while alive.count() > walked:
        turn += 1

        def coin(column: str) -> Column:
            return F.xxhash64(F.col(column), F.lit(turn)).bitwiseAND(1)

        # a null next compares to null: the last arc stays
        gone = F.coalesce((coin("id") == 1) & F.col("next").isNotNull() & (coin("next") == 0), F.lit(False))
        marked = alive.withColumn("gone", gone)
        out = marked.where("gone").select(
            F.col("id").alias("next"), F.col("next").alias("_next"), *[F.col(w).alias(f"_{w}") for w in weights], F.lit(True).alias("_met")
        )
        joined = marked.join(out, "next", "left")
        handed = {w: F.col(w) + F.coalesce(f"_{w}", F.lit(0)) for w in weights}
        step = joined.select("id", F.when(F.col("_met"), F.col("_next")).otherwise(F.col("next")).alias("next"), *[c.alias(w) for w, c in handed.items()], "gone")
        step = stored(step, "contracted")
        taken.append(step.where("gone").select(*columns))
        alive = step.where(~F.col("gone")).select(*columns)

    def walk(batches):
        import pyarrow as pa

        rows = {}
        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in columns]
            rows.update((row[0], row[1:]) for row in zip(*lists))
        order, at = [], next(iter(set(rows) - {row[0] for row in rows.values()}), None)
        while at is not None:
            order.append(at)
            at = rows[at][0]
        sums, total = [], [0] * len(weights)
        for i in reversed(order):
            total = [a + b for a, b in zip(total, rows[i][1:])]
            sums.append((i, *total))
        lists = zip(*sums) if sums else [[] for _ in range(len(weights) + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in lists], names=["id", *weights])

    schema = ", ".join(f"{c} bigint" for c in ("id", *weights))
    known = stored(alive.coalesce(1).mapInArrow(walk, schema), "ranked")
    for gone in reversed(taken):
        behind = known.select(F.col("id").alias("next"), *[F.col(w).alias(f"_{w}") for w in weights])
        found = gone.join(behind, "next").select("id", *[(F.col(w) + F.col(f"_{w}")).alias(w) for w in weights])
        known = known.unionByName(stored(found, "ranked"))
    return known


def prefix_trie(turns: DataFrame, convs: DataFrame, walked: int = WALKED_ARCS) -> DataFrame:
    """One row per node: a distinct sequence of first turns, from the empty one at depth 0.

    ``turns(conv_id, place, digest, n_bytes)`` has the places 0, 1, ... of each
    conversation, ``convs(conv_id)`` every conversation once, also those without turns.
    A conversation is a member of each node that it starts with. Gives ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` (over the node's subtree: childless
    nodes, and the bytes of last turns that repeat), ``ends_sha256`` (of the ids of
    the conversations that end there), ``enter_at`` and ``exit_at`` (places on the tour,
    from 0). The last turn of a node is the turn at place ``depth`` - 1 of its
    ``conv_id``. Without conversations there is no node.

    Children of a node stand in the order of their ``conv_id``. A node with very many
    children, members or ends is spread out like all others.
    """
    prefixes = _prefixes(turns, convs)
    nodes = prefixes.groupBy("key", "parent", "depth", "n_bytes").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    above = nodes.select(F.col("key").alias("parent"), F.col("node").alias("parent_node"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where(F.col("parent").isNotNull()).select("node", "parent", "conv_id")
    share = _share(nodes)
    hung = stored(skew_join(below, above, ["parent"], limit=share).select("node", "parent_node", "parent_conv_id", "conv_id"), "hung")
    placed = stored(numbered(hung, ["parent_node"], ["conv_id"], "place", share), "children")

    first = placed.where("place = 1").select(F.col("parent_node").alias("node"), F.col("node").alias("child"))
    after = placed.select("parent_node", (F.col("place") - 1).alias("place"), F.col("node").alias("sibling"))
    linked = placed.join(after, ["parent_node", "place"], "left").select("node", "parent_node", "sibling")
    linked = nodes.select("node", "n_convs", "n_bytes").join(linked, "node", "left").join(first, "node", "left")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    enter = F.struct(
        (F.col("node") * 2).alias("id"),
        F.coalesce(F.col("child") * 2, F.col("node") * 2 + 1).alias("next"),
        F.when(F.col("child").isNull(), one).otherwise(zero).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
        one.alias("steps"),
    )
    leave = F.struct(
        (F.col("node") * 2 + 1).alias("id"),
        F.coalesce(F.col("sibling") * 2, F.col("parent_node") * 2 + 1).alias("next"),
        zero.alias("leaves"),
        zero.alias("saved"),
        one.alias("steps"),
    )
    arcs = stored(linked.select(F.inline(F.array(enter, leave))), "arcs")
    ranks = list_rank(arcs, ["leaves", "saved", "steps"], walked)

    entering, total = F.col("id") % 2 == 0, 2 * nodes.count()
    both = {w: F.sum(F.when(entering, F.col(w)).otherwise(-F.col(w))) for w in ("leaves", "saved")}
    sums = ranks.groupBy(F.call_function("div", F.col("id"), F.lit(2)).alias("node")).agg(
        both["leaves"].alias("n_leaves"),
        both["saved"].alias("saved_tokens"),
        (total - F.max(F.when(entering, F.col("steps")))).alias("enter_at"),
        (total - F.max(F.when(~entering, F.col("steps")))).alias("exit_at"),
    )
    counted = placed.groupBy(F.col("parent_node").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    return (
        nodes.join(sums, "node")
        .join(hung.select("node", "parent_conv_id"), "node", "left")
        .join(counted, "node", "left")
        .join(_ends(prefixes), "key", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
            "enter_at",
            "exit_at",
        )
    )
