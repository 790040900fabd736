"""Language-model scores by prediction by partial matching over a byte-context trie."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.llm.common import stored, utf8

#: A context has up to so many bytes, those of earlier words and the spaces between included.
ORDER = 5
#: Nodes of the lowest orders, up to this one, go with the tasks: 65,536 and 256 at most.
LOW = 1
#: Codes of at least one in so many bytes of all texts go with the tasks; there are no more.
HOT = 1 << 22
#: Tokens of at least one in so many tokens go with the tasks; there are no more.
FREQUENT = 1 << 20
#: A word ends in a space; a line feed, which no word holds, ends the text.
WORD_END, TEXT_END = b" ", b"\n"
DISCOUNT = 0.5
FLUSH = 500_000
#: Bytes of text whose codes are in memory at a time, and the codes that a task holds back.
BLOCK, HELD = 1 << 20, 1 << 21


def _spelled(tokens: list[bytes]) -> bytes:
    """The bytes that are predicted: each word with the space after it, then the end of the text."""
    return b"".join([WORD_END.join(tokens), WORD_END if tokens else b"", TEXT_END])


def _codes(spelled: list[bytes]):
    """Blocks of (code, text): each byte with its context as one number, and the text it is from.

    The number holds ``ORDER`` bytes of context, zero before the start of the text, and the
    byte. Blocks cut long texts; contexts reach back over the cut.
    """
    import numpy as np

    pad = b"\0" * ORDER
    raw = np.frombuffer(pad + pad.join(spelled), np.uint8)
    size = np.array([len(x) for x in spelled], np.int64)
    start = np.cumsum(size + ORDER) - size
    for first in range(ORDER, len(raw), BLOCK):
        last = min(first + BLOCK, len(raw))
        code = np.zeros(last - first, np.int64)
        for back in range(ORDER, -1, -1):
            code <<= 8
            code |= raw[first - back : last - back]
        # the texts of the block: each owns its bytes and, up to the next one, the padding
        low, high = np.searchsorted(start, (first, last - 1), "right") - 1
        edges = np.clip(np.append(start[low : high + 1], last), first, last)
        own = np.repeat(np.arange(low, high + 1), np.diff(edges))
        inside = np.ones(len(code), bool)
        gaps = (start + size)[low : high + 1, None] + np.arange(ORDER) - first
        inside[gaps[(gaps >= 0) & (gaps < len(code))]] = False
        yield code[inside], own[inside]


def _summed(codes, *weights):
    """The distinct codes in order, and for each the sums of its weights."""
    import numpy as np

    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.empty(0, np.int64)
    return codes[first], *(np.add.reduceat(w[order], first) if len(codes) else w for w in weights)


def token_counts(docs: DataFrame, text: str, train: Column | None = None) -> DataFrame:
    """(token, n, times) over all texts; the end of a text is the empty token. A-Z are lowered.

    ``times`` counts all texts, ``n`` those for which ``train`` is true, all without it.
    A task counts its texts first and sends what it has met, in parts of bounded size.
    """

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        def out(seen, learned):
            n = pa.array(list(seen.values()), pa.int64())
            arrays = [pa.array(list(seen), pa.binary()), n if learned else pa.array([0] * len(seen), pa.int64()), n]
            return pa.RecordBatch.from_arrays(arrays, names=["token", "n", "times"])

        both: dict = {True: Counter(), False: Counter()}
        for batch in batches:
            for value, learned in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                seen = both[learned]
                seen.update(value.lower().split())
                seen[b""] += 1
                if len(seen) > FLUSH:
                    yield out(seen, learned)
                    both[learned] = Counter()
        for learned, seen in both.items():
            if seen:
                yield out(seen, learned)

    learned = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    partial = docs.select(F.col(text), learned.alias("_learned")).mapInArrow(count, "token binary, n bigint, times bigint")
    return partial.groupBy("token").agg(F.sum("n").alias("n"), F.sum("times").alias("times"))


def context_counts(docs: DataFrame, text: str, train: Column | None = None) -> DataFrame:
    """(code, n, uses): how often each byte follows each context of the highest order.

    ``uses`` counts all texts, ``n`` those for which ``train`` is true, all without it. A
    task adds up its blocks first and sends what it has met, in parts of bounded size.
    """

    def count(batches):
        import numpy as np
        import pyarrow as pa

        def out(parts):
            found = _summed(*map(np.concatenate, zip(*parts)))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["code", "n", "uses"])

        parts, held = [], 0
        for spelled, learned in _texts(batches):
            learned = np.array(learned, bool)
            for code, own in _codes(spelled):
                both = np.sort(code << 1 | learned[own])  # plain sorting is much faster than that of indices
                code = both >> 1
                at = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.empty(0, np.int64)
                parts.append((code[at], np.add.reduceat(both & 1, at) if len(at) else at, np.diff(np.append(at, len(code)))))
                held += len(parts[-1][0])
                if held > HELD:
                    parts = [_summed(*map(np.concatenate, zip(*parts)))]
                    held = len(parts[0][0])
                    if 2 * held > HELD:
                        yield out(parts)
                        parts, held = [], 0
        if parts:
            yield out(parts)

    learned = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    partial = docs.select(F.col(text), learned.alias("_learned")).mapInArrow(count, "code bigint, n bigint, uses bigint")
    return partial.groupBy("code").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses"))


def _texts(batches):
    """Lists of spelled texts with their marks, of about a block each; a longer text is a list of its own."""
    spelled, marks, size = [], [], 0
    for batch in batches:
        for value, mark in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
            spelled.append(_spelled(value.lower().split()))
            marks.append(mark)
            size += len(spelled[-1])
            if size > BLOCK:
                yield spelled, marks
                spelled, marks, size = [], [], 0
    if spelled:
        yield spelled, marks


@dataclass
class Level:
    """One order of the trie: nodes (code, n), contexts and for each the sums that scores need."""

    mask: int
    codes: object
    n: object
    contexts: object
    total: object
    inside: object
    excluded_total: object = None
    excluded_inside: object = None


def _level(mask: int, codes, n, total) -> Level:
    """A level from its sorted codes, their counts and the totals of their contexts."""
    import numpy as np

    contexts, of = np.unique(codes >> 8, return_inverse=True)
    whole = np.zeros(len(contexts))
    whole[of] = total
    return Level(mask, codes, n, contexts, whole, np.bincount(of, n - DISCOUNT, len(contexts)))


def _exclude(levels: list[Level]) -> list[Level]:
    """Fill in what the bytes seen in each context weigh in the next lower order."""
    import numpy as np

    for level, lower in zip(levels, levels[1:]):
        of = np.unique(level.codes >> 8, return_inverse=True)[1]
        found, hit = _find(lower.codes, level.codes & lower.mask)
        n = np.where(hit, lower.n[found] if len(lower.n) else 0.0, 0.0)
        size = len(level.contexts)
        level.excluded_total = np.bincount(of, n, size)
        level.excluded_inside = np.bincount(of, np.where(hit, n - DISCOUNT, 0.0), size)
    return levels


def fit(counts: DataFrame, nodes: int | None = None, order: int = ORDER) -> list[Level]:
    """The trie up to an order on the driver, from the counts of the highest one, highest order first.

    Counts of a lower order are sums over the bytes it forgets, made in Spark over all
    of the corpus, as is each context's total. With ``nodes``, those below one in so many
    of all bytes are left out, but for single bytes, and go to the escape. Scores of
    texts take only the orders up to ``LOW`` from here, and these whole.
    """
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    levels = []
    for order in range(order, -1, -1):
        mask = (1 << 8 * (order + 1)) - 1
        table = counts.where("n > 0").groupBy(F.col("code").bitwiseAND(mask).alias("code")).agg(F.sum("n").alias("n"))
        least = size / nodes if order and nodes else 0
        totals = table.groupBy(F.shiftrightunsigned("code", 8).alias("context")).agg(F.sum("n").alias("total"))
        # a kept node's context weighs as much as the node, so this filter drops none of them
        totals = totals.where(F.col("total") >= least)
        kept = table.where(F.col("n") >= least).withColumn("context", F.shiftrightunsigned("code", 8))
        rows = kept.join(totals, "context").select("code", "n", "total").toArrow()
        codes = rows.column("code").to_numpy()
        at = codes.argsort()
        levels.append(_level(mask, codes[at], *(rows.column(c).to_numpy()[at].astype(float) for c in ("n", "total"))))
    return _exclude(levels)


def code_scores(counts: DataFrame) -> DataFrame:
    """(code, score, uses): the log10 probability of each code of ``counts`` under the whole trie.

    All nodes count, however rare. Codes are grouped by the last ``LOW + 1`` bytes of
    their contexts, so each group has all nodes of the higher orders that its codes ask
    for; those of the lower orders are few and go with the tasks.
    """
    spark = counts.sparkSession
    low = spark.sparkContext.broadcast(fit(counts, order=LOW))

    def score(key, batches):
        import numpy as np
        import pyarrow as pa

        table = pa.Table.from_batches(list(batches))
        codes, n = table.column("code").to_numpy(), table.column("n").to_numpy().astype(float)
        known, levels = n > 0, []
        for order in range(ORDER, LOW, -1):
            mask = (1 << 8 * (order + 1)) - 1
            own, of = np.unique(codes[known] & mask, return_inverse=True)
            sums = np.bincount(of, n[known], len(own))
            context = np.unique(own >> 8, return_inverse=True)[1]
            levels.append(_level(mask, own, sums, np.bincount(context, sums)[context]))
        _exclude([*levels, low.value[0]])
        found = byte_scores([*levels, *low.value], codes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(codes), pa.array(found), table.column("uses").combine_chunks()], names=["code", "score", "uses"]
        )

    suffix = F.shiftrightunsigned("code", 8).bitwiseAND((1 << 8 * (LOW + 1)) - 1)
    return counts.withColumn("suffix", suffix).groupBy("suffix").applyInArrow(_whole(score), "code bigint, score double, uses bigint")


def _whole(function):
    def run(key, table):
        import pyarrow as pa

        return pa.Table.from_batches(list(function(key, table.to_batches())))

    return run


def _find(table, values):
    import numpy as np

    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


class Places:
    """Places of values in a sorted table, through a hash table of four slots and more for each entry.

    Values that share a slot with another entry are searched for as in ``_find``.
    """

    def __init__(self, table):
        import numpy as np

        bits = max(4 * len(table), 2).bit_length()
        self.table, self.shift = table, np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.slots[self._slot(table)] = np.arange(len(table), dtype=np.int32)

    def _slot(self, values):
        import numpy as np

        return (values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, values):
        import numpy as np

        at = self.slots[self._slot(values)]
        hit = at >= 0
        if len(self.table):
            hit &= self.table[at] == values
            other = np.flatnonzero(~hit & (at >= 0))
            at[other], hit[other] = _find(self.table, values[other])
        return at, hit


def byte_scores(levels: list[Level], codes):
    """log10 probability of each byte after its context.

    From the highest order down: a byte that the context has seen gets its count less a
    discount, over the context's total; else what is left is the escape to the next
    order, where the bytes seen here are excluded. Contexts that the trie lacks are
    passed for free. Bytes that were never seen share what is left in the end.
    """
    import numpy as np

    out, done = np.zeros(len(codes)), np.zeros(len(codes), bool)
    higher = None
    for level in levels:
        code = codes & level.mask
        at, have = _find(level.contexts, code >> 8)
        total = level.total[at] if len(level.total) else np.zeros(len(codes))
        inside = level.inside[at] if len(level.inside) else np.zeros(len(codes))
        if higher is not None and len(higher.contexts):
            up, seen = _find(higher.contexts, (codes & higher.mask) >> 8)
            total = total - np.where(seen, higher.excluded_total[up], 0.0)
            inside = inside - np.where(seen, higher.excluded_inside[up], 0.0)
        live = have & ~done & (inside > 1e-6)
        node, known = _find(level.codes, code)
        hit = live & known
        out[hit] += np.log10((level.n[node[hit]] - DISCOUNT) / total[hit])
        done |= hit
        lost = live & ~known
        out[lost] += np.log10((total[lost] - inside[lost]) / total[lost])
        higher = level
    out[~done] -= np.log10(max(256 - len(levels[-1].codes), 1))
    return out


def with_scores(docs: DataFrame, train: Column, text: str = "text") -> DataFrame:
    """Score each whole text by a model of the texts for which ``train`` is true.

    One row per row of ``docs``: ``row`` with all its columns, ``n_tokens`` (words and
    one end), ``n_known`` (tokens that the training texts have), ``train_tokens``,
    ``base_score`` (token counts with one added) and ``score``: log10 probability under the
    trie of the lowered words, each with a space after it, and the end, byte after byte;
    contexts go on from word to word. Null counts as empty: one token, the end. Without
    training rows nothing is known, the base is 0 and bytes are equally likely.

    Counts cover all training rows and all contexts, however rare. Each distinct byte in
    its context is scored once, in Spark. Frequent ones and frequent tokens go with
    the tasks, bounded by relative frequency; all others meet the texts in joins, where by
    that bound none has a large share.
    """
    import math

    spark = docs.sparkSession
    counts = stored(token_counts(docs, text, train), "tokens")
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "times")]
    total, everywhere, distinct = counts.agg(*sums, F.count(F.when(F.col("n") > 0, 1))).first()
    codes = stored(code_scores(stored(context_counts(docs, text, train), "contexts")), "codes")
    size = codes.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    rows = codes.where(F.col("uses") * HOT >= F.lit(size)).orderBy("code").toArrow()
    hot = spark.sparkContext.broadcast((rows.column("code").to_numpy(), rows.column("score").to_numpy()))
    often = counts.where(F.col("times") * FREQUENT >= F.lit(everywhere)).toArrow()
    frequent = spark.sparkContext.broadcast(dict(zip(often.column("token").to_pylist(), often.column("n").to_pylist())))
    base = math.log10(total + distinct + 1)

    row = docs.select(F.struct("*").alias("row"))
    fields = (
        "n_tokens bigint, known bigint, part double, score double, "
        "tokens array<binary>, times array<int>, codes array<bigint>, uses array<bigint>"
    )
    schema = T.StructType([row.schema[0], *T.StructType.fromDDL(fields).fields])

    def score(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        often = {token: (n > 0, math.log10(n + 1)) for token, n in frequent.value.items()}
        places, value = Places(hot.value[0]), hot.value[1]

        def coded(spelled):
            """For each text the sum of its frequent codes; its other codes and their number."""
            sums, rare = np.zeros(len(spelled)), []
            for code, own in _codes(spelled):
                at, hit = places.find(code)
                if len(value):
                    sums += np.bincount(own[hit], value[at[hit]], len(spelled))
                rare.append((code[~hit], own[~hit]))
            code, own = (np.concatenate(x) for x in zip(*rare))
            order = np.lexsort((code, own))
            code, own = code[order], own[order]
            new = np.append(True, (code[1:] != code[:-1]) | (own[1:] != own[:-1])) if len(code) else np.empty(0, bool)
            first = np.flatnonzero(new)
            ends = pa.array(np.append(0, np.cumsum(np.bincount(own[first], minlength=len(spelled)))), pa.int32())
            uses = np.diff(np.append(first, len(code)))
            return sums, pa.ListArray.from_arrays(ends, pa.array(code[first])), pa.ListArray.from_arrays(ends, pa.array(uses))

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found, spelled = [], []
                for x in utf8(part.column("row").field(text)):
                    tokens = x.lower().split()
                    spelled.append(_spelled(tokens))
                    seen = Counter(tokens)
                    seen[b""] = 1
                    known, sums, rare = 0, 0.0, {}
                    for token, times in seen.items():
                        hit = often.get(token)
                        if hit is None:
                            rare[token] = times
                        else:
                            known += times * hit[0]
                            sums += times * hit[1]
                    found.append((len(tokens) + 1, known, sums, list(rare), list(rare.values())))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32()))
                n, known, sums, tokens, times = (pa.array(list(x), kind) for x, kind in zip(zip(*found), kinds))
                scores, others, uses = coded(spelled)
                arrays = [part.column("row"), n, known, sums, pa.array(scores), tokens, times, others, uses]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    scored = row.mapInArrow(score, schema).withColumn("uid", F.monotonically_increasing_id())
    scored = stored(scored, "scored")  # fixes the numbers of the rows

    def listed(what: str, times: str) -> DataFrame:
        each = scored.select("uid", F.explode(F.arrays_zip(what, times)).alias("x"))
        return each.select("uid", F.col(f"x.{what}").alias("asked"), F.col(f"x.{times}").alias("by"))

    words = listed("tokens", "times").join(counts, F.col("asked") == F.col("token")).groupBy("uid").agg(
        F.sum(F.when(F.col("n") > 0, F.col("by")).otherwise(0)).alias("more"),
        F.sum(F.col("by") * F.log10(F.col("n") + 1)).alias("rest"),
        F.lit(0.0).alias("bytes"),
    )
    rare = codes.select("code", F.col("score").alias("value"))
    spelled = listed("codes", "uses").join(rare, F.col("asked") == F.col("code")).groupBy("uid").agg(
        F.lit(0).cast("long").alias("more"), F.lit(0.0).alias("rest"), F.sum(F.col("by") * F.col("value")).alias("bytes")
    )
    met = words.unionByName(spelled).groupBy(F.col("uid").alias("of")).agg(*(F.sum(c).alias(c) for c in ("more", "rest", "bytes")))
    joined = scored.drop("tokens", "times", "codes", "uses").join(met, F.col("uid") == F.col("of"), "left")
    zero = F.lit(0.0)
    return joined.select(
        "row",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("rest", zero) - F.col("n_tokens") * base).alias("base_score"),
        (F.col("score") + F.coalesce("bytes", zero)).alias("score"),
    )
