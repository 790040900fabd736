"""Benchmark decontamination by latent semantic retrieval and checks of the passages found."""

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.llm.common import hashable, stored

#: Words are hashed to this many features.
FEATURES = 1 << 15
#: A window is two blocks of words; windows overlap by one block.
BLOCK = 32
RANK, OVERSAMPLE, POWER = 128, 16, 1
#: Windows of documents in the matrix whose singular vectors span the latent space. This
#: bounds the fit only: word statistics, the index and the search cover all windows.
FIT_WINDOWS = 4_096
#: Share of the matrix's energy that these windows get, against the benchmark's items.
FIT_SHARE = 0.2
#: A pair is checked if the window holds this much of what the space sees of the item, by
#: energy, and of what two blocks hold at least of a passage of its length. Neither the rest
#: of the window nor the rank counts against an item.
MIN_HELD = 0.35
#: A whole item: this share of its words in order. A paraphrase: fewer, but the answer too,
#: and half of the whole item; for these, words count by their inverse frequency.
MIN_LCS, PARAPHRASE_LCS, MIN_ANSWER, MIN_CONTENT = 0.75, 0.5, 0.8, 0.5
#: Items that share a latent space, and spaces that go with one pass over the texts.
ITEMS_PER_BLOCK, BLOCKS_PER_PASS = 400, 10
MIN_ITEM_WORDS = 4
CACHE = 500_000
#: Parts in which a summed matrix comes to the driver, one after the other.
PARTS_OF_SUM = 8


#: Bytes of words: lowered letters, digits, the underscore, and all of other scripts.
WORD_BYTES = b"abcdefghijklmnopqrstuvwxyz0123456789_" + bytes(range(128, 256))


def word_ids():
    """A function from a text to its words' 32-bit hashes."""
    import numpy as np
    from xxhash import xxh32_intdigest

    blanks = bytes(c if c in WORD_BYTES else 32 for c in range(256))

    class Hashes(dict):
        def __missing__(self, word):
            self[word] = found = xxh32_intdigest(word)
            return found

    seen = Hashes()

    def ids(text: str):
        found = text.lower().encode("utf-8", "replace").translate(blanks).split()
        if len(seen) > CACHE:
            seen.clear()
        return np.fromiter(map(seen.__getitem__, found), np.uint32, len(found))

    return ids


def _blocks(ids):
    """The features of a text in rows of one block; repeats in a block and padding are ``FEATURES``."""
    import numpy as np

    rows = np.full(-(-len(ids) // BLOCK) * BLOCK, FEATURES, np.int64)
    rows[: len(ids)] = ids & np.uint32(FEATURES - 1)
    rows = np.sort(rows.reshape(-1, BLOCK), axis=1)
    rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = FEATURES
    return rows


def _sums(features, vectors):
    """Sum of the vectors of each row's features; the last vector is zero."""
    import numpy as np

    step = 64  # blocks, so that the gathered vectors stay in cache
    parts = [np.einsum("ijk->ik", vectors.take(features[i : i + step], axis=0)) for i in range(0, len(features), step)]
    return np.concatenate(parts)


def _vector(ids, vectors):
    """The latent vector of an item: each of its words once."""
    import numpy as np

    return vectors[np.unique(ids & np.uint32(FEATURES - 1))].sum(axis=0)


def document_frequencies(docs: DataFrame, text: str = "text"):
    """In how many blocks each feature occurs, and the number of blocks, over all texts.

    A task adds up its own texts and sends one number for each feature it has met.
    """
    import numpy as np

    def count(batches):
        import pyarrow as pa

        ids, total, blocks = word_ids(), np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                found = [_blocks(ids(value or "")) for value in batch.column(0).slice(start, 256).to_pylist()]
                found = np.concatenate(found)
                total += np.bincount(found.ravel(), minlength=FEATURES + 1)[:FEATURES]
                blocks += len(found)
        hit = np.flatnonzero(total)
        features = np.append(hit, FEATURES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(features.astype(np.int32)), pa.array(np.append(total[hit], blocks))], names=["feature", "n"]
        )

    partial = docs.select(text).mapInArrow(count, "feature int, n bigint")
    rows = partial.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()  # FEATURES + 1 rows at most
    out = np.zeros(FEATURES + 1, np.int64)
    out[rows.column("feature").to_numpy()] = rows.column("n").to_numpy()
    return out[:FEATURES], int(out[FEATURES])


def _orthonormal(y):
    """An orthonormal basis of the columns of ``y``, in its place; directions it lacks become zero.

    By the eigenvectors of its Gram matrix, twice for precision. Rows are taken in blocks,
    so that double precision never needs a second matrix of this size on the driver.
    """
    import numpy as np

    blocks = [slice(at, at + 4096) for at in range(0, len(y), 4096)]
    for _ in range(2):
        gram = np.zeros((y.shape[1], y.shape[1]))
        for b in blocks:
            part = y[b].astype(np.float64)
            gram += part.T @ part
        values, vectors = np.linalg.eigh(gram)
        there = values > 1e-12 * max(values[-1], 1e-300)
        turn = vectors * np.where(there, 1 / np.sqrt(np.where(there, values, 1)), 0)
        for b in blocks:
            y[b] = y[b].astype(np.float64) @ turn
    return y


def randomised_svd(passages: DataFrame, idf, rank: int = RANK, oversample: int = OVERSAMPLE, power: int = POWER):
    """Right singular vectors (features x rank) of the TF-IDF matrix of ``passages``.

    ``passages`` has ``words`` (binary, 32-bit hashes) and ``weight``. Rows are scaled to
    unit length times weight. Each product with the matrix and its transpose is one
    Spark job: a task makes its part of A'(A X), the parts are summed by feature block,
    and only the sum, of a fixed size, reaches the driver, a few blocks at a time. Tasks draw
    the random start themselves, and of the last product only (A Q)'(A Q) is asked for. So the
    driver holds one such matrix, and two while the result is made from the last.
    """
    import numpy as np

    width, cut = rank + oversample, 512

    context = passages.sparkSession.sparkContext

    def start():
        return np.random.default_rng(7).standard_normal((FEATURES, width), np.float32)

    def scaled(batches):
        for batch in batches:
            for raw, weight in zip(batch.column("words").to_pylist(), batch.column("weight").to_pylist()):
                f = np.unique(np.frombuffer(raw, np.uint32) & np.uint32(FEATURES - 1))
                if not len(f):
                    continue
                a = idf[f].astype(np.float32)
                a *= weight / max(float(np.linalg.norm(a)), 1e-12)
                yield f, a

    def summed(partial, height, kind):
        """Sum of the tasks' matrices (``height`` x width), which ``partial`` makes of their rows; None without rows."""

        def run(batches):
            import pyarrow as pa

            total = partial(scaled(batches))
            if total is not None:
                blocks = range(0, height, cut)
                values = [total[b : b + cut].tobytes() for b in blocks]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(blocks), pa.int32()), pa.array(values, pa.binary())], names=["block", "part"]
                )

        def add(key, tables):
            import pyarrow as pa

            total = None
            for table in tables:
                for raw in table.column("part").to_pylist():
                    part = np.frombuffer(raw, kind)
                    total = part.copy() if total is None else total + part
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()])], names=["block", "part"])

        parts = passages.mapInArrow(run, "block int, part binary")
        sums = parts.groupBy("block").applyInArrow(_as_batches(add), "block int, part binary")
        out = np.zeros((height, width), kind)
        # a collected matrix would be on the driver several times over, in the JVM and in Python
        for r in sums.coalesce(PARTS_OF_SUM).toLocalIterator(prefetchPartitions=True):
            out[r["block"] : r["block"] + cut] = np.frombuffer(r["part"], kind).reshape(-1, width)
        return out

    def product(held):
        """A'(A X) for the broadcast X, for the random start without one."""

        def partial(rows):
            total = None
            for f, a in rows:
                if total is None:
                    x, total = start() if held is None else held.value, np.zeros((FEATURES, width), np.float32)
                total[f] += np.outer(a, a @ x[f])
            return total

        return summed(partial, FEATURES, np.float32)

    def gram(held):
        """(A Q)'(A Q) for the broadcast Q."""

        def partial(rows):
            total = None
            for f, a in rows:
                y = (a @ held.value[f]).astype(np.float64)
                total = np.zeros((width, width)) if total is None else total
                total += np.outer(y, y)
            return total

        return summed(partial, width, np.float64)

    q = _orthonormal(product(None))
    for _ in range(power):
        held = context.broadcast(q)  # FEATURES x width floats
        del q
        q = _orthonormal(product(held))
        held.destroy()
    held = context.broadcast(q)
    small = gram(held)  # the Gram matrix of A, in the basis found
    held.destroy()
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    turn = vectors[:, ::-1][:, :rank]
    out = np.empty((FEATURES, rank), np.float32)
    for at in range(0, FEATURES, 4096):  # in double precision, as in ``_orthonormal``
        out[at : at + 4096] = q[at : at + 4096] @ turn
    return out


def _as_batches(function):
    def run(key, table):
        import pyarrow as pa

        return pa.Table.from_batches(list(function(key, [table])))

    return run


def lcs(item: list[int], passage: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over the item's words."""
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in passage:
        m = row & where.get(w, 0)
        if m:
            row = ((row + m) | (row - m)) & full
    return len(item) - row.bit_count()


@dataclass
class Items:
    """A block of benchmark items: ids, word hashes, (hash, idf) of all words and of the answers', and
    their space: latent vectors, the energy it sees, and the value from which a window is checked."""

    ids: list
    words: list
    content: list
    answers: list
    space: object
    vectors: object
    energy: object
    least: object
    features: object
    starts: object


def _closest(item: list[int], passage: list[int]) -> tuple[int, list[int]]:
    """The longest common subsequence with a span of twice the item's words, and the span.

    Words of a short item that lie scattered over a long passage are no copy of it.
    """
    size, step = 2 * len(item), max(1, len(item) // 2)
    starts = range(0, max(0, len(passage) - size) + step, step)
    spans = [passage[at : at + size] for at in starts]
    return max(((lcs(item, x), x) for x in spans), key=lambda found: found[0])


def _share(weighed: list[tuple[int, float]], met: set[int]) -> float:
    return sum(x for w, x in weighed if w in met) / max(sum(x for _, x in weighed), 1e-9)


def _answer(text: str, ids) -> list[int]:
    """Word hashes of the answer: the item's last line or sentence, four words of it at least."""
    import re

    parts = [p for p in re.split(r"(?<=[.!?:])\s+|\n", text) if re.search(r"\w", p)]
    tail: list[int] = []
    while parts and len(tail) < 4:
        tail = ids(parts.pop()).tolist() + tail
    return tail


def _covered(n: int) -> float:
    """Share of a passage of ``n`` words that the best window holds at least, however they lie."""
    return min(n, (n + BLOCK) / 2, 2 * BLOCK) / n


def _block(chosen: list, scaled, space, idf, ids) -> Items:
    """The items (id, text, word hashes) with their vectors in ``scaled``, which ``space`` broadcasts.

    The broadcast's own value is left alone, as the driver would load and keep it.
    """
    import numpy as np

    words = [w for _, _, w in chosen]
    vectors = np.stack([_vector(w, scaled) for w in words]).astype(np.float32)
    energy = np.einsum("ij,ij->i", vectors, vectors)
    whole = np.array([np.square(idf[np.unique(w & np.uint32(FEATURES - 1))]).sum() for w in words])
    least = MIN_HELD * energy * np.array([_covered(len(w)) for w in words])
    least[energy < 1e-4 * whole] = -np.inf  # the space is blind to it, so all windows are checked
    size = np.array([len(w) for w in words])
    weighed = lambda ws: [(w, float(idf[w & (FEATURES - 1)])) for w in ws]
    return Items(
        [i for i, _, _ in chosen],
        [w.tolist() for w in words],
        [weighed(w.tolist()) for w in words],
        [weighed(_answer(t, ids)) for _, t, _ in chosen],
        space,
        vectors,
        energy,
        least.astype(np.float32),
        np.concatenate(words) & np.uint32(FEATURES - 1),
        np.cumsum(size) - size,
    )


def _leaks(ids, squares, blocks: list[Items]) -> tuple[int, list[dict]]:
    """Number of windows, and the items found in a text of these words.

    A window's part along an item's latent vector is set against the energy that the
    space sees of the item. Pairs with fewer of the item's words than any finding needs
    are left before words are compared in order.
    """
    import numpy as np

    features = _blocks(ids)
    weight = squares.take(features).sum(axis=1)
    if len(weight) > 1:
        weight = weight[:-1] + weight[1:]
    present = np.zeros(FEATURES, bool)
    present[ids & np.uint32(FEATURES - 1)] = True
    leaks = []
    for items in blocks:
        sums = _sums(features, items.space.value)
        if len(sums) > 1:
            sums = sums[:-1] + sums[1:]
        along = sums @ items.vectors.T
        at, which = np.nonzero(along >= items.least)
        if not len(at):
            continue
        shared = np.add.reduceat(present[items.features], items.starts, dtype=np.int64)
        enough = shared >= PARAPHRASE_LCS * np.diff(np.append(items.starts, len(items.features)))
        keep = enough[which]
        found: dict[int, dict] = {}
        for w, k in zip(at[keep].tolist(), which[keep].tolist()):
            item = items.words[k]
            low = max(0, w * BLOCK - len(item))
            high = (w + 2) * BLOCK + len(item)
            passage = ids[low:high].tolist()
            met = set(passage)
            if sum(x in met for x in item) < PARAPHRASE_LCS * len(item):
                continue
            if lcs(item, passage) < PARAPHRASE_LCS * len(item):
                continue
            hits, span = _closest(item, passage)
            share = hits / len(item)
            if share < PARAPHRASE_LCS or (k in found and found[k]["lcs"] >= share):
                continue
            met = set(span)
            answer = _share(items.answers[k], met)
            if share >= MIN_LCS or answer >= MIN_ANSWER and _share(items.content[k], met) >= MIN_CONTENT:
                cosine = float(along[w, k] / np.sqrt(max(items.energy[k] * weight[w], 1e-9)))
                best = {"item_id": items.ids[k], "lcs": share, "answer": answer, "cosine": cosine}
                found[k] = best | {"first_word": low, "last_word": min(high, len(ids))}
        leaks += found.values()
    return len(weight), leaks


LEAK = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("lcs", T.DoubleType()),
        T.StructField("answer", T.DoubleType()),
        T.StructField("cosine", T.DoubleType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
    ]
)


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(row, n_windows, leaks) for each row: the benchmark items that its text holds, whole or paraphrased.

    Texts are cut into overlapping windows of 64 words. Windows and items are TF-IDF
    vectors, in which a word counts once a block. Items are dealt into blocks, each with a
    latent space of its own, which a distributed randomised SVD finds from its items and a
    sample of windows (``FIT_WINDOWS``): so the rank grows with the benchmark. Every window
    of every text is compared with every item in the item's space. Pairs of ``MIN_HELD`` or
    more, whatever else the window holds, are checked: longest common subsequence of words
    with a span of twice the item's length in the window and its surroundings, over the item's length, of ``MIN_LCS``; or of ``PARAPHRASE_LCS`` with
    ``MIN_ANSWER`` of the item's answer (its last sentence) and ``MIN_CONTENT`` of the item,
    weighed by inverse frequency, there as well.

    The items are a stated query set: ``ITEMS_PER_BLOCK`` of them share a space and
    ``BLOCKS_PER_PASS`` spaces go with the tasks of one pass over the texts; the leaks of
    several passes are stored one after the other and met by a join. Null and empty texts have no leaks. Items
    under four words can't be told from chance and are left out. An empty benchmark, or
    one of such items only, finds nothing. Other columns stay; equal rows get equal results.
    """
    import numpy as np

    spark = docs.sparkSession
    frequency, blocks = document_frequencies(docs, text)
    idf = np.log((1 + blocks) / (1 + frequency)).astype(np.float32) + 1e-3

    make = word_ids
    columns = [F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("item_text")]
    items = benchmark.select(*columns).where("item_text IS NOT NULL")
    count = items.count()

    def hashed(batches):
        import pyarrow as pa

        ids = make()
        for batch in batches:
            found = [ids(x or "").tobytes() for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1)], names=["words", "weight"])

    def sampled(batches):
        import pyarrow as pa

        ids = make()
        for batch in batches:
            found = []
            for value, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = ids(value)
                windows = max(1, len(own) // BLOCK)
                at = key % windows * BLOCK
                found.append(own[at : at + 2 * BLOCK].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["words"])

    n_docs = docs.count()
    rate = min(1.0, FIT_WINDOWS / max(n_docs, 1))
    # a share of the texts, the same ones each time, and one window of each
    key = F.xxhash64(*hashable(docs)).bitwiseAND(0x7FFFFFFFFFFFFFFF)  # of the row, as copies would come together
    some = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("_t"), key.alias("_k")).where(key % 1_000_003 < math.ceil(rate * 1_000_003))
    windows = stored(some.mapInArrow(sampled, "words binary"), "windows") if count else None
    squares = np.append(idf**2, 0).astype(np.float32)

    def space(part: DataFrame, size: int):
        """The latent space of a block of items, features scaled: FEATURES x RANK floats and a row of zeros."""
        weight = math.sqrt(FIT_SHARE / (1 - FIT_SHARE) * size / max(1.0, rate * n_docs))
        own = part.select("item_text", F.lit(1.0).alias("weight")).mapInArrow(hashed, "words binary, weight double")
        passages = stored(own.unionByName(windows.withColumn("weight", F.lit(weight))), "passages")
        scaled = np.zeros((FEATURES + 1, RANK), np.float32)
        np.multiply(idf[:, None], randomised_svd(passages, idf), out=scaled[:-1])
        return scaled

    row = docs.select(F.struct("*").alias("row"))
    schema = T.StructType(
        [row.schema[0], T.StructField("n_windows", T.LongType()), T.StructField("leaks", T.ArrayType(LEAK))]
    )

    def search(blocks: list[Items]):
        def run(batches):
            import pyarrow as pa
            from pyspark.sql.pandas.types import to_arrow_type

            ids, kind = make(), to_arrow_type(T.ArrayType(LEAK))
            for batch in batches:
                windows, leaks = [], []
                for value in batch.column("row").field(text).to_pylist():
                    own = ids(value or "")
                    n, found = _leaks(own, squares, blocks) if len(own) and blocks else (0, [])
                    windows.append(n)
                    leaks.append(found)
                arrays = [batch.column("row"), pa.array(windows, pa.int64()), pa.array(leaks, kind)]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "n_windows", "leaks"])

        return run

    ids = make()
    parts = max(1, -(-count // ITEMS_PER_BLOCK))

    def spaces(numbers) -> list[Items]:
        found = []
        for number in numbers:
            part = items.where(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(parts)) == number)
            mine = part.collect()
            chosen = [(r["item_id"], r["item_text"], ids(r["item_text"])) for r in mine]
            chosen = sorted((x for x in chosen if len(x[2]) >= MIN_ITEM_WORDS), key=lambda x: (x[0] is None, x[0], x[1]))
            if chosen:
                scaled = space(part, len(mine))
                found.append(_block(chosen, scaled, spark.sparkContext.broadcast(scaled), idf, ids))
                del scaled  # before the next space is made
        return found

    passes = [range(at, min(at + BLOCKS_PER_PASS, parts)) for at in range(0, parts, BLOCKS_PER_PASS)]
    if len(passes) == 1:
        return row.mapInArrow(search(spaces(passes[0])), schema)
    # each pass is a job of its own that leaves its leaks in the shared folder, so driver and
    # workers hold the spaces of one pass at a time
    placed = stored(row.withColumn("place", F.monotonically_increasing_id()), "placed")
    leaks = []
    texts = placed.select(F.struct(F.col(f"row.`{text}`").alias(text), "place").alias("row"))
    wide = T.StructType([texts.schema[0], *schema.fields[1:]])
    for numbers in passes:
        blocks = spaces(numbers)
        found = texts.mapInArrow(search(blocks), wide).select("row.place", "n_windows", "leaks")
        leaks.append(stored(found.where((F.size("leaks") > 0) | F.lit(not leaks)), "leaks"))
        for items_of_block in blocks:
            items_of_block.space.destroy()
    every = reduce(DataFrame.unionByName, leaks).groupBy("place").agg(
        F.max("n_windows").alias("n_windows"), F.flatten(F.collect_list("leaks")).alias("leaks")
    )
    return placed.join(every.withColumnRenamed("place", "at"), F.col("place") == F.col("at")).select("row", "n_windows", "leaks")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with the columns of ``docs``."""
    return with_leaks(docs, benchmark, text).where(F.size("leaks") == 0).select("row.*")
