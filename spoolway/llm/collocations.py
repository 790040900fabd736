"""Phrase collocations: n-gram counts from FM-indexes over word ids, one index per shard.

A shard is some text of one language. Its index holds the Burrows-Wheeler transform of
the shard's word ids, once as they stand and once reversed, sorted as deep as the
phrases of the present level are long. An interval of the first is extended to the
left, one of the second to the right. Counts of all shards are summed between the
levels, and each shard gets back which of its phrases are frequent, so that a level
extends only these.
"""

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spoolway.llm.common import stored

MIN_COUNT = 30
MOST_WORDS = 4
#: A candidate goes if a longer one has at least this percentage of its count.
CONTAINED_PERCENT = 80
TOP = 2000
#: Text and word ids that make up a shard, and text that a task gathers for all its languages.
SHARD_BYTES = 6 << 20
SHARD_WORDS = 1 << 20
GATHERED_BYTES = 48 << 20
#: Phrases of all shards that are summed by one call.
GRAMS_PER_SUM = 1 << 20
#: A word is numbered by the first shard that has it; a shard has fewer words than this.
WORDS_OF_SHARD = 1 << 22

# ``.`` ends a piece and so is never part of a word; blanks become spaces, capitals small letters.
_TABLE = bytearray(range(256))
_TABLE[9] = 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = ord(".")
for _c in range(ord("A"), ord("Z") + 1):
    _TABLE[_c] = _c + 32
TABLE = bytes(_TABLE)


def word_ids(texts: list[bytes]):
    """Word numbers of the texts, from 1, with 0 between pieces; and the words, from number 1 on."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    # a mark at both ends, as the dictionary is in order of appearance and blank ends would give empty words
    marked = b" . ".join([b".", b".".join(texts).translate(TABLE).replace(b".", b" . "), b"."])
    found = pc.ascii_split_whitespace(pa.array([marked], pa.large_binary()).cast(pa.large_string()))
    coded = found.flatten().dictionary_encode()
    return coded.indices.to_numpy().astype(np.int32), coded.dictionary.slice(1)


def cut(ids, most: int) -> Iterator[tuple[int, object]]:
    """Stretches of at most ``most`` ids with their sign.

    Neighbouring stretches share ``MOST_WORDS`` - 1 ids, and phrases inside these are
    taken off again by a stretch of negative sign. So no count depends on the cuts.
    """
    import numpy as np

    shared, at, twice = MOST_WORDS - 1, 0, []
    while True:
        yield 1, ids[at : at + most]
        if at + most >= len(ids):
            break
        at += most - shared
        twice += [ids[at : at + shared], np.zeros(1, ids.dtype)]
    if twice:
        yield -1, np.concatenate(twice)


def packed(values) -> bytes:
    """Whole numbers, compressed by byte planes."""
    import numpy as np
    import pyarrow as pa

    values = np.ascontiguousarray(values, np.int64)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + (pa.compress(planes.tobytes(), "zstd", asbytes=True) if len(values) else b"")


def unpacked(data: bytes):
    import numpy as np
    import pyarrow as pa

    n = int.from_bytes(data[:8], "little")
    if n == 0:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data[8:], n * 8, "zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


class WordIndex:
    """The Burrows-Wheeler transform of word ids, sorted by the first ``depth`` words, and its ranks."""

    def __init__(self, ids, depth: int):
        import numpy as np

        # a mark at the end, so that the last word stands before something as well
        ids = np.append(ids, 0)
        n = len(ids)
        rank = ids.astype(np.int64)
        for k in range(1, depth):
            # the rank by k words, then the word behind them
            behind = np.concatenate([ids[k:], np.zeros(min(k, n), ids.dtype)])
            rank = np.unique(rank * (int(ids.max(initial=0)) + 1) + behind, return_inverse=True)[1]
        order = np.argsort(rank, kind="stable")
        self.bwt = ids[order - 1].astype(np.int64)
        self.bwt[order == 0] = 0
        top = int(ids.max(initial=0)) + 2
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=top))])
        self.before = np.concatenate([[0], np.cumsum(np.bincount(self.bwt, minlength=top))])
        # positions of each word in the transform: a rank is a search among them
        self.n = n + 1
        by_word = np.argsort(self.bwt, kind="stable")
        self.places = self.bwt[by_word] * self.n + by_word

    def rank(self, words, at):
        """How often each word stands before each position of the transform."""
        import numpy as np

        return np.searchsorted(self.places, words * self.n + at) - self.before[words]

    def find(self, phrases):
        """The intervals of phrases (one a row), by backward search."""
        words = phrases[:, -1]
        low, high = self.first[words], self.first[words + 1]
        for k in range(phrases.shape[1] - 2, -1, -1):
            words = phrases[:, k]
            low, high = self.first[words] + self.rank(words, low), self.first[words] + self.rank(words, high)
        return low, high

    def extensions(self, low, high):
        """(interval, word, count) of all words that stand before the intervals."""
        import numpy as np

        sizes = high - low
        owner = np.repeat(np.arange(len(low)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
        words = self.bwt[at]
        inside = words > 0
        top = len(self.first)
        found, counts = np.unique(owner[inside] * top + words[inside], return_counts=True)
        return found // top, found % top, counts


def members(rows, of, top: int):
    """Which rows of word ids are among the rows ``of``."""
    import numpy as np

    both = np.concatenate([of, rows])
    code = both[:, 0]
    for k in range(1, both.shape[1]):
        code = np.unique(code * top + both[:, k], return_inverse=True)[1]
    return np.isin(code[len(of) :], code[: len(of)])


def compacted(ids, phrases):
    """The ids with words outside all given phrases (local ids) left out; one 0 stands for each gap."""
    import numpy as np

    n, width = len(ids), phrases.shape[1]
    covered = np.zeros(n, bool)
    if n >= width and len(phrases):
        windows = np.lib.stride_tricks.sliding_window_view(ids, width).astype(np.int64)
        starts = np.flatnonzero((windows > 0).all(axis=1))
        starts = starts[members(windows[starts], phrases, int(max(ids.max(), phrases.max())) + 1)]
        for k in range(width):
            covered[starts + k] = True
    left = np.where(covered, ids, 0)
    return left[(left > 0) | np.concatenate([[True], left[:-1] > 0])] if n else left


def extended(ids, phrases):
    """Phrases one word longer than the given ones, with counts; both shorter parts are among these.

    Even lengths come from extensions to the right, odd ones to the left.
    """
    import numpy as np

    width = phrases.shape[1]
    rightward = width % 2 == 1
    index = WordIndex(ids[::-1] if rightward else ids, width)
    low, high = index.find(phrases[:, ::-1] if rightward else phrases)
    owner, words, counts = index.extensions(low, high)
    parts = [phrases[owner], words[:, None]] if rightward else [words[:, None], phrases[owner]]
    longer = np.concatenate(parts, axis=1)
    kept = members(longer[:, 1:] if rightward else longer[:, :-1], phrases, len(index.first))
    return longer[kept], counts[kept]


def shards(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``shard, lang, sign, ids, words, counts``: the whole texts of ``docs`` as word ids.

    Shards hold texts of one task and one language, so nothing is shuffled and a
    language of many rows has many shards.
    """

    def gather(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        texts, sizes, gathered = {}, {}, 0

        def given(name):
            nonlocal made, gathered
            ids, words = word_ids(texts.pop(name))
            gathered -= sizes.pop(name)
            for sign, stretch in cut(ids, SHARD_WORDS):
                used, local, counts = np.unique(stretch, return_inverse=True, return_counts=True)
                own = used > 0
                if not own.any():
                    continue
                local = local if used[0] == 0 else local + 1
                row = [(part << 20) + made, name, sign, packed(local)]
                row += [words.take(pa.array(used[own] - 1)).cast(pa.string()).to_pylist(), counts[own].tolist()]
                made += 1
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

        names = ["shard", "lang", "sign", "ids", "words", "counts"]
        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                texts.setdefault(name, []).append(value)
                sizes[name] = sizes.get(name, 0) + len(value)
                gathered += len(value)
                if sizes[name] >= SHARD_BYTES:
                    yield from given(name)
                elif gathered >= GATHERED_BYTES:
                    yield from given(max(sizes, key=sizes.get))
        for name in list(texts):
            yield from given(name)

    slim = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    return slim.mapInArrow(gather, "shard bigint, lang string, sign int, ids binary, words array<string>, counts array<bigint>")


def _known_words(pieces: DataFrame, min_count: int) -> DataFrame:
    """``shard, lang, local, word, f, id`` of the frequent words of each shard; ``id`` is the same in all shards."""
    rows = pieces.select("shard", "lang", "sign", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "x"))
    rows = rows.select(
        "shard", "lang", (F.col("local") + 1).alias("local"), F.col("x.words").alias("word"), (F.col("x.counts") * F.col("sign")).alias("n")
    )
    # a word has one row a shard
    same = Window.partitionBy("lang", "word")
    own = F.col("shard") * WORDS_OF_SHARD + F.col("local")
    known = rows.withColumns({"f": F.sum("n").over(same), "id": F.min(own).over(same)})
    return known.where(F.col("f") >= min_count).drop("n")


LEVEL = "kind string, lang string, shard bigint, sign int, bucket bigint, ids binary, vocabulary binary, counts binary"
SUMMED = "kind string, lang string, shard bigint, phrase array<bigint>, f bigint, grams binary"


def _level(width: int, buckets: int):
    """The work of one shard at one level: its phrases of ``width`` words, by buckets, and what is left of its text."""

    def grow(shard, found):
        import zlib

        import numpy as np
        import pyarrow as pa

        schema = pa.schema(
            [("kind", pa.string()), ("lang", pa.string()), ("shard", pa.int64()), ("sign", pa.int32()), ("bucket", pa.int64())]
            + [(c, pa.binary()) for c in ("ids", "vocabulary", "counts")]
        )
        rows = []
        if shard.num_rows and found.num_rows:
            number, lang, sign = (shard.column(c)[0].as_py() for c in ("shard", "lang", "sign"))
            ids = unpacked(shard.column("ids")[0].as_py())
            if width == 2:
                # words by their numbers in all shards; rare words become gaps
                local, known = (found.column(c).to_numpy() for c in ("local", "id"))
                vocabulary, place = np.unique(known, return_inverse=True)
                renamed = np.zeros(int(max(ids.max(), local.max())) + 1, np.int64)
                renamed[local] = place + 1
                ids = renamed[ids]
                phrases = np.arange(1, len(vocabulary) + 1)[:, None]
            else:
                vocabulary = unpacked(shard.column("vocabulary")[0].as_py())
                lists = [unpacked(x).reshape(-1, width - 1) for x in found.column("grams").to_pylist()]
                phrases = np.searchsorted(vocabulary, np.concatenate(lists)) + 1
            ids = compacted(ids, phrases)
            longer, counts = extended(ids, phrases)
            if len(longer):
                used, local = np.unique(ids, return_inverse=True)
                local = local if used[0] == 0 else local + 1
                rows.append(("shard", lang, number, sign, None, packed(local), packed(vocabulary[used[used > 0] - 1]), None))
                longer = vocabulary[longer - 1]
                mixed = np.full(len(longer), zlib.crc32(lang.encode()), np.uint64)
                for k in range(width):
                    mixed = (mixed ^ longer[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    mixed ^= mixed >> np.uint64(29)
                bucket = (mixed >> np.uint64(8)).astype(np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                numbers, starts = np.unique(bucket[order], return_index=True)
                for b, at in zip(numbers.tolist(), np.split(order, starts[1:])):
                    # column by column, as these compress better
                    rows.append(("grams", lang, number, sign, b, packed(longer[at].T.ravel()), None, packed(counts[at] * sign)))
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return grow


def _summing(width: int, min_count: int):
    """Sums the phrases of one bucket over all shards and tells each shard which of its own are frequent."""

    def total(table):
        import numpy as np
        import pyarrow as pa

        rows = []
        langs = np.array(table.column("lang").to_pylist(), dtype=object)
        shard = table.column("shard").to_pylist()
        grams, counts = table.column("ids").to_pylist(), table.column("counts").to_pylist()
        for lang in sorted(set(langs)):
            at = np.flatnonzero(langs == lang)
            lists = [unpacked(grams[i]).reshape(width, -1) for i in at]
            every = np.concatenate(lists, axis=1)
            order = np.lexsort(every[::-1])
            every = every[:, order]
            new = np.concatenate([[True], (every[:, 1:] != every[:, :-1]).any(axis=0)])
            starts = np.flatnonzero(new)
            sums = np.add.reduceat(np.concatenate([unpacked(counts[i]) for i in at])[order], starts)
            frequent = sums >= min_count
            for s, f in zip(starts[frequent], sums[frequent].tolist()):
                rows.append(("gram", lang, None, every[:, s].tolist(), f, None))
            mine = np.empty(len(order), bool)
            mine[order] = frequent[np.cumsum(new) - 1]
            ends = np.cumsum([x.shape[1] for x in lists])
            for i, x, keep in zip(at, lists, np.split(mine, ends[:-1])):
                if keep.any():
                    rows.append(("back", lang, shard[i], None, None, packed(x[:, keep].T.ravel())))
        kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary()]
        names = ["kind", "lang", "shard", "phrase", "f", "grams"]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return total


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words ``lang, id, word, f``, frequent phrases ``lang, phrase, f`` of 1 to ``MOST_WORDS`` word ids, and ``lang, n``.

    Counts are exact and over whole texts. A phrase is extended only if it is frequent,
    as no longer phrase is more frequent than its parts.
    """
    pieces = stored(shards(docs, lang, text), "shards")
    known = stored(_known_words(pieces, min_count), "words")
    each = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x) * F.col("sign")
    totals = stored(pieces.groupBy("lang").agg(F.sum(each).alias("n")), "totals")
    words = known.where(F.col("id") == F.col("shard") * WORDS_OF_SHARD + F.col("local")).select("lang", "id", "word", "f")
    counts = [words.select("lang", F.array("id").alias("phrase"), "f")]
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-all_words // GRAMS_PER_SUM))
    left, found = pieces.select("shard", "lang", "sign", "ids"), known.select("shard", "local", "id")
    for width in range(2, MOST_WORDS + 1):
        grown = left.groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(_level(width, buckets), LEVEL)
        grown = stored(grown, f"level-{width}")
        summed = grown.where("kind = 'grams'").select("lang", "shard", "bucket", "ids", "counts")
        summed = stored(summed.groupBy("bucket").applyInArrow(_summing(width, min_count), SUMMED), f"summed-{width}")
        counts.append(summed.where("kind = 'gram'").select("lang", "phrase", "f"))
        left = grown.where("kind = 'shard'").select("shard", "lang", "sign", "ids", "vocabulary")
        found = summed.where("kind = 'back'").select("shard", "grams")
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    return words, every, totals


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, top: int = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of 2 to ``MOST_WORDS`` words.

    Texts are lowered (A-Z) and cut into pieces at ``.,;:!?`` and line ends, pieces into
    words at spaces and tabs. A null language counts as ``und``, a null text as empty;
    texts without words, and empty tables, give no rows. Other columns are not read.
    ``a`` is the count of a phrase, at least ``min_count``. Of its cuts into two parts with
    counts ``l`` and ``r`` the one with the least floor(2000000 * a / (l + r)) counts,
    the first of equals. Phrases inside a longer one with at least 80 % of their count
    are dropped. ``n`` is the number of words of the language. The best ``top`` by score,
    then count, then bytes of the phrase are returned, ranked from 1.
    """
    words, counts, totals = phrase_counts(docs, lang, text, min_count)
    counts = stored(counts, "phrases")
    candidates = counts.where(F.size("phrase") > 1).withColumnRenamed("f", "a")
    size = F.size("phrase")
    split = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "k", F.slice("phrase", 1, F.col("k")).alias("first"), F.slice("phrase", F.col("k") + 1, size - F.col("k")).alias("rest")
    )

    def part(name: str, count: str) -> DataFrame:
        return counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))

    # whole numbers of 38 digits: products may pass 64 bits
    wide = "decimal(20,0)"
    score = F.call_function("div", F.col("a").cast(wide) * F.lit(2_000_000), F.col("l").cast(wide) + F.col("r").cast(wide))
    scored = split.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("best"))

    # a phrase two words longer has one a single word longer between, with no smaller count
    inner = F.array(F.slice("phrase", 1, size - 1), F.slice("phrase", 2, size - 1))
    around = candidates.where(size > 2).select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    swallowed = F.col("longer").cast(wide) * 100 >= F.col("a").cast(wide) * CONTAINED_PERCENT
    kept = best.join(around, ["lang", "phrase"], "left").where(~F.coalesce(swallowed, F.lit(False)))

    spelt = (
        kept.select("lang", "phrase", F.posexplode("phrase").alias("at", "id"))
        .join(words.select("lang", "id", "word"), ["lang", "id"])
        .groupBy("lang", "phrase")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("text"))
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    named = kept.join(spelt, ["lang", "phrase"]).select("lang", F.col("text").alias("phrase"), "a", "best.l", "best.r", "best.score")
    # the best of a language are among the best of each share of its phrases, so no task ranks them all
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    first = named.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    ranked = first.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
