"""Token counts by rank-synchronous merging of ragged arrays."""

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The piece that stands for a space.
MARK = "▁"
#: A worker remembers the counts of so many pre-tokens of up to so many characters.
CACHE_ENTRIES, CACHE_LENGTH = 400_000, 64
#: Symbols that are merged at once.
BATCH_SYMBOLS = 1_000_000


@dataclass(frozen=True)
class Merges:
    """A piece vocabulary: each character's symbol, and the pairs that merge, sorted by key."""

    symbol: dict
    keys: object
    ranks: object
    merged: object
    width: int
    #: Ranks that several pieces share, and the pairs that make those: {(left, right): (rank, piece)}.
    shared: dict


@lru_cache(2)
def load_merges(path: str) -> Merges:
    """Read a byte-fallback BPE model.

    Two symbols merge if their strings joined are an ordinary piece; the better score
    goes first. Pieces of equal score share a rank. Reads only the vocabulary: the
    library that the model is for does no counting here.
    """
    import numpy as np
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    ordinary = {model.id_to_piece(i): i for i in range(size) if not any(f(i) for f in special)}
    scores = np.array([model.get_score(i) for i in range(size)])
    rank = np.unique(-scores, return_inverse=True)[1]
    rows = [
        (ordinary[p[:k]] * size + ordinary[p[k:]], rank[i], i)
        for p, i in ordinary.items()
        for k in range(1, len(p))
        if p[:k] in ordinary and p[k:] in ordinary
    ]
    keys, ranks, merged = (np.array(x, np.int64) for x in zip(*sorted(rows)))
    often = np.flatnonzero(np.bincount(rank[list(ordinary.values())]) > 1)
    tied = np.isin(ranks, often)
    shared = {divmod(k, size): (r, i) for k, r, i in zip(keys[tied].tolist(), ranks[tied].tolist(), merged[tied].tolist())}
    return Merges({p: i for p, i in ordinary.items() if len(p) == 1}, keys, ranks, merged, size, shared)


NONE = 1 << 40


def _pair_ranks(m: Merges, left, right):
    """Rank and result of each pair; ``NONE`` if it does not merge or has a foreign symbol (-1)."""
    import numpy as np

    key = left * m.width + right
    at = np.minimum(np.searchsorted(m.keys, key), len(m.keys) - 1)
    hit = (m.keys[at] == key) & (left >= 0) & (right >= 0)
    return np.where(hit, m.ranks[at], NONE), m.merged[at]


def _leftmost(m: Merges, symbols: list[int], rank: int) -> int:
    """Finish one sequence whose best rank is shared by several pieces, always at the leftmost pair.

    Only runs of spaces end this way: all other merges are done by then, so the pointer
    steps back one place after a merge and forward otherwise.
    """
    done, rest = [], symbols[::-1]
    while rest:
        done.append(rest.pop())
        while len(done) > 1:
            found = m.shared.get((done[-2], done[-1]))
            if found is None or found[0] != rank:
                break
            done[-2:] = [found[1]]
    return len(done)


def surviving(m: Merges, sequences: list[list[int]]):
    """How many symbols each sequence has left when no pair merges any more.

    All sequences are one ragged array. In each round every sequence merges its pair of
    the lowest rank: all its places at once, from the left, that do not touch. Where a
    new pair would have come before the next of those places, only the first one is
    merged, so the result is that of merging one pair at a time, leftmost first.
    Sequences without a pair leave the array, so a round costs what is still active.
    """
    import numpy as np

    out = np.array([len(s) for s in sequences], np.int64)
    shared = sorted({rank for rank, _ in m.shared.values()})
    keep = np.flatnonzero(out > 1)
    symbols = np.array([x for i in keep for x in sequences[i]], np.int64)
    owner = np.repeat(keep, out[keep])
    while len(symbols):
        rank, merged = _pair_ranks(m, symbols[:-1], symbols[1:])
        rank = np.append(np.where(owner[:-1] == owner[1:], rank, NONE), NONE)
        merged = np.append(merged, -1)
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        lengths = np.diff(np.append(first, len(owner)))
        best = np.minimum.reduceat(rank, first)
        # sequences that are done leave
        alive = best < NONE
        tied = alive & np.isin(best, shared)
        for k in np.flatnonzero(tied).tolist():
            a = first[k]
            out[owner[a]] = _leftmost(m, symbols[a : a + lengths[k]].tolist(), int(best[k]))
        over = ~alive
        out[owner[first[over]]] = lengths[over]
        stay = alive & ~tied
        if not stay.all():
            mask = np.repeat(stay, lengths)
            symbols, owner, rank, merged = symbols[mask], owner[mask], rank[mask], merged[mask]
            if not len(symbols):
                break
            best, lengths = best[stay], lengths[stay]
            first = np.append(0, np.cumsum(lengths)[:-1])
        lowest = np.repeat(best, lengths)
        place = np.flatnonzero(rank == lowest)
        group = np.repeat(np.arange(len(first)), lengths)
        chosen = _apart(place, group[place])
        leading = np.append(True, group[chosen][1:] != group[chosen][:-1])
        if not leading.all():
            chosen = _safe(m, symbols, group, lowest, merged, chosen, leading)
        symbols = symbols.copy()
        symbols[chosen] = merged[chosen]
        mask = np.ones(len(symbols), bool)
        mask[chosen + 1] = False
        symbols, owner = symbols[mask], owner[mask]
    return out


def _apart(place, group):
    """The places, from the left, that do not overlap the one before, less those that touch it.

    Merging one pair at a time, leftmost first, takes just the places that do not
    overlap. Of these, one that touches the last one chosen waits for the next round.
    Close places form short chains, which are walked.
    """
    import numpy as np

    close = np.append(False, (np.diff(place) < 3) & (group[1:] == group[:-1]))
    if not close.any():
        return place
    chosen, free, last = [], 0, -3
    for p, c in zip(place.tolist(), close.tolist()):
        if not c:
            free, last = p, -3
        if p < free:
            continue
        free = p + 2
        if p - last >= 3:
            chosen.append(p)
            last = p
    return np.array(chosen, np.int64)


def _safe(m: Merges, symbols, group, lowest, merged, chosen, leading):
    """Keep only the first place in groups where a merge makes a pair of the same rank or a better one."""
    import numpy as np

    new = merged[chosen]
    left, right = chosen - 1, chosen + 2
    has_left = (left >= 0) & (group[np.maximum(left, 0)] == group[chosen])
    end = len(symbols) - 1
    has_right = (right <= end) & (group[np.minimum(right, end)] == group[chosen])
    a = np.where(has_left, _pair_ranks(m, symbols[np.maximum(left, 0)], new)[0], NONE)
    b = np.where(has_right, _pair_ranks(m, new, symbols[np.minimum(right, end)])[0], NONE)
    worse = np.minimum(a, b) <= lowest[chosen]
    if not worse.any():
        return chosen
    risky = np.zeros(group[-1] + 1, bool)
    risky[group[chosen[worse]]] = True
    return chosen[leading | ~risky[group[chosen]]]


def pre_tokens(text: str) -> list[str]:
    """A text as runs of space marks, each with what follows it; no piece reaches across."""
    import re

    if not text:
        return []
    return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", MARK + text.replace(" ", MARK))


def count_batch(m: Merges, texts: list[str], cache: dict[str, int]) -> list[int]:
    """Tokens of each text. Each distinct pre-token of the batch is merged once."""
    split = [pre_tokens(t) for t in texts]
    new = set()
    for parts in split:
        new.update(parts)
    fresh = {}
    pending, symbols = [], 0

    def flush():
        nonlocal pending, symbols
        if not pending:
            return
        counts = surviving(m, [s for _, s, _ in pending])
        fresh.update((p, int(n) + extra) for (p, _, extra), n in zip(pending, counts))
        pending, symbols = [], 0

    for p in new:
        if p in cache:
            continue
        ids = [m.symbol.get(c, -1) for c in p]
        # a character without a symbol falls back to its bytes
        extra = sum(len(c.encode("utf-8", "replace")) - 1 for c, i in zip(p, ids) if i < 0) if -1 in ids else 0
        pending.append((p, ids, extra))
        symbols += len(ids)
        if symbols >= BATCH_SYMBOLS:
            flush()
    flush()
    out = [sum(fresh[p] if p in fresh else cache[p] for p in parts) for parts in split]
    if len(cache) + len(fresh) > CACHE_ENTRIES:
        cache.clear()
    room = CACHE_ENTRIES - len(cache)
    for p, n in fresh.items():
        if len(p) <= CACHE_LENGTH and room > 0:
            cache[p] = n
            room -= 1
    return out


def with_token_counts(docs: DataFrame, path: str, text: str = "text", rows: int = 256) -> DataFrame:
    """(row, n_bytes, n_tokens) for each row; ``row`` has all columns of ``docs``.

    ``path`` names a byte-fallback BPE model, readable on every executor. Special strings
    inside texts are ordinary text; nothing is added or cut off. Null counts as empty;
    an empty text has no tokens. Texts go through in batches of ``rows``.
    """
    row = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([row.schema[0], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches):
        import pyarrow as pa

        merges, cache = load_merges(path), {}
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                texts = [x or "" for x in part.column("row").field(text).to_pylist()]
                sizes = pa.array([len(x.encode()) for x in texts], pa.int64())
                counts = pa.array(count_batch(merges, texts, cache), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("row"), sizes, counts], names=["row", "n_bytes", "n_tokens"])

    return row.mapInArrow(run, schema)
