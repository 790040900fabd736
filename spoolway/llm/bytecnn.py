"""Language identification by a convolutional network over bytes."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.llm.common import hashable

#: Bytes of a window. Texts are cut into such windows, the last one padded with zeros.
WINDOW = 256
WIDTHS, FILTERS = (2, 3, 4), 8
#: Training windows, one of a text, at most. The bound is on the fit alone.
FIT_ROWS = 6_000
EPOCHS, BATCH, RATE = 12, 64, 0.01
CHUNK = 512


@dataclass
class Network:
    """Filter weights by width (width x 256 x filters), their bias, and the softmax layer."""

    langs: list[str]
    filters: dict
    bias: object
    weights: object
    offset: object

    def tables(self):
        """The filters as sums over byte pairs, which halves the look-ups."""
        import numpy as np

        two, three, four = (self.filters[w] for w in WIDTHS)

        def pair(a, b):
            return (a[:, None, :] + b[None, :, :]).reshape(65_536, -1)

        first = np.concatenate([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])], axis=1)
        return first.astype(np.float32), three[2].astype(np.float32), pair(four[2], four[3]).astype(np.float32)


def _softmax(x):
    import numpy as np

    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _pooled(windows, tables, bias):
    """Greatest response of each filter in each window, after the rectifier."""
    import numpy as np

    first, third, last = tables
    pairs = windows[:, :-1].astype(np.int32) << 8 | windows[:, 1:]
    x, f = first[pairs], FILTERS
    two = x[:, :, :f].max(axis=1)
    three = (x[:, :-1, f : 2 * f] + third[windows[:, 2:]]).max(axis=1)
    four = (x[:, :-2, 2 * f :] + last[pairs[:, 2:]]).max(axis=1)
    return np.maximum(np.concatenate([two, three, four], axis=1) + bias, 0)


def train(windows, labels, langs: list[str], seed: int = 7) -> Network:
    """Fit the network by Adam on one-hot bytes. Only a filter's best place gets its gradient."""
    import numpy as np

    rng = np.random.default_rng(seed)
    size = FILTERS * len(WIDTHS)
    p = {w: rng.normal(0, 0.1, (w, 256, FILTERS)) for w in WIDTHS}
    p["bias"], p["weights"], p["offset"] = np.zeros(size), rng.normal(0, 0.3, (size, len(langs))), np.zeros(len(langs))
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    # languages count alike, whatever their share of the sample
    share = np.bincount(labels, minlength=len(langs)) / len(labels)
    cost = 1 / np.maximum(share, 1e-9) / len(langs)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            x, y = windows[order[at : at + BATCH]], labels[order[at : at + BATCH]]
            n, rows = len(x), np.arange(len(x))[:, None]
            best, peak = [], []
            for w in WIDTHS:
                span = WINDOW - w + 1
                r = sum(p[w][k][x[:, k : k + span]] for k in range(w))
                best.append(r.argmax(axis=1))
                peak.append(r.max(axis=1))
            raw = np.concatenate(peak, axis=1) + p["bias"]
            hidden = np.maximum(raw, 0)
            error = _softmax(hidden @ p["weights"] + p["offset"])
            error[np.arange(n), y] -= 1
            error *= cost[y][:, None] / n
            back = (error @ p["weights"].T) * (raw > 0)
            g = {"weights": hidden.T @ error, "offset": error.sum(axis=0), "bias": back.sum(axis=0)}
            for i, w in enumerate(WIDTHS):
                g[w] = np.zeros_like(p[w])
                own = back[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(w):
                    np.add.at(g[w][k], (x[rows, best[i] + k], np.arange(FILTERS)[None, :]), own)
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Network(langs, {w: p[w] for w in WIDTHS}, p["bias"].astype(np.float32), p["weights"].astype(np.float32), p["offset"].astype(np.float32))


def _windows(text: bytes):
    import numpy as np

    raw = np.frombuffer(text + b"\0" * (-len(text) % WINDOW), np.uint8)
    return raw.reshape(-1, WINDOW)


def fit(docs: DataFrame, train_rows: Column, text: str = "text", lang: str = "lang", rows: int = FIT_ROWS) -> Network | None:
    """Train on one window each of some ``rows`` labelled texts, chosen by a hash of the row; none without any.

    Labelled rows are counted by language first. Each language has its share of the sample, but
    not fewer than half an even share if it has so many rows, so no language is
    missed for being rare; the sample is at most half as large again as ``rows``.
    Every other window is cut shorter, so that short texts are no surprise.
    """
    import numpy as np

    key = F.xxhash64(text).bitwiseAND(2**62 - 1)
    length = F.char_length(text)
    at = (F.lit(1) + key % F.greatest(F.lit(1), length - WINDOW + 1)).cast("int")
    usable = docs.where(F.coalesce(train_rows, F.lit(False)) & F.col(lang).isNotNull() & (length > 0)).select(
        F.substring(F.col(text), at, F.lit(WINDOW)).alias("part"),
        F.col(lang).alias("lang"),
        key.alias("key"),
        F.xxhash64(*hashable(docs)).alias("row"),
    )
    # a language has its share of the sample, and a rare one half an even share at least
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, some = sum(sizes.values()), []
    if total <= rows:
        some = usable.collect()
    else:
        wanted = {x: max(rows * n // total, min(n, rows // (2 * len(sizes)))) for x, n in sizes.items()}
        table = docs.sparkSession.createDataFrame([(x, wanted[x], min(1.0, 1.5 * wanted[x] / n)) for x, n in sizes.items()], "lang string, wanted long, rate double")
        spread = F.xxhash64("row", "part")
        near = usable.join(F.broadcast(table), "lang").where(spread <= (F.col("rate") * 2.0**64 - 2.0**63))
        place = F.row_number().over(Window.partitionBy("lang").orderBy(spread, "row", "part"))
        some = near.withColumn("place", place).where("place <= wanted").collect()
    if not some:
        return None
    some.sort(key=lambda r: (r["row"], r["part"]))
    langs = sorted({r["lang"] for r in some})
    cut = [8 + (r["key"] >> 8) % (WINDOW - 8) if r["key"] % 2 else WINDOW for r in some]
    windows = np.concatenate([_windows(r["part"].encode()[:n] or b" ")[:1] for r, n in zip(some, cut)])
    return train(windows, np.array([langs.index(r["lang"]) for r in some]), langs)


def predict(network: Network, tables, texts: list[bytes]):
    """Mean probabilities (texts x languages) over the windows of each text, by their length."""
    import numpy as np

    cut = [_windows(t) for t in texts]
    count = np.array([len(c) for c in cut])
    stack = np.concatenate(cut)
    parts = [
        _softmax(_pooled(stack[i : i + CHUNK], tables, network.bias) @ network.weights + network.offset)
        for i in range(0, len(stack), CHUNK)
    ]
    found = np.concatenate(parts)
    weight = np.full(len(stack), float(WINDOW))
    ends = np.cumsum(count) - 1
    weight[ends] = [len(t) - WINDOW * (n - 1) for t, n in zip(texts, count.tolist())]
    sums = np.add.reduceat(found * weight[:, None], ends - count + 1, axis=0)
    return sums / sums.sum(axis=1, keepdims=True)


def with_language(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """(row, lang_pred, score) for each row; ``row`` has all columns of ``docs``.

    All windows of a whole text count. A null text, one without a letter, and any text
    without a trained network are ``und`` with score 0. Equal texts get equal results.
    """
    row = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([row.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        tables = network.tables() if network else None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                values = part.column("row").field(text).to_pylist()
                lettered = [i for i, x in enumerate(values) if x and any(c.isalpha() for c in x)]
                lang, score = ["und"] * len(values), [0.0] * len(values)
                if network and lettered:
                    found = predict(network, tables, [values[i].encode() for i in lettered])
                    for i, p in zip(lettered, found):
                        k = int(p.argmax())
                        lang[i], score[i] = network.langs[k], float(p[k])
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(lang), pa.array(score)], names=["row", "lang_pred", "score"])

    return row.mapInArrow(run, schema)
