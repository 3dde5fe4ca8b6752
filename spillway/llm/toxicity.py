"""Toxicity: a convolutional text classifier over hashed word embeddings.

Words are hashed into a fixed number of embeddings, each the sum of vectors of
the word and of its first letters, so inflected forms share a part; filters
of widths 1 to 3 slide over a whole text; each filter's largest response feeds a logistic
output.  Embeddings and filters are trained in numpy on a bounded sample of
labelled rows.  The output is calibrated on rows the fit did not see, and a
decision threshold is chosen for each language.  Scoring is one Arrow map over
all texts: no shuffle, whole texts, fixed-size weights.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.llm import tokens
from spillway.llm.common import ship, whole_row

BITS = 18                  # 2**18 embeddings
DIM = 16
PREFIXES = (4, 6)          # first letters that stand for a word's stem
PARTS = 1 + len(PREFIXES)  # embeddings summed for a word
WIDTHS = (1, 2, 3)
FILTERS = 16               # of each width
SAMPLE_ROWS = 12_000       # bound of the labelled rows that are learned from
SAMPLE_WORDS = 4_096       # labelled rows with more words are not learned from (all rows are scored whole)
LEAST_ROWS = 3             # a word in fewer sample rows has the zero embedding
STEPS, BATCH, RATE = 900, 64, 0.004   # a smaller sample is gone through more often
FOLDS = 5                  # crc32(doc_id) mod 5: 0 is held out, 4 calibrates, the rest fits
LEAST_POSITIVE = 12        # toxic rows a language needs for a threshold of its own
MARGIN = max(WIDTHS) - 1
SEED = 11


@dataclass
class Network:
    """Weights, calibration and thresholds; at most 17 MB whatever the corpus."""

    embedding: np.ndarray           # (2**BITS, DIM); row 0 is padding and zero
    filters: list[np.ndarray]       # per width: (width * DIM, FILTERS)
    bias: np.ndarray
    output: np.ndarray
    offset: float
    scale: float = 1.0              # score = sigmoid(scale * logit + shift)
    shift: float = 0.0
    thresholds: dict[str, float] | None = None
    constant: float | None = None   # the score where there was nothing to learn from

    def __getstate__(self) -> dict:
        """Only the embeddings that are not zero travel."""
        used = np.flatnonzero(self.embedding.any(axis=1))
        return self.__dict__ | {"embedding": (len(self.embedding), used.astype(np.int32), self.embedding[used])}

    def __setstate__(self, state: dict) -> None:
        rows, used, values = state["embedding"]
        self.__dict__.update(state, embedding=np.zeros((rows, values.shape[1]), np.float32))
        self.embedding[used] = values


def word_ids(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, PARTS) embedding numbers of each word and its stems, and the texts' offsets."""
    h, at, _, stems = tokens.words(data, offs, prefixes=PREFIXES)
    return (np.stack([h, *stems], axis=1) >> np.uint64(64 - BITS)).astype(np.int32), at


def padded(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One stream of ids with padding behind every text, and where each text's windows start and end."""
    n = np.diff(at)
    size = np.maximum(n, 1)  # a text without words is one padding position
    begin = np.concatenate([[0], np.cumsum(size + MARGIN)])[:-1]
    stream = np.zeros((int((size + MARGIN).sum()), ids.shape[1]), np.int32)
    stream[np.arange(len(ids)) - np.repeat(at[:-1], n) + np.repeat(begin, n)] = ids
    return stream, begin, begin + size


def responses(net: Network, stream: np.ndarray) -> np.ndarray:
    """(positions, filters) responses of windows that start at each position."""
    x = net.embedding[stream[:, 0]]
    for part in range(1, PARTS):
        x += net.embedding[stream[:, part]]
    x = np.concatenate([x, np.zeros((MARGIN, DIM), np.float32)])
    n = len(stream)
    out = np.empty((n, FILTERS * len(WIDTHS)), np.float32)
    for k, (width, f) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        part = x[:n] @ f[:DIM]
        for j in range(1, width):
            part += x[j:j + n] @ f[j * DIM:(j + 1) * DIM]
        out[:, k * FILTERS:(k + 1) * FILTERS] = part
    return out


def logits(net: Network, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    stream, begin, end = padded(ids, at)
    z = responses(net, stream)
    top = np.maximum.reduceat(z, np.stack([begin, end], axis=1).ravel(), axis=0)[::2] if len(begin) else z
    return np.maximum(top + net.bias, 0) @ net.output + net.offset


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class _Adam:
    def __init__(self, shape) -> None:
        self.m, self.v, self.t = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0

    def step(self, weights: np.ndarray, gradient: np.ndarray, rows=slice(None)) -> None:
        self.t += 1
        self.m[rows] = 0.9 * self.m[rows] + 0.1 * gradient
        self.v[rows] = 0.999 * self.v[rows] + 0.001 * gradient ** 2
        weights[rows] -= RATE * (self.m[rows] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[rows] / (1 - 0.999 ** self.t)) + 1e-8)


def fit(texts: list[np.ndarray], labels: np.ndarray) -> Network:
    """Train on lists of word ids and 0/1 labels."""
    rng = np.random.default_rng(SEED)
    total = FILTERS * len(WIDTHS)
    net = Network(rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32),
                  [rng.normal(0, 0.3, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(total, np.float32), rng.normal(0, 0.1, total).astype(np.float32), 0.0)
    seen = np.zeros(1 << BITS, np.int32)
    for t in texts:
        seen[np.unique(t)] += 1
    net.embedding[seen < LEAST_ROWS] = 0
    net.embedding[0] = 0
    trained = seen >= LEAST_ROWS
    trained[0] = False
    share = float(labels.mean())
    net.offset = float(np.log(share / (1 - share)))
    adam = {"e": _Adam(net.embedding.shape), "b": _Adam(total), "o": _Adam(total), "c": _Adam(1),
            **{k: _Adam(f.shape) for k, f in enumerate(net.filters)}}
    offset = np.array([net.offset], np.float32)
    for _ in range(-(-STEPS * BATCH // len(texts))):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            some = order[a:a + BATCH]
            at = np.concatenate([[0], np.cumsum([len(texts[i]) for i in some])])
            stream, begin, end = padded(np.concatenate([texts[i] for i in some]), at)
            z = responses(net, stream)
            where = np.stack([z[s:e].argmax(axis=0) + s for s, e in zip(begin, end, strict=True)])
            top = np.take_along_axis(z, where, axis=0) + net.bias
            active = np.maximum(top, 0)
            y = labels[some]
            slope = (_sigmoid(active @ net.output + offset[0]) - y).astype(np.float32) / len(some)
            back = slope[:, None] * net.output * (top > 0)
            adam["o"].step(net.output, active.T @ slope)
            adam["c"].step(offset, np.array([slope.sum()]))
            adam["b"].step(net.bias, back.sum(axis=0))
            touched, grads = [], []
            for k, width in enumerate(WIDTHS):
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                g, place = back[:, cols], where[:, cols]
                f = net.filters[k]
                change = np.zeros_like(f)
                for j in range(width):
                    i = np.minimum(place + j, len(stream) - 1)
                    ids = np.where((place + j < len(stream))[..., None], stream[i], 0)
                    change[j * DIM:(j + 1) * DIM] = np.einsum("nfhd,nf->df", net.embedding[ids], g)
                    part = (g[:, :, None] * f[j * DIM:(j + 1) * DIM].T[None]).reshape(-1, DIM)
                    touched += [ids[..., c].ravel() for c in range(PARTS)]
                    grads += [part] * PARTS
                adam[k].step(f, change)
            rows, back_to = np.unique(np.concatenate(touched), return_inverse=True)
            gradient = np.zeros((len(rows), DIM), np.float32)
            np.add.at(gradient, back_to, np.concatenate(grads))
            keep = trained[rows]
            adam["e"].step(net.embedding, gradient[keep], rows[keep])
    net.offset = float(offset[0])
    return net


def calibrate(net: Network, z: np.ndarray, labels: np.ndarray, langs: list[str | None]) -> None:
    """Fit score = sigmoid(scale * logit + shift), then the threshold of each language, on rows the fit didn't see."""
    if len(set(labels)) == 2:
        # Two pseudo rows keep the fit finite where the rows separate.
        x, y = np.concatenate([z, [z.mean(), z.mean()]]), np.concatenate([labels, [0, 1]]).astype(float)
        w = np.array([1.0, 0.0])
        for _ in range(50):
            p = _sigmoid(w[0] * x + w[1])
            g = np.array([((p - y) * x).sum() + 0.01 * w[0], (p - y).sum()])
            r = p * (1 - p)
            h = np.array([[(r * x * x).sum() + 0.01, (r * x).sum()], [(r * x).sum(), r.sum() + 1e-6]])
            w -= np.clip(np.linalg.solve(h, g), -1, 1)
        if w[0] > 0:
            net.scale, net.shift = float(w[0]), float(w[1])
    s = _sigmoid(net.scale * z + net.shift)
    net.thresholds = {}
    for lang in sorted({x for x in langs if x is not None}):
        here = np.array([x == lang for x in langs])
        if labels[here].sum() >= LEAST_POSITIVE and (labels[here] == 0).sum() >= LEAST_POSITIVE:
            net.thresholds[lang] = best_threshold(s[here], labels[here])


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut with fewest errors; of several the one nearest to 0.5, in the middle of its gap."""
    order = np.argsort(scores)
    s, y = scores[order], labels[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum(1 - y[::-1])[::-1], [0]])
    cuts = np.concatenate([[0.0], (s[1:] + s[:-1]) / 2, [1.0]])
    best = np.flatnonzero(errors == errors.min())
    low, high = np.concatenate([[0.0], s])[best], np.concatenate([s, [1.0]])[best]
    holds = (low < 0.5) & (high >= 0.5)
    if holds.any():
        return 0.5
    return float(cuts[best][np.argmin(np.abs(cuts[best] - 0.5))])


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = tokens.buffers(batch.column(batch.num_columns - 1))
        for a, b in tokens.chunks(offs):
            ids, at = word_ids(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(a, b - a) for c in batch.columns[:-1]),
                 pa.ListArray.from_arrays(pa.array((PARTS * at).astype(np.int32)), pa.array(ids.ravel()))],
                names=[*batch.schema.names[:-1], "ids"])


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """Fit and calibrate on at most SAMPLE_ROWS labelled rows outside fold 0, chosen by a hash of their id.

    A document with several labels counts as toxic if one says so; labels
    without a document, with a null id or a null label are not used.
    """
    ship(docs.sparkSession)
    known = (labels.where("doc_id is not null and toxic is not null").where(fold(F.col("doc_id")) != 0)
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    known = known.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(SAMPLE_ROWS)
    rows = (docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(known), "doc_id")  # at most SAMPLE_ROWS rows of two numbers
            .groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("d"))  # one text for each id
            .select("toxic", fold(F.col("doc_id")).cast("int").alias("fold"), "d.lang", F.coalesce("d.text", F.lit("")).alias("text")))
    sample = (rows.mapInArrow(_to_ids, "toxic int, fold int, lang string, ids array<int>")
              .where(F.size("ids") <= PARTS * SAMPLE_WORDS).repartition(1))  # the sample is bounded: one task fits it
    made = sample.mapInArrow(_fit_sample, "network binary").collect()
    return pickle.loads(made[0]["network"]) if made else _constant(0.0)


def _constant(score: float) -> Network:
    return Network(np.zeros((1, DIM), np.float32), [], np.zeros(0), np.zeros(0), 0.0, constant=score)


def _fit_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """toxic, fold, lang, ids of the whole sample -> one pickled network."""
    rows = [(x, y, lang, np.asarray(ids.values.to_numpy(), np.int32).reshape(-1, PARTS))
            for batch in batches for y, x, lang, ids in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3), strict=True)]
    # Rows arrive in any order; the fit depends on it, so it is fixed by content.
    rows.sort(key=lambda r: (len(r[3]), r[3].tobytes(), r[1]))
    learn, check = ([r for r in rows if (r[0] == FOLDS - 1) == last] for last in (False, True))
    y = np.array([r[1] > 0 for r in learn], np.float32)
    if len(set(y)) < 2:
        net = _constant(float(np.mean([r[1] > 0 for r in rows])) if rows else 0.0)
    else:
        net = fit([r[3] for r in learn], y)
        at = np.concatenate([[0], np.cumsum([len(r[3]) for r in check])]).astype(np.int64)
        z = logits(net, np.concatenate([r[3] for r in check]), at) if check else np.zeros(0)
        calibrate(net, z, np.array([r[1] > 0 for r in check], np.float32), [r[2] for r in check])
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], names=["network"])


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Network = shared.value
        for batch in batches:
            data, offs = tokens.buffers(batch.column(batch.num_columns - 1))
            for a, b in tokens.chunks(offs):
                if net.constant is not None:
                    s = np.full(b - a, net.constant)
                else:
                    ids, at = word_ids(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                    s = _sigmoid(net.scale * logits(net, ids, at).astype(np.float64) + net.shift)
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:-1]), pa.array(s, pa.float64())],
                                                 names=[*batch.schema.names[:-1], "score"])
    return run


def scored(rows: DataFrame, net: Network) -> DataFrame:
    """All columns of `rows` but its last, the text, and the score."""
    shared = rows.sparkSession.sparkContext.broadcast(net)  # fixed size
    return rows.mapInArrow(_score(shared), T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())]))


def threshold(net: Network, lang: Column) -> Column:
    """The language's threshold; 0.5 for languages without one and for null."""
    out = F.lit(0.5)
    for name, value in sorted((net.thresholds or {}).items()):
        out = F.when(lang == name, F.lit(value)).otherwise(out)
    return out


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, threshold, rejected: one row per document.

    score: calibrated probability of label 1 from the text alone; predicted:
    score >= 0.5; rejected: score >= the threshold of the document's language.
    Null and empty texts get the score of a text without words.  Without
    labels of both kinds every score is their mean (0 without any).  Rows with
    a null id are scored and not held out; repeated rows stay rows; an empty
    table gives no rows.  Columns other than doc_id, lang and text are not read.
    """
    net = train(docs, labels)
    rows = docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                       F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    cut = threshold(net, F.col("lang"))
    return scored(rows, net).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                                    cut.alias("threshold"), (F.col("score") >= cut).cast("int").alias("rejected"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not rejected, all columns as they are."""
    net = train(docs, labels)
    packed = docs.select(whole_row(docs).alias("row"), F.col("text").cast("string").alias("text"))
    return scored(packed, net).where(F.col("score") < threshold(net, F.col("row.lang"))).select("row.*")
