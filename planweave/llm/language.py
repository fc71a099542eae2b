"""Language identification with a bidirectional gated recurrent network over bytes (operator 1).

The network reads windows of ``WINDOW`` bytes in both directions with ``HIDDEN`` units each, and gives every byte
position a distribution over the languages. A document's probabilities are the mean over all positions of all its
windows; nothing is cut off. Training is plain backpropagation through time in numpy, on the driver, with Adam, from a
bounded sample: of each language the same number of labelled documents, ``TRAIN_DOCS`` in all but one of each at least,
by a hash, and of each of these ``TRAIN_PARTS`` parts of ``TRAIN_CHARS`` characters, from hashed places all over the text.
Whether a document is held out, its language label, its source and its doc_id are never inputs.

Defined cases: a null text and a text without letters get ``und`` with score 0, as does every text if there are no
labelled rows to learn from; labels that are null are not learned; ties go to the first label in order; repeated rows
give repeated results; an empty table gives none; other columns are passed over or along unchanged, but for those that
have the names of results, which results replace. ``keep_languages``: see there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, ids_and_text, read, released
from .scan import Chunk, per_chunk

HIDDEN, WINDOW, BLOCK = 8, 128, 4096
#: Bounds of the sample that the network is fitted on.
TRAIN_DOCS, TRAIN_PARTS, TRAIN_CHARS = 4000, 4, 128
STEPS, BATCH, TRAIN_WINDOW, RATE = 350, 160, 64, 0.02
UNKNOWN = "und"
#: A document whose best language has a smaller pooled probability is in none of the languages learned.
LEAST_SCORE = 0.4


@dataclass
class Network:
    """``bytes_in[d]``: 3H x 256, ``states_in[d]``: 3H x H, gates in the order update, reset, candidate; ``out[d]``: L x H."""

    labels: list[str]
    bytes_in: list[np.ndarray]
    states_in: list[np.ndarray]
    out: list[np.ndarray]
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [*self.bytes_in, *self.states_in, *self.out, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def start(labels: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
    r = np.random.default_rng(seed)
    make = lambda *shape, scale: r.normal(0, scale, shape).astype(np.float32)
    return Network(
        labels, [make(3 * hidden, 256, scale=0.3) for _ in range(2)], [make(3 * hidden, hidden, scale=hidden**-0.5) for _ in range(2)],
        [make(len(labels), hidden, scale=hidden**-0.5) for _ in range(2)], np.zeros((len(labels), 1), np.float32),
    )


def loss_and_gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions of windows x (bytes, time by batch) with labels y, and its gradients."""
    steps, batch = x.shape
    hidden = net.states_in[0].shape[1]
    past, logits = [], np.zeros((steps, len(net.labels), batch), np.float32) + net.bias
    for d in range(2):
        h, kept = np.zeros((hidden, batch), np.float32), {}
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            a, g = net.bytes_in[d][:, x[t]], net.states_in[d] @ h
            zr = _sigmoid(a[: 2 * hidden] + g[: 2 * hidden])
            z, r = zr[:hidden], zr[hidden:]
            n = np.tanh(a[2 * hidden :] + r * g[2 * hidden :])
            new = n + z * (h - n)
            kept[t] = (h, z, r, n, g[2 * hidden :], new)
            logits[t] += net.out[d] @ new
            h = new
        past.append(kept)
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    at = (np.arange(steps)[:, None], y[None, :], np.arange(batch)[None, :])
    loss = float(-np.log(p[at] + 1e-9).mean())
    p[at] -= 1
    p /= steps * batch
    g_in, g_state, g_out = [], [], []
    for d in range(2):
        dh = np.zeros((hidden, batch), np.float32)
        d_state, d_out = np.zeros_like(net.states_in[d]), np.zeros_like(net.out[d])
        d_a = np.empty((steps, 3 * hidden, batch), np.float32)
        for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
            h, z, r, n, g, new = past[d][t]
            d_out += p[t] @ new.T
            dh = dh + net.out[d].T @ p[t]
            dn = dh * (1 - z) * (1 - n * n)
            d_a[t, :hidden] = dh * (h - n) * z * (1 - z)
            d_a[t, hidden : 2 * hidden] = dn * g * r * (1 - r)
            d_a[t, 2 * hidden :] = dn
            d_g = d_a[t].copy()
            d_g[2 * hidden :] *= r
            d_state += d_g @ h.T
            dh = dh * z + net.states_in[d].T @ d_g
        flat, seen = d_a.transpose(1, 0, 2).reshape(3 * hidden, -1), x.ravel()
        g_in.append(np.stack([np.bincount(seen, weights=row, minlength=256) for row in flat]).astype(np.float32))
        g_state.append(d_state)
        g_out.append(d_out)
    return loss, [*g_in, *g_state, *g_out, p.sum(axis=(0, 2))[:, None]]


def train(texts: list[bytes], labels: list[str], steps: int = STEPS, seed: int = 7) -> Network:
    """Fit a network to whole texts given as bytes, with their labels."""
    names = sorted(set(labels))
    net, r = start(names, seed=seed), np.random.default_rng(seed)
    y = np.array([names.index(x) for x in labels])
    by = [np.flatnonzero(y == k) for k in range(len(names))]
    data = [np.frombuffer(t, np.uint8) for t in texts]
    weights = net.arrays()
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        pick = np.array([by[k][r.integers(len(by[k]))] for k in r.integers(len(names), size=BATCH)])
        x = np.full((TRAIN_WINDOW, BATCH), 32, np.uint8)
        for j, i in enumerate(pick):
            t = data[i]
            at = r.integers(max(1, len(t) - TRAIN_WINDOW + 1))
            part = t[at : at + TRAIN_WINDOW]
            x[: len(part), j] = part
        _, grads = loss_and_gradients(net, x, y[pick])
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, s in zip(weights, grads, mean, square, strict=True):
            np.clip(g, -0.1, 0.1, out=g)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= (rate / (1 - 0.9**step)) * m / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


class Reader:
    """A network made ready to read many windows at once: sigmoids as tanh of halved inputs."""

    def __init__(self, net: Network):
        h = net.states_in[0].shape[1]
        half = np.ones((3 * h, 1), np.float32)
        half[: 2 * h] = 0.5
        self.hidden, self.out, self.bias = h, net.out, net.bias
        self.bytes_in = [np.ascontiguousarray(w * half) for w in net.bytes_in]
        self.states_in = [np.ascontiguousarray(w * half) for w in net.states_in]

    def _step(self, d: int, x: np.ndarray, h: np.ndarray) -> np.ndarray:
        n = self.hidden
        a, g = np.take(self.bytes_in[d], x, axis=1), self.states_in[d] @ h
        zr = a[: 2 * n]
        zr += g[: 2 * n]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        c = g[2 * n :]
        c *= zr[n:]
        c += a[2 * n :]
        np.tanh(c, out=c)
        h = h - c
        h *= zr[:n]
        h += c
        return h

    def windows(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums over positions of the probabilities, and counts of positions by their best label, for windows sorted by falling size.

        ``x``: time by windows."""
        steps, batch = x.shape
        active = np.searchsorted(-sizes, -np.arange(steps), "left")  # windows longer than t
        h, past = np.zeros((self.hidden, batch), np.float32), []
        for t in range(steps):
            h = self._step(0, x[t, : active[t]], h[:, : active[t]])
            past.append(h)
        total = np.zeros((len(self.bias), batch), np.float32)
        votes = np.zeros((len(self.bias), batch), np.float32)
        h = np.zeros((self.hidden, 0), np.float32)
        for t in range(steps - 1, -1, -1):
            k = active[t]
            if h.shape[1] < k:
                h = np.concatenate([h, np.zeros((self.hidden, k - h.shape[1]), np.float32)], axis=1)
            h = self._step(1, x[t, :k], h)
            p = self.out[0] @ past.pop()
            p += self.out[1] @ h
            p += self.bias
            top = p.max(axis=0)
            hit = p == top
            if np.count_nonzero(hit) > k:  # a tie
                hit &= np.cumsum(hit, axis=0) == 1
            votes[:, :k] += hit
            p -= top
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            total[:, :k] += p
        return total, votes

    def documents(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Sums of probabilities and of votes, documents by labels."""
        sizes = np.diff(chunk.offs)
        per = -(-sizes // WINDOW)
        doc = np.repeat(np.arange(chunk.n), per)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        begin = chunk.offs[doc] + number * WINDOW
        length = np.minimum(WINDOW, chunk.offs[doc + 1] - begin)
        order = np.argsort(-length, kind="stable")
        padded = np.concatenate([chunk.buf, np.zeros(WINDOW, np.uint8)])
        total, votes = np.zeros((chunk.n, len(self.bias))), np.zeros((chunk.n, len(self.bias)))
        for at in range(0, len(order), BLOCK):
            part = order[at : at + BLOCK]
            x = np.ascontiguousarray(padded[begin[part][:, None] + np.arange(length[part[0]])].T)
            for into, got in zip((total, votes), self.windows(x, length[part]), strict=True):
                np.add.at(into, doc[part], got.T)
        return total, votes


def training_rows(docs: DataFrame, most: int = TRAIN_DOCS) -> tuple[list[bytes], list[str]]:
    """Parts of labelled texts that aren't held out, and their labels: at most ``most`` documents, or one of each label, as evenly over the labels as there are rows."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not counts:
        return [], []
    quota = max(1, most // len(counts))
    # Few more than are needed are drawn before they are put in order.
    share = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, (2 * quota + 20) / n)))))
    name = F.xxhash64("doc_id", "text")
    drawn = known.withColumn("name", name).filter(F.pmod("name", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    size, span = F.length("text"), F.length("text") / TRAIN_PARTS
    place = lambda i: (F.floor(span * i) + F.pmod(F.xxhash64("name", F.lit(i)), F.greatest(F.lit(1), F.floor(span) - TRAIN_CHARS + 1))).cast("int")
    part = lambda i: F.substring("text", place(i) + 1, F.lit(TRAIN_CHARS))
    texts = F.when(size <= TRAIN_PARTS * TRAIN_CHARS, F.array("text")).otherwise(F.array(*map(part, range(TRAIN_PARTS))))
    order = Window.partitionBy("lang").orderBy("name")
    rows = drawn.select("lang", "name", texts.alias("parts")).withColumn("k", F.row_number().over(order)).filter(F.col("k") <= quota).orderBy("name").collect()
    pairs = [(t.encode(), r.lang) for r in rows for t in r.parts]
    return [t for t, _ in pairs], [lang for _, lang in pairs]


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame) -> Network | None:
    """A network for the languages of ``docs`` (doc_id, text, lang), or None without labelled rows."""
    texts, labels = training_rows(docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")))
    return train(texts, labels) if texts else None


def label(docs: DataFrame, net: Network | None, to: tuple[str, str, str] = ("lang_pred", "score", "agreement")) -> DataFrame:
    """``docs`` with the predicted language, its probability, and the part of positions that have this label; ``to`` names them, and replaces columns of these names."""
    kept = [f for f in docs.schema.fields if f.name not in to]
    docs = docs.select([f.name for f in kept])
    if net is None:
        return docs.withColumns({to[0]: F.lit(UNKNOWN), to[1]: F.lit(0.0), to[2]: F.lit(0.0)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, names = Reader(net), np.array([*net.labels, UNKNOWN], object)
        for rows, chunk in per_chunk(batches):
            total, votes = reader.documents(chunk)
            n = np.maximum(total.sum(axis=1), 1e-9)
            best = total.argmax(axis=1)
            at = np.arange(len(best))
            ok = np.asarray(rows.column(rows.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], pa.array(names[np.where(ok, best, -1)], pa.string()), pa.array(np.where(ok, np.clip(total[at, best] / n, 0, 1), 0.0)), pa.array(np.where(ok, np.minimum(votes[at, best] / n, 1), 0.0))],
                [*rows.schema.names[:-1], *to],
            )

    flag = free_name("has_letter", docs.columns, list(to))
    schema = T.StructType([*kept, T.StructField(to[0], T.StringType()), T.StructField(to[1], T.DoubleType()), T.StructField(to[2], T.DoubleType())])
    marked = docs.withColumn(flag, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return marked.mapInArrow(released(run), schema)


def keep_languages(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang) in a language that the network knows, with all their columns; a null ``lang`` becomes the predicted one.

    Rows go if their text is null or has no letter, or if no language has a probability of ``least``. Where no row has a
    label there is no network, and all rows stay as they are."""
    net = fit(docs)
    if net is None:
        return docs
    names = []
    for x in ("predicted", "probability", "agreement"):
        names.append(free_name(x, docs.columns, names))
    found = label(docs, net, tuple(names)).filter((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least))
    return found.withColumn("lang", F.coalesce(F.col("lang"), F.col(names[0]).cast(docs.schema["lang"].dataType))).select(docs.columns)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return label(ids_and_text(docs), fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "agreement")
