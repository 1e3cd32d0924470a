"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of ``WINDOW`` bytes in both directions, labels every
position, and pools the positions' log probabilities into a document's
probabilities.  Weights are trained in numpy by backpropagation through time
on the driver, on at most ``SAMPLE_DOCS`` documents (the ones with the smallest
hash of their id and text; a documented bound, the only part that does not see
all data), and go to the tasks as a few kilobytes.  Every byte of every text is
labelled: long texts are cut into windows, windows of many texts run side by side.

A text that is null or has no letter is ``und`` with score 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

UNDECIDED = "und"
WINDOW = 64           # bytes that the network sees at once
HIDDEN = 8            # units in each direction
SAMPLE_DOCS = 3000    # bound on the training sample
SAMPLE_BYTES = 640    # characters taken from each sampled document, spread over it
PIECES = 3            # places they are taken from
STEPS = 220
BATCH = 192
RATE = 0.02
SEED = 7
TEMPERATURE = 0.1     # neighbouring positions are not independent
MIN_SCORE = 0.5       # of a document that the pipeline keeps
LANES = 2048          # windows that run side by side


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Direction:
    """A gated recurrent unit; the bytes' input weights are a table."""

    table: np.ndarray   # 256 x 3H: update, reset, candidate
    u: np.ndarray       # H x 2H: update, reset
    v: np.ndarray       # H x H: candidate

    @classmethod
    def new(cls, hidden: int, rng: np.random.Generator) -> Direction:
        scale = 1 / np.sqrt(hidden)
        t = rng.normal(0, 0.5, (256, 3 * hidden))
        t[:, :hidden] -= 1     # remember at first
        return cls(*(x.astype(np.float32) for x in (t, rng.normal(0, scale, (hidden, 2 * hidden)), rng.normal(0, scale, (hidden, hidden)))))

    def run(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (T, N, H) for bytes ``x`` (T, N)."""
        n = self.v.shape[0]
        h = np.zeros((x.shape[1], n), np.float32)
        out = np.empty((*x.shape, n), np.float32)
        for t in range(len(x)):
            a = self.table[x[t]]
            g = _sigmoid(a[:, :2 * n] + h @ self.u)
            z, r = g[:, :n], g[:, n:]
            rh = r * h
            c = np.tanh(a[:, 2 * n:] + rh @ self.v)
            if keep is not None:
                keep.append((h, z, r, rh, c))
            h = h + z * (c - h)
            out[t] = h
        return out

    def back(self, x: np.ndarray, keep: list, dout: np.ndarray) -> list[np.ndarray]:
        """Gradients of (table, u, v) by backpropagation through time."""
        n = self.v.shape[0]
        dt, du, dv = np.zeros_like(self.table), np.zeros_like(self.u), np.zeros_like(self.v)
        dh = np.zeros_like(dout[0])
        for t in range(len(x) - 1, -1, -1):
            h, z, r, rh, c = keep[t]
            dh = dh + dout[t]
            dc = dh * z * (1 - c * c)
            drh = dc @ self.v.T
            dg = np.concatenate([dh * (c - h) * z * (1 - z), drh * h * r * (1 - r)], 1)
            dv += rh.T @ dc
            du += h.T @ dg
            np.add.at(dt, x[t], np.concatenate([dg, dc], 1))
            dh = dh * (1 - z) + drh * r + dg @ self.u.T
        return [dt, du, dv]


@dataclass
class Network:
    langs: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray     # 2H x langs
    bias: np.ndarray

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Log probabilities (T, N, langs) of each position of bytes (T, N)."""
        f, b = self.forward.run(x), self.backward.run(x[::-1])[::-1]
        y = np.concatenate([f, b], 2) @ self.out + self.bias
        y -= y.max(2, keepdims=True)
        return y - np.log(np.exp(y).sum(2, keepdims=True))

    def labels(self, data: bytes) -> np.ndarray:
        """Index of the likeliest language at each byte."""
        x, owner, size = windows([data])
        y = self.positions(x).argmax(2).T
        return np.concatenate([row[:n] for row, n in zip(y, size, strict=True)]) if len(size) else np.zeros(0, int)

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities (document, language), pooled over all positions."""
        total = np.zeros((len(texts), len(self.langs)))
        sizes = np.zeros(len(texts))
        x, owner, size = windows(texts)
        for a in range(0, len(owner), LANES):
            s = slice(a, a + LANES)
            y = self.positions(x[:, s])
            y *= (np.arange(len(x))[:, None] < size[s])[..., None]
            np.add.at(total, owner[s], y.sum(0))
            np.add.at(sizes, owner[s], size[s])
        # Positions near each other repeat one another: they count as fewer.
        pooled = total * (TEMPERATURE + 1 / np.maximum(sizes, 1))[:, None]
        pooled -= pooled.max(1, keepdims=True)
        p = np.exp(pooled)
        return p / p.sum(1, keepdims=True)


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (WINDOW, windows), the text each window belongs to, and its size; ends are padded with blanks."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    joined = b"".join(t + b" " * (-len(t) % WINDOW) for t in texts)
    x = np.frombuffer(joined, np.uint8).reshape(-1, WINDOW)
    size = np.full(len(owner), WINDOW)
    last = np.cumsum(counts)[counts > 0] - 1
    size[last] = (sizes[counts > 0] - 1) % WINDOW + 1
    return np.ascontiguousarray(x.T), owner, size


def train(samples: list[tuple[bytes, str]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, seed: int = SEED) -> Network:
    """Fit a network to (text, language) pairs; the same samples give the same weights."""
    langs = sorted({lang for _, lang in samples})
    rng = np.random.default_rng(seed)
    net = Network(langs, Direction.new(hidden, rng), Direction.new(hidden, rng),
                  rng.normal(0, 0.3, (2 * hidden, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    x, owner, size = windows([t for t, _ in samples])
    label = np.array([langs.index(lang) for _, lang in samples])[owner] if samples else np.zeros(0, int)
    by_lang = [np.flatnonzero(label == k) for k in range(len(langs))]
    by_lang = [k for k in by_lang if len(k)]
    if len(by_lang) < 2:
        return net
    params = [net.forward.table, net.forward.u, net.forward.v, net.backward.table, net.backward.u, net.backward.v, net.out, net.bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(k, batch // len(by_lang)) for k in by_lang])   # languages in equal parts
        xs, ys = x[:, pick], label[pick]
        mask = (np.arange(WINDOW)[:, None] < size[pick])[..., None].astype(np.float32)
        kf: list = []
        kb: list = []
        f, b = net.forward.run(xs, kf), net.backward.run(xs[::-1], kb)[::-1]
        both = np.concatenate([f, b], 2)
        y = both @ net.out + net.bias
        y -= y.max(2, keepdims=True)
        p = np.exp(y)
        p /= p.sum(2, keepdims=True)
        p[:, np.arange(len(ys)), ys] -= 1
        d = p * mask / mask.sum()
        dboth = d @ net.out.T
        grads = [*net.forward.back(xs, kf, dboth[..., :hidden]), *net.backward.back(xs[::-1], kb, dboth[::-1, :, hidden:]),
                 np.tensordot(both, d, ((0, 1), (0, 1))), d.sum((0, 1))]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k, g in enumerate(grads):     # Adam
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            params[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    sample_docs: int = SAMPLE_DOCS) -> list[tuple[bytes, str]]:
    """At most ``sample_docs`` labelled documents outside the held-out part, those with the
    smallest hashes, and of each at most ``PIECES`` pieces, ``SAMPLE_BYTES`` in all, at
    hashed places of the whole text.

    Hashes above a bound that a few times ``sample_docs`` rows fall below are dropped
    where they are read, so what reaches the driver does not grow with the table."""
    long = SAMPLE_BYTES // PIECES
    size = F.length("_t")
    places = [F.pmod(F.xxhash64("_id", F.lit(k), F.lit(SEED)), size - long + 1).cast("int") + 1 for k in range(PIECES)]
    part = F.when(size <= SAMPLE_BYTES, F.col("_t")).otherwise(F.concat_ws(" ", *[F.col("_t").substr(p, F.lit(long)) for p in places]))
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), F.col(lang_col).alias("_l"))
    d = d.withColumn("_h", F.xxhash64("_id", F.lit(SEED)))
    share = 4 * sample_docs / max(docs.count(), 1)
    while True:
        near = d if share >= 1 else d.filter(F.col("_h") < -(1 << 63) + int(share * (1 << 64)))
        near = near.filter(~F.coalesce(held_out("_id"), F.lit(False)) & F.col("_l").isNotNull() & F.col("_t").rlike(r"\p{L}"))
        rows = near.select("_l", part.alias("_p"), "_h").orderBy("_h", "_l", "_p").limit(sample_docs).collect()
        if len(rows) == sample_docs or share >= 1:
            return [(r["_p"].encode("utf-8", "replace")[:2 * SAMPLE_BYTES], r["_l"]) for r in rows]
        share *= 8      # few rows have a label


def labelled(text: Column, net: Network) -> Column:
    """struct(lang_pred, score) of a text."""

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple[str, float]] = [(UNDECIDED, 0.0)] * len(batch)
            at = [k for k, t in enumerate(batch) if net.langs and t and any(map(str.isalpha, t))]
            data = [batch.iat[k].encode("utf-8", "replace") for k in at]
            a = 0
            while a < len(data):      # a bounded number of bytes at once
                b, room = a, LANES * WINDOW * 8
                while b < len(data) and (b == a or room > 0):
                    room -= len(data[b])
                    b += 1
                p = net.documents(data[a:b])
                for k, row in zip(at[a:b], p, strict=True):
                    out[k] = (net.langs[int(row.argmax())], float(row.max()))
                a = b
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    return label(text)


def identify(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) for every row; only the text decides.  A
    null id is not held out.  A network without languages answers ``und``."""
    d = small_batches(docs).select(F.col(id_col).alias("_id"), labelled(F.col(text_col), net).alias("_y"))
    return d.select(F.col("_id").alias(id_col), F.coalesce(held_out("_id"), F.lit(False)).alias("held_out"), "_y.*")


def accepted(docs: DataFrame, net: Network, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose text has a language, with at least ``min_score``."""
    y = labelled(F.col(text_col), net)
    return small_batches(docs).filter((y["lang_pred"] != UNDECIDED) & (y["score"] >= min_score))


def train_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network:
    return train(training_sample(docs, id_col, text_col, lang_col))
