"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its words, hashed and weighted by the root of their share, one bin of each structure
statistic (bin edges are quantiles of the training rows) and one bin of its recorded length. Every pair of features
interacts through the product of their low-rank factors; the sum of all pair terms is half of (square of the sum -
sum of the squares) per factor, so a score takes time linear in the number of features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .sample import training_sample
from .textvec import LETTER, SPACE, Hasher, freed, slices, utf8, words

WORD_BITS, BINS = 15, 12
LENGTH_BINS = 40  # powers of two of the recorded length; the last bin is for no length


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


_UPPER, _DIGIT, _LINE = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789"), _class("\n")
_STOP = _class(".,;:?")
_MARK = ~(LETTER | SPACE | _DIGIT | _STOP)
N_STATS = 12
SIZE = (1 << WORD_BITS) + N_STATS * BINS + LENGTH_BINS


def statistics(data: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, before: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The structure statistics of each text, one row each."""
    size, n = np.diff(offsets).astype(float), np.diff(before).astype(float)

    def count(member: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(member, dtype=np.int64)])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    def per_word(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
        return total[before[1:]] - total[before[:-1]]

    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    text = np.repeat(np.arange(len(n)), np.diff(before))
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    unique = np.bincount(t[new], minlength=len(n)).astype(float)
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(h)))
    most = np.zeros(len(n))
    np.maximum.at(most, t[at], runs)
    lines = count(_LINE[data]) + 1
    one, w = np.maximum(size, 1), np.maximum(n, 1)
    letters = count(LETTER[data])
    upper = count(_UPPER[data])
    marks = count(_MARK[data])
    length = per_word((ends - starts).astype(float)) / w
    return np.stack([np.log1p(size), upper / np.maximum(letters, 1), marks / one, count(_STOP[data]) / one, count(_DIGIT[data]) / one, letters / one, per_word(same) / w, unique / w, most / w, length, size / lines, count(_class("|!")[data]) / w], axis=1)


def features(column: pa.Array, lengths: list) -> "list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]":
    """For ranges of rows: first row, text of each word feature, its index, its weight, and statistics with the length bin as last column."""
    for lo, hi in slices(column):
        data, offsets = utf8(column.slice(lo, hi - lo))
        starts, ends, before = words(data, offsets, LETTER)
        hashes = Hasher(data).of(starts, ends)
        stats = statistics(data, offsets, hashes, before, starts, ends)
        n = np.diff(before)
        text = np.repeat(np.arange(len(n), dtype=np.int64), n)
        key, times = np.unique((text << WORD_BITS) | (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
        owner = key >> WORD_BITS
        size = np.array([-1 if x is None or x < 0 else x for x in lengths[lo:hi]], float)
        bin_ = np.where(size < 0, LENGTH_BINS - 1, np.minimum(LENGTH_BINS - 2, np.log2(np.maximum(size, 0) + 1).astype(int)))
        yield lo, owner, key & ((1 << WORD_BITS) - 1), np.sqrt(times / n[owner]), np.column_stack([stats, bin_])


@dataclass
class Model:
    """bias, weights w, factors v and bin edges of a trained machine."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    edges: np.ndarray

    def indices(self, stats: np.ndarray) -> np.ndarray:
        """The index of each text's bin of each statistic and of its length."""
        bins = np.stack([np.searchsorted(e, stats[:, k], "right") for k, e in enumerate(self.edges)], axis=1)
        return np.column_stack([bins + (1 << WORD_BITS) + np.arange(N_STATS) * BINS, stats[:, -1].astype(int) + (1 << WORD_BITS) + N_STATS * BINS])

    def sums(self, n: int, owner: np.ndarray, index: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: sum of w x, sum of v x, and sum of (v x)^2 over the factors. owner is sorted."""
        v = self.v[index] * weight[:, None]
        line = np.bincount(owner, self.w[index] * weight, n)
        total, at = np.zeros((n, v.shape[1])), np.searchsorted(owner, np.arange(n))
        full = at < np.append(at[1:], len(owner))
        if full.any():
            total[full] = np.add.reduceat(v, at[full], axis=0)
        return line, total, np.bincount(owner, (v * v).sum(axis=1), n)

    def score(self, owner: np.ndarray, index: np.ndarray, weight: np.ndarray, stats: np.ndarray) -> np.ndarray:
        n, fixed = len(stats), self.indices(stats)
        a = self.sums(n, owner, index, weight)
        b = self.sums(n, np.repeat(np.arange(n), fixed.shape[1]), fixed.ravel(), np.ones(fixed.size))
        z = self.bias + a[0] + b[0] + 0.5 * (((a[1] + b[1]) ** 2).sum(axis=1) - a[2] - b[2])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], stats: np.ndarray, labels: np.ndarray, rank: int = 8, steps: int = 500, batch: int = 128, rate: float = 0.1, decay: float = 1e-5, seed: int = 3) -> Model:
    """Fit by at least `steps` AdaGrad updates on the log loss. rows: word indices and weights of each text; stats as features() gives them."""
    rng = np.random.default_rng(seed)
    edges = np.quantile(stats[:, :N_STATS], np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T if len(stats) else np.zeros((N_STATS, BINS - 1))
    model = Model(0.0, np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, rank)), edges)
    if not len(labels):
        return model
    share = np.clip(labels.mean(), 0.01, 0.99)
    model.bias = float(np.log(share / (1 - share)))
    fixed = model.indices(stats)
    index = [np.concatenate([i, f]) for (i, _), f in zip(rows, fixed)]
    weight = [np.concatenate([x, np.ones(len(f))]) for (_, x), f in zip(rows, fixed)]
    gw, gv = np.full(SIZE, 1e-2), np.full((SIZE, rank), 1e-2)
    parts = -(-len(labels) // batch)
    for _ in range(-(-steps // parts)):
        for take in np.array_split(rng.permutation(len(labels)), parts):
            i, x = np.concatenate([index[k] for k in take]), np.concatenate([weight[k] for k in take])
            owner = np.repeat(np.arange(len(take)), [len(index[k]) for k in take])
            line, total, squares = model.sums(len(take), owner, i, x)
            z = model.bias + line + 0.5 * ((total**2).sum(axis=1) - squares)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[take]) / len(take)
            model.bias -= rate * float(g.sum())
            used, where = np.unique(i, return_inverse=True)
            dw = np.bincount(where, g[owner] * x, len(used)) + decay * model.w[used]
            pull = (g[owner] * x)[:, None] * (total[owner] - model.v[i] * x[:, None])
            dv = np.stack([np.bincount(where, pull[:, f], len(used)) for f in range(rank)], axis=1) + decay * model.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            model.w[used] -= rate * dw / np.sqrt(gw[used])
            model.v[used] -= rate * dv / np.sqrt(gv[used])
    return model


def _training_rows(batches):
    for b in batches:
        quality = b.column("quality").to_numpy()
        for lo, owner, index, weight, stats in features(b.column("text"), b.column("n_chars").to_pylist()):
            at = np.searchsorted(owner, np.arange(len(stats) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(quality[lo : lo + len(stats)]),
                    pa.array([index[a:z].astype("<u2").tobytes() for a, z in zip(at, at[1:])], pa.binary()),
                    pa.array([weight[a:z].astype("<f4").tobytes() for a, z in zip(at, at[1:])], pa.binary()),
                    pa.array([s.tobytes() for s in stats], pa.binary()),
                ],
                names=["quality", "i", "x", "stats"],
            )


def held_out(id_col: str, folds: int = 5, fold: int = 0):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", label_col: str = "quality", max_rows: int = 8_000, max_bytes: int = 64 << 20, **training) -> Model:
    """Fit on whole texts of at most max_rows distinct labelled rows outside the held-out fold, of max_bytes in all.

    They are those whose hashed rows are smallest (see training_sample). Ids without a document, null labels and null
    ids are left out; repeated rows and labels count once, an id with both labels counts as both. Without any row,
    every score is 0.5. The model is trained in one task, whose memory those bounds bound; only it reaches the driver.
    """
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("quality")).where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")).distinct()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(length_col).cast("long").alias("n_chars"))
    texts = texts.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")).withColumn("t", F.xxhash64("text", "n_chars"))
    keys = texts.select("doc_id", "t", F.octet_length("text").alias("size")).join(marked, "doc_id")  # without texts
    rows = training_sample(texts, keys, None, max_rows, max_bytes).select("text", "n_chars", "quality")
    featured = rows.mapInArrow(_training_rows, "quality int, i binary, x binary, stats binary").repartition(1)

    def run(batches):
        got = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("stats", "i", "quality", "x")))]
        got.sort()  # the order of rows must not depend on the cluster
        words_ = [(np.frombuffer(i, "<u2").astype(np.int64), np.frombuffer(x, "<f4").astype(float)) for _, i, _, x in got]
        stats = np.array([np.frombuffer(s) for s, *_ in got]).reshape(-1, N_STATS + 1)
        m = train(words_, stats, np.array([q for _, _, q, _ in got], float), **training)
        yield pa.RecordBatch.from_arrays([pa.array([m.bias]), *(pa.array([x.astype("<f8").tobytes()]) for x in (m.w, m.v, m.edges))], names=["bias", "w", "v", "edges"])

    model = featured.mapInArrow(run, "bias double, w binary, v binary, edges binary").head()
    if model is None:
        return train([], np.zeros((0, N_STATS + 1)), np.zeros(0), **training)
    return Model(model.bias, np.frombuffer(model.w), np.frombuffer(model.v).reshape(SIZE, -1), np.frombuffer(model.edges).reshape(N_STATS, -1))


def score_quality(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", keep: list[str] = ()) -> DataFrame:
    """One row per input row: the columns in keep unchanged, doc_id and score (0 to 1); a kept column of that name, in any case, gives way to it.

    Null text counts as empty; a text without words is scored from its statistics alone. Repeated rows get equal
    scores. An empty table gives no rows.
    """
    keep = [c for c in keep if c.lower() != "score"]
    others = [c for c in keep if c not in ("doc_id", text_col)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"), F.col(length_col).cast("long").alias("__length"), *others)
    source = {c: "__text" if c == text_col else c for c in ["doc_id", *(c for c in keep if c != "doc_id")]}  # the text goes to Python once
    out = StructType([StructField("doc_id", LongType()), *(docs.schema[c] for c in keep if c != "doc_id")]).add("score", "double")

    def run(batches):
        for b in freed(batches):
            score = np.zeros(b.num_rows)
            for lo, owner, index, weight, stats in features(b.column("__text"), b.column("__length").to_pylist()):
                score[lo : lo + len(stats)] = model.score(owner, index, weight, stats)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in source.values()), pa.array(score)], names=out.names)

    return rows.mapInArrow(run, out)
