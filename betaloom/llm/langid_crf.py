"""Language identification by a linear-chain conditional random field over the words of a text.

Each word has affix, byte n-gram and whole-word (lexicon) features, hashed to weights per language; learned
transitions say how likely a writer changes language between two words. The forward-backward algorithm gives each
word's posterior, so code-switched text gets a label per word; a text's language is the one with most posterior mass.

Long chains are cut into segments of SEGMENT words, very long texts into stretches of such (see Tagger.stretches). The transfer matrix of each segment is formed for all segments at
once, the states at segment bounds follow from them, and then all segments run forward and backward at once; the
result is that of one pass over the whole chain.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .sample import training_sample
from .textvec import LETTER, Hasher, freed, mix, slices, utf8, words

BITS, SEGMENT = 18, 64
STRETCH, LONG = 1 << 18, 2 << 20  # bytes of a stretch, and of a text from which on it is tagged by stretches
UNDETERMINED = "und"


def word_features(hasher: Hasher, starts: np.ndarray, ends: np.ndarray):
    """Yields (words that have the feature, hashed feature index), one kind of feature at a time."""

    def index(kind: int, hashes: np.ndarray) -> np.ndarray:
        return (mix(hashes + np.uint64(kind * 0x9E3779B9)) >> np.uint64(64 - BITS)).astype(np.int64)

    every, size = np.arange(len(starts)), ends - starts
    yield every, index(1, hasher.of(starts, ends))
    for n in (1, 2, 3, 4):
        has = every[size >= n]
        yield has, index(10 + n, hasher.of(starts[has], starts[has] + n))
        yield has, index(20 + n, hasher.of(ends[has] - n, ends[has]))
    for n in (2, 3):
        count = np.maximum(size - n + 1, 0)
        has = np.repeat(every, count)
        at = np.arange(len(has)) - np.repeat(np.cumsum(count) - count, count) + starts[has]
        yield has, index(30 + n, hasher.of(at, at + n))


def emissions(weights: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The score of each word for each language; equal words are scored once."""
    hasher = Hasher(data)
    _, first, back = np.unique(hasher.of(starts, ends), return_index=True, return_inverse=True)
    score = np.zeros((len(first), weights.shape[1]))
    for has, index in word_features(hasher, starts[first], ends[first]):
        for k in range(weights.shape[1]):
            score[:, k] += np.bincount(has, weights[index, k], len(first))
    return score[back]


def _transfers(e_at: np.ndarray, size: np.ndarray, fresh: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Transfer matrices of segments: rows are the label before the segment (before a text's first word: any)."""
    width, seg, labels = e_at.shape
    moved = np.broadcast_to(np.eye(labels), (seg, labels, labels)).copy()
    for t in range(width):
        step = moved @ a if t else np.where(fresh[:, None, None], moved, moved @ a)
        step = step * e_at[t][:, None, :]
        step /= step.max(axis=(1, 2), keepdims=True)
        moved = np.where((size > t)[:, None, None], step, moved)
    return moved


def _transfer(score: np.ndarray, change: np.ndarray, first: bool) -> np.ndarray:
    """The transfer matrix of one stretch of a text; `first` if the text begins with it."""
    labels, n = score.shape[1], len(score)
    parts = -(-n // SEGMENT)
    padded = np.ones((parts * SEGMENT, labels))
    padded[:n] = np.exp(score - score.max(axis=1, keepdims=True)) + 1e-30
    e_at = padded.reshape(parts, SEGMENT, labels).transpose(1, 0, 2)
    size = np.full(parts, SEGMENT)
    size[-1] = n - (parts - 1) * SEGMENT
    fresh = np.zeros(parts, bool)
    fresh[0] = first
    out = np.eye(labels)
    for m in _transfers(e_at, size, fresh, np.exp(change - change.max())):
        out = out @ m
        out /= out.max()
    return out


def forward_backward(score: np.ndarray, before: np.ndarray, start: np.ndarray, change: np.ndarray, enter: np.ndarray | None = None, leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of all words of chains, and the boundary's forward states for training.

    score: of each word and label; before: len + 1 offsets of the chains; start and change: scores of a first label
    and of a change of labels. A chain that is the middle of a longer one has in `enter` the forward state of the word
    before it and in `leave` the backward state of its last word.
    """
    labels = score.shape[1]
    e = np.exp(score - score.max(axis=1, keepdims=True)) + 1e-30 if len(score) else score
    pi, a = np.exp(start - start.max()), np.exp(change - change.max())
    n = np.diff(before)
    parts = -(-n // SEGMENT)
    chain = np.repeat(np.arange(len(n)), parts)
    place = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = before[:-1][chain] + place * SEGMENT
    size = np.minimum(SEGMENT, before[1:][chain] - begin)
    width = int(size.max()) if len(size) else 0
    seg = len(chain)
    e_at = np.ones((width, seg, labels))
    for t in range(width):
        has = size > t
        e_at[t, has] = e[begin[has] + t]
    fresh = (place == 0) & (enter is None)
    moved = _transfers(e_at, size, fresh, a)
    # states at the bounds of segments
    ahead, behind = np.empty((seg, labels)), np.ones((seg, labels))
    rank = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[rank], np.arange(int(parts.max()) + 1 if len(parts) else 0))
    levels = [rank[lo:hi] for lo, hi in zip(cuts, [*cuts[1:], len(rank)])]
    for k, level in enumerate(levels):
        if k:
            prior = level - 1
            state = np.einsum("ni,nij->nj", ahead[prior], moved[prior])
            ahead[level] = state / state.sum(axis=1, keepdims=True)
        else:
            ahead[level] = pi / pi.sum() if enter is None else enter
    if leave is not None:
        behind[np.cumsum(parts) - 1] = leave
    for level in reversed(levels):
        level = level[place[level] + 1 < parts[chain[level]]]
        after = level + 1
        state = np.einsum("nij,nj->ni", moved[after], behind[after])
        behind[level] = state / state.sum(axis=1, keepdims=True)
    # forward and backward inside all segments
    alpha, beta = np.empty_like(e_at), np.empty_like(e_at)
    state = ahead
    for t in range(width):
        step = state @ a if t else np.where(fresh[:, None], state, state @ a)
        step = step * e_at[t]
        step /= step.sum(axis=1, keepdims=True)
        state = np.where((size > t)[:, None], step, state)
        alpha[t] = state
    state = behind
    for t in range(width - 1, -1, -1):
        beta[t] = state
        step = (state * e_at[t]) @ a.T
        step /= step.sum(axis=1, keepdims=True)
        state = np.where((size > t)[:, None], step, state)
    post = alpha * beta
    post /= post.sum(axis=2, keepdims=True)
    out = np.empty_like(score)
    pairs = np.zeros((labels, labels))
    for t in range(width):
        has = size > t
        out[begin[has] + t] = post[t, has]
        if t:
            both = alpha[t - 1, has][:, :, None] * a[None] * (e_at[t, has] * beta[t, has])[:, None, :]
            pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return out, pairs


@dataclass
class Tagger:
    labels: list[str]
    weights: np.ndarray
    start: np.ndarray
    change: np.ndarray

    def tag(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word starts, ends, number of words before each text, and each word's posterior over labels."""
        starts, ends, before = words(data, offsets, LETTER)
        score = emissions(self.weights, data, starts, ends)
        return starts, ends, before, forward_backward(score, before, self.start, self.change)[0]


    def stretches(self, data: np.ndarray):
        """Of one long text (its UTF-8 bytes), stretch by stretch: word starts, ends and posteriors, as of the whole chain.

        Two passes: transfer matrices of all stretches give the states at their bounds, then each is tagged between
        these. Memory holds one stretch of some STRETCH bytes, cut where a word ends; a run of letters that is longer is
        cut inside.
        """
        bounds = [0]
        while len(data) - bounds[-1] > STRETCH:
            gaps = np.flatnonzero(~LETTER[data[bounds[-1] : bounds[-1] + STRETCH]])
            bounds.append(bounds[-1] + (int(gaps[-1]) + 1 if len(gaps) else STRETCH))
        parts = [(a, b) for a, b in zip(bounds, [*bounds[1:], len(data)])]

        def scored(a: int, b: int):
            starts, ends, _ = words(data[a:b], np.array([0, b - a]), LETTER)
            return starts, ends, emissions(self.weights, data[a:b], starts, ends)

        moved, first = [], True
        for a, b in parts:
            score = scored(a, b)[2]
            moved.append(_transfer(score, self.change, first) if len(score) else None)
            first = first and not len(score)
        pi = np.exp(self.start - self.start.max())
        enter, leave = pi / pi.sum(), [np.ones(len(self.labels))]
        for m in reversed(moved[1:]):
            state = leave[-1] if m is None else m @ leave[-1]
            leave.append(state / state.sum())
        leave.reverse()
        first = True
        for (a, b), m, after in zip(parts, moved, leave):
            if m is None:
                continue
            starts, ends, score = scored(a, b)
            post = forward_backward(score, np.array([0, len(score)]), self.start, self.change, None if first else enter, after)[0]
            yield starts + a, ends + a, post
            enter, first = enter @ m, False
            enter = enter / enter.sum()


def _pieces(text: str, size: int = 1 << 18) -> list[str]:
    """text in parts of about `size` characters, cut at spaces where there are any."""
    out, at = [], 0
    while len(text) - at > size:
        stop = text.rfind(" ", at, at + size) + 1 or at + size
        out.append(text[at:stop])
        at = stop
    return [*out, text[at:]]


@dataclass
class Corpus:
    """Texts as chains of word numbers, and the features of each distinct word (those of word i: index[at[i]:at[i + 1]])."""

    word: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    gold: np.ndarray
    index: np.ndarray
    at: np.ndarray


def chains(texts: list[str], labels: list[int], length: int) -> Corpus:
    """Every word of every text, in chains of up to `length` neighbours. Memory grows with words, not with their features."""
    parts, of = [], []
    for text, label in zip(texts, labels):
        for part in _pieces(text):
            parts.append(part)
            of.append(label)
    column = pc.utf8_lower(pa.array(parts, pa.string()))
    hashes, names, known, begin, end, gold, n = [], [], [], [], [], [], 0
    for lo, hi in slices(column):
        data, offsets = utf8(column.slice(lo, hi - lo))
        starts, ends, before = words(data, offsets, LETTER)
        h, raw = Hasher(data).of(starts, ends), data.tobytes()
        fresh, first = np.unique(h, return_index=True)
        hashes.append(h)
        known.append(fresh)
        names += [raw[starts[i] : ends[i]] for i in first.tolist()]
        count = np.diff(before)
        k = -(-count // length)
        text = np.repeat(np.arange(len(count)), k)
        place = np.arange(len(text)) - np.repeat(np.cumsum(k) - k, k)
        begin.append(n + before[text] + place * count[text] // k[text])
        end.append(n + before[text] + (place + 1) * count[text] // k[text])
        gold.append(np.array(of[lo:hi])[text])
        n += len(h)
    vocabulary, first = np.unique(np.concatenate(known), return_index=True)
    word = np.searchsorted(vocabulary, np.concatenate(hashes)).astype(np.int32)
    del hashes, known
    index, count = [], []
    for lo in range(0, len(first), 8192):  # features of some words at a time
        data, offsets = utf8(pa.array([names[i] for i in first[lo : lo + 8192].tolist()], pa.binary()).cast(pa.large_binary()).view(pa.large_string()))
        owner, at = (np.concatenate(x) for x in zip(*((h.astype(np.int32), i.astype(np.int32)) for h, i in word_features(Hasher(data), offsets[:-1], offsets[1:]))))
        index.append(at[np.argsort(owner, kind="stable")])
        count.append(np.bincount(owner, minlength=len(offsets) - 1))
    at = np.concatenate([[0], np.cumsum(np.concatenate([np.empty(0, np.int64), *count]))])
    return Corpus(word, np.concatenate(begin), np.concatenate(end), np.concatenate(gold), np.concatenate([np.empty(0, np.int32), *index]), at)


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all ranges begin[i]..end[i] - 1, one after the other."""
    n = end - begin
    return np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())


def train(texts: list[str], labels: list[str], *, steps: int = 150, batch: int = 192, length: int = 24, rate: float = 0.25, decay: float = 1e-6, mixed: float = 0.3, seed: int = 5) -> Tagger:
    """Fit weights and transitions by at least `steps` AdaGrad updates on the chains' log likelihood, whole passes over all words.

    texts are in one language each. A share of the chains is made of two, so that changes of language are seen.
    """
    names = sorted(set(labels))
    L = max(1, len(names))
    tagger = Tagger(names or [UNDETERMINED], np.zeros((1 << BITS, L)), np.zeros(L), np.zeros((L, L)))
    if len(names) < 2:
        return tagger
    number = {x: k for k, x in enumerate(names)}
    c = chains(texts, [number[x] for x in labels], length)
    rng = np.random.default_rng(seed)
    squares, s_start, s_change = np.full((1 << BITS, L), 1e-4), np.full(L, 1e-4), np.full((L, L), 1e-4)
    parts = max(1, len(c.begin) // batch)
    for _ in range(-(-steps // parts) if len(c.begin) else 0):
        for take in np.array_split(rng.permutation(len(c.begin)), parts):
            first, k = [], 0  # places in take at which a chain begins; the others are joined to the one before
            while k < len(take):
                first.append(k)
                k += 2 if rng.random() < mixed else 1
            rows, size = _ranges(c.begin[take], c.end[take]), c.end[take] - c.begin[take]
            y = np.repeat(c.gold[take], size)
            bounds = np.append(np.concatenate([[0], np.cumsum(size)])[first], len(rows))
            used_words, word = np.unique(c.word[rows], return_inverse=True)
            used = c.index[_ranges(c.at[used_words], c.at[used_words + 1])]
            owner = np.repeat(np.arange(len(used_words)), c.at[used_words + 1] - c.at[used_words])
            score = np.stack([np.bincount(owner, tagger.weights[used, k], len(used_words)) for k in range(L)], axis=1)[word]
            post, pairs = forward_backward(score, bounds, tagger.start, tagger.change)
            wrong = post.copy()
            wrong[np.arange(len(rows)), y] -= 1
            wrong /= len(first)
            touched, where = np.unique(used, return_inverse=True)
            of_word = np.stack([np.bincount(word, wrong[:, k], len(used_words)) for k in range(L)], axis=1)
            grad = np.stack([np.bincount(where, of_word[owner, k], len(touched)) for k in range(L)], axis=1) + decay * tagger.weights[touched]
            squares[touched] += grad**2
            tagger.weights[touched] -= rate * grad / np.sqrt(squares[touched])
            g = wrong[bounds[:-1]].sum(axis=0)
            s_start += g**2
            tagger.start -= rate * 0.2 * g / np.sqrt(s_start)
            inner = np.ones(len(rows), bool)
            inner[bounds[:-1]] = False
            inner[np.arange(len(rows)) - bounds[np.searchsorted(bounds, np.arange(len(rows)), "right") - 1] >= SEGMENT] = False
            seen = np.zeros((L, L))
            np.add.at(seen, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
            g = (pairs - seen) / len(first)
            s_change += g**2
            tagger.change -= rate * 0.2 * g / np.sqrt(s_change)
    tagger.weights = tagger.weights.astype(np.float32)
    return tagger


def held_out(id_col: str, folds: int = 4, fold: int = 2):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold


def fit_langid(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = 4_000, max_bytes: int = 16 << 20, **training) -> Tagger:
    """Fit on whole texts of at most max_rows distinct documents with a language outside the held-out fold, of max_bytes in all.

    They are those whose hashed rows are smallest in each language, as many of each as there are (see training_sample),
    so a rare language is learned too. Null ids, languages and texts are left out; repeated rows count once. With fewer
    than two languages, all text gets the one there is; with an empty table it is "und". The model is trained in one
    task, whose memory those bounds bound, and only the model reaches the driver.
    """
    marked = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(~held_out("doc_id"))
    rows = marked.select("doc_id", F.xxhash64("text", "lang").alias("t"), "text")
    keys = marked.select("doc_id", F.xxhash64("text", "lang").alias("t"), F.octet_length("text").alias("size"), "lang")
    chosen = training_sample(rows, keys, "lang", max_rows, max_bytes).select("lang", "text").repartition(1).sortWithinPartitions("lang", "text")

    def run(batches):
        langs, texts = [], []
        for b in batches:
            langs += b.column("lang").to_pylist()
            texts += b.column("text").to_pylist()
        t = train(texts, langs, **training)
        yield pa.RecordBatch.from_arrays([pa.array([t.labels]), *(pa.array([np.asarray(x, kind).tobytes()]) for x, kind in ((t.weights, "<f4"), (t.start, "<f8"), (t.change, "<f8")))], names=["labels", "weights", "start", "change"])

    model = chosen.mapInArrow(run, "labels array<string>, weights binary, start binary, change binary").head()
    if model is None:
        return train([], [])
    n = len(model.labels)
    return Tagger(list(model.labels), np.frombuffer(model.weights, "<f4").reshape(-1, n), np.frombuffer(model.start), np.frombuffer(model.change).reshape(n, n))


def identify_language(docs: DataFrame, tagger: Tagger, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = (), certainty: bool = False) -> DataFrame:
    """One row per input row: the columns in keep unchanged, doc_id, lang_pred and score (its mean posterior, 0 to 1).

    A column in keep with the name of a result (in any case) gives way to it.

    certainty adds a column of that name: the mean over words of the best language's posterior, from 0 (no better than
    chance among the learned languages) to 1, whether or not the words agree on a language. With one language it is 1.
    n_words comes with it: how many words that mean is over.

    Null texts and texts without a letter get "und", score 0 and certainty 0. Ties go to the first language in order. Repeated rows
    get equal results. An empty table gives no rows. Texts beyond LONG bytes are tagged by stretches, with the same result
    and memory that does not grow with them beyond the text itself; only a run of letters beyond STRETCH bytes counts as
    several words.
    """
    text = F.col(text_col)
    keep = [c for c in keep if c.lower() not in ("lang_pred", "score", *(("certainty", "n_words") if certainty else ()))]
    others = [c for c in keep if c not in ("doc_id", text_col)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("__text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("__letter"), *others)
    source = {c: "__text" if c == text_col else c for c in ["doc_id", *(c for c in keep if c != "doc_id")]}  # the text goes to Python once
    out = StructType([StructField("doc_id", LongType()), *(docs.schema[c] for c in keep if c != "doc_id")]).add("lang_pred", "string").add("score", "double")
    if certainty:
        out = out.add("certainty", "double").add("n_words", "long")
    least = 1 / len(tagger.labels)

    def run(batches):
        for b in freed(batches):
            pred, score, sure, n_words = [UNDETERMINED] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
            letter, column = b.column("__letter").to_pylist(), b.column("__text")
            for lo, hi in slices(column):
                data, offsets = utf8(pc.utf8_lower(column.slice(lo, hi - lo)))
                if len(data) > LONG:  # a text of its own
                    sums, best, n = np.zeros(len(tagger.labels)), 0.0, 0
                    for _, _, post in tagger.stretches(data):
                        sums, best, n = sums + post.sum(axis=0), best + post.max(axis=1).sum(), n + len(post)
                    if letter[lo] and n:
                        k = int(sums.argmax())
                        n_words[lo], sure[lo] = n, min(1.0, max(0.0, (best / n - least) / (1 - least))) if least < 1 else 1.0
                        pred[lo], score[lo] = tagger.labels[k], min(1.0, sums[k] / n)
                    continue
                _, _, before, post = tagger.tag(data, offsets)
                total = np.concatenate([np.zeros((1, post.shape[1])), np.cumsum(post, axis=0)])
                mass = (total[before[1:]] - total[before[:-1]]) / np.maximum(np.diff(before), 1)[:, None]
                n_words[lo:hi] = np.diff(before)
                best = np.concatenate([[0.0], np.cumsum(post.max(axis=1))])
                best = (best[before[1:]] - best[before[:-1]]) / np.maximum(np.diff(before), 1)
                for i, k in enumerate(mass.argmax(axis=1)):
                    if letter[lo + i]:
                        sure[lo + i] = min(1.0, max(0.0, (best[i] - least) / (1 - least))) if least < 1 else 1.0
                        pred[lo + i], score[lo + i] = tagger.labels[k], min(1.0, mass[i, k])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in source.values()), pa.array(pred), pa.array(score), *([pa.array(sure), pa.array(n_words)] if certainty else [])], names=out.names)

    return rows.mapInArrow(run, out)


def tag_words(docs: DataFrame, tagger: Tagger, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per word: doc_id, word (from 0), text (lower case), lang_pred and score of the word in its context.

    Null and empty texts and texts without a letter have no word and give no row; repeated rows give their words each.
    Other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            for lo, hi in slices(b.column("text")):
                data, offsets = utf8(pc.utf8_lower(b.column("text").slice(lo, hi - lo)))
                if len(data) > LONG:
                    n = 0
                    for starts, ends, post in tagger.stretches(data):
                        best = post.argmax(axis=1)
                        text = [data[i:j].tobytes().decode("utf-8", "ignore") for i, j in zip(starts.tolist(), ends.tolist())]
                        at = pa.array(np.arange(n, n + len(best)).astype(np.int32))
                        yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(np.full(len(best), lo))), at, pa.array(text, pa.string()), pa.array([tagger.labels[k] for k in best], pa.string()), pa.array(post[np.arange(len(best)), best].astype(float))], names=["doc_id", "word", "text", "lang_pred", "score"])
                        n += len(best)
                    continue
                starts, ends, before, post = tagger.tag(data, offsets)
                raw, best = data.tobytes(), post.argmax(axis=1) if len(post) else np.empty(0, int)
                doc = np.repeat(np.arange(hi - lo), np.diff(before))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)),
                        pa.array((np.arange(len(doc)) - before[doc]).astype(np.int32)),
                        pa.array([raw[s:e].decode("utf-8", "ignore") for s, e in zip(starts, ends)], pa.string()),
                        pa.array([tagger.labels[k] for k in best], pa.string()),
                        pa.array(post[np.arange(len(best)), best].astype(float)),
                    ],
                    names=["doc_id", "word", "text", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, "doc_id long, word int, text string, lang_pred string, score double")
