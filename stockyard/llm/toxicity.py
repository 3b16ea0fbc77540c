"""Toxicity by a bidirectional gated recurrent network with attention over overlapping windows.

A word enters as its own vector, if it was seen in training, and as the mean of its character
trigrams' vectors. Two gated recurrent layers read a window forwards and backwards, attention weighs
their states, and one logit comes out. A document's score is that of its highest window, brought to
a probability on the training documents. The network is trained in numpy on a bounded sample of
labelled documents and sent to all tasks; every window of every whole text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import portions, text_bytes
from stockyard.llm.words import NO_LETTER, mixed, words_of

# Words of a window, and how far apart windows begin.
WINDOW, STRIDE = 32, 16
# The sample: at most so many documents of each label, none with more characters.
MOST_TOXIC, MOST_CLEAN, MOST_CHARACTERS = 2500, 4000, 20_000
VOCABULARY, TRIGRAMS, EMBEDDED, HIDDEN = 30_000, 1 << 12, 8, 8
EPOCHS, LEAST_STEPS, BATCH, RATE = 6, 400, 128, 0.01
TEXT_PER_STEP = 1 << 21


@dataclass
class Read:
    """The words of some texts: each distinct one's hash and trigrams, and which one stands where."""

    hashes: np.ndarray
    trigrams: np.ndarray
    trigram_start: np.ndarray
    word: np.ndarray
    first: np.ndarray


def read(data: np.ndarray, bounds: np.ndarray) -> Read:
    words = words_of(data, bounds, lower=True, apart=NO_LETTER)
    hashes, example, word = np.unique(words.hash, return_index=True, return_inverse=True)
    start, length = words.start[example], (words.end - words.start)[example]
    opens = np.cumsum(length) - length
    at = np.repeat(start - opens, length) + np.arange(int(length.sum()))
    letters = data[at].astype(np.int64)
    upper = (letters >= ord("A")) & (letters <= ord("Z"))
    letters[upper] += 32
    # A letter with its neighbours, 0 beyond the word's ends.
    before, after = np.roll(letters, 1), np.roll(letters, -1)
    if len(letters):
        before[opens] = 0
        after[opens + length - 1] = 0
    code = (before * 65537 + letters * 257 + after).astype(np.uint64)
    trigrams = (mixed(code) >> np.uint64(40)).astype(np.int64) & (TRIGRAMS - 1)
    return Read(hashes, trigrams, opens, word, words.first)


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words, and text of each window; a text without words has none."""
    counts = np.diff(first)
    n = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // STRIDE)) + 1, 0)
    text = np.repeat(np.arange(len(counts)), n)
    nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = first[:-1][text] + nth * STRIDE
    return start, np.minimum(WINDOW, first[1:][text] - start), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """The network's weights, and what it makes of windows."""

    def __init__(self, vocabulary: np.ndarray, signal: np.ndarray):
        rng = np.random.default_rng(11)

        def small(*shape: int, by: float = 0.3) -> np.ndarray:
            return (rng.standard_normal(shape) * by).astype(np.float32)

        # Hashes of known words, ascending; the row after the last is for all others.
        self.vocabulary = vocabulary
        e, h = EMBEDDED, HIDDEN
        self.w = {"word": small(len(vocabulary) + 1, e, by=0.05), "trigram": small(TRIGRAMS, e, by=0.05)}
        # A word's first coordinate starts as how much it prefers toxic documents.
        self.w["word"][:-1, 0] = signal
        for side in "fb":
            self.w[f"in_{side}"] = small(2 * e, 3 * h)
            self.w[f"own_{side}"] = small(h, 3 * h)
            self.w[f"bias_{side}"] = np.zeros(3 * h, np.float32)
        self.w |= {"attend": small(2 * h, h), "focus": small(h), "out": small(2 * h), "level": np.zeros(1, np.float32)}
        # Brings the highest logit of a document to a probability.
        self.slope, self.shift = 1.0, 0.0

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.vocabulary, hashes)
        known = self.vocabulary[np.minimum(place, len(self.vocabulary) - 1)] == hashes if len(self.vocabulary) else hashes == ~hashes
        return np.where(known, place, len(self.vocabulary))

    def inputs(self, text: Read) -> np.ndarray:
        """The vector of each distinct word."""
        sums = np.add.reduceat(self.w["trigram"][text.trigrams], text.trigram_start) if len(text.hashes) else np.zeros((0, EMBEDDED), np.float32)
        lengths = np.diff(np.append(text.trigram_start, len(text.trigrams)))
        return np.concatenate([self.w["word"][self.rows(text.hashes)], sums / lengths[:, None].astype(np.float32)], axis=1)

    # States, gates and gradients have one row per feature and one column per window.

    def _layer(self, drive: np.ndarray, words: np.ndarray, own: np.ndarray, there, order, keep: bool):
        """States of one direction; `drive` has the gates' inputs of each word."""
        h, n = HIDDEN, words.shape[1]
        state, states, kept = np.zeros((h, n), np.float32), np.empty((WINDOW, h, n), np.float32), {}
        for t in order:
            pull = own.T @ state
            gates = drive.take(words[t], axis=1)
            both = gates[: 2 * h]
            both += pull[: 2 * h]
            both *= 0.5
            np.tanh(both, out=both)
            both *= 0.5
            both += 0.5
            z, r = both[:h], both[h:]
            new = np.tanh(gates[2 * h :] + r * pull[2 * h :])
            if keep:
                kept[t] = (state, z, r, new, pull[2 * h :])
            step = new - state
            step *= 1 - z
            if there is not None:
                step *= there[t]
            state = state + step
            states[t] = state
        return states, kept

    def drives(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        """What each word puts into the gates of both directions."""
        return {s: np.ascontiguousarray((vectors @ self.w[f"in_{s}"] + self.w[f"bias_{s}"]).T) for s in "fb"}

    def forward(self, drives: dict[str, np.ndarray], words: np.ndarray, there: np.ndarray, keep: bool = False):
        """Logits of windows; `words` are columns of `drives` and `there` says which exist, as (steps, windows)."""
        here = there.astype(np.float32)
        mask = None if there.all() else here
        states, kept = [], {}
        for side, order in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
            found, kept[side] = self._layer(drives[side], words, self.w[f"own_{side}"], mask, order, keep)
            states.append(found)
        both = np.concatenate(states, axis=1)
        bent = np.tanh(self.w["attend"].T @ both)
        heed = self.w["focus"] @ bent
        heed = np.exp(heed - heed.max(axis=0)) * here
        heed /= heed.sum(axis=0)
        pooled = np.einsum("tin,tn->in", both, heed)
        logit = self.w["out"] @ pooled + self.w["level"][0]
        return (logit, (both, bent, heed, pooled, kept, here)) if keep else (logit, None)

    def gradients(self, vectors, words, there, target) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean cross entropy: by the weights after the embedding, and by `vectors`."""
        logit, (both, bent, heed, pooled, kept, here) = self.forward(self.drives(vectors), words, there, keep=True)
        h, slope = HIDDEN, ((_sigmoid(logit) - target) / len(target)).astype(np.float32)
        g = {"out": pooled @ slope, "level": np.array([slope.sum()], np.float32)}
        d_pooled = self.w["out"][:, None] * slope
        d_heed = np.einsum("tin,in->tn", both, d_pooled)
        d_score = heed * (d_heed - (heed * d_heed).sum(axis=0))
        g["focus"] = np.einsum("thn,tn->h", bent, d_score)
        d_bent = d_score[:, None, :] * self.w["focus"][:, None] * (1 - bent * bent)
        g["attend"] = np.einsum("tin,tjn->ij", both, d_bent)
        d_both = heed[:, None, :] * d_pooled + self.w["attend"] @ d_bent
        d_vectors = np.zeros_like(vectors)
        order_of = np.argsort(words.ravel(), kind="stable")
        opens = np.searchsorted(words.ravel()[order_of], np.arange(len(vectors)))
        for k, (side, order) in enumerate((("f", range(WINDOW - 1, -1, -1)), ("b", range(WINDOW)))):
            own, carried = self.w[f"own_{side}"], 0.0
            d_own, d_drive = np.zeros_like(own), np.zeros((WINDOW, 3 * h, len(target)), np.float32)
            for t in order:
                state, z, r, new, pull = kept[side][t]
                total = d_both[t, k * h : (k + 1) * h] + carried
                moved = total * here[t]
                d_new = moved * (1 - z) * (1 - new * new)
                d_z = moved * (state - new) * z * (1 - z)
                d_r = d_new * pull * r * (1 - r)
                d_pull = np.concatenate([d_z, d_r, d_new * r])
                d_drive[t] = np.concatenate([d_z, d_r, d_new])
                d_own += state @ d_pull.T
                carried = total - moved + moved * z + own @ d_pull
            flat = d_drive.transpose(0, 2, 1).reshape(-1, 3 * h)
            g[f"own_{side}"], g[f"bias_{side}"] = d_own, flat.sum(axis=0)
            summed = np.add.reduceat(flat[order_of], opens)
            g[f"in_{side}"] = vectors.T @ summed
            d_vectors += summed @ self.w[f"in_{side}"].T
        return g, d_vectors

    def logits(self, text: Read, most: int = 1 << 13) -> tuple[np.ndarray, np.ndarray]:
        """The logit of every window, and its text."""
        drives = self.drives(self.inputs(text))
        start, length, of = windows_of(text.first)
        out = np.empty(len(start), np.float32)
        steps = np.arange(WINDOW)[:, None]
        for low in range(0, len(start), most):
            part = slice(low, low + most)
            there = steps < length[part]
            at = np.where(there, start[part] + steps, 0)
            out[part] = self.forward(drives, text.word[at], there)[0]
        return out, of

    def scores(self, text: Read) -> np.ndarray:
        """The probability of each text; one without words has that of the lowest logit there can be."""
        highest = np.full(len(text.first) - 1, -np.inf)
        logits, of = self.logits(text)
        np.maximum.at(highest, of, logits)
        return _sigmoid(np.clip(self.slope * highest + self.shift, -30, 30))


def _signal(text: Read, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of two documents or more, and how much more toxic documents have them than expected."""
    of = np.repeat(np.arange(len(toxic)), np.diff(text.first))
    pairs = np.unique(text.word * len(toxic) + of)
    word, document = pairs // len(toxic), pairs % len(toxic)
    all_ = np.bincount(word, minlength=len(text.hashes))
    hits = np.bincount(word, weights=toxic[document], minlength=len(text.hashes))
    expected = all_ * toxic.mean()
    signal = np.clip((hits - expected) / np.sqrt(expected + 1), -3, 6) / 3
    # The most frequent words, and those that say most.
    order = np.argsort(-(np.abs(signal) * 1000 + np.minimum(all_, 999)), kind="stable")
    known = np.sort(order[all_[order] > 1][:VOCABULARY])
    return text.hashes[known], signal[known].astype(np.float32)


def train(data: np.ndarray, bounds: np.ndarray, toxic: np.ndarray) -> Network:
    """The network from labelled texts."""
    rng = np.random.default_rng(7)
    text = read(data, bounds)
    net = Network(*_signal(text, toxic))
    start, length, of = windows_of(text.first)
    # A toxic document's windows are toxic where its words say so most, until the network says better.
    own = net.w["word"][net.rows(text.hashes), 0]
    steps = np.arange(WINDOW)[:, None]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    turn = 0
    lengths = np.diff(np.append(text.trigram_start, len(text.trigrams)))
    epoch, looked = 0, 0
    # A small sample is gone through more often.
    while epoch < EPOCHS or turn < LEAST_STEPS:
        if epoch < 2:
            there = steps < length
            suspect = np.where(there, own[text.word[np.where(there, start + steps, 0)]], -1).max(axis=0)
        elif turn >= looked:
            suspect, looked = net.logits(text)[0], turn + LEAST_STEPS // 6
        best = np.lexsort((rng.random(len(of)), -suspect, of))
        rank = np.empty(len(of), np.int64)
        rank[best] = np.arange(len(of)) - np.searchsorted(of, of)[best]
        # Of each document the windows that look worst, and of clean ones one more at random.
        chosen = np.flatnonzero((rank < 1) | ((rank < 3) & (toxic[of] == 0)))
        rng.shuffle(chosen)
        for low in range(0, len(chosen), BATCH):
            batch = chosen[low : low + BATCH]
            there = steps < length[batch]
            at = text.word[np.where(there, start[batch] + steps, 0)]
            used, words = np.unique(at, return_inverse=True)
            words = words.reshape(at.shape)
            spans = [slice(text.trigram_start[u], text.trigram_start[u] + lengths[u]) for u in used]
            trigrams = np.concatenate([text.trigrams[s] for s in spans])
            sizes = lengths[used].astype(np.float32)
            opens = np.concatenate([[0], np.cumsum(lengths[used])[:-1]])
            rows = net.rows(text.hashes[used])
            mean = np.add.reduceat(net.w["trigram"][trigrams], opens) / sizes[:, None]
            vectors = np.concatenate([net.w["word"][rows], mean], axis=1)
            g, d = net.gradients(vectors, words, there, toxic[of[batch]].astype(np.float32))
            g["word"] = np.zeros_like(net.w["word"])
            np.add.at(g["word"], rows, d[:, :EMBEDDED])
            g["trigram"] = np.zeros_like(net.w["trigram"])
            np.add.at(g["trigram"], trigrams, np.repeat(d[:, EMBEDDED:] / sizes[:, None], lengths[used], axis=0))
            turn += 1
            for name, slope in g.items():
                mean_, square = moments[name]
                mean_ += 0.1 * (slope - mean_)
                square += 0.001 * (slope * slope - square)
                step = mean_ / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
                net.w[name] -= (RATE * step).astype(np.float32)
        epoch += 1
    _calibrate(net, text, toxic)
    return net


def _calibrate(net: Network, text: Read, toxic: np.ndarray) -> None:
    """A logistic curve through the documents' highest logits."""
    highest = np.full(len(toxic), -np.inf)
    logits, of = net.logits(text)
    np.maximum.at(highest, of, logits)
    x, y = highest[np.isfinite(highest)], toxic[np.isfinite(highest)]
    slope, shift = 1.0, 0.0
    for _ in range(500):
        miss = _sigmoid(slope * x + shift) - y
        slope = max(0.05, slope - 0.05 * float((miss * x).mean()))
        shift -= 0.5 * float(miss.mean())
    net.slope, net.shift = slope, shift


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> pa.Table:
    """Labelled texts for training, in a fixed order: at most `MOST_TOXIC` and `MOST_CLEAN`."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).dropna()
    known = known.groupBy("id").agg(F.max("toxic").cast("int").alias("toxic")).filter(~held_out(F.col("id")))
    mixed_up = F.xxhash64(F.col("id"), F.lit(5))
    # More than needed, since some have no text of a fitting length.
    few = [
        known.filter(F.col("toxic") == label).orderBy(mixed_up, "id").limit(2 * most)
        for label, most in ((1, MOST_TOXIC), (0, MOST_CLEAN))
    ]
    ids = F.broadcast(few[0].union(few[1]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna()
    texts = texts.filter(F.length("text").between(1, MOST_CHARACTERS)).join(ids, "id")
    # Equal texts once: thousands of copies would be one document.
    kept = texts.groupBy(F.xxhash64("text").alias("h"), "toxic").agg(F.min("id").alias("id"))
    kept = kept.orderBy(F.xxhash64(F.col("id"), F.lit(5)), "id", "h").toArrow()
    chosen = []
    for label, most in ((1, MOST_TOXIC), (0, MOST_CLEAN)):
        rows = kept.filter(pc.equal(kept["toxic"], label))
        chosen.append(rows.slice(0, most))
    wanted = pa.concat_tables(chosen)
    spark = docs.sparkSession
    wanted_ids = F.broadcast(spark.createDataFrame(wanted.select(["id"]).to_pandas(), f"id {dict(texts.dtypes)['id']}"))
    return texts.join(wanted_ids, "id", "left_semi").orderBy("id", F.xxhash64("text")).toArrow()


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """One row per document: whether it is held out, its score from 0 to 1, and the label predicted.

    Labels are learnt from documents that are not held out only, a bounded sample of them; scores rest
    on the text alone. A null text, or one without words, has the lowest score there is. Without labels of
    both kinds every score is 0. Repeated rows, and rows without an identifier (not held out), have a row
    each; of several labels of a document the highest holds; other columns are ignored.
    """
    taught = sample(docs, labels, id_col, text_col, label_col)
    marks = taught["toxic"].to_numpy().astype(np.float64)
    net = train(*text_bytes(taught["text"]), marks) if 0 < marks.sum() < len(marks) else None
    model = docs.sparkSession.sparkContext.broadcast(net)
    kind = dict(docs.dtypes)[id_col]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        for batch in batches:
            data, bounds = text_bytes(batch["text"])
            found = [np.zeros(0)]
            for first, last in portions(bounds, TEXT_PER_STEP):
                low, high = bounds[first], bounds[last]
                if net is None:
                    found.append(np.zeros(last - first))
                else:
                    found.append(net.scores(read(data[low:high], bounds[first : last + 1] - low)))
            score = np.concatenate(found)
            columns = [batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")
