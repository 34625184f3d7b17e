"""Toxicity of texts by a bidirectional gated recurrent network with attention pooling, written and trained in numpy.

A word enters as a learned vector for itself and the mean of learned vectors for its character trigrams. Two gated recurrent
units read a window of words in either direction; attention weighs their states, and the weighted mean gives the score. A
text's score is the highest over all its overlapping windows, so one passage is enough.

The network is fitted on a bounded sample of labelled rows. All rows are scored, over their whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Words in a window, and from the start of one to the next.
WINDOW, STRIDE = 64, 48
#: Rows of the word and trigram tables, width of each, width of a direction's state.
WORDS, TRIGRAMS, WIDTH, STATE = 1 << 14, 1 << 12, 8, 8
#: Bound of the training sample: rows with label 1, with label 0, and characters in all.
POSITIVE_ROWS, NEGATIVE_ROWS, SAMPLE_CHARS = 1_000, 2_000, 13_000_000
EPOCHS, BATCH, RATE, DECAY, DROPPED = 10, 96, 0.02, 0.02, 0.2
#: Texts of the sample in which a word or trigram must occur to get a vector; others stay at zero, so that a text can't be known by a word of its own.
WORD_TEXTS, TRIGRAM_TEXTS = 3, 6
#: Distinct words whose projections a worker holds at once; words read at once.
HELD, READ = 200_000, 100_000

_EDGES = ".,;:!?()[]{}\"'|«»…"


def split_words(text: str | None) -> list[str]:
    """Lower-case words without punctuation at their ends."""
    return [w.strip(_EDGES) or w for w in (text or "").lower().split()]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word its row in the word table, and its trigrams' rows with offsets."""
    rows = np.array([zlib.crc32(w.encode()) % WORDS for w in words], np.int64)
    grams, sizes = [], []
    for w in words:
        marked = f"^{w}$"
        sizes.append(max(1, len(marked) - 2))
        grams += [zlib.crc32(marked[i : i + 3].encode()) % TRIGRAMS for i in range(sizes[-1])]
    return rows, np.array(grams, np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of these numbers of words, one after the other: words of every window (places), which are there, and the text of each window.

    Windows start every ``STRIDE`` words until the text's end is covered; a text without words has one empty window.
    """
    each = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    of = np.repeat(np.arange(len(counts)), each)
    begin = np.concatenate([[0], np.cumsum(counts)])
    nth = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
    place = (begin[of] + nth * STRIDE)[:, None] + np.arange(WINDOW)
    there = place < begin[of + 1][:, None]
    return np.where(there, place, 0), there, of


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters by name, the forward pass, and gradients."""

    def __init__(self, seed: int = 1, state: int = STATE, width: int = WIDTH, words: int = WORDS, trigrams: int = TRIGRAMS, dtype=np.float32) -> None:
        r = np.random.default_rng(seed)
        small = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(dtype)
        self.state = state
        self.p = {
            "word": np.zeros((words, width), dtype),
            "gram": np.zeros((trigrams, width), dtype),
            "input": small(2 * width, 6 * state, scale=(2 * width) ** -0.5),
            "bias": np.zeros(6 * state, dtype),
            "forth": small(state, 3 * state, scale=state**-0.5),
            "back": small(state, 3 * state, scale=state**-0.5),
            "attend": small(2 * state, scale=0.3),
            "out": small(2 * state, scale=0.3),
            "offset": np.zeros(1, dtype),
        }

    def vectors(self, rows: np.ndarray, grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Input vectors of words."""
        sums = np.add.reduceat(self.p["gram"][grams], offsets[:-1], axis=0) if len(rows) else np.zeros((0, self.p["gram"].shape[1]))
        return np.hstack([self.p["word"][rows], sums / np.diff(offsets)[:, None]]).astype(self.p["word"].dtype)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """What words add to the gates of both directions; it depends on the word alone."""
        return vectors @ self.p["input"] + self.p["bias"]

    def _read(self, gates: np.ndarray, there: np.ndarray, u: np.ndarray, order: range, keep: list | None) -> np.ndarray:
        s = self.state
        h = np.zeros((len(gates), s), gates.dtype)
        states = np.zeros((len(gates), WINDOW if gates.shape[1] == WINDOW else gates.shape[1], s), gates.dtype)
        for t in order:
            x, own = gates[:, t], h @ u
            zr = _sigmoid(x[:, : 2 * s] + own[:, : 2 * s])
            z, r = zr[:, :s], zr[:, s:]
            new = np.tanh(x[:, 2 * s :] + r * own[:, 2 * s :])
            m = there[:, t, None]
            if keep is not None:
                keep.append((t, h, z, r, new, own, m))
            h = np.where(m, new + z * (h - new), h)
            states[:, t] = h
        return states

    def run(self, gates: np.ndarray, there: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Logits of windows from their words' projections."""
        s, span = self.state, range(gates.shape[1])
        steps = ([], []) if kept is not None else (None, None)
        states = np.concatenate([self._read(gates[:, :, : 3 * s], there, self.p["forth"], span, steps[0]), self._read(gates[:, :, 3 * s :], there, self.p["back"], span[::-1], steps[1])], axis=2)
        heat = np.where(there, states @ self.p["attend"], -1e9)
        weight = np.exp(heat - heat.max(axis=1, keepdims=True)) * there
        weight = weight / np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("bt,bts->bs", weight, states)
        if kept is not None:
            kept |= {"steps": steps, "states": states, "weight": weight, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["offset"][0]

    def gradients(self, rows: np.ndarray, grams: np.ndarray, offsets: np.ndarray, place: np.ndarray, there: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss of windows over distinct words (``place`` into them) and its gradients."""
        p, s = self.p, self.state
        vectors = self.vectors(rows, grams, offsets)
        gates = self.project(vectors)[place]
        kept: dict = {}
        score = _sigmoid(self.run(gates, there, kept))
        loss = float(-np.mean(np.log(np.where(label > 0, score, 1 - score) + 1e-9)))
        error = ((score - label) / len(label)).astype(gates.dtype)
        g = {"out": error @ kept["pooled"], "offset": error.sum(keepdims=True)}
        pooled = error[:, None] * p["out"]
        states, weight = kept["states"], kept["weight"]
        on_weight = np.einsum("bs,bts->bt", pooled, states)
        heat = weight * (on_weight - (weight * on_weight).sum(axis=1, keepdims=True))
        g["attend"] = np.einsum("bt,bts->s", heat, states)
        on_states = weight[:, :, None] * pooled[:, None] + heat[:, :, None] * p["attend"]
        on_gates = np.zeros_like(gates)
        for k, name in enumerate(("forth", "back")):
            u, on_u = p[name], np.zeros_like(p[name])
            on_h = np.zeros((len(label), s), gates.dtype)
            for t, h, z, r, new, own, m in reversed(kept["steps"][k]):
                on_h = on_h + on_states[:, t, k * s : (k + 1) * s]
                d = np.where(m, on_h, 0)
                on_new = d * (1 - z) * (1 - new * new)
                on_z = d * (h - new) * z * (1 - z)
                on_r = on_new * own[:, 2 * s :] * r * (1 - r)
                own_side = np.hstack([on_z, on_r, on_new * r])
                on_gates[:, t, 3 * s * k : 3 * s * (k + 1)] = np.hstack([on_z, on_r, on_new])
                on_u += h.T @ own_side
                on_h = np.where(m, d * z, on_h) + own_side @ u.T
            g[name] = on_u
        flat = on_gates.reshape(-1, 6 * s)
        on_words = np.zeros((len(rows), 6 * s), gates.dtype)
        for k in range(6 * s):
            on_words[:, k] = np.bincount(place.ravel(), flat[:, k], len(rows))
        g["input"], g["bias"] = vectors.T @ on_words, on_words.sum(axis=0)
        on_vectors = on_words @ p["input"].T
        width = p["word"].shape[1]
        on_grams = np.repeat(on_vectors[:, width:] / np.diff(offsets)[:, None], np.diff(offsets), axis=0)
        g["word"] = np.stack([np.bincount(rows, on_vectors[:, k], len(p["word"])) for k in range(width)], axis=1).astype(gates.dtype)
        g["gram"] = np.stack([np.bincount(grams, on_grams[:, k], len(p["gram"])) for k in range(width)], axis=1).astype(gates.dtype)
        return loss, g


def train(texts: list[list[str]], labels: np.ndarray, seed: int = 1) -> Network:
    """Fits a network on texts (words) with labels 0 and 1.

    In the first epochs random windows carry their text's label, afterwards the one with the highest score does (a text is
    toxic if any window is) besides a random one of the texts labelled 0. Words are left out at random, and tables decay. At the end the offset is moved so that 0.5 parts
    the texts best.
    """
    net, r = Network(seed), np.random.default_rng(seed)
    if not len(texts) or labels.min() == labels.max():
        net.p["offset"][:] = 3.0 if len(texts) and labels.max() else -3.0
        return net
    numbers: dict[str, int] = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t] or [0], np.int64)
    known = features(list(numbers) or [""])
    spread = {"word": np.zeros(WORDS, np.int64), "gram": np.zeros(TRIGRAMS, np.int64)}
    for t in texts:
        own = np.unique([numbers[w] for w in t]).astype(np.int64)
        sizes = known[2][own + 1] - known[2][own]
        spread["word"][np.unique(known[0][own])] += 1
        spread["gram"][np.unique(known[1][np.repeat(known[2][own] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())])] += 1
    learnt = {"word": (spread["word"] >= WORD_TEXTS)[:, None], "gram": (spread["gram"] >= TRIGRAM_TEXTS)[:, None]}
    place, there, of = windows(np.array([len(t) for t in texts]))
    first = np.searchsorted(of, np.arange(len(texts)))
    each = np.diff(np.append(first, len(of)))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0

    def scores() -> np.ndarray:
        gates = net.project(net.vectors(*known))
        return np.concatenate([net.run(gates[words[place[a : a + 2048]]], there[a : a + 2048]) for a in range(0, len(of), 2048)])

    for epoch in range(EPOCHS):
        drawn = first + (r.random(len(texts)) * each).astype(np.int64)
        if epoch < 2:
            chosen = np.concatenate([drawn, first + (r.random(len(texts)) * each).astype(np.int64)])
        else:
            now = scores()
            top = np.maximum.reduceat(now, first)
            best = np.array([a + int(np.argmax(now[a : a + n])) for a, n in zip(first.tolist(), each.tolist())])
            chosen = np.concatenate([best, drawn[labels == 0], best[(labels == 1) & (top < 0)]])
        r.shuffle(chosen)
        for a in range(0, len(chosen), BATCH):
            part = chosen[a : a + BATCH]
            own, inverse = np.unique(words[place[part]], return_inverse=True)
            sizes = known[2][own + 1] - known[2][own]
            grams = np.repeat(known[2][own] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            _, g = net.gradients(known[0][own], known[1][grams], np.concatenate([[0], np.cumsum(sizes)]), inverse.reshape(len(part), -1), there[part] & (r.random(there[part].shape) >= DROPPED), labels[of[part]].astype(np.float32))
            step += 1
            for k, v in net.p.items():
                m, s = moment[k]
                if k in learnt:
                    g[k] = g[k] * learnt[k]
                    v *= 1 - RATE * DECAY
                m += 0.1 * (g[k] - m)
                s += 0.001 * (g[k] * g[k] - s)
                v -= (RATE * (1 - epoch / (EPOCHS + 2)) / (1 - 0.9**step)) * m / (np.sqrt(s / (1 - 0.999**step)) + 1e-7)
    top = np.maximum.reduceat(scores(), first)
    order = np.argsort(top, kind="stable")
    right = np.concatenate([[0], np.cumsum(np.where(labels[order] == 0, 1, -1))])  # with a cut after so many
    cuts = np.flatnonzero(right == right.max())
    cut = int(cuts[len(cuts) // 2])
    edges = np.concatenate([[top[order[0]] - 1], top[order], [top[order[-1]] + 1]])
    net.p["offset"] -= np.float32((edges[cut] + edges[cut + 1]) / 2)
    return net


def sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str) -> tuple[list[list[str]], np.ndarray]:
    """Texts and labels of the training sample: rows of ``labels`` in order of a hash of their key, up to the documented bounds.

    A key that is labelled several times counts as 1 if any label is; of several texts with one key the longest is taken.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(F.col(label).cast("int")).alias("marked"))
    order = F.xxhash64(F.col(key), F.lit("sample"))
    bound = lambda value, n: marked.where(F.col("marked") == value).orderBy(order).limit(n)
    chosen = stored(bound(1, POSITIVE_ROWS).union(bound(0, NEGATIVE_ROWS)), "labelled")
    mine = docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("body")).join(F.broadcast(chosen), key)
    # lengths first, so that no more text than the bound is ever gathered
    sizes = mine.groupBy(key, "marked").agg(F.max(F.length("body")).alias("n"))
    upto = F.sum("n").over(Window.orderBy(order, F.col(key)))
    within = stored(sizes.withColumn("upto", upto).where(F.col("upto") <= SAMPLE_CHARS).select(key, "marked"), "sampled")
    rows = mine.drop("marked").join(F.broadcast(within), key).groupBy(key, "marked").agg(F.max(F.struct(F.length("body").alias("n"), "body"))["body"].alias("body")).toArrow()
    found = sorted((zlib.crc32(str(k).encode()), k, t, m) for k, t, m in zip(*(rows[c].to_pylist() for c in (key, "body", "marked"))))
    return [split_words(t) for _, _, t, _ in found], np.array([m for *_, m in found], np.int64)


def score(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` for every row; nothing but the text decides it. No shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(net)
    kept = docs.select(key, text)
    schema = kept.limit(0).selectExpr(f"`{key}`", "0D score").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held.value
        numbers: dict[str, int] = {}
        known = np.zeros((0, 6 * net.state), np.float32)

        def scored(texts: list[list[str]]) -> np.ndarray:
            nonlocal known
            if len(numbers) > HELD:
                numbers.clear()
                known = known[:0]
            fresh = list(dict.fromkeys(w for t in texts for w in t if w not in numbers))
            if fresh:
                numbers.update(zip(fresh, range(len(numbers), len(numbers) + len(fresh))))
                known = np.concatenate([known, net.project(net.vectors(*features(fresh)))])
            words = np.array([numbers[w] for t in texts for w in t] or [0], np.int64)
            place, there, of = windows(np.array([len(t) for t in texts]))
            gates = known if len(known) else np.zeros((1, 6 * net.state), np.float32)
            logits = np.concatenate([net.run(gates[words[place[a : a + 2048]]], there[a : a + 2048]) for a in range(0, len(of), 2048)])
            return _sigmoid(np.maximum.reduceat(logits, np.searchsorted(of, np.arange(len(texts)))).astype(np.float64))

        for batch in batches:
            texts, total, done = [], 0, []
            for t in batch.column(1).to_pylist():
                texts.append(split_words(t))
                total += len(texts[-1])
                if total > READ:
                    done.append(scored(texts))
                    texts, total = [], 0
            if texts:
                done.append(scored(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(done) if done else np.zeros(0))], names=[key, "score"])

    return kept.mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key, held_out, score, predicted``. Labels are learnt from rows that aren't held out alone.

    Null and empty texts get the score of an empty window. Null keys aren't held out (and have no label). Repeated rows are
    scored alike; an empty table gives an empty result; without labels of both kinds every score is the same, below 0.5
    unless all labels are 1. Other columns are ignored.
    """
    net = train(*sample(docs, labels.where(~held_out(key)), label, key, text))
    return score(docs, net, key, text).select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
