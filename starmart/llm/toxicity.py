"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters as a word embedding, the mean embedding of its character
n-grams, and the evidence that the labelled rows hold for the word and for its
n-grams. The network reads windows of words in both directions, pools them by
attention and gives a logit; a document's windows overlap and cover all of it,
and its highest logit, calibrated for the number of windows, is its score.
Everything is trained here in numpy on a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import text_or_empty

WORD = re.compile(r"\w+")
PRIME = np.uint64(0x9E3779B97F4A7C15)
GRAMS = (3, 4, 5)
EVIDENCE_BITS, WORD_BITS, GRAM_BITS = 20, 14, 15


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * PRIME
    return h ^ (h >> np.uint64(29))


def word_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word; hashes of its character n-grams, words marked at both
    ends, and for each of those the word's index (ascending)."""
    marked = [f"<{w}>" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    code = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    left = np.repeat(starts + lengths, lengths) - np.arange(len(code))  # characters to the word's end
    row = np.repeat(np.arange(len(marked)), lengths)
    at = np.arange(len(code)) - np.repeat(starts, lengths)
    whole = _mix(np.add.reduceat(_mix(code * PRIME + at.astype(np.uint64)), starts))
    rows, grams = [], []
    for n in GRAMS:
        first = np.flatnonzero(left >= n)
        h = np.full(len(first), n, np.uint64)
        for j in range(n):
            h = h * PRIME + code[first + j]
        rows.append(row[first])
        grams.append(_mix(h))
    row, gram = np.concatenate(rows), np.concatenate(grams)
    order = np.argsort(row, kind="stable")
    return whole, gram[order], row[order]


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def evidence_table(docs: Iterable[list[str]], labels: Iterable[int]) -> np.ndarray:
    """Per hash bucket of words and n-grams: signed root of the likelihood ratio
    of its document counts under the two labels, with chance-size values at 0."""
    counts = np.zeros((2, 1 << EVIDENCE_BITS), np.float32)
    n = np.zeros(2)
    for words, label in zip(docs, labels):
        n[label] += 1
        whole, gram, _ = word_hashes(words)
        counts[label, np.unique(_bucket(np.concatenate((whole, gram)), EVIDENCE_BITS))] += 1
    held = np.flatnonzero(counts.any(axis=0))
    k = counts[:, held].astype(np.float64)
    share = k.sum(axis=0) / max(1.0, n.sum())

    def part(k: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    g = sum(part(k[c], n[c] * share) + part(n[c] - k[c], n[c] * (1 - share)) for c in (0, 1))
    z = np.sqrt(np.maximum(2 * g, 0)) * np.sign(k[1] * n[0] - k[0] * n[1])
    out = np.zeros(1 << EVIDENCE_BITS, np.float32)
    out[held] = np.sign(z) * np.clip(np.abs(z) - 2.5, 0, 6) / 2
    return out


@dataclass
class Shape:
    """Sizes of the network and of its training; all fixed by the caller."""
    window: int = 32
    stride: int = 16
    hidden: int = 8
    embed: int = 6
    attention: int = 8
    steps: int = 300
    batch: int = 256
    rate: float = 0.01
    seed: int = 0


@dataclass
class Net:
    """The network's parameters and passes."""
    shape: Shape
    evidence: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)
    calibration: tuple[float, float, float] = (1.0, 0.0, 0.0)  # of logit, log windows, constant

    def __post_init__(self):
        if not self.p:
            s, rng = self.shape, np.random.default_rng(self.shape.seed)
            d = 2 * s.embed + 3
            def draw(*size, scale=None):
                return (rng.standard_normal(size) * (scale or size[0] ** -0.5)).astype(np.float32)
            self.p = {"word": draw(1 << WORD_BITS, s.embed, scale=0.1), "gram": draw(1 << GRAM_BITS, s.embed, scale=0.1),
                      "wa": draw(2 * s.hidden, s.attention), "ba": np.zeros(s.attention, np.float32),
                      "va": draw(s.attention), "wo": draw(2 * s.hidden), "bo": np.zeros(1, np.float32)}
            for side in "fb":
                self.p |= {f"wx{side}": draw(d, 3 * s.hidden), f"wh{side}": draw(s.hidden, 3 * s.hidden),
                           f"b{side}": np.zeros(3 * s.hidden, np.float32)}

    # inputs

    def inputs(self, words: list[str]) -> tuple[np.ndarray, dict]:
        """One input row per word, and what its backward pass needs."""
        whole, gram, row = word_hashes(words)
        starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))  # every word has an n-gram
        count = np.diff(np.append(starts, len(row)))[:, None].astype(np.float32)
        at = {"word": _bucket(_mix(whole), WORD_BITS), "gram": _bucket(_mix(gram), GRAM_BITS), "row": row, "count": count}
        ev = self.evidence[_bucket(gram, EVIDENCE_BITS)]
        mean = np.add.reduceat(self.p["gram"][at["gram"]], starts) / count
        x = np.concatenate([self.p["word"][at["word"]], mean, self.evidence[_bucket(whole, EVIDENCE_BITS)][:, None],
                            np.maximum.reduceat(ev, starts)[:, None], np.add.reduceat(ev, starts)[:, None] / count], axis=1)
        return x.astype(np.float32), at

    def features(self, words: list[str], block: int = 20_000) -> np.ndarray:
        """The input rows alone, a block of words at a time."""
        return np.concatenate([self.inputs(words[i:i + block])[0] for i in range(0, len(words), block)])

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What each direction's gates get from each word."""
        return {s: x @ self.p[f"wx{s}"] + self.p[f"b{s}"] for s in "fb"}

    # passes

    @staticmethod
    def _sigmoid(a: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(a, -30, 30)))

    def _run(self, proj: np.ndarray, index: np.ndarray, mask: np.ndarray | None, side: str, tape: list | None):
        """Hidden states (T, N, H) of one direction; ``proj`` has the words'
        input projections, ``index`` (N, T) the windows' words."""
        n, t_max, hid = len(index), index.shape[1], self.shape.hidden
        wh = self.p[f"wh{side}"]
        h = np.zeros((n, hid), np.float32)
        out = np.empty((t_max, n, hid), np.float32)
        for t in range(t_max) if side == "f" else range(t_max - 1, -1, -1):
            x, u = proj[index[:, t]], h @ wh
            gates = self._sigmoid(x[:, :2 * hid] + u[:, :2 * hid])
            z, r = gates[:, :hid], gates[:, hid:]
            new = np.tanh(x[:, 2 * hid:] + r * u[:, 2 * hid:])
            nxt = new + z * (h - new)
            if mask is not None:
                nxt = np.where(mask[:, t, None], nxt, h)
            if tape is not None:
                tape.append((t, h, z, r, new, u))
            out[t] = h = nxt
        return out

    def forward(self, proj: dict, index: np.ndarray, mask: np.ndarray | None = None, tape: dict | None = None) -> np.ndarray:
        """Logit of each window. ``index`` (N, T) has rows of ``project(x)``."""
        p = self.p
        tapes = {"f": [], "b": []} if tape is not None else {"f": None, "b": None}
        states = np.concatenate([self._run(proj[s], index, mask, s, tapes[s]) for s in "fb"], axis=2)
        a = np.tanh(states @ p["wa"] + p["ba"])
        e = a @ p["va"]
        if mask is not None:
            e = np.where(mask.T, e, -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", w, states)
        if tape is not None:
            tape |= {"tapes": tapes, "states": states, "a": a, "w": w, "pooled": pooled}
        return pooled @ p["wo"] + p["bo"][0]

    def backward(self, x, at, index, mask, tape, d_logit) -> dict[str, np.ndarray]:
        """Gradients of all parameters for ``d_logit``, the loss's by logit."""
        p, hid, g = self.p, self.shape.hidden, {}
        states, a, w, pooled = (tape[k] for k in ("states", "a", "w", "pooled"))
        g["wo"], g["bo"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * p["wo"]
        d_w = np.einsum("nh,tnh->tn", d_pooled, states)
        d_e = w * (d_w - (w * d_w).sum(axis=0))
        g["va"] = np.einsum("tn,tna->a", d_e, a)
        d_a = d_e[:, :, None] * p["va"] * (1 - a * a)
        g["wa"], g["ba"] = np.einsum("tnh,tna->ha", states, d_a), d_a.sum(axis=(0, 1))
        d_states = w[:, :, None] * d_pooled + d_a @ p["wa"].T
        d_x = np.zeros_like(x)
        for k, side in enumerate("fb"):
            d_out = d_states[:, :, k * hid:(k + 1) * hid]
            wh = p[f"wh{side}"]
            d_proj, g_wh, d_h = np.zeros((len(x), 3 * hid), np.float32), np.zeros_like(wh), 0
            for t, h, z, r, new, u in reversed(tape["tapes"][side]):
                d_next = d_out[t] + d_h
                passed = 0
                if mask is not None:
                    passed = np.where(mask[:, t, None], 0, d_next)
                    d_next = np.where(mask[:, t, None], d_next, 0)
                d_new = d_next * (1 - z) * (1 - new * new)
                d_z = d_next * (h - new) * z * (1 - z)
                d_r = d_new * u[:, 2 * hid:] * r * (1 - r)
                d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g_wh += h.T @ d_u
                np.add.at(d_proj, index[:, t], np.concatenate([d_z, d_r, d_new], axis=1))
                d_h = d_next * z + d_u @ wh.T + passed
            g[f"wh{side}"], g[f"wx{side}"], g[f"b{side}"] = g_wh, x.T @ d_proj, d_proj.sum(axis=0)
            d_x += d_proj @ p[f"wx{side}"].T
        m = self.shape.embed
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], at["word"], d_x[:, :m])
        np.add.at(g["gram"], at["gram"], (d_x[:, m:2 * m] / at["count"])[at["row"]])
        return g

    # windows and documents

    def windows(self, n_words: int) -> np.ndarray:
        """Starts of the overlapping windows that cover ``n_words`` words."""
        size, stride = self.shape.window, self.shape.stride
        if n_words <= size:
            return np.zeros(1, np.int64)
        return np.append(np.arange(0, n_words - size, stride), n_words - size)

    def window_logits(self, docs: list[np.ndarray], x: np.ndarray, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all windows of documents given as rows of ``x`` (none of
        them empty), and the number of windows of each document."""
        starts = [self.windows(len(d)) for d in docs]
        per_doc = np.fromiter(map(len, starts), np.int64, len(starts))
        offset = np.cumsum([0, *map(len, docs)])
        flat, proj = np.concatenate(docs), self.project(x)
        first = np.concatenate([s + o for s, o in zip(starts, offset)])
        length = np.repeat(np.minimum(np.fromiter(map(len, docs), np.int64, len(docs)), self.shape.window), per_doc)
        out, steps = np.empty(len(first), np.float32), np.arange(self.shape.window)
        for rows in (np.flatnonzero(length == self.shape.window), np.flatnonzero(length < self.shape.window)):
            for i in range(0, len(rows), block):
                part = rows[i:i + block]
                mask = steps < length[part, None]
                at = np.minimum(first[part, None] + steps, len(flat) - 1)
                out[part] = self.forward(proj, flat[at], None if mask.all() else mask)
        return out, per_doc

    def document_scores(self, top: np.ndarray, n_windows: np.ndarray) -> np.ndarray:
        a, b, c = self.calibration
        return self._sigmoid(a * top.astype(np.float64) + b * np.log(n_windows) + c)


def _indexed(texts: Iterable[str]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct words, and each text's words as indices of them."""
    place: dict[str, int] = {}
    out = []
    for text in texts:
        words = words_of(text)
        out.append(np.fromiter((place.setdefault(w, len(place)) for w in words), np.int32, len(words)))
    return list(place), out


def _tops(logits: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    return np.maximum.reduceat(logits, np.concatenate(([0], np.cumsum(per_doc)[:-1])))


def train(texts: list[str], labels: list[int], shape: Shape | None = None) -> Net | None:
    """Fit a network; None if the rows do not hold both labels.

    A toxic document's label need not hold for all its windows: its window of
    most evidence counts as toxic, and after half the steps the one the network
    scores highest. Of the others the highest-scored windows and random ones
    count as clean. A quarter of the rows is kept back to calibrate on.
    """
    shape = shape or Shape()
    vocabulary, found = _indexed(texts)
    rng = np.random.default_rng(shape.seed)
    order = rng.permutation([k for k, d in enumerate(found) if len(d)]).astype(int).tolist()
    by_label = {y: [k for k in order if labels[k] == y] for y in (0, 1)}
    if not (by_label[0] and by_label[1]):
        return None
    back = [k for y in (0, 1) for k in by_label[y][:len(by_label[y]) // 4]]
    rows = [k for y in (0, 1) for k in by_label[y][len(by_label[y]) // 4:]]
    docs, y = [found[k] for k in rows], np.array([labels[k] for k in rows])
    net = Net(shape, evidence_table(([vocabulary[w] for w in np.unique(d)] for d in docs), y))
    x = net.features(vocabulary)
    strength = x[:, -2] + x[:, -3]  # evidence of word and n-grams
    starts = [net.windows(len(d)) for d in docs]
    per_doc = np.fromiter(map(len, starts), np.int64, len(starts))
    owner = np.repeat(np.arange(len(docs)), per_doc)
    first = np.concatenate(starts)
    sums = [np.concatenate(([0], np.cumsum(strength[d]))) for d in docs]
    scores = np.array([sums[k][min(f + shape.window, len(docs[k]))] - sums[k][f] for k, f in zip(owner, first)])
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    pad = np.zeros(shape.window, np.int64)
    for step in range(shape.steps):
        if step in (0, shape.steps // 2, shape.steps * 3 // 4):
            if step:
                scores, _ = net.window_logits(docs, net.features(vocabulary))
            order = np.lexsort((-scores, owner))
            best = order[np.concatenate(([0], np.cumsum(per_doc)[:-1]))]  # each document's top window
            positive = best[y == 1]
            hard = best[y == 0]
            clean = np.flatnonzero(y[owner] == 0)
        half = shape.batch // 2
        picked = np.concatenate([rng.choice(positive, half), rng.choice(hard, half // 2), rng.choice(clean, half - half // 2)])
        target = (np.arange(len(picked)) < half).astype(np.float32)
        index, mask = np.empty((len(picked), shape.window), np.int64), np.zeros((len(picked), shape.window), bool)
        for k, wdw in enumerate(picked):
            part = docs[owner[wdw]][first[wdw]:first[wdw] + shape.window]
            index[k], mask[k, :len(part)] = np.concatenate([part, pad[len(part):]]), True
        used, inverse = np.unique(index, return_inverse=True)
        index = inverse.reshape(index.shape)
        xb, at = net.inputs([vocabulary[k] for k in used])
        tape: dict = {}
        logit = net.forward(net.project(xb), index, mask, tape)
        g = net.backward(xb, at, index, mask, tape, ((net._sigmoid(logit) - target) / len(picked)).astype(np.float32))
        for k, v in net.p.items():  # Adam
            m1, m2 = moments[k]
            m1 += 0.1 * (g[k] - m1)
            m2 += 0.001 * (g[k] * g[k] - m2)
            v -= shape.rate * (m1 / (1 - 0.9 ** (step + 1))) / (np.sqrt(m2 / (1 - 0.999 ** (step + 1))) + 1e-8)
    if not any(labels[k] for k in back):
        back = rows
    _calibrate(net, net.features(vocabulary), [found[k] for k in back], np.array([labels[k] for k in back], np.float64))
    return net


def _calibrate(net: Net, x: np.ndarray, docs: list[np.ndarray], y: np.ndarray) -> None:
    """Logistic fit of a document's label to its top logit and window count."""
    logits, per_doc = net.window_logits(docs, x)
    f = np.stack([_tops(logits, per_doc), np.log(per_doc), np.ones(len(docs))], axis=1).astype(np.float64)
    prior = np.array([1.0, 0.0, 0.0])

    def loss(w: np.ndarray) -> float:  # with a pull to the plain logit
        m = f @ w
        return float(np.logaddexp(0, m).sum() - y @ m + 0.5 * ((w - prior) ** 2).sum())

    weight = prior
    for _ in range(50):  # Newton steps, halved until the loss falls
        q = net._sigmoid(f @ weight)
        grad = f.T @ (q - y) + (weight - prior)
        step = np.linalg.solve((f * (q * (1 - q))[:, None]).T @ f + np.eye(3), grad)
        while loss(weight - step) > loss(weight) and np.abs(step).max() > 1e-9:
            step = step / 2
        weight = weight - step
    net.calibration = tuple(map(float, weight))


class Scorer:
    """Scores texts with a trained network; a block of words at a time."""

    def __init__(self, net: Net, block_chars: int = 1 << 20):
        self.net, self.block_chars = net, block_chars

    def scores(self, texts: Iterable[str]) -> list[float]:
        """Score per text; 0 for a text without words."""
        out: list[float] = []
        held: list[tuple[int, str]] = []
        chars = 0

        def settle() -> None:
            nonlocal chars
            vocabulary, found = _indexed(t for _, t in held)
            full = [i for i, d in enumerate(found) if len(d)]
            if full:
                logits, per_doc = self.net.window_logits([found[i] for i in full], self.net.features(vocabulary))
                for i, s in zip(full, self.net.document_scores(_tops(logits, per_doc), per_doc)):
                    out[held[i][0]] = float(s)
            held.clear()
            chars = 0

        for k, text in enumerate(texts):
            out.append(0.0)
            held.append((k, text))
            chars += len(text)
            if chars >= self.block_chars:
                settle()
        settle()
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, max_toxic: int = 1500, max_clean: int = 4500,
                    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                    seed: int = 0, max_chars: int = 32_768) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``max_toxic`` + ``max_clean`` labelled rows
    outside the held-out fifth, picked by a seeded hash of the id. Ids are picked
    from the labels alone. Of rows that share a picked id one is taken (the least
    hash of the text), and of a text longer than ``max_chars`` a part of that
    length from a seeded place, so what reaches the driver is bounded whatever
    the table holds. Only the sample is cut: scoring reads whole texts."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & (_remainder(F.col("id")) != 0))
             .groupBy("id").agg(F.max("label").alias("label")))
    draw = F.xxhash64("id", F.lit(seed))
    picked = [r for label, most in ((1, max_toxic), (0, max_clean))
              for r in known.where(F.col("label") == label).orderBy(draw, "id").limit(most).collect()]
    if not picked:
        return [], []
    table = docs.sparkSession.createDataFrame(picked, known.schema)  # bounded, so it may be broadcast
    beyond = F.length("text") - max_chars
    part = F.when(beyond <= 0, F.col("text")).otherwise(F.substring(
        F.col("text"), (F.pmod(draw, F.greatest(beyond, F.lit(1))) + 1).cast("int"), F.lit(max_chars)))
    # one row an id, chosen in the tasks before the shuffle
    rows = (docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
            .join(F.broadcast(table), "id").select("id", "label", F.xxhash64("text").alias("h"), part.alias("text"))
            .groupBy("id", "label").agg(F.min(F.struct("h", "text")).alias("one"))
            .select("id", "one.text", "label").collect())
    rows.sort(key=lambda r: (r["id"], r["text"]))
    return [r["text"] for r in rows], [r["label"] for r in rows]


def _remainder(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 5


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", max_toxic: int = 1500, max_clean: int = 4500,
                   shape: Shape | None = None) -> DataFrame:
    """One row per input row: ``id_col``, ``held_out``, ``score``, ``predicted``.

    Learns from at most ``max_toxic`` and ``max_clean`` labelled rows (one an id,
    see ``labelled_sample``) whose crc32(id as text) mod 5 is not 0 and scores
    every text by its words alone.
    Null and wordless texts score 0. A null id counts as the empty text. If the
    labels do not hold both classes, every text scores 0.
    """
    net = train(*labelled_sample(docs, labels, max_toxic, max_clean, id_col, text_col, label_col), shape)
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of a size fixed by Shape and the hash tables
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value) if shared.value is not None else None
        for batch in batches:
            found = scorer.scores(batch["text"]) if scorer else [0.0] * len(batch)
            yield pd.DataFrame({"id": batch["id"].array, "score": np.array(found, dtype=np.float64)})

    return source.mapInPandas(score, schema).select(
        F.col("id").alias(id_col), (_remainder(F.col("id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
