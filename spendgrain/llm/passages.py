"""Quality classifier: multiple-instance learning with gated attention.

A text is a bag of passages of PASSAGE bytes. Each passage is encoded: shares of kinds of characters, how far its words and lines
repeat, and a hashed bag of its words, through one layer. Only documents have labels; which passages decide is
learned with them: an attention network with a gate weighs the passages of a text, and its score comes from their
weighted mean.

Learning takes a bounded sample: at most `sample` labels, those with the smallest hashes of their ids, and for learning at most `most` passages of
each of their texts, evenly spaced, encoded where the texts lie; the network is then fitted to these on the driver. Scoring encodes every passage
of every text. Sums over passages are kept as they come, so a text may be of any length.

Defined results: a NULL or empty text is one empty passage and has the score of that. Without labels every score is 0.5, and with one kind of label it is
that label's share. Labels other than 0 and 1 and labels of no document are not used; repeated ones count each time. Texts are scored one by one,
so repeated rows and ids don't matter; an empty table gives no rows. Other columns pass through `score`, except score and predicted, which it replaces.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrain.llm.common import ship

ship(__name__)

PASSAGE, BUCKETS, HIDDEN, GATES = 512, 96, 24, 12
SAMPLE, MOST, EPOCHS, RATE, DECAY = 4_000, 48, 40, 0.01, 1e-4
#: Passages encoded at a time.
BLOCK = 4096
THRESHOLD = 0.3

_KINDS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\x0b\x0c", b".", b",;:", b"!?", b"#*$%&", b"|<>", b"()[]{}\"'", b"/\\_=+-@~^`"]
_KIND = np.full(256, len(_KINDS), np.uint8)
_KIND[128:] = len(_KINDS) + 1
for _number, _bytes in enumerate(_KINDS):
    _KIND[list(_bytes)] = _number
N_KINDS = len(_KINDS) + 2
N_INPUTS = N_KINDS + 9 + BUCKETS


def encode(passages: list[bytes]) -> np.ndarray:
    """One row of N_INPUTS numbers for each passage."""
    out = np.zeros((len(passages), N_INPUTS), np.float32)
    sizes = np.array([len(p) for p in passages], np.int64)
    kinds = _KIND[np.frombuffer(b"".join(passages), np.uint8)].astype(np.int64)
    owner = np.repeat(np.arange(len(passages)), sizes)
    out[:, :N_KINDS] = np.bincount(owner * N_KINDS + kinds, minlength=len(passages) * N_KINDS).reshape(-1, N_KINDS) / np.maximum(sizes, 1)[:, None]
    for row, passage in enumerate(passages):
        words = passage.split()
        n = len(words) or 1
        seen, lines = Counter(words), passage.split(b"\n")
        pairs = len(set(zip(words, words[1:], strict=False)))
        capital = sum(w[:1].isupper() for w in words)
        ended = sum(w[-1:] in b".!?" for w in words)
        whole = sum(w.isupper() for w in words)
        out[row, N_KINDS : N_KINDS + 9] = (
            len(passage) / PASSAGE, np.log1p(len(words)), len(seen) / n, pairs / n, max(seen.values(), default=0) / n,
            len(set(lines)) / len(lines), capital / n, ended / n, whole / n,
        )
        for word, times in seen.items():
            out[row, N_KINDS + 9 + zlib.crc32(word.lower()) % BUCKETS] += times
        out[row, N_KINDS + 9 :] /= n
    return out


def passages_of(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return [raw[at : at + PASSAGE] for at in range(0, max(len(raw), 1), PASSAGE)]


class Network:
    """Encoder, gated attention and output. `forward` and `gradient` are over bags: rows x of passages, owner of each row."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 13) -> None:
        r = np.random.default_rng(seed)
        self.mean, self.spread = mean, spread
        n = len(mean)
        self.weights = {
            "encode": r.normal(0, n**-0.5, (n, HIDDEN)), "encode_0": np.zeros(HIDDEN),
            "attend": r.normal(0, HIDDEN**-0.5, (HIDDEN, GATES)), "gate": r.normal(0, HIDDEN**-0.5, (HIDDEN, GATES)),
            "weigh": r.normal(0, GATES**-0.5, GATES), "out": r.normal(0, HIDDEN**-0.5, HIDDEN), "out_0": np.zeros(1),
        }

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Hidden vector, attention, gate and weight of each passage. Weights are bounded by the sum of |weigh|, so exp can't overflow."""
        w = self.weights
        hidden = np.tanh((x - self.mean) / self.spread @ w["encode"] + w["encode_0"])
        attend, gate = np.tanh(hidden @ w["attend"]), 1 / (1 + np.exp(-hidden @ w["gate"]))
        return hidden, attend, gate, np.exp((attend * gate) @ w["weigh"])

    def finish(self, total: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Scores of bags from the weighted sums of their hidden vectors."""
        return 1 / (1 + np.exp(-(total / weight[:, None] @ self.weights["out"] + self.weights["out_0"])))

    def gradient(self, x: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean log loss over bags, and how it changes with each weight. owner counts up from 0."""
        w, n = self.weights, len(labels)
        starts = np.searchsorted(owner, np.arange(n))
        scaled = (x - self.mean) / self.spread
        hidden, attend, gate, force = self.parts(x)
        weight = np.add.reduceat(force, starts)
        share = force / weight[owner]
        mean = np.add.reduceat(hidden * share[:, None], starts)
        score = self.finish(mean, np.ones(n))
        loss = -np.mean(np.log(np.where(labels == 1, score, 1 - score) + 1e-12))
        wrong = (score - labels) / n
        to_hidden = wrong[owner, None] * w["out"]
        pull = share * ((hidden - mean[owner]) * to_hidden).sum(axis=1)  # by the log of each weight
        to_gated = pull[:, None] * w["weigh"]
        to_attend, to_gate = to_gated * gate * (1 - attend**2), to_gated * attend * gate * (1 - gate)
        back = (share[:, None] * to_hidden + to_attend @ w["attend"].T + to_gate @ w["gate"].T) * (1 - hidden**2)
        return loss, {
            "encode": scaled.T @ back, "encode_0": back.sum(axis=0), "attend": hidden.T @ to_attend, "gate": hidden.T @ to_gate,
            "weigh": (pull[:, None] * attend * gate).sum(axis=0), "out": mean.T @ wrong, "out_0": wrong.sum(keepdims=True),
        }

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, size: int = 128, seed: int = 13) -> None:
        """Adam on the log loss, with a rate that falls to zero and a little weight decay."""
        r, first, second, step = np.random.default_rng(seed), {}, {}, 0
        steps = epochs * -(-len(bags) // size)
        for _ in range(epochs):
            order = r.permutation(len(bags))
            for at in range(0, len(bags), size):
                some = order[at : at + size]
                owner = np.repeat(np.arange(len(some)), [len(bags[i]) for i in some])
                _, slope = self.gradient(np.concatenate([bags[i] for i in some]), owner, labels[some])
                step += 1
                rate = RATE * (1 - (step - 1) / steps)
                for name, g in slope.items():
                    g = g + DECAY * self.weights[name]
                    first[name] = 0.9 * first.get(name, 0) + 0.1 * g
                    second[name] = 0.999 * second.get(name, 0) + 0.001 * g * g
                    change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] = self.weights[name] - rate * change

    def score(self, texts: list[str | None]) -> np.ndarray:
        total, weight = np.zeros((len(texts), HIDDEN)), np.zeros(len(texts))
        held: list[bytes] = []
        owners: list[int] = []

        def add():
            hidden, _, _, force = self.parts(encode(held))
            np.add.at(total, owners, hidden * force[:, None])
            np.add.at(weight, owners, force)
            held.clear()
            owners.clear()

        for number, text in enumerate(texts):
            for passage in passages_of(text):
                held.append(passage)
                owners.append(number)
                if len(held) == BLOCK:
                    add()
        if held:
            add()
        return self.finish(total, weight)


class Constant:
    """The same score for every text."""

    def __init__(self, value: float) -> None:
        self.value = value

    def score(self, texts: list[str | None]) -> np.ndarray:
        return np.full(len(texts), self.value)


def labelled_bags(documents: DataFrame, labels: DataFrame, sample: int, most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The encoded passages of labelled documents, and their labels. The chosen labels go to the texts, which stay where they are."""
    kept = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    by_hash = (F.xxhash64("doc_id"), "doc_id", "quality")
    chosen = F.broadcast(kept.orderBy(*by_hash).limit(sample))
    rows = documents.select("doc_id", "text").join(chosen, "doc_id")

    def encoded(batches):
        for batch in batches:
            out = []
            for text in batch["text"]:
                passages = passages_of(text)
                out.append(encode([passages[i] for i in sorted(set(np.linspace(0, len(passages) - 1, most).astype(int).tolist()))]).tobytes())
            yield pd.DataFrame({"hash": batch["hash"], "quality": batch["quality"], "bag": out})

    bags = rows.select(F.xxhash64("doc_id", "text").alias("hash"), "quality", "text").mapInPandas(encoded, "hash long, quality int, bag binary")
    # Ids may repeat among the documents.
    found = bags.orderBy("hash", "quality").limit(sample).collect()
    return [np.frombuffer(r.bag, np.float32).reshape(-1, N_INPUTS) for r in found], np.array([r.quality for r in found])


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = MOST) -> Network | Constant:
    """documents: doc_id, text; labels: doc_id, quality (0 or 1)."""
    bags, known = labelled_bags(documents, labels, sample, most)
    if len(set(known.tolist())) < 2:
        return Constant(float(known.mean()) if len(known) else 0.5)
    every = np.concatenate(bags)
    network = Network(every.mean(axis=0).astype(float), every.std(axis=0) + 1e-3)
    network.fit(bags, known)
    return network


def score(documents: DataFrame, model: Network | Constant, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with score, 0 to 1, and predicted: 1 where it is `threshold` or more, else 0."""
    # Plain arrays are broadcast; the class goes with the function.
    shared, kind = documents.sparkSession.sparkContext.broadcast(vars(model)), type(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = kind.__new__(kind)
        vars(own).update(shared.value)
        for texts in batches:
            yield pd.Series(own.score(list(texts)))

    kept = [c for c in documents.columns if c not in ("score", "predicted")]
    rows = documents.select(*kept, scored("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
