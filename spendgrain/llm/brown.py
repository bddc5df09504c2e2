"""Language-model scoring by a Brown class-based bigram model.

Words are counted over all training texts. The most frequent words, the end of a text, and buckets of all
other words by their ending are symbols; exchange clustering assigns each symbol to one of a few classes,
moving it to the class that makes the class bigrams most likely. A text's probability is the product of the
transitions between its words' classes and of the words within their classes, both smoothed.

What reaches the driver is bounded by parameters: counts of `known` words, and of pairs of at most `head` + 1 +
`rare` symbols. The counts of all other words stay in a table that their occurrences are joined with.

Defined results: tokens are words, A-Z in lower case, and one end per text; a NULL text has only its end. Without training
text every token has count 0 and the model falls back to its smoothing. Rows are scored one by one, so repeated
rows and ids don't matter. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from math import log10

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrain.llm.common import cut, ship

ship(__name__)

#: A line feed is never part of a word.
END = "\n"
KNOWN, HEAD, RARE, CLASSES, SWEEPS = 200_000, 768, 255, 32, 5
#: Different words that a task counts before it hands them on, and texts scored at a time.
FLUSH = 300_000


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), b"\n"]


def ending(word: bytes, rare: int) -> int:
    return zlib.crc32(word[-2:]) % rare


def word_counts(texts: DataFrame, rare: int = RARE) -> DataFrame:
    """word, bucket and n over all texts."""

    def counted(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(tokens(text))
                if len(seen) > FLUSH:
                    yield frame(seen)
                    seen = Counter()
        yield frame(seen)

    def frame(seen: Counter) -> pd.DataFrame:
        words = list(seen)
        return pd.DataFrame({"word": [w.decode("utf-8", "replace") for w in words], "bucket": [ending(w, rare) for w in words], "n": list(seen.values())})

    rows = texts.select("text").mapInPandas(counted, "word string, bucket int, n long")
    return rows.groupBy("word").agg(F.min("bucket").alias("bucket"), F.sum("n").alias("n"))


class Symbols(dict):
    """Words to symbols: the head words and the end by number, others by their ending."""

    def __init__(self, head: list[str], rare: int) -> None:
        super().__init__({w.encode(): i for i, w in enumerate(head)})
        self.first, self.rare = len(head), rare

    def __missing__(self, word: bytes) -> int:
        return self.first + zlib.crc32(word[-2:]) % self.rare

    def __reduce__(self):
        return Symbols._again, (list(self.items()), self.first, self.rare)

    @staticmethod
    def _again(items, first, rare):
        again = Symbols([], rare)
        again.update(items)
        again.first = first
        return again


def pair_counts(texts: DataFrame, symbols: Symbols, n_symbols: int) -> np.ndarray:
    """How often each symbol follows each other one; a text begins after an end."""
    shared = texts.sparkSession.sparkContext.broadcast(symbols)

    def paired(batches):
        of, size = shared.value.__getitem__, n_symbols * n_symbols
        total = np.zeros(size, np.int64)
        before = of(b"\n")
        for batch in batches:
            for at in range(0, len(batch), 200):
                ids = [before]
                for text in batch["text"].iloc[at : at + 200]:
                    ids.extend(map(of, tokens(text)))
                ids = np.array(ids, np.int64)
                pairs, n = np.unique(ids[:-1] * n_symbols + ids[1:], return_counts=True)
                total[pairs] += n
        found = np.flatnonzero(total)
        yield pd.DataFrame({"pair": found, "n": total[found]})

    rows = texts.select("text").mapInPandas(paired, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.zeros(n_symbols * n_symbols)
    for pair, n in rows.toPandas().itertuples(index=False):
        counts[pair] = n
    return counts.reshape(n_symbols, n_symbols)


def exchange(counts: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """The class of each symbol. Each in turn, from the most frequent on, moves to the class that gives the
    largest sum of n log n over class pairs less that over classes, until none moves."""
    def weight(x):
        return x * np.log(np.maximum(x, 1))

    totals = counts.sum(axis=1) + counts.sum(axis=0)
    order = np.argsort(-totals, kind="stable")
    of = np.zeros(len(counts), np.int64)
    of[order] = np.arange(len(counts)) % classes
    member = np.eye(classes)[of]
    pairs = member.T @ counts @ member
    first, second = pairs.sum(axis=1), pairs.sum(axis=0)  # how often each class comes first, and second, in a pair
    for _ in range(sweeps):
        moved = 0
        for s in order[totals[order] > 0]:
            home, itself = of[s], counts[s, s]
            after = np.bincount(of, counts[s], classes)
            before = np.bincount(of, counts[:, s], classes)
            after[home] -= itself
            before[home] -= itself
            first[home] -= counts[s].sum()
            second[home] -= counts[:, s].sum()
            pairs[home] -= after
            pairs[:, home] -= before
            pairs[home, home] -= itself
            # The class sums of the others stay, wherever the symbol goes.
            gain = (weight(pairs + after) - weight(pairs)).sum(axis=1) + (weight(pairs + before[:, None]) - weight(pairs)).sum(axis=0)
            own = np.diagonal(pairs)
            gain += weight(own + after + before + itself) - weight(own + after) - weight(own + before) + weight(own)
            gain -= weight(first + counts[s].sum()) - weight(first) + weight(second + counts[:, s].sum()) - weight(second)
            new = int(np.argmax(gain)) if gain.max() > gain[home] + 1e-9 else home
            first[new] += counts[s].sum()
            second[new] += counts[:, s].sum()
            pairs[new] += after
            pairs[:, new] += before
            pairs[new, new] += itself
            of[s] = new
            moved += new != home
        if not moved:
            break
    return of


class Model:
    """Everything a text's score needs but the counts of words that are not known here."""

    def __init__(self, symbols: Symbols, of: np.ndarray, pairs: np.ndarray, sizes: np.ndarray, known: dict[bytes, int], total: int, words: int) -> None:
        """of: class of each symbol; sizes: different words of each class."""
        classes = len(sizes)
        self.symbols, self.of, self.known, self.total, self.words = symbols, of, known, total, words
        seen = np.bincount(of, pairs.sum(axis=0), classes)
        by_class = np.zeros((classes, classes))
        np.add.at(by_class, (of[:, None], of[None, :]), pairs)
        alone = (seen + 1) / (seen.sum() + classes)
        self.step = np.log10((by_class + classes * alone) / (by_class.sum(axis=1, keepdims=True) + classes))
        self.within = -np.log10(seen + sizes + 1)


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """At most `most` words, those with a count above the lowest of some 16 steps per doubling that allows it."""
    step = F.floor(F.log2("n") * 16)
    room, lowest = most, None
    for at, n in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        if n > room:
            break
        room, lowest = room - n, at
    return counts.where(step >= lowest) if lowest is not None else counts.limit(0)


def learn(texts: DataFrame, known: int = KNOWN, head: int = HEAD, rare: int = RARE, classes: int = CLASSES, sweeps: int = SWEEPS) -> tuple[Model, DataFrame]:
    """The model, and the counts of all words."""
    counts = cut(word_counts(texts, rare))
    total, words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = most_frequent(counts, known).select("word", "n").toPandas().sort_values(["n", "word"], ascending=[False, True])
    frequent = [END, *[w for w in top["word"][: head + 1] if w != END][:head]]
    symbols = Symbols(frequent, rare)
    n_symbols = len(frequent) + rare
    pairs = pair_counts(texts, symbols, n_symbols)
    of = exchange(pairs, min(classes, n_symbols), sweeps)
    buckets = dict(counts.join(F.broadcast(texts.sparkSession.createDataFrame([(w,) for w in frequent], "word string")), "word", "left_anti").groupBy("bucket").count().collect())
    different = np.array([1] * len(frequent) + [buckets.get(i, 0) for i in range(rare)])
    sizes = np.bincount(of, different, min(classes, n_symbols))
    known_words = {w.encode(): int(n) for w, n in top.itertuples(index=False)}
    return Model(symbols, of, pairs, sizes, known_words, int(total), int(words)), counts


def score(documents: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """documents: doc_id, text. Returns doc_id, n_tokens, n_known, train_tokens, base_score (the words alone,
    add-one) and score, both log10 of the text's probability, and perplexity."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = dict(documents.dtypes)["doc_id"]

    def scored(batches):
        m = shared.value
        of, known, end = m.symbols.__getitem__, m.known.get, m.of[m.symbols[b"\n"]]
        for batch in batches:
            rows = []
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"], strict=True):
                said = tokens(text)
                c = m.of[list(map(of, said))]
                path = m.step[np.concatenate(([end], c[:-1])), c].sum() + m.within[c].sum()
                n = [known(w, 0) for w in said]
                rest = Counter(w for w, k in zip(said, n, strict=True) if not k)
                n = np.array(n)
                rows.append((row, doc_id, len(said), int((n > 0).sum()), float(np.log10(n + 1).sum()), float(path), [w.decode("utf-8", "replace") for w in rest], list(rest.values())))
            yield pd.DataFrame(rows, columns=["row", "doc_id", "n_tokens", "n_known", "words", "path", "rest", "times"])

    schema = f"row long, doc_id {kind}, n_tokens long, n_known long, words double, path double, rest array<string>, times array<long>"
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInPandas(scored, schema)
    rows = cut(rows)
    rare = rows.select("row", F.explode(F.arrays_zip("rest", "times")).alias("r")).select("row", F.col("r.rest").alias("word"), F.col("r.times").alias("times"))
    found = rare.join(counts.select("word", "n"), "word").groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more")
    )
    whole = rows.drop("rest", "times").join(found, "row", "left")
    words = F.col("words") + F.coalesce("more", F.lit(0.0))
    base = words - F.col("n_tokens") * F.lit(log10(model.total + model.words + 1))
    return whole.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), base.alias("base_score"), (words + F.col("path")).alias("score"),
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
