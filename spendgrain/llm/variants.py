"""Spelling variant grouping by search schemes on FM-indexes of the vocabulary.

Two words are near if one inserted, deleted or replaced code point makes them equal. Wherever that is, one half of the
longer word (of either, if one is replaced) stands in both words, so each word is searched for twice: its last half is matched exactly and
then extended to the left across the first half with one error, and its first half is matched and extended to the right. Matching keeps
intervals of suffix ranks over the delimited vocabulary, those of its words read forwards for one direction and backwards for
the other; an interval that is empty ends a branch. A word is searched for with a replaced and with a deleted code point; what a
deletion finds is near in both directions, so nothing has to be inserted.

The indexes are dealt out by a hash of the half that is matched exactly, in blocks of bounded size: a half that more than
MOST words share is split over several indexes, which each of its words is searched for in, itself split over as many tasks.

Defined results: words are the longest runs of [A-Za-zÀ-ÿ], A-Z in lower case, with at least `shortest` code points and `least`
occurrences. A NULL text has none; a NULL doc_id counts as an empty one. Repeated rows count each time. Texts of
any length are read whole, in slices between words. Ties of the form go to the first word in code point order. An empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrain.llm.common import LOWER, UPPER, cut, ship

ship(__name__)

SHORTEST, LEAST, TIMES = 5, 3, 2
#: Words of an index on average and at most; different words that a task counts before it hands them on; characters read at a time.
BLOCK, MOST, FLUSH, SLICE = 16_000, 64_000, 300_000, 4_000_000
#: Symbols of words searched for side by side.
CELLS = 1_000_000
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_OTHER = re.compile("[^A-Za-zÀ-ÿ]")
REPLACED, DELETED = 0, 1


def slices(text: str) -> Iterator[str]:
    """The text in lower case, cut between words."""
    text = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    at = 0
    while len(text) - at > SLICE and (gap := _OTHER.search(text, at + SLICE)):
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:]


def word_counts(documents: DataFrame, shortest: int = SHORTEST, slips: int = 0) -> DataFrame:
    """documents: doc_id, text. word and n. With `slips`, one in so many words of a document loses a code point, chosen by checksum:
    misspellings with a known origin."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")

    def counted(batches):
        seen: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                own: Counter = Counter()
                for part in slices(text):
                    own.update(runs.findall(part))
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, n in own.items():
                    if slips and (h := zlib.crc32(word.encode(), start)) % slips == 0:
                        h %= len(word)
                        word = word[:h] + word[h + 1 :]
                        if len(word) < shortest:
                            continue
                    seen[word] += n
                if len(seen) > FLUSH:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen = Counter()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    blank = F.lit("")
    rows = documents.select(F.coalesce(F.col("doc_id").cast("string"), blank).alias("doc_id"), F.coalesce("text", blank).alias("text"))
    return rows.mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """FM-index of words, each between delimiters (symbol 0). Suffixes end with their word; equal ones are in the order of the words."""

    def __init__(self, words: list[str]) -> None:
        self.words = words = sorted(words)
        points = [np.frombuffer((w + "\0").encode("utf-32-le"), np.uint32) for w in words]
        sizes = np.array([len(p) for p in points])
        self.alphabet, text = np.unique(np.concatenate(points), return_inverse=True)
        self.size, left = len(text), np.repeat(np.cumsum(sizes), sizes) - np.arange(len(text))
        # The rank of each suffix by its first 2, 4, 8 ... symbols.
        rank, reach = text.astype(np.int64), 1
        while reach < sizes.max():
            beyond = np.zeros(self.size, np.int64)
            inside = np.flatnonzero(left > reach)
            beyond[inside] = rank[inside + reach]
            _, rank = np.unique(rank * (rank.max() + 1) + beyond, return_inverse=True)
            reach *= 2
        self.before = text[np.argsort(rank, kind="stable") - 1].astype(np.int64)
        places = np.argsort(self.before, kind="stable")
        self.keys = self.before[places] * (self.size + 1) + places
        self.step_of = np.empty(self.size, np.int64)
        self.step_of[places] = np.arange(self.size)
        same = self.before[places[1:]] == self.before[places[:-1]]
        self.last = np.full(self.size, -1, np.int64)  # the place before with the same symbol
        self.last[places[1:][same]] = places[:-1][same]

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; -1 for those that no word has."""
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at, -1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank intervals with the symbol before what they match; empty ones for a symbol of -1."""
        base = np.maximum(symbol, 0) * (self.size + 1)
        low = np.searchsorted(self.keys, base + low)
        return low, np.where(symbol < 0, low, np.searchsorted(self.keys, base + high))

    def others(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each interval its extensions by all symbols but the given one and the delimiter: number of the interval, low, high."""
        size = high - low
        few = np.flatnonzero(size <= len(self.alphabet))
        owner = np.repeat(few, size[few])
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + low[owner]
        c = self.before[place]
        first = (c > 0) & (c != symbol[owner]) & (self.last[place] < low[owner])
        owner, place, c = owner[first], place[first], c[first]
        found = [(owner, self.step_of[place], self.extend(c, low[owner], high[owner])[1])]
        many = np.flatnonzero(size > len(self.alphabet))
        for c in range(1, len(self.alphabet)):
            owner = many[symbol[many] != c]
            a, b = self.extend(np.full(len(owner), c), low[owner], high[owner])
            found.append((owner[a < b], a[a < b], b[a < b]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def search(self, words: list[str], exact: np.ndarray, error: int, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """Matches the last `exact` symbols of each word, then the others with one error: numbers of words and of the index's words."""
        sizes = np.array([len(w) for w in words])
        points = np.zeros((len(words), sizes.max() + 2), np.uint32)  # from the last on, then a delimiter
        for row, w in enumerate(words):
            points[row, : len(w)] = np.frombuffer(w[::-1].encode("utf-32-le"), np.uint32)
        symbols = self.codes(points)
        who = np.arange(len(words))
        low, high = np.zeros(len(words), np.int64), np.full(len(words), len(self.words))
        for t in range(int(exact.max())):
            now = exact[who] > t
            low[now], high[now] = self.extend(symbols[who[now], t], low[now], high[now])
            who, low, high = (x[low < high] for x in (who, low, high))
        at, ways = exact[who], []
        who, at, low, high = (x[at < sizes[who]] for x in (who, at, low, high))
        while len(who):
            if error == REPLACED:
                owner, a, b = self.others(symbols[who, at], low, high)
                ways.append((who[owner], at[owner] + 1, a, b))
            else:  # of equal neighbours, the first in the word as it is spelled
                neighbour = np.maximum(at - 1, 0) if backwards else at + 1
                once = (points[who, at] != points[who, neighbour]) | (backwards & (at == 0))
                ways.append((who[once], at[once] + 1, low[once], high[once]))
            low, high = self.extend(symbols[who, at], low, high)
            at = at + 1
            going = (low < high) & (at < sizes[who])
            who, at, low, high = (x[going] for x in (who, at, low, high))
        if not ways:
            return who, who
        who, at, low, high = (np.concatenate(x) for x in zip(*ways, strict=True))
        found = []
        while len(who):  # exactly, up to the delimiter
            done = at == sizes[who]
            a, b = self.extend(symbols[who, at], low, high)
            found.append((who[done & (a < b)], a[done & (a < b)]))
            going = ~done & (a < b)
            who, at, low, high = who[going], at[going] + 1, a[going], b[going]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (who, who)


def exact_half(size, kind):
    """Symbols of a word's half that must match: the last ones of words read forwards (kind 0, 1), the first of words read backwards (2, 3)."""
    return (size + 1 - kind // 2) // 2


def of_like_length(words: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Parts of words in order of length, such that a row for each as long as the longest has CELLS symbols at most."""
    sizes, start = words["frame"].str.len().to_numpy(), 0
    while start < len(sizes):
        end = min(start + CELLS // (sizes[start] + 2) + 1, len(sizes))
        while end > start + 1 and (end - start) * (sizes[end - 1] + 2) > CELLS:
            end = start + (end - start) // 2
        yield words.iloc[start:end]
        start = end


def near_words(vocabulary: DataFrame) -> DataFrame:
    """vocabulary: word, n (different words). word, n, near and near_n of all near words, each pair in both directions, once."""
    buckets = max(1, -(-vocabulary.count() // BLOCK))
    kinds = vocabulary.select("word", "n", F.explode(F.array(*[F.lit(k) for k in range(4)])).alias("kind"))
    framed = kinds.withColumn("frame", F.when(F.col("kind") < 2, F.col("word")).otherwise(F.reverse("word"))).drop("word")

    def keyed(size):
        """By the half of a word of `size` that the searched word and the found one share."""
        half = F.expr(f"right(frame, cast(({size} + 1 - kind div 2) div 2 as int))")
        return (F.pmod(F.xxhash64("kind", half), F.lit(buckets)) * 4 + F.col("kind")).alias("bucket")

    indexed = framed.select("kind", "frame", "n", keyed("(char_length(frame) + kind % 2)"))
    asked = framed.select("kind", "frame", "n", keyed("char_length(frame)"))
    # Blocks of an average bucket; large buckets, at most 4 / MOST of all words in number, are split on both sides.
    large = indexed.select("bucket", F.lit(1).alias("i"), F.lit(0).alias("q")).unionByName(asked.select("bucket", F.lit(0).alias("i"), F.lit(1).alias("q")))
    large = large.groupBy("bucket").agg(*[F.ceil(F.sum(c) / MOST).alias(c) for c in ("i", "q")]).where("i > 1 OR q > 1")
    large = F.broadcast(cut(large))

    def in_blocks(rows, own, other, role):
        parts = rows.join(large, "bucket", "left").fillna(1, ["i", "q"])
        own_part = F.pmod(F.xxhash64("frame"), F.greatest(F.col(own), F.lit(1)))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(other), F.lit(1)).cast("long") - 1))
        return parts.select(F.lit(role).alias("role"), "kind", "frame", "n", "bucket", own_part.alias(own), every.alias(other))

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        """The near words of one block's words in its index."""
        held, words = rows[rows["role"] == "held"].sort_values("frame"), rows[rows["role"] == "asked"]
        parts = []
        if len(held) and len(words):
            kind, index = int(words["kind"].iloc[0]), Index(list(held["frame"]))
            words = words.iloc[np.argsort(words["frame"].str.len().to_numpy(), kind="stable")]
            for some in of_like_length(words):
                exact = exact_half(some["frame"].str.len().to_numpy(), kind)
                who, which = index.search(list(some["frame"]), exact, kind % 2, kind >= 2)
                if not len(who):
                    continue
                ours, theirs = some.iloc[who], held.iloc[which]
                pairs = pd.DataFrame({"word": list(ours["frame"]), "n": list(ours["n"]), "near": list(theirs["frame"]), "near_n": list(theirs["n"])})
                if kind >= 2:
                    pairs["word"], pairs["near"] = [w[::-1] for w in pairs["word"]], [w[::-1] for w in pairs["near"]]
                parts.append(pairs)
                if kind % 2 == DELETED:
                    parts.append(pairs.rename(columns={"word": "near", "n": "near_n", "near": "word", "near_n": "n"})[pairs.columns])
        return pd.concat(parts) if parts else pd.DataFrame({"word": [], "n": [], "near": [], "near_n": []}).astype({"word": object, "near": object})

    both = in_blocks(indexed, "i", "q", "held").unionByName(in_blocks(asked, "q", "i", "asked"))
    return both.groupBy("bucket", "i", "q").applyInPandas(found, "word string, n long, near string, near_n long")


def roots(links: DataFrame) -> DataFrame:
    """links: word, form; forms lead to no circle. word and root, the last form on its way. Ways double in each round."""
    ways = cut(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not ways.where("moved").isEmpty():
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = cut(ways.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
    return ways.select("word", "root")


def group_variants(counts: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """counts: word, n. The words with n >= least, with n_near, how many are near; form, the near word of largest n if
    that is `times` the word's own or more, with form_n; and root, where the forms of forms end. Counts grow from form to form, so there is no circle."""
    vocabulary = cut(counts.where(F.col("n") >= least))
    near = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("best"), F.first("n").alias("own"))
    strong = -F.col("best.n") >= times * F.col("own")
    near = cut(near.select("word", "n_near", F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.n")).alias("form_n")))
    whole = vocabulary.join(near, "word", "left").join(roots(near.where("form IS NOT NULL")), "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
