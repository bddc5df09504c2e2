"""Phrase collocation mining over sorted count streams.

Texts are read three times: for words, for pairs of frequent words (by hash, to see which may be frequent), and for the runs of
words in which every pair may be. Pairs and longer phrases are counted in these runs, one order after the other, where
both of their shorter phrases are frequent. The frequent phrases of all orders then lie in two streams: in prefix order (sorted by their words from the
first) and in suffix order (from the last). In prefix order everything a phrase begins with stands before
it and is still open when it is read, so one pass in lockstep with a stack of open phrases gives the counts of all first parts, and
shows which phrases an extension to the right covers; the pass in suffix order does the same for last parts and
extensions to the left. The streams are dealt out by range, so no phrase is hashed for this and a common first word spreads
over as many tasks as it needs; each task is handed the counts of the few phrases still open where it begins.

What is broadcast: a bit filter of at most 2**MAX_BITS bits that lets everything through that may be frequent (what it lets through
needlessly is counted and dropped), and at most `longest` - 1 open phrases per task.

Defined results: a NULL text is empty, a NULL lang is `und`. A-Z count in lower case; phrases don't reach over any of
. , ; : ! ? and line breaks. Repeated rows count each time; ids are not looked at. Texts of any length are read whole, in
slices between words. Ties for the lowest cut go to the shortest first part, ties of rank to the phrase first in byte order. An
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendgrain.llm.common import cut, ship

ship(__name__)

LEAST, LONGEST, TOP, COVER = 100, 5, 2000, 100
#: Bytes of text split at a time; tokens and different words that a task holds before it hands counts on.
SLICE, TOKENS, WORDS = 4_000_000, 2_000_000, 400_000
MAX_BITS = 26
BREAK = b"."
_TABLE = bytes(BREAK[0] if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def slices(texts: list[str]) -> Iterator[bytes]:
    """The texts in lower case with one mark for every break, a break after each, cut between words."""
    part, size = [], 0
    for text in texts:
        whole = text.encode("utf-8", "surrogatepass").translate(_TABLE) + BREAK
        if size + len(whole) > SLICE and part:
            yield b"".join(part)
            part, size = [], 0
        at = 0
        while len(whole) - at > SLICE:
            end = whole.find(b" ", at + SLICE)
            if end < 0:
                break
            yield whole[at:end]
            at = end
        part.append(whole[at:])
        size += len(whole) - at
    yield b"".join(part)


class Filter:
    """Which phrases of a language may be frequent: one bit each, by a hash of their words' hashes."""

    def __init__(self, bits: int, marked: np.ndarray) -> None:
        self.bits, self.marked = bits, marked

    @staticmethod
    def hashes(lang: str, words: list[np.ndarray]) -> np.ndarray:
        """words: for each place in the phrase, the hashes of the words there."""
        h = np.full(len(words[0]), xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")), np.uint64)
        for w in words:
            h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h * np.uint64(0xBF58476D1CE4E5B9)

    def hits(self, lang: str, words: list[np.ndarray]) -> np.ndarray:
        at = (self.hashes(lang, words) >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.marked[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _hash(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def phrase_places(phrases: DataFrame, order: int) -> DataFrame:
    """phrases: lang, phrase of `order` words. The first MAX_BITS bits of their hashes."""

    def placed(batches):
        for batch in batches:
            for lang, group in batch.groupby("lang")["phrase"]:
                words = [p.encode("utf-8", "surrogatepass").split(b" ") for p in group]
                h = Filter.hashes(lang, [_hash([w[i] for w in words]) for i in range(order)])
                yield pd.DataFrame({"place": (h >> np.uint64(64 - MAX_BITS)).astype(np.int64)})

    return phrases.select("lang", "phrase").mapInPandas(placed, "place long")


def filter_of(places: DataFrame) -> Filter:
    """places: place, the first MAX_BITS bits of hashes. 64 bits for each, up to 2**MAX_BITS in all."""
    bits = min(max(places.count() * 64, 1 << 16).bit_length(), MAX_BITS)
    place = F.shiftright("place", MAX_BITS - bits) + 1
    blocks = places.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    marked = np.zeros((1 << bits) // 8, np.uint8)
    # Block b, counted from 1, is the bitmap of 32,768 places in 4,096 bytes.
    for b, block in blocks.collect():
        marked[(b - 1) * 4096 : b * 4096] = np.frombuffer(block, np.uint8)
    return Filter(bits, marked)


class Tokens:
    """The tokens of texts of each language as numbers, until there are enough of them to count."""

    def __init__(self) -> None:
        self.ids: defaultdict = defaultdict(count().__next__)
        self.mark = self.ids[BREAK]
        self.parts: dict[str, list[np.ndarray]] = defaultdict(list)
        self.copies: dict[str, list[int]] = defaultdict(list)
        self.size, self.hashes = 0, None

    def add(self, lang: str, texts: list[str], copies: list[int]) -> None:
        of = self.ids.__getitem__
        for part in slices(texts):
            said = part.replace(BREAK, b" . ").split()
            self.parts[lang].append(np.fromiter(map(of, said), np.int64, len(said)))
            self.size += len(said)
        self.copies[lang].extend(copies)

    def full(self) -> bool:
        return self.size > TOKENS or len(self.ids) > WORDS

    def languages(self) -> Iterator[tuple[str, np.ndarray]]:
        for lang, parts in self.parts.items():
            yield lang, np.concatenate(parts)

    def times(self, lang: str, said: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the tokens there count. Only runs, which hold no breaks, come in several copies."""
        copies = np.array(self.copies[lang], np.int64)
        if (copies == 1).all():
            return np.ones(len(at), np.int64)
        return copies[np.cumsum(said == self.mark)[at]]

    def frequent(self, lang: str, said: np.ndarray, order: int, known: Filter) -> np.ndarray:
        """Where a phrase of so many words begins, in one piece, that the filter lets through."""
        inside, places = said != self.mark, max(len(said) - order + 1, 0)
        whole = inside[:places].copy()
        for i in range(1, order):
            whole &= inside[i : places + i]
        if self.hashes is None:
            self.hashes = _hash(list(self.ids))
        at = np.flatnonzero(whole)
        whole[at] = known.hits(lang, [self.hashes[said[at + i]] for i in range(order)])
        return whole


def batches_of_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[Tokens]:
    """batches: lang, text, copies."""
    held = Tokens()
    for batch in batches:
        # A few megabytes at a time, whatever the length of a batch's texts.
        piece = np.cumsum(batch["text"].str.len().to_numpy()) // SLICE
        for (lang, _), rows in batch.groupby(["lang", piece], sort=False):
            held.add(lang, list(rows["text"]), list(rows["copies"]))
            if held.full():
                yield held
                held = Tokens()
    yield held


def phrase_counts(rows: DataFrame, order: int, known: Filter | None = None) -> DataFrame:
    """rows: lang, text, copies. lang, phrase and n of the phrases of `order` words whose two shorter phrases `known` lets through."""

    def counted(batches):
        for held in batches_of_tokens(batches):
            words = [w.decode("utf-8", "replace") for w in held.ids]
            for lang, said in held.languages():
                if order == 1:
                    at = np.flatnonzero(said != held.mark)
                else:
                    shorter = held.frequent(lang, said, order - 1, known)
                    at = np.flatnonzero(shorter[:-1] & shorter[1:])
                    # Two phrases side by side are whole, so the phrase over both is in one piece.
                if not len(at):
                    continue
                number = said[at]
                for i in range(1, order):
                    if i > 1:
                        _, number = np.unique(number, return_inverse=True)
                    number = number * len(words) + said[at + i]
                _, first, number = np.unique(number, return_index=True, return_inverse=True)
                n = np.zeros(len(first), np.int64)
                np.add.at(n, number, held.times(lang, said, at))
                begins = at[first]
                texts = [words[i] for i in said[begins]] if order == 1 else [" ".join([words[i] for i in p]) for p in said[begins[:, None] + np.arange(order)].tolist()]
                yield pd.DataFrame({"lang": lang, "phrase": texts, "n": n})

    found = rows.select("lang", "text", "copies").mapInPandas(counted, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def pair_places(rows: DataFrame, known: Filter, least: int, total: int) -> DataFrame:
    """place of the pairs of neighbouring words that may come `least` times. Only hashes are counted, since most pairs are rare: what
    comes often enough is counted by its words later. A task sends the hashes in blocks by their first bits, of which there are
    so many that a block has some 100,000 hashes in all."""
    first = max(6, (total // 100_000).bit_length())

    def counted(batches):
        for held in batches_of_tokens(batches):
            found = []
            for lang, said in held.languages():
                shorter = held.frequent(lang, said, 1, known)
                at = np.flatnonzero(shorter[:-1] & shorter[1:])
                found.append(Filter.hashes(lang, [held.hashes[said[at]], held.hashes[said[at + 1]]]))
            hashes, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            if len(hashes):
                block = (hashes >> np.uint64(64 - first)).astype(np.int64)
                starts = np.flatnonzero(np.diff(block, prepend=-1))
                rest = (hashes >> np.uint64(32 - first)).astype(np.uint32)
                parts = list(zip(starts.tolist(), [*starts[1:].tolist(), len(block)], strict=True))
                yield pd.DataFrame({"block": block[starts], "rest": [rest[a:b].tobytes() for a, b in parts], "n": [n[a:b].astype(np.int32).tobytes() for a, b in parts]})

    def summed(key, block):
        rest, number = np.unique(np.frombuffer(b"".join(block["rest"]), np.uint32), return_inverse=True)
        n = np.zeros(len(rest), np.int64)
        np.add.at(n, number, np.frombuffer(b"".join(block["n"]), np.int32))
        whole = (np.int64(key[0]) << 32) + rest[n >= least].astype(np.int64)
        return pd.DataFrame({"place": np.unique(whole >> (first + 32 - MAX_BITS))})

    blocks = rows.select("lang", "text", "copies").mapInPandas(counted, "block long, rest binary, n binary")
    return blocks.groupBy("block").applyInPandas(summed, "place long")


def frequent_runs(rows: DataFrame, order: int, known: Filter) -> DataFrame:
    """lang, text and copies of the longest runs of words in which every phrase of `order` words is let through.
    Frequent phrases of so many words or more are in these alone."""

    def cut_out(batches):
        for held in batches_of_tokens(batches):
            words = [w.decode("utf-8", "replace") for w in held.ids]
            for lang, said in held.languages():
                inside = np.concatenate(([False], held.frequent(lang, said, order, known), [False]))
                start, end = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
                times: Counter = Counter()
                for a, b, n in zip(start.tolist(), end.tolist(), held.times(lang, said, start).tolist(), strict=True):
                    times[said[a : b + order - 1].tobytes()] += n
                texts = [" ".join([words[i] for i in np.frombuffer(t, np.int64).tolist()]) for t in times]
                if texts:
                    yield pd.DataFrame({"lang": lang, "text": texts, "copies": list(times.values())})

    found = rows.select("lang", "text", "copies").mapInPandas(cut_out, "lang string, text string, copies long")
    return found.groupBy("lang", "text").agg(F.sum("copies").alias("copies"))


def frequent_phrases(documents: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to `longest` words with n >= least, as lang, order, phrase, n; and the words of each language, as lang, total."""
    rows = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"), F.lit(1).cast("long").alias("copies"))
    words = cut(phrase_counts(rows, 1))
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    orders = [words.where(F.col("n") >= least)]
    for order in range(2, longest + 1):
        known = filter_of(cut(phrase_places(orders[-1], order - 1)))
        if order == 2:
            every = totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
            rows = cut(frequent_runs(rows, 2, filter_of(cut(pair_places(rows, known, least, every)))))
        orders.append(cut(phrase_counts(rows, order, known).where(F.col("n") >= least)))
    every = None
    for order, found in enumerate(orders, start=1):
        found = found.withColumn("order", F.lit(order))
        every = found if every is None else every.unionByName(found)
    return every, totals


def in_order(phrases: DataFrame, key: Column) -> DataFrame:
    """The phrases as a stream sorted by language and key, dealt out by range and kept."""
    keyed = phrases.withColumn("sorted_by", key)
    return cut(keyed.repartitionByRange("lang", "sorted_by").sortWithinPartitions("lang", "sorted_by").drop("sorted_by"))


def open_phrases(stream: DataFrame, backwards: bool) -> dict[tuple[str, str], int]:
    """The counts of the phrases that each task's first phrase begins with: they may stand in the tasks before."""

    def first(batches):
        for batch in batches:
            if len(batch):
                yield batch.iloc[:1]
                return

    firsts = stream.select("lang", "phrase").mapInPandas(first, "lang string, phrase string").collect()
    needed = {(lang, part) for lang, phrase in firsts for part in parts_of(phrase, backwards)}
    if not needed:
        return {}
    asked = stream.sparkSession.createDataFrame(sorted(needed), "lang string, phrase string")
    return {(r.lang, r.phrase): r.n for r in stream.select("lang", "phrase", "n").join(F.broadcast(asked), ["lang", "phrase"]).collect()}


def parts_of(phrase: str, backwards: bool) -> list[str]:
    """The shorter phrases it begins with, or with `backwards` those it ends with, from the shortest on."""
    words = phrase.split(" ")
    return [" ".join(words[-k:] if backwards else words[:k]) for k in range(1, len(words))]


def lockstep(stream: DataFrame, backwards: bool, name: str, cover: int) -> DataFrame:
    """The stream's rows with `name`: the counts of the parts each phrase begins with (ends with), by length; and
    `covers` + name: whether it has `cover` percent of the count of the phrase without its last (first) word."""
    begun = stream.sparkSession.sparkContext.broadcast(open_phrases(stream, backwards))

    def passed(batches):
        lang, path, counts = None, [], []
        for batch in batches:
            parts, covers = [], []
            for own, phrase, n in zip(batch["lang"], batch["phrase"], batch["n"], strict=True):
                words = phrase.split(" ")[:: -1 if backwards else 1]
                if own != lang:
                    lang, path, counts = own, [], []
                same = 0
                while same < len(path) and same < len(words) and path[same] == words[same]:
                    same += 1
                del path[same:], counts[same:]
                if len(path) < len(words) - 1:  # only before the first phrases of a task
                    path = words[:-1]
                    counts = [begun.value[own, part] for part in parts_of(phrase, backwards)]
                parts.append(list(counts))
                covers.append(bool(counts) and 100 * n >= cover * counts[-1])
                path.append(words[-1])
                counts.append(n)
            yield batch.assign(**{name: parts, "covers_" + name: covers})

    schema = ", ".join(f"{c} {t}" for c, t in stream.dtypes) + f", {name} array<long>, covers_{name} boolean"
    return stream.mapInPandas(passed, schema)


def mine(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """documents: lang, text. The `top` phrases of each language by score: floor(1000 * a * n / (l * r)) at the cut of the phrase where
    that is lowest; a, l and r count the phrase, its first and its last part, n the language's words. Phrases
    inside a longer one with `cover` percent of their count or more are left out. Returns lang, rank, phrase, a, l, r, n, score."""
    every, totals = frequent_phrases(documents, least, longest)
    phrases = every.join(totals, "lang")
    forwards = lockstep(in_order(phrases, F.split("phrase", " ")), False, "firsts", cover)
    both = cut(lockstep(in_order(forwards, F.reverse(F.split("phrase", " "))), True, "lasts", cover))
    words = F.split("phrase", " ")
    size = F.col("order")
    covered = both.where("covers_firsts").select("lang", F.array_join(F.slice(words, F.lit(1), size - 1), " ").alias("phrase")).unionByName(
        both.where("covers_lasts").select("lang", F.array_join(F.slice(words, F.lit(2), size - 1), " ").alias("phrase"))
    )
    left = both.where("order > 1").join(covered.hint("merge"), ["lang", "phrase"], "left_anti")
    # Products and the integral division are exact: 38 digits. Element k of firsts belongs to the cut after k words.
    exact = "cast({} as decimal(19,0))".format
    score = f"(cast(1000 as decimal(4,0)) * {exact('n')} * {exact('total')}) div ({exact('element_at(firsts, k)')} * {exact('element_at(lasts, order - k)')})"
    lowest = F.expr(f"array_min(transform(sequence(1, order - 1), k -> struct({score} AS score, k, element_at(firsts, k) AS l, element_at(lasts, order - k) AS r)))")
    best = left.withColumn("at", lowest)
    ranked = best.select("lang", "phrase", F.col("n").alias("a"), "at.l", "at.r", F.col("total").alias("n"), "at.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return ranked.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
