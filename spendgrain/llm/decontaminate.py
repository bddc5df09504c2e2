"""Benchmark decontamination by the q-gram lemma.

Where a benchmark item of m characters occurs in a text with at most e edits, the two share at least
m + 1 - q (e + 1) q-grams, all on neighbouring diagonals (place in the text minus place in the item).
Shared q-grams are counted in overlapping bands of diagonals, bands that reach the item's bound are
retained, and a banded alignment verifies each: it counts as found with at most e edits, in the text that holds it
whole; an alignment does not go on into the next text. Nothing else decides, so every occurrence within the budget is found.

The items' index is broadcast in blocks of at most `block_chars` characters or one item; documents meet each
block where they are read, whole and without a shuffle.

Defined results: letters and digits count in lower case, everything else as one space. The edit budget is
`share` of the item's length, and small enough for a bound of at least one q-gram. Items of fewer than q
characters, or NULL, can't be told from other text and are not searched. NULL and empty texts hold nothing.
Repeated items are each found; documents are judged row by row, so repeated rows and ids don't matter. An empty
table gives no rows. Other columns pass through `find`, except n_items, items and edits, which it replaces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrain.llm.common import ship

ship(__name__)

Q, SHARE = 10, 0.08
#: Slots of the table that tells most q-grams of a text apart from all q-grams of the items.
SLOTS = 22
#: Characters of texts that are worked on at a time, and alignments.
SLICE, ALIGNED = 500_000, 2048
#: Pairs of equal q-grams of a text and of the items that are counted at a time.
HITS = 2_000_000
MULTIPLIER = 0x9E3779B97F4A7C15
ENDS, SPACE = 0, 32
ADDED = ["n_items", "items", "edits"]


def lower_table() -> np.ndarray:
    """For each code point the lower-case letter or digit, or a space."""
    table = np.full(0x110000, SPACE, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalnum():
            table[code] = ord(c.lower()[0])
    return table


def normalised(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' characters, each text followed by ENDS, and the places where texts begin."""
    codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = table[codes]
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    chars[ends] = ENDS
    keep = chars > SPACE
    keep[:-1] |= keep[1:] & (chars[:-1] == SPACE)  # one space before a word ...
    keep[np.concatenate(([0], ends[:-1] + 1))] &= chars[np.concatenate(([0], ends[:-1] + 1))] != SPACE
    keep[ends] = True
    starts = np.concatenate(([0], np.cumsum(keep)[ends]))
    chars = chars[keep]
    # ... but not at the beginning of a text.
    lead = starts[:-1][chars[np.minimum(starts[:-1], len(chars) - 1)] == SPACE]
    if len(lead):
        rest = np.ones(len(chars), bool)
        rest[lead] = False
        starts = starts - np.concatenate(([0], np.cumsum(~rest)))[starts]
        chars = chars[rest]
    return chars, starts


def grams(chars: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q characters from each place on, put together from halves."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, width, known = chars.astype(np.uint64), 1, None
    done = 0
    size = q
    with np.errstate(over="ignore"):
        while size:
            if size & 1:
                part = power[done : done + n]
                known = part.copy() if known is None else known * np.uint64(pow(MULTIPLIER, width, 1 << 64)) + part
                done += width
            size >>= 1
            if size:
                power = power[:-width] * np.uint64(pow(MULTIPLIER, width, 1 << 64)) + power[width:]
                width *= 2
        return (known ^ (known >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)


class Index:
    """q-grams of a block of items with their places."""

    def __init__(self, items: list[tuple], table: np.ndarray, q: int, share: float) -> None:
        """items: id, text."""
        self.table, self.q = table, q
        items = items or [(None, "")]
        chars, starts = normalised([text or "" for _, text in items], table)
        spelled = [(i, chars[a : b - 1]) for (i, _), a, b in zip(items, starts[:-1], starts[1:], strict=True)]
        spelled = [(i, c) for i, c in spelled if len(c) >= q]
        self.ids, self.items = [i for i, _ in spelled], [c for _, c in spelled]
        self.length = np.array([len(c) for c in self.items], np.int64)
        self.budget = np.minimum((self.length * share).astype(np.int64), self.length // q - 1)
        self.bound = self.length + 1 - q * (self.budget + 1)
        hashed = [grams(c, q) for c in self.items]
        hashes = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(hashed)), [len(h) for h in hashed])
        place = np.concatenate([np.arange(len(h)) for h in hashed]) if hashed else item
        order = np.argsort(hashes, kind="stable")
        self.hashes, first = np.unique(hashes[order], return_index=True)
        self.first = np.append(first, len(hashes))
        self.item, self.place = item[order].astype(np.int32), place[order].astype(np.int32)
        self.slots = np.zeros(1 << SLOTS, bool)
        self.slots[self.hashes >> np.uint64(64 - SLOTS)] = True
        #: Half a band of each item: more than its budget, so that a band of two halves holds neighbouring diagonals.
        self.half = np.array([1 << (int(b) + 1).bit_length() for b in self.budget], np.int64)

    def bands(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """item and first diagonal of each band that reaches its item's bound."""
        hashes = grams(chars, self.q)
        at = np.flatnonzero(self.slots[hashes >> np.uint64(64 - SLOTS)])
        found = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        same = self.hashes[found] == hashes[at]
        at, found = at[same], found[same]
        every = self.first[found + 1] - self.first[found]
        shift = int(self.length.max()) + int(self.half.max())  # diagonals before the text are not below 0
        width = (len(chars) + 2 * shift) // int(self.half.min()) + 2
        key, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Places of a repeated q-gram in the text times its places in the items may be many: some HITS of them at a time.
        part = np.cumsum(every) // HITS
        for first in np.flatnonzero(np.diff(part, prepend=-1)):
            some = slice(first, np.searchsorted(part, part[first], side="right"))
            n = every[some]
            entry = np.repeat(self.first[found[some]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            item = self.item[entry].astype(np.int64)
            half_band = (np.repeat(at[some], n) - self.place[entry] + shift) // self.half[item]
            own, times = np.unique(item * width + half_band, return_counts=True)
            key, number = np.unique(np.concatenate([key, own]), return_inverse=True)
            before, count = count, np.zeros(len(key), np.int64)
            np.add.at(count, number, np.concatenate([before, times]))
        # The band that begins with a half, and the one that ends with it, counted together with its neighbour.
        after = np.append(np.where(key[1:] == key[:-1] + 1, count[1:], 0), 0) if len(key) else count
        before = np.append(0, np.where(key[1:] == key[:-1] + 1, count[:-1], 0)) if len(key) else count
        bound = self.bound[key // width]
        band = np.unique(np.concatenate([key[count + after >= bound], key[count + before >= bound] - 1]))
        item = band // width
        return item, (band - item * width) * self.half[item] - shift

    def align(self, chars: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where an item, along its band of diagonals, ends within its budget in a part of one text: number of
        the band, the place after that part, and the edits. All items have halves of one size."""
        slack = int(self.budget[item].max()) + 1
        width = 2 * int(self.half[item[0]]) + 2 * slack
        far = slack + int(self.length[item].max())  # no alignment goes over the end of a text
        column = np.arange(width)[None, :]
        longest = self.length[item].max(initial=0)
        spelled = np.full((len(item), longest + 1), ENDS, np.uint32)
        for k, i in enumerate(item):
            spelled[k, : self.length[i]] = self.items[i]
        start = diagonal[:, None] - slack + column  # the text's place on each diagonal, for the item's first character
        row = np.where((start >= 0) & (start < len(chars)), 0, far)
        hits = []
        for j in range(longest):
            at = start + j
            inside = (at >= 0) & (at < len(chars))
            here = np.where(inside, chars[np.clip(at, 0, len(chars) - 1)], ENDS)
            closed = here == ENDS
            # Along a diagonal; from the diagonal above, which skips the item's character; then within the row,
            # which skips the text's characters.
            new = np.minimum(row + np.where(closed, far, here != spelled[:, j : j + 1]), far)
            new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
            steps = np.cumsum(np.where(closed, far, 1), axis=1)
            row = np.minimum.accumulate(new - steps, axis=1) + steps
            ends = np.flatnonzero(self.length[item] == j + 1)
            if len(ends):
                line, cell = np.nonzero(row[ends] <= self.budget[item[ends]][:, None])
                hits.append((ends[line], start[ends[line], cell] + j + 1, row[ends[line], cell]))
        return tuple(np.concatenate(x) for x in zip(*hits, strict=True))

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int]]]:
        """For each text the items in it, as (number of the item, edits)."""
        found: list[dict[int, int]] = [{} for _ in texts]
        if not self.ids or not texts:
            return [[] for _ in texts]
        chars, starts = normalised([t or "" for t in texts], self.table)
        items, diagonals = self.bands(chars)
        for half in np.unique(self.half[items]):
            of = np.flatnonzero(self.half[items] == half)
            for k in range(0, len(of), ALIGNED):
                item, diagonal = items[of[k : k + ALIGNED]], diagonals[of[k : k + ALIGNED]]
                band, place, edits = self.align(chars, item, diagonal)
                text = np.searchsorted(starts, place - 1, side="right") - 1  # the one that holds the last character
                for t, i, e in zip(text.tolist(), item[band].tolist(), edits.tolist(), strict=True):
                    found[t][i] = min(e, found[t].get(i, e))
        return [sorted(f.items()) for f in found]


def blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The items in lists of about block_chars characters, one list at a time."""
    rows = benchmark.select("item_id", "text").where("text IS NOT NULL")
    total = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(total / block_chars))
    for k in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()]


def find(documents: DataFrame, benchmark: DataFrame, q: int = Q, share: float = SHARE, block_chars: int = 1_000_000) -> DataFrame:
    """documents: text and others. benchmark: item_id, text. Adds n_items, items (the ids found) and
    edits (of each)."""
    kept = [c for c in documents.columns if c not in ADDED]
    kind = f"items array<{dict(benchmark.dtypes)['item_id']}>, edits array<int>"
    table, found = lower_table(), []
    for items in blocks(benchmark, block_chars):
        shared = documents.sparkSession.sparkContext.broadcast(Index(sorted(items, key=str), table, q, share))
        found.append(_searcher(shared, kind)("text"))
    rows = documents.select(*kept, *[f.alias(f"contaminated_{k}") for k, f in enumerate(found)])
    names = range(len(found))
    both = [F.flatten(F.array(*[F.col(f"contaminated_{k}.{name}") for k in names])).alias(name) for name in ("items", "edits")]
    return rows.select(*kept, *both).select(*kept, F.size("items").alias("n_items"), "items", "edits")


def _searcher(shared, kind: str):
    @F.pandas_udf(kind)
    def searched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for texts in batches:
            found, part, size = [], [], 0
            for text in texts:
                part.append(text)
                size += len(text or "")
                if size > SLICE:
                    found += index.search(part)
                    part, size = [], 0
            found += index.search(part)
            yield pd.DataFrame({"items": [[index.ids[i] for i, _ in f] for f in found], "edits": [[e for _, e in f] for f in found]})

    return searched
