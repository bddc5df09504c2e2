"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of a sample of labelled text knows every substring of it. A text is
cut greedily into the longest phrases that the automaton knows; the language whose automaton needs the
fewest phrases per character wins. Texts are parsed whole, in pieces of fixed length side by side, all
languages at once; a phrase ends at the end of a piece.

The sample is bounded: for each language, pieces of SAMPLE_PIECE characters from at most SAMPLE_ROWS
documents, those with the smallest hashes, and at most `chars` characters in all, with every letter that they have. The model that is broadcast
holds some 50,000 transitions of 16 bytes per language at most (100 languages: 80 MB), or DENSE cells of 4 bytes where few letters allow it.

Defined results: letters count in lower case; everything else counts as one space. A NULL text, or one
without a letter, is `und` with score 0. Ties go to the language with more labelled rows, then by name.
Without labelled text every language is `und`. Documents are judged row by row, so repeated rows and ids
don't matter; an empty table gives no rows. Other columns pass through `predict`, except lang_pred and score,
which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendgrain.llm.common import ship

ship(__name__)

SAMPLE_ROWS, SAMPLE_PIECE = 64, 256
#: Symbols that a text is parsed in at a time, and characters of texts that are worked on at a time.
PIECE, SLICE = 2048, 1_000_000
SPACE = 0
#: Cells of all languages' tables together; beyond that their transitions are looked up by a search.
DENSE = 16_000_000


def labelled_sample(labelled: DataFrame, seed: int = 10) -> DataFrame:
    """labelled: text, lang. Returns lang, rank, n_rows (labelled rows of the language) and piece, from a
    random place of the text."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND lang <> 'und'")
    h = F.xxhash64(F.lit(seed), "text")
    by_hash = Window.partitionBy("lang").orderBy("h")
    # Spark limits the rank in each task before the shuffle, so a language with most rows is no hot key.
    chosen = rows.select("lang", h.alias("h")).withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= SAMPLE_ROWS)
    chosen = chosen.groupBy("lang", "h").agg(F.min("rank").alias("rank"))
    counted = rows.groupBy("lang").agg(F.count("*").alias("n_rows"))
    start = F.pmod(F.col("h"), F.greatest(F.length("text") - SAMPLE_PIECE, F.lit(0)) + 1).cast("int") + 1
    # At most SAMPLE_ROWS rows per language go to the texts.
    pieces = rows.select("lang", "text", h.alias("h")).join(F.broadcast(chosen), ["lang", "h"]).withColumn("piece", F.substr("text", start, F.lit(SAMPLE_PIECE)))
    return pieces.groupBy("lang", "rank").agg(F.min("piece").alias("piece")).join(counted, "lang")


def automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads every substring of the text, from state 0."""
    to, link, length, last = [{}], [-1], [0], 0
    for symbol in text:
        new = len(to)
        to.append({})
        link.append(0)
        length.append(length[last] + 1)
        at, last = last, new
        while at >= 0 and symbol not in to[at]:
            to[at][symbol] = new
            at = link[at]
        if at < 0:
            continue
        after = to[at][symbol]
        if length[after] == length[at] + 1:
            link[new] = after
            continue
        copy = len(to)
        to.append(dict(to[after]))
        link.append(link[after])
        length.append(length[at] + 1)
        while at >= 0 and to[at].get(symbol) == after:
            to[at][symbol] = copy
            at = link[at]
        link[after] = link[new] = copy
    return to


class Table:
    """One language's transitions. `local` turns symbols into this language's own; the next state comes as an offset, or, where the phrase
    ends, as -1 minus the state that the next phrase begins with."""

    def __init__(self, text: list[int], n_symbols: int) -> None:
        """text: symbols; all of them are below n_symbols."""
        own = sorted(set(text) - {SPACE})
        self.local = np.full(n_symbols, len(own) + 1, np.int32)  # symbols that the sample doesn't have
        self.local[SPACE] = SPACE
        self.local[own] = np.arange(1, len(own) + 1)
        self.width = len(own) + 2
        to = automaton(self.local[text].tolist())
        # One state more, in which the next phrase has yet to begin: at first, and after an unknown symbol.
        self.states, self.start = len(to) + 1, len(to) * self.width
        self.ends = np.full(self.width, -1 - self.start, np.int64)
        for symbol, state in to[0].items():
            self.ends[symbol] = -1 - state * self.width
        keys = [(state * self.width + symbol, after * self.width) for state, reached in enumerate(to) for symbol, after in reached.items()]
        self.keys, self.after = np.array(sorted(keys), np.int64).reshape(-1, 2).T.copy()
        self.cells = None

    def spread(self) -> None:
        """As an array of all states and symbols."""
        self.cells = np.tile(self.ends, self.states).astype(np.int32)
        self.cells[self.keys] = self.after

    def step(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        own = self.local[symbols]
        if self.cells is not None:
            return self.cells[state + own]
        if not len(self.keys):
            return self.ends[own]
        key = state + own
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.after[at], self.ends[own])


class Model:
    """Symbols of characters, and a table of transitions per language. Every letter of the samples is a symbol."""

    def __init__(self, sample: list[tuple[str, str, int]], chars: int) -> None:
        """sample: lang, text, number of labelled rows."""
        by_rows = sorted({(-n, lang) for lang, _, n in sample})
        self.langs = list(dict.fromkeys(lang for _, lang in by_rows))
        texts = {lang: " ".join(" ".join(p.lower() for other, p, _ in sample if other == lang).split())[:chars] for lang in self.langs}
        letters = sorted({c for t in texts.values() for c in t if c.isalpha()})
        symbols = {c: i + 1 for i, c in enumerate(letters)}
        unknown = len(letters) + 1
        self.symbols = np.zeros(0x110000, np.int32)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                self.symbols[code] = symbols.get(c.lower(), unknown)
        spaced = {lang: "".join(c if c.isalpha() else " " for c in t) for lang, t in texts.items()}
        self.tables = [Table([symbols.get(c, SPACE) for c in " ".join(spaced[lang].split())], unknown + 1) for lang in self.langs]
        if sum(t.states * t.width for t in self.tables) <= DENSE:
            for table in self.tables:
                table.spread()

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text and language the number of phrases; for each text its symbols and whether it has a letter."""
        codes = self.symbols[np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        ends = np.cumsum([len(t) + 1 for t in texts])
        keep = codes != SPACE
        letters = np.concatenate(([0], np.cumsum(keep)))[np.concatenate(([0], ends))]
        keep[:-1] |= codes[1:] != SPACE  # a space stays before a letter of the same text
        keep[ends - 1] = False
        kept = np.concatenate(([0], np.cumsum(keep)))[np.concatenate(([0], ends))]
        symbols, sizes = codes[keep], np.diff(kept)
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = kept[:-1][owner] + place * PIECE
        length = np.minimum(sizes[owner] - place * PIECE, PIECE)
        order = np.argsort(-length, kind="stable")
        owner, start, length = owner[order], start[order], length[order]
        state = np.array([[table.start] * len(owner) for table in self.tables], np.int64)
        count = np.zeros((len(self.langs), len(owner)), np.int32)
        open_at = np.searchsorted(-length, -np.arange(PIECE), side="left")
        for t in range(int(length.max(initial=0))):
            n = open_at[t]
            symbol = symbols[start[:n] + t]
            for l, table in enumerate(self.tables):
                after = table.step(state[l, :n], symbol)
                ended = after < 0
                count[l, :n] += ended
                state[l, :n] = np.where(ended, ~after, after)
        totals = np.zeros((len(texts), len(self.langs)), np.int64)
        for l in range(len(self.langs)):
            totals[:, l] = np.bincount(owner, count[l], len(texts))
        return totals, sizes, np.diff(letters) > 0

    def judge(self, texts: list[str | None]) -> pd.DataFrame:
        langs, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
        if self.langs and texts:
            totals, sizes, spoken = self.phrases([t or "" for t in texts])
            best = totals.argmin(axis=1)
            ordered = np.sort(totals, axis=1)
            second = ordered[:, 1] if len(self.langs) > 1 else ordered[:, 0] * 0 + sizes + 1
            langs[spoken] = np.array(self.langs, object)[best[spoken]]
            scores[spoken] = 1 - ordered[spoken, 0] / np.maximum(second[spoken], 1)
        return pd.DataFrame({"lang_pred": langs, "score": np.clip(scores, 0, 1)})


def learn(labelled: DataFrame, chars: int = 16_384) -> Model:
    """labelled: text, lang. The sample that reaches the driver has at most SAMPLE_ROWS pieces per language."""
    rows = sorted(labelled_sample(labelled).collect(), key=lambda r: (r["lang"], r["rank"]))
    return Model([(r["lang"], r["piece"], r["n_rows"]) for r in rows], chars)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with lang_pred and score: how far the second best language is behind, 0 to 1."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts, part, size = [], [], 0
            for text in texts:
                part.append(text)
                size += len(text or "")
                if size > SLICE:
                    parts.append(shared.value.judge(part))
                    part, size = [], 0
            yield pd.concat([*parts, shared.value.judge(part)], ignore_index=True)

    kept = [c for c in documents.columns if c not in ("lang_pred", "score")]
    rows = documents.select(*kept, judged("text").alias("language_found"))
    return rows.select(*kept, "language_found.lang_pred", "language_found.score")
