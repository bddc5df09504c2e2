"""Substring dedup by sliding sentence spans.

A text is cut into sentences, and a sentence of more than LONG words further after words chosen by their
hash, so that the same passage is cut alike wherever it stands. From each sentence starts a span: the shortest run of at least
`sentences` consecutive sentences with at least `words` words. All spans of all documents are hashed and
joined: where a span occurs more than once, its first occurrence (by doc_id, then by place) stays, and
the sentences that any later one covers are removed.

Only hashes and places are shuffled to find repeated spans; they are counted before the shuffle, and the join
that follows has one row per hash on one side, so that a span that very many documents share can be
split by Spark.

Defined results: NULL and empty texts have no sentences and stay as they are. NULL ids come last. Rows with the
same id and text are one document: its repeats are no repeats of spans, and each row gets the same result.
Sentences are compared by their words in order, whatever the space between them. An empty table gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrain.llm.common import ship

ship(__name__)

#: After a full stop, question or exclamation mark before space, and after a line feed.
BREAK = re.compile(r"(?<=[.!?])(?=\s)|(?<=\n)")
#: Words with the space before them, and the space at the end.
PARTS = re.compile(r"\s*\S+|\s+$")
#: Words of a sentence that is not cut further, and the mean number of words of the parts of a longer one.
LONG, MEAN = 30, 8


def _short(piece: str, said: list[str]) -> list[str]:
    if len(said) <= LONG:
        return [piece]
    found, part, n = [], [], 0
    for word in PARTS.findall(piece):
        part.append(word)
        n += 1
        if n >= LONG or zlib.crc32(word.strip().encode("utf-8", "surrogatepass")) % MEAN == 0:
            found.append("".join(part))
            part, n = [], 0
    return found + ["".join(part)] * bool(part)


def sentences_of(text: str) -> list[list]:
    """[piece of the text, its words]; the pieces make up the text. Empty ones belong to the sentence before."""
    found: list[list] = []
    for sentence in BREAK.split(text):
        for piece in _short(sentence, sentence.split()):
            said = piece.split()
            if said or not found:
                found.append([piece, said])
            else:
                found[-1][0] += piece
    return found


def spans_of(text: str, sentences: int, words: int) -> list[tuple[int, int, bytes]]:
    """(first sentence, number of sentences, hash) of the span from each sentence that has one."""
    said = [s for _, s in sentences_of(text)]
    joined = [" ".join(s) for s in said]
    found, end, total = [], 0, 0
    for i in range(len(said)):
        while end < len(said) and (end < i + sentences or total < words):
            total += len(said[end])
            end += 1
        if end - i < sentences or total < words:
            break
        found.append((i, end - i, xxhash.xxh3_128_digest("\n".join(joined[i:end]))))
        total -= len(said[i])
    return found


def without(text: str, covered: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the covered sentences, their number, and the number of all."""
    pieces = sentences_of(text)
    gone = np.zeros(len(pieces), bool)
    for start, n in covered:
        gone[start : start + n] = True
    return "".join(p for (p, _), g in zip(pieces, gone, strict=True) if not g), int(gone.sum()), sum(bool(s) for _, s in pieces)


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))


def repeated_spans(documents: DataFrame, sentences: int = 2, words: int = 20) -> DataFrame:
    """doc_id, text_hash, first, n: the spans that occur elsewhere before."""
    keyed = _keyed(documents)
    id_type = dict(keyed.dtypes)["doc_id"]

    def hashed(batches):
        for batch in batches:
            rows = [
                (doc_id, text_hash, first, n, digest)
                for doc_id, text_hash, text in zip(batch["doc_id"], batch["text_hash"], batch["text"], strict=True)
                if text
                for first, n, digest in spans_of(text, sentences, words)
            ]
            ids, texts, first, n, digests = zip(*rows, strict=True) if rows else ((),) * 5
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pd.DataFrame({"doc_id": pd.Series(ids, dtype=object), "text_hash": np.array(texts, np.int64), "first": np.array(first, np.int32), "n": np.array(n, np.int32), "h1": halves[:, 0], "h2": halves[:, 1]})

    spans = keyed.where("text <> ''").mapInPandas(hashed, f"doc_id {id_type}, text_hash long, first int, n int, h1 long, h2 long")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", "first")
    seen = spans.groupBy("h1", "h2").agg(F.min(place).alias("home"), F.max(place).alias("last")).where("home <> last")
    found = spans.join(seen.drop("last"), ["h1", "h2"]).where(place != F.col("home"))
    return found.select("doc_id", "text_hash", "first", "n")


def dedup_spans(documents: DataFrame, sentences: int = 2, words: int = 20) -> DataFrame:
    """Returns doc_id, n_sentences, n_removed and text, what is left of it, for each row."""
    found = repeated_spans(documents, sentences, words)
    covered = found.groupBy(F.col("doc_id").alias("in_id"), F.col("text_hash").alias("in_hash")).agg(
        F.collect_set(F.struct("first", "n")).alias("covered")
    )
    keyed = _keyed(documents)
    rows = keyed.join(covered, keyed["doc_id"].eqNullSafe(F.col("in_id")) & (F.col("text_hash") == F.col("in_hash")), "left")
    id_type = dict(keyed.dtypes)["doc_id"]

    def cleaned(batches):
        for batch in batches:
            out = [
                (None, 0, 0) if text is None else without(text, [(s["first"], s["n"]) for s in (spans if spans is not None else ())])
                for text, spans in zip(batch["text"], batch["covered"], strict=True)
            ]
            texts, removed, total = zip(*out, strict=True) if out else ((),) * 3
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_sentences": np.array(total, np.int32), "n_removed": np.array(removed, np.int32), "text": pd.Series(texts, dtype=object)})

    return rows.select("doc_id", "text", "covered").mapInPandas(cleaned, f"doc_id {id_type}, n_sentences int, n_removed int, text string")
