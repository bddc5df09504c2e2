"""Near-duplicate detection by Order MinHash.

A text's k-mers are runs of three words, each labelled with how often it has occurred before. A sketch
takes the labelled k-mers with the smallest hashes and keeps them in the order of the text, so that two texts
agree in one with a probability that falls with their edit distance; at the edit budget they agree in at least one of
all with 0.95 or more. Texts that agree in a sketch form a bucket. Each text of a bucket meets the bucket's head as a candidate. What heads leave apart is compared
within its bucket by signatures: samples of the words, labelled with how often they have occurred before, whose agreement estimates how
many words two texts share. Texts within the edit budget share 1 - SIMILARITY less than all, and fall short of that in the
sample by DEVIATIONS deviations once in some 30,000 pairs; so texts that have only a common passage in common are no candidates. Signatures are compared
side by side within tasks, of which each holds GROUP texts of a bucket or two parts of a larger one, and candidates are verified there; only links leave them.
A banded alignment of the words verifies each candidate: a link needs at most 1 - SIMILARITY edits per word of the
longer text, so both must be about as long and have enough words in common, which is counted first. An alignment through shared k-mers within the band is tried first; where it needs too many edits, all
alignments are, for one more edit at a time up to that number. Classes are the connected components of the links, and do not
depend on which text was a head.

Equal texts are one node, 64 bits of hash, from the start, so a group of copies of any size costs one sketch.

Defined results: words are what lies between white space, A-Z in lower case. NULL texts count as empty; all empty texts
are equal. A text of fewer than three words is one k-mer. Repeated rows and ids are judged row by row; the class
id is the smallest doc_id in the class, NULL if it has none. An empty table gives no rows. Other columns are not
looked at by `near_duplicates`, and pass through `keep_first`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrain.llm.common import cut, ship
from spendgrain.llm.graph import components

ship(__name__)

K, SIMILARITY = 3, 0.8
#: Words of the k-mers that an alignment is first tried through.
ANCHOR = 3
#: Sketches of a text, and k-mers in each.
SKETCHES, KEPT = 32, 2
#: Cells of a matrix of hashes or alignments that is worked on at a time.
CELLS = 1 << 20
#: Words that are compared at a time where two texts run alike.
RUN = 16
FAR = 1 << 28
#: Bytes of a signature, deviations of its estimate that are allowed for, and texts that are compared within a task, and their words.
BINS, DEVIATIONS, GROUP, GROUP_WORDS = 2048, 4, 2048, 1 << 20


class WordHashes(dict):
    """Words to 64 bits, remembered while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_ids(text: str | None, hashes: WordHashes) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def labelled_kmers(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words and of its number among equal ones, in the order of the text."""
    k = min(k, len(words))
    h = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        h = mixed(h + words[i : i + len(h)])
    order = np.argsort(h, kind="stable")
    run = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
    if len(run) < len(h):
        seen = np.empty(len(h), np.uint64)
        seen[order] = np.arange(len(h)) - np.repeat(run, np.diff(np.append(run, len(h))))
        h = np.where(seen > 0, mixed(h + seen * np.uint64(0xA24BAED4963EE407)), h)
    return h


def sketch_keys(words: np.ndarray, k: int, sketches: int, kept: int) -> np.ndarray:
    """The keys of the buckets that a text falls into, one of each sketch."""
    with np.errstate(over="ignore"):
        h = labelled_kmers(words, k)
        seeds = mixed(np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
        keys = np.empty(sketches, np.uint64)
        step = max(1, CELLS // len(h))
        for at in range(0, sketches, step):
            ranked = mixed(h[None, :] ^ seeds[at : at + step, None])
            if len(h) > kept:
                places = np.sort(np.argpartition(ranked, kept - 1, axis=1)[:, :kept], axis=1)
            else:
                places = np.broadcast_to(np.arange(len(h)), (len(ranked), len(h)))
            key = seeds[at : at + step].copy()
            for i in range(places.shape[1]):
                key = mixed(key + h[places[:, i]])
            keys[at : at + step] = key
        return keys


def aligned(pairs: list[tuple[np.ndarray, np.ndarray]], reach: int) -> np.ndarray:
    """Edits between the words of each pair, if there are at most `reach`; else more than that.
    For one more edit at a time, how many words of a are used up at most on each diagonal (words of b less words of a) that can still be left in time."""
    n = np.array([len(a) for a, _ in pairs])
    m = np.array([len(b) for _, b in pairs])
    edits = np.full(len(pairs), FAR)
    line = np.flatnonzero(np.abs(m - n) <= reach)
    if not len(line):
        return edits
    a = np.zeros((len(pairs), n.max() + RUN), np.uint64)
    b = np.zeros((len(pairs), m.max() + RUN), np.uint64)
    for i, (x, y) in enumerate(pairs):
        a[i, : len(x)], b[i, : len(y)] = x, y
    a, b, n, m = a[line], b[line], n[line], m[line]
    low = -((reach - (m - n)) // 2)  # of the diagonals that are left in time
    diagonal = low[:, None] + np.arange(reach + 1)
    most = np.minimum(n[:, None], m[:, None] - diagonal)
    start, goal = -low, m - n - low
    far = np.full((len(line), reach + 3), -FAR, np.int64)  # a column at either side stays unused
    for e in range(reach + 1):
        left = max(0, start.min() - e, goal.min() - (reach - e))
        right = min(reach, start.max() + e, goal.max() + (reach - e)) + 1
        if e == 0:
            now = np.full((len(far), right - left), -FAR, np.int64)
            now[np.arange(len(far)), start - left] = 0
        else:
            # A word of each is used, or one of b, or one of a.
            now = np.maximum(np.maximum(far[:, left + 1 : right + 1], far[:, left + 2 : right + 2]) + 1, far[:, left:right])
            now = np.minimum(now, most[:, left:right])
        off = diagonal[:, left:right]
        # Where the texts run alike, no edit is used: first a word, then more and more at a time.
        cell = np.flatnonzero((now >= 0) & (now + off >= 0) & (now < most[:, left:right]))
        row = cell // now.shape[1]
        at = now.ravel()[cell]
        in_a = row * a.shape[1] + at
        in_b = row * b.shape[1] + at + off.ravel()[cell]
        room = most[:, left:right].ravel()[cell] - at
        width, ends = 1, now.ravel()
        while len(cell):
            if width == 1:
                run = (a.ravel()[in_a] == b.ravel()[in_b]).astype(np.int64)
            else:
                steps = np.arange(width)
                differ = a.ravel()[in_a[:, None] + steps] != b.ravel()[in_b[:, None] + steps]
                run = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), width), room)
            ends[cell] += run
            on = np.flatnonzero((run == width) & (room > width))
            cell, in_a, in_b, room, width = cell[on], in_a[on] + width, in_b[on] + width, room[on] - width, min(RUN, width * 2)
        far[:, left + 1 : right + 1] = now
        done = (far[np.arange(len(far)), goal + 1] >= n) & (edits[line] == FAR)
        edits[line[done]] = e
        open_ = edits[line] == FAR
        if not open_.any():
            break
        if open_.sum() * 2 <= len(line):
            line, a, b, n, m, diagonal, most, start, goal, far = (x[open_] for x in (line, a, b, n, m, diagonal, most, start, goal, far))
    return edits


class Sorted:
    """The labelled words and k-mers of texts in the order of their hashes, worked out once for each array of words."""

    def __init__(self) -> None:
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def kmers(self, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the labelled k-mers, smallest first, and their places. Texts of fewer than k words have none."""
        kept = self.found.get((id(words), k))
        if kept is None:
            with np.errstate(over="ignore"):
                h = labelled_kmers(words, k) if len(words) >= k else np.zeros(0, np.uint64)
            places = np.argsort(h)
            # The array stays with its id, so that no other one can take that.
            kept = self.found[id(words), k] = (h[places], places, words)
        return kept[:2]

    def both(self, a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of the k-mers that both have, in each."""
        (x, at_x), (y, at_y) = self.kmers(a, k), self.kmers(b, k)
        if not len(x):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(x, y)
        at[at == len(x)] = 0
        same = x[at] == y
        return at_x[at[same]], at_y[same]


def anchored(a: np.ndarray, b: np.ndarray, reach: int, known: Sorted) -> int:
    """Edits of the alignment through the k-mers that both have, in order and on diagonals within reach:
    no fewer than the fewest possible."""
    if min(len(a), len(b)) < ANCHOR:
        return max(len(a), len(b))
    at_a, at_b = known.both(a, b, ANCHOR)
    order = np.argsort(at_a)
    at_a, at_b = at_a[order], at_b[order]
    near = np.abs(at_b - at_a) <= reach
    at_a, at_b = at_a[near], at_b[near]
    highest = np.maximum.accumulate(np.append(-1, at_b))
    rising = at_b > highest[:-1]
    at_a, at_b = at_a[rising], at_b[rising]
    if not len(at_a):
        return max(len(a), len(b))
    # Words between two anchors are replaced, and added or left out; anchors may overlap.
    step_a, step_b = np.diff(at_a), np.diff(at_b)
    between = np.maximum(step_a, step_b) - np.minimum(ANCHOR, np.minimum(step_a, step_b))
    ends = max(at_a[0], at_b[0]) + max(len(a) - at_a[-1], len(b) - at_b[-1]) - ANCHOR
    return int(between.sum() + ends)


def linked(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float, known: Sorted | None = None) -> np.ndarray:
    """Whether the words of each pair align with at most (1 - similarity) edits per word of the longer one."""
    known = known or Sorted()
    longest = np.array([max(len(a), len(b)) for a, b in pairs])
    budget = ((1 - similarity) * longest + 1e-9).astype(np.int64)
    found = np.zeros(len(pairs), bool)
    open_pairs = {}
    for i, (a, b) in enumerate(pairs):
        if abs(len(a) - len(b)) > budget[i]:
            continue
        if len(known.both(a, b, 1)[0]) < longest[i] - budget[i]:
            continue  # words in common are too few, whatever their order
        if anchored(a, b, int(budget[i]), known) <= budget[i]:
            found[i] = True
            continue
        same = min(len(a), len(b))
        differ = np.flatnonzero(a[:same] != b[:same])
        head = int(differ[0]) if len(differ) else same
        a, b = a[head:], b[head:]
        same = min(len(a), len(b))
        differ = np.flatnonzero(a[::-1][:same] != b[::-1][:same])
        tail = int(differ[0]) if len(differ) else same
        open_pairs[i] = (a[: len(a) - tail], b[: len(b) - tail])
    # Pairs with as good as the same budget are aligned together.
    order = sorted(open_pairs, key=lambda i: (budget[i], len(open_pairs[i][0])))
    while order:
        part = [order.pop()]
        reach = int(budget[part[0]])
        cells = 4 * (reach + RUN) + 2 * len(open_pairs[part[0]][0])
        while order and (len(part) + 1) * cells <= CELLS // 4 and budget[order[-1]] * 1.25 >= reach:
            part.append(order.pop())
        found[part] = aligned([open_pairs[i] for i in part], reach) <= budget[part]
    return found


def _noded(documents: DataFrame) -> DataFrame:
    return documents.withColumn("omh_node", F.xxhash64(F.coalesce("text", F.lit(""))))


def sketch_rows(noded: DataFrame, k: int, sketches: int, kept: int) -> DataFrame:
    """omh_node, words, keys: of each different text the number of words and the bucket in each sketch."""

    def sketched(batches):
        hashes = WordHashes()
        for batch in batches:
            nodes, sizes, keys = [], [], []
            for node, text in zip(batch["omh_node"], batch["text"], strict=True):
                if len(ids := word_ids(text, hashes)):
                    nodes.append(node)
                    sizes.append(len(ids))
                    keys.append(sketch_keys(ids, k, sketches, kept).view(np.int64))
            yield pd.DataFrame({"omh_node": np.array(nodes, np.int64), "words": np.array(sizes, np.int64), "keys": pd.Series(keys, dtype=object)})

    rows = noded.select("omh_node", "text").mapInPandas(sketched, "omh_node long, words long, keys array<long>")
    return cut(rows.dropDuplicates(["omh_node"]))


def texts_of(noded: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text: each of the nodes once. Of equal texts only one is sent, that of the smallest doc_id."""
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id")
    homes = noded.groupBy(F.col("omh_node").alias("node")).agg(F.min(place).alias("home")).join(nodes, "node", "left_semi")
    homes = homes.select("node", F.col("home.doc_id").alias("home"))
    texts = noded.join(homes, (F.col("omh_node") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("home")))
    return cut(texts.select("node", "text").dropDuplicates(["node"]))


def confirmed(texts: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs a, b that a banded alignment confirms."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def verified(batches):
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                # A head meets many texts; its words are looked up once.
                ids: dict[int, np.ndarray] = {}
                for node, text in ("a", "text_a"), ("b", "text_b"):
                    for n, t in zip(part[node], part[text], strict=True):
                        if n not in ids:
                            ids[n] = word_ids(t, hashes)
                pairs = [(ids[x], ids[y]) for x, y in zip(part["a"], part["b"], strict=True)]
                yield part.loc[linked(pairs, similarity), ["a", "b"]]

    return both.select("a", "b", "text_a", "text_b").mapInPandas(verified, "a long, b long")


def _labelled(rows: DataFrame, joined: DataFrame, node: str, label: str) -> DataFrame:
    """rows with the component of a node as `label`."""
    of = joined.select(F.col("node").alias(node), F.col("component").alias(label))
    return rows.join(of, node, "left").withColumn(label, F.coalesce(label, node))


def signature(words: np.ndarray) -> np.ndarray:
    """BINS bytes: the labelled words fall into bins by their hashes, and 8 bits of the smallest one stand for the bin; 0 is an empty one."""
    with np.errstate(over="ignore"):
        h = mixed(labelled_kmers(words, 1))
    least = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    bins = (h >> np.uint64(40)) % np.uint64(BINS)
    np.minimum.at(least, bins.astype(np.int64), h & np.uint64((1 << 40) - 1))
    filled = least != np.iinfo(np.uint64).max
    return np.where(filled, least % np.uint64(255) + np.uint64(1), 0).astype(np.uint8)


def alike(own: np.ndarray, others: np.ndarray, words: int, sizes: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether signatures of texts of those sizes (in words) may be of texts within the edit budget of the one of `own`; and which
    share of the filled bins agree."""
    share = similarity / (2 - similarity)  # of all words of two texts, those that both have, at least
    filled = ((others > 0) | (own > 0)).sum(axis=1)
    same = ((others == own) & (own > 0)).sum(axis=1)
    # The filled bins are a sample, without repeats, of the words of both.
    every = np.maximum((words + sizes) / (1 + share), 2)
    deviation = np.sqrt(share * (1 - share) * filled * np.clip((every - filled) / (every - 1), 0.02, 1))
    fits = np.minimum(words, sizes) >= similarity * np.maximum(words, sizes) - 1e-9
    return fits & (same >= share * filled - DEVIATIONS * deviation - 1), same / np.maximum(filled, 1)


def signatures(texts: DataFrame) -> DataFrame:
    """node, text and signature of each text."""

    def signed(batches):
        hashes = WordHashes()
        for batch in batches:
            found = [signature(word_ids(text, hashes)).tobytes() for text in batch["text"]]
            yield batch.assign(signature=pd.Series(found, index=batch.index, dtype=object))

    return texts.select("node", "text").mapInPandas(signed, "node long, text string, signature binary")


class TextIds(dict):
    """Nodes to the words of their texts, looked up for those that are asked for."""

    def __init__(self, nodes: pd.Series, texts: pd.Series, hashes: WordHashes) -> None:
        self.texts, self.hashes = dict(zip(nodes, texts, strict=True)), hashes

    def __missing__(self, node: int) -> np.ndarray:
        found = self[node] = word_ids(self.texts[node], self.hashes)
        return found


def links_within(rows: pd.DataFrame, ids: TextIds, similarity: float, known: Sorted) -> np.ndarray:
    """rows: node, component, part, words (their number), signature and keys of one bucket, or of two parts of it, and its number among the sketches.
    Links between nodes of different components, of different parts where there are two, that meet in no bucket of a sketch before. Once two
    components are linked, no more pairs of theirs are aligned; the most alike ones come first."""
    node, component, part = (rows[c].to_numpy() for c in ("node", "component", "part"))
    before = np.stack(rows["keys"].to_list())[:, : int(rows["sketch"].iloc[0])]
    words, signed = rows["words"].to_numpy(), np.frombuffer(b"".join(rows["signature"]), np.uint8).reshape(-1, BINS)
    found, shares, parts = [np.zeros((0, 2), np.int64)], [np.zeros(0)], part.min() != part.max()
    for i in range(len(rows) - 1):
        open_ = component[i + 1 :] != component[i]
        if parts:
            open_ &= part[i + 1 :] != part[i]
        others = np.flatnonzero(open_) + i + 1
        if len(others):
            others = others[~(before[others] == before[i]).any(axis=1)]
            kept, share = alike(signed[i], signed[others], words[i], words[others], similarity)
            near = others[kept]
            found.append(np.stack([np.full(len(near), i), near], axis=1))
            shares.append(share[kept])
    if not any(map(len, found)):
        return found[0]
    pairs = np.concatenate(found)[np.argsort(-np.concatenate(shares), kind="stable")]
    ends = np.sort(component[pairs], axis=1)
    between = np.unique(ends, axis=0, return_inverse=True)[1].reshape(-1)
    links, step = [np.zeros((0, 2), np.int64)], 1
    while len(pairs):
        # The next `step` pairs of each two components.
        order = np.argsort(between, kind="stable")
        first = np.flatnonzero(np.diff(between[order], prepend=-1))
        place = np.empty(len(pairs), np.int64)
        place[order] = np.arange(len(pairs)) - np.repeat(first, np.diff(np.append(first, len(pairs))))
        now = np.flatnonzero(place < step)
        is_link = np.concatenate([linked([(ids[node[i]], ids[node[j]]) for i, j in pairs[part]], similarity, known) for part in np.split(now, range(500, len(now), 500))])
        # One link of two components is enough.
        done, at = np.unique(between[now[is_link]], return_index=True)
        links.append(node[pairs[now[is_link][at]]])
        left = (place >= step) & ~np.isin(between, done)
        pairs, between, step = pairs[left], between[left], step * 2
    return np.concatenate(links)


def open_pairs(shared: DataFrame, joined: DataFrame, texts: DataFrame, sketched: DataFrame, similarity: float) -> DataFrame:
    """a, b: links between different components among the texts of buckets that still hold several of them.

    A bucket of more than GROUP texts, or GROUP_WORDS words, is dealt out in parts, and each two parts meet in one group."""
    sketched = sketched.withColumnRenamed("omh_node", "node")
    members = _labelled(shared.select("key", "sketch", "node"), joined, "node", "component").join(sketched.select("node", "words"), "node")
    several = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"), F.sum("words").alias("all_words")).where("low <> high")
    parts = F.greatest(F.ceil(F.col("n") / GROUP), F.ceil(F.col("all_words") / GROUP_WORDS))
    rows = members.join(several.select("key", F.least(parts, "n").alias("parts")), "key")
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    met = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    placed = rows.select("key", "sketch", "node", "component", "words", part.alias("part"), met.alias("met"))
    placed = cut(placed.select("key", "sketch", "node", "component", "words", "part", F.least("part", "met").alias("low"), F.greatest("part", "met").alias("high")))
    # Many small buckets share a task's group; a large one has as good as its own.
    n, words = placed.agg(F.count("*"), F.coalesce(F.sum("words"), F.lit(0))).first()
    groups = max(1, n // GROUP, words // GROUP_WORDS)
    signed = signatures(texts.join(placed.select("node").distinct(), "node", "left_semi")).join(sketched.select("node", "keys"), "node")
    dealt = placed.withColumn("dealt", F.pmod(F.xxhash64("key", "low", "high"), F.lit(groups))).join(signed, "node")
    hashes = WordHashes()

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        ids, known = TextIds(rows["node"], rows["text"], hashes), Sorted()
        found = [np.zeros((0, 2), np.int64)]
        found += [links_within(one, ids, similarity, known) for _, one in rows.groupby(["key", "low", "high"]) if len(one) > 1]
        pairs = np.concatenate(found)
        return pd.DataFrame({"a": pairs.max(axis=1, initial=np.iinfo(np.int64).min), "b": pairs.min(axis=1, initial=np.iinfo(np.int64).max)})

    # A group is work enough for a task, however few bytes it has.
    return dealt.repartition(groups, "dealt").groupBy("dealt").applyInPandas(compared, "a long, b long")


def links(noded: DataFrame, sketched: DataFrame, similarity: float) -> DataFrame:
    """a, b: links that join all texts within the edit budget that share a bucket.

    Each text of a bucket meets the bucket's head, the text that shares most buckets with others. Then whatever
    that has not joined is compared, so that no link depends on which text was a head."""
    rows = sketched.select("omh_node", "words", F.posexplode("keys").alias("sketch", "key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(rows.join(sizes, "key").select("key", "sketch", F.col("omh_node").alias("node"), "words", "n"))
    degrees = shared.groupBy("node").agg((-F.sum("n")).alias("order"))
    texts = texts_of(noded, degrees)
    heads = shared.join(degrees, "node").groupBy("key").agg(F.min(F.struct("order", "node", "words")).alias("head"))
    pairs = shared.join(heads, "key").where(F.col("node") != F.col("head.node"))
    # Texts of too different lengths are not sent.
    longest, apart = F.greatest("words", "head.words"), F.abs(F.col("words") - F.col("head.words"))
    pairs = pairs.where(apart <= F.floor(F.lit(1 - similarity) * longest + F.lit(1e-9)))
    pairs = pairs.select(F.col("node").alias("a"), F.col("head.node").alias("b")).distinct()
    joined = components(confirmed(texts, cut(pairs), similarity))
    return _as_links(joined).unionByName(open_pairs(shared, joined, texts, sketched, similarity))


def _as_links(joined: DataFrame) -> DataFrame:
    return joined.select(F.col("node").alias("a"), F.col("component").alias("b"))


def classes(documents: DataFrame, similarity: float = SIMILARITY, k: int = K, sketches: int = SKETCHES, kept: int = KEPT) -> DataFrame:
    """omh_node, component, class_id and class_size of each different text."""
    noded = _noded(documents.select("doc_id", "text"))
    joined = components(links(noded, sketch_rows(noded, k, sketches, kept), similarity))
    nodes = noded.groupBy("omh_node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    nodes = nodes.join(joined, F.col("omh_node") == F.col("node"), "left").select("omh_node", "least", "n", F.coalesce("component", "omh_node").alias("component"))
    nodes = cut(nodes)
    whole = nodes.groupBy("component").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"))
    return nodes.join(whole, "component").select("omh_node", "component", "class_id", "class_size")


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Returns doc_id, class_id and class_size (rows in the class) for each row."""
    found = classes(documents, similarity)
    rows = _noded(documents.select("doc_id", "text")).drop("text")
    return rows.join(found, "omh_node").select("doc_id", "class_id", "class_size")


def keep_first(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near duplicates: of each class the row with the smallest doc_id; of several
    such rows, the one with the smallest hash of its text and then of its columns."""
    found = cut(classes(documents, similarity).select(F.col("omh_node").alias("in_node"), "component"))
    rows = _noded(documents).withColumn("omh_row", F.xxhash64(*documents.columns))
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "omh_node", "omh_row")
    small = rows.select("doc_id", "omh_node", "omh_row").join(found, F.col("omh_node") == F.col("in_node"))
    first = small.groupBy("component").agg(F.min(place).alias("first")).select(
        F.col("first.omh_node").alias("first_node"), F.col("first.omh_row").alias("first_row")
    )
    kept = rows.join(first, (F.col("omh_node") == F.col("first_node")) & (F.col("omh_row") == F.col("first_row")), "left_semi")
    return kept.dropDuplicates(["omh_node", "omh_row"]).select(*documents.columns)
