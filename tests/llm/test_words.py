"""Phrases, spelling variants and quality scores against brute force, and on odd inputs."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendgrain.llm import collocations, passages, variants
from tests.llm.test_operators import ODD, documents, prose

# --- 11: phrases


def mined(rows, least, longest, top, cover):
    """The contract, word by word."""
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        kept = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        found = []
        for p, a in kept.items():
            inside = any(
                len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in kept.items()
            )
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("least", "cover", "top"), [(2, 100, 50), (3, 60, 10)])
def test_phrases_against_brute_force(spark, monkeypatch, least, cover, top):
    monkeypatch.setattr(collocations, "SLICE", 400)
    r = random.Random(least)
    words = ["a", "b", "A", "cc", "d\x01", "é", "x y", "the", "\x00"]
    rows = [(r.choice(["en", "fr", None, "und"]), "".join(r.choice(words) + r.choice([" "] * 8 + ["\t ", ". ", "\n", ", ", "  "]) for _ in range(r.randint(0, 60)))) for _ in range(120)]
    rows += [("en", None), ("en", ""), (None, " "), ("en", "the cc " * 700), ("fr", "q" * 3000)] + [("en", "one two three four five six")] * 9
    docs = spark.createDataFrame([(i, t, lang, 1) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase long")
    found = collocations.mine(docs, least=least, top=top, cover=cover)
    assert sorted(tuple(x) for x in found.collect()) == mined(rows, least, 5, top, cover)


def test_phrases_on_odd_inputs(spark):
    found = collocations.mine(documents(spark, ODD).withColumnRenamed("n_chars", "n"), least=2)
    assert {x.phrase for x in found.collect()} == {x[2] for x in mined([("en", t) for t in ODD], 2, 5, 2000, 100)}
    assert collocations.mine(documents(spark, [])).count() == 0
    assert collocations.mine(documents(spark, [None, ""])).count() == 0


def test_scores_of_large_counts_are_exact(spark):
    """Products of counts beyond 64 bits."""
    a, n, l, r = 3_000_000_000_017, 900_000_000_000_001, 4_000_000_000_033, 3_500_000_000_011
    one = spark.createDataFrame([(n, a, l, r)], "total long, n long, l long, r long")
    exact = "cast({} as decimal(19,0))".format
    row = one.selectExpr(f"(cast(1000 as decimal(4,0)) * {exact('n')} * {exact('total')}) div ({exact('l')} * {exact('r')}) AS score").first()
    assert row.score == 1000 * a * n // (l * r)


# --- 12: spelling variants


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(rows, slips, shortest, least):
    """The contract, word by word."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= shortest and c >= least}
    around = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(around[w]), n.get(form[w])))
    return sorted(out)


@pytest.mark.parametrize("most", [64_000, 7])
def test_variants_against_brute_force(spark, monkeypatch, most):
    """With few words per index, every bucket is split on both sides."""
    monkeypatch.setattr(variants, "MOST", most)
    monkeypatch.setattr(variants, "CELLS", 300)
    monkeypatch.setattr(variants, "SLICE", 200)
    r = random.Random(most)
    words = ["".join(r.choice("abÀÿ") for _ in range(r.randint(4, 7))) for _ in range(150)] + ["aaaaa", "aaaaaa", "aaaaaaa", "Aabaab"]
    rows = [(r.choice([i, i, None]), " ".join(r.choice(words[: r.choice([10, 150, 154])]) for _ in range(60)) + r.choice(["", "1-2", "Ā"])) for i in range(60)]
    rows += [(1, None), (2, ""), (3, "x" * 5000 + " " + "x" * 4999 + "y"), (4, "x" * 5000 + " " + "x" * 4999 + "y " + "x" * 5000), (5, "x" * 4999 + "y")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n long")
    found = variants.group_variants(variants.word_counts(docs, slips=5), least=2)
    expected = grouped(rows, 5, 5, 2)
    assert sorted(tuple(x) for x in found.collect()) == expected
    assert any(x[4] > 3 for x in expected)


def test_roots_of_chains(spark):
    """Each form leads to the next one, and all to the last."""
    chain = [("w" * (5 + i), 2**i) for i in range(12)]
    found = variants.group_variants(spark.createDataFrame(chain, "word string, n long"), least=1).collect()
    assert {x.word: (x.form, x.root, x.form_n) for x in found} == {
        w: (chain[i + 1][0], chain[-1][0], chain[i + 1][1]) if i < 11 else (None, w, None) for i, (w, _) in enumerate(chain)
    }


def test_variants_of_long_words_and_odd_inputs(spark):
    counts = spark.createDataFrame([("x" * 3000, 9), ("x" * 2999 + "y", 4), ("x" * 3001, 20), (prose(3)[:40].replace(" ", ""), 5)], "word string, n long")
    found = {len(x.word) * (1 if x.word[-1] == "x" else -1): (x.n_near, len(x.root)) for x in variants.group_variants(counts).collect()}
    assert found[3000] == (2, 3001) and found[-3000] == (1, 3001) and found[3001] == (1, 3001)
    assert variants.group_variants(variants.word_counts(documents(spark, []))).count() == 0
    assert variants.group_variants(variants.word_counts(documents(spark, ODD * 3))).where("n < 3").count() == 0


# --- 13: quality by passages


def plain_score(model, text):
    """One passage after another, in plain sums."""
    raw, weights, total = (text or "").encode(), [], 0
    for at in range(0, max(len(raw), 1), passages.PASSAGE):
        w = model.weights
        x = (passages.encode([raw[at : at + passages.PASSAGE]])[0] - model.mean) / model.spread
        h = np.tanh(x @ w["encode"] + w["encode_0"])
        weights.append(np.exp(np.sum(w["weigh"] * np.tanh(h @ w["attend"]) / (1 + np.exp(-h @ w["gate"])))))
        total = total + weights[-1] * (w["out"] @ h)
    return 1 / (1 + np.exp(-(total / sum(weights) + w["out_0"][0])))


def test_gradient_of_the_network():
    r = np.random.default_rng(1)
    x, owner, labels = r.normal(size=(9, 5)), np.array([0, 0, 0, 1, 2, 2, 3, 3, 3]), np.array([0, 1, 1, 0])
    net = passages.Network(np.zeros(5), np.ones(5))
    _, slope = net.gradient(x, owner, labels)
    for name, w in net.weights.items():
        for i in np.ndindex(*w.shape):
            if r.random() < 0.2:
                was, losses = w[i], []
                for d in (1e-5, -1e-5):
                    w[i] = was + d
                    losses.append(net.gradient(x, owner, labels)[0])
                w[i] = was
                assert abs((losses[0] - losses[1]) / 2e-5 - slope[name][i]) < 1e-6, name


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = passages.learn(docs, labels.where("crc32(cast(doc_id as string)) % 5 <> 0"))
    held = passages.score(docs, model).join(labels.where("crc32(cast(doc_id as string)) % 5 = 0"), "doc_id").select("doc_id", "text", "score", "predicted", "quality").collect()
    good, bad = ([x.score for x in held if x.quality == q] for q in (1, 0))
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    right = np.mean([x.predicted == x.quality for x in held])
    assert len(held) > 700 and auc > 0.85 and right > 0.93, (auc, right)
    for x in held[:40]:
        assert abs(plain_score(model, x.text) - x.score) < 1e-9


def test_quality_on_odd_inputs(spark, monkeypatch):
    docs = documents(spark, ODD + ["𝄞" * 900]).withColumn("predicted", F.lit("clash")).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)] + [(None, 1), (3, None), (3, 7), (77, 1), (4, 0)], "doc_id long, quality int")
    model = passages.learn(docs, labels, sample=50)
    found = {x.doc_id: x for x in passages.score(docs, model).collect()}
    assert len(found) == 10 and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in found.values())
    assert found[0].score == found[1].score and found[4].score == found[5].score and found[0].label == 1
    monkeypatch.setattr(passages, "BLOCK", 3)  # sums as they come
    assert all(abs(plain_score(model, x.text) - model.score([x.text])[0]) < 1e-9 for x in found.values())
    for labels_, value in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0)):
        assert {x.score for x in passages.score(docs, passages.learn(docs, labels_)).collect()} == {value}
    assert passages.score(docs.limit(0), model).count() == 0
    assert passages.score(docs, passages.learn(docs.limit(0), labels)).count() == 10
