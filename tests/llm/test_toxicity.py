"""Subword rows, folded scores and the bounds of the training sample, against plain loops."""

import random
import subprocess
import sys

import numpy as np
import pytest

from msgflow.llm import toxicity as t

MASK = 2**64 - 1


def plain_rows(word):
    """Rows of a word by plain whole numbers, one n-gram after the other."""

    def mix(x):
        for _ in range(2):
            x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & MASK
        return x ^ (x >> 32)

    marked = [ord(c) for c in f"<{word}>"]
    rows = []
    for n in range(t.SHORTEST, t.LONGEST + 1):
        for i in range(len(marked) - n + 1):
            h = sum(c * int(f) for c, f in zip(marked[i : i + n], t.FACTORS)) & MASK
            rows.append(mix(h + n & MASK) >> int(t.SHIFT))
    whole = sum(c * pow(t.POWER, i, 1 << 64) for i, c in enumerate(marked)) & MASK
    return sorted([*rows, mix(whole) >> int(t.SHIFT)])


def rows_of(words):
    out = [[] for _ in words]
    for number, rows in t.subwords(words):
        for w, r in zip(number.tolist(), rows.tolist()):
            out[w].append(r)
    return [sorted(r) for r in out]


@pytest.mark.parametrize("size", [t.SLICE, 64, 16])
def test_subwords_equal_a_loop(monkeypatch, size):
    monkeypatch.setattr(t, "SLICE", size)
    rng = random.Random(size)
    words = ["a", "ab", "x" * 500, "é漢🙂", "_1"] + ["".join(rng.choices("abcé漢", k=rng.randint(1, 90))) for _ in range(120)]
    assert rows_of(words) == [plain_rows(w) for w in words]
    folded = np.random.default_rng(1).normal(0, 1, t.BUCKETS).astype(np.float32)
    sums, counts = t.weigh(words, folded)
    assert counts.tolist() == [len(plain_rows(w)) for w in words]
    assert np.allclose(sums, [folded[plain_rows(w)].sum(dtype=np.float64) for w in words])


def corpus(n, seed):
    rng = random.Random(seed)
    plain = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "river", "stone", "window"]
    rude = ["numbskull", "blockhead", "scoundrel", "grobian"]
    texts, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=40)
        if i % 4 == 0:
            words[5:5] = rng.choices(rude, k=3)
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_score_is_the_softmax_over_averaged_embeddings():
    texts, labels = corpus(200, 1)
    model = t.train(texts, labels)
    scorer = t.Scorer(*model.folded())
    vectors = np.zeros((t.BUCKETS, t.WIDTH))
    vectors[model.used] = model.table
    some = [*texts[:30], "", "unknown words, Numbskull!", "a  b\nc", "scoundrel"]
    for _ in range(2):  # computed, and from what was kept
        for text, odds in zip(some, scorer.odds(some)):
            rows = [r for w in t.words_of(text) for r in plain_rows(w)]
            mean = vectors[rows].sum(axis=0) * t.SCALE / max(1, len(rows))
            logits = mean @ model.soft + model.bias
            p = np.exp(logits - logits.max())
            assert abs(p[1] / p.sum() - 1 / (1 + np.exp(-odds))) < 1e-5


def test_unseen_misspellings_share_the_vectors():
    texts, labels = corpus(300, 2)
    scorer = t.Scorer(*t.train(texts, labels).folded())
    plain = "alpha beta gamma delta river stone " * 5
    for word in ("numbskul", "nuumbskull", "blokhead", "blockheads", "scoundrell", "xgrobian"):
        assert word not in " ".join(texts).split()
        toxic, clean = scorer.odds([f"{plain}{word} {word} {word}", plain])
        assert toxic > 0 > clean, word


def test_kept_weights_are_forgotten_by_generation(monkeypatch):
    monkeypatch.setattr(t, "KEPT", 5)
    texts, labels = corpus(80, 3)
    scorer, fresh = (t.Scorer(*t.train(texts, labels).folded()) for _ in range(2))
    monkeypatch.setattr(t, "TOGETHER", 300)
    a = [scorer.odds([x])[0] for x in texts]
    assert a == pytest.approx(fresh.odds(texts)) and len(scorer.young) < 40


def test_one_long_word_takes_little_memory():
    """20 MB without a blank, in a process of its own."""
    code = """
import resource, sys
import numpy as np
from msgflow.llm import toxicity as t
scorer = t.Scorer(np.ones(t.BUCKETS, np.float32), 0.0)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert scorer.odds(["ab1" * 7_000_000])[0] == 1.0
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-500:]
    assert int(done.stdout) < 500


def test_bounds_of_the_sample(spark):
    rows = [(i, "w " * (500 if i % 2 else 5)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 4 // 2) for i in range(400)], "doc_id long, toxic int")
    draw = lambda **bounds: t.training_sample(docs, labels, "doc_id", "text", "toxic", **bounds)
    # Long texts go before the draw, so that it is still full.
    some = draw(bounds=(20, 30), long_text=100)
    assert [sum(y == k for *_, y in some) for k in (1, 0)] == [20, 30] and all(i % 2 == 0 for i, *_ in some)
    few = draw(most_bytes=10_000)
    assert 0 < sum(len(x) for _, x, _ in few) <= 10_000 and {y for *_, y in few} == {0, 1}
    assert draw() == draw()
