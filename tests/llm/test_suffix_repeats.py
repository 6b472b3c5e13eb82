import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from msgflow.llm import suffix_repeats as sr


def removed(texts, keep_first=False):
    """Bytes of each text and a mark for each byte that goes, by a table of all strings."""
    raw = [(t or "").encode() for t in texts]
    seen, first = Counter(b[i : i + 400] for b in raw for i in range(len(b) - 399)), {}
    out = []
    for n, b in enumerate(raw):
        gone = bytearray(len(b))
        for i in range(len(b) - 399):
            string = b[i : i + 400]
            if first.setdefault(string, (n, i)) != (n, i) if keep_first else seen[string] > 1:
                gone[i : i + 400] = b"\1" * 400
        out.append((b, gone))
    return out


def brute(texts, keep_first=False):
    out = []
    for b, gone in removed(texts, keep_first):
        kept = bytes(x for x, g in zip(b, gone) if not g)
        starts = [i for i, g in enumerate(gone) if g and not (i and gone[i - 1])]
        ends = [i + 1 for i, g in enumerate(gone) if g and not (i + 1 < len(gone) and gone[i + 1])]
        out.append((len(b), sum(gone), len(starts), hashlib.sha256(kept).hexdigest(), list(zip(starts, ends))))
    return out


def made(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéf") for _ in range(r.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))[: n * 3]
    passages = [prose(r.choice([130, 150, 200, 300, 600])) for _ in range(4)]
    texts = [None, "", "x" * 399, "x" * 400, "y" * 1500, "ab" * 700]
    for _ in range(25):
        parts = [prose(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 3)
            parts += [p[a : len(p) - r.randint(0, len(p) // 3)], prose(r.randint(0, 40))]
        texts.append("".join(parts))
    base = prose(900)
    for _ in range(12):  # near copies
        t = list(base)
        for _ in range(r.randint(1, 3)):
            t[r.randrange(len(t))] = "#"
        texts.append("".join(t))
    texts += [texts[8], texts[8], base, base[:400], base[1:401], texts[9] + texts[9]]
    return texts


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("seed,group", [(1, 2000), (2, 2000), (3, 2000), (1, 2), (4, 1)])
def test_equals_brute_force(spark, seed, group, keep_first):
    texts = made(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _row string")
    got = sorted(sr.repeated_bytes(df.repartition(5), group=group, keep_first=keep_first).collect())
    assert [(*g[1:5], [tuple(x) for x in g[5]]) for g in got] == brute(texts, keep_first)


@pytest.mark.parametrize("keep_first", [False, True])
def test_kept_text(spark, keep_first):
    texts = made(5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in sr.without_repeats(df, keep_first=keep_first).collect()}
    for i, (b, gone) in enumerate(removed(texts, keep_first)):
        kept = bytes(x for x, g in zip(b, gone) if not g)
        assert bytes(got[i].kept) == kept
        spans = [tuple(s) for s in got[i].spans]
        assert b"".join(b[lo:hi] for lo, hi in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(b)])) == kept


def made_to_collide():
    """Pairs of texts that share no 400 bytes, but a hash known beforehand: polynomial modulo 2^64, xxhash64."""
    head = "".join(random.Random(7).choices("abcdefgh ", k=336))
    sums = [head + "hberpgkvumezmbzkmrqrvubaunwkoosboocgzqgkrygtvelzvauajzdeoduvnbly",
            head + "pvmatrqpnjwwiaqkawkxlfhadoiguupzpuawyspjmwlztpedmsyxtkopnpwbmzyw"]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .,-"
    body = "".join(random.Random(1).choices(letters, k=700))
    lanes = [body[:320] + a + body[328:352] + b + body[360:] for a, b in (("uc ~:-]8", "AJ.SyZEB"), ('5Os!@KA"', "AJ.SYqEf"))]
    return {"contexts": sums, "strings": [sums[0] + "a", sums[1] + "b"], "texts": lanes}


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("kind,group", [("contexts", 2000), ("strings", 1), ("texts", 2000)])
def test_made_collisions_remove_nothing(spark, kind, group, keep_first):
    texts = made_to_collide()[kind]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(sr.repeated_bytes(df, group=group, keep_first=keep_first).collect())
    assert [(*g[1:5], [tuple(x) for x in g[5]]) for g in got] == brute(texts, keep_first)
    assert [g.n_removed for g in got] == [0, 0]


def test_marks_tell_strings_as_their_bytes_do():
    r = random.Random(8)
    data = np.frombuffer("".join(r.choice(["ab" * 300, "abc" * 200, "a" * 450]) for _ in range(20)).encode(), np.uint8)
    for key in (b"", b"run"):
        marks = sr.string_marks(data, key).tolist()
        strings = [data[i : i + 400].tobytes() for i in range(len(data) - 399)]
        assert len(marks) == len(strings) and len(set(marks)) == len(set(strings)) == len(set(zip(marks, strings)))


def test_first_copies_stay_once(spark):
    t = "".join(random.Random(6).choices("abcdefgh ", k=800))
    df = spark.createDataFrame([(5, t), (5, t), (3, t), (None, "a" + t), (9, t[100:] + "end")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_removed) for r in sr.repeated_bytes(df, keep_first=True).collect())
    assert got == [("3", 800), ("5", 800), ("5", 800), ("9", 700), ("None", 0)]


@pytest.mark.parametrize("seed", range(4))
def test_orders_of_suffixes(seed):
    """Byte order and common prefixes at every distance, against sorting."""
    r = random.Random(seed)
    parts = ["".join(r.choice("ab") for _ in range(n)) for n in (5, 40, 200, 380)]
    contexts = [("".join(r.choices(parts, k=3)) + "x" * r.randint(0, 3)).encode()[: r.randint(420, 700)] for _ in range(40)]
    contexts = [c for c in contexts if len(c) > 400]
    lefts = np.array([r.randint(0, min(300, len(c) - 101)) for c in contexts])
    grams = np.array([r.randint(0, 1) for _ in contexts])
    order = sr.SuffixOrder(grams, lefts, contexts)
    for distance in range(int(lefts.max()) + 1):
        if distance:
            order.step()
        own = [i for i in range(len(contexts)) if lefts[i] >= distance]
        assert sorted(order.order.tolist()) == own
        suffix = {i: contexts[i][lefts[i] - distance :] for i in own}
        left = {i: contexts[i][lefts[i] - distance : lefts[i]] for i in own}
        right = {i: contexts[i][lefts[i] :] for i in own}
        rank = sorted(own, key=lambda i: (left[i], grams[i], right[i]))
        assert [(left[i], grams[i], right[i]) for i in order.order] == [(left[i], grams[i], right[i]) for i in rank]
        for k in range(1, len(own)):
            a, b = order.order[k - 1], order.order[k]
            if grams[a] == grams[b]:
                same = next((n for n, (x, y) in enumerate(zip(suffix[a], suffix[b])) if x != y), min(len(suffix[a]), len(suffix[b])))
                assert order.common[k] == same


def test_smaller_values_beside():
    r = random.Random(1)
    for _ in range(300):
        n = r.randint(0, 30)
        place = np.array(r.sample(range(100), n), np.int64)
        run = np.cumsum(np.array([r.random() < 0.3 for _ in range(n)], np.int64))
        got = sr._beside(place, run, 101)
        assert got.tolist() == [any(run[j] == run[i] and place[j] < place[i] for j in range(n)) for i in range(n)]


def test_anchors_in_slices(monkeypatch):
    r = random.Random(2)
    data = np.frombuffer(bytes(r.choices(b"abcd", k=9_000)), np.uint8)
    whole = sr.anchors(data)
    monkeypatch.setattr(sr, "SLICE", 1_000)
    assert all((a == b).all() for a, b in zip(whole, sr.anchors(data)))


def test_rows_that_repeat_and_null_keys(spark):
    t = "".join(chr(97 + i * i % 23) + "-" for i in range(400))
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (None, "short"), (2, t[3:])], "doc_id long, text string")
    got = sr.repeated_bytes(df).collect()
    assert sorted((str(g[0]), g[1], g[2]) for g in got) == [
        ("1", 800, 800), ("1", 800, 800), ("2", 797, 797), ("None", 5, 0), ("None", 800, 800)]


def test_empty_table(spark):
    assert sr.repeated_bytes(spark.createDataFrame([], "doc_id long, text string")).collect() == []
