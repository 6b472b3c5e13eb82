"""The methods inside the operators, against plain loops."""

import base64
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from msgflow.llm import ball_tree, bpe, chunk_recipes, license_templates, odd_sketch, queries, secret_scan, token_counts, toxicity


def merged(coder, word):
    """The merges replayed one by one."""
    parts = [ord(c) for c in word]
    while True:
        best = min(((coder.merged[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in coder.merged), default=None)
        if best is None:
            return [coder.ids[p] for p in parts]
        parts[best[1] : best[1] + 2] = [best[0]]


def test_backtracking_equals_replayed_merges():
    coder = bpe.WordTokenizer(bpe.read_definition(queries.vocabulary())).coder
    r = random.Random(1)
    for _ in range(3000):
        raw = "".join(r.choices(["th", "he", "in", "a", "s", "'", "é", "ing", "q", "aa", "!"], k=r.randint(1, 12))).encode()
        w = raw[:-1].decode("latin-1") + chr(raw[-1] + 256)
        assert coder.encode(w) == merged(coder, w)


def test_long_and_special_texts_equal_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary())
    own = bpe.WordTokenizer(bpe.read_definition(queries.vocabulary()))
    r = random.Random(3)
    texts = ["a" * 50_000, "!" * 50_000, "ha" * 30_000, "x<|endoftext|>y<|", "ΣΑΣ İ ǅ ﬁ 漢字 \x1c\x85 It's", "é", ""]
    texts += ["".join(chr(r.choice([r.randint(32, 0x2FF), r.randint(0x300, 0xD7FF)])) for _ in range(30)) for _ in range(300)]
    for text in texts:
        ids = np.frombuffer(own.encode(text), "<u4")
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids).decode() == library.decode(ids.tolist(), skip_special_tokens=False)


def test_a_clash_of_chunk_identifiers_is_seen_and_chunked_again(spark):
    rows = [(i, f"text number {i} " * 50) for i in range(40)] + [(100, "text number 3 " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weak = lambda chunk, seed: b"same" if seed < 2 else chunk_recipes.chunk_id(chunk, seed)
    got = {r.doc_id: r for r in chunk_recipes.exact_groups(df, name=weak).collect()}
    assert got[3].keep_id == 100 and got[4].group_size == 1
    with pytest.raises(ValueError, match="clash"):
        chunk_recipes.exact_groups(df, name=lambda chunk, seed: b"same").collect()


def test_chunks_do_not_depend_on_neighbours():
    r = np.random.default_rng(1)
    a, b = (r.integers(97, 123, n, dtype=np.uint8) for n in (70_000, 30_000))
    both = chunk_recipes.cut_candidates(np.concatenate([a, b]))
    alone = chunk_recipes.chunk_ends(chunk_recipes.cut_candidates(b), 0, len(b))
    assert [x - len(a) for x in chunk_recipes.chunk_ends(both, len(a), len(a) + len(b))] == alone
    assert all(256 <= y - x <= 8192 for x, y in zip([0, *alone], alone[:-1]))


def test_ball_tree_search_over_shards(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=8)]) for i in range(600)]
    rows += [(i, rows[0][1]) for i in range(600, 700)] + [(700, None), (701, [1.0, None]), (702, [float("nan")] * 8), (None, rows[1][1]), (750, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = {}
    for x in ball_tree.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=64, query_block=4).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    ok = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows
          if i is not None and v is not None and i not in (701, 702)}
    ok[750] = np.zeros(8, int)
    for q in (i for i in ok if i % 50 == 0):
        best = sorted((-int(ok[q] @ v), i) for i, v in ok.items() if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert set(got) == {i for i in ok if i % 50 == 0}


def test_top_k_of_few_rows(spark):
    make = lambda rows: ball_tree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0)
    assert make([]).collect() == [] and make([(0, [1.0])]).collect() == []
    assert [tuple(x) for x in make([(0, [1.0]), (1, [0.5])]).collect()] == [(0, 1, 1, 256 * 128)]


def test_template_regions():
    a = license_templates.Automaton('Licensed by <<var words="1-3" match="[a-z]+">> under <<optional>>the <<optional>>old<<end>> <<end>>terms')
    take = lambda text: a.accepts(license_templates.plain_words(text))
    assert take("LICENSED by Ann, Bob under the terms!") == 7
    assert take("licensed by ann under terms") == 5 and take("licensed by ann under the old terms here") == 7
    assert take("licensed by under terms") == 0 and take("licensed by a b c d under terms") == 0
    assert take("licensed by 12 under terms") == 0 and take("licensed by ann under old terms") == 0
    with pytest.raises(ValueError):
        license_templates.Automaton("<<optional>>x<<end>> y")


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x82, *len(body).to_bytes(2, "big")])
    return bytes([tag]) + size + body


def test_structures_are_confirmed():
    number = lambda n: der(2, b"\x01" * n)
    pkcs1 = der(0x30, der(2, b"\0"), *[number(n) for n in (128, 3, 128, 64, 64, 64, 64, 64)])
    pkcs8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48")), der(4, pkcs1))
    url = lambda d: base64.urlsafe_b64encode(json.dumps(d).encode()).decode().rstrip("=")
    token = f'{url({"alg": "HS256", "typ": "JWT"})}.{url({"sub": "12"})}.c2ln'
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 51) + field(b"s" * 90)
    kinds = lambda text: [secret_scan.KINDS[k] for _, k, _ in secret_scan.confirmed_spans(text)]
    wrapped = "\n".join(base64.encodebytes(pkcs8).decode().split())
    assert kinds(f"a {wrapped}\n-- b") == ["der"] and kinds(f"x {pkcs1.hex()} y") == ["der"]
    assert kinds(base64.b64encode(ssh).decode()) == ["openssh"] and kinds(f"bearer {token};") == ["jwt"]
    broken = pkcs8[:2] + b"\x01" + pkcs8[3:]
    assert kinds(base64.b64encode(broken).decode()) == [] and kinds("A" * 80) == [] and kinds(token.replace("eyJ", "eyK", 1)) == []
    assert secret_scan.base_spans("to\u212aen: abcdef") == [] and len(secret_scan.base_spans("tokEN: abcdef")) == 1


@pytest.mark.parametrize("rule,expected", [("first", [2, 0, 1]), ("last", [1, 0, 2]), ("most", [1, 1, 1])])
def test_allocation_rules(rule, expected):
    # Tokens of 2, 7 and 3 bytes over sections of 3, 4 and 5 bytes: the second crosses two edges.
    section, crosses = token_counts.allocate(np.array([2, 9, 12]), np.array([3, 7, 12]), rule)
    assert np.bincount(section, minlength=3).tolist() == expected and crosses.tolist() == [False, True, False]


def test_odd_sketches_estimate_similarity():
    r = np.random.default_rng(4)
    near, far = [], []
    for share, into in ((0.85, near), (0.4, far)):
        for _ in range(60):
            n = int(300 * share * 2 / (1 + share))
            common, a, b = (r.integers(0, 1 << 63, k, dtype=np.uint64) for k in (n, 300 - n, 300 - n))
            s = odd_sketch.odd_sketches(np.array([odd_sketch.minhash(np.concatenate([common, x])) for x in (a, b)])).view(np.uint64)
            into.append(int(np.bitwise_count(s[0] ^ s[1]).sum()))
    assert max(near) <= odd_sketch.FAR < min(far)


def test_words_across_blocks(monkeypatch):
    text = b" ".join(b"w%d" % (i % 37) * (i % 5 + 1) for i in range(3000)) + b" "
    data = np.frombuffer(text, np.uint8)
    whole = odd_sketch.word_hashes(data)
    monkeypatch.setattr(odd_sketch, "BLOCK", 64)
    parts = odd_sketch.word_hashes(data)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    assert len(set(whole[1].tolist())) == len(set(text.split()))


def near_rows():
    r = random.Random(6)
    base = [f"w{r.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(400):  # a group of near copies of very different distance
        t = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 4, 6])):
            t[r.randrange(150)] = f"x{r.randrange(9999)}"
        rows.append((i, " ".join(t)))
    for i in range(400, 460):  # a chain: neighbours are linked, ends are not
        rows.append((i, " ".join(f"c{j}" for j in range((i - 400) * 4, (i - 400) * 4 + 100))))
    return rows + [(500 + i, rows[0][1]) for i in range(30)] + [(600 + i, " ".join(f"u{r.randrange(10**6)}" for _ in range(40))) for i in range(60)]


@pytest.mark.parametrize("block", [1024, 16])
def test_no_link_is_lost_in_large_groups(spark, monkeypatch, block):
    monkeypatch.setattr(odd_sketch, "BLOCK_ROWS", block)
    rows = near_rows()
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            c = len(sets[a] & sets[b])
            if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in odd_sketch.near_groups(df, width=4).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in ids}


def test_no_task_holds_all_unlinked_members_of_a_band(spark, monkeypatch):
    r = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):  # pages of one template: they share bands, most of them are not linked
        t = list(base)
        for k in r.sample(range(150), 4):
            t[k] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    # Both halves of one pair stand anywhere in the blocks, and have to be found.
    rows.append((900, rows[7][1] + " end"))
    plain, most = odd_sketch._links_between, 16 * 3

    def watched(percent):
        held = plain(percent)

        def run(asking, against):
            if max(asking.num_rows, against.num_rows) > most:
                raise ValueError(f"one task holds {asking.num_rows} against {against.num_rows} members")
            return held(asking, against)

        return run

    monkeypatch.setattr(odd_sketch, "BLOCK_ROWS", 16)
    monkeypatch.setattr(odd_sketch, "_links_between", watched)
    sets = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} for i, t in rows for w in [t.split()]}
    links = [(a, b) for a in sets for b in sets
             if a < b and 5 * (c := len(sets[a] & sets[b])) >= 4 * (len(sets[a]) + len(sets[b]) - c)]
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in odd_sketch.near_groups(df, width=4).collect()}
    assert got == root and len(set(root.values())) > 100


def long_key(fill):
    return der(0x30, der(2, b"\0"), *[der(2, b"\x01" * n) for n in (128, 3, 128, 64, 64, 64, 64, fill)])


@pytest.mark.parametrize("fill", [62, 63, 64])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n", "\\r\\n", "\\\\n"])
def test_a_key_ends_where_its_lengths_say(fill, end):
    raw = base64.b64encode(long_key(fill)).decode()
    wrapped = end.join(raw[i : i + 64] for i in range(0, len(raw), 64))
    text = f"BEGIN{end}{wrapped}{end}word and more{end}{'Q' * 64}{end}{wrapped}{end}{wrapped}{end}END"
    first = text.index(wrapped)
    second = text.index(wrapped, first + 1)
    third = text.index(wrapped, second + 1)
    assert secret_scan.confirmed_spans(text) == [(i, 3, i + len(wrapped)) for i in (first, second, third)]


def test_dsa_and_openssh_keys_among_other_lines():
    number = lambda first, n: der(2, bytes([first]) + b"\x05" * (n - 1))
    parts = [der(2, b"\0"), number(0x7F, 128), number(0x7F, 21), number(0x11, 128), number(0x12, 128), number(0x13, 20)]
    for end in ("\n", "\\n"):
        key = base64.b64encode(der(0x30, *parts)).decode()
        assert secret_scan.confirmed_spans(f"x{end}{key}{end}word") == [(1 + len(end), 3, 1 + len(end) + len(key))]
    wrong = base64.b64encode(der(0x30, *parts[:5], number(0x7F, 21))).decode()
    assert secret_scan.confirmed_spans(wrong) == []
    field = lambda b: len(b).to_bytes(4, "big") + b
    for n in (89, 90, 91):
        ssh = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 51) + field(b"s" * n)
        key = base64.b64encode(ssh).decode()
        for end in ("\n", "\\n"):
            assert secret_scan.confirmed_spans(f"{key}{end}word") == [(0, 4, len(key))]


@pytest.mark.parametrize("clean,toxic", [(40, 4), (20, 3), (3, 2), (60, 5), (5, 2), (58, 10)])
def test_few_labelled_rows_are_learned_from(clean, toxic):
    r = random.Random(clean)
    plain = lambda: " ".join(r.choices(["alpha", "beta", "gamma", "delta", "epsilon", "zeta"], k=40))
    marked = lambda: " ".join([plain(), "grobian", "grobian", plain()])
    texts = [plain() + " " + plain() for _ in range(clean)] + [marked() for _ in range(toxic)]
    scorer = toxicity.Scorer(*toxicity.train(texts, [0] * clean + [1] * toxic).folded())
    assert min(scorer.odds([marked() for _ in range(20)])) > 0
    assert max(scorer.odds([plain() + " " + plain() for _ in range(20)] + [""])) < 0


@pytest.mark.parametrize("clean,toxic", [(40, 4), (20, 3), (3, 2), (60, 5), (5, 2)])
def test_no_difference_scores_low(clean, toxic):
    for text in ("the same words", ""):
        scorer = toxicity.Scorer(*toxicity.train([text] * (clean + toxic), [0] * clean + [1] * toxic).folded())
        assert max(scorer.odds([text, "other"])) < -1


def test_rows_that_share_a_key_are_dropped_as_marked(spark):
    page, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, page), (5, page.upper()), (5, other), (6, None), (None, page)]
    kept = odd_sketch.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, page), (5, other), (6, None), (None, page)], key=str)
