"""Registered queries against their SQL or brute force, and the cases every operator defines."""

import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
from msgflow.llm import queries as llm

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def texts_of(tables):
    return dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_equals_its_sql(spark, tables, name):
    df = llm.QUERIES[name](spark, SF)
    result = tables.execute(llm.ORACLE[name])
    expected = check.rows_of([d[0] for d in result.description], result.fetchall())
    assert check.rows_of(df.columns, df.collect()) == expected


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


def test_bpe_equals_the_library(spark, tables):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(llm.vocabulary())
    library.no_truncation()
    library.no_padding()
    texts = texts_of(tables)
    for row in llm.QUERIES["op2_bpe"](spark, SF).collect():
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_licenses_equal_a_plain_scan(spark, tables):
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    texts = texts_of(tables)
    for row in llm.QUERIES["op3_licenses"](spark, SF).collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), texts[row.doc_id] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, k) for k, p in phrases.items() for i in range(len(words)) if words[i : i + len(p)] == p]
        starts = [i for i, _ in places]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({k for _, k in places}))
        assert set(row.base_labels.split(",")) <= set(row.labels.split(",")) | {""} and 0 <= row.score <= 1


def test_secrets_equal_the_patterns(spark, tables):
    patterns = {
        "assign": (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
                   r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    }
    texts = texts_of(tables)
    for row in llm.QUERIES["op7_secrets"](spark, SF).collect():
        found = {k: [m for m in re.finditer(p, texts[row.doc_id] or "") if ok(m)] for k, (p, ok) in patterns.items()}
        assert [row.n_assign, row.n_access, row.n_hex] == [len(v) for v in found.values()]
        spans = sorted((m.start(), list(found).index(k), m.end()) for k, v in found.items() for m in v)
        listed = ",".join(f"{list(found)[k]}:{a}:{b}" for a, k, b in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))


def test_toxicity_on_held_out_rows(spark):
    rows = llm.QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").join(
        llm.table(spark, "/root/testdata/sf0.1", "labels").select("doc_id", "toxic"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    toxic = [r.predicted for r in held if r.toxic == 1]
    clean = [r.predicted for r in held if r.toxic == 0]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.02 * len(clean)


def test_sections_add_up(spark, tables):
    import base64

    import public_tokenizers
    import tiktoken

    with open(llm.vocabulary("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f.read().splitlines())}
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts, rows = texts_of(tables), {}
    for r in llm.QUERIES["op9_token_counts"](spark, SF).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert set(rows) == set(texts)
    for doc, sections in rows.items():
        sections.sort(key=lambda r: r.section)
        text = texts[doc] or ""
        assert "".join(text[r.start_char : r.end_char] for r in sections) == text
        counts, at, n = [0] * len(sections), 0, 0
        ends = np.cumsum([len(text[r.start_char : r.end_char].encode()) for r in sections])
        for token in coder.encode_ordinary(text):
            while at >= ends[n]:
                n += 1
            counts[n] += 1
            at += len(coder.decode_single_token_bytes(token))
        assert counts == [r.n_tokens for r in sections]


def test_mix_is_near_its_targets(spark):
    rows = llm.QUERIES["op10_mixing"](spark, "/root/testdata/sf0.01").withColumn("source", F.lit(1)).collect()
    docs = {r.doc_id: r.source for r in llm.table(spark, "/root/testdata/sf0.01").select("doc_id", "source").collect()}
    taken, target, largest = {}, {}, {}
    for r in rows:
        s = docs[r.doc_id]
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s], largest[s] = r.target, max(largest.get(s, 0), r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in taken)
    total = sum(r.size for r in rows)
    assert sum(target.values()) == pytest.approx(1.5 * total)


def odd_rows():
    long = " ".join(random.Random(5).choices(["alpha", "beta", "gamma", "delta", "ÉTÉ", "token=abcdefgh"], k=30_000))
    return [
        (1, None, None, None), (2, "", "s", "x"), (3, "One two three four five six seven", "s", None),
        (4, "one two three four FIVE six seven", None, "y"), (3, "One two three four five six seven", "s", None),
        (None, "one two three four five six seven", "t", "x"), (None, None, None, None), (5, " \n\t ", "s", "x"),
        (6, long, "t", "x"), (7, long.upper(), "t", "x"), (8, "MIT license. AKIA" + "A" * 20 + " " + "0f" * 20, "t", "x"),
    ]


# Columns whose names the operators use inside.
ODD = "doc_id long, text string, source string, _row string"


@pytest.fixture(params=[True, False], ids=["odd rows", "no rows"])
def odd(spark, request):
    return spark.createDataFrame(odd_rows() if request.param else [], ODD).withColumns(
        {c: F.lit("z") for c in ("_id", "_key", "_text", "_size", "_hash", "_set", "kept", "size", "target", "section", "n_tokens")})


def operators(spark):
    import public_tokenizers

    from msgflow.llm import bpe, chunk_recipes, license_templates, mixing, odd_sketch, secret_scan, suffix_repeats, token_counts, toxicity

    labels = spark.createDataFrame([(3, 1), (6, 0), (6, 1), (None, 1), (7, None), (8, 0), (2, 5)], "doc_id long, toxic int")
    return {
        "near": odd_sketch.near_groups, "bpe": lambda d: bpe.encode_digests(d, llm.vocabulary()),
        "licenses": license_templates.license_report, "repeats": suffix_repeats.repeated_bytes,
        "exact": chunk_recipes.exact_groups, "secrets": secret_scan.secret_spans,
        "toxicity": lambda d: toxicity.toxicity_report(d, labels), "mixing": mixing.mix_report,
        "sections": lambda d: token_counts.section_tokens(d, llm.vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
    }


NAMES = ["near", "bpe", "licenses", "repeats", "exact", "secrets", "toxicity", "mixing", "sections"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, name):
    n, got = odd.count(), operators(spark)[name](odd).collect()
    if name == "sections":
        assert sorted({str(r.doc_id) for r in got}) == sorted({str(r.doc_id) for r in odd.collect()})
        return
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd.collect())
    rows = {r.doc_id: r for r in got}
    if not n:
        return
    if name == "near":
        assert (rows[1].component_id, rows[1].n_shingles, rows[2].kept) == (1, 0, True)
        assert rows[4].component_id == 3 and not rows[4].kept and rows[7].component_id == 6 - 0
    if name == "exact":
        kept = [r for r in got if r.text_sha256 == rows[4].text_sha256 and r.kept]
        assert [r.doc_id for r in kept] == [4] and rows[3].group_size == 4 and rows[1].keep_id == 2
    if name == "repeats":
        assert rows[6].n_bytes == len(odd_rows()[8][1].encode()) and rows[3].n_removed == 0
    if name == "mixing":
        assert rows[1].taken == 0 and rows[5].size == 0
    if name == "licenses":
        assert rows[8].labels == "mit" and rows[1].n_words == 0
    if name == "secrets":
        assert (rows[8].n_access, rows[8].n_hex, rows[1].spans) == (1, 1, "")


def test_pipeline_stages_keep_the_columns(spark, odd):
    import corpus_pipeline

    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd.columns, name
    assert docs.count() <= 2 * odd.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_pipeline_equals_its_operators(spark, tables):
    """What stays after the two dedup stages, against plain sets."""
    import corpus_pipeline

    docs = llm.table(spark, SF)
    kept = corpus_pipeline.near_copies(spark, corpus_pipeline.exact_copies(spark, docs, SF), SF)
    low = {d: re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for d, t in texts_of(tables).items()}
    last = {t: d for d, t in sorted(low.items())}
    sets = {}
    for t, d in last.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted({find(d) for d in ids})
