"""Columns that carry the operators' own names, keys of other types, and texts built to be costly."""

import base64
import time

import pytest

from msgflow.llm import chunk_recipes, mixing, odd_sketch, queries, secret_scan, token_counts, toxicity

OWN = [
    "_doc", "_hash", "_source", "_null", "_copy", "_times", "_cut", "_sha", "_key", "_recipe", "_row", "_id", "_text", "_of",
    "_n", "_h1", "_h2", "_size", "_set", "_class", "_label", "_also", "kept", "keep_id", "text_sha256", "component_id",
    "target", "source_size", "b", "a", "size", "score", "id", "key",
]


def documents(spark):
    """Some rows are copies, near copies or repeated as a whole; every own name holds a value of its row."""
    page = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    texts = [page[0], page[0].upper(), page[1], page[1] + " more", page[2], "grobian words", None, ""]
    rows = [(i, t, f"s{i % 3}" if i % 4 else None, *[f"{n}-{i}" for n in OWN]) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, page[2], "s1", *[f"{n}-none" for n in OWN])]
    names = ", ".join(f"`{n}` string" for n in OWN)
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {names}")


@pytest.mark.parametrize("stage", ["toxic", "exact", "near", "mix"])
def test_stages_leave_every_column_alone(spark, stage):
    docs = documents(spark)
    labels = spark.createDataFrame([(5, 1), (0, 0), (2, 0)], "doc_id long, toxic int")
    out = {
        "toxic": lambda: toxicity.drop_toxic(docs, labels), "exact": lambda: chunk_recipes.drop_exact_copies(docs),
        "near": lambda: odd_sketch.drop_near_copies(docs), "mix": lambda: mixing.mix(docs),
    }[stage]()
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = {tuple(r) for r in docs.collect()}
    got = [tuple(r) for r in out.collect()]
    assert got and all(r in rows for r in got)


@pytest.mark.parametrize("kind, keys", [("string", ["k1", "k10", None, "k2"]), ("double", [1.5, -2.0, None, 0.0]), ("date", None)])
def test_exact_groups_by_other_keys(spark, kind, keys):
    import datetime as dt

    keys = keys or [dt.date(2024, 1, 1), dt.date(2023, 1, 1), None, dt.date(2022, 5, 5)]
    rows = [(k, t) for k in keys for t in ("same", "SAME")] + [(keys[0], "other")]
    got = chunk_recipes.exact_groups(spark.createDataFrame(rows, f"`a key` {kind}, text string"), key="a key").collect()
    largest = max(k for k in keys if k is not None)
    assert {(r.keep_id, r.group_size) for r in got} == {(largest, 8), (keys[0], 1)}
    assert sum(r.kept for r in got) == 2


def coder():
    import public_tokenizers

    with open(queries.vocabulary("byte_bpe_50k.tiktoken"), "rb") as f:
        return token_counts.encoding_of(f.read(), public_tokenizers.PATTERN, "test")[0]


@pytest.mark.parametrize("blank", [" ", "\n", "\t ", " \n", "　", "\x85"])
def test_long_blank_runs_are_split_exactly(blank):
    c = coder()
    run = (blank * 9000)[:9000]
    for text in (run, f"a{run}", f"{run}b", f"a b{run} c{run}d", f"x{run[:-1]} y", f"x{run[:-1]}\n1"):
        assert token_counts.encode(c, text) == c.encode_ordinary(text)


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_a_megabyte_of_blanks(spark, blank):
    text = "a" + blank * 1_000_000 + "b"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    import public_tokenizers

    out = token_counts.section_tokens(docs, queries.vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert len(out) == (1 if blank == " " else 1_000_001)
    assert sum(r.n_tokens for r in out) == len(token_counts.encode(coder(), text))


def test_lines_that_start_like_keys_take_linear_time():
    def field(x):
        return len(x).to_bytes(4, "big") + x

    starts = [
        b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + (4_000).to_bytes(4, "big"),
        b"openssh-key-v1\0" + b"\xff" * 40, b"\x30\x84\x7f\xff\xff\xff\x02\x01\x00" + b"x" * 20, b"\x30\x82\x3f\xff\x02\x01\x00" + b"x" * 20,
    ]
    for start in starts:
        line = base64.b64encode(start + b"y" * 30).decode().rstrip("=")
        text = "\n".join([line] * (1_000_000 // len(line)))
        began = time.process_time()
        secret_scan.confirmed_spans(text)
        assert time.process_time() - began < 20, start[:20]


@pytest.mark.parametrize("letter", ["A", " "])
def test_a_megabyte_of_one_character(spark, letter):
    from msgflow.llm import bpe, license_templates, suffix_repeats

    docs = spark.createDataFrame([(1, letter * 1_000_000), (2, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 0)], "doc_id long, toxic int")
    assert bpe.encode_digests(docs, queries.vocabulary()).count() == 2
    assert len(license_templates.license_report(docs).collect()) == 2
    assert len(secret_scan.secret_spans(docs).collect()) == 2
    assert len(toxicity.toxicity_report(docs, labels).collect()) == 2
    assert len(chunk_recipes.exact_groups(docs).collect()) == 2
    assert len(odd_sketch.near_groups(docs).collect()) == 2
    got = {r.doc_id: r.n_removed for r in suffix_repeats.repeated_bytes(docs).collect()}
    assert got == {1: 1_000_000, 2: 0}


def test_words_of_a_certain_build_are_told_apart(spark):
    """Thue-Morse words, on which running sums modulo a power of two collide."""
    word = "a"
    while len(word) < 4096:
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    for n in (1024, 2048, 4096):
        texts = [f"{w[:n]} one two three four five" for w in (word, other)]
        got = odd_sketch.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), width=7)
        assert sorted(r.component_id for r in got.collect()) == [0, 1]
