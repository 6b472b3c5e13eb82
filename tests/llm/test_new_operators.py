"""Filter audit, vector codes and files of ids against plain loops."""

import hashlib
import random
import struct
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from msgflow.llm import filter_audit as fa
from msgflow.llm import id_files as idf
from msgflow.llm.queries import vocabulary
from msgflow.llm.vector_codes import Gnat, codebooks_digest, fit_codebooks, squares, usable_vectors, vector_codes

# -- files of ids -----------------------------------------------------------

BYTES = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(BYTES))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


ODD_TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\n\nb c", "tab\t b", "line\n next", "x y  z", "　 wide  q",
    "\x1c \x1c a", "<|endoftext|>", "a <|endoftext|> b", "can't we'll I'M", "é à ü 漢字 🙂 12,345.6", "  lead", "\r\n \r\n", "\x85 \x85a",
]


def test_pieces_give_the_librarys_ids(library):
    rng = random.Random(3)
    alphabet = ["a", "Bc", " ", "  ", "\n", "\t", "'s", "1", "é", " ", "!", "<|endoftext|>", " ", "\x1f"]
    texts = ODD_TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(2000)] + [None]
    encoder = idf.PieceEncoder(vocabulary(BYTES))
    for _ in range(2):  # from the library, and from what was kept
        lengths, flat = encoder.encode(pa.array(texts))
        ends = np.cumsum(lengths)
        for t, a, b in zip(texts, ends - lengths, ends):
            assert flat[a:b].tolist() == ids_of(library, t), repr(t)


def test_kept_pieces_are_forgotten_by_generation(library):
    encoder = idf.PieceEncoder(vocabulary(BYTES))
    encoder.KEPT = 5
    for text in ("one two three four five six seven", "eight one two", "nine ten eleven twelve one"):
        lengths, flat = encoder.encode(pa.array([text]))
        assert flat.tolist() == ids_of(library, text)
        assert len(encoder.young) <= 20 and len(encoder.old) <= 20


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_planes_round_trip(bits, kind):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, np.iinfo(kind).max, n, dtype=np.uint64, endpoint=True).astype(kind)
        planes = idf.to_planes(ids, bits)
        assert len(planes) == ids.dtype.itemsize * 8 // bits
        assert (idf.from_planes(planes, n, ids.dtype.itemsize, bits) == ids).all()


@pytest.mark.parametrize("bits", [1, 8])
def test_one_file(tmp_path, bits):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 300, n).astype(np.uint16) for n in (0, 5, 3000, 1, 0, 999, 1)]
    writer = idf.IdWriter(f"{tmp_path}/a/x.ids", 2, bits, chunk_ids=256)
    for lo, hi in ((0, 3), (3, 7)):
        writer.add(pa.array(list(range(lo, hi))), np.array([len(d) for d in docs[lo:hi]]), np.concatenate(docs[lo:hi]))
    writer.close()
    file = idf.IdFile(f"{tmp_path}/a/x.ids")
    whole = np.concatenate(docs)
    assert file.n_ids == len(whole) and file.documents["key"].to_pylist() == list(range(7))
    for i, doc in enumerate(docs):
        assert (file.document(i) == doc).all()
    for lo, hi in ((0, len(whole)), (255, 257), (256, 512), (10, 10), (4005, 4006)):
        assert (file.ids(lo, hi) == whole[lo:hi]).all()
    parts = list(file.stretches(100))
    assert [(a, b) for a, b, _ in parts][0][0] == 0 and parts[-1][1] == 7
    assert (np.concatenate([ids for _, _, ids in parts]) == whole).all()
    read, real = [], file.chunk
    file.chunk = lambda c: read.append(c) or real(c)
    file.ids(300, 310)
    assert read == [1]  # only the chunk that holds them


def test_damaged_files_are_refused(tmp_path):
    writer = idf.IdWriter(f"{tmp_path}/x.ids", 2)
    writer.add(pa.array([1]), np.array([3]), np.array([1, 2, 3]))
    writer.close()
    data = (tmp_path / "x.ids").read_bytes()
    (tmp_path / "cut.ids").write_bytes(data[:-4])
    at = len(data) - len(idf.MAGIC) - idf.FOOTER.size - 8
    (tmp_path / "bad.ids").write_bytes(data[:at] + b"\xff" + data[at + 1 :])
    for name in ("cut.ids", "bad.ids"):
        with pytest.raises(ValueError):
            idf.IdFile(f"{tmp_path}/{name}")


def expected_files(library, rows):
    """Per document in order of the key; rows that share a key in any order."""
    out, start = [], 0
    for key, text in rows:
        ids = [*ids_of(library, text), 0]
        out.append((key, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


@pytest.mark.parametrize("options", [{}, {"file_ids": 40, "chunk_ids": 16}, {"bits": 1}])
def test_corpus_of_ids(spark, library, options):
    rows = [(i * 7 % 41, t) for i, t in enumerate(ODD_TEXTS * 2)]
    rows += [(900, None), (901, " " * 1_000_000), (902, "\n" * 1_000_000), (903, "x" * 1_000_000), (-5, "first")]
    rows = sorted(dict(rows).items())
    shuffled = random.Random(4).sample(rows, len(rows))
    docs = spark.createDataFrame([(k, t, 1, 2, 3) for k, t in shuffled], "doc_id long, text string, _key int, _n int, start int")
    manifest = idf.write_ids(docs.repartition(5), vocabulary(BYTES), **options)
    got = idf.read_ids(manifest, digest=True).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected_files(library, rows)
    back = {r.key: r.value for r in idf.read_ids(manifest.filter("n_ids < 100000"), digest=False).collect()}
    assert back and all(v == [*ids_of(library, dict(rows)[k]), 0] for k, v in back.items() if k < 900)
    # The same from any one file by itself, through its index.
    file = manifest.orderBy("base").first()
    some = idf.IdFile(file.file)
    assert some.document(0).tolist() == [*ids_of(library, rows[0][1]), 0]


def test_repeated_and_null_keys_are_all_written(spark, library):
    texts = ["same"] * 30 + ["other words", None, ""]
    docs = spark.createDataFrame([(7, t) for t in texts] + [(None, "no key"), (None, None)], "doc_id long, text string")
    got = idf.id_file_report(docs, vocabulary(BYTES), file_ids=8).orderBy("start").collect()
    assert len(got) == 35 and [r.doc_id for r in got[:2]] == [None, None]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()
    assert sorted(r.ids_crc32 for r in got) == sorted(c for *_, c in expected_files(library, [(7, t) for t in [*texts, "no key", None]]))
    empty = idf.id_file_report(docs.limit(0), vocabulary(BYTES))
    assert empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and empty.count() == 0


# -- vector codes -----------------------------------------------------------


@pytest.mark.parametrize("n,width,spread", [(1, 3, 5), (16, 8, 3000), (16, 2, 2), (300, 4, 50), (300, 1, 4), (64, 6, 100_000_000)])
def test_tree_finds_the_nearest_entry(n, width, spread):
    rng = np.random.default_rng(n + width)
    entries = rng.integers(-spread, spread, (n, width))
    queries = np.concatenate([rng.integers(-spread, spread, (500, width)), entries])
    tree = Gnat(entries)
    index, best = tree.nearest(queries)
    whole = squares(queries, entries)
    assert (best == whole.min(axis=1)).all() and (index == whole.argmin(axis=1)).all()  # ties: lowest number


def test_tree_eliminates_subtrees():
    rng = np.random.default_rng(5)
    centres = rng.integers(-100_000, 100_000, (20, 4))
    entries = (centres[:, None] + rng.integers(-50, 50, (20, 25, 4))).reshape(-1, 4)
    tree = Gnat(entries)
    queries = entries + 3
    index, _ = tree.nearest(queries)
    assert (index == squares(queries, entries).argmin(axis=1)).all()
    assert tree.measured < 0.2 * len(queries) * len(entries)


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(k, l, [int(np.floor(4096 * float(x))) for x in v]) for k, v, l in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda a, book: min((far(a, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for c in cut:
                own.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(x) // len(own[i]) for x in zip(*own[i])] if i in own else e for i, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    totals = {}
    for (_, l, _), e in zip(kept, errors):
        totals[l] = totals.get(l, 0) + e
    return sorted(
        ((k, "".join(f"{i:02x}" for _, i in f), e, totals[l], digest) for (k, l, _), f, e in zip(kept, found, errors)), key=repr
    )


VECTORS = "vec_id long, embedding array<float>, label int, _key int, _vector int"


def vector_rows(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1, 16)], int(i % 3) if i % 5 else None) for i in range(n)]
    if n > 4:
        rows += [rows[3], rows[3], (None, rows[4][1], 7), (None, rows[2][1], None), (n, None, 1), (n + 1, [1.0, None] * 8, 1),
                 (n + 2, [float("nan")] * 16, 2), (n + 3, [float("inf")] * 16, 2), (n + 4, [0.0] * 16, 2)]
    return rows


@pytest.mark.parametrize("n", [60, 5, 1])
def test_vector_codes_equal_a_plain_loop(spark, n):
    rows = vector_rows(n)
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS).repartition(3)
    got = sorted((tuple(r) for r in vector_codes(table).collect()), key=repr)
    assert got == plain_codes(rows)


def test_vector_codes_of_odd_tables(spark):
    none = spark.createDataFrame([], VECTORS)
    assert vector_codes(none).count() == 0
    only_bad = spark.createDataFrame([(1, None, 1, 0, 0)], VECTORS)
    assert vector_codes(only_bad).count() == 0
    bare = spark.createDataFrame([(i, [float(i)] * 8, None, 0, 0) for i in range(3)], VECTORS)
    assert {r.label_error for r in vector_codes(bare).collect()} == {0}
    for bad in ([[1.0] * 8, [1.0] * 16], [[1.0] * 9], [[1e30] * 8]):
        with pytest.raises(ValueError):
            vector_codes(spark.createDataFrame([(i, v, 1, 0, 0) for i, v in enumerate(bad)], VECTORS))


def test_more_entries_than_a_byte(spark):
    rows = vector_rows(400, seed=2)
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS)
    got = vector_codes(table, entries=300, rounds=1)
    books = fit_codebooks(usable_vectors(table, "vec_id", "embedding", "label", 4096.0), entries=300, rounds=1)
    assert {len(r.code) for r in got.collect()} == {24} and got.first().codebooks_sha256 == codebooks_digest(books)


# -- filter audit -----------------------------------------------------------


def plain_audit(rows, labels):
    """rows: (id, text, source); labels: (id, quality, toxic)."""
    good = {k for k, q, _ in labels if q == 1 and k is not None}  # no id: no label
    bad = {k for k, _, t in labels if t == 1 and k is not None}
    least = {}
    for k, t, _ in rows:
        if k is not None:
            least[t or ""] = min(k, least.get(t or "", k))
    docs = []
    for k, t, s in rows:
        t = t or ""
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t):
            fails.add("C")
        if any(c in "#$%&*|" for c in t):
            fails.add("D")
        if k is not None and least[t] < k:
            fails.add("E")
        docs.append((s or "", fails, k in good, k in bad))
    out = []
    for part in {d[0] for d in docs}:
        own, lost = [d for d in docs if d[0] == part], {}
        for order in permutations("ABCDE"):
            for i, f in enumerate(order):
                lost[f] = lost.get(f, 0) + sum(f in d[1] and not d[1] & set(order[:i]) for d in own)
        for order in permutations("ABCDE"):
            for i, f in enumerate(order):
                gone = set(order[:i])
                removed = [d for d in own if f in d[1] and not d[1] & gone]
                out.append((
                    part, "".join(order), i + 1, sum(not d[1] & {*gone, f} for d in own), len(removed),
                    sum(f in d[1] and bool(d[1] & gone) for d in own), sum(d[1] == {f} for d in own),
                    sum(d[2] for d in removed), sum(d[3] for d in removed), lost[f],
                ))
    return sorted(out)


def audit_rows():
    rng = random.Random(8)
    long = " ".join(f"w{i}" for i in range(200))
    texts = ["", None, "short", "Short TEXT", "a$ b", long, long + " A", long + " #", "w " * 300, long.upper(), long + "\x0bé 漢", " ".join("ab")]
    rows = [(rng.randint(0, 60), rng.choice(texts), rng.choice(["s1", "s2", "", None])) for _ in range(150)]
    rows += [(None, long, "s1"), (None, "short", None), (3, "short", "s1"), (3, "short", "s1"), (3, "short", "s2")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)] + [(4, 1, 1), (4, None, None), (None, 1, 1)]
    return rows, labels


DOCS = "doc_id long, text string, source string, id int, part int, mask int, digest int"


def write_docs(spark, rows, path, files, mode="overwrite"):
    """One file for each share of the rows, ids falling from file to file, so that smaller ids come late."""
    rows = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    size = -(-len(rows) // files)
    for i in range(files):
        part = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows[i * size : (i + 1) * size]], DOCS).coalesce(1)
        part.write.mode(mode if i == 0 else "append").parquet(path)


def as_tuples(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_audit_equals_a_plain_loop(spark, tmp_path, monkeypatch, broadcast_rows):
    monkeypatch.setattr(fa.label_flags, "__defaults__", ("doc_id", broadcast_rows))
    rows, labels = audit_rows()
    write_docs(spark, rows, f"{tmp_path}/d", 4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    changes_folder = f"{tmp_path}/run"
    got = fa.filter_audit(spark, f"{tmp_path}/d", marks, buckets=3, folder=changes_folder)
    assert as_tuples(got) == plain_audit(rows, labels)
    changes = spark.read.parquet(f"{changes_folder}/changes")
    assert changes.filter("n < 0").count() > 0  # earlier masks were taken back


def test_audit_goes_on_with_more_files(spark, tmp_path):
    rows, labels = audit_rows()
    rows.sort(key=lambda r: -1 if r[0] is None else r[0])
    marks = fa.label_flags(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    for part, mode in ((rows[80:], "overwrite"), (rows[:80], "append")):
        write_docs(spark, part, f"{tmp_path}/d", 2, mode)
        stream = fa.stream_files(spark, f"{tmp_path}/d")
        changes = fa.run_audit(stream, marks, f"{tmp_path}/run", 3)
    counters = changes.groupBy(*fa.INFO).agg(F.sum("n").alias("n"))
    assert as_tuples(fa.order_report(counters)) == plain_audit(rows, labels)


def test_audit_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/d")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.filter_audit(spark, f"{tmp_path}/d", marks).count() == 0


def test_combining_sends_one_row_of_a_hot_text():
    rows = pa.RecordBatch.from_pylist(
        [{"id": 50 - i, "part": "s", "mask": 1, "digest": b"x" * 32, "good": False, "toxic": False} for i in range(50)],
        pa.schema([("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("digest", pa.binary()),
                   ("good", pa.bool_()), ("toxic", pa.bool_())]),
    )
    out = pa.Table.from_batches(fa._combine(7)(iter([rows]))).to_pylist()
    assert sorted((r["bucket"] >= 0, r["id"], r["n"]) for r in out) == [(False, 0, 49), (True, 1, 1)]


def test_state_of_the_audit_reserves_no_disk(spark, tmp_path):
    import zipfile

    from msgflow.llm.filter_audit import filter_audit

    path, folder = str(tmp_path / "documents.parquet"), tmp_path / "audit"
    spark.createDataFrame([(i, f"text {i % 7}", "web") for i in range(40)], "doc_id long, text string, source string").write.parquet(path)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert filter_audit(spark, path, labels, folder=str(folder)).count() == 600
    options = []
    for file in folder.rglob("*.zip"):
        with zipfile.ZipFile(file) as archive:
            options += [archive.read(n).decode() for n in archive.namelist() if n.startswith("OPTIONS")]
    assert options and all("allow_fallocate=false" in o for o in options)
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", None) is None
