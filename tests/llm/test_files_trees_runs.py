"""Token files, Merkle manifests and periodic runs against plain Python, on all kinds of odd rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from creditspark.llm import huffman, merkle, runs, tokenfile
from creditspark.llm.queries import QUERIES, tokenizer_path
from creditspark.llm.tables import Scratch
from creditspark.llm.tokenids import unit_ids

from .test_cases import ROWS, docs, empty  # noqa: F401  (fixtures)

FOLDER = "/root/testdata/sf0.001"


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


# -- token ids and their files


def test_units_are_tokenised_as_in_whole_texts():
    r, known = random.Random(1), tokenizer()
    parts = ["a", "b", "é", "à", " ", "  ", "\n", "\n\n", "\t", "\r\n", ".", ",", "'s", "'", "!", "?", "1", " ", " ", "　", "\x1c", "\x85",
             "ab", "中", "𝒳", "<|endoftext|>", "<|", "…", "“", "\x0b", " \n", "\n ", " ", "​", " ", "\x00", "it's", "we'll."]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(8000)]
    texts += ["x" * 3000 + " y," + "z" * 400 + "\n" + "b" * 300, None, "", " ".join(f"w{i}" for i in range(300_000))]
    at = 0
    for i, j, ids, counts in unit_ids(tokenizer_path()).of_column(pa.array(texts)):
        assert i == at
        at, end = j, np.cumsum(counts)
        for k, expected in enumerate(known.encode_batch_fast([t or "" for t in texts[i:j]], add_special_tokens=False)):
            assert ids[end[k] - counts[k] : end[k]].tolist() == expected.ids, texts[i + k][:80]
    assert at == len(texts)


def test_more_units_than_are_remembered(monkeypatch):
    from creditspark.llm import tokenids

    monkeypatch.setattr(tokenids, "KNOWN_UNITS", 64)
    few, known = tokenids.UnitIds(tokenizer_path()), tokenizer()
    texts = [" ".join(f"word{i * 7 % 1000} x{i}y" for i in range(k, k + 90)) for k in range(12)]
    for i, _, ids, counts in few.of_column(pa.array(texts)):
        assert ids.tolist() == [x for t in texts[i : i + len(counts)] for x in known.encode(t, add_special_tokens=False).ids]


def test_huffman_codes_are_optimal_and_bounded():
    r = np.random.default_rng(1)
    import heapq

    for _ in range(150):
        counts = r.integers(0, 1000, r.integers(2, 40))
        counts[:2] += 1
        used = counts[counts > 0]
        heap, cost = used.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            cost += both
            heapq.heappush(heap, both)
        free = huffman.code_lengths(counts, 24)
        assert (free * counts).sum() == cost and ((free > 0) == (counts > 0)).all()
        most = int(np.ceil(np.log2(len(used)))) + int(r.integers(0, 3))
        lengths = huffman.code_lengths(counts, most)
        assert lengths.max() <= most and sum(2.0 ** -lengths[lengths > 0].astype(float)) <= 1
        ids = r.choice(np.flatnonzero(counts), r.integers(0, 1500))
        codec = huffman.Codec(lengths)
        data = codec.encode(ids)
        assert (codec.decode(data) == ids).all()
        a, b = sorted(r.integers(0, len(ids) + 1, 2))
        assert (codec.decode(data, int(a), int(b)) == ids[a:b]).all()
        # Canonical: in the order of (length, id), codes are consecutive numbers.
        order = sorted(np.flatnonzero(lengths), key=lambda x: (lengths[x], x))
        texts = [format(int(codec.codes[x]), f"0{lengths[x]}b") for x in order]
        assert texts == sorted(texts) and not any(b.startswith(a) for a, b in zip(texts, texts[1:]))
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5), 2)
    with pytest.raises(ValueError):
        huffman.Codec(np.array([1, 0])).encode(np.array([1]))


@pytest.mark.parametrize("run_ids", [1 << 18, 700])
def test_token_files(docs, monkeypatch, run_ids):  # noqa: F811
    monkeypatch.setattr(tokenfile, "RUN_IDS", run_ids)
    spark = docs.sparkSession
    folder = f"{Scratch(spark).folder}/ids"
    tokenfile.write_ids(docs, tokenizer_path(), folder)
    found = tokenfile.read_documents(spark, folder).orderBy("start").collect()
    known = tokenizer()
    ids_of = lambda t: known.encode(t or "", add_special_tokens=False).ids + [2]
    expected = collections.Counter((i, tuple(ids_of(t))) for i, t in ROWS)
    assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found) == expected
    assert [r.doc_id is None for r in found] == [True] + [False] * (len(found) - 1)
    assert [r.doc_id for r in found[1:]] == sorted(i for i, _ in ROWS if i is not None)
    assert [r.start for r in found] == [sum(r.n_tokens for r in found[:k]) for k in range(len(found))]
    every = np.frombuffer(b"".join(r.ids for r in found), "<u4")
    for begin, end in ((0, len(every)), (300, 301), (250, 5000), (len(every) - 3, len(every) + 9), (7, 7)):
        pieces = tokenfile.read_stretch(spark, folder, begin, end).orderBy("start").collect()
        assert (np.frombuffer(b"".join(p.ids for p in pieces), "<u4") == every[begin:end]).all()
        assert not pieces or pieces[0].start == begin
    total = spark.read.parquet(f"{folder}/totals").first()
    assert (total.documents, total.ids, total.end_id) == (len(ROWS), len(every), 2)
    bits = {r.id: r.bits for r in spark.read.parquet(f"{folder}/codes").collect()}
    assert set(bits) == set(every.tolist())


def test_token_files_read_each_text_for_ranges_and_tokens_only(spark, tmp_path):
    seen = str(tmp_path)

    @F.udf("string")
    def read(i):
        open(f"{seen}/{i}", "a").write("x")
        return f"text {i}"

    docs = spark.range(20).select(F.col("id").alias("doc_id"), read.asNondeterministic()("id").alias("text"))
    folder = f"{Scratch(spark).folder}/ids"
    tokenfile.write_ids(docs, tokenizer_path(), folder)
    assert max(len(open(f"{seen}/{i}").read()) for i in range(20)) <= 2
    known = tokenizer()
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in tokenfile.read_documents(spark, folder).collect()}
    assert found == {i: known.encode(f"text {i}", add_special_tokens=False).ids + [2] for i in range(20)}


def test_token_files_with_ids_beyond_two_bytes(spark):
    folder = f"{Scratch(spark).folder}/ids"
    docs = spark.createDataFrame([(2, "b c"), (1, "a")], "doc_id long, text string")
    tokenfile.write_ids(docs, tokenizer_path(), folder, end_id=70_000)
    known = tokenizer()
    found = tokenfile.read_documents(spark, folder).orderBy("start").collect()
    expected = [known.encode(t, add_special_tokens=False).ids + [70_000] for t in ("a", "b c")]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in found] == expected


def test_token_files_of_an_empty_table(empty):  # noqa: F811
    folder = f"{Scratch(empty.sparkSession).folder}/ids"
    tokenfile.write_ids(empty, tokenizer_path(), folder)
    assert tokenfile.read_documents(empty.sparkSession, folder).count() == 0
    assert tokenfile.read_stretch(empty.sparkSession, folder, 0, 10).count() == 0


def test_token_files_query(spark):
    known, start = tokenizer(), 0
    found = {r.doc_id: r for r in QUERIES["op11_token_files"](spark, FOLDER).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    assert set(found) == set(texts)
    for i in sorted(texts):
        ids = known.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        r = found[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


# -- Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes, fan_out):
    """Root, and per leaf the (before, after) texts of each level."""
    paths, own = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, owned = [], []
        for k in range(0, len(nodes), fan_out):
            group = nodes[k : k + fan_out]
            for j in range(len(group)):
                for i in own[k + j]:
                    paths[i].append(("".join(group[:j]), "".join(group[j + 1 :])))
            above.append(sha(*group))
            owned.append([i for members in own[k : k + fan_out] for i in members])
        nodes, own = above, owned
    return nodes[0], paths


def expected_manifest(rows, fan_out):
    """Counter of (doc_id, leaf, subroot, root, path)."""
    leaf = lambda r: sha(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r[c] for c in merkle.COLUMNS)])
    langs = collections.defaultdict(list)
    for r in rows:
        langs[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r["doc_id"]))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([y[2] for y in sorted(langs[x], key=lambda y: y[:3])], fan_out) for x in order}
    root, tops = tree([trees[x][0] for x in order], fan_out)
    found = collections.Counter()
    for x, top in zip(order, tops):
        for y, path in zip(sorted(langs[x], key=lambda y: y[:3]), trees[x][1]):
            found[y[3], y[2], trees[x][0], root, tuple(path + top)] += 1
    return found


def got_manifest(df):
    return collections.Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.path)) for r in df.collect())


@pytest.mark.parametrize(("fan_out", "block"), [(2, 1024), (2, 4), (3, 9)])
def test_manifest(docs, fan_out, block):  # noqa: F811
    rows = docs.select(*merkle.COLUMNS).collect()
    assert got_manifest(merkle.manifest(docs, fan_out=fan_out, block=block)) == expected_manifest(rows, fan_out)


@pytest.mark.parametrize("n", [1, 2, 5, 16, 17, 33])
def test_manifest_of_one_language(spark, n):
    """Sizes around powers of the block, most rows in one language, and a language of one row."""
    rows = [(i * 3 % 40, None if i % 4 else "s", None if i == 0 else "é", i, "t" * i) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert got_manifest(merkle.manifest(df, block=4)) == expected_manifest(df.collect(), 2)


def test_manifest_of_nothing_and_tampering(docs, empty):  # noqa: F811
    assert merkle.manifest(empty).count() == 0
    columns = {c: F.col(c) for c in merkle.COLUMNS}
    changed = merkle.leaf(columns | {"text": F.concat(F.coalesce("text", F.lit("")), F.lit("x"))})
    found = merkle.manifest(docs, {"changed": F.when(F.col("doc_id") > 20, changed)}, block=4)
    found = found.withColumn("to", merkle.folded(F.coalesce("changed", "leaf"), F.col("path"))).collect()
    assert all((r.to == r.root) == (r.doc_id is None or r.doc_id <= 20) for r in found)
    for r in found:
        assert r.root == found[0].root


# -- periodic runs


def brute_runs(words, least=runs.LEAST_WORDS, periods=runs.LEAST_PERIODS):
    n, out = len(words), set()
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            shorter = any(all(words[x] == words[x + p] for x in range(start, end - p)) for p in range(1, q))
            if end - start >= max(least, periods * q) and not shorter:
                out.add((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize(("least", "periods"), [(6, 4), (2, 2), (5, 3)])
def test_runs_of_random_words(least, periods):
    r, seen = random.Random(3), 0
    for _ in range(500):
        texts = []
        for _ in range(r.randint(1, 4)):
            n, most = r.randint(0, 60), r.randint(1, 4)
            words = [r.randint(0, most) for _ in range(n)]
            if r.random() < 0.5 and n:
                a = r.randrange(n)
                p = 1 + (n - a) // r.randint(2, 10)
                words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            texts.append(words)
        limits = np.cumsum([0, *map(len, texts)])
        symbols = np.array([w + 6 * k for k, words in enumerate(texts) for w in words], np.int64)
        got = [tuple(x) for x in runs.runs_of(symbols, limits, least, periods).tolist()]
        expected = [(s + limits[k], s + n + limits[k], q) for k, words in enumerate(texts) for s, n, q in brute_runs(words, least, periods)]
        seen += len(expected)
        assert got == expected
    assert seen > 400


def test_runs_of_very_long_texts():
    n = 200_000
    for period in (1, 2, 5000, n // 4, n // 4 + 1):
        found = runs.runs_of(np.arange(n) % period, np.array([0, n])).tolist()
        assert found == ([[0, n, period]] if period <= n // 4 else [])
    a, b = [0], [0, 1]
    while len(b) < n:  # a word without any fourth power
        a, b = b, b + a
    assert len(runs.runs_of(np.array(b), np.array([0, len(b)]))) == 0


def test_runs(docs, empty):  # noqa: F811
    found = runs.periodic_runs(docs).collect()
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    short = [(i, t) for i, t in ROWS if len(t or "") < 10_000]
    expected = collections.Counter()
    for i, t in short:
        own = brute_runs(split(t))
        expected[i, len(split(t)), tuple(own), collapsed(split(t), own)] += 1
    got = collections.Counter(
        (r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in found if r.n_words < 2000
    )
    assert got == expected and len(found) == len(ROWS)
    assert any(r.runs for r in found)
    assert runs.periodic_runs(empty).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, periods=1)


def test_runs_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    some = 0
    for r in QUERIES["op13_periodic_runs"](spark, FOLDER).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        elif n > 1500:
            continue  # brute force is quadratic
        own = brute_runs(words)
        some += len(own)
        top = min(own, key=lambda x: (-x[1], x[0], x[2])) if own else (None, None, None)
        milli = 1000 * top[1] // top[2] if own else None
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(own), *top, milli)
        assert r.runs_sha256 == sha("".join(f"{s},{length},{q}\n" for s, length, q in own))
        assert r.collapsed_sha256 == sha(collapsed(words, own))
    assert some > 5
