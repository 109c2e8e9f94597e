"""Near copies, embeddings and repeated strings against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from variloom.llm import embeddings, minhash, suffixes
from variloom.llm.components import Forest, components


def groups(ids, linked):
    forest = Forest()
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if linked(a, b):
                forest.join(a, b)
    return {i: forest.root(i) for i in ids}


def shingles(text, size):
    words = re.findall(rb"[^\x20\x09-\x0d]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    size = min(size, len(words))
    return {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if words else set()


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [str(x) for x in rng.choice(vocabulary, 120)]
    rows = []
    for i in range(60):  # copies of one base with more and more words changed
        own = list(base)
        for k in rng.choice(120, int(rng.integers(0, 8)), replace=False):
            own[int(k)] = str(rng.choice(vocabulary))
        rows.append((i + 100, " ".join(own)))
    rows += [(i, " ".join(str(x) for x in rng.choice(vocabulary, 50))) for i in range(30)]
    rows += [(200, None), (201, ""), (202, " \t"), (203, "One"), (204, "one"), (205, "one two"), (206, rows[0][1].upper()), (207, "x " * 30000), (208, "x " * 20000)]
    return rows


@pytest.mark.parametrize("size,threshold", [(3, 0.85), (5, 0.8)])
def test_groups_agree_with_all_pairs(spark, texts, size, threshold):
    sets = {i: shingles(t, size) for i, t in texts}
    want = groups(sorted(sets), lambda a, b: sets[a] and sets[b] and 1000 * len(sets[a] & sets[b]) >= round(1000 * threshold) * len(sets[a] | sets[b]))
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 as node", "2 as `Component`").repartition(7)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, size, threshold).collect()}
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_blocks_find_links_that_the_smallest_member_does_not_have(spark, texts, monkeypatch):
    from variloom.llm import linking
    monkeypatch.setattr(linking, "BLOCK_ROWS", 8)  # many blocks
    test_groups_agree_with_all_pairs(spark, texts, 3, 0.85)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (3, "a b c d"), (3, "z y x w"), (5, "z y x w"), (None, "only here now")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 0.85).collect()), key=repr)
    assert got == sorted([(None, 3, False), (None, 3, False), (3, 3, True), (3, 3, True), (5, 3, False), (None, None, True)], key=repr)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).collect() == [] and minhash.distinct_documents(empty).collect() == []


def test_every_coordinate_fills_and_estimates():
    rng = np.random.default_rng(2)
    for n in (1, 2, 13, 500):
        a = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        s = minhash.sketch(a)
        assert (s != ~np.uint64(0)).all() and (s == minhash.sketch(a[::-1])).all()
    a = rng.integers(0, 2 ** 63, 1000).astype(np.uint64)
    b = np.concatenate((a[:800], rng.integers(0, 2 ** 63, 200).astype(np.uint64)))
    assert abs((minhash.sketch(a) == minhash.sketch(b)).mean() - 800 / 1200) < 0.12


def test_components_of_chains_and_loops(spark, monkeypatch):
    from variloom.llm import components as module
    monkeypatch.setattr(module, "PART", 40)
    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(150)] + [(500, 500), (7, None)] + [(1000 + int(a), 1000 + int(b)) for a, b in rng.integers(0, 200, (150, 2))]
    forest = Forest()
    for a, b in edges:
        if b is not None and a != b:
            forest.join(a, b)
    nodes = {x for a, b in edges if b is not None and a != b for x in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: forest.root(x) for x in nodes}


def test_embeddings_agree_with_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 50)
    rng = np.random.default_rng(6)
    centre = rng.standard_normal((4, 16))
    rows = []
    for i in range(300):
        v = centre[i % 4] + rng.standard_normal(16) * 0.12 * (i % 3)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 2) if i % 20 else None))
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 16, 1), (403, [float("nan")] + [1.0] * 15, 1), (404, [None] + [1.0] * 15, 1), (405, [1.0, 2.0], 1), (406, [2.0, 4.0], 1)]
    rows += [(500 + i, rows[1][1], 1) for i in range(5)] + [(None, rows[1][1], 1), (600, [1e-200] * 16, 0), (601, [3e-200] * 16, 0)]
    good = {i: (np.array(v), c) for i, v, c in rows if c is not None and v and None not in v and np.isfinite(v).all() and any(v)}

    def linked(a, b):
        (x, c), (y, d) = good[a], good[b]
        if c != d or len(x) != len(y):
            return False
        x, y = x / abs(x).max(), y / abs(y).max()
        return x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98

    ids = sorted((i for i in good if i is not None))
    want = groups(ids, linked)
    extra = sum(linked(1, i) or i == 1 for i in ids)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x")).repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.link_vectors(df).collect()}
    for i, _, _ in rows:
        if i is None:
            assert got[i] == (extra, want[1], False)
        elif i not in good:
            assert got[i] == (0, i, True)
        else:
            with_null = linked(i, 1) or good[i][0].tolist() == good[1][0].tolist() and good[i][1] == 1
            assert got[i] == (sum(linked(i, j) for j in ids if j != i) + with_null, want[i], want[i] == i)
    assert embeddings.link_vectors(df.limit(0)).collect() == []


def cut(rows, length):
    from collections import Counter
    bodies = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, bodies):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [4096, 3])
def test_repeated_strings_agree_with_counting(spark, monkeypatch, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    rng = np.random.default_rng(9)
    word = lambda n: "".join(rng.choice(list("abé "), n))
    shared, other = word(300), word(230)
    rows = [(i, word(int(rng.integers(0, 300))) + shared[int(rng.integers(0, 80)):] + word(50) + (other if i % 3 else "")) for i in range(25)]
    rows += [(50, None), (51, ""), (52, "ab" * 700), (53, "a" * 199), (54, "a" * 200), (55, "b" * 1000), (56, word(5000)), (57, rows[0][1]), (None, word(400)), (58, "x" + "ab" * 120)]
    rows += [rows[3], (60, "z" * 150_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' as doc", "0 as anchor").repartition(4)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffixes.remove_repeats(docs).collect()), key=repr)
    assert got == cut(rows, 200)
    assert suffixes.remove_repeats(docs.limit(0)).collect() == []


def test_two_stage_order_is_the_suffix_order():
    rng = np.random.default_rng(8)
    for letters in ("ab", "abcdef", "a"):
        text = np.frombuffer("".join(rng.choice(list(letters), 400)).encode() + bytes(60), np.uint8)
        wanted = np.sort(rng.choice(400, 150, replace=False))
        raw = text.tobytes() + bytes(60)
        got = suffixes.suffix_order(text, wanted, 40)
        assert sorted(got.tolist()) == wanted.tolist()
        keys = [raw[i:i + 40] for i in got.tolist()]
        assert keys == sorted(keys)


def test_one_row_of_each_group_stays_and_no_other_text_goes(spark):
    words = [f"w{i}" for i in range(60)]
    copy, near, unique = " ".join(words), " ".join([*words[:-1], "end"]), "a text of its own that shares nothing with any other one here"
    rows = [(7, unique), (7, copy), (3, near), (3, near), (None, copy), (None, "x " + unique[::-1]), (None, "x " + unique[::-1]), (5, None), (5, ""), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("row", "node", "gone", "_gone", "bands", "component_id", "kept", "size")})
    out = minhash.distinct_documents(df)
    assert out.columns == df.columns
    got = sorted(map(repr, ((r.doc_id, r.text) for r in out.collect())))
    assert got == sorted(map(repr, [(7, unique), (3, near), (None, "x " + unique[::-1]), (5, None), (5, ""), (9, None)]))
