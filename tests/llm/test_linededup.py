"""Line dedup against all pairs of lines."""

import re

import numpy as np
import pytest

from variloom.llm import linededup
from variloom.llm.components import Forest, components
from variloom.llm.textbytes import word_hashes

SEED = "the quick brown fox jumps over a lazy dog while seven wizards quietly mix potions under pale winter moons near old stone bridges"


def words_of(line):
    return [w.decode("utf-8", "replace") for w in re.findall(rb"[0-9a-z\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in line.encode()))]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def blocks_of(words):
    raw = " ".join(words).encode()
    ends = np.flatnonzero(np.append(np.frombuffer(raw, np.uint8), 0x20) == 0x20)
    starts = np.append(0, ends[:-1] + 1)
    hashes = word_hashes(np.frombuffer(raw, np.uint8), starts, ends)
    return linededup.simhash(hashes, np.array([0, len(hashes)]))[0]


def brute(rows):
    """Kept lines of (doc_id, text) rows, in the given order of rows."""
    lines = []
    for r, (i, text) in enumerate(rows):
        for k, line in enumerate([] if text is None else text.split("\n")):
            if words_of(line):
                lines.append((i is None, i if i is not None else 0, linededup.content_key(text.encode()), k, r, words_of(line)))
    forms = sorted({tuple(x[5]) for x in lines})
    forest = Forest()
    sims = [blocks_of(list(f)) for f in forms]
    for a in range(len(forms)):
        for b in range(a):
            x, y = " ".join(forms[a]), " ".join(forms[b])
            if (sims[a] == sims[b]).any() and distance(x, y) <= max(len(x), len(y)) * 100 // 1000:
                forest.join(a, b)
    groups = {}
    for x in lines:
        groups.setdefault(forest.root(forms.index(tuple(x[5]))), []).append(x)
    first = {min(g, key=lambda x: (x[0], x[1], int.from_bytes(x[2][:8], "little", signed=True), x[3], x[4]))[3:5] for g in groups.values()}
    return [None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if not words_of(x) or (k, r) in first) for r, (_, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    w = SEED.split()
    near = " ".join(w * 3)
    out = [(1, "Alpha beta!\n" + near + "\n\n--\nshared line"), (2, near.replace("fox", "fix", 1) + "\nSHARED   line."), (3, near.replace("stone", "stones", 1)),
           (4, None), (5, ""), (6, "\n\n"), (7, "shared line\n"), (None, "shared line\nonly here äöü"), (None, None), (8, "x" * 70000 + "\nonly here ÄÖÜ"),
           (9, " ".join(f"{x}{k}" for k in range(9) for x in w) + " end"), (10, " ".join(f"{x}{k}" for k in range(9) for x in w) + " fin")]
    rng = np.random.default_rng(3)
    for i in range(20, 60):
        own = [str(rng.choice(w)) for _ in range(40)]
        own[int(rng.integers(40))] = "changed"
        out.append((i, " ".join(w * 2 + [w[i % len(w)]]) + "\n" + " ".join(own)))
    return out


def test_edit_distance_agrees_with_the_table():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = "".join(rng.choice(list("abc"), int(rng.integers(0, 25))))
        b = "".join(rng.choice(list("abc"), int(rng.integers(0, 25)))) if rng.random() < 0.5 else a[:5] + "z" + a[6:]
        d = distance(a, b)
        for most in (0, 2, 30):
            assert linededup.edit_distance(a, b, most) == (d if d <= most else most + 1)


@pytest.mark.parametrize("wide", [8192, 0])
def test_edit_distance_of_longer_texts(monkeypatch, wide):
    monkeypatch.setattr(linededup, "WIDE", wide)
    rng = np.random.default_rng(7)
    for n in (90, 150):
        a = "".join(rng.choice(list("abcd"), n))
        b = list(a)
        for k in rng.choice(n, 40, replace=False):
            b[int(k)] = str(rng.choice(["", "x", "ab"]))
        b = "".join(b)
        d = distance(a, b)
        assert d > linededup.FEW
        for most in (d - 1, d, d + 30):
            assert linededup.edit_distance(a, b, most) == min(d, most + 1)
    assert linededup.edit_distance("a" * 30, "b" * 40, 40) == 40


def test_lines_agree_with_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_lines", "'s' as source").repartition(5)
    got = {(r.doc_id, r.text is None): r.text for r in linededup.drop_repeated_lines(docs).collect()}
    assert got == {(i, t is None): x for (i, t), x in zip(rows, brute(rows))}


def test_recall_against_edit_similarity_alone(spark):
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(3, 10))))
    lines = []
    for n in (5, 8, 10, 15, 20, 30) * 12:
        own = [word() for _ in range(n)]
        own[int(rng.integers(n))] = "1234"
        line = " ".join(own)
        at = int(rng.integers(n))
        other = " ".join([*own[:at], word(), *own[at + 1:]])
        typo = line[:7] + "x" + line[7 + int(rng.integers(2)):]
        lines += [line, line.replace("1234", "1299"), typo, other]
    pairs = {(i, j) for i in range(len(lines)) for j in range(i) if i // 4 == j // 4
             and 10 * distance(lines[i], lines[j]) <= max(len(lines[i]), len(lines[j]))}
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    group = {r.doc_id: r.group for r in linededup.line_groups(docs).collect()}
    found = {(i, j) for i, j in pairs if group[i] == group[j]}
    assert len(pairs) > 200 and len(found) >= 0.95 * len(pairs)
    assert len(set(group.values())) >= len(lines) // 4


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "one line here\n..")] * 3, "doc_id long, text string")
    assert sorted(r.text for r in linededup.drop_repeated_lines(docs).collect()) == ["..", "..", "one line here\n.."]
    assert linededup.drop_repeated_lines(docs.limit(0)).collect() == []


@pytest.mark.parametrize("letters", ["ab ", "abcdef\xe9", "ab\u0436\U0001F600"])
def test_pairs_at_once_agree_with_the_table(letters):
    rng = np.random.default_rng(5)
    text = lambda n: "".join(rng.choice(list(letters), n))
    a, b = [], []
    for n in (0, 1, 9, 40, 90, 130) * 30:
        one = text(n)
        other = list(one)
        for _ in range(int(rng.integers(0, 2 + n // 5))):
            at = int(rng.integers(0, len(other) + 1))
            other[at:at + int(rng.integers(0, 2))] = text(int(rng.integers(0, 2)))
        a, b = [*a, one, text(n)], [*b, "".join(other), text(max(0, n - 3))]
    exact = np.array([distance(x, y) for x, y in zip(a, b)])
    longest = np.array([max(len(x), len(y)) for x, y in zip(a, b)])
    for mosts in (longest // 10, longest // 3, exact, exact - 1, longest):
        assert linededup.within_bound(a, b, mosts).tolist() == (exact <= mosts).tolist()
        assert [linededup.within_bound([x], [y], np.array([m]))[0] for x, y, m in zip(a, b, mosts)] == (exact <= mosts).tolist()
    # hundreds of edits: more diagonals than one number has bits
    a = [text(700) for _ in range(40)]
    b = [x[100:600] if k % 2 else x[:350] + text(70) + x[350:] for k, x in enumerate(a)]
    assert linededup.within_bound(a, b, np.full(40, 200)).tolist() == [True] * 40
    assert linededup.within_bound(a, b, np.full(40, 69)).tolist() == [False] * 40


def test_documents_take_one_exchange(spark):
    docs = spark.createDataFrame([(i, f"line {i}\nshared words here") for i in range(9)], "doc_id long, text string")
    # a small table would be broadcast instead
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = linededup.drop_repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    window, join = plan.index("Window"), plan.index("SortMergeJoin")
    assert window < join and "Exchange" not in plan[window:join]


def test_few_edges_are_folded_without_stars(spark, monkeypatch):
    monkeypatch.setattr("variloom.llm.components._stars", None)
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(900, 901)], "x long, y long").repartition(7)
    assert {(r.node, r.component) for r in components(edges).collect()} == {(i, 0) for i in range(301)} | {(900, 900), (901, 900)}
