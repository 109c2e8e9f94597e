"""Trie, shards and hard negatives against brute force, with the cases of their docstrings."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from variloom.llm import negatives, sharding, trie

# ---------------------------------------------------------------- trie


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(turns.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, ms in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(ms) - 1) * len(node[-1][1]) if node else 0
    ends = defaultdict(list)
    for c, seq in rebuilt.items():
        ends[seq].append(c)
    return sorted((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), kids[node], leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()) for node, ms in members.items())


def built_trie(spark, rows, more=()):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in more:
        df = df.withColumn(c, F.lit("clash"))
    out = trie.prefix_trie(*trie.swap_openings(trie.numbered_turns(df)))
    return sorted(tuple(r) for r in out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def test_trie_against_brute_force(spark):
    rng, rows = random.Random(3), []
    for c in [*range(0, 40), *range(120, 160), *range(200, 203), -5, -120, 10 ** 12]:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "", None, "émile 𝄞", "a" * 40 + rng.choice("xyz")])))
    rows += rows[:7] + [(None, 1, "user", "x")]
    assert built_trie(spark, rows, ["pos", "u", "part", "depth"]) == brute_trie(rows)


def test_trie_of_copies_long_and_turnless_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 16)
    # a third of all rows in one conversation, 700 equal ones, and short ones that lose all their turns
    rows = [(700_000, t, "user", f"turn {t % 50}") for t in range(160)]
    rows += [(c, t, "user", f"same {t}") for c in range(100_000, 100_700) for t in range(3)]
    rows += [(c, 0, "user", "only") for c in range(300_100, 300_160)]
    made = built_trie(spark, rows)
    assert made == brute_trie(rows) and made[0][3] == 761
    assert len({r[7] for r in made}) > 3


def test_trie_of_nothing(spark):
    assert built_trie(spark, []) == []


# ---------------------------------------------------------------- shards


def brute_shards(rows, shards):
    digest = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    own = sorted((digest(x or ""), digest("" if i is None else str(i)), -1 if i is None else i, len((x or "").encode()) + 1, zlib.crc32((x or "").encode())) for i, x in rows)
    total, of = sum(r[3] for r in own), Counter()
    for r in own:
        of[r[0]] += r[3]
    at, start, out, slots = 0, {}, [], Counter()
    for h, _, i, n, crc in own:
        start.setdefault(h, at)
        twice = 2 * start[h] + of[h] if of[h] * sharding.WHOLE_PART * shards <= total else 2 * at + n
        shard = twice * shards // (2 * total)
        out.append((i, n, crc, shard, slots[shard]))
        slots[shard] += 1
        at += n
    return sorted(out)


def placed(df, shards):
    rows = sharding.place(df, shards).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in rows)


@pytest.fixture(scope="module")
def shard_rows():
    rng = random.Random(8)
    rows = [(i, "hot text") for i in range(900)] + [(5, "one row many times")] * 900
    rows += [(i, None if i % 50 == 0 else "é" * rng.randrange(0, 300) + str(i % 700)) for i in range(2000, 3500)]
    return rows + [(None, "no id"), (None, None), (7777, ""), (7778, "long " * 5000)]


def test_shards_against_brute_force(spark, shard_rows):
    df = spark.createDataFrame(shard_rows, "doc_id long, text string")
    clash = df.withColumns({c: F.lit("clash") for c in ("h", "g", "salt", "range", "size", "shard", "slot", "row", "first")})
    want = brute_shards(shard_rows, 16)
    assert placed(clash, 16) == want
    assert placed(df.repartition(3), 5) == brute_shards(shard_rows, 5)


def test_shards_are_nearly_equal_and_split_hot_texts(spark, shard_rows):
    rows = [r for r in shard_rows if r[0] != 7778]
    out = placed(spark.createDataFrame(rows, "doc_id long, text string"), 8)
    sizes = Counter()
    for _, size, _, shard, _ in out:
        sizes[shard] += size
    mean = sum(sizes.values()) / 8
    assert sorted(sizes) == list(range(8)) and max(abs(s - mean) for s in sizes.values()) <= mean / sharding.WHOLE_PART + 600


def test_ranges_subdivide_the_overfull(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(sharding, "MIN_RANGES", 64)
    monkeypatch.setattr(sharding, "SAMPLES", 1)
    df = spark.createDataFrame(shard_rows, "doc_id long, text string")
    assert placed(df, 16) == brute_shards(shard_rows, 16)
    keys = sharding.settle(df.select(F.lit(1).cast("long").alias("size"), sharding._hash(F.coalesce("text", F.lit(""))).alias("h"),
                                     F.lit(0).cast("long").alias("g"), F.monotonically_increasing_id().alias("salt")), "keys")
    _, totals = sharding._ranges(keys, df.count(), df.count())
    assert totals.where((F.col("n") > 1) & (F.col("w") > sharding.OVERFULL * 2 / 64)).count() == 0


def test_written_shards_hold_whole_rows(spark, shard_rows, tmp_path):
    df = spark.createDataFrame(shard_rows, "doc_id long, text string").withColumn("shard", F.lit("own")).withColumn("row", F.lit(1))
    sharding.write_shards(df, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(repr, back.select("row.*").collect())) == sorted(map(repr, df.collect()))
    per = {r["shard"]: (r["n"], r["low"], r["high"]) for r in back.groupBy("shard").agg(F.countDistinct("slot").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high")).collect()}
    assert sorted(per) == [0, 1, 2, 3] and all(low == 0 and high == n - 1 for n, low, high in per.values())


def test_shards_of_nothing(spark):
    assert placed(spark.createDataFrame([], "doc_id long, text string"), 16) == []


# ---------------------------------------------------------------- hard negatives


def brute_negatives(rows, positives=5, keep=10):
    own = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and None not in v:
            own[i] = min(own.get(i, (label, v)), (label, v))
    out = []
    for a, (la, va) in own.items():
        if a % 10:
            continue
        score = {i: sum(x * y for x, y in zip(va, v)) for i, (_, v) in own.items() if i != a and len(v) == len(va)}
        for p in sorted((i for i in score if own[i][0] == la), key=lambda i: (-score[i], i))[:positives]:
            near = sorted((i for i in score if own[i][0] != la and 30 * score[p] <= 100 * score[i] <= 90 * score[p]), key=lambda i: (-score[i], i))
            out += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(near[:keep])]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, v array<bigint>").withColumns({c: F.lit("clash") for c in ("id", "size", "i", "anchor", "slot")})
    out = negatives.mine(df, F.col("id") % 10 == 0)
    return sorted(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("sizes", [(8192, 4096, 512), (16, 20, 3)])
def test_negatives_against_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("FIRST_ROWS", "BLOCK_ROWS", "BLOCK_ANCHORS"), sizes):
        monkeypatch.setattr(negatives, name, value)
    monkeypatch.setattr(negatives, "ROWS_PER_CELL", 16)
    monkeypatch.setattr(negatives, "GROWTH", 4)
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 60, (6, 12))
    rows = [(i, int(rng.integers(4)), (centres[rng.integers(6)] + rng.normal(0, 20, 12)).astype(int).tolist()) for i in range(500)]
    # copies of one vector in two labels, null cases, another length, empty vectors, a shared id, one of its kind
    rows += [(i, i % 2, [30] * 12) for i in range(1000, 1300)]
    rows += [(2000, None, [1] * 12), (2010, 1, None), (2020, 1, [None] + [1] * 11), (None, 1, [1] * 12)]
    rows += [(i, i % 3, [i % 7, -3, 5]) for i in range(3000, 3060)] + [(i, i % 2, []) for i in range(4000, 4030)]
    rows += [(20, 3, [0] * 12), (20, 0, [9] * 12), (30, 2, rows[30][2]), rows[40], (5000, 77, [1] * 12), (5010, 1, [0] * 12)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_large_numbers_and_nothing(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, [int(x) for x in rng.integers(-2 ** 29, 2 ** 29, 4)]) for i in range(60)]
    assert mined(spark, rows) == brute_negatives(rows)
    assert mined(spark, []) == []


def test_scaled_components(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, [0.5, -0.001]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, [None, 1.0]), (6, [])], "k int, e array<float>")
    assert [r["v"] for r in df.select("k", negatives.scaled(F.col("e")).alias("v")).orderBy("k").collect()] == [[128, -1], None, None, None, None, []]


def test_visits_fall_and_bound_every_score():
    rng = np.random.default_rng(4)
    order = list(negatives.visits(rng.normal(size=7), rng.normal(size=5)))
    assert len({(i, j) for _, i, j in order}) == 35 and all(a[0] >= b[0] for a, b in zip(order, order[1:]))


# ---------------------------------------------------------------- preference pairs


def test_repeated_pairs_and_negative_ids(spark):
    from variloom.llm import chat

    turns = [(c, t, role, f"{c}:{t if c < 5 else 0}") for c in (-2, -1, 0, 1) for t, role in enumerate(("user", "assistant", "user", "assistant"))]
    frame = spark.createDataFrame([*turns, (None, 0, "user", "lost")], "conv_id long, turn long, role string, text string")
    made, pairs = chat.swapped_endings(frame)
    rows = {r.pair_id: r for r in chat.preference_pairs(made, pairs.unionByName(pairs)).collect()}
    assert sorted(rows) == [-2, -1, 0, 1]
    for c, r in rows.items():
        own = [f"<|im_start|>{role}\n{text}<|im_end|>\n" for conv, _, role, text in turns if conv == c]
        assert (r.prompt_turns, r.prompt, r.chosen) == (3, "".join(own[:3]), own[3])
        assert r.rejected == f"<|im_start|>assistant\n{c ^ 1}:3<|im_end|>\n" and len(r.chosen_mask) == len(r.rejected_mask) == 1
    two = spark.createDataFrame([(1, 0, 1), (1, -2, 1)], "pair_id long, chosen long, rejected long")
    assert [r.chosen.count("-2:") for r in chat.preference_pairs(frame, two).collect()] == [4]
