import random

import pytest

from variloom.functions import sequence as S
from variloom.operators import tags as T


def sequences(spark, lengths, seed=3):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice("ACGT") for _ in range(n))) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "seq_id bigint, seq string"), rows


def expected_windows(rows, params):
    best = S.best_synonyms()
    out = {}
    for seq_id, seq in rows:
        codons = [seq[i:i + 3] for i in range(0, len(seq) - len(seq) % 3, 3)]
        for start in range(len(codons) - 7):
            part = codons[start:start + 8]
            new = "".join(best[c][0] for c in part)
            score = sum(a != b for a, b in zip(new, "".join(part)))
            mt = sum(2 if b in "AT" else 4 for b in new)
            if params.min_temp <= mt <= params.max_temp and score / 24 * 100 >= params.min_recoded:
                out[seq_id, start] = (score, new)
    return out


def expected_pairs(windows, params):
    return [(s, i, j, a[0] + b[0]) for (s, i), a in windows.items() for (t, j), b in windows.items()
            if s == t and i < j and params.min_distance <= 3 * (j - i + 8) <= params.max_distance]


@pytest.fixture()
def small_pieces(monkeypatch):
    # pieces far smaller than a sequence, so every seam is crossed
    monkeypatch.setattr(T, "PIECE_CODONS", 10)


PARAMS = T.TagParams(min_temp=64, max_temp=72, min_recoded=35, min_distance=40, max_distance=120)
LENGTHS = [0, 2, 23, 24, 26, 27, 54, 300, 602, 901]


def test_windows_match_brute_force(spark, small_pieces):
    df, rows = sequences(spark, LENGTHS)
    got = {(r.seq_id, r.start): (r.score, r.new) for r in T.filter_windows(T.recode_windows(df), PARAMS).collect()}
    assert got == expected_windows(rows, PARAMS)
    every = {(i, s) for i, q in rows for s in range(max(0, len(q) // 3 - 7))}
    assert {(r.seq_id, r.start) for r in T.codon_windows(df, spread=False).collect()} == every
    codons = {(r.seq_id, r.i): r.codon for r in T.codon_table(df).collect()}
    assert codons == {(i, k // 3): q[k:k + 3] for i, q in rows for k in range(0, len(q) - 2, 3)}


def test_pairs_match_brute_force(spark, small_pieces):
    df, rows = sequences(spark, LENGTHS)
    want = expected_pairs(expected_windows(rows, PARAMS), PARAMS)
    got = [(r.seq_id, r.left_start, r.right_start, r.score) for r in T.window_pairs(df, PARAMS).collect()]
    assert sorted(got) == sorted(want) and len(want) > 50
    partners = {}
    for s, left, right, score in want:
        n, best, near = partners.get((s, left), (0, -1, 0))
        partners[s, left] = (n + 1, max(best, score), right if score > best or score == best and right < near else near)
    assert {(r.seq_id, r.left_start): (r.partners, r.score, r.right_start) for r in T.window_partners(df, PARAMS).collect()} == partners
    top = {}
    for s, *_, score in want:
        top[s] = max(score, top.get(s, 0))
    best = {(r.seq_id, r.left_start, r.right_start, r.score) for r in T.best_pairs(df, PARAMS).collect()}
    assert best == {w for w in want if w[3] == top[w[0]]}
    last = {(r.seq_id, r.left_start, r.right_start) for r in T.best_pairs(df, PARAMS, "parity").collect()}
    assert last == {max((w[0], w[1], w[2]) for w in want if w[0] == s) for s in top}


def brute_parity(rows, params):
    """The result list of a search whose score to beat stays 0, replayed pair by pair."""
    windows, out = expected_windows(rows, params), {}
    for s, i, j, score in sorted(expected_pairs(windows, params)):
        listed = out.setdefault(s, [])
        if score > 0:
            listed.clear()
        listed.append((i, j, score))
    return out


def test_ties_are_counted_without_listing(spark, small_pieces):
    df, rows = sequences(spark, LENGTHS, seed=9)
    want = expected_pairs(expected_windows(rows, PARAMS), PARAMS)
    ties = {}
    for s, i, j, score in sorted(want):
        if score == max(w[3] for w in want if w[0] == s):
            ties.setdefault(s, []).append((i, j, score))
    got = {r.seq_id: (r.ties, r.score, r.first_left, r.first_right, r.left_start, r.right_start, r.min_distance) for r in T.pair_ties(df, PARAMS).collect()}
    assert got == {s: (len(t), t[0][2], *t[0][:2], *t[-1][:2], min(3 * (j - i + 8) for i, j, _ in t)) for s, t in ties.items()}
    assert max(len(t) for t in ties.values()) > 1
    last = {r.seq_id: r.asDict() for r in T.last_pair(T.best_pairs(df, PARAMS)).collect()}
    for r in T.pair_ties(df, PARAMS).collect():
        assert last[r.seq_id] == {k: v for k, v in r.asDict().items() if k in last[r.seq_id]}


def test_parity_tail_against_a_replay(spark, small_pieces):
    params = T.TagParams(min_temp=0, max_temp=200, min_recoded=0, min_distance=40, max_distance=120)
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(["ATGTGG", "ATG", "TGG", "GCA" if i % 3 else "ATG"]) for _ in range(60)) + "ATGTGG" * (i * 4)) for i in range(9)]
    rows += [(20, "ATGTGG" * 40), (21, "GCA" * 70), (22, "ATG" * 9)]
    df = spark.createDataFrame(rows, "seq_id bigint, seq string")
    want = brute_parity(rows, params)
    got = {r.seq_id: r for r in T.parity_tail(df, params).collect()}
    assert sorted(got) == sorted(want)
    for s, listed in want.items():
        positive = [(i, j) for i, j, score in listed if score > 0]
        r = got[s]
        assert ((r.left_start, r.right_start) if positive else (None, None)) == (positive[0] if positive else (None, None))
        assert r.tail == len(listed) - len(positive) and (r.last_left, r.last_right) == listed[-1][:2]
    assert any(r.tail > 50 and r.left_start is not None for r in got.values()) and any(r.left_start is None for r in got.values())


def test_sequences_of_one_id_or_none_stay_apart(spark):
    rows = [(1, "ATGGCA" * 12), (1, "TGGGCACTT" * 9), (None, "ATGGCA" * 12), (None, "CTTCGA" * 10)]
    df = spark.createDataFrame(rows, "seq_id bigint, seq string")
    got = sorted((r.seq_id or 0, r.start, r.old) for r in T.recode_windows(df).collect())
    assert got == sorted((i or 0, k, q[3 * k:3 * k + 24]) for i, q in rows for k in range(len(q) // 3 - 7))


def test_tagged_sequence_keeps_its_protein(spark):
    df, rows = sequences(spark, [900])
    pairs = T.last_pair(T.design_tags(df, PARAMS))
    r = T.apply_tags(df, pairs).first()
    seq = rows[0][1]
    amino = S.amino_table()
    assert len(r.tagged) == len(seq) and r.tagged != seq
    assert [amino[r.tagged[i:i + 3]] for i in range(0, 900, 3)] == [amino[seq[i:i + 3]] for i in range(0, 900, 3)]
    changed = {i for i in range(900) if r.tagged[i] != seq[i]}
    assert len(changed) == r.score
    assert all(3 * r.left_start <= i < 3 * r.left_start + 24 or 3 * r.right_start <= i < 3 * r.right_start + 24 for i in changed)


def test_rejects_add_up(spark):
    df, rows = sequences(spark, [200, 400])
    for r in T.window_rejects(T.recode_windows(df), PARAMS).collect():
        assert r.windows == len(rows[r.seq_id][1]) // 3 - 7 == r.rejected_temp + r.rejected_percent + r.kept


def test_checks(spark):
    df = spark.createDataFrame([(1, "ACGT" * 25), (2, "acg t\n" * 25), (3, "ACGU" * 25), (4, "AC")], "seq_id int, seq string")
    got = {r.seq_id: r.errors for r in T.validate_sequences(df).collect()}
    assert got == {1: [], 2: [], 3: ["alphabet"], 4: ["length"]}
    short = spark.createDataFrame([(1, "A C" * 40)], "seq_id int, seq string")
    assert T.validate_sequences(short, mode="parity").first().errors == [] and T.validate_sequences(short).first().errors == ["length"]


def test_design_checks(spark):
    names = ["min_temp", "max_temp", "min_recoded", "min_amp", "max_amp"]
    rows = [("9", "10", "50", "100", "1000"), ("60", "50", "101", "99", "1001"), ("x", "10", "0", "500", "400")]
    got = [r.errors for r in T.validate_design(spark.createDataFrame(rows, names)).collect()]
    assert got == [[], ["temp_range", "min_recoded", "min_amp", "max_amp"], ["min_temp", "amp_range"]]


def test_pieces_are_scored_once(spark):
    df = spark.createDataFrame([(i, "".join(random.Random(i).choices("ACGT", k=3 * 300))) for i in range(4)], "seq_id bigint, seq string")
    for run in (T.best_pairs, T.parity_tail):
        plan = run(df, PARAMS)._jdf.queryExecution().executedPlan().toString()
        # one table of codons is joined, below the only pass over the pieces
        assert plan.count("BroadcastHashJoin") == 1, run.__name__


def test_pairs_keep_letters_outside_ascii(spark):
    text = "é" + "".join(random.Random(5).choices("ACGT", k=3 * 200))
    records = spark.createDataFrame([("ACGT" * 20,), (text,)], "new string")
    at = T._with_bytes(records).selectExpr("new", "_bytes", "1 as _k", "4 as _j", "array(1Y, 2Y, 3Y, 4Y, 5Y) as s").select("new", "_bytes", *T._pair_details())
    for r in at.collect():
        assert (r.left_new, r.right_new) == (r.new[3:27], r.new[12:36])
        assert (r["_bytes"] is None) == (r.new == text)
