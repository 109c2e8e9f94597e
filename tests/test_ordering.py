import random

from pyspark.sql import functions as F

from variloom.operators import ordering as O
from variloom.operators.reads import is_sorted, sort_if_needed


def shuffled(spark, n):
    keys = random.Random(1).sample(range(10 * n), n)
    return spark.createDataFrame([(k, k % 3) for k in keys], "k bigint, v bigint").repartition(7), sorted(keys)


def test_row_index_over_many_ranges(spark):
    df, keys = shuffled(spark, 500)
    assert len(O.range_cuts(df, "k", 20)) > 10
    rows = O.row_index(df, "k", rows_per_range=20).orderBy("k").collect()
    assert [r.k for r in rows] == keys and [r.row_no for r in rows] == list(range(1, 501))


def test_running_totals_over_many_ranges(spark):
    df, keys = shuffled(spark, 300)
    got = O.running_totals(df, "k", {"a": F.col("v") == 0, "b": F.col("v")} | {"a": (F.col("v") == 0).cast("int")}, 17)
    a = b = 0
    for row, k in zip(got.orderBy("k").collect(), keys):
        a, b = a + (k % 3 == 0), b + k % 3
        assert (row.k, row.a, row.b) == (k, a, b)


def test_range_of_edges(spark):
    df = spark.createDataFrame([(i,) for i in range(8)], "k bigint")
    got = df.select(O.range_of(F.col("k"), [2, 3, 6])).collect()
    assert [r[0] for r in got] == [0, 0, 1, 2, 2, 2, 3, 3]


def test_file_row_index_over_splits(spark, tmp_path):
    for name, count in (("a.txt", 400), ("b.txt", 150)):
        (tmp_path / name).write_text("".join(f"{name}:{i}\n" for i in range(1, count + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = spark.read.text(str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3
        whole = O.file_row_index(lines).orderBy("row_no").collect()
        assert [r.value for r in whole] == [f"a.txt:{i}" for i in range(1, 401)] + [f"b.txt:{i}" for i in range(1, 151)]
        assert [r.row_no for r in whole] == list(range(1, 551))
        each = O.file_row_index(lines, per_file=True).collect()
        assert all(r.value.endswith(f":{r.row_no}") for r in each)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_first_last_and_insert(spark):
    new = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, o int, v string")
    assert {(r.k, r.v) for r in O.first_per_key(new, "k", "o").collect()} == {("a", "y"), ("b", "z")}
    assert {(r.k, r.v) for r in O.last_per_key(new, "k", "o").collect()} == {("a", "x"), ("b", "z")}
    target = spark.createDataFrame([("b",)], "k string")
    assert [(r.k, r.v) for r in O.insert_ignore(target, new, "k", "o").collect()] == [("a", "y")]


def test_is_sorted_over_many_ranges(spark):
    rows = [(i, f"chr{1 + i // 60}", 1 + i % 60) for i in range(300)]
    good = spark.createDataFrame(rows, "o bigint, chrom string, pos bigint")
    assert tuple(is_sorted(good, "o", 25).first()) == (True, 0)
    swapped = [(o, c, 10**6 if o in (49, 50, 120) else p) for o, c, p in rows]
    bad = spark.createDataFrame(swapped, "o bigint, chrom string, pos bigint")
    keys = [(int(c[3:]), p) for _, c, p in swapped]
    assert is_sorted(bad, "o", 25).first()["inversions"] == sum(a > b for a, b in zip(keys, keys[1:]))
    # references outside the fixed ranks are told apart by name
    contigs = lambda rows: spark.createDataFrame(rows, "o bigint, chrom string, pos bigint")
    assert tuple(is_sorted(contigs([(1, "chrUn_a", 100), (2, "chrUn_b", 1)]), "o").first()) == (True, 0)
    assert tuple(is_sorted(contigs([(1, "chrUn_b", 1), (2, "chrUn_a", 2)]), "o").first()) == (False, 1)
    ordered = [r.pos for r in sort_if_needed(bad, "o", ["o"]).collect()]
    assert ordered == [p for _, p in sorted(keys)]


def test_next_rows_over_many_ranges(spark, monkeypatch):
    df, keys = shuffled(spark, 400)
    for least in (O.SAMPLE_KEYS, 90):
        # with a small sample the number of rows is read off its hashes
        monkeypatch.setattr(O, "SAMPLE_KEYS", least)
        rows = O.with_next(df, "k", rows_per_range=20).orderBy("row_no").collect()
        assert [(r.k, r.row_no, r.following and r.following.k) for r in rows] == [(k, i + 1, n) for i, (k, n) in enumerate(zip(keys, [*keys[1:], None]))]
        assert 8 <= len(O.range_cuts(df, "k", 20)) <= 60
    assert O.with_next(df.limit(0), "k").count() == 0 and O.range_cuts(df.limit(0), "k") == []


def test_pairs_read_one_exchange(spark):
    from variloom.operators import cohort as C

    rows = [(i, f"g{i}", "TCGA", "TCGA-GBM", f"T-02-{i // 2:04d}-{code}-01D", f"f{i}", 5, "H", "u") for i, code in enumerate(["01A", "10A", "10A", "10A", "01A"] * 9)]
    names = ["file_gdc_id", "program_name", "project_short_name", "barcode", "file_name", "file_size", "platform", "file_gcs_url"]
    pairs = C.pair_adjacent(spark.createDataFrame(rows, ["row_no_in", *names]), "row_no_in")
    got = {r["index"]: (r.tumor_file, r.normal_file, r.last_barcode) for r in pairs.collect()}
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and plan.split("== Initial Plan ==")[0].count("REPARTITION_BY_NUM") <= 2
    want = {}
    for k in range(0, len(rows), 2):
        side = {}
        for r in rows[k:k + 2]:
            side["tumor" if "-01A-" in r[4] else "normal"] = r[5]
        want[k // 2] = (side.get("tumor"), side.get("normal"), rows[min(k + 1, len(rows) - 1)][4])
    assert got == want


def test_file_row_index_neither_sorts_nor_exchanges_rows(spark, tmp_path):
    spark.range(1000, numPartitions=5).selectExpr("id", "id * 3 as x").write.parquet(str(tmp_path / "t"))
    rows = O.file_row_index(spark.read.parquet(str(tmp_path / "t")), "place", per_file=False)
    got = rows.collect()
    assert [(r.place, r.x) for r in sorted(got)] == [(i + 1, 3 * i) for i in range(1000)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    # the rows are the join's streamed side; only the table of splits is exchanged and sorted, below the broadcast
    assert "BroadcastHashJoin" in plan and "Exchange" not in plan[:plan.index("BroadcastHashJoin")]
    assert all("id#" not in line for line in plan.splitlines() if "Sort [" in line or "Window [" in line)
