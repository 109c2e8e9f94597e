import pytest
from pyspark.sql import functions as F

from variloom.operators import cohort as C
from variloom.operators import runstate as R

MANIFEST = ("row_id bigint, file_gdc_id string, program_name string, project_short_name string, barcode string, "
            "file_name string, file_size bigint, platform string, file_gcs_url string")


def manifest(spark, barcodes):
    rows = [(i, f"g{i}", "TCGA", "TCGA-GBM", b, f"{b}.bam", 10 * (i + 1), "HiSeq", f"gs://b/{i}") for i, b in enumerate(barcodes)]
    return spark.createDataFrame(rows, MANIFEST)


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "case_id string")


def test_pair_adjacent_quirks(spark):
    df = manifest(spark, ["T-1-1-01A", "T-1-1-10A",   # tumor, normal
                          "T-1-2-11A", "T-1-2-02A",   # normal, tumor
                          "T-1-3-01A", "T-1-3-01B",   # two tumors: the second stays, no normal
                          "T-1-4-01A", "T-1-5-10A",   # different cases, the normal second
                          "T-1-6-01A"])               # no partner
    pairs = {r["index"]: r for r in C.pair_adjacent(df, "row_id").collect()}
    assert [pairs[i].case_id for i in range(5)] == ["T-1-1", "T-1-2", "T-1-3", "T-1-4", "T-1-6"]
    assert (pairs[0].tumor_barcode, pairs[0].normal_barcode, pairs[0].total_size) == ("T-1-1-01A", "T-1-1-10A", 30)
    assert (pairs[1].tumor_barcode, pairs[1].normal_barcode) == ("T-1-2-02A", "T-1-2-11A")
    assert (pairs[2].tumor_barcode, pairs[2].normal_barcode, pairs[2].total_size) == ("T-1-3-01B", None, 60)
    found = C.pair_adjacent(df, "row_id")
    assert {r["index"] for r in C.pair_mismatches(found).collect()} == {2, 3, 4}
    # parity compares the second row with the normal side: pair 3 passes for itself
    assert {r["index"] for r in C.pair_mismatches(found, "parity").collect()} == {2, 4}


def test_pair_by_case(spark):
    df = manifest(spark, ["T-1-1-01A", "T-1-1-10A", "T-1-1-02A", "T-1-1-11A", "T-1-2-01A"])
    first = C.pair_by_case(df, "row_id").collect()
    assert [(r.tumor_barcode, r.normal_barcode) for r in first] == [("T-1-1-01A", "T-1-1-10A")]
    each = C.pair_by_case(df, "row_id", "each").collect()
    assert {(r.tumor_barcode, r.normal_barcode) for r in each} == {("T-1-1-01A", "T-1-1-10A"), ("T-1-1-02A", "T-1-1-10A")}


def test_routing_is_a_partition(spark):
    pairs = ids(spark, *"abcdef").withColumn("total_size", F.lit(1))
    routed = C.route(pairs, ids(spark, "a", "b"), ids(spark, "b", "c"))
    names = [{r.case_id for r in d.collect()} for d in routed]
    assert names == [{"a", "b"}, {"c"}, {"c", "d", "e", "f"}]
    assert {r.case_id for r in C.route(pairs, ids(spark, "a"), ids(spark, "c"), True).to_run.collect()} == set("bdef")
    state = C.seed_state(pairs, ids(spark, "a", "b"), ids(spark, "b", "c"), ids(spark, "d"))
    assert {(r.case_id, r.state) for r in state.collect()} == {
        ("a", "finished"), ("b", "finished"), ("c", "failed"), ("c", "queued"), ("e", "queued"), ("f", "queued")}
    queued = {r.case_id for r in C.rebuild_queue(routed.to_run, ids(spark, "d")).collect()}
    assert queued == {r.case_id for r in state.where("state = 'queued'").collect()}


def test_lookups(spark):
    dim = spark.createDataFrame([("a", "X", 1), ("a", "Y", 2)], "case_id string, code string, o int")
    assert C.lookup_strict(ids(spark, "a"), dim, "case_id", "code", "o").first().code == "Y"
    with pytest.raises(Exception, match="no code for b"):
        C.lookup_strict(ids(spark, "b"), dim, "case_id", "code", "o").collect()


def test_repair_modes(spark):
    pairs = spark.createDataFrame([("T", "N", "old-t", "old-n")], "tumor_barcode string, normal_barcode string, tumor_file_url string, normal_file_url string")
    new = spark.createDataFrame([("N", "gs://x/n", 1), ("T", "gs://y/t", 2), ("N", "gs://z/n2", 3)], "barcode string, url string, o int")
    both = C.repair_urls(pairs, new, "o")
    assert (both.first().tumor_file_url, both.first().normal_file_url) == ("gs://y/t", "gs://x/n")
    one = C.repair_urls(pairs, new, "o", "parity")
    assert (one.first().tumor_file_url, one.first().normal_file_url) == ("old-t", "gs://x/n")
    assert {(r.bucket, r.n) for r in C.count_by_bucket(one).collect()} == {("gs://x", 1)}


def test_contains_join_is_grep(spark):
    lines = spark.createDataFrame([(1, "xx T-10 yy T-10"), (2, "T-1"), (3, "none"), (4, ""), (5, None)], "n int, line string")
    wanted = spark.createDataFrame([("T-1", "P"), ("T-10", "F"), ("T-10", "P"), ("", "P")], "case_id string, status string")
    got = sorted((r.n, r.case_id, r.status) for r in C.contains_join(lines, wanted).collect())
    assert got == [(1, "T-1", "P"), (1, "T-10", "F"), (1, "T-10", "P"), (2, "T-1", "P")]


def test_cancer_codes_start_at_zero(spark):
    df = spark.createDataFrame([("GBM",), ("GBM",), ("NEW",)], "cancer_type string")
    got = {r.cancer_type: r.n for r in C.count_by_cancer(df).collect()}
    assert len(got) == 26 and got["GBM"] == 2 and got["OV"] == 0 and got["NEW"] == 1


def jobs(spark, rows):
    return spark.createDataFrame(rows, "job_id bigint, command string, job_state string, submit_time string, req_nodes string, nodes string")


def test_job_summary_last_values(spark):
    df = jobs(spark, [(1, "/h/u/t/A/1", "RUNNING", "t1", "n1", "n1"), (2, "/h/u/t/A/2", "TIMEOUT", None, "n2,n3", None),
                      (3, "/h/u/t/B/1", "NODE_FAIL", "t3", "n1", None), (4, "/short", "FAILED", "t", "n9", None)])
    work = ids(spark, "A", "B", "C")
    got = {r.case_id: (r.submit_time, r.node, r.requested, r.progress) for r in R.progress(work, df).collect()}
    assert got == {"A": ("NA", "n1", "n2, n3", "1 | 0 | 1"), "B": ("t3", "Un-assigned", "n1", "0 | 0 | 0")}


def test_nodes(spark):
    df = jobs(spark, [(1, "/h/u/t/A/1", "RUNNING", "t1", "n1,n2", "n1"), (2, "/h/u/t/A/2", "RUNNING", "t", "n1,gone", None)])
    nodes = spark.createDataFrame([("n1", "IDLE"), ("n2", "DOWN*"), ("n3", "DOWN"), ("n4", "MIXED"), ("n5", "IDLE")], "node string, state string")
    assert {r.node: r.jobs_requested for r in R.node_status(nodes, df).collect()} == {"n1": 2, "n2": 1, "n3": 0, "n4": 0, "n5": 0}
    assert R.least_loaded(nodes, df).first().node == "n4"
    assert R.filter_nodes(nodes, ["all"]).count() == 5 and R.filter_nodes(nodes, ["n1"]).count() == 1


def test_large_cases_are_paged(spark):
    rows = [(i, f"/h/u/t/{'HOT' if i < 500 else 'B'}/x", "RUNNING", "t", "n", "n") for i in range(520)]
    nested = R.jobs_by_case(jobs(spark, rows), page_size=50).collect()
    hot = [r for r in nested if r.case_id == "HOT"]
    assert {r.page: set(r.jobs) for r in hot} == {p: set(range(50 * p, 50 * p + 50)) for p in range(10)}
    # the rule is the same for a small case
    assert [(r.page, len(r.jobs)) for r in nested if r.case_id == "B"] == [(10, 20)]


def test_finish_records_move_every_row(spark):
    processing = spark.createDataFrame([(1, "a", "n1", "t1"), (2, "a", "n2", "t2"), (3, "b", "n3", "t3"), (4, "c", "n4", "t4"), (5, "d", None, "t5")],
                                       "row_id bigint, case_id string, normal_file string, tumor_file string")
    records = spark.createDataFrame([("n1", "t1"), ("n2", "t2"), ("n2", "t2"), ("n3", "t3"), ("x", "y"), (None, "t5")], "normal string, tumor string")
    got = {(r.row_id, r.from_state, r.to_state): r.inserted for r in R.finish_transition(processing, ids(spark, "b", "b"), records).collect()}
    # b is finished already: its row leaves processing all the same
    assert got == {(1, "processing", "finished"): True, (2, "processing", "finished"): False, (3, "processing", "finished"): False}
    running = spark.createDataFrame([("n1", "t1", 4), ("n1", "t1", 5), ("n9", "t9", 4)], "normal string, tumor string, stage int")
    assert sorted(r.stage for r in R.finish_running(running, records).collect()) == [4, 5]


def test_first_and_last_in_one_pass(spark):
    from variloom.operators.ordering import first_and_last

    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 3, "z"), ("b", 1, "w")], "k string, o int, v string")
    assert {tuple(r) for r in first_and_last(df, "k", "o", "v").collect()} == {("a", "y", "z"), ("b", "w", "w")}


def test_submission(spark):
    queue = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c")], "o int, case_id string")
    ok = ids(spark, "b")
    good = R.submit_batch(queue, 3, ok, "o").collect()
    assert [(r.case_id, r.to_state) for r in good] == [("b", "processing")]
    all_out = {(r.case_id, r.to_state) for r in R.submit_batch(queue, 3, ok, "o", "parity").collect()}
    assert all_out == {("a", None), ("b", "processing")}
    assert R.submit_case(queue, "b", True).count() == 1 and R.submit_case(queue, "b", False).count() == 0


def test_reset_plan():
    assert R.reset_plan() == R.RUN_TABLES
    assert R.reset_plan(finished=True)[-1] == "finished"
    assert set(R.METRIC_TABLES) <= set(R.reset_plan(everything=True)) and "finished" not in R.reset_plan(everything=True)
    assert R.reset_plan(only_finished=True) == ["finished"]


def test_preview_marks_hidden_rows(spark):
    queue = spark.createDataFrame([(i,) for i in range(60)], "o int")
    assert R.queue_preview(queue, "o").where("more_hidden").count() == 50
    assert R.queue_preview(queue.limit(50), "o").where("more_hidden").count() == 0


def test_contains_join_by_anchors_against_brute_force(spark):
    import random

    rng = random.Random(6)
    names = sorted({"TCGA-" + "".join(rng.choice("AB-1") for _ in range(rng.randrange(0, 9))) for _ in range(60)} | {"A", "B1", "-é-", "TCGA"})
    texts = ["".join(rng.choice(["TCGA-", "A", "B", "-", "1", "é", " "]) for _ in range(rng.randrange(0, 30))) for _ in range(400)] * 2
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, line string")
    wanted = spark.createDataFrame([(n, "s") for n in names], "case_id string, status string")
    found = C.contains_join(lines, wanted)
    assert sorted((r.n, r.case_id) for r in found.collect()) == sorted((i, n) for i, t in enumerate(texts) for n in names if n in t)
    assert C.contains_join(lines, wanted.limit(0)).count() == 0
