import re

import pytest
from pyspark.sql import functions as F

from variloom.operators import runstate as R
from variloom.session import work_path
from variloom.sinks import files as K
from variloom.sources import files as S
from variloom.sources import metrics as M
from variloom.streaming import stages as X


def test_lists(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("\nA\nB,x\n\nA\n")
    assert sorted(r.case_id for r in S.read_ids(spark, str(tmp_path / "ids.txt")).collect()) == ["A", "A", "B"]
    assert S.read_ids(spark, str(tmp_path / "none.txt")).count() == 0
    (tmp_path / "v.csv").write_text("A, FAILED\nB, PASSED\n")
    assert {tuple(r) for r in S.read_status(spark, str(tmp_path / "v.csv")).collect()} == {("A", "FAILED"), ("B", "PASSED")}
    (tmp_path / "c.json").write_text("{'OV': 3, 'disease_code': 1}")
    assert [tuple(r) for r in S.read_count_dict(spark, str(tmp_path / "c.json")).collect()] == [("OV", 3)]
    (tmp_path / "codes.csv").write_text("OV\nOV\nGBM\n")
    assert S.read_codes(spark, str(tmp_path / "codes.csv")).count() == 3


def test_pair_files(spark, tmp_path):
    line = "1,C,Tb,Tf,Tg,Tu,10.0,P,Nb,Nf,Ng,Nu,412345678901,P,OV,0"
    (tmp_path / "p.csv").write_text("h" + ",h" * 15 + "\n" + line + "\n")
    r = S.read_pairs(spark, str(tmp_path / "p.csv"), header=True).first()
    assert (r["index"], r.tumor_file_size, r.normal_file_size, r.cancer_type) == (1, 10, 412345678901, "OV")
    (tmp_path / "WHITE_TODO_KIRP_MATCHED.csv").write_text(line + ",gs://a,gs://b\n")
    t = S.read_todo(spark, str(tmp_path / "*_TODO_*_MATCHED.csv")).first()
    assert (t.cohort, t.cancer, t.new_normal_url) == ("WHITE", "KIRP", "gs://b")


def test_metrics(spark):
    bodies = ['{"ID":"a","ElapsedTime_s":"1:02.50","CPU_Percent":"50%","ExitStatus":"0"}', '{"ID":"b","ExitStatus":"x"}', '{"ID":']
    parsed = M.parse_metrics(spark.createDataFrame([(b,) for b in bodies], "body string"))
    good = {r.ID: (r.elapsed, r.cpu, r.ExitStatus) for r in M.good_metrics(parsed).collect()}
    assert good == {"a": (62.5, 0.5, 0), "b": (None, None, None)}
    assert [r.body for r in M.bad_metrics(parsed).collect()] == ['{"ID":']


def test_scan_table_refuses_other_names(spark):
    with pytest.raises(ValueError):
        S.scan_table(spark, "secrets", R.RUN_TABLES)


SCHEMA = "event_id bigint, ts timestamp, normal string, tumor string, stage int"


def batch(spark, path, rows):
    spark.createDataFrame([(i, None, n, "t", s) for i, n, s in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_across_restarts(spark):
    source, out = work_path(spark, "in"), work_path(spark, "out")
    batch(spark, source, [(1, "a", 1), (2, "b", 1), (3, "a", 5)])
    events = X.read_events(spark, source, SCHEMA)
    X.run_batches(R.current_stage(events), "update", out).awaitTermination()
    batch(spark, source, [(4, "b", 9), (5, "c", 2)])
    X.run_batches(R.current_stage(X.read_events(spark, source, SCHEMA)), "update", out).awaitTermination()
    got = {(r.normal, r.stage) for r in X.latest_per_key(spark, out, ["normal", "tumor"]).collect()}
    want = {(r.normal, r.stage) for r in R.current_stage(spark.read.parquet(source)).collect()}
    assert got == want == {("a", 5), ("b", 9), ("c", 2)}


def test_json_stream_counts(spark, tmp_path):
    folder = tmp_path / "events"
    folder.mkdir()
    for i, stage in enumerate([1, 1, 9]):
        (folder / f"{i}.json").write_text('{"Normal":"n","Tumor":"t","Stage":%d}' % stage)
    events = X.read_json_events(spark, str(folder), "Normal string, Tumor string, Stage int").withColumnRenamed("Stage", "stage")
    got = {(r.stage, r.n) for r in X.run_to_end(X.stage_counts(events), "complete", "json").collect()}
    assert got == {(1, 2), (9, 1)}


def test_mirror_stage_keeps_old(spark):
    work = spark.createDataFrame([("a", "t", 3), ("z", "t", 4)], "normal_file string, tumor_file string, stage int")
    now = spark.createDataFrame([("a", "t", 7)], "normal string, tumor string, stage int")
    assert {(r.normal_file, r.stage) for r in R.mirror_stage(work, now).collect()} == {("a", 7), ("z", 4)}
    assert R.by_stage(now, "<").select(F.count("*")).first()[0] == 1


def test_manifest_file_to_work_units(spark, tmp_path):
    from variloom.operators import cohort as C
    from variloom.operators.ordering import file_row_index

    head = "file_gdc_id,program_name,project_short_name,barcode,file_name,file_size,platform,file_gcs_url\n"
    rows = []
    for case in range(40):
        for code in ("01A", "10A"):
            name = f"T-02-{case:04d}-{code}-01D"
            rows.append(f"g{case}{code},TCGA,TCGA-GBM,{name},{name}.bam,{100 + case},HiSeq,gs://b{case % 3}/w/{name}.bam\n")
    (tmp_path / "m.csv").write_text(head + "".join(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        numbered = file_row_index(S.read_manifest(spark, str(tmp_path / "m.csv")))
        pairs = C.pair_adjacent(numbered, "row_no")
        assert pairs.count() == 40 and C.pair_mismatches(pairs).count() == 0
        assert {(r["index"], r.case_id, r.total_size) for r in pairs.collect()} == {
            (i, f"T-02-{i:04d}", 200 + 2 * i) for i in range(40)}
        units = C.expand_units(pairs)
        assert units.count() == 1000
        one = units.where("case_id = 'T-02-0003' and reference = 'chrX.fa'").first()
        assert one.tumor_ref_file == "T-02-0003-01A-01D.REF_chrX.bam"
        assert {r.cancer_type: r.n for r in C.count_by_cancer(pairs).where("n > 0").collect()} == {"GBM": 40}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_live_views_do_not_hang_on_file_count(spark, tmp_path):
    rows = [(i, f"/h/u/t/c{i % 5}/x", "RUNNING", None, f"n{i % 3}", None) for i in range(1500)]
    jobs = spark.createDataFrame(rows, "job_id bigint, command string, job_state string, submit_time string, req_nodes string, nodes string")
    nodes = spark.createDataFrame([("n0", "IDLE"), ("n1", "IDLE"), ("n2", "DOWN")], "node string, state string")
    work = spark.createDataFrame([("c0",), ("c4",)], "case_id string")
    folder = str(tmp_path / "jobs")
    jobs.repartition(5).write.parquet(folder)
    want = {r.node: r.jobs_requested for r in R.node_status(nodes, jobs).collect()}
    for files in (1, 2, 1000):
        stream = X.read_events(spark, folder, jobs.schema, "*.parquet", files)
        path = X.write_to_end(stream, "live")
        assert {r.node: r.jobs_requested for r in X.live_node_view(spark, path, nodes).collect()} == want == {"n0": 500, "n1": 500, "n2": 500}
        assert {r.case_id: r.progress for r in X.live_progress(spark, path, work).collect()} == {"c0": "300 | 0 | 0", "c4": "300 | 0 | 0"}


def test_json_records_share_files(spark, tmp_path):
    path = tmp_path / "records"
    rows = spark.range(2500, numPartitions=3).selectExpr("id", "concat('a\"', id) as name", "if(id % 7 = 0, null, id) as odd")
    K.write_json_records(rows, str(path), 400)
    # 834 rows at most in a partition, whose first and last files may be short
    files = list(path.glob("part-*"))
    assert len(files) <= 12 and max(f.read_text().count('"name"') for f in files) == 400
    (path / "part-alone.txt").write_text('{"id": -1,\n "name": "alone"}')
    back = S.read_json_records(spark, str(path), "id bigint, name string, odd bigint")
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [
        (-1, "alone", None), *((i, f'a"{i}', None if i % 7 == 0 else i) for i in range(2500))]


def test_reads_are_counted_without_sorting_them(spark, tmp_path):
    from variloom.plans import bridge
    from variloom.plans.registry import RUNS

    spark.range(50).selectExpr("id as p_partkey", "concat('Brand#', id % 5) as p_brand", "cast(id % 9 as int) as p_size").write.parquet(
        str(tmp_path / "part.parquet"))
    spark.range(400).selectExpr(
        "id as l_orderkey", "id % 50 as l_partkey", "id % 3 as l_suppkey", "cast(id % 7 as int) as l_linenumber", "cast(id % 50 + 1 as double) as l_quantity",
        "0.05 as l_tax", "'A' as l_returnflag", "if(id % 2 = 0, 'F', 'O') as l_linestatus").write.parquet(str(tmp_path / "lineitem.parquet"))
    found = RUNS["rt_sam"](spark, str(tmp_path))
    reads = bridge.Views(spark, str(tmp_path)).reads.collect()
    for r in found.collect():
        raw = r.chrom.removeprefix("chr")
        own = [x for x in reads if x.raw_chrom == raw and x.role == r.role]
        assert (r.n, r.pos_sum, r.flag_sum, r.min_base) == (len(own), sum(x.pos for x in own), sum(x.flag for x in own), min(x.base for x in own))
    # the sorting aggregate for the least text meets groups that a hash aggregate has counted
    assert re.search(r"HashAggregate\(keys=\[[^]]*seq#", found._jdf.queryExecution().executedPlan().toString())
