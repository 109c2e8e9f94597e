"""Depth by sweep, order by header, order test by file splits."""

import random
from collections import Counter
from statistics import median

from variloom.operators import reads as G
from variloom.operators import somatic as P
from variloom.sources import genomics as B


def test_segments_against_depth_by_base(spark, monkeypatch):
    monkeypatch.setattr(G, "BIN", 16)
    rng = random.Random(2)
    runs = [(f"s{i % 2}", f"chr{i % 3}", rng.randrange(400), rng.choice([0, 1, 5, 40, 200])) for i in range(300)] + [("s0", "chr0", 900, 1)] * 50
    df = spark.createDataFrame(runs, "sample string, chrom string, start bigint, size int")
    depth = Counter((s, c, p) for s, c, start, size in runs for p in range(start, start + size))
    segments = G.depth_segments(df, ["sample"]).collect()
    assert Counter({(r.sample, r.chrom, p): r.depth for r in segments for p in range(r.start, r.end)}) == depth
    assert sum(r.end - r.start for r in segments) == len(depth)
    for r in G.coverage_runs(df, ["sample"]).collect():
        own = [n for (s, c, _), n in depth.items() if (s, c) == (r.sample, r.chrom)]
        assert (r.positions, r.mean_depth, r.median_depth, r.max_depth) == (len(own), sum(own) / len(own), median(own), max(own))


def test_a_sweep_counts_its_events_once(spark):
    runs = spark.range(1000).selectExpr("concat('chr', id % 3) as chrom", "id * 7 as start", "5 as size").union(
        spark.sql("select cast(null as string), 1L, 5"))
    segments = G.depth_segments(runs)
    assert segments.agg({"depth": "sum"}).first()[0] == 1000
    segments.collect()
    assert "ReusedExchange" in segments._jdf.queryExecution().executedPlan().toString()


def test_runs_of_alignments(spark):
    df = spark.createDataFrame([("chr1", 10, "3S4M2D3M1I2M5N1M2H"), ("chr1", 5, "*")], "chrom string, pos bigint, cigar string")
    assert [(r.start, r.size) for r in P.aligned_runs(df).collect()] == [(10, 4), (16, 3), (19, 2), (26, 1)]


def test_a_sweep_has_no_row_per_base(spark):
    df = spark.createDataFrame([("chr1", 100, 10 ** 8), ("chr1", 5 * 10 ** 7, 10 ** 8), ("chr2", 1, 10 ** 9)], "chrom string, start bigint, size int")
    assert G.depth_segments(df).count() == 4
    stats = {r.chrom: (r.positions, r.max_depth, r.median_depth) for r in G.coverage_runs(df).collect()}
    assert stats == {"chr1": (5 * 10 ** 7 - 100 + 10 ** 8, 2, 1.0), "chr2": (10 ** 9, 1, 1.0)}


def test_a_shuffled_header_gives_its_order(spark, tmp_path):
    names = ["chr3", "1", "chrUn_b", "X", "chr2"]
    lines = ["@HD\tVN:1.6", *(f"@SQ\tSN:{n}\tLN:100" for n in names), "@SQ\tSN:chr3\tLN:100", "@RG\tID:a"]
    reads = [(f"r{i}", c, p) for i, (c, p) in enumerate((c, p) for p in (5, 1) for c in ("2", "chrZ", "*", "X", "1", "chrUn_b", "chrA", "chr3"))]
    lines += [f"{n}\t0\t{c}\t{p}\t9\t1M\t*\t0\t0\tA\tI" for n, c, p in reads]
    (tmp_path / "a.sam").write_text("\n".join(lines) + "\n")
    header, rows = B.read_sam(spark, str(tmp_path / "a.sam"))
    order = G.header_order(header)
    assert [r.chrom for r in order.orderBy("rank").collect()] == ["chr3", "chr1", "chrUn_b", "chrX", "chr2"]
    got = [(r.chrom, r.pos) for r in G.coordinate_sort(G.reheader(rows), ["qname"], order).collect()]
    assert got == [(c, p) for c in ("chr3", "chr1", "chrUn_b", "chrX", "chr2", "chrA", "chrZ", "*") for p in (1, 5)]


def test_order_of_files_without_a_shuffle_of_reads(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"chr{1 + i // 150}" if i < 700 else f"chrUn_{i // 50}", i % 150 + 1) for i in range(1000)]

    def written(name, rows):
        for k in range(4):
            spark.createDataFrame(rows[k * 250:(k + 1) * 250], "chrom string, pos bigint").coalesce(1).write.parquet(f"{tmp_path}/{name}/f={k}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    key = lambda r: (int(r[0][3:]) if not r[0].startswith("chrUn") else 26, r[0], r[1])
    mixed = list(rows)
    for _ in range(30):
        i, j = rng.randrange(1000), rng.randrange(1000)
        mixed[i], mixed[j] = mixed[j], mixed[i]
    mixed[249], mixed[250] = mixed[999], mixed[0]
    for name, own in (("good", sorted(rows, key=key)), ("mixed", mixed)):
        want = sum(key(a) > key(b) for a, b in zip(own, own[1:]))
        tested = G.is_sorted_files(written(name, own))
        assert tuple(tested.first()) == (want == 0, want)
    assert "hashpartitioning" not in G.split_edges(written("plan", rows))._jdf.queryExecution().executedPlan().toString()
    assert tuple(G.is_sorted_files(spark.read.parquet(f"{tmp_path}/good").where("pos < 0")).first()) == (True, 0)
