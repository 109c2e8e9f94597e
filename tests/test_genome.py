from pyspark.sql import functions as F

from variloom.operators import reads as G
from variloom.operators import somatic as P
from variloom.operators import variants as V
from variloom.sources import genomics as B

REF = "ACGTACGTACGTACGTACGT"


def sam(spark, tmp_path, rows):
    path = tmp_path / "x.sam"
    head = "@HD\tVN:1.6\n@SQ\tSN:1\tLN:20\n@SQ\tSN:MT\tLN:5\n"
    path.write_text(head + "".join("\t".join(map(str, r)) + "\n" for r in rows))
    return B.read_sam(spark, str(path))


def row(name, flag, pos, cigar, seq, mapq=60, tag=""):
    out = [name, flag, "1", pos, mapq, cigar, "*", 0, 0, seq, "I" * len(seq)]
    return out + [tag] if tag else out


def test_sam_and_flagstat(spark, tmp_path):
    header, reads = sam(spark, tmp_path, [
        row("a", 99, 1, "4M", "ACGT", tag="NM:i:0"), row("b", 1 | 8, 1, "4M", "ACGT"), row("c", 256, 1, "4M", "ACGT"),
        row("d", 2048, 1, "4M", "ACGT"), row("e", 4, 0, "*", "ACGT"), row("f", 512 | 1024, 1, "4M", "ACGT")])
    assert [(r.tag, r.raw_chrom, r.length) for r in header.orderBy("line").collect()] == [
        ("HD", "", None), ("SQ", "1", 20), ("SQ", "MT", 5)]
    assert tuple(G.any_renamed(header.where("tag = 'SQ'")).first()) == (True, 2)
    stats = {r.qc_fail: r.asDict() for r in G.flagstat(reads).collect()}
    assert stats[True]["total"] == 1 and stats[True]["duplicates"] == 1
    ok = stats[False]
    assert (ok["total"], ok["secondary"], ok["supplementary"], ok["mapped"]) == (5, 1, 1, 4)
    assert (ok["paired"], ok["proper"], ok["singletons"], ok["both_mapped"], ok["read1"]) == (2, 1, 1, 1, 1)
    assert G.usable_reads(reads).count() == 3  # the supplementary read stays


def test_cigar_expansion(spark, tmp_path):
    _, reads = sam(spark, tmp_path, [row("a", 0, 3, "2S3M1I2M2D2M1H", "NNGTAXCGAC")])
    got = P.expand_alignment(G.reheader(reads)).orderBy("pos", F.col("indel").isNotNull()).collect()
    assert [(r.pos, r.base, r.indel) for r in got] == [
        (3, "G", None), (4, "T", None), (5, "A", None), (5, None, "+X"), (6, "C", None), (7, "G", None),
        (7, None, "-2"), (10, "A", None), (11, "C", None)]


def test_runs_of_no_length_and_many_runs(spark, tmp_path):
    _, reads = sam(spark, tmp_path, [row("a", 0, 3, "0M2M", "AC"), row("b", 0, 1, "1M1I1M1D1M0D1S", "ACGTN"), row("c", 0, 9, "*", "*")])
    got = sorted((r.pos, r.base or "", r.indel or "") for r in P.expand_alignment(G.reheader(reads)).collect())
    assert got == sorted([(3, "A", ""), (4, "C", ""), (1, "A", ""), (1, "", "+C"), (2, "G", ""), (2, "", "-1"), (4, "T", "")])


def test_small_shares_are_exact(spark):
    import pytest

    df = spark.createDataFrame([(0, 2000), (1, 2000), (1, 2500), (1, 2501), (0, 0)], "part int, whole int")
    got = df.select(P.at_least(F.col("part"), F.col("whole"), 0.0004).alias("x"), P.at_most(F.col("part"), F.col("whole"), 0.0004).alias("y")).collect()
    assert [(r.x, r.y) for r in got] == [(False, True), (True, False), (True, True), (False, True), (False, False)]
    with pytest.raises(ValueError):
        P.at_least(F.col("part"), F.col("whole"), 1 / 3)


def called(spark, tmp_path, normal, tumor):
    rows = [row(f"{i}", 16 * (i % 2), 1, c, s) for i, (c, s) in enumerate(normal + tumor)]
    _, reads = sam(spark, tmp_path, rows)
    told = G.reheader(reads).withColumns({
        "sample": F.lit("S"), "role": F.when(F.col("qname").cast("int") < len(normal), "normal").otherwise("tumor")})
    (tmp_path / "ref").mkdir()
    (tmp_path / "ref" / "chr1.fa").write_text(f">chr1\n{REF[:7].lower()}\n{REF[7:14]}\n{REF[14:]}\n")
    blocks = B.reference_blocks(B.read_reference(spark, str(tmp_path / "ref")), 8, 4)
    bases = P.expand_alignment(G.usable_reads(told))
    pile = P.with_reference(P.pileup(bases), blocks, 8)
    snps = P.process_somatic(P.call_somatic(P.allele_counts(pile)))
    indels = P.process_somatic(P.call_somatic(P.indel_counts(bases, pile, blocks, 8)))
    return P.route_variant_kind(snps), P.route_variant_kind(indels)


def test_somatic_deletion_and_snp(spark, tmp_path):
    plain, changed = ("12M", REF[:12]), ("12M", "ACTTACGTACGT")
    deleted = ("7M2D3M", REF[:7] + REF[9:12])
    snps, indels = called(spark, tmp_path, [plain] * 12, [plain] * 6 + [changed] * 6 + [deleted] * 8)
    got = [(r.pos, r.ref, r.alt, r.n_alt, r.t_alt, r.status, r.hc, r.kind) for r in snps.collect()]
    assert got == [(3, "G", "T", 0, 6, "Somatic", True, "snp")]
    one = indels.collect()
    # the deleted bases 8 and 9 lie in the next reference block
    assert [(r.pos, r.ref, r.alt, r.n_alt, r.t_alt, r.t_ref, r.status, r.file) for r in one] == [
        (7, "GTA", "G", 0, 8, 12, "Somatic", "S_chr1.indel.vcf")]


def test_germline_insertion(spark, tmp_path):
    plain, more = ("10M", REF[:10]), ("4M2I6M", REF[:4] + "GG" + REF[4:10])
    snps, indels = called(spark, tmp_path, [plain] * 5 + [more] * 5, [plain] * 5 + [more] * 5)
    assert snps.count() == 0
    assert [(r.pos, r.ref, r.alt, r.status, r.hc) for r in indels.collect()] == [(4, "T", "TGG", "Germline", True)]


def test_changes_alone_and_reads_dealt_by_place(spark, tmp_path):
    rows = [row(f"{i}", 16 * (i % 2), 1 + i % 7, c, s) for i, (c, s) in enumerate(
        [("12M", REF[:12]), ("4M2I6M", "ACGTGGACGTAC"), ("7M2D3M", REF[:10]), ("0I3M0D", "ACG"), ("*", "*")] * 8)]
    told = G.reheader(sam(spark, tmp_path, rows)[1]).withColumns({"sample": F.lit("S"), "role": F.lit("tumor")})
    bases, changes = P.expand_alignment(told), P.expand_changes(told)
    assert sorted(map(str, changes.collect())) == sorted(map(str, bases.where("indel is not null").collect()))
    # reads without a change are left out before they are opened
    assert ", [ID])" in changes._jdf.queryExecution().optimizedPlan().toString()
    near = P.pileup(P.expand_alignment(P.near_reads(told), P.MATCHED))
    assert "RebalancePartitions" in near._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(near.collect()) == sorted(P.pileup(bases).collect())
    # depths come from a pileup without reference bases
    blocks = spark.createDataFrame([("chr1", 0, REF)], "chrom string, block bigint, bases string")
    plain = P.indel_counts(changes, near, blocks, 1000)
    assert sorted(plain.collect()) == sorted(P.indel_counts(bases, P.with_reference(near, blocks, 1000), blocks, 1000).collect())
    assert plain.count() > 0


def counts(spark, *rows):
    named = [("S", "chr1", i, "A", "C", *r, r[0] + r[1], r[2] + r[3]) for i, r in enumerate(rows)]
    return spark.createDataFrame(named, "sample string, chrom string, pos bigint, ref string, alt string, n_ref bigint, "
                                        "n_alt bigint, t_ref bigint, t_alt bigint, n_depth bigint, t_depth bigint")


def test_calling_rules(spark):
    df = counts(spark, (20, 0, 10, 10), (10, 10, 0, 20), (10, 10, 10, 10), (0, 20, 20, 0), (7, 0, 10, 10), (20, 0, 4, 1),
                (20, 0, 19, 1), (20, 0, 18, 2), (90, 10, 25, 75))
    got = {r.pos: (r.status, r.n_gt, r.t_gt) for r in P.call_somatic(df).collect()}
    assert got == {0: ("Somatic", "ref", "het"), 1: ("LOH", "het", "hom"), 2: ("Germline", "het", "het"),
                   3: ("Unknown", "hom", "ref"), 7: ("Germline", "ref", "het"), 8: ("LOH", "het", "hom")}
    kept = P.process_somatic(P.call_somatic(df))
    assert {r.pos for r in kept.where("hc").collect()} == {0, 1, 2, 8}
    assert kept.count() == len(got)


def test_vcf_text(spark, tmp_path):
    head = "##fileformat=VCFv4.1\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tNORMAL\tTUMOR\n"
    for sample in ("S1", "S_2"):
        for chrom, kind in (("chr1", "snp"), ("chr2", "indel"), ("chr10", "snp")):
            (tmp_path / f"{sample}_{chrom}.{kind}.vcf").write_text(
                head + f"{chrom}\t7\t.\tA\tG\t.\tPASS\tDP=40;SOMATIC;SS=2;SSC=9;GPV=1E0;SPV=1.5E-4\tGT:DP:RD:AD:FREQ\t0/0:20:20:0:0%\t0/1:20:10:10\n")
    vcf = B.read_vcf(spark, str(tmp_path))
    assert vcf.count() == 6 and {(r.sample, r.kind) for r in vcf.collect()} == {
        ("S1", "snp"), ("S1", "indel"), ("S_2", "snp"), ("S_2", "indel")}
    one = vcf.first()
    assert one.info["DP"] == "40" and one.info["SOMATIC"] is None and one.tumor_fields["FREQ"] is None
    calls = P.process_somatic(V.calls_from_vcf(vcf))
    assert calls.where("hc and status = 'Somatic'").count() == 6
    order = [(r.sample, r.kind, r.chrom) for r in V.concat_vcf(vcf).collect()]
    assert order == [(s, k, c) for s in ("S1", "S_2") for k, c in (("indel", "chr2"), ("snp", "chr1"), ("snp", "chr10"))]


def test_reference_offsets_over_splits(spark, tmp_path):
    bases = "".join("ACGT"[(i * i + i // 3) % 4] for i in range(1000))
    (tmp_path / "chr2.fa").write_text(">chr2\n" + "".join(bases[i:i + 50] + "\n" for i in range(0, 1000, 50)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        lines = B.read_reference(spark, str(tmp_path)).orderBy("start").collect()
        assert [(r.chrom, r.start, r.bases) for r in lines] == [("chr2", i, bases[i:i + 50]) for i in range(0, 1000, 50)]
        blocks = B.reference_blocks(B.read_reference(spark, str(tmp_path)), 64, 16).orderBy("block").collect()
        assert [r.bases for r in blocks] == [bases[i:i + 80] for i in range(0, 1000, 64)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_coverage_median(spark):
    df = spark.createDataFrame([("chr1", p) for p, n in ((1, 1), (2, 4), (3, 2), (4, 9)) for _ in range(n)], "chrom string, pos int")
    r = G.coverage_stats(df).first()
    assert (r.positions, r.mean_depth, r.median_depth, r.max_depth) == (4, 4.0, 3.0, 9)


def test_completeness_needs_more_than_the_limit(spark):
    rows = [("a", "snp", f"chr{i}", 100_001) for i in range(23)] + [("b", "snp", f"chr{i}", 100_001) for i in range(22)]
    rows += [("b", "snp", "chrX", 100_000)] + [("a", "indel", f"chr{i}", 200_000) for i in range(21)]
    files = spark.createDataFrame(rows, "sample string, kind string, chrom string, size_bytes bigint")
    assert {(r.kind, r.samples, r.complete_samples) for r in V.chrom_completeness(files).collect()} == {("snp", 2, 1), ("indel", 1, 1)}


def test_fasta_records_keep_their_names(spark, tmp_path):
    folder = tmp_path / "fa"
    folder.mkdir()
    (folder / "all.fa").write_text(">chr1 first\nacgt\nAC\n>chrX\nGG\n\nTTT\n>empty\n")
    (folder / "chr2.fa").write_text("AAAA\nC\n")
    got = sorted((r.chrom, r.start, r.bases) for r in B.read_reference(spark, str(folder)).collect())
    assert got == [("chr1", 0, "ACGT"), ("chr1", 4, "AC"), ("chr2", 0, "AAAA"), ("chr2", 4, "C"), ("chrX", 0, "GG"), ("chrX", 2, "TTT")]


def test_published_vcf_has_one_header_and_global_order(spark, tmp_path):
    from variloom.sinks import files as K

    rows = [("s", "snp", f"chr{1 + i % 3}", i, "A", "C", f"chr{1 + i % 3}\t{i}\t.\tA\tC") for i in range(500)] + [("s", "indel", "chr1", 5, "A", "AC", "chr1\t5\t.\tA\tAC")]
    lines = spark.createDataFrame(rows, "sample string, kind string, chrom string, pos bigint, ref string, alt string, line string").repartition(7)
    K.publish_vcf(lines, str(tmp_path / "vcf"))
    import gzip
    for kind, want in (("snp", sorted((r[2], r[3]) for r in rows if r[1] == "snp")), ("indel", [("chr1", 5)])):
        files = sorted((tmp_path / "vcf" / "sample=s" / f"kind={kind}").glob("part-*"))
        text = "".join(gzip.open(f, "rt").read() for f in files).splitlines()
        body = [x for x in text if not x.startswith("#")]
        assert text[: len(text) - len(body)] == K.VCF_HEADER.split("\n")
        assert [(x.split("\t")[0], int(x.split("\t")[1])) for x in body] == want
    assert B.read_vcf(spark, str(tmp_path / "vcf")).count() == 501
