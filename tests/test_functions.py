from fractions import Fraction
from math import comb

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from variloom.functions import barcode as B
from variloom.functions import chrom as C
from variloom.functions import labels as L
from variloom.functions import sequence as S
from variloom.functions.stats import fisher_one_tailed, hypergeometric_tail, ln_factorial


def values(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_barcode_parts(spark):
    df = spark.createDataFrame([("TCGA-02-2483-01A-01D",), ("TCGA-02-2483-10A",), ("TCGA-02",)], "barcode string")
    rows = B.parse_barcode(df).collect()
    assert [r.role for r in rows] == ["tumor", "normal", None]
    assert rows[0].case_id == "TCGA-02-2483" and rows[0].sample_key == "TCGA-02-2483-01A" and rows[0].type_code == "01"


def test_paths(spark):
    df = spark.createDataFrame([("/home/u/tcga/T-1/a.slurm", "gs://b/x/y"), ("/home", "gs://c/z")], "cmd string, url string")
    assert [tuple(r) for r in df.select(B.case_from_command(F.col("cmd")), B.bucket_of(F.col("url"))).collect()] == [
        ("T-1", "gs://b"), (None, "gs://c")]


def test_chromosome_names(spark):
    names = ["1", "22", "23", "X", "y", "MT", "m", "mt", "chr1", "GL000192", "01"]
    got = values(spark, [(n,) for n in names], "n string", C.normalize_chrom(F.col("n")))
    assert got == ["chr1", "chr22", "23", "chrX", "chrY", "chrM", "chrM", "chrM", "chr1", "GL000192", "01"]


def test_ref_file(spark):
    got = values(spark, [("a.sorted.bam", "chr1.fa")], "n string, r string", C.ref_file(F.col("n"), F.col("r")))
    assert got == ["a.sorted.REF_chr1.bam"]


def test_sizes(spark):
    sizes = [0, 1023, 1024, 1536, 1 << 20, 19 << 30, 3 << 40, None]
    rows = [(s,) for s in sizes]
    assert values(spark, rows, "s bigint", L.human_size(F.col("s"))) == ["0B", "1023B", "1K", "1K", "1M", "19G", "3T", None]
    assert values(spark, rows, "s bigint", L.size_unit(F.col("s"))) == ["B", "B", "KiB", "KiB", "MiB", "GiB", "TiB", None]


def test_times(spark):
    assert values(spark, [("1:02:03.50",), ("2:03.25",), ("x",)], "t string", L.elapsed_seconds(F.col("t"))) == [3723.5, 123.25, None]
    assert values(spark, [("37%",), ("?%",)], "t string", L.percent(F.col("t"))) == [0.37, None]
    assert values(spark, [(0,), (1500000000,), (None,)], "t bigint", L.format_epoch(F.col("t"))) == [
        "NA", "Fri Jul 14 02:40:00 2017", "NA"]


def test_times_of_late_years_have_no_sign(spark):
    seconds = [253402300799, 253402300800, 3110400000000, 19440000000000, 1, -86400]
    assert values(spark, [(s,) for s in seconds], "t bigint", L.format_epoch(F.col("t"))) == [
        "Fri Dec 31 23:59:59 9999", "Sat Jan 01 00:00:00 10000", "Fri Aug 27 00:00:00 100534", "Fri Jan 29 00:00:00 617999",
        "Thu Jan 01 00:00:01 1970", "Wed Dec 31 00:00:00 1969"]


def test_node_labels(spark):
    states = [("DRAINED",), ("MAINT",), ("MIXED",), ("IDLE",), ("BOOT_FAIL",)]
    assert values(spark, states, "s string", L.node_label(F.col("s"))) == ["alert", "warning", "success", "primary", "secondary"]


def test_codons(spark):
    assert values(spark, [("ACGTACG",), ("AC",), ("",)], "s string", S.codons(F.col("s"))) == [["ACG", "TAC"], [], []]


def test_amino_table_is_complete():
    assert len(S.amino_table()) == 64
    assert {c for c, a in S.amino_table().items() if a == "STOP"} == {"TAA", "TAG", "TGA"}
    assert S.amino_table("mycobacterium") == S.amino_table()


def test_best_synonyms():
    best = S.best_synonyms()
    assert best["ATG"] == ("ATG", 0) and best["TGG"] == ("TGG", 0)
    assert best["GCT"] == ("GCC", 1)  # first of three equal ones
    assert best["AGA"] == ("CGT", 2) and best["TTA"] == ("CTT", 2)
    assert best["TCT"] == ("AGC", 3)  # only two serine codons are offered
    assert S.best_synonyms(full_serine=True)["AGT"] == ("TCC", 3)


def test_melting(spark):
    rows = [("ACGT",), ("ACGTACGTACGTAC",)]
    assert values(spark, rows, "s string", S.melting_temp(F.col("s"))) == [12.0, 42.0]
    short, long = values(spark, rows, "s string", S.melting_temp(F.col("s"), "long"))
    assert short == 12.0 and long == pytest.approx(64.9 + 41 * (7 - 16.4) / 14)


def test_percent_changed(spark):
    rows = [("AAAA", "AATT"), ("AAA", "AA")]
    assert values(spark, rows, "a string, b string", S.percent_changed(F.col("a"), F.col("b"))) == [50.0, 0.0]


def test_percent_changed_of_a_width_needs_no_lambda(spark):
    rows = [("ACGT", "AGGA"), ("ACGTA", "ACGTC"), ("AC", "ACG"), ("", ""), ("ACGT", None)]
    plain, wide = (S.percent_changed(F.col("a"), F.col("b"), w) for w in (None, 4))
    assert values(spark, rows, "a string, b string", wide) == values(spark, rows, "a string, b string", plain) == [50.0, 20.0, 0.0, None, 0.0]



def exact_tail(x, d, k, n):
    hits = sum(comb(k, i) * comb(n - k, d - i) for i in range(x, min(k, d) + 1))
    return float(Fraction(hits, comb(n, d)))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 60)] * 4), min_size=20, max_size=60))
def test_fisher_is_exact(spark, tables):
    tables = [t for t in tables if sum(t[:2]) and sum(t[2:])]
    if not tables:
        return
    df = spark.createDataFrame(tables, "a bigint, b bigint, c bigint, d bigint")
    got = df.select("a", "b", "c", "d", fisher_one_tailed(*"abcd").alias("p")).collect()
    for a, b, c, d, p in got:
        rises = d * (a + b) >= b * (c + d)
        want = exact_tail(d if rises else c, c + d, (b + d) if rises else (a + c), a + b + c + d)
        assert p == pytest.approx(want, rel=1e-9, abs=1e-15)


def test_tail_of_a_deep_locus(spark):
    # 400,000 reads at one locus: only a square-root number of terms, still exact
    x, d, k, n = 60_600, 200_000, 120_000, 400_000
    df = spark.createDataFrame([(x, d, k, n)], "x bigint, d bigint, k bigint, n bigint")
    p = df.select(hypergeometric_tail(*"xdkn")).first()[0]
    term, total, i = Fraction(1), 1.0, x
    ratio = 1.0
    while i < min(k, d):
        ratio *= (k - i) * (d - i) / ((i + 1) * (n - k - d + i + 1))
        total += ratio
        i += 1
        if ratio < 1e-18:
            break
    from math import lgamma

    first = (lgamma(k + 1) - lgamma(x + 1) - lgamma(k - x + 1) + lgamma(n - k + 1) - lgamma(d - x + 1)
             - lgamma(n - k - d + x + 1) - lgamma(n + 1) + lgamma(d + 1) + lgamma(n - d + 1))
    from math import exp

    assert p == pytest.approx(exp(first) * total, rel=1e-6)


def test_ln_factorial(spark):
    from math import lgamma

    ns = [0, 1, 2, 20, 21, 100, 10**6]
    got = values(spark, [(n,) for n in ns], "n bigint", F.expr(ln_factorial("n")))
    assert got == pytest.approx([lgamma(n + 1) for n in ns], rel=1e-13, abs=1e-12)
