"""Filtering, clustering and overlap."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from readloom.design import Design
from readloom.operators import cluster, index_filter, overlap

D = Design()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def one_by_one(counts, design):
    """The plain form: barcodes by falling counts, each to the best of the representatives so far."""
    n, reps, out = design.cluster_max_dist + 1, {}, {}

    def parts(s):
        return [(i, s[len(s) * i // n : len(s) * (i + 1) // n]) for i in range(n)]

    for bc in sorted(counts, key=lambda b: (-counts[b], b)):
        options = []
        if counts[bc] < design.cluster_protect_count:
            for p in reps:
                common = [i for (i, x), (_, y) in zip(parts(bc), parts(p)) if x == y]
                d = edit_distance(bc, p)
                if common and d <= design.cluster_max_dist and counts[bc] <= design.cluster_merge_ratio * counts[p]:
                    options.append((d, common[0], -counts[p], p))
        out[bc] = min(options)[3] if options else bc
        if not options:
            reps[bc] = True
    return out


@pytest.mark.parametrize("ratio, protect, dist, seed", [(0.1, 25, 2, 1), (0.1, 25, 2, 2), (0.5, 25, 1, 3), (1.0, 1000, 2, 4), (0.5, 5, 3, 5)])
def test_clustering_equals_the_plain_form(spark, ratio, protect, dist, seed):
    rng = random.Random(seed)
    design = Design(cluster_merge_ratio=ratio, cluster_protect_count=protect, cluster_max_dist=dist)
    rows, want = [], {}
    for sample in ("A", "B"):
        counts = {}
        for _ in range(6):
            root = "".join(rng.choice("ACGT") for _ in range(12))
            counts[root] = rng.choice([2, 12, 30, 400])
            for _ in range(12):
                text = list(root)
                for _ in range(rng.randrange(1, 3)):
                    i, kind = rng.randrange(len(text)), rng.randrange(3)
                    text[i : i + 1] = [[], [rng.choice("ACGT")], [text[i], rng.choice("ACGT")]][kind]
                counts["".join(text)] = rng.choice([1, 1, 2, 3, 9, 15, 24, 60])
        rows += [(sample, b, c) for b, c in counts.items()]
        want |= {(sample, b): r for b, r in one_by_one(counts, design).items()}
    df = spark.createDataFrame(rows, "sample string, barcode string, cnt long")
    got = {(r["sample"], r["barcode"]): r["rep"] for r in cluster.assignments(df, design).collect()}
    assert got == want
    corrected = cluster.corrected_counts(df, design).collect()
    assert sum(r["total_count"] for r in corrected) == sum(r[2] for r in rows)
    assert abs(sum(r["freq_within_sample"] for r in corrected) - 2) < 1e-9


def test_a_variant_merges(spark):
    root = "AAAAAACCCCCCGATTTTTTCGGGGG"
    rows = [("A", root, 500), ("A", "T" + root[1:], 3), ("A", "GGGGGACGGGGGGAGGGGGTCCCCCC", 400)]
    got = cluster.corrected_counts(spark.createDataFrame(rows, "sample string, barcode string, cnt long"))
    assert {(r["corrected_barcode"], r["total_count"]) for r in got.collect()} == {(root, 503), (rows[2][1], 400)}


@pytest.mark.parametrize("ratio, protect, rounds", [(0.1, 25, 2), (0.1, 1001, 4), (1 / 3, 244, 6), (0.5, 2, 1), (0.99, 25, 24), (0.1, 1, 0), (0, 25, 0), (1, 25, None)])
def test_merge_rounds(ratio, protect, rounds):
    assert cluster.merge_rounds(Design(cluster_merge_ratio=ratio, cluster_protect_count=protect)) == rounds


def test_a_chain_of_powers_keeps_all_reads(spark):
    design = Design(cluster_merge_ratio=0.1, cluster_protect_count=1001)
    root = "AAAAAACCCCCCGATTTTTTCGGGGG"
    names = [root[: 13 + i] + "A" * (i > 0) + root[13 + i + (i > 0) :] for i in (0, 1, 2, 3, 4)]
    counts = dict(zip(names, (10_000, 1000, 100, 10, 1)))
    df = spark.createDataFrame([("A", b, c) for b, c in counts.items()], "sample string, barcode string, cnt long")
    assert {r["barcode"]: r["rep"] for r in cluster.assignments(df, design).collect()} == one_by_one(counts, design)
    corrected = cluster.corrected_counts(df, design).collect()
    assert sum(r["total_count"] for r in corrected) == 11_111


def test_counts_and_umi_groups(spark):
    rows = [("A", i, u, b) for i, (u, b) in enumerate([("AAAAAAAATT", "x"), ("aaaaaaaagg", "x"), ("AAAAAAAC", "x"), ("CCCCCCCC", "x"), (None, "x"), ("ACG", "y"), ("ACT", "y"), ("A", None)])]
    df = spark.createDataFrame(rows, "sample string, read_idx long, combined_umi string, barcode string")
    assert {r["barcode"]: r["cnt"] for r in cluster.barcode_counts(df).collect()} == {"x": 5, "y": 2}
    assert {r["barcode"]: (r["n_reads"], r["n_umi_groups"]) for r in cluster.umi_groups(df).collect()} == {"x": (5, 3), "y": (2, 1)}


def test_filter(spark):
    good = "AAAAAACCCCCCGATTTTTTCGGGGG"
    maps = spark.createDataFrame([(1, "A", "x"), (2, "A", " gccaat\t"), (3, "C", "AAAAAA")], "line_no long, sample string, expected_index string")
    expected = index_filter.expected_indexes(maps, "line_no")
    rows = [("A", 1, "GCCAAT", good), ("A", 2, "gccaaa", good), ("A", 3, "GCCTTT", good), ("A", 4, "GCCAATT", good), ("A", 5, "GCCAAT", "T" * 26),
            ("A", 6, None, good), ("A", 7, "GCCAAT", None), ("B", 1, "GCCAAT", good)]
    df = spark.createDataFrame(rows, "sample string, read_idx long, combined_index string, barcode string")
    out = index_filter.filter_reasons(df, expected)
    assert {r["read_idx"]: r["filter_reason"] for r in out.collect()} == {
        1: None, 2: None, 3: "index_mismatch", 4: "index_mismatch", 5: "motif_absent", 6: "index_mismatch", 7: "motif_absent",
    }
    assert [r["sample"] for r in index_filter.unmapped_samples(df, expected).collect()] == ["B"]
    s = index_filter.filter_summary(out).first()
    assert (s["kept"], s["index_mismatch"], s["motif_absent"], s["total"], s["kept_fraction"]) == (2, 3, 2, 7, 2 / 7)


def cells(spark, counts, sample="A"):
    return spark.createDataFrame([(sample, b, c) for b, c in counts.items()], "sample string, barcode string, cnt long")


@pytest.mark.parametrize("relative_to", ["mean", "median"])
def test_relative_abundance(spark, relative_to):
    counts = {f"b{i:03}": 2 for i in range(60)} | {f"c{i:03}": 1000 for i in range(41)}
    judged = overlap.relative_abundance(cells(spark, counts), 0.05, relative_to)
    total = sum(counts.values())
    middle = (statistics.fmean if relative_to == "mean" else statistics.median)([c / total for c in counts.values()])
    for r in judged.collect():
        assert r["dropped"] == (r["freq"] < 0.05 * middle)
    assert judged.filter("dropped").count() == (60 if relative_to == "mean" else 0)
    with pytest.raises(ValueError):
        overlap.relative_abundance(cells(spark, counts), 0.05, "mode")


def test_relative_abundance_switched_off(spark):
    for counts, fraction in (({"x": 5}, 0.5), ({"x": 5, "y": 1000}, 0.0)):
        assert overlap.relative_abundance(cells(spark, counts), fraction).filter("dropped or cutoff_freq is not null").count() == 0


def test_matrix_summary_and_histogram(spark):
    rows = [("A", "x", 3), ("A", "x", 1), ("A", "x", 2), ("B", "x", 4), ("A", "yN", 9), ("A", "z", 5), ("B", None, 5), ("B", "w", None)]
    usable = overlap.usable_counts(spark.createDataFrame(rows, "sample string, barcode string, cnt long"), 2)
    assert {tuple(r) for r in usable.collect()} == {("A", "x", 5), ("B", "x", 4), ("A", "z", 5)}
    m = {r["barcode"]: (r["A"], r["B"]) for r in overlap.matrix(usable).collect()}
    assert m == {"x": (5, 4), "z": (5, None)}
    f = {r["barcode"]: (r["A"], r["B"]) for r in overlap.matrix(overlap.with_frequency(usable), "freq").collect()}
    assert f == {"x": (0.5, 1.0), "z": (0.5, None)}
    s = {r["barcode"]: tuple(r)[1:] for r in overlap.overlap_summary(usable).collect()}
    assert s == {"x": (2, "A;B", 9), "z": (1, "A", 5)}
    bins = overlap.histogram(overlap.relative_abundance(cells(spark, {f"b{i}": i for i in range(1, 101)}), 0.05)).collect()
    assert sum(r["n_kept"] + r["n_dropped"] for r in bins) == 100 and {r["n_bins"] for r in bins} == {20}
    assert max(r["bin"] for r in bins) == 19 and min(r["bin"] for r in bins) == 0
    same = overlap.histogram(overlap.relative_abundance(cells(spark, {"a": 5, "b": 5}), 0)).collect()
    assert len(same) == 1 and same[0]["n_kept"] == 2


def test_surviving_straggler_end_to_end(spark):
    """A barcode abundant in one sample and a straggler in the other isn't shared once stragglers go."""
    a = {f"a{i}": 100 + i for i in range(40)} | {"shared": 500}
    b = {f"b{i}": 100 + i for i in range(40)} | {"shared": 1}
    both = cells(spark, a).union(cells(spark, b, "B"))
    for fraction, samples in ((0.0, 2), (0.05, 1)):
        kept = overlap.surviving(overlap.relative_abundance(overlap.usable_counts(both, 1), fraction, "mean"))
        assert overlap.overlap_summary(kept).filter(F.col("barcode") == "shared").first()["n_samples"] == samples
