"""FASTQ files, discovery, exports and the command line."""

import csv
import gzip
import hashlib
import os
import random

import pytest

from readloom.cli import main
from readloom.design import Design
from readloom.functions.sequences import complement as rev_comp_text
from readloom.sources import discovery, sinks
from readloom.sources.fastq import part_files, range_records, read_fastq, read_fastq_split, read_samples, records, records_from

D = Design()
TAIL = "CATGTTACCGGATTGCAAGTCTGACGATCAGTTCAGCATACGCTTGGAC"
INDEXES = {1: "GCCAAT", 2: "TTAGGC"}


def dna(n, *named):
    """n bases that depend on what is named only."""
    digest = hashlib.shake_128(repr(named).encode()).digest(n)
    return "".join("TGAC"[byte % 4] for byte in digest)


def tag(name):
    """A barcode of the design: its motif with the open places filled."""
    free = iter(dna(len(D.barcode_motif), "tag", name))
    return "".join(next(free) if c == "N" else c.upper() for c in D.barcode_motif)


def fragment(sample, number, barcode, flaw=None):
    """Sequences and qualities of both reads of one fragment, with one flaw: a bad `base` in the UMI, a `primer` of 10 foreign
    bases, or another `insert` in the second read."""
    primer = D.inner_p1_primer if flaw != "primer" else D.inner_p1_primer[:11] + "A" * 10
    opposite = rev_comp_text(TAIL) if flaw != "insert" else "C" * 40
    one = INDEXES[1] + dna(8, sample, number, "umi1") + primer + barcode + TAIL
    two = INDEXES[2] + dna(8, sample, number, "umi2") + D.inner_p2_primer + opposite
    good = chr(33 + D.qmin)
    marks = "".join(chr(33 + D.qmin - 1) if flaw == "base" and i == 9 else good for i in range(len(one)))
    return (one, marks), (two, good * len(two))


def write(path, reads):
    with (gzip.open if path.endswith(".gz") else open)(path, "wt") as f:
        f.writelines(f"@m:{k}\n{sequence}\n+\n{marks}\n" for k, (sequence, marks) in enumerate(reads, 1))


#: Per sample the fragments of each barcode; the three flaws have barcodes of their own.
CONTENT = {
    "Sample_A": {"both": 30, "both too": 15, "a's": 10, "base": 5, "primer": 5, "insert": 5},
    "Sample_B": {"both": 8, "both too": 20, "b's": 12},
    "Sample_C": {"c's": 20},
    "Sample_D": {},
}
FILES = {"Sample_A": "Sample_A_S1_L001_R{}_001.fastq.gz", "Sample_B": "Sample_B_S2_L001_R{}_001.fastq.gz",
         "Sample_C": "Sample_C_S3_L001_R{}_001.fastq", "Sample_D": "Sample_D_R{}.fq"}


@pytest.fixture
def folder(tmp_path):
    """Two paired-end samples, a single-end one and a paired-end one without reads."""
    for sample, content in CONTENT.items():
        drawn = [(name, k) for name, n in content.items() for k in range(n)]
        flaws = {"base", "primer", "insert"}
        pairs = [fragment(sample, i, tag((name, k) if name in flaws else name), name if name in flaws else None) for i, (name, k) in enumerate(drawn)]
        for read in (1,) if sample == "Sample_C" else (1, 2):
            write(str(tmp_path / FILES[sample].format(read)), [p[read - 1] for p in pairs])
    (tmp_path / "samples.txt").write_text("# samples\nSample_A\n\n Sample_B \nSample_C\nSample_D\n")
    whole = INDEXES[1] + INDEXES[2]
    lines = ["sample,expected_index", f"Sample_A,{whole}", f"Sample_B,{whole.lower()}", f"Sample_C,{INDEXES[1]}", f"Sample_D,{whole}"]
    (tmp_path / "index_map.csv").write_text("\n".join(lines) + "\n")
    return tmp_path


def table(path, sep=","):
    with open(path, newline="") as f:
        return list(csv.DictReader(f, delimiter=sep))


def test_whole_run(spark, folder):
    out = folder / "out"
    argv = ["run", "--samples", str(folder / "samples.txt"), "--fastq-dir", str(folder), "--outdir", str(out),
            "--index-map", str(folder / "index_map.csv"), "--do-map", "--map-plot"]
    assert main(argv) == 0
    stats = (out / "1_extracted/Sample_A.stats.tsv").read_text()
    assert stats == "# Total_reads\t70\n# Passed\t55\n# Quality_fail\t5\n# Regex_fail\t5\n# Overlap_fail\t5\n# Pass_fraction\t0.7857\n"
    assert len(table(out / "1_extracted/Sample_A.parsed.tsv", "\t")) == 55
    single = table(out / "1_extracted/Sample_C.parsed.tsv", "\t")
    assert len(single) == 20 and list(single[0]) == ["Combined_UMI", "Combined_Index", "Barcode", "Index1", "UMI1"]
    assert len(table(out / "1_extracted/Sample_A.unmatched.tsv", "\t")) == 5
    assert table(out / "1_extracted/Sample_B.unmatched.tsv", "\t") == []
    assert [r["kept_fraction"] for r in table(out / "2_filtered/filter_summary.csv")] == ["1.0000"] * 3 + ["0.0000"]
    assert (out / "1_extracted/Sample_D.stats.tsv").read_text() == "".join(
        f"# {k}\t0\n" for k in ("Total_reads", "Passed", "Quality_fail", "Regex_fail", "Overlap_fail")
    ) + "# Pass_fraction\t0.0000\n"
    assert table(out / "2_filtered/filter_summary.csv")[3] == {
        "sample": "Sample_D", "kept": "0", "index_mismatch": "0", "motif_absent": "0", "total": "0", "kept_fraction": "0.0000"
    }
    for name in ("1_extracted/Sample_D.parsed.tsv", "2_filtered/kept/Sample_D.kept.tsv", "2_filtered/filtered/Sample_D.filtered.tsv"):
        assert (out / name).read_text().startswith("Combined_UMI\tCombined_Index\tBarcode\tIndex1\tIndex2")
        assert len((out / name).read_text().splitlines()) == 1
    assert table(out / "3_clustered/Sample_D.corrected_barcodes.csv") == []
    assert [int(r["total_count"]) for r in table(out / "3_clustered/Sample_A.corrected_barcodes.csv")] == [30, 15, 10]
    summary = table(out / "4_mapped/barcode_overlap_summary.csv")
    assert sum(r["n_samples"] == "2" for r in summary) == 2 and summary[0]["samples"] == "Sample_A;Sample_B"
    counts = table(out / "4_mapped/barcode_x_sample_counts.csv")
    assert list(counts[0]) == ["barcode", "Sample_A", "Sample_B", "Sample_C"] and counts[-1]["Sample_C"] in ("", "20")
    freq = table(out / "4_mapped/barcode_x_sample_freq.csv")
    assert {r["Sample_A"] for r in freq} == {"0.545455", "0.272727", "0.181818", ""}


def test_stages_one_by_one(spark, folder):
    common = ["--outdir"]
    at = lambda name: str(folder / name)
    assert main(["extract", "--samples", at("samples.txt"), "--fastq-dir", at("."), *common, at("x")]) == 0
    assert main(["filter", "--parsed-dir", at("x"), "--index-map", at("index_map.csv"), *common, at("f")]) == 0
    assert main(["cluster", "--input-dir", at("f/kept"), *common, at("c")]) == 0
    assert main(["cluster", "--input-dir", at("x"), *common, at("c2")]) == 0
    assert main(["map", "--counts-dir", at("c"), *common, at("m"), "--min-count", "9", "--min-rel-abundance", "0.05", "--relative-to", "mean"]) == 0
    assert main(["cluster", "--input-dir", at("m"), *common, at("none")]) == 1
    assert table(at("c/Sample_B.corrected_barcodes.csv")) == table(at("c2/Sample_B.corrected_barcodes.csv"))
    assert table(at("f/filtered/Sample_A.filtered.tsv"), "\t") == [] == table(at("f/kept/Sample_D.kept.tsv"), "\t")
    assert [r["total"] for r in table(at("f/filter_summary.csv"))] == ["55", "40", "20", "0"]
    kept = table(at("f/kept/Sample_A.kept.tsv"), "\t")
    assert len(kept) == 55 and kept[0]["filter_reason"] == "" and kept[0]["BestOverlapDist"] == "0"
    assert len(table(at("m/barcode_overlap_summary.csv"))) == 5


def test_map_cuts_off_per_file_and_pools_afterwards(spark, tmp_path):
    """10 reads of Z lie below 0.05 of the first file's median of 1000; in the second file nothing does."""
    (tmp_path / "in").mkdir()
    for name, counts in (("lane1", {"X": 1000, "Y": 1000, "Z": 10}), ("lane2", {"Z": 12, "W": 10})):
        lines = [f"s,{b},{n},{n / sum(counts.values())}" for b, n in counts.items()]
        (tmp_path / f"in/{name}.csv").write_text("\n".join(["sample,corrected_barcode,total_count,freq_within_sample", *lines]) + "\n")
    assert main(["map", "--counts-dir", str(tmp_path / "in"), "--outdir", str(tmp_path / "m"), "--min-rel-abundance", "0.05"]) == 0
    got = {r["barcode"]: r["s"] for r in table(tmp_path / "m/barcode_x_sample_counts.csv")}
    assert got == {"X": "1000", "Y": "1000", "Z": "12", "W": "10"}
    assert {r["total_count"] for r in table(tmp_path / "m/barcode_overlap_summary.csv")} == {"1000", "12", "10"}


def test_map_lists_equals_by_their_first_survival(spark, tmp_path):
    """GGG stands before CCC in file a, but too rarely to count there."""
    (tmp_path / "in").mkdir()
    for name, rows in (("a", ["TTT,10", "GGG,1", "CCC,10"]), ("b", ["GGG,10"]), ("c", ["NNN,99"])):
        lines = ["sample,corrected_barcode,total_count,freq_within_sample", *[f"{name},{r},0.5" for r in rows]]
        (tmp_path / f"in/{name}.csv").write_text("\n".join(lines) + "\n")
    assert main(["map", "--counts-dir", str(tmp_path / "in"), "--outdir", str(tmp_path / "m")]) == 0
    for name in ("x_sample_counts", "x_sample_freq", "overlap_summary"):
        assert [r["barcode"] for r in table(tmp_path / f"m/barcode_{name}.csv")] == ["TTT", "CCC", "GGG"]


def test_shares_are_rounded_like_their_binary_value(spark):
    rng = random.Random(11)
    values = [rng.randrange(1, b + 1) / b for b in (rng.choice([7, 64, 999, 10**6, 2 * 10**6, 2**20, 10**9]) for _ in range(3000))]
    values += [7 / 2e6, 5 / 2e6, 1 / 128, 3 / 128, 0.5, 1.5, 2.5, 0.0, 1.0, 12345.678905, 0.9999995, 5e-7, 1e-300]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = df.select("v", *[sinks.fixed("v", k).alias(f"p{k}") for k in (0, 1, 4, 6)]).collect()
    for r in got:
        for k in (0, 1, 4, 6):
            assert r[f"p{k}"] == (None if r["v"] is None else f"{r['v']:.{k}f}"), (r["v"], k)


def test_pairs_end_with_the_shorter_file(spark, tmp_path):
    write(str(tmp_path / "s_R1.fq"), [("ACGT", "IIII")] * 3)
    write(str(tmp_path / "s_R2.fq"), [("TTTT", "IIII")] * 2)
    rows = read_fastq(spark, discovery.find_samples(["s"], str(tmp_path))).orderBy("read_idx").collect()
    assert [(r["read_idx"], r["mode"], r["r1_seq"], r["r2_seq"]) for r in rows] == [(1, "PE", "ACGT", "TTTT"), (2, "PE", "ACGT", "TTTT")]


def test_records(tmp_path):
    path = tmp_path / "x.fastq"
    path.write_text("@a\r\nAC\r\n+\r\nII\r\n@b\n\n+\n\n")
    assert list(records(str(path))) == [("@a", "AC", "II"), ("@b", "", "")]
    path.write_text("@a\nAC\n")
    with pytest.raises(ValueError):
        list(records(str(path)))
    path.write_text("@a\nAC\n+\nII\n\n")
    with pytest.raises(ValueError):
        list(records(str(path)))


def test_discovery(tmp_path):
    for name in ("Col-1_R1.fq", "Col-10_R1.fq", "Col-10_R2.FQ.GZ", "both_1.fastq", "both_2.fastq", "plain.fastq", "note.txt"):
        (tmp_path / name).write_text("")
    find = lambda names, mode="auto": discovery.find_samples(names, str(tmp_path), mode)
    got = find(["Col-1", "Col-10", "both", "plain"])
    assert {k: (v.mode, os.path.basename(v.r1)) for k, v in got.items()} == {
        "Col-1": ("SE", "Col-1_R1.fq"), "Col-10": ("PE", "Col-10_R1.fq"), "both": ("PE", "both_1.fastq"), "plain": ("SE", "plain.fastq"),
    }
    for names, mode in ((["Col-1"], "pe"), (["plain"], "pe"), (["both"], "se"), (["Col"], "auto"), (["Col-2"], "auto"), (["plain", "plain"], "auto"), (["plain"], "xx")):
        with pytest.raises(ValueError):
            find(names, mode)


def odd_reads(rng):
    """Qualities that begin like headers, and like the line between."""
    return [("".join(rng.choices("ACGT", k=n)), "".join(rng.choice("@+I") for _ in range(n))) for n in [rng.randrange(1, 30) for _ in range(12)]]


@pytest.mark.parametrize("split_bytes", [1, 7, 17, 100, 10**6])
def test_every_record_is_in_one_range(tmp_path, split_bytes):
    path = str(tmp_path / "x.fq")
    write(path, odd_reads(random.Random(split_bytes)))
    size = os.path.getsize(path)
    ranges = [range_records(path, a, a + split_bytes) for a in range(0, size, split_bytes)]
    got = [r for at, n in ranges for batch in records_from(path, at, 0, n) for r in zip(*batch)]
    assert got == list(records(path)) and len(got) == 12 == sum(n for _, n in ranges)
    at, n = ranges[0]
    assert [r for batch in records_from(path, at, 0, n) for r in zip(*batch)][1:] == [r for batch in records_from(path, at, min(1, n), n) for r in zip(*batch)]


def test_splits_give_the_same_reads(spark, tmp_path):
    reads = odd_reads(random.Random(3))
    write(str(tmp_path / "p_R1.fq"), reads)
    write(str(tmp_path / "p_R2.fq"), [(s[::-1], q[::-1]) for s, q in reads[:10]])
    write(str(tmp_path / "s.fastq"), reads[::-1])
    found = discovery.find_samples(["p", "s"], str(tmp_path))
    a, b = (sorted(map(tuple, df.collect())) for df in (read_fastq(spark, found), read_fastq_split(spark, found, 250)))
    assert a == b and len(a) == 22
    with pytest.raises(Exception, match="compressed"):
        write(str(tmp_path / "z.fq.gz"), reads)
        read_fastq_split(spark, [discovery.SampleFiles("z", str(tmp_path / "z.fq.gz"))]).collect()


def test_large_plain_samples_are_split_and_others_are_not(spark, tmp_path):
    reads = odd_reads(random.Random(4))
    write(str(tmp_path / "p_R1.fq"), reads)
    write(str(tmp_path / "p_R2.fq"), [(s[::-1], q[::-1]) for s, q in reads[:11]])
    write(str(tmp_path / "z_R1.fq.gz"), reads)
    write(str(tmp_path / "z_R2.fq"), reads)
    write(str(tmp_path / "s.fastq"), reads[:2])
    found = discovery.find_samples(["p", "z", "s"], str(tmp_path))
    want = sorted(map(tuple, read_fastq(spark, found).collect()))
    for split_bytes in (200, 10**6, 1):
        assert sorted(map(tuple, read_samples(spark, found, split_bytes).collect())) == want
    only_plain = {"p": found["p"]}
    assert sorted(map(tuple, read_samples(spark, only_plain, 100).collect())) == [r for r in want if r[0] == "p"]


def test_folders_of_parts_are_one_file(spark, tmp_path):
    reads = odd_reads(random.Random(5))
    for n, cuts in ((1, (0, 3, 3, 12)), (2, (0, 7, 12, 12))):  # some parts are empty, pairs aren't parted alike
        os.mkdir(tmp_path / f"r{n}")
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            write(str(tmp_path / f"r{n}" / f"part-{99999 + k:05d}-x.txt"), reads[a:b])
        (tmp_path / f"r{n}" / "_SUCCESS").write_text("")
    assert [os.path.basename(p) for p in part_files(str(tmp_path / "r1"))] == ["part-99999-x.txt", "part-100000-x.txt", "part-100001-x.txt"]
    rows = read_fastq_split(spark, [discovery.SampleFiles("p", str(tmp_path / "r1"), str(tmp_path / "r2"))], 60).orderBy("read_idx").collect()
    assert [(r["r1_seq"], r["r1_qual"]) for r in rows] == reads == [(r["r2_seq"], r["r2_qual"]) for r in rows]
    assert [r["read_idx"] for r in rows] == list(range(1, 13))


def test_files_of_other_systems(tmp_path, monkeypatch):
    """What the tasks read and write goes through the file system that a path names."""
    from pyarrow import fs

    from readloom.sources import storage, tables

    monkeypatch.setitem(storage.SYSTEMS, "stub", fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem()))
    reads = odd_reads(random.Random(8))
    write(str(tmp_path / "x.fq.gz"), reads)
    write(str(tmp_path / "x_R1.fq"), reads)
    (tmp_path / "names.txt").write_text("x\n")
    assert [r[1:] for r in records("stub://x.fq.gz")] == reads == [r[1:] for r in records("stub://x_R1.fq")]
    at, n = range_records("stub://x_R1.fq", 0, 10**6)
    assert (at, n) == (0, 12) and len(list(records_from("stub://x_R1.fq", at, 2, n))[0][0]) == 10
    assert discovery.sample_names("stub://names.txt") == ["x"] and len(discovery.fastq_files("stub://")) == 2
    for k in (0, 1, 10):
        storage.write_whole(f"stub://parts/part-{k:05d}-x.csv", [f"{k}\n".encode()]) if k else storage.make_folder("stub://parts")
    sinks._join("stub://parts", "stub://out.csv", ["a b", "c"], ",")
    assert (tmp_path / "out.csv").read_text() == "a b,c\n1\n10\n" and part_files("stub://parts")[0] == "stub://parts/part-00001-x.csv"
    (tmp_path / "s.parsed.tsv").write_text("Combined_UMI\tBarcode\tIndex2\n")
    assert tables.table_modes(["stub://s.parsed.tsv"], ".parsed.tsv") == {"s": "PE"}
    storage.remove_folder("stub://parts")
    assert storage.names("stub://parts") == [] and storage.uri("a") == "file://" + os.path.abspath("a")
