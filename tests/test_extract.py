"""Read structure, cascade, counters and tallies."""

import random

import pytest
from pyspark.sql import functions as F

from readloom.design import Design
from readloom.functions.motifs import fixed_bases, motif_tolerant, strict_pattern
from readloom.functions.sequences import (
    best_overlap_distance, hamming, index_matches, levenshtein_within, quality_ok, register, rev_comp,
)
from readloom.functions.structure import exact_parts, fuzzy_parts, fuzzy_pattern, primer_possible
from readloom.operators import extract

D = Design()
DOWN = "CATGTTACCGGATTGCAAGTCTGACGATCAGTTCAGCATACGC"
BARCODE = "AAAAAACCCCCCGATTTTTTCGGGGG"
READS = "sample string, read_idx long, r1_seq string, r1_qual string, r2_seq string, r2_qual string"
COMPLEMENT = str.maketrans("ACGTNacgtn", "TGCANtgcan")


def rc(s):
    return s.translate(COMPLEMENT)[::-1]


def read1(primer=D.inner_p1_primer, barcode=BARCODE, idx="GCCAAT", umi="ACGTACGT", down=DOWN):
    return idx + umi + primer + barcode + down


def read2(primer=D.inner_p2_primer, down=None):
    return "TTAGGC" + "TTTTCCCC" + primer + (rc(DOWN) if down is None else down)


def one(spark, column, **values):
    kinds = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], kinds).select(column).first()[0]


def test_scalar_functions(spark):
    a, b = F.col("a"), F.col("b")
    assert one(spark, rev_comp(a), a="ACGTNxacgtn") == "nacgtxNACGT"
    assert one(spark, hamming(a, b), a="ACGT", b="AcGA") == 2
    assert one(spark, hamming(a, b), a="", b="") == 0
    assert one(spark, hamming(a, b), a="AC", b="ACG") is None
    assert one(spark, levenshtein_within(a, b, 2), a="ACGT", b="CGTA") == 2
    assert one(spark, levenshtein_within(a, b, 1), a="ACGT", b="CGTA") is None
    assert one(spark, quality_ok(a, 3, 25), a="::I!") is True
    assert one(spark, quality_ok(a, 3, 25), a=":9I") is False
    assert one(spark, quality_ok(a, 3, 25), a=":I") is False
    assert one(spark, quality_ok(a, 3, 25), a=None) is False
    register(spark)
    assert tuple(spark.sql("SELECT rev_comp('AAC'), seq_hamming('AC', 'AG'), levenshtein_within('AC', 'GT', 1)").first()) == ("GTT", 1, None)


@pytest.mark.parametrize(
    "seen, wanted, fits",
    [("ACGTACGTACGT", "ACGTACGTACGT", True), ("TCGTACGTACGA", "ACGTACGTACGT", True), ("TTGTACGTACGT", "ACGTACGTACGT", False),
     ("ACGTAC", "ACGTACG", False), ("", "", True), ("ACGTACA", "ACGTACT", True), ("AAAAAAAT", "AAAAAATA", False)],
)
def test_index_chunks(spark, seen, wanted, fits):
    assert one(spark, index_matches(F.col("a"), F.col("b"), 6, 1), a=seen, b=wanted) is fits


def test_motifs(spark):
    assert strict_pattern("NacN") == "[ACGTN]AC[ACGTN]" and fixed_bases("NacN") == [(1, "A"), (2, "C")]
    for wrong in ("Nn", "NX"):
        with pytest.raises(ValueError):
            strict_pattern(wrong)
    for barcode, fits in ((BARCODE, True), (BARCODE.lower(), True), (BARCODE.replace("AC", "AT", 1), True), ("T" + BARCODE, True),
                          (BARCODE[1:], False), ("T" * 26, False), ("", False)):
        assert one(spark, motif_tolerant(F.col("a"), D.barcode_motif, 1), a=barcode) is fits, barcode


def brute_overlap(a, b, k):
    a, b = a.upper(), b.upper()
    found = [sum(x != y for x, y in zip(a[i : i + k], b[j : j + k])) for i in range(len(a) - k + 1) for j in range(len(b) - k + 1)]
    return min(found, default=None)


def test_overlap_against_brute_force(spark):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("ACGTNacgt") for _ in range(n))
    rows = [(letters(rng.randrange(0, 40)), letters(rng.randrange(0, 40))) for _ in range(200)]
    rows += [(a, "TT" + a[:12]) for a, _ in rows[:50]] + [(None, "ACGT"), ("ACGT" * 9, None)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", best_overlap_distance(F.col("a"), F.col("b"), 8)).collect()
    for a, b, d in got:
        assert d == (None if a is None or b is None else brute_overlap(a, b, 8)), (a, b)


def damaged(rng, text, edits):
    for _ in range(edits):
        i, kind = rng.randrange(len(text)), rng.randrange(3)
        text = text[:i] + rng.choice(["", rng.choice("ACGT"), text[i] + rng.choice("ACGT")][kind : kind + 1]) + text[i + 1 :]
    return text


def test_native_path_equals_the_fuzzy_structure(spark):
    import regex

    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    reads = []
    for i in range(600):
        barcode = letters(5) + "AC" + letters(5) + "GA" + letters(5) + "TC" + letters(5)
        text = read1(damaged(rng, D.inner_p1_primer, i % 5), barcode, letters(6), letters(8), letters(rng.randrange(15, 60)))
        reads.append(rng.choice([text, text.lower(), text + "xyzACGT", text[: rng.randrange(1, len(text))]]))
    whole = regex.compile(fuzzy_pattern(D, 1), regex.IGNORECASE)
    df = spark.createDataFrame([(r,) for r in reads], "s string")
    got = df.select(
        "s", exact_parts(F.col("s"), D, 1).alias("x"), fuzzy_parts(F.col("s"), D, 1).alias("y"), primer_possible(F.col("s"), D, 1).alias("z")
    ).collect()
    seen = 0
    assert not all(r["z"] for r in got)
    for s, x, y, z in got:
        assert z or y["idx"] is None
        m = whole.match(s)
        assert (y["idx"] is None) == (m is None)
        if m:
            assert tuple(y) == (m["idx"], m["umi"], m["barcode"], m["down"])
        if x is not None:
            seen += 1
            assert tuple(x) == tuple(y)
    assert seen > 50


def test_cascade_and_counters(spark):
    q1, q2 = "I" * 61, "I" * 37
    rows = [
        ("A", 1, read1(), q1, read2(), q2, "passed"),
        ("A", 2, read1(), "#" + q1[1:], read2(), q2, "quality_fail"),
        ("A", 3, read1("T" * 21), q1, read2(), "#" * 37, "quality_fail"),
        ("A", 4, read1("T" * 21), q1, read2(down="A" * 40), q2, "regex_fail"),
        ("A", 5, read1(), q1, read2("A" * 23), q2, "regex_fail"),
        ("A", 6, read1(), q1, read2(down="ATATATATATATATATATATATATAT"), q2, "overlap_fail"),
        ("A", 7, read1(D.inner_p1_primer[:4] + D.inner_p1_primer[5:]), q1, read2(), q2, "passed"),
        ("A", 8, None, None, None, None, "quality_fail"),
        ("A", 9, read1(), q1[:60], read2(), q2, "quality_fail"),
        ("S", 1, read1().lower(), q1, None, None, "passed"),
        ("S", 2, read1(barcode="T" * 26), q1, None, None, "regex_fail"),
        ("S", 3, "", "", None, None, "quality_fail"),
    ]
    df = extract.classify(spark.createDataFrame([r[:6] for r in rows], READS))
    got = {(r["sample"], r["read_idx"]): r["status"] for r in df.collect()}
    assert got == {(r[0], r[1]): r[6] for r in rows}
    parsed = {(r["sample"], r["read_idx"]): r for r in extract.parsed_rows(df).collect()}
    assert set(parsed) == {("A", 1), ("A", 7), ("S", 1)}
    first, single = parsed["A", 1], parsed["S", 1]
    assert (first["combined_umi"], first["combined_index"], first["barcode"], first["best_overlap_dist"]) == ("ACGTACGTTTTTCCCC", "GCCAATTTAGGC", BARCODE, 0)
    assert (single["mode"], single["barcode"], single["index2"], single["best_overlap_dist"]) == ("SE", BARCODE.lower(), None, None)
    counters = {r["sample"]: r.asDict() for r in extract.read_counters(df).collect()}
    assert counters["A"]["total_reads"] == 9 and counters["A"]["passed"] == 2 and counters["A"]["quality_fail"] == 4
    assert counters["S"]["pass_fraction"] == 1 / 3
    tally = extract.unmatched_tally(extract.unmatched_of(df), 1).collect()
    assert {(r["sample"], r["sequence_prefix"], r["n_reads"]) for r in tally} == {("A", read1("T" * 21)[:60], 1), ("S", read1(barcode="T" * 26)[:60], 1)}


def test_tally_ties_go_to_the_first_seen(spark):
    rows = [("A", i, p) for i, p in enumerate(["x", "y", "y", "x", "z"])]
    got = extract.unmatched_tally(spark.createDataFrame(rows, "sample string, read_idx long, sequence_prefix string"), 2)
    assert [(r["sequence_prefix"], r["place"]) for r in got.orderBy("place").collect()] == [("x", 1), ("y", 2)]


def test_design():
    assert Design.from_dict({"qmin": 30}).qmin == 30 and Design().r1_quality_len == 61 and Design().r2_quality_len == 37
    with pytest.raises(ValueError):
        Design.from_dict({"quality": 30})


def test_design_from_yaml(tmp_path):
    from readloom.design import _flat_yaml

    text = '# a comment\n\nqmin: 30  # Phred\nbarcode_motif: "NNacNN"\ncluster_merge_ratio: 0.2\n'
    (tmp_path / "d.yaml").write_text(text)
    d = Design.from_yaml(str(tmp_path / "d.yaml"))
    assert (d.qmin, d.barcode_motif, d.cluster_merge_ratio) == (30, "NNacNN", 0.2)
    assert _flat_yaml(text) == {"qmin": 30, "barcode_motif": "NNacNN", "cluster_merge_ratio": 0.2}
    assert Design.from_yaml(None) == Design()
