"""Near-duplicates, frequent items, term frequencies, overlaps and distinct counts against brute force."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from readloom.llm.distinct_counts import ERROR, RANKS, ROWS, estimate, matrices, merged_counts
from readloom.llm.frequent_items import frequent_items, reduce_counters
from readloom.llm.near_duplicates import shift_tuples, similar_pairs
from readloom.llm import overlaps as overlap_module
from readloom.llm.overlaps import estimated_overlaps, exact_overlaps, lowest, overlaps, pairs_sharing, sets_of, sketches
from readloom.llm.queries import QUERIES
from readloom.llm.term_frequencies import mark, term_frequencies


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        i, kind = rng.randrange(len(text) + 1), rng.randrange(3)
        if kind == 0:
            text.insert(i, rng.choice("ACGTN"))
        elif text and kind == 1:
            del text[min(i, len(text) - 1)]
        elif text:
            text[min(i, len(text) - 1)] = rng.choice("ACGTN")
    return "".join(text)


def pairs_of(df, **options):
    got = similar_pairs(df, F.col("g"), F.col("v"), **options).collect()
    assert len(got) == len({tuple(r) for r in got})
    return {tuple(r) for r in got}


def true_pairs(rows, most):
    kept = {r[:2] for r in rows if None not in r[:2]}
    by = {}
    for g, v in kept:
        by.setdefault(g, []).append(v)
    return {(g, *sorted(p)) for g, own in by.items() for p in combinations(own, 2) if edit_distance(*p) <= most}


@pytest.mark.parametrize("most, parts", [(1, None), (2, None), (2, 4), (2, 5), (3, 5)])
def test_similar_pairs_are_complete(spark, most, parts):
    rng = random.Random(most * 10 + (parts or 0))
    rows = []
    for g in ("a", "b", None):
        for n in (26, 26, 26, 5, 2, 1):
            root = "".join(rng.choice("ACGT") for _ in range(n))
            rows += [(g, edited(rng, root, rng.randrange(0, 4)), "x", 1, "y") for _ in range(14)]
    rows += rows[:30] + [("a", None, None, None, None), ("a", "", None, None, None), ("b", "", None, None, None)]
    rows += [("a", "A" * n, None, None, None) for n in range(8)] + [("b", "AC" * 30, "", 0, ""), ("b", "CA" * 30, "", 0, "")]
    df = spark.createDataFrame(rows, "g string, v string, sig string, n int, grp string")  # clashing names
    assert pairs_of(df, max_edits=most, parts=parts) == true_pairs(rows, most)


def test_similar_pairs_of_long_values_and_none(spark):
    kinds = "g string, v string"
    assert pairs_of(spark.createDataFrame([], kinds)) == set()
    rng = random.Random(1)
    long = "".join(rng.choice("ACGT") for _ in range(20_000))
    near = long[:5000] + "T" + long[5000:12_000] + long[12_001:]
    got = pairs_of(spark.createDataFrame([("a", long), ("a", near), ("a", long[:-3])], kinds))
    assert got == {("a", *sorted([long, near]))}


def test_shifts_of_equal_lengths_go_one_way():
    assert set(shift_tuples(1, 0, 2)) == {(0,), (1,)} and set(shift_tuples(1, 1, 2)) == {(0,), (1,)}
    assert set(shift_tuples(2, 0, 2)) == {(0, 0), (0, 1), (1, 0), (1, 1)} and (-1,) in shift_tuples(1, -1, 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=80), max_size=6), st.integers(1, 8))
def test_merged_summaries_keep_their_guarantee(parts, counters):
    values, counts, lost, seen = np.zeros(0, object), np.zeros(0, np.int64), 0, Counter()
    for part in parts:
        seen.update(part)
        merged = Counter(dict(zip(values.tolist(), counts.tolist())))
        merged.update(part)
        values, counts, cut = reduce_counters(np.array(list(merged), object), np.array(list(merged.values()), np.int64), counters)
        lost += cut
    total = sum(seen.values())
    low = dict(zip(values.tolist(), counts.tolist()))
    assert len(low) <= counters and lost <= total / (counters + 1)
    for v, n in seen.items():
        assert low.get(v, 0) <= n <= low.get(v, 0) + lost


@pytest.mark.parametrize("fan_in", [2, 64])
@pytest.mark.parametrize("counters", [3, 20, 1000])
def test_frequent_items(spark, counters, fan_in):
    rng = random.Random(2)
    rows = [("x", f"v{int(rng.paretovariate(0.7))}", "c", 1) for _ in range(4000)] + [("y", "", "c", 1)] * 3 + [("z", None, "c", 1), (None, "q", "c", 1)]
    df = spark.createDataFrame(rows, "field_name string, item_value string, part string, low int").repartition(7)
    got = frequent_items(df, counters, fan_in).collect()
    true = Counter(r[1] for r in rows if r[0] == "x")
    mine = {r["item_value"]: r for r in got if r["field_name"] == "x"}
    assert len(mine) <= counters and {r["field_name"] for r in got} <= {"x", "y"}
    for v, n in true.items():
        if v in mine:
            assert mine[v]["low"] <= n <= mine[v]["low"] + mine[v]["lost"] and mine[v]["weight"] == 4000
        else:
            assert n * (counters + 1) <= 4000
    assert [(r["item_value"], r["low"]) for r in got if r["field_name"] == "y"] == [("", 3)]
    assert frequent_items(df.limit(0)).collect() == []


def test_term_frequencies(spark):
    rows = [("a", "u", "r1", 1), ("a", None, "r1", 1), ("a", "u", "r2", 1), (None, "u", None, 1), ("", "w" * 100_000, None, 1)]
    df = spark.createDataFrame(rows, "x string, y string, record string, item_value int")
    terms = term_frequencies(df, {"x": F.col("x"), "y": F.col("y")}, F.col("record"))
    got = {tuple(r) for r in terms.collect()}
    assert got == {("x", "a", 3, 2), ("x", "", 1, 1), ("y", "u", 3, 3), ("y", "w" * 100_000, 1, 1)}
    marks = mark(terms, {"rare": F.col("n_reads") == 1, "common:often": F.col("n_reads") >= 3}).collect()
    assert {(r["item_value"][:1], tuple(r["marks"])) for r in marks} == {("a", ("common",)), ("", ("rare",)), ("u", ("common",)), ("w", ("rare",))}
    assert term_frequencies(df.limit(0), {"x": F.col("x")}, F.col("record")).collect() == []


def test_overlaps_within_their_error(spark):
    rng = np.random.default_rng(4)
    sets = {"a": range(0, 30_000), "b": range(20_000, 60_000), "c": range(0, 300), "d": rng.integers(0, 10**9, 5000).tolist(), "e": range(0, 30_000)}
    rows = [(s, f"i{v}", 1) for s, own in sets.items() for v in own]
    df = spark.createDataFrame(rows + rows[:500] + [("a", None, 1), (None, "i1", 1)], "set_id string, item string, h int")
    for k in (256, 1024):
        got = {(r["set_a"], r["set_b"]): r for r in estimated_overlaps(df, k).collect()}
        assert len(got) == 10
        for (a, b), r in got.items():
            true = len({*sets[a]} & {*sets[b]})
            assert abs(r["shared"] - true) <= 5 * r["shared_error"] + 0.2 * true + 1e-6, (a, b, r, true)
            assert abs(r["size_a"] - len({*sets[a]})) <= 5 * len({*sets[a]}) / np.sqrt(k)
    exact = exact_overlaps(df, spark.createDataFrame([("a", "b"), ("a", "d")], "set_a string, set_b string")).collect()
    assert {tuple(r) for r in exact if r["set_b"] == "b"} == {("a", "b", 30_000, 40_000, 10_000)}
    assert max(len(r["hashes"]) for r in sketches(df, 256).collect()) == 256


def test_overlaps_of_small_sets_are_exact(spark):
    df = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "2"), ("y", "2"), ("z", "3")], "set_id string, item string")
    got = {(r["set_a"], r["set_b"]): (r["size_a"], r["size_b"], r["union_size"], r["shared"], r["shared_error"]) for r in estimated_overlaps(df).collect()}
    assert got == {("x", "y"): (2, 1, 2, 1, 0), ("x", "z"): (2, 1, 3, 0, 0), ("y", "z"): (1, 1, 2, 0, 0)}
    assert estimated_overlaps(df.limit(0)).collect() == []
    assert overlaps([np.array([1, 2]), np.array([], np.int64)], 4)[1][0, 1] == 0
    cells = spark.createDataFrame([("s", "b", 0), ("s", "c", None), ("s", "d", 2)], "s string, b string, n long")
    assert [tuple(r) for r in sets_of(cells, F.col("s"), F.col("b"), F.col("n") > 0).collect()] == [("s", "d")]


def test_merged_sketches_equal_their_definition():
    """Full and partial sketches, many of them alike: below the first end of a full one the union's hashes are all known."""
    rng = np.random.default_rng(2)
    pool = rng.integers(-(2**63), 2**63 - 1, 3000)
    for k in (8, 64):
        sets = [np.unique(rng.choice(pool, n, replace=False)) for n in (0, 1, 5, 7, 8, 9, 100, 500, 2000, 2900)] + [pool[:900], pool[:900]]
        cut = [np.sort(s)[:k] for s in sets]
        union, shared, error, n_hashes = overlaps(cut, k)
        for i, j in combinations(range(len(sets)), 2):
            both = np.union1d(sets[i], sets[j])
            ends = [c[-1] for c in (cut[i], cut[j]) if len(c) == k]
            low = both[both <= min(ends)] if ends else both
            common = np.isin(low, sets[i]) & np.isin(low, sets[j])
            assert n_hashes[i, j] == len(low)
            assert abs(shared[i, j] - union[i, j] * common.sum() / max(1, len(low))) < 1e-6
            assert abs(union[i, j] - len(both)) <= (6 * len(both) / np.sqrt(k) if ends else 0) and (error[i, j] > 0) == bool(ends)


def test_blocks_change_nothing(spark):
    rows = [(f"s{s}", f"i{v}") for s in range(9) for v in range(s * 150, s * 150 + 700)]
    df = spark.createDataFrame(rows, "set_id string, item string")
    whole = {tuple(r) for r in estimated_overlaps(df, 64).collect()}
    assert len(whole) == 36 and {tuple(r) for r in estimated_overlaps(df, 64, block=2).collect()} == whole


def test_only_pairs_near_the_bound_are_counted(spark, monkeypatch):
    """Sets of 50 times the sketch's size: pairs far above the bound are sure, far below they are out, and neither is joined."""
    shares = {"b": 0.9, "c": 0.6, "d": 0.302, "e": 0.298, "f": 0.1, "g": 0.0}
    n = 51_200
    rows = spark.range(n).select(F.lit("a").alias("set_id"), F.concat(F.lit("x"), "id").alias("item"))
    for name, share in shares.items():
        own = F.when(F.col("id") < int(n * share), F.concat(F.lit("x"), "id")).otherwise(F.concat(F.lit(name), "id"))
        rows = rows.unionByName(spark.range(n).select(F.lit(name).alias("set_id"), own.alias("item")))
    counted, plain = [], overlap_module.exact_overlaps
    monkeypatch.setattr(overlap_module, "exact_overlaps", lambda s, p: (counted.extend(map(tuple, p.collect())), plain(s, p))[1])
    wide = {tuple(r) for r in pairs_sharing(rows, 0.3, 1024).collect()}
    want = {(x, y) for x, y in combinations("abcdefg", 2) if min(shares.get(x, 1), shares.get(y, 1)) >= 0.3}
    assert wide == want and ("a", "d") in counted and ("a", "e") in counted
    assert not {("a", "b"), ("b", "c"), ("a", "f"), ("a", "g"), ("f", "g")} & set(counted)
    counted.clear()
    assert {tuple(r) for r in pairs_sharing(rows.filter("set_id in ('a', 'b', 'f')"), 0.3, 1024).collect()} == {("a", "b")} and not counted
    assert pairs_sharing(rows.limit(0), 0.3, 1024).collect() == []


def test_sketches_are_cut_before_the_shuffle(spark):
    """With k above Spark's limit of 1,000 for partial ranks; sets above and below k, repeated, in steps of merging."""
    sets = spark.range(0, 60_000, 1, 10).select(F.when(F.col("id") % 20 == 0, "few").otherwise("many").alias("set_id"), F.concat(F.lit("i"), F.col("id") % 30_000).alias("item"))
    hashes = sets.select("set_id", F.xxhash64("item").alias("h")).distinct().toPandas()
    want = {s: sorted(own["h"])[:4096] for s, own in hashes.groupby("set_id")}
    assert {s: len(own) for s, own in want.items()} == {"few": 1500, "many": 4096}
    for fan_in in (2, 64):
        assert {r["set_id"]: r["hashes"] for r in sketches(sets, 4096, fan_in).collect()} == want
    plan = sketches(sets)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.rindex("Exchange") :]  # what feeds the first shuffle
    assert "MapInArrow" in before and "Window" not in plan


def test_a_partition_holds_bounded_hashes():
    rng = np.random.default_rng(6)
    rows = [(f"s{i % 7}", int(h)) for i, h in enumerate(rng.integers(-(2**63), 2**63 - 1, 40_000))] * 2
    rng.shuffle(rows)
    batches = [
        pa.RecordBatch.from_pydict({"set_id": [s for s, _ in own], "h": [int(h) for _, h in own], "part": [3] * len(own)})
        for own in (rows[i : i + 1000] for i in range(0, len(rows), 1000))
    ]
    want = {f"s{i}": sorted({int(h) for s, h in rows if s == f"s{i}"})[:1500] for i in range(7)}
    for gathered, most in ((500, 1 << 22), (500, 4000), (1 << 19, 1 << 22)):
        got = defaultdict(set)
        for out in lowest(iter(batches), 1500, most, gathered):
            for r in out.to_pylist():
                assert r["part"] == 3 and r["hashes"] == sorted(set(r["hashes"])) and len(r["hashes"]) <= 1500
                got[r["set_id"]] |= set(r["hashes"])
        assert {s: sorted(h)[:1500] for s, h in got.items()} == want
    assert list(lowest(iter([]), 5)) == []


def _most_rows(plan):
    """The most rows that any join of a plan that ran gave out."""
    inner = "executedPlan" if plan.nodeName() == "AdaptiveSparkPlan" else "plan" if plan.nodeName().endswith("QueryStage") else None
    below = [getattr(plan, inner)()] if inner else [plan.children().apply(i) for i in range(plan.children().size())]
    own = plan.metrics().apply("numOutputRows").value() if plan.nodeName().endswith("Join") else 0
    return max([own, *map(_most_rows, below)])


def test_a_large_set_is_not_repeated_for_small_partners(spark):
    rows = [("a", f"i{v}") for v in range(5000)] + [(f"b{s:02}", f"i{v}") for s in range(40) for v in range(4990 + s % 5, 5005)]
    df = spark.createDataFrame(rows + rows[:9], "set_id string, item string")
    exact = exact_overlaps(df, spark.createDataFrame([("a", f"b{s:02}") for s in range(40)] + [("b00", "b04")], "set_a string, set_b string"))
    want = {("a", f"b{s:02}", 5000, 15 - s % 5, 10 - s % 5) for s in range(40)} | {("b00", "b04", 15, 11, 11)}
    assert {tuple(r) for r in exact.select("set_a", "set_b", "n_a", "n_b", "n_shared").collect()} == want
    exact.collect()
    assert 0 < _most_rows(exact._jdf.queryExecution().executedPlan()) <= len(rows) + 9  # 200,000 if it were


def test_pairs_of_very_unequal_samples_are_found(spark, tmp_path):
    """Each small sample has exactly 0.3 of its barcodes in one 190 times as large: few common hashes, or none, are expected."""
    rng = np.random.default_rng(3)
    rows = [("large", f"B{i}", 1) for i in range(19_000)]
    for s in range(250):
        rows += [(f"s{s:03}", f"B{i}", 1) for i in rng.choice(19_000, 30, replace=False)] + [(f"s{s:03}", f"O{s}X{i}", 1) for i in range(70)]
    spark.createDataFrame(rows, "sample_name string, barcode string, total_count long").write.parquet(str(tmp_path / "barcode_x_sample_counts.parquet"))
    got = {tuple(r) for r in QUERIES["p4_found"](spark, str(tmp_path)).collect()}
    assert got == {("large", f"s{s:03}") for s in range(250)}


def test_estimates_meet_the_stated_error():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 100, 3000, 50_000, 400_000):
        errors = []
        for _ in range(12):
            h = rng.integers(0, 2**63, n)
            row, rest = h % ROWS, (h // ROWS).astype(np.uint64)
            rank = np.minimum(np.log2((rest & (~rest + np.uint64(1))).astype(float) + (rest == 0)).astype(int), RANKS - 1)
            seen = np.zeros((ROWS, RANKS), bool)
            seen[row, rank] = True
            got, error = estimate(seen.sum(axis=0)[None], ROWS)
            errors.append(got[0] - n)
            if n >= 50_000:
                assert abs(error[0] / n * np.sqrt(ROWS) - ERROR) < 0.03
        assert np.sqrt(np.mean(np.square(errors))) <= 2 * ERROR / np.sqrt(ROWS) * n


def test_distinct_counts_merge(spark):
    rows = [(i % 3 or None, f"s{i % 2}", f"v{i % 5000}", None if i % 7 else f"u{i}", 0) for i in range(20_000)]
    df = spark.createDataFrame(rows, "day int, sample string, v string, u string, row int")
    keys, fields = {"day": F.col("day"), "sample": F.col("sample")}, {"v": F.col("v"), "u": F.col("u")}
    whole = matrices(df, keys, fields)
    halves = matrices(df.limit(9000), keys, fields).unionByName(matrices(df.subtract(df.limit(9000)), keys, fields)).unionByName(whole)
    a, b = ({tuple(r) for r in merged_counts(m, list(keys)).collect()} for m in (whole, halves))
    assert a == b
    got = {r[:4]: r[4:] for r in a}
    assert len(got) == 2 * (1 + 3 + 2 + 6)
    for (g, day, sample, field), (n, _, low, high) in got.items():
        own = [r for r in rows if (g & 2 or r[0] == day) and (g & 1 or r[1] == sample)]
        true = len({r[2 if field == "v" else 3] for r in own} - {None})
        assert low <= true <= high and abs(n - true) <= 0.07 * true, (g, day, sample, field, true, n)
    assert merged_counts(matrices(df.limit(0), keys, fields), list(keys)).collect() == []


PARSED = "sample_name string, read_mode string, read_idx long, combined_umi string, barcode string, lane_no int, run_day date, loaded_at timestamp"


def test_queries_on_a_dirty_fixture(spark, tmp_path):
    """Deliveries count once, blanks and case don't count, nulls are no values."""
    b = ["ACGTACGTAC", " acgtacgtac\t", "ACGTACGTAG\r", None, "", "TTTTTTTTTT"]
    rows = [("s1", "PE", i, u, b[i % 6], 1, None, None) for i, u in enumerate(["aa", "AA", None, " ", "CC", "GG"] * 2)]
    rows += rows[:6] + [("s2", "SE", 1, "AA", "GGGGGGGGGG", None, None, None)]
    spark.createDataFrame(rows, PARSED).write.parquet(str(tmp_path / "parsed.parquet"))
    spark.createDataFrame([("s1", 1, None, None, None)] * 2 + [("s1", 2, "nn ", None, None)], "sample_name string, read_idx long, sequence_prefix string, run_day date, loaded_at timestamp").write.parquet(str(tmp_path / "unmatched.parquet"))
    run = lambda q: {tuple(r) for r in QUERIES[q](spark, str(tmp_path)).collect()}
    assert run("p1_found") == {("s1", "ACGTACGTAC", "ACGTACGTAG")}
    assert run("p2_found") == {("barcode", x) for x in ("ACGTACGTAC", "ACGTACGTAG", "TTTTTTTTTT", "GGGGGGGGGG")} | {("sequence_prefix", "NN")}
    assert run("p3_found") == {("barcode", "GGGGGGGGGG", "rare"), *[("barcode", x, "common") for x in ("ACGTACGTAC", "ACGTACGTAG", "TTTTTTTTTT", "GGGGGGGGGG")],
                               *[("combined_umi", x, "common") for x in ("AA", "CC", "GG")]}
    assert ("combined_umi", "AA", 5, 2, "common") in run("p3_terms")


def test_queries_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], PARSED).write.parquet(str(tmp_path / "parsed.parquet"))
    spark.createDataFrame([], "sample_name string, read_idx long, sequence_prefix string").write.parquet(str(tmp_path / "unmatched.parquet"))
    spark.createDataFrame([], "barcode string, sample_name string, total_count long").write.parquet(str(tmp_path / "barcode_x_sample_counts.parquet"))
    for q in ("p1_found", "p2_found", "p3_found", "p4_found", "p4_found_by_small_sketches", "p4_overlaps", "p4_bounds", "p5_distinct"):
        assert QUERIES[q](spark, str(tmp_path)).collect() == [], q
