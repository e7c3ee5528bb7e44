"""Functions of sequences as column expressions, and the overlap kernel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


#: Letters of pairs that are compared together.
PAIR_LETTERS = 1 << 18


def rev_comp(s: Column) -> Column:
    """Reverse complement; letters other than ACGTN stay, case is kept."""
    return F.reverse(F.translate(s, "ACGTNacgtn", "TGCANtgcan"))


_PAIRS = str.maketrans("ACGTNacgtn", "TGCANtgcan")


def complement(s: str) -> str:
    """rev_comp() of a string."""
    return s.translate(_PAIRS)[::-1]


def hamming(a: Column, b: Column) -> Column:
    """Differing positions, case counts; NULL for unequal lengths."""
    differing = F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda d: d)
    return F.when((a == "") & (b == ""), F.lit(0)).when(F.length(a) == F.length(b), F.size(differing))


def levenshtein_within(a: Column, b: Column, most: int) -> Column:
    """Edit distance, or NULL beyond `most`."""
    return F.nullif(F.levenshtein(a, b, most), F.lit(-1))


def quality_ok(quality: Column, length: int, qmin: int) -> Column:
    """Whether the first `length` letters are all of Phred quality `qmin` (offset 33) or more; false if there are fewer."""
    return F.coalesce(quality.rlike(rf"^[^\x00-\x{qmin + 32:02x}]{{{length}}}"), F.lit(False))


def index_matches(observed: Column, expected: Column, chunk_len: int, most: int) -> Column:
    """Whether two indexes have equal lengths and no chunk of `chunk_len` letters (the last may be shorter) has more than
    `most` mismatches; two empty ones match."""
    if chunk_len < 1:
        raise ValueError("chunk_len must be positive")
    chunks = F.sequence(F.lit(0), F.floor(F.greatest(F.length(observed) - 1, F.lit(0)) / chunk_len).cast("int"))

    def near(i: Column) -> Column:
        part = lambda s: F.substring(s, i * chunk_len + 1, F.lit(chunk_len))
        return hamming(part(observed), part(expected)) <= most

    same = (F.length(observed) == F.length(expected)) & F.forall(chunks, near)
    return F.when(observed == expected, F.lit(True)).otherwise(same)


def overlap_distances(first: list[str | None], second: list[str | None], k: int) -> list[int | None]:
    """For each pair of texts the least Hamming distance between a k-mer of one and a k-mer of the other, whatever the case; None
    if one is null or shorter than k. Pairs of equal lengths are handled together: mismatches along every diagonal are summed
    over windows of k."""
    out: list[int | None] = [None] * len(first)
    alike: dict[tuple[int, int], list[int]] = {}
    for i, (a, b) in enumerate(zip(first, second)):
        if a is not None and b is not None and len(a) >= k and len(b) >= k:
            alike.setdefault((len(a), len(b)), []).append(i)
    for (n, m), rows in alike.items():
        step = max(1, PAIR_LETTERS // (n + m))
        for own in (rows[i : i + step] for i in range(0, len(rows), step)):
            x, y = (_letters([side[i] for i in own], width) for side, width in ((first, n), (second, m)))
            best = np.full(len(own), k, np.int32)
            for d in range(k - m, n - k + 1):
                u, v = x[:, max(d, 0) :], y[:, max(-d, 0) :]
                width = min(u.shape[1], v.shape[1])
                sums = np.zeros((len(own), width + 1), np.int32)
                np.cumsum(u[:, :width] != v[:, :width], axis=1, out=sums[:, 1:])
                np.minimum(best, (sums[:, k:] - sums[:, :-k]).min(axis=1), out=best)
            for i, distance in zip(own, best.tolist()):
                out[i] = distance
    return out


def _letters(texts: list[str], width: int) -> np.ndarray:
    """Upper-cased texts of one length as rows of code points; case is changed where that keeps the length."""
    same = [u if len(u := t.upper()) == width else t for t in texts]
    return np.frombuffer("".join(same).encode("utf-32-le"), np.uint32).reshape(len(texts), width)


def share_kmer(a: Column, b: Column, k: int) -> Column:
    """Whether some k-mer of one stands in the other, whatever the case; false if one is shorter than k, null for nulls."""
    x, y = F.upper(a), F.upper(b)
    starts = F.sequence(F.lit(1), F.greatest(F.length(x) - (k - 1), F.lit(1)))
    found = F.contains(y, F.substring(x, 1, k)) | F.exists(starts, lambda i: F.contains(y, F.substring(x, i, F.lit(k))))
    return (F.length(x) >= k) & (F.length(y) >= k) & found


def best_overlap_distance(a: Column, b: Column, k: int) -> Column:
    """overlap_distances() of columns. Pairs that share a k-mer, nearly all of them, are settled in the JVM; the others go
    to an Arrow function."""
    @F.pandas_udf("int")
    def kernel(s: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series(overlap_distances(s.to_list(), t.to_list(), k), dtype="Int32")

    shared = share_kmer(a, b, k)
    # not evaluated again for each use of the result
    return F.when(shared, F.lit(0)).otherwise(kernel.asNondeterministic()(F.when(~shared, a), F.when(~shared, b)))


def register(spark: SparkSession) -> None:
    """Makes the row-wise functions available to SQL: rev_comp(s), seq_hamming(a, b), levenshtein_within(a, b, d)."""
    for sql in (
        "rev_comp(s STRING) RETURNS STRING RETURN reverse(translate(s, 'ACGTNacgtn', 'TGCANtgcan'))",
        "seq_hamming(a STRING, b STRING) RETURNS INT RETURN CASE WHEN a = '' AND b = '' THEN 0 WHEN length(a) = length(b) "
        "THEN size(filter(zip_with(split(a, ''), split(b, ''), (x, y) -> x <> y), d -> d)) END",
        "levenshtein_within(a STRING, b STRING, d INT) RETURNS INT RETURN "
        "CASE WHEN levenshtein(a, b) <= d THEN levenshtein(a, b) END",
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {sql}")
