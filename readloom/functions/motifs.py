"""Barcode motifs: `N` stands for any base, other letters are fixed bases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_pattern(motif: str) -> str:
    """The regular expression of barcodes that fit exactly; ValueError for letters other than N and bases."""
    wrong = [c for c in motif if c != "N" and c.upper() not in "ACGT"]
    if wrong:
        raise ValueError(f"the motif {motif!r} has {wrong[0]!r}, which is neither N nor a base")
    return "".join("[ACGTN]" if c == "N" else c.upper() for c in motif)


def fixed_bases(motif: str) -> list[tuple[int, str]]:
    """Positions (from 0) and bases that the motif fixes."""
    return [(i, c.upper()) for i, c in enumerate(motif) if c != "N"]


def motif_tolerant(barcode: Column, motif: str, most: int = 1) -> Column:
    """Whether some window as long as the motif differs from it at no more than `most` fixed positions; case doesn't
    count. Shorter barcodes give false, null gives null."""
    b, width = F.upper(barcode), len(motif)

    def fits(start: Column) -> Column:
        wrong = [(F.substring(b, start + 1 + i, F.lit(1)) != base).cast("int") for i, base in fixed_bases(motif)]
        return reduce(lambda x, y: x + y, wrong, F.lit(0)) <= most

    starts = F.sequence(F.lit(0), F.greatest(F.length(b) - width, F.lit(0)))
    return F.when(F.length(b) == width, fits(F.lit(0))).when(F.length(b) < width, F.lit(False)).when(
        barcode.isNotNull(), F.exists(starts, fits)
    )
