"""The structure of reads: index, UMI, fuzzy primer, barcode motif, downstream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..design import Design
from .motifs import strict_pattern
from .sequences import complement, overlap_distances

PARTS = "struct<idx: string, umi: string, barcode: string, down: string>"
BOTH = (
    "struct<idx1: string, umi1: string, barcode: string, down1: string, idx2: string, umi2: string, down2: string, dist: int>"
)


def fuzzy_pattern(design: Design, read: int) -> str:
    """The whole structure for the `regex` package, which allows edits in the primer. Fixed format of the reads."""
    if read == 1:
        idx, umi, primer, edits = design.index1_len, design.umi1_len, design.inner_p1_primer, design.primer1_max_edits
        barcode = f"(?P<barcode>{strict_pattern(design.barcode_motif)})"
    else:
        idx, umi, primer, edits = design.index2_len, design.umi2_len, design.inner_p2_primer, design.primer2_max_edits
        barcode = ""
    down = f"(?P<down>[ACGTN]{{{design.downstream_min_len},}})"
    return rf"^(?P<idx>.{{{idx}}})(?P<umi>.{{{umi}}})(?:{primer}){{e<={edits}}}{barcode}{down}.*$"


def fuzzy_parts(seq: Column, design: Design, read: int) -> Column:
    """The parts of a read by the fuzzy structure, or NULL: an Arrow function over the reads that aren't null."""
    pattern, has_barcode = fuzzy_pattern(design, read), read == 1

    @F.pandas_udf(PARTS)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import regex

        whole = regex.compile(pattern, regex.IGNORECASE)
        for s in batches:
            rows = []
            for text in s:
                m = whole.match(text) if text is not None else None
                rows.append((m["idx"], m["umi"], m["barcode"] if has_barcode else "", m["down"]) if m else (None,) * 4)
            yield pd.DataFrame(rows, columns=["idx", "umi", "barcode", "down"], dtype=object)

    # the optimizer would evaluate a deterministic function once for every column and filter that uses a part
    return match.asNondeterministic()(seq)


def fuzzy_read(seq1: Column, seq2: Column, design: Design) -> Column:
    """The parts of both reads by the fuzzy structure and, where both have them, their overlap distance: one Arrow function
    over the reads that the native path leaves open. Read 2 may be null."""
    first, second = fuzzy_pattern(design, 1), fuzzy_pattern(design, 2)
    names = [f.split(":")[0] for f in BOTH.removeprefix("struct<").split(", ")]

    @F.pandas_udf(BOTH)
    def match(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        import regex

        one, two = regex.compile(first, regex.IGNORECASE), regex.compile(second, regex.IGNORECASE)
        nothing = (None,) * len(names)
        for s, t in batches:
            rows = [nothing] * len(s)
            open_ = s.notna().to_numpy().nonzero()[0].tolist()
            seen = [(one.match(s.iloc[i]), two.match(t.iloc[i]) if t.iloc[i] is not None else None) for i in open_]
            both = [(a["down"], complement(b["down"])) if a and b else (None, None) for a, b in seen]
            apart = overlap_distances([a for a, _ in both], [b for _, b in both], design.overlap_k)
            for i, (a, b), distance in zip(open_, seen, apart):
                own = (a["idx"], a["umi"], a["barcode"], a["down"]) if a else (None,) * 4
                other = (b["idx"], b["umi"], b["down"]) if b else (None,) * 3
                rows[i] = (*own, *other, distance)
            yield pd.DataFrame(rows, columns=names, dtype=object)

    # the optimizer would evaluate a deterministic function once for every column and filter that uses a part
    return match.asNondeterministic()(seq1, seq2)


def primer_possible(seq: Column, design: Design, read: int) -> Column:
    """False for reads that the fuzzy structure can't fit: of edits + 1 pieces of the primer one at least stands unharmed
    in the read, no further from its place than there are edits."""
    if read == 1:
        at, primer, edits = design.index1_len + design.umi1_len, design.inner_p1_primer, design.primer1_max_edits
    else:
        at, primer, edits = design.index2_len + design.umi2_len, design.inner_p2_primer, design.primer2_max_edits
    n, possible = len(primer), F.lit(False)
    for i in range(edits + 1):
        start, end = n * i // (edits + 1), n * (i + 1) // (edits + 1)
        first = max(0, at + start - edits)
        near = F.upper(F.substring(seq, first + 1, at + end + edits - first))
        possible = possible | F.contains(near, F.lit(primer[start:end].upper()))
    return possible


def exact_parts(seq: Column, design: Design, read: int) -> Column:
    """The parts of a read whose primer has no error, natively; NULL for other reads."""
    if read == 1:
        idx, umi, primer, motif = design.index1_len, design.umi1_len, design.inner_p1_primer, design.barcode_motif
    else:
        idx, umi, primer, motif = design.index2_len, design.umi2_len, design.inner_p2_primer, ""
    at = idx + umi + 1
    begin = at + len(primer) + len(motif)  # of the downstream part, whose longest run of bases counts
    down = F.regexp_extract(F.substring(seq, F.lit(begin), F.greatest(F.length(seq), F.lit(1))), "^(?i:[ACGTN]*)", 0)
    barcode = F.substring(seq, at + len(primer), len(motif))
    found = F.struct(
        F.substring(seq, 1, idx).alias("idx"), F.substring(seq, idx + 1, umi).alias("umi"),
        barcode.alias("barcode"), down.alias("down"),
    )
    fits = (F.upper(F.substring(seq, at, len(primer))) == primer.upper()) & (F.length(down) >= design.downstream_min_len)
    return F.when(fits & barcode.rlike(f"^(?i:{strict_pattern(motif)})") if motif else fits, found)
