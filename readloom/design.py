"""The amplicon's design: lengths, primers, motif and tolerances, with YAML overrides."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields


@dataclass(frozen=True)
class Design:
    """All tunable values. Fixed values of the default design: the defaults below."""

    index1_len: int = 6
    umi1_len: int = 8
    index2_len: int = 6
    umi2_len: int = 8
    inner_p1_primer: str = "GCCACTCGAGCACCTAGGAGG"
    inner_p2_primer: str = "AATCAGTCCAGTTATGCTGTGAA"
    primer1_max_edits: int = 3
    primer2_max_edits: int = 3
    barcode_motif: str = "NNNNNacNNNNNgaNNNNNtcNNNNN"
    downstream_min_len: int = 20
    overlap_k: int = 20
    overlap_max_mismatch: int = 4
    qmin: int = 25
    index_chunk_len: int = 6
    index_max_mismatch: int = 1
    motif_max_mismatch: int = 1
    umi_group_len: int = 8
    umi_group_max_dist: int = 1
    cluster_max_dist: int = 2
    cluster_merge_ratio: float = 0.10
    cluster_protect_count: int = 25
    top_unmatched_n: int = 50

    @property
    def r1_quality_len(self) -> int:
        """Bases of read 1 whose quality counts: index, UMI, primer and barcode."""
        return self.index1_len + self.umi1_len + len(self.inner_p1_primer) + len(self.barcode_motif)

    @property
    def r2_quality_len(self) -> int:
        """Bases of read 2 whose quality counts: index, UMI and primer."""
        return self.index2_len + self.umi2_len + len(self.inner_p2_primer)

    def to_dict(self) -> dict:
        """All values by name."""
        return asdict(self)

    @classmethod
    def from_dict(cls, values: dict | None) -> Design:
        """Defaults with some values replaced; unknown names raise ValueError."""
        unknown = set(values or {}) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown design keys: {', '.join(sorted(unknown))}")
        return cls(**(values or {}))

    @classmethod
    def from_yaml(cls, path: str | None) -> Design:
        """Reads a flat YAML file; None gives the defaults."""
        if path is None:
            return cls()
        with open(path) as f:
            text = f.read()
        try:
            import yaml

            return cls.from_dict(yaml.safe_load(text))
        except ImportError:
            return cls.from_dict(_flat_yaml(text))


def _flat_yaml(text: str) -> dict:
    """`key: value` lines with comments, quotes and numbers: all that a design file has."""
    out: dict = {}
    for line in text.splitlines():
        key, colon, value = line.partition(":")
        if line.lstrip().startswith("#") or not colon:
            continue
        value = value.strip()
        if value[:1] in "'\"" and value:
            out[key.strip()] = value[1 : value.index(value[0], 1)]
            continue
        value = value.split(" #")[0].strip()
        for kind in (int, float, str):
            try:
                out[key.strip()] = kind(value)
                break
            except ValueError:
                continue
    return out
