"""Finding the FASTQ files of named samples."""

from __future__ import annotations

import io
import os
import re
from dataclasses import dataclass

from . import storage

#: Fixed formats: file name endings, whatever their case, and the marks of read 1 and read 2.
ENDINGS = (".fastq.gz", ".fq.gz", ".fastq", ".fq")
READ_1 = re.compile(r"_R1[_.]|_R1$|_1\.fastq|_1\.fq")
READ_2 = re.compile(r"_R2[_.]|_R2$|_2\.fastq|_2\.fq")


@dataclass(frozen=True)
class SampleFiles:
    """A sample's files; `r2` is None for single-end samples."""

    sample: str
    r1: str
    r2: str | None = None

    @property
    def mode(self) -> str:
        return "PE" if self.r2 else "SE"


def sample_names(path: str) -> list[str]:
    """Names of a list file: one a line, stripped; blank lines and lines that begin with # don't count."""
    with io.TextIOWrapper(storage.open_in(path), encoding="utf-8") as f:
        return [line.strip() for line in f if line.strip() and line[0] != "#"]


def names_file(sample: str, file_name: str) -> bool:
    """Whether a file name has the sample's name between characters that are neither letters nor digits."""
    return re.search(rf"(?<![A-Za-z0-9]){re.escape(sample)}(?![A-Za-z0-9])", file_name) is not None


def fastq_files(folder: str) -> list[str]:
    """Names of the FASTQ files right in a folder, sorted."""
    return [f for f in storage.names(folder) if f.lower().endswith(ENDINGS)]


def find_samples(names: list[str], folder: str, mode: str = "auto") -> dict[str, SampleFiles]:
    """Files of each sample. Longer names choose first and a file serves one sample. A read-1 and a read-2 file make a
    paired-end sample, a single file a single-end one; `mode` 'pe' or 'se' makes the other kind an error. ValueError for
    samples without files, with several candidates for one role, or named twice."""
    if mode not in ("auto", "pe", "se"):
        raise ValueError(f"mode must be 'auto', 'pe' or 'se', not {mode!r}")
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"samples named twice: {sorted(twice)}")
    free, found = fastq_files(folder), {}
    for name in sorted(names, key=len, reverse=True):
        own = [f for f in free if names_file(name, f)]
        first, second = [f for f in own if READ_1.search(f)], [f for f in own if READ_2.search(f)]
        if not own:
            raise ValueError(f"no FASTQ file of sample {name!r} in {folder} ({len(free)} files left)")
        if len(first) == 1 and len(second) == 1 and first != second:
            if mode == "se":
                raise ValueError(f"sample {name!r} has both reads, but mode is 'se'")
            # files of the sample that bear neither mark stay unused
            chosen = SampleFiles(name, os.path.join(folder, first[0]), os.path.join(folder, second[0]))
            used = {first[0], second[0]}
        elif len(own) == 1:
            if mode == "pe":
                raise ValueError(f"sample {name!r} has one file, {own[0]}, but mode is 'pe'")
            chosen, used = SampleFiles(name, os.path.join(folder, own[0])), {own[0]}
        else:
            raise ValueError(f"ambiguous files of sample {name!r}: {own}")
        free = [f for f in free if f not in used]
        found[name] = chosen
    return found
