"""FASTQ as a batch data source: spark.read.format("fastq").option("samples", samples_option(found)).load()"""

from __future__ import annotations

import gzip
import io
import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice, repeat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import storage
from .discovery import SampleFiles

SCHEMA = (
    "sample string, mode string, read_idx long, r1_header string, r1_seq string, r1_qual string, "
    "r2_header string, r2_seq string, r2_qual string"
)
BATCH = 10_000


def _lines(path: str, at: int = 0) -> io.TextIOBase:
    """A plain or (by its ending .gz) gzip-compressed text, a plain one from a byte on."""
    raw = storage.open_in(path)
    if at:
        raw.seek(at)
    return io.TextIOWrapper(gzip.open(raw) if path.endswith(".gz") else raw, encoding="utf-8", newline=None)


def _batches(text: io.TextIOBase, path: str, size: int, most: int | None = None) -> Iterator[tuple[list[str], ...]]:
    """record_batches() of an open text, of `most` records at most."""
    lines_left = islice(text, None if most is None else 4 * most)
    while lines := [line.rstrip("\n") for line in islice(lines_left, 4 * size)]:
        whole = len(lines) - len(lines) % 4
        if len(lines) % 4 == 3:
            lines.append("")
            whole += 4
        if whole:
            yield lines[0:whole:4], lines[1:whole:4], lines[3:whole:4]
        if whole < len(lines):
            raise ValueError(f"truncated FASTQ record in {path}")


def record_batches(path: str, size: int = BATCH) -> Iterator[tuple[list[str], list[str], list[str]]]:
    """Headers, sequences and qualities of up to `size` records of four lines at a time. Ends where no further line follows a
    record; ValueError where one breaks off before its third line (a blank line at the end is such a record)."""
    with _lines(path) as text:
        yield from _batches(text, path, size)


def records(path: str) -> Iterator[tuple[str, str, str]]:
    """The same, record by record."""
    for batch in record_batches(path):
        yield from zip(*batch)


def _rows(sample: str, mode: str, first: int, one: tuple, two: tuple, n: int) -> pa.RecordBatch:
    """The first n reads of a batch of each file, numbered from `first`."""
    text, names = pa.string(), [c.split()[0] for c in SCHEMA.split(", ")]
    head = [pa.array([sample] * n, text), pa.array([mode] * n, text), pa.array(range(first, first + n), pa.int64())]
    return pa.RecordBatch.from_arrays([*head, *[pa.array(column[:n], text) for column in (*one, *two)]], names)


class _Sample(InputPartition):
    def __init__(self, sample: str, r1: str, r2: str | None):
        self.sample, self.r1, self.r2 = sample, r1, r2


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.samples = [SampleFiles(*s) for s in json.loads(options["samples"])]

    def partitions(self) -> list[InputPartition]:
        """One task per sample: reads 1 and 2 are zipped by their order, and gzip can't be split."""
        return [_Sample(s.sample, s.r1, s.r2) for s in self.samples]

    def read(self, partition: _Sample) -> Iterator[pa.RecordBatch]:
        mode, at = "PE" if partition.r2 else "SE", 0
        second = record_batches(partition.r2) if partition.r2 else repeat(([None] * BATCH,) * 3)
        for one, two in zip(record_batches(partition.r1), second):
            n = min(len(one[0]), len(two[0]))
            yield _rows(partition.sample, mode, at + 1, one, two, n)
            at += n
            if n < BATCH:
                break  # the shorter file has ended


class FastqSource(DataSource):
    """Reads of samples, those of a pair side by side (up to the end of the shorter file), numbered from 1."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_fastq(spark: SparkSession, found: dict[str, SampleFiles] | list[SampleFiles]) -> DataFrame:
    """The reads of found samples. Where few large files make few tasks, repartition before the work on reads. A list may name
    a sample several times, once for each of its lanes; reads are numbered within a lane then."""
    spark.dataSource.register(FastqSource)
    samples = found.values() if isinstance(found, dict) else found
    return spark.read.format("fastq").option("samples", json.dumps([[s.sample, s.r1, s.r2] for s in samples])).load()


RANGE_SCHEMA = "sample string, read_no int, split long, path string, at long, n long"
#: Bytes of a plain file that one task reads.
SPLIT_BYTES = 128 * 1024 * 1024


def part_files(path: str) -> list[str]:
    """The file itself or, of a folder of part files as Spark writes them, these in order of their numbers."""
    return [f"{path}/{name}" for name in storage.part_names(path)] if storage.is_folder(path) else [path]


def range_records(path: str, start: int, end: int) -> tuple[int, int]:
    """Of a plain file where the first record begins that begins in the bytes [start, end), and how many do.

    A line is a header if it begins with @ and the next line but one with +: a quality line may begin with @ too, but two
    lines below it stands a sequence. From there on ends of lines are counted only; nothing is decoded."""
    with storage.open_in(path) as raw:
        end = min(end, raw.size())
        at = max(0, start - 1)
        raw.seek(at)
        if start:
            text = io.BufferedReader(raw, 1 << 16)
            at += len(text.readline())  # the rest of a line that began before
            held = [text.readline() for _ in range(3)]
            while at < end and held[0] and not (held[0][:1] == b"@" and held[2][:1] == b"+"):
                at += len(held.pop(0))
                held.append(text.readline())
        if at >= end:
            return end, 0
        raw.seek(at)
        lines, left = 1, end - 1 - at
        while left > 0 and (block := raw.read(min(left, 1 << 20))):
            lines += block.count(b"\n")
            left -= len(block)
        return at, -(-lines // 4)


def records_from(path: str, at: int, skip: int, n: int) -> Iterator[tuple[list[str], ...]]:
    """Batches of n records of a plain file from a record's first byte on, less the first `skip` of them."""
    with _lines(path, at) as text:
        for _ in islice(text, 4 * skip):
            pass
        yield from _batches(text, path, BATCH, n - skip)


class _Part(InputPartition):
    def __init__(self, values: list):
        self.values = values


class _RangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.samples = [SampleFiles(*s) for s in json.loads(options["samples"])]
        self.bytes = int(options.get("splitbytes") or SPLIT_BYTES)

    def partitions(self) -> list[InputPartition]:
        """Ranges of bytes of all files, numbered throughout those of a sample's read."""
        out = []
        for s in self.samples:
            for n, whole in enumerate((s.r1, s.r2), 1):
                k = 0
                for path in part_files(whole) if whole else ():
                    if path.endswith(".gz"):
                        raise ValueError(f"{path} is compressed and can't be split")
                    for a in range(0, storage.size(path), self.bytes):
                        out.append(_Part([s.sample, n, k, path, a, a + self.bytes]))
                        k += 1
        return out

    def read(self, partition: _Part) -> Iterator[tuple]:
        sample, read_no, split, path, start, end = partition.values
        yield (sample, read_no, split, path, *range_records(path, start, end))


class FastqRangesSource(DataSource):
    """Where the records of ranges of plain FASTQ files begin, and their numbers."""

    @classmethod
    def name(cls) -> str:
        return "fastq_ranges"

    def schema(self) -> str:
        return RANGE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _RangeReader(self.options)


class _PairReader(DataSourceReader):
    def __init__(self, options: dict):
        self.parts = json.loads(options["parts"])

    def partitions(self) -> list[InputPartition]:
        return [_Part(p) for p in self.parts]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        """Batches of both files don't end alike, so the longer one's rest waits for the next."""
        sample, mode, at, one, two = partition.values
        sides = [(b for s in own for b in records_from(*s)) for own in (one, two)]
        if mode == "SE":
            sides[1] = repeat(([None] * BATCH,) * 3)
        held: list[tuple[list, ...]] = [([], [], []), ([], [], [])]
        while True:
            for i in (0, 1):
                while not held[i][0] and (new := next(sides[i], None)) is not None:
                    held[i] = new
            n = min(len(h[0]) for h in held)
            if not n:
                return
            yield _rows(sample, mode, at, held[0], held[1], n)
            at += n
            held = [tuple(column[n:] for column in h) for h in held]


class FastqPairsSource(DataSource):
    """Reads of plain FASTQ files by ranges of records, those of a pair side by side."""

    @classmethod
    def name(cls) -> str:
        return "fastq_pairs"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _PairReader(self.options)


def _parts(samples: list[SampleFiles], ranges: list) -> list[list]:
    """Per range of a sample's first file: sample, mode, the first record's number, and what to read of either file as
    (path, first byte, records to skip, records up to which)."""
    held: dict[tuple[str, int], list] = {}
    for r in sorted(ranges, key=lambda r: r["split"]):
        held.setdefault((r["sample"], r["read_no"]), []).append(r)
    out = []
    for s in samples:
        second, ends = held.get((s.sample, 2), []), []
        for r in second:
            ends.append((ends[-1] if ends else 0) + r["n"])
        first = 0
        for r in held.get((s.sample, 1), []):
            last, two = first + r["n"], []
            for k in range(bisect_right(ends, first), len(second)):
                own, begin = second[k], ends[k] - second[k]["n"]
                if begin >= last:
                    break
                two.append([own["path"], own["at"], max(0, first - begin), min(own["n"], last - begin)])
            if r["n"]:
                out.append([s.sample, s.mode, first + 1, [[r["path"], r["at"], 0, r["n"]]], two])
            first = last
    return out


def read_fastq_split(spark: SparkSession, found: dict[str, SampleFiles] | list[SampleFiles], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The same rows as read_fastq(), of plain files of any size, or folders of plain part files. A first pass counts the ends of
    lines of every range of bytes; prefix sums of these counts (a row per range, on the driver like the ranges themselves) number
    the records. The second pass reads each range of a first file and, beside it, the same records of the second file, from
    the ranges that hold them: reads aren't shuffled."""
    spark.dataSource.register(FastqRangesSource)
    spark.dataSource.register(FastqPairsSource)
    samples = list(found.values() if isinstance(found, dict) else found)
    option = json.dumps([[s.sample, s.r1, s.r2] for s in samples])
    ranges = spark.read.format("fastq_ranges").option("samples", option).option("splitbytes", split_bytes).load().collect()
    return spark.read.format("fastq_pairs").option("parts", json.dumps(_parts(samples, ranges))).load()


def read_samples(spark: SparkSession, found: dict[str, SampleFiles], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The reads of found samples, by ranges of bytes where all files of a sample are plain and one is larger than a range,
    else by one task a sample."""
    def by_ranges(s: SampleFiles) -> bool:
        paths = [p for p in (s.r1, s.r2) if p]
        if any(p.endswith(".gz") for p in paths):
            return False
        return max(map(storage.size, paths)) > split_bytes

    large = [s for s in found.values() if by_ranges(s)]
    small = [s for s in found.values() if s not in large]
    if not large:
        return read_fastq(spark, small)
    rows = read_fastq_split(spark, large, split_bytes)
    return rows.unionByName(read_fastq(spark, small)) if small else rows
