"""``address_features``: the feature files as a registered source, for batch and stream reads.

    register(spark)
    spark.read.format("address_features").load("/data/features").where("job_id = '17'")
    spark.readStream.format("address_features").load("/data/features")

Files are partitions. Conditions on ``job_id`` and ``file_path`` decide which files are opened. Lines are
parsed in Python workers, batch by batch; ``geojson.read_features`` parses in the JVM and is the faster
way to read everything, this one is for readers that name a source by its format, or pick few files.

Options: ``job_pattern`` (where a path holds the job id), ``whole_files`` (``true`` unpacks a file once
before its first row is given, so a cut file gives none), ``on_broken`` (``fail``, or ``skip`` a file
that cannot be read to its end, which needs ``whole_files``).
"""

from __future__ import annotations

import fnmatch
import gzip
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from addrloom.sources.geojson import JOB_ID_PATTERN, PROPERTIES, TEXT_CHAINS

FORMAT = "address_features"
FILE_FIELDS = ("job_id", "file_path")
SCHEMA = (
    "job_id string, file_path string, file_size bigint, line_no bigint, item int, "
    + ", ".join(f"{name} string" for name in PROPERTIES)
    + ", not_text boolean"
)
ROWS = 4096
PIECE_BYTES = 1 << 20
BLANK = " \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class FeatureFile(InputPartition):
    path: str
    size: int
    modified: int
    job_id: str


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to a session, and let conditions reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(AddressFeatures)
    return spark


def list_feature_files(path: str, job_pattern: str) -> list[FeatureFile]:
    """Files below a folder, or of a pattern with ``*``, oldest first; hidden ones are left out."""
    from pyarrow import fs

    wild = re.search(r"[*?\[]", path)
    top = path[: wild.start()].rsplit("/", 1)[0] if wild else path.rstrip("/")
    files, base = fs.FileSystem.from_uri(top) if "://" in top or top.startswith("file:") else (
        fs.LocalFileSystem(), top
    )
    scheme = top[: len(top) - len(base)]
    info = files.get_file_info(base)
    found = [info] if info.is_file else files.get_file_info(fs.FileSelector(base, recursive=True))
    chosen = []
    for one in found:
        name = scheme + one.path
        hidden = any(part[:1] in "_." for part in one.path[len(base) :].split("/") if part)
        if not one.is_file or hidden or (wild and not _matches(name, path)):
            continue
        job = re.search(job_pattern, name)
        chosen.append(FeatureFile(name, one.size, one.mtime_ns or 0, job.group(1) if job else ""))
    return sorted(chosen, key=lambda f: (f.modified, f.path))


def _matches(name: str, pattern: str) -> bool:
    """A pattern names files, or folders whose files are all meant."""
    parts, wanted = name.split("/"), pattern.rstrip("/").split("/")
    return len(parts) >= len(wanted) and all(map(fnmatch.fnmatchcase, parts, wanted))


def _open(path: str):
    from pyarrow import fs

    files, base = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(), path
    )
    raw = files.open_input_stream(base, compression=None)
    return gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw


def problem_of(path: str) -> str | None:
    """Why a file cannot be read to its end, or ``None``."""
    try:
        with _open(path) as stream:
            while stream.read(PIECE_BYTES):
                pass
    except (OSError, EOFError, ValueError) as error:
        return str(error)
    return None


def lines_of(path: str) -> Iterator[str]:
    """Lines of a file, unpacked piece by piece."""
    rest = b""
    with _open(path) as stream:
        while piece := stream.read(PIECE_BYTES):
            *whole, rest = (rest + piece).split(b"\n")
            for line in whole:
                yield line.decode("utf-8", "replace")
    if rest:
        yield rest.decode("utf-8", "replace")


def _no_constant(text: str) -> None:
    raise ValueError(text)


_DECODER = json.JSONDecoder(parse_constant=_no_constant)


def document_of(line: str) -> dict | None:
    """The line's JSON object, or ``None`` where it is not one and nothing else."""
    text = re.sub(f"^[{BLANK}]*\x1e+[{BLANK}]*|^[{BLANK}]+|[{BLANK}]+$", "", line)
    try:
        found = _DECODER.decode(text)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def text_of(value: object) -> str | None:
    """Text of a property; what JSON counts as missing is null."""
    if not value:
        return None
    if isinstance(value, str):
        return value
    if isinstance(value, (dict, list)):
        return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    return str(value)


def bags_of(document: dict) -> list[dict]:
    """The property bags of a document, one per feature; null properties are an empty bag."""

    def bag(value: object) -> dict:
        return value if isinstance(value, dict) else {}

    kind = document.get("type")
    if kind == "Feature":
        return [bag(document.get("properties"))]
    if kind == "FeatureCollection":
        members = document.get("features")
        members = members if isinstance(members, list) else []
        return [bag(m.get("properties")) for m in members if isinstance(m, dict)]
    own = document.get("properties")
    return [own] if isinstance(own, dict) else []


def feature_rows(path: str) -> Iterator[tuple]:
    """(line number, place in the line, properties as text, whether a text property is no text)."""
    for number, line in enumerate(lines_of(path)):
        document = document_of(line)
        if document is None:
            continue
        for item, bag in enumerate(bags_of(document)):
            used = (next((bag[n] for n in chain if bag.get(n)), "") for chain in TEXT_CHAINS)
            wrong = any(not isinstance(value, str) for value in used)
            yield number, item, *(text_of(bag.get(name)) for name in PROPERTIES), wrong


def feature_batches(part: FeatureFile, options: dict) -> Iterator[pa.RecordBatch]:
    if options.get("whole_files", "false").lower() == "true":
        problem = problem_of(part.path)
        if problem is not None:
            if options.get("on_broken", "fail") == "skip":
                return
            raise OSError(f"{part.path}: {problem}")
    names = ["line_no", "item", *PROPERTIES, "not_text"]
    kinds = [pa.int64(), pa.int32(), *[pa.string()] * len(PROPERTIES), pa.bool_()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_pydict(
            {
                "job_id": pa.array([part.job_id] * len(rows), pa.string()),
                "file_path": pa.array([part.path] * len(rows), pa.string()),
                "file_size": pa.array([part.size] * len(rows), pa.int64()),
                **{n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)},
            }
        )

    held: list[tuple] = []
    for row in feature_rows(part.path):
        held.append(row)
        if len(held) == ROWS:
            yield batch(held)
            held = []
    if held:
        yield batch(held)


class _Files:
    def __init__(self, options: dict) -> None:
        self.options = dict(options)
        if "path" not in self.options:
            raise ValueError("name a path to load")
        if self.options.get("on_broken", "fail") == "skip" and (
            self.options.get("whole_files", "false").lower() != "true"
        ):
            raise ValueError("on_broken=skip needs whole_files=true: rows given cannot be taken back")

    def listed(self) -> list[FeatureFile]:
        pattern = self.options.get("job_pattern", JOB_ID_PATTERN)
        return list_feature_files(self.options["path"], pattern)


class FeatureReader(_Files, DataSourceReader):
    def __init__(self, options: dict) -> None:
        super().__init__(options)
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Conditions that a file's name answers are taken; the others are left to Spark."""
        for one in filters:
            known = isinstance(one, (EqualTo, In, StringStartsWith))
            if known and len(one.attribute) == 1 and one.attribute[0] in FILE_FIELDS:
                self.conditions.append(one)
            else:
                yield one

    def _wanted(self, file: FeatureFile) -> bool:
        own = {"job_id": file.job_id, "file_path": file.path}
        for one in self.conditions:
            value = own[one.attribute[0]]
            if isinstance(one, In):
                fits = value in one.value
            elif isinstance(one, StringStartsWith):
                fits = value.startswith(one.value)
            else:
                fits = value == one.value
            if not fits:
                return False
        return True

    def partitions(self) -> list[FeatureFile]:
        return [file for file in self.listed() if self._wanted(file)]

    def read(self, partition: FeatureFile) -> Iterator[pa.RecordBatch]:
        return feature_batches(partition, self.options)


class FeatureStreamReader(_Files, DataSourceStreamReader):
    """Micro-batches of the files that came since the last one, by time of change and path."""

    def initialOffset(self) -> dict:
        return {"modified": -1, "path": ""}

    def latestOffset(self) -> dict:
        listed = self.listed()
        if not listed:
            return self.initialOffset()
        return {"modified": listed[-1].modified, "path": listed[-1].path}

    def partitions(self, start: dict, end: dict) -> list[FeatureFile]:
        low, high = ((o["modified"], o["path"]) for o in (start, end))
        return [f for f in self.listed() if low < (f.modified, f.path) <= high]

    def read(self, partition: FeatureFile) -> Iterator[pa.RecordBatch]:
        return feature_batches(partition, self.options)

    def commit(self, end: dict) -> None:
        pass


class AddressFeatures(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> FeatureReader:
        return FeatureReader(self.options)

    def streamReader(self, schema: StructType) -> FeatureStreamReader:
        return FeatureStreamReader(self.options)
