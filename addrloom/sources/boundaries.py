"""Boundary archives: zipped shapefiles to text attributes plus WKB geometry.

A Python worker only cuts each archive into records and turns a shape into WKB; the fixed-width
attribute records are split by column expressions. An archive member cannot exceed 2 GB by format.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.functions.text import null_if_empty

# Archive members by boundary kind, spatial reference id, geometry column.
STATE_MEMBER = r"(^|/)tl_[^/]*state\.shp$"
COUNTY_MEMBER = r"(^|/)tl_[^/]*county\.shp$"
SRID = 4269
GEOMETRY = "the_geom"

RECORD_SCHEMA = "path STRING, layout STRING, record_no INT, attributes BINARY, the_geom BINARY"
BATCH_RECORDS = 512


@dataclass(frozen=True)
class DbfField:
    name: str
    kind: str
    offset: int
    length: int
    decimals: int


def archives(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
    return reader.load(path).select("path", "content")


def dbf_fields(header: bytes) -> list[DbfField]:
    """Field list of a .dbf header; offsets count from the deletion flag at 0."""
    size = struct.unpack_from("<H", header, 8)[0]
    if len(header) < size:
        raise ValueError(f"the attribute header is cut: {len(header)} of {size} bytes")
    fields, offset = [], 1
    for start in range(32, size - 1, 32):
        if header[start] == 0x0D:
            break
        name = header[start : start + 11].split(b"\0")[0].decode("utf-8").lower()
        length = header[start + 16]
        fields.append(DbfField(name, chr(header[start + 11]), offset, length, header[start + 17]))
        offset += length
    return fields


def members(archive: zipfile.ZipFile, pattern: str) -> Iterator[tuple[bytes, bytes]]:
    """``(shp, dbf)`` bytes of the wanted shapefiles of an archive."""
    names = archive.namelist()
    for name in names:
        if re.search(pattern, name):
            twin = next(n for n in names if n.lower() == name[:-4].lower() + ".dbf")
            yield archive.read(name), archive.read(twin)


def signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0], ring[:, 1]
    return float(np.sum(x[:-1] * y[1:] - x[1:] * y[:-1])) / 2


def covers(ring: np.ndarray, point: np.ndarray) -> bool:
    """Even-odd test: does the ring go around the point?"""
    (x0, y0), (x1, y1) = ring[:-1].T, ring[1:].T
    crosses = (y0 > point[1]) != (y1 > point[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        at = x0 + (point[1] - y0) * (x1 - x0) / (y1 - y0)
    return bool(np.sum(crosses & (point[0] < at)) % 2)


def polygons(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Group rings: clockwise rings are shells, the others holes of the smallest shell around."""
    shells = [[ring] for ring in rings if signed_area(ring) < 0]
    for ring in rings:
        if signed_area(ring) < 0:
            continue
        around = [s for s in shells if covers(s[0], ring[0])]
        if len(shells) == 1:
            around = shells
        if around:
            min(around, key=lambda s: abs(signed_area(s[0]))).append(ring)
        else:
            shells.append([ring])
    return shells


def wkb_head(kind: int, count: int) -> bytes:
    return struct.pack("<BII", 1, kind, count)


def wkb_points(points: np.ndarray) -> bytes:
    return struct.pack("<I", len(points)) + points.astype("<f8").tobytes()


def to_wkb(shape: bytes) -> bytes | None:
    """Little-endian WKB of one shape record; measures and heights are left out."""
    kind = struct.unpack_from("<i", shape)[0] % 10
    if kind == 1:
        return struct.pack("<BI", 1, 1) + shape[4:20]
    if kind == 8:
        count = struct.unpack_from("<i", shape, 36)[0]
        points = [shape[40 + 16 * i : 56 + 16 * i] for i in range(count)]
        return wkb_head(4, count) + b"".join(struct.pack("<BI", 1, 1) + p for p in points)
    if kind not in (3, 5):
        return None
    n_parts, n_points = struct.unpack_from("<ii", shape, 36)
    starts = [*struct.unpack_from(f"<{n_parts}i", shape, 44), n_points]
    points = np.frombuffer(shape, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2)
    parts = [points[a:b] for a, b in zip(starts, starts[1:])]
    if kind == 3:
        lines = [struct.pack("<BI", 1, 2) + wkb_points(part) for part in parts]
        return lines[0] if len(lines) == 1 else wkb_head(5, len(lines)) + b"".join(lines)
    areas = [
        wkb_head(3, len(rings)) + b"".join(wkb_points(ring) for ring in rings)
        for rings in polygons(parts)
    ]
    return areas[0] if len(areas) == 1 else wkb_head(6, len(areas)) + b"".join(areas)


def cut_records(shp: bytes, dbf: bytes) -> Iterator[tuple[int, bytes, bytes | None]]:
    """``(record number, attribute bytes, WKB)``; deleted attribute records are left out."""
    head, width = struct.unpack_from("<HH", dbf, 8)
    place, number = 100, 0
    while place + 8 <= len(shp):
        length = 2 * struct.unpack_from(">i", shp, place + 4)[0]
        attributes = dbf[head + number * width : head + (number + 1) * width]
        if attributes[:1] != b"*":
            yield number, attributes, to_wkb(shp[place + 8 : place + 8 + length])
        place, number = place + 8 + length, number + 1


def dbf_header(data: bytes) -> bytes:
    """The field part of a .dbf file, without date and record count in front of it."""
    return data[: struct.unpack_from("<H", data, 8)[0]]


def layout_name(header: bytes) -> str:
    """Equal for headers with equal fields."""
    return hashlib.sha256(header[32:]).hexdigest()


def archive_records(zipped: DataFrame, member: str) -> DataFrame:
    """One row per shape with its undivided attribute bytes, from ``(path, content)`` archives."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "layout", "record_no", "attributes", "the_geom"]
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for shp, dbf in members(archive, member):
                        rows, layout = [], layout_name(dbf_header(dbf))
                        for record in cut_records(shp, dbf):
                            rows.append((file, layout, *record))
                            if len(rows) == BATCH_RECORDS:
                                yield pd.DataFrame(rows, columns=columns)
                                rows = []
                        if rows:
                            yield pd.DataFrame(rows, columns=columns)

    return zipped.mapInPandas(decode, RECORD_SCHEMA)


def archive_layouts(zipped: DataFrame, member: str) -> dict[str, list[DbfField]]:
    """Fields of every attribute layout among the archives: their headers, no data."""

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {}
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in archive.namelist():
                        if re.search(member, name):
                            twin = name[:-4].lower() + ".dbf"
                            real = next(n for n in archive.namelist() if n.lower() == twin)
                            with archive.open(real) as dbf:
                                start = dbf.read(32)
                                size = struct.unpack_from("<H", start, 8)[0]
                                header = start + dbf.read(size - 32)
                            found[layout_name(header)] = header
            yield pd.DataFrame({"layout": list(found), "header": list(found.values())})

    rows = zipped.mapInPandas(headers, "layout STRING, header BINARY")
    # One row per different layout, and those are few: a boundary kind has one per edition.
    different = rows.groupBy("layout").agg(F.first("header").alias("header")).collect()
    if not different:
        raise ValueError(f"no archive has a member like {member}")
    return {row.layout: dbf_fields(bytes(row.header)) for row in sorted(different)}


def attribute_text(field: DbfField) -> Column:
    """Text of one attribute: numbers without padding, dates as ISO text, blanks as null."""
    cell = F.substring("attributes", field.offset + 1, field.length)
    text = F.regexp_replace(F.decode(cell, "UTF-8"), r"^[\s\x00]+|[\s\x00]+$", "")
    if field.kind in "NF":
        text = null_if_empty(F.regexp_replace(text, r"\*", ""))
        if field.kind == "N" and field.decimals == 0:
            return text.cast("decimal(38,0)").cast("string")
        # Plain digits at any size, with at least one decimal place.
        plain = text.cast(f"decimal(38,{max(1, field.decimals)})").cast("string")
        return F.regexp_replace(plain, r"(\.\d+?)0+$", "$1")
    if field.kind == "D":
        return F.date_format(F.to_date(null_if_empty(text), "yyyyMMdd"), "yyyy-MM-dd")
    if field.kind == "L":
        return F.when(F.upper(text).isin("T", "Y"), "true").when(
            F.upper(text).isin("F", "N"), "false"
        )
    return text


def boundaries(zipped: DataFrame, member: str) -> DataFrame:
    """All attributes as text under lower-case names, the geometry as WKB, its reference id.

    Each archive is read by its own layout; an attribute that one of them lacks is null there.
    """
    layouts = archive_layouts(zipped, member)
    names = list(dict.fromkeys(field.name for fields in layouts.values() for field in fields))
    texts = {
        name: F.coalesce(
            *[
                F.when(F.col("layout") == layout, attribute_text(field))
                for layout, fields in layouts.items()
                for field in fields
                if field.name == name
            ]
        )
        for name in names
    }
    return archive_records(zipped, member).select(
        *[text.alias(name) for name, text in texts.items()], GEOMETRY, F.lit(SRID).alias("srid")
    )


def read_boundaries(spark: SparkSession, path: str, member: str) -> DataFrame:
    return boundaries(archives(spark, path), member)
