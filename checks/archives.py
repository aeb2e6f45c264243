"""Zipped shapefiles made from the customer table, for the boundary reader's checks."""

from __future__ import annotations

import io
import struct
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Customers per archive.
ARCHIVE_ROWS = 5_000


def square(x: float, y: float) -> bytes:
    """Shape record content: one clockwise unit square."""
    ring = [(x, y), (x, y + 1), (x + 1, y + 1), (x + 1, y), (x, y)]
    return polygon([ring])


def polygon(rings: list[list[tuple[float, float]]]) -> bytes:
    points = [point for ring in rings for point in ring]
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    starts = [sum(len(r) for r in rings[:i]) for i in range(len(rings))]
    head = struct.pack("<i4dii", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(points))
    return (
        head
        + struct.pack(f"<{len(starts)}i", *starts)
        + b"".join(struct.pack("<2d", *point) for point in points)
    )


def shp_file(shapes: list[bytes]) -> bytes:
    body = b"".join(
        struct.pack(">ii", i + 1, len(shape) // 2) + shape for i, shape in enumerate(shapes)
    )
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2)
    return head + struct.pack("<2i8d", 1000, 5, *[0.0] * 8) + body


def dbf_file(fields: list[tuple[str, str, int, int]], rows: list[tuple[str, ...]]) -> bytes:
    """``fields`` are (name, kind, length, decimals); a first value ``None`` deletes the row."""
    width = 1 + sum(field[2] for field in fields)
    head = struct.pack("<4BIHH20x", 3, 121, 1, 1, len(rows), 33 + 32 * len(fields), width)
    for name, kind, length, decimals in fields:
        head += struct.pack("<11sc4xBB14x", name.encode(), kind.encode(), length, decimals)
    cells = [
        (b"*" if row[0] is None else b" ")
        + b"".join(
            (value or "").encode().rjust(f[2]) if f[1] == "N" else (value or "").encode().ljust(f[2])
            for value, f in zip(row, fields)
        )
        for row in rows
    ]
    return head + b"\r" + b"".join(cells) + b"\x1a"


def zip_file(members: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return out.getvalue()


COUNTY_FIELDS = [
    ("STATEFP", "C", 2, 0), ("COUNTYFP", "C", 8, 0), ("GEOID", "C", 10, 0), ("NAME", "C", 30, 0),
    ("ALAND", "N", 14, 0),
]


def county_archive(rows: pd.DataFrame) -> bytes:
    """Archive of ``(statefp, countyfp, geoid, name, aland, x, y)`` rows."""
    shapes = [square(x, y) for x, y in zip(rows["x"], rows["y"])]
    columns = ["statefp", "countyfp", "geoid", "name", "aland"]
    cells = list(rows[columns].astype(str).itertuples(index=False, name=None))
    stem = "tl_2021_us_county"
    return zip_file(
        {f"{stem}.shp": shp_file(shapes), f"{stem}.dbf": dbf_file(COUNTY_FIELDS, cells)}
    )


def customer_archives(customers: DataFrame) -> DataFrame:
    """``(path, content)`` archives, each of a bounded number of customers."""
    rows = customers.select(
        F.floor(F.col("c_custkey") / ARCHIVE_ROWS).alias("part"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("statefp"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("countyfp"),
        F.concat(
            F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
            F.lpad(F.col("c_custkey").cast("string"), 8, "0"),
        ).alias("geoid"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") * 10).alias("aland"),
        (F.col("c_custkey") % 360 - 180).cast("double").alias("x"),
        (F.col("c_custkey") % 180 - 90).cast("double").alias("y"),
    )

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {"path": [f"counties-{group['part'].iloc[0]}.zip"], "content": [county_archive(group)]}
        )

    return rows.groupBy("part").applyInPandas(pack, "path STRING, content BINARY")


def nation_archives(nations: DataFrame) -> DataFrame:
    """``(path, content)`` state archives, each of a bounded number of nations."""
    rows = nations.select(
        F.floor(F.col("n_nationkey") / ARCHIVE_ROWS).alias("part"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("statefp"),
        F.col("n_nationkey").cast("string").alias("statens"),
        F.col("n_name").alias("name"),
    )

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        fields = [("STATEFP", "C", 2, 0), ("STATENS", "C", 8, 0), ("NAME", "C", 30, 0)]
        cells = list(group[["statefp", "statens", "name"]].itertuples(index=False, name=None))
        shapes = [square(k, k) for k in range(len(cells))]
        stem = "tl_2021_us_state"
        content = zip_file({f"{stem}.shp": shp_file(shapes), f"{stem}.dbf": dbf_file(fields, cells)})
        return pd.DataFrame({"path": [f"states-{group['part'].iloc[0]}.zip"], "content": [content]})

    return rows.groupBy("part").applyInPandas(pack, "path STRING, content BINARY")


def write_archives(archives: DataFrame, folder: str) -> str:
    """Write each archive as a file below ``folder``, from the tasks that made it."""

    def store(batches):
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with files.open_output_stream(f"{base}/{name}") as stream:
                    stream.write(content)
            yield batch[["path"]]

    archives.mapInPandas(store, "path STRING").count()
    return folder
