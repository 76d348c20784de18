"""Image catalog: size, checksum and header dimensions of image files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _webp_size(data: bytes) -> tuple[int, int] | None:
    kind = data[12:16]
    if kind == b"VP8X" and len(data) >= 30:
        return int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1
    if kind == b"VP8L" and len(data) >= 25 and data[20] == 0x2F:
        bits = int.from_bytes(data[21:25], "little")
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8 " and len(data) >= 30 and data[23:26] == b"\x9d\x01\x2a":
        return int.from_bytes(data[26:28], "little") & 0x3FFF, int.from_bytes(data[28:30], "little") & 0x3FFF
    return None


def _tiff_size(data: bytes) -> tuple[int, int] | None:
    """From the first directory: tag 256 is the width, 257 the height, as 16 or 32 bits."""
    order = "little" if data[:2] == b"II" else "big"
    at = int.from_bytes(data[4:8], order)
    found = {}
    for k in range(int.from_bytes(data[at : at + 2], order)):
        entry = data[at + 2 + 12 * k : at + 14 + 12 * k]
        tag, kind = int.from_bytes(entry[:2], order), int.from_bytes(entry[2:4], order)
        if len(entry) == 12 and tag in (256, 257) and kind in (3, 4):
            found[tag] = int.from_bytes(entry[8 : 10 if kind == 3 else 12], order)
    return (found[256], found[257]) if len(found) == 2 else None


def header_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) from PNG, JPEG, WebP or TIFF header bytes, None if unreadable."""
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        return _webp_size(data)
    if data[:4] in (b"II*\x00", b"MM\x00*"):
        return _tiff_size(data)
    if data[:8] == b"\x89PNG\r\n\x1a\n" and data[12:16] == b"IHDR" and len(data) >= 24:
        return int.from_bytes(data[16:20], "big"), int.from_bytes(data[20:24], "big")
    if data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            return None
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
            continue
        # frame headers are C0-CF except the table segments C4, C8 and CC
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
        if kind == 0x01 or 0xD0 <= kind <= 0xD7:
            at += 2
            continue
        at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    return None


_SIZE = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])


@F.pandas_udf(_SIZE)
def _dims(contents: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in contents:
        sizes = [header_size(bytes(b)) if b is not None else None for b in batch]
        yield pd.DataFrame(
            {"width": [s[0] if s else None for s in sizes], "height": [s[1] if s else None for s in sizes]}, dtype="Int32"
        )


def catalog_of(files: DataFrame) -> DataFrame:
    """Rows of ``(path, length, content)`` with dimensions and SHA-256; unreadable files stay."""
    # a PNG header is read in the JVM; only other files travel to Python
    png = (F.hex(F.substring("content", 1, 8)) == "89504E470D0A1A0A") & (F.hex(F.substring("content", 13, 4)) == "49484452")
    png = png & (F.octet_length("content") >= 24)
    sized = files.select(
        "path", "length", F.sha2("content", 256).alias("sha256"), _dims(F.when(~png, F.col("content"))).alias("d"), png.alias("png"),
        F.hex(F.substring("content", 17, 4)).alias("w"), F.hex(F.substring("content", 21, 4)).alias("h"),
    )

    def side(part: str, other: str) -> Column:
        return F.when(F.col("png"), F.conv(part, 16, 10).cast("int")).otherwise(F.col(other)).alias(other.split(".")[1])

    return sized.select("path", F.col("length").alias("bytes"), "sha256", side("w", "d.width"), side("h", "d.height"))


def image_catalog(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Catalog of a folder.

    File contents travel to Python in Arrow batches, which Spark bounds by rows and bytes;
    set ``spark.sql.execution.arrow.maxRecordsPerBatch`` low for folders of large originals.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return catalog_of(files)
