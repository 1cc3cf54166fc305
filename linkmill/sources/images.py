"""Image folders ``root/<class>/<file>``."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.functions.text import parent_name

# fixed values: PNG signature, channels by PNG colour type, JPEG markers that start a frame header
_PNG = "89504E470D0A1A0A"
_PNG_CHANNELS = {0: 1, 2: 3, 3: 3, 4: 2, 6: 4}
_JPEG_FRAMES = sorted(set(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC})
#: segments and fill bytes that may stand before the frame header of a JPEG
MAX_SEGMENTS = 1024


def list_image_files(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """``(path, class)`` and, on request, the encoded bytes.

    Without ``content`` no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    columns = ["path", parent_name(F.col("path")).alias("class")]
    if content:
        columns.append(F.col("content").alias("encoded"))
    return files.select(*columns)


def _rgb(data: pd.Series) -> pd.Series:
    def swap(raw: bytes) -> bytes:
        out = bytearray(raw)
        out[0::3], out[2::3] = raw[2::3], raw[0::3]
        return bytes(out)

    return data.map(swap)


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images: ``(path, class, height, width, pixels)``, pixels in RGB order.

    Decoding is Spark's own; an image without three channels fails the job.
    """
    images = (
        spark.read.format("image").option("recursiveFileLookup", "true").load(root).select("image.*")
    )
    complaint = F.concat(F.lit("not a three-channel image: "), F.col("origin"))
    data = F.when(F.col("nChannels") == 3, F.col("data")).otherwise(
        F.raise_error(complaint).cast("binary")
    )
    to_rgb = F.pandas_udf(_rgb, "binary")
    return images.select(
        F.col("origin").alias("path"),
        parent_name(F.col("origin")).alias("class"),
        "height",
        "width",
        to_rgb(data).alias("pixels"),
    )


def _number(raw: Column, at: Column | int, size: int) -> Column:
    """The big-endian number in ``size`` bytes from the 1-based place ``at``."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.hex(F.substring(raw, at, F.lit(size))), 16, 10).cast("long")


def _dims(height: Column, width: Column, channels: Column) -> Column:
    return F.struct(height.alias("height"), width.alias("width"), channels.alias("channels"))


def _jpeg_dims(raw: Column) -> Column:
    """Walk from marker to marker up to the frame header; null if there is none."""

    def step(state: Column, _: Column) -> Column:
        at = state["at"]
        marker = _number(raw, at + 1, 1)
        here = _dims(_number(raw, at + 5, 2), _number(raw, at + 7, 2), _number(raw, at + 9, 1))
        onward = F.when(marker == 255, at + 1).otherwise(at + 2 + _number(raw, at + 2, 2))
        none = F.lit(None).cast("struct<height:long,width:long,channels:long>")
        moved = (
            F.when(_number(raw, at, 1) != 255, F.struct(F.lit(None).cast("long").alias("at"), none.alias("dims")))
            .when(marker.isin(_JPEG_FRAMES), F.struct(at.alias("at"), here.alias("dims")))
            .otherwise(F.struct(onward.alias("at"), none.alias("dims")))
        )
        return F.when(at.isNull() | state["dims"].isNotNull(), state).otherwise(moved)

    start = F.struct(F.lit(3).cast("long").alias("at"), F.lit(None).cast("struct<height:long,width:long,channels:long>").alias("dims"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(MAX_SEGMENTS)), start, step, lambda state: state["dims"])


def image_dims(encoded: Column) -> Column:
    """``(height, width, channels)`` of encoded PNG or JPEG images, read from their headers.

    Column functions only: no pixel is decoded and no byte leaves the JVM.  Anything
    else, or a JPEG without a frame header, fails the job.
    """
    colour = _number(encoded, 26, 1)
    channels = F.lit(None).cast("long")
    for kind, count in _PNG_CHANNELS.items():
        channels = F.when(colour == kind, F.lit(count).cast("long")).otherwise(channels)
    png = _dims(_number(encoded, 21, 4), _number(encoded, 17, 4), channels)
    found = F.when(F.hex(F.substring(encoded, 1, 8)) == _PNG, png).when(
        F.hex(F.substring(encoded, 1, 2)) == "FFD8", _jpeg_dims(encoded)
    )
    complaint = F.raise_error(F.lit("neither a PNG nor a JPEG with a frame header"))
    return F.when(found["height"].isNotNull() & found["channels"].isNotNull(), found).otherwise(
        complaint.cast("struct<height:long,width:long,channels:long>")
    )
