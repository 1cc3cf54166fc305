"""Pixels to model input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linkmill.fixed_values import IMAGE_SIDE

_OUT_ROWS = 32  # images per output batch, bounds the memory of a task


def fit(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Centre crop or zero-pad to ``height`` x ``width``."""
    out = np.zeros((height, width, image.shape[2]), dtype=np.float32)
    spans = []
    for have, want in ((image.shape[0], height), (image.shape[1], width)):
        size = min(have, want)
        spans.append((max(have - want, 0) // 2, max(want - have, 0) // 2, size))
    (from_y, to_y, h), (from_x, to_x, w) = spans
    out[to_y : to_y + h, to_x : to_x + w] = image[from_y : from_y + h, from_x : from_x + w]
    return out


def _standard(pixels: np.ndarray) -> np.ndarray:
    wide = pixels.astype(np.float64).ravel()
    floor = 1.0 / np.sqrt(wide.size)
    return ((wide - wide.mean()) / max(wide.std(), floor)).astype(np.float32)


def image_features(
    df: DataFrame, height: int = IMAGE_SIDE, width: int = IMAGE_SIDE, pixels: str = "pixels"
) -> DataFrame:
    """Replace ``pixels (height, width, RGB bytes)`` by ``features array<float>``.

    Crops or pads to one size, then scales each image to mean 0 and deviation 1.
    """
    others = [c for c in df.columns if c not in (pixels, "height", "width")]
    narrow = df.select(*others, "height", "width", pixels)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.select(*others).schema]
    schema = ", ".join([*fields, "features array<float>"])
    n = len(others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _OUT_ROWS):
                part = batch.slice(at, _OUT_ROWS)
                vectors = []
                for h, w, raw in zip(*(part.column(i).to_pylist() for i in (n, n + 1, n + 2))):
                    image = np.frombuffer(raw, dtype=np.uint8).reshape(h, w, 3)
                    vectors.append(_standard(fit(image, height, width)))
                flat = np.concatenate(vectors)
                ends = np.arange(0, flat.size + 1, height * width * 3, dtype=np.int32)
                cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], cells], names=[*others, "features"]
                )

    return narrow.mapInArrow(run, schema)
