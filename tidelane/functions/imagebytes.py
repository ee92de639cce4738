"""Image payloads as bytes: envelope checks and raw encodings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes per pixel and channels of the raw encodings.
RAW = {"mono8": (1, 1), "8UC1": (1, 1), "mono16": (2, 1), "16UC1": (2, 1), "rgb8": (3, 3), "bgr8": (3, 3), "yuv422": (2, 3), "uyvy": (2, 3), "yuyv": (2, 3), "yuv422_yuy2": (2, 3)}


def jpeg_fault(data: Column) -> Column:
    """Why bytes are no JPEG file: fewer than 4 bytes, no start marker, no end marker; NULL if both are there (or the value is NULL)."""
    head, tail = F.substring(data, 1, 2), F.substring(data, -2, 2)
    return (
        F.when(F.octet_length(data) < 4, "invalid_jpeg_markers")
        .when((head != F.unhex(F.lit("FFD8"))) & (tail != F.unhex(F.lit("FFD9"))), "invalid_jpeg_markers")
        .when(head != F.unhex(F.lit("FFD8")), "missing_soi")
        .when(tail != F.unhex(F.lit("FFD9")), "missing_eoi")
    )


def compressed_format(format_text: Column) -> Column:
    """jpeg or png from a free format text; NULL if neither is named."""
    f = F.lower(format_text)
    return F.when(F.contains(f, F.lit("jpeg")) | F.contains(f, F.lit("jpg")), "jpeg").when(F.contains(f, F.lit("png")), "png")


def decode_raw(data: bytes, encoding: str, height: int, width: int) -> np.ndarray | None:
    """Pixels as (height, width, 3) RGB or (height, width) grey; NULL for an unknown encoding or a wrong length.  mono16 is read as 16 bits."""
    if encoding not in RAW or data is None or len(data) != height * width * RAW[encoding][0]:
        return None
    if encoding in ("mono16", "16UC1"):
        return np.frombuffer(data, "<u2").reshape(height, width)
    pixels = np.frombuffer(data, np.uint8)
    if encoding in ("mono8", "8UC1"):
        return pixels.reshape(height, width)
    if encoding in ("rgb8", "bgr8"):
        rgb = pixels.reshape(height, width, 3)
        return rgb if encoding == "rgb8" else rgb[..., ::-1]
    quad = pixels.reshape(height, width // 2, 4).astype(np.float64)
    y0, u, y1, v = (quad[..., i] for i in ((0, 1, 2, 3) if "yuy" in encoding else (1, 0, 3, 2)))
    out = np.empty((height, width, 3))
    for k, y in enumerate((y0, y1)):
        c, d, e = 1.164 * (y - 16), u - 128, v - 128
        out[:, k::2] = np.stack([c + 1.596 * e, c - 0.392 * d - 0.813 * e, c + 2.017 * d], -1)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


@F.pandas_udf(T.DoubleType())
def mean_brightness(data: pd.Series, encoding: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """Mean of an image's raw pixels; NULL where it can't be decoded."""
    images = (decode_raw(d, e, int(h), int(w)) for d, e, h, w in zip(data, encoding, height, width, strict=True))
    return pd.Series([None if i is None else float(i.mean()) for i in images], dtype="float64")


@F.pandas_udf(T.ArrayType(T.FloatType()))
def unit_tensor(data: pd.Series, encoding: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """Pixels 0..1, channel by channel; NULL where the image can't be decoded."""
    def tensor(image: np.ndarray | None) -> list[float] | None:
        if image is None:
            return None
        top = 65535.0 if image.dtype == np.dtype("<u2") else 255.0
        return (np.moveaxis(np.atleast_3d(image), -1, 0) / top).astype(np.float32).ravel().tolist()

    return pd.Series([tensor(decode_raw(d, e, int(h), int(w))) for d, e, h, w in zip(data, encoding, height, width, strict=True)])
