"""Width and height of images from their headers: PNG, GIF, JPEG."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import checkpoint, small_side


def dimensions(head: bytes | None) -> tuple[int | None, int | None]:
    """Width and height, or nulls if the bytes are no image of a known kind.

    >>> dimensions(b"GIF89a" + bytes([5, 0, 7, 0]))
    (5, 7)
    """
    head = head or b""
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) >= 24:
        return struct.unpack(">II", head[16:24])
    if head[:6] in (b"GIF87a", b"GIF89a") and len(head) >= 10:
        return struct.unpack("<HH", head[6:10])
    if head[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(head):
            if head[at] != 0xFF:
                at += 1
                continue
            mark = head[at + 1]
            if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", head[at + 5 : at + 9])
                return width, height
            at += 2 if mark == 0xFF or 0xD0 <= mark <= 0xD9 or mark == 1 else 2 + struct.unpack(">H", head[at + 2 : at + 4])[0]
    return None, None


def read_dimensions(files: DataFrame, key: str, raw: str, head: int = 65_536) -> DataFrame:
    """key, width and height of files whose bytes are in the column ``raw``.

    The first ``head`` bytes of each file reach Python. A JPEG whose size stands behind
    longer metadata is read a second time, as a whole.
    """
    kind = files.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            both = [dimensions(c) for c in pdf["__head"]]
            more = [w is None and long and c[:2] == b"\xff\xd8" for (w, _), c, long in zip(both, pdf["__head"], pdf["__long"])]
            yield pdf[[key]].assign(width=pd.array([w for w, _ in both], dtype="Int32"), height=pd.array([h for _, h in both], dtype="Int32"), more=more)

    schema = f"`{key}` {kind}, width int, height int, more boolean"
    long = F.coalesce(F.octet_length(F.col(raw)) > head, F.lit(False))
    first = checkpoint(files.select(key, F.substring(F.col(raw), 1, head).alias("__head"), long.alias("__long")).mapInPandas(run, schema))
    rest = files.where(long & (F.hex(F.substring(F.col(raw), 1, 2)) == "FFD8")).join(small_side(first.where("more").select(key).distinct()), key, "left_semi")
    second = rest.select(key, F.col(raw).alias("__head"), F.lit(False).alias("__long")).mapInPandas(run, schema)
    return first.where("NOT more").unionByName(second).drop("more")
