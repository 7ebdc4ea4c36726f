import bz2
import gzip
import io
import struct
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame

from stationlake.schemas import LINES_SCHEMA


def lines_df(spark, files: dict[str, str]) -> DataFrame:
    """LINES from {name: text} without touching the file system."""
    rows = []
    for name, text in files.items():
        parts = text.split("\n")
        if parts and parts[-1] == "":
            parts.pop()
        for i, v in enumerate(parts, start=1):
            rows.append((f"/inbox/{name}", name, i, v))
    return spark.createDataFrame(rows, LINES_SCHEMA)


def write_text(path, text, newline="\n", encoding="utf-8"):
    data = text.replace("\n", newline).encode(encoding)
    with open(path, "wb") as f:
        f.write(data)
    return path


def framed(codec: str, data: bytes, block: int = 1000, chunk: int = 1000) -> bytes:
    """``data`` in the framing of Hadoop's block codecs."""
    pack, out = pa.Codec(codec), []
    for lo in range(0, len(data), block):
        part = data[lo:lo + block]
        out.append(struct.pack(">I", len(part)))
        for at in range(0, len(part), chunk):
            body = pack.compress(part[at:at + chunk], asbytes=True)
            out += [struct.pack(">I", len(body)), body]
    return b"".join(out)


def zipped(data: bytes, method: int = zipfile.ZIP_DEFLATED, more: bool = True) -> bytes:
    mem = io.BytesIO()
    with zipfile.ZipFile(mem, "w", method) as z:
        z.writestr("first.csv", data)
        if more:
            z.writestr("second.csv", b"ignored\n")
    return mem.getvalue()


PACK = {".gz": gzip.compress, ".bz2": bz2.compress, ".deflate": zlib.compress, ".zip": zipped,
        ".lz4": lambda b: framed("lz4_raw", b), ".snappy": lambda b: framed("snappy", b)}
