"""Members of ZIP archives as rows."""

from __future__ import annotations

import struct
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import filesystem, is_real_member, is_tiff


#: Where a member stands: its number in the archive's directory, the place of its own header and what is needed to unpack it.
PLACE = "struct<nth: long, at: long, packed: long, size: long, method: int, crc: long, flags: int>"
LISTED = f"zip string, member string, size long, packed long, error string, place {PLACE}"
#: Members that one Arrow batch passes on at most.
BATCH_MEMBERS = 5000


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ("nth", "at", "packed", "size", "method", "crc", "flags")
    place = pa.struct([(k, pa.int32() if k in ("method", "flags") else pa.int64()) for k in keys])
    types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), place)
    for batch in batches:
        for path in batch.column(0).to_pylist():
            try:
                fs, at = filesystem(path)
                with fs.open_input_file(at) as f, zipfile.ZipFile(f) as z:
                    found, error = z.infolist(), None
            except (zipfile.BadZipFile, ValueError, OSError) as e:
                found, error = [], str(e)
            for first in range(0, len(found) if error is None else 1, BATCH_MEMBERS):
                rows = [
                    (path, i.filename, i.file_size, i.compress_size, None, dict(zip(keys, (n, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC, i.flag_bits), strict=True)))
                    for n, i in enumerate(found[first : first + BATCH_MEMBERS], first)
                ] or [(path, None, None, None, error, None)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["zip", "member", "size", "packed", "error", "place"])


def members(zips: DataFrame, column: str = "path") -> DataFrame:
    """(zip, member, size, packed, error, place, tiff) of the real files in archives, read from their directories alone.

    An archive that can't be read has one row with its error and no member.  Folders and what macOS adds drop out.
    """
    rows = zips.select(F.col(column).alias("path")).mapInArrow(_listed, LISTED)
    return rows.where(F.col("error").isNotNull() | is_real_member(F.col("member"))).withColumn("tiff", is_tiff(F.col("member")))


def unpacked(f: BinaryIO, member: str, place: dict) -> bytes:
    """A member's content, read at its place in an open archive, without the archive's directory; checked by its CRC."""
    info = zipfile.ZipInfo(member)
    info.compress_size, info.file_size, info.compress_type, info.CRC, info.flag_bits = (place[k] for k in ("packed", "size", "method", "crc", "flags"))
    if info.flag_bits & 0x61:
        raise ValueError("the member is encrypted or a patch")
    f.seek(place["at"])
    head = f.read(30)
    if len(head) < 30 or head[:4] != b"PK\3\4":
        raise zipfile.BadZipFile("no header where the directory says")
    length, extra = struct.unpack_from("<HH", head, 26)
    name = f.read(length).decode("utf-8" if struct.unpack_from("<H", head, 6)[0] & 0x800 else "cp437")
    if name.partition("\0")[0] != member:
        raise zipfile.BadZipFile("the directory and the header give different names")
    f.seek(place["at"] + 30 + length + extra)
    try:
        data = zipfile.ZipExtFile(f, "r", info).read()
    except (NotImplementedError, EOFError) as e:
        raise zipfile.BadZipFile(str(e) or "the member ends early") from e
    if len(data) != place["size"]:
        raise zipfile.BadZipFile("the member ends early")
    return data


class Opened:
    """Archives opened one after another: the last one stays open while its members are read."""

    def __init__(self) -> None:
        self.path, self.file = None, None

    def read(self, path: str, member: str, place: dict) -> bytes:
        if path != self.path:
            self.close()
            fs, at = filesystem(path)
            self.file, self.path = fs.open_input_file(at), path
        return unpacked(self.file, member, place)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.path, self.file = None, None
