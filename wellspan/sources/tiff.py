"""TIFF files as numpy arrays and as rows: a codec for grey pages, their metadata, and a reader that decodes in tasks."""

from __future__ import annotations

import io
import json
import lzma
import struct
import xml.etree.ElementTree as ET
import zlib
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

#: Fixed values of the TIFF format: bytes of each field type, compression numbers.
FIELD = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 10: "ii", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
COMPRESSION = {"none": 1, "lzw": 5, "zlib": 8, "lzma": 34925, "zstd": 50000}
#: Fixed name of the OME schema.
OME = "http://www.openmicroscopy.org/Schemas/OME/2016-06"
BROKEN = (ValueError, KeyError, IndexError, TypeError, struct.error, zlib.error, lzma.LZMAError, zstandard.ZstdError, ET.ParseError)


def pages(data: bytes) -> tuple[str, list[dict[int, tuple]]]:
    """Byte order and the tags of each page; text tags are one bytes value, rationals are pairs in a row."""
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if order is None or len(data) < 8:
        raise ValueError("not a TIFF")
    big = struct.unpack_from(order + "H", data, 2)[0] == 43
    at = struct.unpack_from(order + ("Q" if big else "I"), data, 8 if big else 4)[0]
    head, entry, inline, link = ("Q", "HHQ", 8, "Q") if big else ("H", "HHI", 4, "I")
    out, seen = [], set()
    while at and at not in seen:
        seen.add(at)
        count = struct.unpack_from(order + head, data, at)[0]
        at += struct.calcsize(order + head)
        step = struct.calcsize(order + entry) + inline
        tags: dict[int, tuple] = {}
        for i in range(count):
            tag, kind, n = struct.unpack_from(order + entry, data, at + i * step)
            if kind not in FIELD:
                continue
            form = order + (f"{n}s" if kind == 2 else FIELD[kind] * n)
            place = at + (i + 1) * step - inline
            if struct.calcsize(form) > inline:
                place = struct.unpack_from(order + link, data, place)[0]
            tags[tag] = struct.unpack_from(form, data, place)
        out.append(tags)
        at = struct.unpack_from(order + link, data, at + count * step)[0]
    return order, out


def tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    """Byte order and the tags of the first page."""
    order, found = pages(data)
    return order, found[0]


def rational(value: tuple) -> float:
    """Numerator by denominator, 0 by anything is 0."""
    return value[0] / value[1] if value[1] else 0.0


def _unlzw(data: bytes) -> bytes:
    out, table, width, bits, held, last = bytearray(), [], 9, 0, 0, None
    for byte in data:
        bits, held = bits << 8 | byte, held + 8
        if held < width:
            continue
        held -= width
        code = bits >> held
        bits &= (1 << held) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, None
            continue
        word = table[code] if code < len(table) else last + last[:1]
        if last is not None:
            table.append(last + word[:1])
        out += word
        last = word
        width = min(12, (len(table) + 1).bit_length() if len(table) + 1 >= 512 else 9)
    return bytes(out)


def _lzw(data: bytes) -> bytes:
    """Codes of growing width, cleared before the table is full; the writer's table is one entry ahead of the reader's."""
    out, bits, held = bytearray(), 0, 0
    fresh = {bytes([i]): i for i in range(256)}
    table, width, free, word = dict(fresh), 9, 258, b""

    def put(code: int) -> None:
        nonlocal bits, held
        bits, held = bits << width | code, held + width
        while held >= 8:
            held -= 8
            out.append(bits >> held)
            bits &= (1 << held) - 1

    put(256)
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer], free = free, free + 1
        word = data[i : i + 1]
        if free == 4094:
            put(256)
            table, width, free = dict(fresh), 9, 258
        else:
            width = max(9, free.bit_length())
    if word:
        put(table[word])
        # The reader makes an entry of the last word too before it reads the end mark.
        width = max(width, (free + 1).bit_length())
    put(257)
    if held:
        out.append(bits << (8 - held) & 255)
    return bytes(out)


def _inflate(data: bytes, compression: int) -> bytes:
    match compression:
        case 1:
            return bytes(data)
        case 5:
            return _unlzw(data)
        case 8 | 32946:
            return zlib.decompress(data)
        case 34925:
            return lzma.decompress(data)
        case 50000:
            return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    raise ValueError(f"compression {compression} is not supported")


def _deflate(raw: bytes, compression: str) -> bytes:
    match compression:
        case "zlib":
            return zlib.compress(raw, 6)
        case "lzma":
            return lzma.compress(raw)
        case "zstd":
            return zstandard.ZstdCompressor().compress(raw)
        case "lzw":
            return _lzw(raw)
        case "none":
            return raw
    raise ValueError(f"can't write {compression}")


def _page(data: bytes, order: str, t: dict[int, tuple]) -> np.ndarray:
    width, height, bits = t[256][0], t[257][0], t.get(258, (1,))[0]
    if t.get(277, (1,))[0] != 1 or bits not in (8, 16, 32):
        raise ValueError("only grey pages of 8, 16 or 32 bits are read")
    kind = np.dtype(f"{order}{'f' if t.get(339, (1,))[0] == 3 else 'u'}{bits // 8}")
    code, add = t.get(259, (1,))[0], t.get(317, (1,))[0] == 2
    if 322 in t:
        h, w, offsets, counts = t[323][0], t[322][0], t[324], t[325]
    else:
        h, w, offsets, counts = min(t.get(278, (height,))[0], height), width, t[273], t[279]
    across = -(-width // w)
    out = np.zeros((-(-height // h) * h, across * w), kind.newbyteorder("="))
    for i, (a, n) in enumerate(zip(offsets, counts, strict=True)):
        block = np.frombuffer(_inflate(data[a : a + n], code), kind)
        block = block[: len(block) // w * w].reshape(-1, w)[:h].astype(kind.newbyteorder("="))
        y, x = i // across * h, i % across * w
        out[y : y + len(block), x : x + w] = np.cumsum(block, axis=1, dtype=block.dtype) if add else block
    return out[:height, :width]


def decode(data: bytes, page: int = 0) -> np.ndarray:
    """A page as (height, width), of 8, 16 or 32 bits, in native byte order; strips and tiles."""
    order, found = pages(data)
    return _page(data, order, found[page])


def decode_all(data: bytes) -> list[np.ndarray]:
    order, found = pages(data)
    return [_page(data, order, t) for t in found]


class Writer:
    """Writes grey pages one by one, each in one strip, to a file object that can seek; memory holds one page.

    ``big`` files have 64-bit places.  ``description`` goes to the first page and must be ASCII; ``describe`` puts another in its place.
    """

    def __init__(self, file: BinaryIO, compression: str = "zlib", description: str = "", big: bool = True, photometric: int = 1, resolution: tuple[float, float] | None = None, unit: int = 2):
        if compression not in COMPRESSION:
            raise ValueError(f"can't write {compression}")
        self.file, self.compression, self.text, self.big = file, compression, description.encode("ascii") + b"\0", big
        self.photometric, self.resolution, self.unit = photometric, resolution, unit
        self.first, self.link, self.said = True, 8 if big else 4, None
        file.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0) if big else struct.pack("<2sHI", b"II", 42, 0))

    def add(self, page: np.ndarray) -> None:
        page = np.ascontiguousarray(page, page.dtype.newbyteorder("<"))
        raw = _deflate(page.tobytes(), self.compression)
        at = self.file.seek(0, io.SEEK_END)
        if not self.big and at + len(raw) + len(self.text) + 400 >= 2**32:
            raise ValueError("too large for a classic TIFF")
        self.file.write(raw)
        place, long_ = ("Q", 16) if self.big else ("I", 4)
        height, width = page.shape
        fields: list[tuple[int, int, int, bytes]] = [
            (256, 4, 1, struct.pack("<I", width)), (257, 4, 1, struct.pack("<I", height)), (258, 3, 1, struct.pack("<H", page.dtype.itemsize * 8)),
            (259, 3, 1, struct.pack("<H", COMPRESSION[self.compression])), (262, 3, 1, struct.pack("<H", self.photometric)),
        ]
        if self.first and len(self.text) > 1:
            fields.append((270, 2, len(self.text), self.text))
        fields += [(273, long_, 1, struct.pack("<" + place, at)), (277, 3, 1, struct.pack("<H", 1)), (278, 4, 1, struct.pack("<I", height)), (279, long_, 1, struct.pack("<" + place, len(raw)))]
        if self.resolution:
            fields += [(tag, 5, 1, struct.pack("<II", round(value * 10**4), 10**4)) for tag, value in zip((282, 283), self.resolution, strict=True)]
            fields.append((296, 3, 1, struct.pack("<H", self.unit)))
        fields.append((339, 3, 1, struct.pack("<H", 3 if page.dtype.kind == "f" else 1)))
        inline = 8 if self.big else 4
        where = []
        for _, _, _, value in fields:
            where.append(self.file.tell())
            if len(value) > inline:
                self.file.write(value)
        here = self.file.tell()
        here += here % 2
        self.file.seek(here)
        self.file.write(struct.pack("<Q" if self.big else "<H", len(fields)))
        for (tag, kind, n, value), stands in zip(fields, where, strict=True):
            self.said = self.file.tell() if tag == 270 else self.said
            self.file.write(struct.pack("<HHQ" if self.big else "<HHI", tag, kind, n))
            self.file.write(value.ljust(inline, b"\0") if len(value) <= inline else struct.pack("<" + place, stands))
        link = self.file.tell()
        self.file.write(struct.pack("<" + place, 0))
        self.file.seek(self.link)
        self.file.write(struct.pack("<" + place, here))
        self.link, self.first = link, False

    def describe(self, description: str) -> None:
        """Replace the first page's description, which must be there, by a longer or shorter one of 8 characters or more."""
        text = description.encode("ascii") + b"\0"
        if self.said is None or len(text) <= 8:
            raise ValueError("there is no description to replace")
        at = self.file.seek(0, io.SEEK_END)
        self.file.write(text)
        self.file.seek(self.said)
        self.file.write(struct.pack("<HHQQ", 270, 2, len(text), at) if self.big else struct.pack("<HHII", 270, 2, len(text), at))
        self.file.seek(0, io.SEEK_END)


def encode(array: np.ndarray, compression: str = "zlib", description: str = "", **how) -> bytes:
    """A little-endian TIFF of one page (height, width) or several (n, height, width); classic unless ``big``."""
    out = io.BytesIO()
    writer = Writer(out, compression, description, **({"big": False} | how))
    for page in array if array.ndim == 3 else [array]:
        writer.add(page)
    return out.getvalue()


# Metadata


def ome_xml(sizes: dict[str, int], dtype: str = "uint16", channels: Sequence[str] = (), planes: Sequence[dict] = (), description: str = "", present: Sequence[tuple[int, int, int]] | None = None, **pixels) -> str:
    """ASCII OME-XML of an image of T, C, Z, Y, X sizes; ``pixels`` are further attributes such as PhysicalSizeX.

    ``present``: (t, c, z) of each page where some planes of these sizes have none.
    """
    ET.register_namespace("", OME)
    tag = lambda name: f"{{{OME}}}{name}"
    root = ET.Element(tag("OME"))
    image = ET.SubElement(root, tag("Image"), ID="Image:0", Name="Image0")
    if description:
        ET.SubElement(image, tag("Description")).text = description
    own = {k: str(v) for k, v in pixels.items() if v is not None}
    size = {f"Size{a}": str(sizes.get(a, 1)) for a in "XYZCT"}
    px = ET.SubElement(image, tag("Pixels"), ID="Pixels:0", DimensionOrder="XYZCT", Type=dtype, **size, **own)
    for i in range(sizes.get("C", 1)):
        ET.SubElement(px, tag("Channel"), ID=f"Channel:0:{i}", SamplesPerPixel="1", Name=channels[i] if i < len(channels) else f"Channel_{i}")
    if present is None:
        ET.SubElement(px, tag("TiffData"), IFD="0", PlaneCount=str(sizes.get("T", 1) * sizes.get("C", 1) * sizes.get("Z", 1)))
    for i, (t, c, z) in enumerate(present or ()):
        ET.SubElement(px, tag("TiffData"), IFD=str(i), FirstT=str(t), FirstC=str(c), FirstZ=str(z), PlaneCount="1")
    for p in planes:
        ET.SubElement(px, tag("Plane"), **{k: str(v) for k, v in p.items() if v is not None})
    return ET.tostring(root, "us-ascii").decode("ascii")


def image_metadata(data: bytes) -> dict:
    """kind (ome, imagej or plain), axes, sizes of the axes, and what the description says besides.

    OME: pixels (attributes), channels (names), planes, pages (what TiffData says of them), description.  ImageJ: its entries.  XML that can't be read leaves
    the axes that the pages show.
    """
    _, found = pages(data)
    text = found[0].get(270, (b"",))[0].rstrip(b"\0").decode("utf-8", "replace")
    height, width = found[0][257][0], found[0][256][0]
    shown = {"I": len(found)} if len(found) > 1 else {}
    plain = {"kind": "plain", "axes": "".join(shown) + "YX", "sizes": [*shown.values(), height, width]}
    if text.startswith("ImageJ="):
        info = dict(line.split("=", 1) for line in text.splitlines() if "=" in line)
        sizes = {a: int(info.get(k, 1)) for a, k in (("T", "frames"), ("Z", "slices"), ("C", "channels"))}
        sizes = {a: n for a, n in sizes.items() if n > 1}
        return {"kind": "imagej", "axes": "".join(sizes) + "YX", "sizes": [*sizes.values(), height, width], "info": info}
    if "<OME" not in text:
        return plain
    try:
        root = ET.fromstring(text)
        px = root.find(".//{*}Pixels")
        given = px.get("DimensionOrder", "XYZCT")[::-1]
        sizes = {a: int(px.get(f"Size{a}", 1)) for a in given}
        sizes = {a: n for a, n in sizes.items() if n > 1 or a in "YX"}
        return {
            "kind": "ome", "axes": "".join(sizes), "sizes": list(sizes.values()), "pixels": dict(px.attrib),
            "channels": [c.get("Name", f"Channel_{i}") for i, c in enumerate(px.findall("{*}Channel"))],
            "planes": [dict(p.attrib) for p in px.findall("{*}Plane")], "pages": [dict(p.attrib) for p in px.findall("{*}TiffData")], "description": root.findtext(".//{*}Image/{*}Description") or "",
        }
    except (ET.ParseError, AttributeError, ValueError):
        return plain | {"kind": "ome"}


def recompressed(data: bytes, compression: str = "zlib") -> bytes:
    """The same pages under another compression, with photometric, resolution and description kept, checked by reading it back."""
    _, found = pages(data)
    first = found[0]
    resolution = (rational(first[282]), rational(first[283])) if 282 in first and 283 in first else None
    text = first.get(270, (b"",))[0].rstrip(b"\0").decode("utf-8", "replace")
    # A description must be ASCII; in XML other characters are written as references.
    text = text.encode("ascii", "xmlcharrefreplace" if "<OME" in text else "replace").decode("ascii")
    out = io.BytesIO()
    writer = Writer(out, compression, text, big=len(data) > 2**31, photometric=first.get(262, (1,))[0], resolution=resolution, unit=first.get(296, (2,))[0])
    all_pages = decode_all(data)
    for page in all_pages:
        writer.add(page)
    result = out.getvalue()
    if not all(np.array_equal(a, b) for a, b in zip(decode_all(result), all_pages, strict=True)):
        raise ValueError("the written file does not read back")
    return result


# Rows

PLANE_ROW = "path string, page int, h int, w int, dtype string, px binary, error string"


def _decoded(every: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.string())
        names = ["path", "page", "h", "w", "dtype", "px", "error"]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                try:
                    data = files.read_bytes(path)
                    for i, page in enumerate(decode_all(data) if every else [decode(data)]):
                        rows.append((path, i, *page.shape, str(page.dtype), page.astype(page.dtype.newbyteorder("<")).tobytes(), None))
                except (*BROKEN, OSError) as e:
                    rows = [(path, None, None, None, None, None, str(e))]
                for i in range(0, len(rows), 8):
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i : i + 8]], t) for k, t in enumerate(types)], names)

    return run


def planes_of(paths: DataFrame, column: str = "path", every: bool = False) -> DataFrame:
    """(path, page, h, w, dtype, px, error) of the files named in a column, read and decoded in tasks; the first page, or ``every``.

    px holds little-endian pixels; error says why there are none.
    """
    return paths.select(F.col(column).alias("path")).mapInArrow(_decoded(every), PLANE_ROW)


def read_tiffs(spark: SparkSession, root: str, pattern: str = "*.tif", recursive: bool = True, every: bool = False) -> DataFrame:
    """Planes of the files below ``root`` that match the glob, one task a few files."""
    found = files.list_files(spark, root, pattern, recursive).select("path")
    parts = max(1, min(found.count() // 4, int(spark.conf.get("spark.sql.shuffle.partitions")) * 4))
    return planes_of(found.repartition(parts), every=every)


def read_metadata(spark: SparkSession, root: str, pattern: str = "*.tif", recursive: bool = True) -> DataFrame:
    """(path, kind, axes, sizes, metadata): ``image_metadata`` of each file, the whole of it as JSON; nulls where a file can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    m = image_metadata(files.read_bytes(path))
                    rows.append((path, m["kind"], m["axes"], m["sizes"], json.dumps(m, sort_keys=True)))
                except (*BROKEN, OSError):
                    rows.append((path, None, None, None, None))
            types = (pa.string(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["path", "kind", "axes", "sizes", "metadata"])

    return files.list_files(spark, root, pattern, recursive).select("path").mapInArrow(run, "path string, kind string, axes string, sizes array<int>, metadata string")
