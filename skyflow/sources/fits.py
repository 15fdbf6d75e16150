"""FITS files as DataFrames: headers, pixel strips and binary tables.

Three Python data sources. Files are opened through Arrow file systems, so any
path the executors can reach works, and only the byte ranges a task needs are
read: header blocks for ``read_exposures``, one extension for ``read_pixels``, a
range of rows for ``read_bintable``.
"""

from __future__ import annotations

import fnmatch
import math
import posixpath
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK, CARD = 2880, 80
FILES_PER_TASK = 64
TABLE_BYTES_PER_TASK = 64 << 20
PIXEL_BYTES_PER_TASK = 128 << 20
STRIPS_PER_BATCH = 256

# column -> (header card, type); missing cards are null
EXPOSURE_CARDS = {
    "ra": ("RA", "string"),
    "dec": ("DEC", "string"),
    "filter": ("FILTER", "string"),
    "object": ("OBJECT", "string"),
    "exptime": ("EXPTIME", "double"),
    "date_obs": ("DATE-OBS", "string"),
    "observat": ("OBSERVAT", "string"),
    "secz": ("SECZ", "double"),
    **{f"sky{c}": (f"SKY{c.upper()}", "double") for c in ("kk", "mm", "tt", "nn")},
    **{f"fwhm1{c}": (f"FWHM1{c.upper()}", "double") for c in ("kk", "mm", "tt", "nn")},
}
EXPOSURE_SCHEMA = "path string, name string, " + ", ".join(f"{c} {t}" for c, (_, t) in EXPOSURE_CARDS.items())
STRIP_SCHEMA = "path string, name string, ext int, y int, values array<float>"


def split_uri(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def list_files(pattern: str) -> list[tuple[str, int]]:
    """(path, size) of the files matching a glob in the last path component."""
    fs, path = split_uri(pattern)
    folder, name = posixpath.split(path)
    infos = fs.get_file_info(pafs.FileSelector(folder or ".", recursive=False))
    prefix = pattern[: len(pattern) - len(path)]
    return sorted(
        (prefix + i.path, i.size) for i in infos
        if i.type == pafs.FileType.File and fnmatch.fnmatch(posixpath.basename(i.path), name)
    )


_VALUE = re.compile(r"^\s*(?:'((?:[^']|'')*)'|([^/]*))")


def card_value(text: str):
    m = _VALUE.match(text)
    if m.group(1) is not None:
        return m.group(1).replace("''", "'").rstrip()
    raw = m.group(2).strip()
    if raw in ("T", "F"):
        return raw == "T"
    try:
        return int(raw)
    except ValueError:
        pass
    try:
        return float(raw.replace("D", "E"))
    except ValueError:
        return raw or None


def read_header(handle) -> dict:
    """Cards of the header unit at the handle's position; empty at the end of the file."""
    cards: dict = {}
    while True:
        block = handle.read(BLOCK)
        if len(block) < BLOCK:
            return {}
        for i in range(0, BLOCK, CARD):
            card = bytes(block[i : i + CARD]).decode("ascii", "replace")
            key = card[:8].rstrip()
            if key == "END":
                return cards
            if card[8:10] == "= ":
                cards.setdefault(key, card_value(card[10:]))


def data_bytes(cards: dict) -> int:
    axes = int(cards.get("NAXIS") or 0)
    if axes == 0:
        return 0
    count = math.prod(int(cards[f"NAXIS{i + 1}"]) for i in range(axes))
    size = abs(int(cards["BITPIX"])) // 8 * int(cards.get("GCOUNT") or 1) * (int(cards.get("PCOUNT") or 0) + count)
    return -(-size // BLOCK) * BLOCK


def seek_extension(handle, ext: int) -> dict:
    """Header of extension ``ext`` (0 = primary), the handle at its data."""
    for i in range(ext + 1):
        cards = read_header(handle)
        if not cards or i == ext:
            return cards
        handle.seek(handle.tell() + data_bytes(cards))
    return {}


class Part(InputPartition):
    def __init__(self, *args):
        self.args = args


def _typed(value, kind: str):
    if value is None or isinstance(value, bool):
        return None
    if kind == "string":
        return str(value)
    try:
        number = float(value)
    except (TypeError, ValueError):
        return None
    return None if math.isnan(number) else number


class HeaderSource(DataSource):
    """Primary headers of many files, one row per file."""

    @classmethod
    def name(cls):
        return "skyflow_exposures"

    def schema(self):
        return EXPOSURE_SCHEMA

    def reader(self, schema):
        return HeaderReader(self.options["path"])


class HeaderReader(DataSourceReader):
    def __init__(self, pattern):
        self.pattern = pattern

    def partitions(self):
        files = [p for p, _ in list_files(self.pattern)]
        return [Part(files[i : i + FILES_PER_TASK]) for i in range(0, len(files), FILES_PER_TASK)] or [Part([])]

    def read(self, part):
        for path in part.args[0]:
            fs, local = split_uri(path)
            with fs.open_input_file(local) as handle:
                cards = read_header(handle)
            row = [_typed(cards.get(card), kind) for card, kind in EXPOSURE_CARDS.values()]
            yield (path, posixpath.basename(local), *row)


class PixelSource(DataSource):
    """Image extensions as strips of one detector row; a task per file and about ``PIXEL_BYTES_PER_TASK`` of it."""

    @classmethod
    def name(cls):
        return "skyflow_pixels"

    def schema(self):
        return STRIP_SCHEMA

    def reader(self, schema):
        exts = self.options.get("ext", "")
        return PixelReader(self.options["path"], [int(e) for e in exts.split(",") if e.strip()])


class PixelReader(DataSourceReader):
    def __init__(self, pattern, exts):
        self.pattern, self.exts = pattern, exts

    def partitions(self):
        parts = []
        for path, size in list_files(self.pattern):
            slices = max(1, math.ceil(size / PIXEL_BYTES_PER_TASK))
            parts += [Part(path, size * i // slices, size * (i + 1) // slices) for i in range(slices)]
        return parts or [Part(None, 0, 0)]

    def read(self, part):
        """The extensions whose data start in the task's range of bytes; headers are read along the chain."""
        path, low, high = part.args
        if path is None:
            return
        fs, local = split_uri(path)
        with fs.open_input_file(local) as handle:
            ext = 0
            while handle.tell() < high and (cards := read_header(handle)):
                start = handle.tell()
                if low <= start < high and ext and (not self.exts or ext in self.exts):
                    yield from self.strips(handle, cards, path, posixpath.basename(local), ext)
                handle.seek(start + data_bytes(cards))
                ext += 1

    def strips(self, handle, cards, path, name, ext):
        if cards.get("XTENSION", "IMAGE").strip() != "IMAGE" or int(cards.get("NAXIS") or 0) < 2:
            return
        width, height = int(cards["NAXIS1"]), int(cards["NAXIS2"])
        bits = int(cards["BITPIX"])
        dtype = np.dtype({8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}[bits])
        scale, zero = float(cards.get("BSCALE") or 1), float(cards.get("BZERO") or 0)
        for y in range(0, height, STRIPS_PER_BATCH):
            rows = min(STRIPS_PER_BATCH, height - y)
            raw = np.frombuffer(handle.read(rows * width * dtype.itemsize), dtype=dtype)
            flat = (raw.astype(np.float64) * scale + zero).astype(np.float32)
            values = pa.ListArray.from_arrays(
                pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(flat, mask=np.isnan(flat))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path] * rows), pa.array([name] * rows), pa.array(np.full(rows, ext, np.int32)),
                    pa.array(np.arange(y, y + rows, dtype=np.int32)), values,
                ],
                names=["path", "name", "ext", "y", "values"],
            )


# TFORM letter -> (numpy big-endian type, Spark type)
TFORMS = {
    "L": ("S1", T.BooleanType()), "B": ("u1", T.ShortType()), "I": (">i2", T.ShortType()), "J": (">i4", T.IntegerType()),
    "K": (">i8", T.LongType()), "E": (">f4", T.FloatType()), "D": (">f8", T.DoubleType()),
}


class Column(NamedTuple):
    """A column of a binary table: stored values times ``scale`` plus ``zero``; stored ``null`` is no value."""

    name: str
    letter: str
    repeat: int
    scale: float
    zero: float
    null: int | None

    @property
    def scaled(self) -> bool:
        return self.letter not in "AL" and (self.scale, self.zero) != (1, 0)

    def spark_type(self) -> T.DataType:
        if self.letter == "A":
            return T.StringType()
        kind = T.DoubleType() if self.scaled else TFORMS[self.letter][1]
        return T.ArrayType(kind) if self.repeat > 1 else kind


def table_columns(cards: dict) -> list[Column]:
    out = []
    for i in range(1, int(cards.get("TFIELDS") or 0) + 1):
        repeat, letter = re.match(r"\s*(\d*)([A-Z])", cards[f"TFORM{i}"]).groups()
        scale, zero = cards.get(f"TSCAL{i}"), cards.get(f"TZERO{i}")
        out.append(Column(
            _clean(cards.get(f"TTYPE{i}") or f"col{i}"), letter, int(repeat) if repeat else 1,
            1 if scale is None else scale, 0 if zero is None else zero, cards.get(f"TNULL{i}"),
        ))
    return out


def _clean(name: str) -> str:
    return re.sub(r"\W+", "_", name.strip()).strip("_").lower()


class TableSource(DataSource):
    """Binary-table extension of many files: the columns of the first one, found by name in the others."""

    @classmethod
    def name(cls):
        return "skyflow_bintable"

    def _columns(self):
        files = list_files(self.options["path"])
        if not files:
            raise FileNotFoundError(self.options["path"])
        fs, local = split_uri(files[0][0])
        with fs.open_input_file(local) as handle:
            return table_columns(seek_extension(handle, int(self.options.get("ext", 1))))

    def schema(self):
        return T.StructType([T.StructField("path", T.StringType()), *(T.StructField(c.name, c.spark_type()) for c in self._columns())])

    def reader(self, schema):
        return TableReader(self.options["path"], int(self.options.get("ext", 1)), schema)


class TableReader(DataSourceReader):
    def __init__(self, pattern, ext, schema):
        self.pattern, self.ext, self.schema = pattern, ext, schema

    def partitions(self):
        parts = []
        for path, size in list_files(self.pattern):
            slices = max(1, math.ceil(size / TABLE_BYTES_PER_TASK))
            parts += [Part(path, i, slices) for i in range(slices)]
        return parts

    def read(self, part):
        from pyspark.sql.pandas.types import to_arrow_schema

        path, index, slices = part.args
        wanted = list(to_arrow_schema(self.schema))[1:]
        fs, local = split_uri(path)
        with fs.open_input_file(local) as handle:
            cards = seek_extension(handle, self.ext)
            columns = table_columns(cards)
            layout = np.dtype(
                [(f"f{i}", f"S{c.repeat}") if c.letter == "A" else (f"f{i}", TFORMS[c.letter][0], (c.repeat,) if c.repeat > 1 else ()) for i, c in enumerate(columns)]
            )
            place = {c.name: i for i, c in reversed(list(enumerate(columns)))}
            width, rows = int(cards["NAXIS1"]), int(cards["NAXIS2"])
            first, last = rows * index // slices, rows * (index + 1) // slices
            handle.seek(handle.tell() + first * width)
            while first < last:
                count = min(last - first, 65536)
                block = np.frombuffer(handle.read(count * width), dtype=layout)
                arrays = [pa.array([path] * count)]
                for field in wanted:
                    i = place.get(field.name)
                    found = pa.nulls(count, field.type) if i is None else _arrow(block[f"f{i}"], columns[i])
                    arrays.append(found.cast(field.type, safe=False))
                yield pa.RecordBatch.from_arrays(arrays, names=self.schema.names)
                first += count


def _arrow(values: np.ndarray, column: Column) -> pa.Array:
    if column.letter == "A":
        return pa.array([v.decode("ascii", "replace").rstrip() for v in values])
    if column.letter == "L":
        native = values == b"T"
    elif column.letter == "B":
        native = values.astype(np.int16)
    else:
        native = values.astype(values.dtype.newbyteorder("="))
    flat = native.reshape(-1)
    none = np.isnan(flat) if flat.dtype.kind == "f" else np.zeros(len(flat), bool)
    if column.null is not None and flat.dtype.kind == "i":
        none |= flat == column.null
    if column.scaled:
        flat = flat.astype(float) * column.scale + column.zero
    flat = pa.array(flat, mask=none)
    if column.repeat == 1:
        return flat
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * column.repeat), flat)


def register(spark: SparkSession) -> None:
    for source in (HeaderSource, PixelSource, TableSource):
        spark.dataSource.register(source)


def read_exposures(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per file; NaN and missing cards are null."""
    register(spark)
    return spark.read.format("skyflow_exposures").load(pattern)


def read_pixels(spark: SparkSession, pattern: str, ext: list[int] | None = None) -> DataFrame:
    """Strip rows ``path, name, ext, y, values`` of the given extensions (default: all images of the file)."""
    register(spark)
    reader = spark.read.format("skyflow_pixels")
    if ext:
        reader = reader.option("ext", ",".join(map(str, ext)))
    return reader.load(pattern)


def read_bintable(spark: SparkSession, pattern: str, ext: int = 1) -> DataFrame:
    """Binary-table rows, with ``path``; LDAC objects are in extension 2."""
    register(spark)
    return spark.read.format("skyflow_bintable").option("ext", ext).load(pattern)


def with_defaults(exposures: DataFrame) -> DataFrame:
    """Missing text as '' and missing numbers as 0, as the astrometry stage expects them."""
    return exposures.na.fill("").na.fill(0).withColumn("serial", F.substring("name", 15, 6))
