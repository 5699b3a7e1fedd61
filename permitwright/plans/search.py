"""Free text search that leaves out files which cannot hold the needle."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from permitwright.functions.text import PAGE_SPACE
from permitwright.plans.browse import Filters, filtered
from permitwright.session import fresh_dir
from permitwright.sources import store
from permitwright.sources.tables import RecordTable

# Bits of a file's filter. A file with more than about a fifth as many different trigrams no longer leaves out much.
BITS = 1 << 16
_GRAM = 3
# Parts of an index are named after how their bits are made; parts of another name are not read.
_PART = "mixed"


# What comes before a file's place in the table.
_DATA = "/data/write="


def _below(file: str) -> str:
    return unquote(file).rsplit(_DATA, 1)[1]


def _joined(columns: list[str]) -> Column:
    return F.lower(F.concat_ws("\0", *columns))


def _grams(points: np.ndarray) -> np.ndarray:
    """The bit of every run of three characters, from code points one after the other."""
    p = points.astype(np.uint64)
    mixed = ((p[:-2] << np.uint64(42)) ^ (p[1:-1] << np.uint64(21)) ^ p[2:]) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, text) rows to (file, bits): one bitmap per run of rows of a file, with a break between texts that no needle spans."""
    for batch in batches:
        files, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        starts = [i for i in range(len(files)) if not i or files[i] != files[i - 1]]
        bits = []
        for start, end in zip(starts, [*starts[1:], len(files)], strict=True):
            found = np.zeros(BITS, bool)
            points = _points("\0\0".join(texts[start:end]))
            if len(points) >= _GRAM:
                found[_grams(points)] = True
            bits.append(np.packbits(found, bitorder="little").view("<i8"))
        shape = pa.schema([("file", pa.string()), ("bits", pa.list_(pa.int64()))])
        yield pa.RecordBatch.from_arrays([pa.array([files[i] for i in starts], pa.string()), pa.array(bits, shape.field(1).type)], schema=shape)


class SearchIndex:
    """One bitmap of trigrams per file of a record table.

    Files never change, so a file's bitmap stays right: `refresh` reads only files it does not know. A file is read for a needle
    if its bitmap has all of the needle's trigrams; the test on its rows is the exact one. Needles of fewer than three characters,
    or with a zero character, are looked for in every file.
    """

    schema = "file string, bits array<bigint>"

    def __init__(self, table: RecordTable, root: str):
        self.table = table
        self.spark: SparkSession = table.spark
        self.root = root.rstrip("/")

    def _known(self) -> DataFrame:
        parts = [f"{self.root}/{name}" for name in store.names(self.spark, self.root) if name.startswith(f"{_PART}-")]
        parts = [part for part in parts if store.is_complete(self.spark, part)]
        return self.spark.read.schema(self.schema).parquet(*parts) if parts else self.spark.createDataFrame([], self.schema)

    def _current(self) -> list[str]:
        """The files of the current version, by their places below the table's `data`."""
        return sorted(_below(file) for file in self.table.read().inputFiles())

    def refresh(self) -> int:
        """Add the files that are new; returns their number."""
        known = {row["file"] for row in self._known().select("file").collect()}  # names, as the driver lists them anyway
        fresh = [file for file in self._current() if file not in known]
        if fresh:
            rows = self._rows(fresh)
            place = F.url_decode(F.replace(F.substring_index("_metadata.file_path", _DATA, -1), F.lit("+"), F.lit("%2B")))
            # Texts go to numpy tasks, bitmaps come back: what is joined after that is a bitmap per file and batch of rows.
            bits = rows.select(place.alias("file"), _joined(self._columns()).alias("text")).mapInArrow(_bitmaps, self.schema)
            longs = bits.select("file", F.posexplode("bits").alias("at", "long")).groupBy("file", "at").agg(F.bit_or("long").alias("long"))
            found = longs.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("at", "long"))).alias("m"))
            dense = found.select("file", F.transform("m", lambda m: m["long"]).alias("bits"))
            dense.write.parquet(f"{self.root}/{fresh_dir(self.spark, _PART).rsplit('/', 1)[1]}")
        return len(fresh)

    def _columns(self) -> list[str]:
        return self.table.schema.fieldNames()

    def _rows(self, files: list[str]) -> DataFrame:
        read = self.spark.read.schema(self.table.schema).option("basePath", f"{self.table.root}/data")
        return read.parquet(*[f"{self.table.root}{_DATA}{file}" for file in files])

    def files(self, text: str) -> list[str]:
        """The current files that may hold a text, and those the index does not know."""
        needle = text.strip(PAGE_SPACE).lower()
        current = self._current()
        if len(needle) < _GRAM or "\0" in needle:
            return current
        wanted = sorted({int(bit) for bit in _grams(_points(needle))})
        lacking = F.lit(False)
        for bit in wanted:
            has = F.call_function("shiftright", F.get("bits", F.lit(bit >> 6)), F.lit(bit & 63)).bitwiseAND(F.lit(1).cast("bigint"))
            lacking = lacking | (has == 0)
        known = self._known()
        out = {row["file"] for row in known.filter(lacking).select("file").collect()}
        return [file for file in current if file not in out]

    def search(self, text: str, filters: Filters | None = None) -> DataFrame:
        """The records in which any column holds the text, as `browse.filtered` finds them; other filters apply as well."""
        files = self.files(text)
        if not files:
            return self.spark.createDataFrame([], self.table.schema)
        wanted = Filters(**(vars(filters or Filters()) | {"text": text}))
        return filtered(self.table.normal(self._rows(files)), wanted)
