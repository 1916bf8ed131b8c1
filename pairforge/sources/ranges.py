"""Byte-range scan of raw text whose records may be larger than a task should hold.

A delimiter-aligned scan gives a file without the delimiter to one task.  Here a file is cut into
byte ranges at positions that no pre-token and no delimiter crosses, so pieces of a record
have together exactly the pre-tokens of the whole record.

A cut lies between a well-formed character that is not white space and an ASCII white-space byte.
There a pre-token always ends (only white space holds white space beyond a leading blank), and it
ends alike whatever follows: a run of white space looks ahead, and none touches the cut from the left.
The pattern never looks back, so the right side starts afresh.  Bytes that are invalid UTF-8 are
dropped later and cannot lie at a cut.  A position inside an occurrence of the delimiter is no cut.

Each task finds its own first and last cut by reading on from its range's bounds, so no task
needs another's result and a retried task gives the same rows.  A stretch without white space
stays whole however long it is.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pairforge.functions.patterns import DEFAULT_SPECIAL_TOKEN
from pairforge.sources.corpus import UTF8_SEQUENCE, decode_utf8_ignore
from pairforge.sources.shards import _fs, qualified

MAX_RANGES = 200_000  # ranges grow beyond this number, so the driver's list stays bounded
WINDOW = 1 << 16


def first_cut(read_at, size: int, at: int, delimiter: bytes) -> int:
    """The first cut at or after byte ``at`` of a file of ``size`` bytes; its ends are cuts."""
    if at <= 0 or at >= size:
        return max(0, min(at, size))
    ends = re.compile(f"({UTF8_SEQUENCE})(?=[\\t-\\r ])".encode("ascii"))
    around = max(4, len(delimiter))  # bytes that must be seen on both sides of a cut
    while at < size:
        lo = max(0, at - around)
        data = read_at(min(WINDOW, size - at) + 2 * around, lo)
        seen = lo + len(data)
        for m in ends.finditer(data):
            cut = lo + m.end()
            if cut < at:
                continue
            if cut + around > seen and seen < size:
                break
            i = m.end()
            crossed = len(delimiter) > 1 and delimiter in data[max(0, i - len(delimiter) + 1):i + len(delimiter) - 1]
            if not crossed and not m[1].decode("utf-8").isspace():
                return cut
        at = size if seen >= size else seen - around
    return size


class TextRange(InputPartition):
    def __init__(self, file: str, size: int, begin: int, end: int):
        self.file, self.size, self.begin, self.end = file, size, begin, end


class TextRangeReader(DataSourceReader):
    """``path, pos, starts, value``: pieces of records by byte position; ``starts`` marks a record's first piece."""

    def __init__(self, options):
        self.path = options["path"]
        self.delimiter = options.get("delimiter", "").encode("utf-8")
        self.range_bytes, self.piece_bytes = int(options["rangeBytes"]), int(options["pieceBytes"])

    def partitions(self):
        from pyarrow import fs

        filesystem, root = _fs(self.path)
        info = filesystem.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else filesystem.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.size
                       and not any(p[:1] in "._" for p in f.path[len(root):].strip("/").split("/") if p))
        step = max(self.range_bytes, -(-sum(n for _, n in files) // MAX_RANGES))
        return [TextRange(path, size, a, min(a + step, size)) for path, size in files for a in range(0, size, step)]

    def read(self, partition):
        import pyarrow as pa

        filesystem, _ = _fs(self.path)
        with filesystem.open_input_file(partition.file) as f:
            def cut(at):
                return first_cut(f.read_at, partition.size, at, self.delimiter)

            at, last = cut(partition.begin), cut(partition.end)
            while at < last:
                end = min(last, cut(at + self.piece_bytes))
                data = f.read_at(end - at, at)
                rows, pos = [], at
                for i, part in enumerate(data.split(self.delimiter) if self.delimiter else [data]):
                    rows.append((pos, i > 0 or at == 0, part))
                    pos += len(part) + len(self.delimiter)
                if end == partition.size and rows[-1][1:] == (True, b""):
                    rows.pop()  # the last delimiter ends the last record
                if rows:
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([partition.file] * len(rows)), pa.array(columns[0], pa.int64()),
                         pa.array(columns[1]), pa.array(columns[2], pa.binary())], names=["path", "pos", "starts", "value"])
                at = end


class TextRangeSource(DataSource):
    @classmethod
    def name(cls):
        return "text_ranges"

    def schema(self):
        return "path STRING, pos BIGINT, starts BOOLEAN, value BINARY"

    def reader(self, schema):
        return TextRangeReader(self.options)


def read_text_ranges(spark: SparkSession, path: str, delimiter: str = DEFAULT_SPECIAL_TOKEN,
                     range_bytes: int = 32 << 20, piece_bytes: int = 1 << 20) -> DataFrame:
    """Pieces of the records of a raw text file or folder: ``path, pos, starts, text``.

    Word counts and token totals over the pieces equal those over whole records.  A piece
    holds about ``piece_bytes``, a task about ``range_bytes``.  ``pos`` is the piece's first byte,
    ``starts`` is true for the first piece of a record; an empty delimiter splits nothing.
    """
    if range_bytes < 1 or piece_bytes < 1:
        raise ValueError("range_bytes and piece_bytes must be positive")
    full = qualified(spark, path)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(full)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(path)  # S6
    spark.dataSource.register(TextRangeSource)
    df = (spark.read.format("text_ranges").option("path", full).option("delimiter", delimiter)
          .option("rangeBytes", str(range_bytes)).option("pieceBytes", str(piece_bytes)).load())
    return df.select("path", "pos", "starts", decode_utf8_ignore("value").alias("text"))
