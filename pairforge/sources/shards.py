"""Contiguous uint16 token shards (S12, S13, J3): batch writer, streaming writer and range reader.

Rows ``split, start_pos, ids`` are range-partitioned by position and sorted inside
each partition, so every task writes one contiguous run of the stream (rows that come in runs
already are not dealt again: each run is a file), to
``{path}/{split}/shard-{first start_pos:020d}.bin`` (little-endian uint16); listing a
split's files by name gives the stream in order.  Writers take Arrow batches: a run of rows of
one split is one slice of the batch's ids, checked and written at once.  Files are written
under a folder of the job with task-attempt names and moved at job commit, so retried or lost
tasks leave nothing behind.  Overwrite removes older shards only at commit, after all new
files are complete; a failed job leaves the old output as it was.

A stream has no positions: rows ``split, ids`` get them when their epoch is committed, each
task's rows following those of the task before, from the next free position that the
last manifest (``_epochs/{epoch:010d}.json``) holds for the split.  An epoch counts once its manifest
stands: a replayed epoch that has one is dropped, and one without starts by removing what an
unfinished commit left beyond the last manifest.  So stop, restart and replay give the same bytes.

The reader splits shards into byte ranges and opens only those that overlap the wanted splits and
positions, which come as options or as pushed filters
(``spark.sql.python.filterPushdown.enabled``).  Without pushed filters Python hands over blocks of ids that
Spark's generated code explodes into rows; a row of its own for each id would cross from Arrow at twice the cost.

Paths are qualified on the driver by Spark's own file systems, so a bare path means
the cluster's default store, never an executor's disk; the resulting URI is opened
with pyarrow (``file``, ``hdfs``, ``s3``/``s3a``, ``gs``, ...), other schemes are an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

UINT16_MAX = 65535
RANGE_TOKENS = 8 << 20   # tokens a reading task gets, at least
MAX_RANGES = 100_000
BLOCK_TOKENS = 1 << 14   # ids in one row of a block reader, at most
READ_TOKENS = 1 << 18    # ids of one Arrow batch of a block reader, at most


@dataclass
class ShardCommit(WriterCommitMessage):
    files: list  # [(tmp_path, final_path, n_tokens)]


def qualified(spark, path: str) -> str:
    """``path`` with the scheme that Spark's default file system gives it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _fs(path: str):
    """(filesystem, path) of a qualified URI."""
    import re

    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:/*", "", path)
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        raise ValueError(f"{path}: shard paths need a scheme; see qualified()")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def _runs(batch, places: bool = False):
    """(split, first row, end row, ids of these rows) of each run of rows of one split in an Arrow batch.

    With ``places`` a run also ends where the next row's ``start_pos`` does not follow.
    """
    import numpy as np
    import pyarrow as pa

    splits = batch.column(batch.schema.get_field_index("split"))
    lists = batch.column(batch.schema.get_field_index("ids"))
    if isinstance(lists, pa.ListArray) and lists.null_count:
        raise ValueError("ids must not be null")
    offsets, values = np.asarray(lists.offsets), np.asarray(lists.values)
    codes = np.asarray(splits.dictionary_encode(null_encoding="encode").indices)
    new = codes[1:] != codes[:-1]
    if places and len(codes):
        at = np.asarray(batch.column(batch.schema.get_field_index("start_pos")), "int64")
        new |= at[1:] != at[:-1] + np.diff(offsets)[:-1]
    starts = np.flatnonzero(np.concatenate([[True], new])) if len(codes) else []
    for i, j in zip(starts, [*starts[1:], len(codes)]):
        ids = values[offsets[i]:offsets[j]]
        if ids.size and (ids.max() > UINT16_MAX or ids.min() < 0):
            raise ValueError(f"token id {int(ids.max())} does not fit uint16")
        yield splits[int(i)].as_py(), int(i), int(j), ids.astype("<u2")


def _attempt() -> str:
    from pyspark import TaskContext

    ctx = TaskContext.get()
    return f"{ctx.partitionId():07d}-{ctx.attemptNumber()}-{ctx.taskAttemptId()}"


class TokenShardWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        import uuid

        self.path = options["path"]
        self.overwrite = overwrite
        self.job = f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator):
        filesystem, root = _fs(self.path)
        tag = _attempt()
        files, out, cur_split, first, n = [], None, None, None, 0

        def close():
            if out is not None:
                out.close()
                files.append((tmp, f"{root}/{cur_split}/shard-{first:020d}.bin", n))

        for batch in iterator:
            at = batch.column(batch.schema.get_field_index("start_pos"))
            for split, i, _, ids in _runs(batch, places=True):
                if out is None or split != cur_split or at[i].as_py() != first + n:
                    close()
                    cur_split, first, n = split, at[i].as_py(), 0
                    filesystem.create_dir(f"{root}/{self.job}", recursive=True)
                    tmp = f"{root}/{self.job}/{split}-{first:020d}-{tag}.bin"
                    out = filesystem.open_output_stream(tmp)
                out.write(ids.tobytes())
                n += int(ids.size)
        close()
        return ShardCommit(files)

    def commit(self, messages):
        from concurrent.futures import ThreadPoolExecutor

        from pyarrow import fs

        filesystem, root = _fs(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        new = {final for _, final, _ in files}
        old = [f.path for f in filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
               if f.path.endswith(".bin") and f"/{self.job}/" not in f.path]
        if not self.overwrite and (both := sorted(new.intersection(old))):
            raise ValueError(f"append would replace {both[0]}; shift start_pos past the stream's end")
        for folder in {final.rsplit("/", 1)[0] for final in new}:
            filesystem.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: filesystem.move(f[0], f[1]), files))
            if self.overwrite:
                list(pool.map(filesystem.delete_file, [f for f in old if f not in new]))
        self.abort(messages)

    def abort(self, messages):
        from pyarrow import fs

        filesystem, root = _fs(self.path)
        if filesystem.get_file_info(f"{root}/{self.job}").type != fs.FileType.NotFound:
            filesystem.delete_dir(f"{root}/{self.job}")


class TokenStreamWriter(DataSourceStreamArrowWriter):
    """Exactly-once streaming form (S12, T1, T2): positions are dealt and files placed at epoch commit."""

    def __init__(self, options):
        import uuid

        self.path = options["path"]
        self.job = f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator):
        filesystem, root = _fs(self.path)
        tag, open_files = _attempt(), {}
        for batch in iterator:
            for split, _, _, ids in _runs(batch):
                if split not in open_files:
                    filesystem.create_dir(f"{root}/{self.job}", recursive=True)
                    tmp = f"{root}/{self.job}/{split}-{tag}.bin"
                    open_files[split] = [filesystem.open_output_stream(tmp), tmp, 0]
                open_files[split][0].write(ids.tobytes())
                open_files[split][2] += int(ids.size)
        for f in open_files.values():
            f[0].close()
        return ShardCommit([(tmp, split, n) for split, (_, tmp, n) in sorted(open_files.items())])

    def commit(self, messages, batchId):
        import json

        from pyarrow import fs

        filesystem, root = _fs(self.path)
        done = f"{root}/_epochs/{batchId:010d}.json"
        if filesystem.get_file_info(done).type == fs.FileType.NotFound:
            position = next_positions(self.path, batchId)
            for info in filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True)):
                split, _, name = info.path[len(root) + 1:].rpartition("/")  # left by a commit that did not finish
                if name.startswith("shard-") and int(name[6:-4]) >= position.get(split, 0):
                    filesystem.delete_file(info.path)
            # messages come in the order of tasks, and a task's file in the order of its rows
            for tmp, split, n in (f for m in messages if m is not None for f in m.files):
                if n:
                    filesystem.create_dir(f"{root}/{split}", recursive=True)
                    filesystem.move(tmp, f"{root}/{split}/shard-{position.get(split, 0):020d}.bin")
                    position[split] = position.get(split, 0) + n
            filesystem.create_dir(f"{root}/_epochs", recursive=True)
            tmp = f"{root}/{self.job}-{batchId}.json"
            with filesystem.open_output_stream(tmp) as f:
                f.write(json.dumps({"epoch": batchId, "next": position}).encode())
            filesystem.move(tmp, done)
        self._clean()

    def abort(self, messages, batchId):
        self._clean()

    def _clean(self):
        """Remove the files of all attempts; a path belongs to one stream, which has one epoch at a time."""
        from pyarrow import fs

        filesystem, root = _fs(self.path)
        for info in filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if "/_temporary-" in info.path and info.type == fs.FileType.Directory:
                filesystem.delete_dir(info.path)


def next_positions(uri: str, before: int | None = None) -> dict[str, int]:
    """Next write position of each split (W2) by the last manifest, or the last one before epoch ``before``."""
    import json

    from pyarrow import fs

    filesystem, root = _fs(uri)
    epochs = sorted(f.path for f in filesystem.get_file_info(fs.FileSelector(f"{root}/_epochs", allow_not_found=True)) if f.path.endswith(".json"))
    if before is not None:
        epochs = [p for p in epochs if int(p.rpartition("/")[2][:-5]) < before]
    if not epochs:
        return {}
    with filesystem.open_input_stream(epochs[-1]) as f:
        return json.loads(f.read())["next"]


class ShardRange(InputPartition):
    def __init__(self, file: str, split: str, first: int, begin: int, end: int):
        self.file, self.split, self.first, self.begin, self.end = file, split, first, begin, end


class TokenShardReader(DataSourceReader):
    """``split, pos, id`` of the wanted positions; a task reads one byte range of one shard."""

    def __init__(self, options):
        self.path = options["path"]
        self.split = options.get("split")
        self.begin = int(options.get("begin", 0))
        self.end = int(options["end"]) if "end" in options else None

    def partitions(self):
        import re

        from pyarrow import fs

        filesystem, root = _fs(self.path)
        wanted = []
        for info in filesystem.get_file_info(fs.FileSelector(root, recursive=True)):
            m = re.fullmatch(r"([^/]+)/shard-(\d+)\.bin", info.path[len(root):].lstrip("/"))
            if m and self.split in (None, m[1]):
                first, n = int(m[2]), info.size // 2
                begin, end = max(self.begin, first), first + n if self.end is None else min(self.end, first + n)
                if begin < end:
                    wanted.append((info.path, m[1], first, begin, end))
        total = sum(w[4] - w[3] for w in wanted)
        step = max(RANGE_TOKENS, -(-total // MAX_RANGES))
        return [ShardRange(file, split, first, a, min(a + step, end)) for file, split, first, begin, end in sorted(wanted)
                for a in range(begin, end, step)]

    def read(self, partition):
        import numpy as np
        import pyarrow as pa

        filesystem, _ = _fs(self.path)
        with filesystem.open_input_file(partition.file) as f:
            for a in range(partition.begin, partition.end, 1 << 16):
                n = min(1 << 16, partition.end - a)
                ids = np.frombuffer(f.read_at(2 * n, 2 * (a - partition.first)), "<u2").astype("int32")
                yield pa.RecordBatch.from_arrays([pa.array([partition.split]).take(np.zeros(n, "int32")), pa.array(np.arange(a, a + n)), pa.array(ids)],
                                                 names=["split", "pos", "id"])


class FilteredShardReader(TokenShardReader):
    """The reader where the session lets Spark push filters to Python sources."""

    def pushFilters(self, filters):
        for f in filters:
            name, value = getattr(f, "attribute", ()), getattr(f, "value", None)
            if name == ("split",) and isinstance(f, EqualTo) and self.split in (None, value):
                self.split = value
            elif name == ("pos",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.begin = max(self.begin, value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    end = value if isinstance(f, LessThan) else value + 1
                    self.end = end if self.end is None else min(self.end, end)
            else:
                yield f


class TokenBlockReader(TokenShardReader):
    """``split, begin, ids``: the wanted ids in blocks, each with the position of its first id."""

    def read(self, partition):
        import numpy as np
        import pyarrow as pa

        filesystem, _ = _fs(self.path)
        with filesystem.open_input_file(partition.file) as f:
            for a in range(partition.begin, partition.end, READ_TOKENS):
                n = min(READ_TOKENS, partition.end - a)
                ids = np.frombuffer(f.read_at(2 * n, 2 * (a - partition.first)), "<u2").astype("int32")
                starts = np.arange(0, n, BLOCK_TOKENS)
                blocks = pa.ListArray.from_arrays(pa.array(np.append(starts, n).astype("int32")), pa.array(ids))
                yield pa.RecordBatch.from_arrays([pa.array([partition.split] * len(starts), pa.string()), pa.array(a + starts), blocks],
                                                 names=["split", "begin", "ids"])


class TokenBlockSource(DataSource):
    @classmethod
    def name(cls):
        return "token_shard_blocks"

    def schema(self):
        return "split STRING, begin BIGINT, ids ARRAY<INT>"

    def reader(self, schema):
        return TokenBlockReader(self.options)


class TokenShardSource(DataSource):
    @classmethod
    def name(cls):
        return "token_shards"

    def schema(self):
        return "split STRING, pos BIGINT, id INT"

    def reader(self, schema):
        return (FilteredShardReader if self.options.get("filters") == "true" else TokenShardReader)(self.options)

    def writer(self, schema, overwrite):
        return TokenShardWriter(self.options, overwrite)

    def streamWriter(self, schema, overwrite):
        return TokenStreamWriter(self.options)


def register(spark) -> None:
    spark.dataSource.register(TokenShardSource)
    spark.dataSource.register(TokenBlockSource)


def check_uint16(tokens: DataFrame, ids_col: str = "ids") -> None:
    """Fail before writing when an id cannot be stored as uint16."""
    mx = tokens.agg(F.max(F.array_max(ids_col)).alias("m")).first()["m"]
    if mx is not None and mx > UINT16_MAX:
        raise ValueError(f"max token id {mx} exceeds {UINT16_MAX}; use a wider dtype")


def write_token_shards(tokens: DataFrame, path: str, order=None, shards: int | None = None,
                       mode: str = "overwrite", tokens_per_shard: int = 64 << 20, in_runs: bool = False) -> None:
    """Write ``split, start_pos, ids`` rows as ordered uint16 shards.

    ``start_pos`` orders the rows (``order`` is accepted for rows without gaps but
    not needed).  By default the number of shards follows the number of tokens.
    Ids that do not fit are found by the task that would write them.

    ``in_runs``: the rows come in long runs of the stream, as ``token_offsets`` leaves them; every run
    becomes a shard where it is, without a count, a sort and a shuffle of the ids.
    """
    spark = tokens.sparkSession
    register(spark)
    rows = tokens.where(F.size("ids") > 0).select("split", "start_pos", "ids")
    if in_runs:
        rows.write.format("token_shards").mode(mode).option("path", qualified(spark, path)).save()
        return
    if shards is None:
        n = rows.agg(F.sum(F.size("ids"))).first()[0] or 0
        shards = max(spark.sparkContext.defaultParallelism, -(-int(n) // tokens_per_shard))
    (rows.repartitionByRange(shards, "split", "start_pos").sortWithinPartitions("split", "start_pos")
     .write.format("token_shards").mode(mode).option("path", qualified(spark, path)).save())


def read_token_shards(spark, path: str, split: str | None = None, begin: int | None = None, end: int | None = None) -> DataFrame:
    """``split, pos, id`` of written shards; of one split and positions ``begin <= pos < end`` only those bytes are read."""
    register(spark)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    r = spark.read.format("token_shards" if pushed == "true" else "token_shard_blocks").option("path", qualified(spark, path)).option("filters", pushed)
    for name, value in (("split", split), ("begin", begin), ("end", end)):
        if value is not None:
            r = r.option(name, str(value))
    if pushed == "true":
        return r.load()
    return r.load().select("split", "begin", F.posexplode("ids").alias("i", "id")).select("split", (F.col("begin") + F.col("i")).alias("pos"), "id")


def start_token_stream(tokens: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Stream rows ``split, ids`` into shards, exactly once; returns the StreamingQuery."""
    spark = tokens.sparkSession
    register(spark)
    w = (tokens.where(F.size("ids") > 0).select("split", "ids").writeStream.format("token_shards").outputMode("append")
         .option("path", qualified(spark, path)).option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def shard_listing(spark, path: str) -> DataFrame:
    """``split, file, start_pos, n_tokens`` of written shards (from file sizes)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    name = F.regexp_extract("path", r"/([^/]+)/shard-(\d+)\.bin$", 2)
    return df.select(F.regexp_extract("path", r"/([^/]+)/shard-\d+\.bin$", 1).alias("split"),
                     F.col("path").alias("file"), name.cast("bigint").alias("start_pos"),
                     (F.col("length") / 2).cast("bigint").alias("n_tokens"))
