"""A pair of tables rewritten so that rows of one key lie in files of one bucket, one sorted Parquet file a bucket.

The rows of a file are brought together and put in order by one shuffle: an RDD is
dealt out by a partitioner of our own and sorted on the way in
(``repartitionAndSortWithinPartitions``).  Its key is composite: the number of the
file and then the whole row, written as bytes that compare as the row does.  A
partition's rows therefore arrive as a sorted stream, file after file, and are
decoded some thousands at a time into one Parquet writer a file; the sort spills, so
a file may be larger than a task's memory.

``rewrite_pair`` first writes both tables as numbered starting files, then reads
those and rewrites them by bucket.  A child's bucket depends on whether its key is a
parent's; that is a sort-merge join of the children with the counted keys, which
adaptive execution splits where a key is hot.  Starting files that hold exactly one
final file's rows stay.  What comes to the driver is a path a file and a number a
bucket, which the number of buckets bounds.

An attempt at a task writes files with names of its own and hands those back; only
names of the attempt that Spark committed are used, and others are deleted at the
end, so lost executors cost a task and never a file.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.checkpoints import shared_dir
from .storage import Scratch

#: Rows that are decoded and written at a time, and rows that are sorted in a task, about.
CHUNK, TASK_ROWS = 1 << 15, 1 << 18
_FILE = "number int, path string, n_rows long, ids_sha256 string"
_INTS = {"tinyint": ("i1", pa.int8()), "smallint": ("i2", pa.int16()), "int": ("i4", pa.int32()), "bigint": ("i8", pa.int64())}
_INTS |= {"date": ("i4", pa.date32()), "timestamp": ("i8", pa.timestamp("us", "UTC")), "timestamp_ntz": ("i8", pa.timestamp("us"))}
_FLOATS = {"float": ("f4", pa.float32()), "double": ("f8", pa.float64())}
_OTHER = {"boolean": ("u1", pa.bool_()), "string": ("", pa.string())}
_KINDS = _INTS | _FLOATS | _OTHER


class RowCodec:
    """Rows as bytes that sort as the rows do, column by column, null first; and back.

    Numbers are big-endian with the sign turned over, strings UTF-8 raised by one and
    ended by a zero byte (no byte of UTF-8 is 0xFF).  After the columns, where it
    decides nothing but between 0.0 and -0.0, stands what decoding needs: which zeros
    are negative and how long strings are.
    """

    def __init__(self, kinds: list[str]):
        for k in kinds:
            if k not in _KINDS:
                raise TypeError(f"columns of type {k} cannot be sorted here")
        self.kinds = kinds
        self.tail = sum(4 if k == "string" else k in _FLOATS for k in kinds)

    def _fixed(self, col: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray | None]:
        """Big-endian sortable bytes of a column without nulls, and which values are -0.0."""
        code = _KINDS[kind][0]
        if kind == "boolean":
            return col.cast(pa.uint8()).to_numpy(zero_copy_only=False)[:, None], None
        width = int(code[1])
        top = np.array(1 << (8 * width - 1), f"u{width}")
        if kind in _INTS:
            x = col.cast(pa.int32() if kind == "date" else pa.int64() if code == "i8" else col.type)
            u, minus = x.to_numpy(zero_copy_only=False).astype(code).view(f"u{width}") ^ top, None
        else:
            x = col.to_numpy(zero_copy_only=False).astype(code)
            minus = (x == 0) & np.signbit(x)
            x = np.where(np.isnan(x), np.array(np.nan, code), np.where(minus, np.array(0, code), x))
            u = x.view(f"u{width}")
            u = np.where(u & top, ~u, u | top)
        return np.ascontiguousarray(u.astype(f">u{width}")).view(np.uint8).reshape(len(col), width), minus

    def encode(self, cols: list[pa.Array], head: np.ndarray) -> list[bytes]:
        """One value a row: four bytes of ``head``, then the row."""
        n, parts, size = len(head), [], np.full(len(head), 4 + self.tail, np.int64)
        for col, kind in zip(cols, self.kinds):
            valid = col.is_valid().to_numpy(zero_copy_only=False)
            if kind == "string":
                col = col.cast(pa.large_string()).fill_null("")
                _, off, data = col.buffers()
                off = np.frombuffer(off, np.int64)[col.offset : col.offset + n + 1]
                data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
                parts.append((valid, data, np.diff(off)))
                size += 2 + parts[-1][2]
            else:
                fixed, minus = self._fixed(col.fill_null(pa.scalar(0).cast(pa.int64()).cast(col.type) if kind in ("timestamp", "timestamp_ntz") else pa.scalar(0, pa.int32()).cast(col.type)), kind)
                parts.append((valid, fixed * valid[:, None], minus))
                size += 1 + fixed.shape[1]
        off = np.concatenate(([0], np.cumsum(size)))
        out, at = np.zeros(off[-1], np.uint8), off[:-1].copy()
        out[at[:, None] + np.arange(4)] = head.astype(">u4").view(np.uint8).reshape(n, 4)
        at += 4
        tail = off[1:] - self.tail
        for (valid, data, more), kind in zip(parts, self.kinds):
            out[at] = valid
            if kind == "string":
                first = np.concatenate(([0], np.cumsum(more)[:-1])) if n else more
                out[np.repeat(at + 1 - first, more) + np.arange(len(data))] = data + 1
                at += 2 + more
                out[tail[:, None] + np.arange(4)] = more.astype("<u4").view(np.uint8).reshape(n, 4)
                tail += 4
            else:
                width = data.shape[1]
                out[at[:, None] + np.arange(1, width + 1)] = data
                at += 1 + width
                if kind in _FLOATS:
                    out[tail] = more & valid
                    tail += 1
        whole, cut = out.tobytes(), off.tolist()
        return [whole[i:j] for i, j in zip(cut, cut[1:])]

    def decode(self, rows: list[bytes]) -> list[pa.Array]:
        n, buf = len(rows), np.frombuffer(b"".join(rows), np.uint8)
        off = np.concatenate(([0], np.cumsum(np.fromiter(map(len, rows), np.int64, n))))
        at, tail, out = off[:-1] + 4, off[1:] - self.tail, []
        for kind in self.kinds:
            valid, (code, typ) = buf[at] == 1, _KINDS[kind]
            if kind == "string":
                size = np.ascontiguousarray(buf[tail[:, None] + np.arange(4)]).view("<u4").ravel().astype(np.int64)
                ends = np.concatenate(([0], np.cumsum(size)))
                data = buf[np.repeat(at + 1 - ends[:-1], size) + np.arange(ends[-1])] - 1
                bits = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
                col = pa.Array.from_buffers(pa.large_string(), n, [bits, pa.py_buffer(ends), pa.py_buffer(data.astype(np.uint8))])
                out.append(col.cast(pa.string()))
                at, tail = at + 2 + size, tail + 4
                continue
            width = int(code[1])
            raw = np.ascontiguousarray(buf[at[:, None] + np.arange(1, width + 1)])
            at = at + 1 + width
            if kind == "boolean":
                out.append(pa.array(raw.ravel() == 1, mask=~valid))
                continue
            u = raw.view(f">u{width}").ravel().astype(f"u{width}")
            top = np.array(1 << (8 * width - 1), f"u{width}")
            if kind in _INTS:
                out.append(pa.array((u ^ top).view(code), mask=~valid).cast(typ))
            else:
                x = np.where(u & top, u ^ top, ~u).view(code)
                x = np.where(buf[tail] == 1, np.array(-0.0, code), x)
                tail = tail + 1
                out.append(pa.array(x, mask=~valid, from_pandas=False))
        return out


def _place(root: str) -> tuple[pafs.FileSystem, str, str]:
    """The file system of a folder, the folder's path there, and what its files' names are given out under."""
    if "://" not in root and not root.startswith("file:"):
        return pafs.LocalFileSystem(), root, root
    files, base = pafs.FileSystem.from_uri(root if "://" in root else root.replace("file:", "file://", 1))
    return files, base, base if isinstance(files, pafs.LocalFileSystem) else root


def write_sorted(
    df: DataFrame, names: list[str], folder: str, key: str, scratch: Scratch, partitions: int
) -> DataFrame:
    """One Parquet file for each value of ``df``'s first column, with the other columns, sorted by ``key`` and then them.

    The other columns are called ``names`` in the files, whatever they are called here.

    Returns (number, path, n_rows, ids_sha256) of the files, where the last is the
    SHA-256 of the keys in file order, in decimal, joined by commas.
    """
    fields = df.schema.fields[1:]
    order = sorted(range(len(fields)), key=lambda i: (names[i] != key, i))
    codec = RowCodec([fields[i].dataType.simpleString() for i in order])
    schema = pa.schema([pa.field(n, _KINDS[f.dataType.simpleString()][1]) for n, f in zip(names, fields)])
    back = [order.index(i) for i in range(len(fields))]

    def encode(batches):
        for b in batches:
            if len(b):
                head = b.column(0).to_numpy(zero_copy_only=False)
                rows = codec.encode([b.column(1 + i) for i in order], head)
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(rows)], pa.binary())], names=["chunk"])

    def number(row: bytes) -> int:
        return int.from_bytes(row[:4], "big")

    def write(pairs):
        files, base, shown = _place(folder)
        files.create_dir(base, recursive=True)
        for no, rows in groupby((k for k, _ in pairs), number):
            name, digest, n = f"{no:05d}-{uuid.uuid4().hex}.parquet", hashlib.sha256(), 0
            with files.open_output_stream(f"{base}/{name}") as sink, pq.ParquetWriter(sink, schema) as out:
                while some := list(islice(rows, CHUNK)):
                    cols = codec.decode(some)
                    out.write_table(pa.Table.from_arrays([cols[i] for i in back], schema=schema))
                    ids = ",".join(cols[0].cast(pa.string()).fill_null("").to_pylist())
                    digest.update((ids if n == 0 else f",{ids}").encode())
                    n += len(some)
            yield no, f"{shown}/{name}", n, digest.hexdigest()

    inner = df.toDF("number", *[f"c{i}" for i in range(len(fields))])
    rows = inner.mapInArrow(encode, "chunk binary").rdd.flatMap(lambda r: ((k, None) for k in pickle.loads(r[0])))
    # The first four bytes are the file's number: files are dealt out, and rows are sorted by file and content.
    dealt = rows.repartitionAndSortWithinPartitions(partitions, lambda k: number(k))
    return scratch.write(df.sparkSession.createDataFrame(dealt.mapPartitions(write), _FILE), "files")


def _read(spark: SparkSession, files: list, schema: T.StructType) -> DataFrame:
    """The rows of files as columns c0, c1 and so on, after ``s`` with each row's file number."""
    name, cols = r"([0-9]+)-[0-9a-f]+\.parquet$", [f"c{i}" for i in range(len(schema))]
    if not files:
        own = [T.StructField(c, f.dataType) for c, f in zip(cols, schema.fields)]
        return spark.createDataFrame([], T.StructType([T.StructField("s", T.IntegerType()), *own]))
    df = spark.read.schema(schema).parquet(*[f["path"] for f in files])
    return df.select(F.regexp_extract(F.input_file_name(), name, 1).cast("int"), "*").toDF("s", *cols)


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key that is not null."""
    return (F.crc32(F.concat(F.lit("s"), key.cast("string")).cast("binary")) % buckets).cast("int")


def rewrite_pair(
    parents: DataFrame, children: DataFrame, key: str, start_parents: Column, start_children: Column, *,
    names: tuple[str, str] = ("parents", "children"), buckets: int = 600, partitions: int | None = None
) -> DataFrame:
    """Write both tables as starting files by the given numbers, then rewrite them as one file a table and bucket.

    Keys of parents and children with a parent lie in bucket ``crc32("s" || key) mod
    buckets``; children without a parent in ``buckets``, null keys of both tables in
    the one after it.  Returns a row for each final file: table_name, path, columns,
    ids_sha256, lineage_sha256 (of ``file:rows`` over the starting files that its
    rows come from), bucket, n_rows, n_joined (rows of the bucket's inner join),
    rewritten (false where a starting file stayed).  The files stay in a new folder
    under ``spark.checkpoint.dir``; nothing else is left there.

    * nulls may stand in any column and come first; repeated rows all stay;
    * 0.0 and -0.0 are equal and keep their signs, NaN is the largest number;
    * empty tables have no files; other columns may have any name, and types are
      integers, floats, booleans, strings, dates and timestamps (else TypeError);
    * texts may be of any length.
    """
    spark = parents.sparkSession
    scratch, folder = Scratch(spark), f"{shared_dir(spark)}/cobucket-{uuid.uuid4().hex}"
    n = partitions or max(spark.sparkContext.defaultParallelism, -(-max(parents.count(), children.count()) // TASK_ROWS))
    n = min(buckets + 2, n)
    pair = {names[0]: (parents, start_parents), names[1]: (children, start_children)}
    start, files = {}, {}
    for name, (df, no) in pair.items():
        files[name] = write_sorted(df.select(no.cast("int"), "*"), df.columns, f"{folder}/{name}", key, scratch, n)
        start[name] = _read(spark, files[name].select("path").collect(), df.schema)

    own = F.col(f"c{parents.columns.index(key)}")
    # Written, so that the join's sides are plain shuffles, whose hot partitions adaptive execution can split.
    ids = start[names[0]].where(own.isNotNull()).groupBy(own.alias("k")).agg(F.count(F.lit(1)).alias("j"))
    ids = scratch.write(ids, "keys")

    def marked(name: str) -> DataFrame:
        """(b, s, j) before the table's columns: bucket, starting file, and how many rows of the other table each joins."""
        df = start[name]
        k, cols = F.col(f"c{pair[name][0].columns.index(key)}"), df.columns[1:]
        if name == names[0]:
            b = F.coalesce(bucket_of(k, buckets), F.lit(buckets + 1))
            return df.select(b.alias("b"), "s", F.lit(0).cast("long").alias("j"), *cols)
        # Never broadcast: the keys grow with the input.
        both = df.join(ids.hint("merge"), k == F.col("k"), "left")
        b = F.when(k.isNull(), buckets + 1).when(F.col("j").isNull(), buckets).otherwise(bucket_of(k, buckets))
        return both.select(b.alias("b"), "s", F.coalesce("j", F.lit(0).cast("long")).alias("j"), *cols)

    facts = [
        marked(t).groupBy("b", "s").agg(F.count(F.lit(1)).alias("n"), F.sum("j").alias("j")).select(F.lit(t).alias("t"), "*")
        for t in names
    ]
    facts = scratch.write(facts[0].unionByName(facts[1]), "facts")
    by_file = facts.groupBy("t", "s").agg(F.count(F.lit(1)).alias("m"))
    by_file = by_file.where("m = 1").select("t", F.col("s").alias("one"), F.lit(True).alias("whole"))
    parts = F.sort_array(F.collect_list(F.struct("s", "n")))  # a bucket's starting files, at most as many as there are numbers
    told = F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["s"], x["n"])), ",")
    by_bucket = facts.groupBy("t", "b").agg(
        F.sha2(told, 256).alias("lineage_sha256"), F.sum("n").alias("rows"), F.sum("j").alias("joined"),
        F.when(F.count(F.lit(1)) == 1, F.min("s")).alias("one")
    ).join(by_file.hint("merge"), ["t", "one"], "left")
    by_bucket = scratch.write(by_bucket.withColumn("stays", F.coalesce("whole", F.lit(False))), "buckets")
    joined = by_bucket.where(F.col("t") == names[1]).select("b", F.col("joined").alias("n_joined"))
    final = []
    for t in names:
        mine = by_bucket.where(F.col("t") == t).drop("t")
        stay = [r["b"] for r in mine.where("stays").select("b").collect()]
        rest = marked(t)
        rest = rest.where(~F.col("b").isin(stay)) if stay else rest
        new = write_sorted(rest.drop("s", "j"), pair[t][0].columns, f"{folder}/{t}", key, scratch, n)
        new = new.withColumnRenamed("number", "b").withColumn("rewritten", F.lit(True))
        old = mine.where("stays").select("b", F.col("one").alias("number")).join(files[t].hint("merge"), "number")
        both = new.unionByName(old.drop("number").withColumn("rewritten", F.lit(False)))
        final.append(
            both.join(mine.select("b", "lineage_sha256").hint("merge"), "b").select(
                F.lit(t).alias("table_name"), "path", F.lit(",".join(pair[t][0].columns)).alias("columns"), "ids_sha256",
                "lineage_sha256", "b", "n_rows", "rewritten"
            )
        )
    out = final[0].unionByName(final[1]).join(joined.hint("merge"), "b", "left")
    out = scratch.write(out.select(
        "table_name", "path", "columns", "ids_sha256", "lineage_sha256", F.col("b").cast("long").alias("bucket"), "n_rows",
        F.coalesce("n_joined", F.lit(0).cast("long")).alias("n_joined"), "rewritten"
    ), "result")
    keep = {r["path"].rsplit("/", 1)[1] for r in out.select("path").collect()}
    place, base, _ = _place(folder)
    for t in names:
        for f in place.get_file_info(pafs.FileSelector(f"{base}/{t}", allow_not_found=True)):
            if f.base_name not in keep:
                place.delete_file(f.path)
    return out
