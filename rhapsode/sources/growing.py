"""A streaming sink of growing arrays: rows of unknown number, appended epoch by epoch, and one ``.npy`` file of them at the end.

Tasks write the rows of each array to files of their own. An epoch's commit lists them in one small file, with the number of rows that each array
has from then on; it appears whole, and an epoch that is committed already is passed over, so that a stream which starts again repeats nothing. Files that no
commit lists are never read. ``settle`` writes the arrays as files: the header for the final number of rows, then the epochs' rows in order.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from .archives import _store, listed_files, tasks
from .recordfiles import put_whole, qualified

#: Bytes that are copied at a time.
COPY = 8 << 20
#: Files that a task keeps open.
OPEN = 32


def npy_header(rows: int, width: int, kind: str = "<f4") -> bytes:
    """The header of an array of that many rows, as numpy writes it; it has the same size for any number of rows up to 10^19."""
    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(out, {"descr": kind, "fortran_order": False, "shape": (rows, width) if width else (rows,)})
    return out.getvalue()


@dataclass
class Appended(WriterCommitMessage):
    """Parts of a task: (array, first position, rows, width, file, place in the file)."""

    parts: list[tuple]


class ArrayWriter(DataSourceStreamArrowWriter):
    """Rows (array, position, values): a task gathers some megabytes of them and writes these as one file, array by array."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, batches: Iterator[pa.RecordBatch]) -> Appended:
        store, base = _store(self.folder)
        store.create_dir(f"{base}/parts", recursive=True)
        parts: list[tuple] = []
        held, size = [], 0

        def flush() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            t = t.sort_by([(t.column_names[0], "ascending"), (t.column_names[1], "ascending")]).combine_chunks()
            keys, position, values = t.column(0).to_pylist(), np.asarray(t.column(1)), t.column(2)
            many = pa.types.is_list(values.type) or pa.types.is_large_list(values.type)
            widths = pc.list_value_length(values).to_numpy() if many else np.zeros(len(keys), dtype="i8")
            x = np.asarray(pc.list_flatten(values) if many else values, dtype="<f4")
            ends = np.concatenate([[0], np.cumsum(widths if many else np.ones(len(keys), dtype="i8"))])
            name, cuts = f"{uuid.uuid4().hex}.f4", [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if (widths[lo:hi] != widths[lo]).any():
                    raise ValueError(f"rows of array {keys[lo]} differ in width")
                parts.append((str(keys[lo]), int(position[lo]), hi - lo, int(widths[lo]), name, int(ends[lo]) * 4))
            with store.open_output_stream(f"{base}/parts/{name}") as out:
                out.write(x.tobytes())

        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes
            if size >= COPY:
                flush()
                held, size = [], 0
        if held:
            flush()
        return Appended(parts)

    def commit(self, messages: list[Appended | None], batchId: int) -> None:  # noqa: N803
        store, base = _store(self.folder)
        path = f"{base}/epochs/{batchId:012d}.json"
        if store.get_file_info(path).type.name != "NotFound":
            return
        put_whole(self.folder, path, "".join(json.dumps(dict(zip(("array", "first", "rows", "width", "file", "at"), p, strict=True))) + "\n" for m in messages if m for p in sorted(m.parts)))

    def abort(self, messages: list[Appended | None], batchId: int) -> None:  # noqa: N803
        store, base = _store(self.folder)
        for m in messages:
            for name in {p[4] for p in m.parts} if m else ():
                store.delete_file(f"{base}/parts/{name}")


class GrowingArrays(DataSource):
    """``growing_arrays``: a stream sink of (array, position long, value float or array of floats); option path."""

    @classmethod
    def name(cls) -> str:
        return "growing_arrays"

    def schema(self) -> str:
        return "array string, position long, value array<float>"

    def streamWriter(self, schema, overwrite: bool) -> ArrayWriter:  # noqa: N802
        if len(schema) != 3:
            raise ValueError("columns must be array, position and value")
        return ArrayWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GrowingArrays)


def settle(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """Writes ``<array>.npy`` into ``out`` for each array, one task each; gives (array, rows, width, bytes), as a table.

    Rows of one epoch are in the order of their positions, epochs in their own order. A file appears whole, and doing it again gives the same bytes."""
    folder, out = qualified(spark, folder), qualified(spark, out)
    listed = spark.read.schema("array string, first long, rows long, width int, file string, at long").json(f"{folder}/epochs").withColumn("epoch", F.col("_metadata.file_name"))
    each = listed.groupBy("array").agg(F.sum("rows").alias("rows"), F.max("width").alias("width"), F.min("width").alias("narrow"), F.array_sort(F.collect_list(F.struct("epoch", "first", "file", "at", (F.col("rows") * F.greatest("width", F.lit(1)) * 4).alias("size")))).alias("parts"))

    def run(frames):
        import pandas as pd

        store, base = _store(folder)
        _, target = _store(out)
        store.create_dir(target, recursive=True)
        opened: dict = {}
        for f in frames:
            sizes = []
            for v in f.to_dict("records"):
                if v["width"] != v["narrow"]:
                    raise ValueError(f"rows of array {v['array']} differ in width")
                draft = f"{target}/.{v['array']}.{uuid.uuid4().hex[:8]}"
                with store.open_output_stream(draft) as sink:
                    sink.write(npy_header(int(v["rows"]), int(v["width"])))
                    for p in v["parts"]:
                        if p["file"] not in opened:
                            while len(opened) >= OPEN:
                                opened.pop(next(iter(opened))).close()
                            opened[p["file"]] = store.open_input_file(f"{base}/parts/{p['file']}")
                        part, left = opened[p["file"]], int(p["size"])
                        part.seek(int(p["at"]))
                        while left and (block := part.read(min(COPY, left))):
                            sink.write(block)
                            left -= len(block)
                        if left:
                            raise ValueError(f"{p['file']} is short")
                store.move(draft, f"{target}/{v['array']}.npy")
                sizes.append(store.get_file_info(f"{target}/{v['array']}.npy").size)
            yield f[["array", "rows", "width"]].assign(bytes=pd.Series(sizes, index=f.index, dtype="int64"))
        for part in opened.values():
            part.close()

    done = each.repartition(tasks(spark), "array").mapInPandas(run, "array string, rows long, width int, bytes long")
    done.write.mode("overwrite").parquet(f"{folder}/settled")
    return spark.read.parquet(f"{folder}/settled")


def read_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """(array, position, value) of a folder of ``.npy`` files of float rows, read in blocks."""
    files = listed_files(spark, qualified(spark, folder), ".npy")

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                store, at = _store(path)
                name = at.rpartition("/")[2].removesuffix(".npy")
                with store.open_input_file(at) as raw:
                    np.lib.format.read_magic(raw)
                    shape, _, dtype = np.lib.format.read_array_header_1_0(raw)
                    width, done = int(np.prod(shape[1:], dtype=np.int64)), 0
                    while done < shape[0]:
                        n = min(shape[0] - done, max(1, COPY // (width * dtype.itemsize)))
                        x = np.frombuffer(raw.read(n * width * dtype.itemsize), dtype)
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(x))
                        yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(np.arange(done, done + n)), lists], names=["array", "position", "value"])
                        done += n

    return files.mapInArrow(run, "array string, position long, value array<float>")
