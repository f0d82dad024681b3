"""Sinks: JSON lines, shards by rows or by bytes, rejects, upserts, and folders that are replaced whole."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunk import chunk_documents
from ..operators.dedup import last_wins


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Writes a folder beside `path` and puts it in its place when it is whole. Until then, and if writing fails, the old one stays; a driver that dies
    between the two renames leaves both under their other names."""
    mark = uuid.uuid4().hex
    fresh, old = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write(fresh)
    except Exception:
        fs.delete(at(fresh), True)
        raise
    there = fs.exists(at(path))
    if there and not fs.rename(at(path), at(old)):
        raise OSError(f"can't move {path}")
    if not fs.rename(at(fresh), at(path)):
        raise OSError(f"can't move {fresh}")
    if there:
        fs.delete(at(old), True)


def write_json(df: DataFrame, path: str, rows_per_file: int = 500_000) -> None:
    """JSON lines in files of at most so many rows; the folder is replaced when all are written."""
    replace(df.sparkSession, path, lambda to: df.write.option("maxRecordsPerFile", rows_per_file).option("ignoreNullFields", "false").json(to))


def write_csv(df: DataFrame, path: str, rows_per_file: int = 350_000) -> None:
    """CSV files with a header, of at most so many rows; the folder is replaced when all are written."""
    replace(df.sparkSession, path, lambda to: df.write.option("maxRecordsPerFile", rows_per_file).option("emptyValue", "").csv(to, header=True, quote='"', escape='"'))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Further CSV files in a folder, each with the header."""
    df.write.mode("append").option("emptyValue", "").csv(path, header=True, quote='"', escape='"')


def rows_by_file(spark: SparkSession, path: str) -> DataFrame:
    """file, rows: what a written folder of JSON lines holds."""
    return spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"))


def write_rejects(rejected: DataFrame, path: str, duplicates: DataFrame | None = None) -> None:
    """Rejected rows by reason, as JSON lines; `duplicates`, if given, go with them under the reason duplicate."""
    if duplicates is not None:
        rejected = rejected.unionByName(duplicates.withColumn("_reject_reason", F.lit("duplicate")), allowMissingColumns=True)
    replace(rejected.sparkSession, path, lambda to: rejected.write.partitionBy("_reject_reason").json(to))


def upsert(table: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """A table after changes: of each key the row of the highest sequence number."""
    return last_wins(table.unionByName(changes, allowMissingColumns=True), list(keys), [seq])


def byte_parts(df: DataFrame, group: str, order: str, line: str, target: int, most_rows: int | None = None) -> DataFrame:
    """part, rows, bytes, sha256 of each group's lines, filled one by one: a part ends before it would pass `target` bytes, or `most_rows`, and holds one line at least.

    Filling is sequential by its meaning; a group is what is written by one task, such as an input file of bounded size.
    """

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        parts, held, rows, size = [], hashlib.sha256(), 0, 0
        for raw in (x.encode() + b"\n" for x in pdf.sort_values(order)[line]):
            if rows and (size + len(raw) > target or (most_rows and rows >= most_rows)):
                parts.append((rows, size, held.hexdigest()))
                held, rows, size = hashlib.sha256(), 0, 0
            held.update(raw)
            rows, size = rows + 1, size + len(raw)
        parts.append((rows, size, held.hexdigest()))
        return pd.DataFrame([(pdf[group].iloc[0], k, *p) for k, p in enumerate(parts, 1)], columns=[group, "part", "rows", "bytes", "sha256"])

    kind = df.schema[group].dataType.simpleString()
    return df.select(group, order, line).groupBy(group).applyInPandas(fill, f"{group} {kind}, part int, rows long, bytes long, sha256 string")


def fill_parts(lengths: np.ndarray, target: int, most_rows: int | None = None, head: int = 0) -> np.ndarray:
    """The part of each line, from 1, if lines of these lengths fill parts one by one: a part ends before it would pass `target` bytes, `head` included, or `most_rows`."""
    ends, out, at, part = np.cumsum(lengths), np.empty(len(lengths), np.int32), 0, 0
    while at < len(lengths):
        before = ends[at - 1] if at else 0
        end = int(np.searchsorted(ends, before + target - head, side="right"))
        end = max(at + 1, min(end, at + most_rows) if most_rows else end)
        part += 1
        out[at:end] = part
        at = end
    return out


def write_parts(df: DataFrame, folder: str, group: str, order: str, target: int, most_rows: int | None = None, count: str | None = None) -> DataFrame:
    """Writes each group's rows, in order, as CSV parts with byte order mark and header; gives group, part, path (a name in the folder), rows, bytes, sha256 and, of the column
    `count`, the number of runs of equal values (documents, where rows are their chunks) as `counted`.

    Parts are found from the lines' lengths alone, one group (an input file of bounded size) at a time; each part is then one task's, which
    writes under a name of its own and renames. No row is split; a part holds one row at least. `group` is no column of the files.
    """
    columns = [c for c in df.columns if c != group]
    options = {"quote": '"', "escape": '"', "emptyValue": "", "nullValue": ""}
    header = "\ufeff" + ",".join(f'"{c}"' if set(c) & set(',"\n') else c for c in columns) + "\n"
    head = len(header.encode())
    if head >= target:
        raise ValueError("the header alone is as large as a part")
    kind, order_kind = df.schema[group].dataType.simpleString(), df.schema[order].dataType.simpleString()
    lines = df.select(F.col(group).alias("__group"), F.col(order).alias("__order"), F.concat(F.to_csv(F.struct(*columns), options), F.lit("\n")).alias("__line"), (F.col(count).cast("string") if count else F.lit(None).cast("string")).alias("__count"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__order", ignore_index=True)
        return pdf[["__group", "__order"]].assign(__part=fill_parts(pdf["__n"].to_numpy(), target, most_rows, head))

    placed = lines.select("__group", "__order", F.octet_length("__line").alias("__n")).groupBy("__group").applyInPandas(fill, f"__group {kind}, __order {order_kind}, __part int")
    rows = lines.join(placed, ["__group", "__order"]).select("__group", "__part", "__order", "__line", "__count")
    rows = rows.repartition("__group", "__part").sortWithinPartitions("__group", "__part", "__order").select("__group", "__part", "__line", "__count")

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + os.path.abspath(folder))
        store.create_dir(base, recursive=True)
        now, out, done = None, None, []

        def close():
            out["to"].close()
            name = f"{now[0]}.part-{now[1]:05d}.csv"
            store.move(f"{base}/{out['name']}", f"{base}/{name}")
            done.append((now[0], now[1], name, out["rows"], out["bytes"], out["sha"].hexdigest(), out["runs"]))

        for batch in batches:
            for g, part, line, value in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if (g, part) != now:
                    if now:
                        close()
                    name, raw = f".{uuid.uuid4().hex}.csv", header.encode()
                    now, out = (g, part), {"name": name, "to": store.open_output_stream(f"{base}/{name}"), "rows": 0, "bytes": head, "sha": hashlib.sha256(raw), "last": None, "runs": 0}
                    out["to"].write(raw)
                raw = line.encode()
                out["to"].write(raw)
                out["sha"].update(raw)
                out["runs"] += value is not None and value != out["last"]
                out["rows"], out["bytes"], out["last"] = out["rows"] + 1, out["bytes"] + len(raw), value
        if now:
            close()
        if done:
            types = [batch.schema.field(0).type, pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(types)], names=[group, "part", "path", "rows", "bytes", "sha256", "counted"])

    return rows.mapInArrow(run, f"{group} {kind}, part int, path string, rows long, bytes long, sha256 string, counted long")


def write_chunks(docs: DataFrame, folder: str, target: int, id_col: str = "doc_id", text_col: str = "content", title_col: str | None = "title", limit: int = 2000, overlap: int = 200) -> DataFrame:
    """Chunks of documents written as parts in one go; gives the manifest of write_parts, where `counted` are the documents that begin in or reach into a part."""
    if not 0 <= overlap < limit or limit < 200:
        raise ValueError("chunks hold 200 characters at least, and more than they overlap")
    chunks = chunk_documents(docs, id_col, text_col, title_col, limit, overlap)
    placed = chunks.withColumn("file", F.lit("documents_chunks")).withColumn("place", F.concat("doc_id", F.lit("#"), F.lpad(F.col("chunk_no").cast("string"), 9, "0")))
    return write_parts(placed, folder, "file", "place", target, count="doc_id")


def id_file(df: DataFrame, column: str, path: str) -> None:
    """The distinct ids of a column, a line each."""
    df.select(F.col(column).cast("string").alias("value")).distinct().orderBy("value").write.mode("overwrite").text(path)
