"""One ordered XML file (K1, K5) whose rows are sorted, formatted and encoded by many tasks.

``xml_parts`` writes the rows in ranges of their order, each part a whole document with the root around it.
``join_parts`` then makes one file of them: the head of the first part, the rows of all, the end of the last. That step copies
bytes through a small buffer in one task, as a file has one writer; it holds no row, and starts again if its executor is lost.

Defined results: the bytes are those that one task would have written; no rows give one empty file, as Spark's writer does;
rows of equal order come in any order among themselves. ``mode`` is that of ``DataFrameWriter``; with "overwrite" the old
folder goes only when all parts are written. A part that does not begin and end as the writer's parts do raises an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession

from addrweave.session import remove_scratch, scratch_path, ship_package

# Fixed value: the declaration in front of the root element.
DECLARATION = 'version="1.0" encoding="UTF-8" standalone="yes"'
BUFFER = 8 << 20
MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def _system(spark: SparkSession, path: str):
    """(file system, path) as the JVM knows them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(at)


def _open(path: str):
    """(Arrow file system, path in it), for use inside tasks."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def xml_parts(df: DataFrame, folder: str, order: list[Column], drop: list[str], root: str, row: str) -> list[str]:
    """Write the rows as XML into the new ``folder``, in ranges of ``order``; the parts' names, in order."""
    spark = df.sparkSession
    writer = df.orderBy(*order).drop(*drop).write.format("xml").option("rootTag", root).option("rowTag", row)
    writer.option("declaration", DECLARATION).save(folder)
    system, at = _system(spark, folder)
    return sorted(f.getPath().toString() for f in system.listStatus(at) if f.getPath().getName().startswith("part-"))


def _body(size: int, name: str, src, head: bytes, end: bytes) -> tuple[int, int]:
    """Where the rows of a part begin and end (equal for a part without rows)."""
    if size == 0:
        return 0, 0
    if size < len(head) + len(end) or src.read_at(len(head), 0) != head or src.read_at(len(end), size - len(end)) != end:
        raise ValueError(f"{name} does not begin with {head!r} and end with {end!r}")
    return len(head), size - len(end)


def join_parts(spark: SparkSession, parts: list[str], folder: str, root: str) -> str:
    """Make one new file in ``folder`` of the parts, in their order; its name (hidden from readers until it is renamed)."""
    head = f"<?xml {DECLARATION}?>\n<{root}>\n".encode()
    end = f"\n</{root.split()[0]}>".encode()

    def copy(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in frames:
            for names in t.parts:
                target = f"{folder}/_joined-{uuid.uuid4().hex}"  # a name for each attempt
                system, at = _open(target)
                any_rows = False
                with system.open_output_stream(at) as out:
                    for name in names:
                        source, path = _open(name)
                        with source.open_input_file(path) as src:
                            a, b = _body(src.size(), name, src, head, end)
                            if a < b:
                                out.write(b"\n" if any_rows else head)
                                any_rows = True
                            while a < b:
                                block = src.read_at(min(BUFFER, b - a), a)
                                out.write(block)
                                a += len(block)
                    if any_rows:
                        out.write(end)
                yield pd.DataFrame({"name": [target]})

    ship_package(spark)
    one = spark.createDataFrame([(parts,)], "parts array<string>").coalesce(1)
    return one.mapInPandas(copy, "name string").collect()[0].name


def write_one_file(df: DataFrame, order: list[Column], drop: list[str], path: str, root: str, row: str, mode: str) -> None:
    """Write ``df`` without the columns ``drop`` as one XML file, sorted by ``order``, into the folder ``path``."""
    spark = df.sparkSession
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {MODES}")
    system, at = _system(spark, path)
    there = system.exists(at)
    if there and mode == "ignore":
        return
    if there and mode.startswith("error"):
        raise FileExistsError(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    folder = scratch_path(spark, "xml-parts")
    try:
        parts = xml_parts(df, folder, order, drop, root, row)
        if there and mode == "overwrite":
            system.delete(at, True)
        system.mkdirs(at)
        joined = hadoop(join_parts(spark, parts, at.toString().rstrip("/"), root))
        if not system.rename(joined, hadoop(at, f"part-00000-{uuid.uuid4()}.xml")):
            raise OSError(f"{joined.toString()} was not renamed")
        for f in system.listStatus(at):  # of attempts that were lost
            if f.getPath().getName().startswith("_joined-"):
                system.delete(f.getPath(), False)
        system.create(hadoop(at, "_SUCCESS"), True).close()
    finally:
        remove_scratch(spark, folder)
