"""Discovery and defensive reading of raw CSV files."""

from __future__ import annotations

import csv
import io
import itertools
import os
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fnmatch import fnmatchcase as fnmatch
from pathlib import Path
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import staged

PATTERN = "suspicious_login_logs*.csv"
KEY_PREFIX = "HMAC_SECRET_KEY"
ENCODINGS = ("utf-8", "cp1252", "latin-1")
SAMPLE = 8192


@dataclass(frozen=True)
class RawFile:
    path: str
    institution: str
    key: bytes


def key_name(institution: str | None) -> str:
    """The environment variable that holds an institution's key."""
    if not institution:
        return KEY_PREFIX
    return f"{KEY_PREFIX}_" + "".join(c if c.isascii() and c.isalnum() else "_" for c in institution.upper())


class Folder:
    """What is in a folder: of the local disk, or of any store that Spark reaches."""

    def __init__(self, path: str, spark: SparkSession | None = None):
        self.path, self.spark = path.rstrip("/"), spark

    def entries(self) -> list[tuple[str, bool]]:
        """(path, is a folder) of all entries, sorted; FileNotFoundError without the folder."""
        if self.spark is None:
            if not Path(self.path).is_dir():
                raise FileNotFoundError(f"no folder {self.path}")
            return sorted((str(p), p.is_dir()) for p in Path(self.path).iterdir())
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(at) or not fs.getFileStatus(at).isDirectory():
            raise FileNotFoundError(f"no folder {self.path}")
        return sorted((s.getPath().toString(), s.isDirectory()) for s in fs.listStatus(at))


def discover(folder: str, env: Mapping[str, str] = os.environ, warn=None, spark: SparkSession | None = None) -> list[RawFile]:
    """Raw files with their keys: sub-folders are institutions, each with a key of its own; else one flat institution.

    With ``spark``, the folder may be in any store that Spark reaches. Raises FileNotFoundError without the folder or any
    file, KeyError naming the variable without a key. A sub-folder without files is reported to ``warn`` and left out.
    """

    def key(name: str) -> bytes:
        if not env.get(name):
            raise KeyError(f"set {name} to the secret key")
        return env[name].encode()

    def raw(entries: list[tuple[str, bool]]) -> list[str]:
        return [p for p, is_folder in entries if not is_folder and fnmatch(p.rpartition("/")[2], PATTERN)]

    out = []
    entries = Folder(folder, spark).entries()
    subs = [p for p, is_folder in entries if is_folder]
    for sub in subs:
        name = sub.rstrip("/").rpartition("/")[2]
        if files := raw(Folder(sub, spark).entries()):
            out += [RawFile(p, name, key(key_name(name))) for p in files]
        elif warn:
            warn(f"no raw files in {sub}")
    if not subs:
        out = [RawFile(p, "default", key(key_name(None))) for p in raw(entries)]
    if not out:
        raise FileNotFoundError(f"no {PATTERN} in {folder}")
    return out


def sniff(raw: bytes) -> tuple[str, str, list[str]]:
    """(encoding, delimiter, header) of a file: the first encoding that decodes all of it, and a delimiter from its start."""
    for encoding in ENCODINGS:
        try:
            text = raw.decode(encoding)
            break
        except UnicodeDecodeError:
            continue
    text = text.removeprefix("\ufeff")
    head = text[:SAMPLE]
    try:
        delimiter = csv.Sniffer().sniff(head, delimiters=",;\t|").delimiter
    except csv.Error:
        first = head.partition("\n")[0]
        delimiter = ";" if first.count(";") > first.count(",") else ","
    return encoding, delimiter, next(csv.reader(io.StringIO(text, newline=""), delimiter=delimiter), [])


def _sniffed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(p, *sniff(c.as_py())) for p, c in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True)]
        types = (("path", pa.string()), ("encoding", pa.string()), ("delimiter", pa.string()), ("header", pa.list_(pa.string())))
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, (_, t) in enumerate(types)], names=[n for n, _ in types])


def _records(encoding: str, delimiter: str, width: int):
    """Whole records of files in an encoding that Spark does not read, in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                text = io.TextIOWrapper(io.BufferedReader(pa.BufferReader(content.as_buffer())), encoding=encoding, newline="")
                rows = (r for r in csv.reader(text, delimiter=delimiter) if r)
                next(rows, None)
                while some := list(itertools.islice(rows, 10_000)):
                    cells = [[x or None for x in (r + [""] * width)[:width]] for r in some]
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(cells)), pa.array(cells, pa.list_(pa.string()))], names=["path", "cells"])

    return run


def _spark_names(header: list[str]) -> list[str]:
    return [f"c{i}_" for i in range(len(header))]


def _read_group(spark: SparkSession, paths: list[str], encoding: str, delimiter: str, header: list[str]) -> DataFrame:
    """All files of one form as text columns, with path_ and line_, which grows in each file."""
    names = _spark_names(header)
    if encoding == "cp1252":  # not a charset that Spark reads
        raw = spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(_records(encoding, delimiter, len(header)), "path string, cells array<string>")
        df = raw.select(F.col("path").alias("path_"), *(F.get("cells", i).alias(n) for i, n in enumerate(names)))
    else:
        options = {"sep": delimiter, "header": True, "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"', "multiLine": True, "enforceSchema": True, "mode": "PERMISSIVE"}
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        read = spark.read.options(**options).option("encoding", "ISO-8859-1" if encoding == "latin-1" else "UTF-8").schema(schema).csv(paths)
        df = read.select(F.col("_metadata.file_path").alias("path_"), *names)
    return df.select("path_", F.monotonically_increasing_id().alias("line_"), *(F.col(n).alias(h) for n, h in zip(names, header, strict=True)))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """All columns of one file as strings, only empty text as null, with ``line_``, which grows with the row's place."""
    (form,) = _forms(spark, [path])
    return _read_group(spark, [path], *form[1:]).drop("path_")


def _forms(spark: SparkSession, paths: list[str]) -> list[tuple[str, str, str, list[str]]]:
    """(path, encoding, delimiter, header) of each file, found where it is read; a row a file comes to the driver."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    rows = files.mapInArrow(_sniffed, "path string, encoding string, delimiter string, header array<string>").collect()
    return [(r["path"], r["encoding"], r["delimiter"], list(r["header"])) for r in rows]


def _plain(path: str) -> str:
    """A path as it can be compared, however its scheme is written."""
    return unquote(re.sub(r"^file:/*", "/", path))


def read_all(spark: SparkSession, files: list[RawFile], required: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """The files' rows with institution, source_file and row_order (file, line), and counts of what was dropped.

    Files of one encoding, delimiter and header are read together, and the rows are written once, so that all that follows
    sees the same ones. Rows of blanks only are dropped. Raises ValueError if files differ in their set of columns (not its
    order) or a required column is missing.
    """
    if not files:
        raise FileNotFoundError("no raw files")
    groups: dict[tuple, list[str]] = {}
    columns = None
    for path, encoding, delimiter, header in sorted(_forms(spark, [f.path for f in files])):
        columns = columns or set(header)
        if set(header) != columns:
            raise ValueError(f"columns of {path} differ: {sorted(set(header) ^ columns)}")
        if missing := sorted(set(required) - columns):
            raise ValueError(f"{path} lacks {missing}")
        groups.setdefault((encoding, delimiter, tuple(header)), []).append(path)
    parts = [_read_group(spark, paths, encoding, delimiter, list(header)) for (encoding, delimiter, header), paths in groups.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    known = [(_plain(f.path), i, f.institution, f.path.rpartition("/")[2]) for i, f in enumerate(files)]
    names = F.broadcast(spark.createDataFrame(known, "name_ string, file_ int, institution string, source_file string"))  # a row a file
    raw = sorted(columns)
    empty = F.lit(True)
    for c in raw:
        empty = empty & (F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")) == "")
    name = F.url_decode(F.replace(F.regexp_replace("path_", "^file:/*", "/"), F.lit("+"), F.lit("%2B")))
    marked = out.withColumns({"name_": name, "empty_": empty}).join(names, "name_")
    marked = staged(marked.withColumn("row_order", F.struct(F.col("file_").alias("file"), F.col("line_").alias("line"))).drop("name_", "path_", "file_", "line_"), "raw")
    return marked.where(~F.col("empty_")).drop("empty_"), {"removed_empty_rows": marked.where("empty_").count()}


def read_release(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A release CSV; raises ValueError unless its header is exactly the schema's names in order."""
    header = spark.read.option("header", True).csv(path).columns
    if header != schema.names:
        raise ValueError(f"columns are {header}, expected {schema.names}")
    return spark.read.schema(schema).options(header=True, enforceSchema=False).csv(path)


def first_existing(env_name: str, candidates: list[str], env: Mapping[str, str] = os.environ) -> Path:
    """The path an environment variable names, else the first candidate that exists."""
    for p in filter(None, [env.get(env_name), *candidates]):
        if Path(p).exists():
            return Path(p)
    raise FileNotFoundError(f"none of {candidates} exists and {env_name} names no file")
