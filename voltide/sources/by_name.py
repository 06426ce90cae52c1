"""CSV files whose columns are found by name, whatever their order in each file.

A reader takes the columns of all its files by position. So files are grouped by
their header line, each group gets a reader with a schema in the order of its own
header, and the groups are put together by name. Only the first line of a file is
read to group it; pruning and pushed filters work as with one reader.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Headers that are read at the same time.
READERS = 16
_SPECIAL = str.maketrans({c: "\\" + c for c in "\\{}[]*?"})


def _first_record(spark: SparkSession, uri: str) -> tuple[str, list[str]]:
    """A file's path and the fields of its first line, none if it is empty."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        plain = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        lines = [reader.readLine()]
        # a quoted name may hold a line break
        while lines[-1] is not None and "".join(lines).count('"') % 2:
            lines.append(reader.readLine())
    finally:
        stream.close()
    text = "\n".join(x for x in lines if x is not None).removeprefix("\ufeff")
    return path.toString(), next(csv.reader([text], strict=True), []) if text else []


def csv_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, tuple[str, ...]]:
    """The column names of every file that is not empty, by file."""
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(READERS) as pool:
        found = list(pool.map(lambda f: _first_record(spark, f), sorted(files)))
    out = {}
    for file, names in found:
        if not names:
            continue
        named = tuple(n or f"_c{i}" for i, n in enumerate(names))
        if len(set(named)) < len(named):
            raise ValueError(f"{file} has a column name twice: {', '.join(named)}")
        out[file] = named
    if not out:
        raise FileNotFoundError(f"no CSV file with a header in {path}")
    return out


def _common(types: Iterable[T.DataType]) -> T.DataType:
    """A type that holds the values of all."""
    kinds = list(types)
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return T.LongType()
    return T.DoubleType() if all(isinstance(k, T.NumericType) for k in kinds) else T.StringType()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_csv_by_name(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    extra: bool = True,
    missing: bool = True,
    file_name: str | None = None,
) -> DataFrame:
    """Rows of all files of ``path`` (a file, folder, pattern or list), by column name.

    ``schema``: declared types; a value that does not fit fails the job. Columns that
    a file lacks are null, or an error without ``missing``; further columns are kept
    as text behind the declared ones, or left out without ``extra``. Without a schema
    types are inferred, for columns of different types the one that holds all.
    ``file_name`` names a column for the file each row came from. Empty files are
    skipped; a path without any header is an error. A quote inside quotes is doubled.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in csv_headers(spark, path).items():
        groups.setdefault(names, []).append(file)
    declared = None
    if schema is not None:
        struct = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        declared = {f.name: f.dataType for f in struct.fields}
        for names, files in groups.items():
            gone = [c for c in declared if c not in names]
            if gone and not missing:
                raise ValueError(f"{files[0]} lacks {', '.join(gone)}")

    parts = []
    for names, files in groups.items():
        reader = spark.read.options(
            header=True, mode="FAILFAST", escape='"', multiLine=any("\n" in n for n in names)
        )
        if declared is None:
            reader = reader.option("inferSchema", True)
        else:
            reader = reader.schema(T.StructType(
                [T.StructField(n, declared.get(n, T.StringType())) for n in names]
            ))
        part = reader.csv([f.translate(_SPECIAL) for f in files])
        chosen = [
            F.col(_quoted(c)).alias(n) for c, n in zip(part.columns, names)
            if declared is None or extra or n in declared
        ]
        source = [F.col("_metadata.file_name").alias(file_name)] if file_name else []
        parts.append(part.select(*chosen, *source))

    kinds: dict[str, list[T.DataType]] = {n: [k] for n, k in (declared or {}).items()}
    for p in parts:
        for f in p.schema.fields:
            if f.name != file_name and not (declared and f.name in declared):
                kinds.setdefault(f.name, []).append(f.dataType)
    final = {n: _common(k) for n, k in kinds.items()} | ({file_name: T.StringType()} if file_name else {})
    out = None
    for p in parts:
        same = p.select(*[
            (F.col(_quoted(n)).cast(k) if n in p.columns else F.lit(None).cast(k)).alias(n)
            for n, k in final.items()
        ])
        out = same if out is None else out.unionByName(same)
    return out
