"""CSV and parquet scans, CSV schema inference, and landing raw CSV as parquet."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.setops import union_parts
from .fs import _fs_and_path, committed, complete

# The patterns of one CSV cell (booleans compare case-insensitively).
BOOL_PATTERN = r"(?i)^(true|false)$"
DECIMAL_PATTERN = r"^-?\d+\.\d+$"
INTEGER_PATTERN = r"^-?\d+$"
DATETIME_PATTERN = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$"
# Bytes of a file that are read at once for its header, and files whose headers are read side by side.
HEADER_BYTES = 8192
HEADER_THREADS = 32
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[XXX]"


def _as_paths(path: str | Sequence[str]) -> list[str]:
    paths = [path] if isinstance(path, str) else list(path)
    if not paths:
        raise ValueError("no CSV files")
    return paths


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The first record of a CSV file (its first bytes are read, decompressed where its name says so); () for an empty file."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        source = codec.createInputStream(stream) if codec is not None else stream
        data = b""
        while True:
            more = bytes(source.readNBytes(HEADER_BYTES))
            data += more
            text = data.decode("utf-8", "replace").removeprefix("\ufeff")
            # a line break within quotes belongs to a name
            end = next((i for i, c in enumerate(text) if c in "\r\n" and text.count('"', 0, i) % 2 == 0), None)
            if end is not None or not more:
                return tuple(next(csv.reader([text if end is None else text[:end]]), ()))
    finally:
        stream.close()


def _in_order(spark: SparkSession, paths: list[str], files: list[str]) -> list[str]:
    """Files in the order of the paths that name them or a folder above them, then by name."""
    place = {}
    for i, p in enumerate(paths):
        fs, path = _fs_and_path(spark, p)
        place.setdefault(fs.makeQualified(path).toUri().getPath(), i)

    def key(file: str) -> tuple[int, str]:
        at = unquote(urlsplit(file).path)
        while at not in place and at.strip("/"):
            at = at.rsplit("/", 1)[0]
        return place.get(at, len(paths)), file

    return sorted(files, key=key)


def _read_by_name(spark: SparkSession, paths: list[str], types: dict[str, T.DataType] | None = None) -> DataFrame:
    """CSV files (or folders) with headers as one table, columns matched by name.

    The first bytes of every file are read side by side, without a Spark job; files whose headers list the columns in the same
    order are one read, whatever folder they are in; other orders are read with their own and united by name. Within a
    read Spark checks the header of every file once more. A column outside ``types`` is text.
    """
    files = _in_order(spark, paths, spark.read.text(paths).inputFiles())
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        headers = list(pool.map(lambda f: _header(spark, f), files))
    by_header: dict[tuple, list[str]] = {}
    for f, header in zip(files, headers):
        if header:  # an empty file has no rows either
            by_header.setdefault(header, []).append(f)
    if not by_header:
        raise ValueError(f"no header in {paths}")
    names = next(iter(by_header))
    frames = []
    for header, group in by_header.items():
        if len(set(header)) < len(header):
            raise ValueError(f"columns share a name: {list(header)}")
        if set(header) != set(names):
            raise ValueError(f"headers differ: {list(names)} and {list(header)}")
        schema = T.StructType([T.StructField(n, (types or {}).get(n, T.StringType())) for n in header])
        jvm = spark.sparkContext._jvm
        chosen = paths if len(group) == len(files) else [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in group]
        frames.append(spark.read.schema(schema).csv(chosen, header=True, mode="FAILFAST", enforceSchema=False,
                                                    timestampFormat=TIMESTAMP_FORMAT).select(*[f"`{n}`" for n in names]))
    return union_parts(frames)


# What a cell can be: empty, one of the patterns (no text meets two of them), or any other text. One bit for each.
PATTERNS = {"integer": INTEGER_PATTERN, "decimal": DECIMAL_PATTERN, "bool": BOOL_PATTERN, "datetime": DATETIME_PATTERN}
KINDS = {k: 1 << i for i, k in enumerate(("empty", *PATTERNS, "other"))}


def _facts(text: DataFrame) -> list:
    """For each text column, the kinds of cells it has. A cell is tried against one pattern after the other until one fits."""
    aggs = []
    for i, name in enumerate(text.columns):
        cell = F.col(f"`{name}`")
        kind = F.when(F.coalesce(cell == "", F.lit(True)), KINDS["empty"])
        for k, pattern in PATTERNS.items():
            kind = kind.when(cell.rlike(pattern), KINDS[k])
        aggs.append(F.bit_or(kind.otherwise(KINDS["other"])).alias(f"kinds{i}"))
    return aggs


def _typed(columns: list[str], found: dict) -> T.StructType:
    """The schema that those facts give."""
    fields = []
    for i, name in enumerate(columns):
        kinds = {k for k, bit in KINDS.items() if (found[f"kinds{i}"] or 0) & bit}
        filled = kinds - {"empty"}
        kind = (T.StringType() if not filled else T.LongType() if filled == {"integer"} else
                T.DoubleType() if filled <= {"integer", "decimal"} else T.BooleanType() if filled == {"bool"} else
                T.TimestampType() if filled == {"datetime"} else T.StringType())
        fields.append(T.StructField(name, kind, "empty" in kinds))
    return T.StructType(fields)


def _scan_types(schema: T.StructType) -> T.StructType:
    """Column types of the single-file scan: date-times stay text."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType, True)
                         for f in schema.fields])


def csv_infer(spark: SparkSession, path: str | Sequence[str], rows: int | None = None) -> T.StructType:
    """Schema of one or many CSV files from every cell (or, when asked, the first ``rows`` records).

    A column whose non-empty cells are all integers is long; integers and decimals make a double; true and
    false a boolean; date-times a timestamp; anything else, or no value at all, is a string. A column is
    nullable iff it has an empty cell.
    """
    text = _read_by_name(spark, _as_paths(path))
    return _typed(text.columns, (text if rows is None else text.limit(rows)).agg(*_facts(text)).first().asDict())


def infer_csv_schema(spark: SparkSession, path: str | Sequence[str], rows: int | None = None) -> T.StructType:
    """Column types of the single-file scan: those of ``csv_infer``, but date-times stay text."""
    return _scan_types(csv_infer(spark, path, rows))


def csv_scan(spark: SparkSession, path: str | Sequence[str], infer_rows: int | None = None,
             schema: T.StructType | str | None = None) -> DataFrame:
    """CSV read with a header; types from all rows, unless a schema or ``infer_rows`` is given.

    Inference reads the files once more; pass a schema where that is too dear. A missing path raises
    (Spark's PATH_NOT_FOUND).
    """
    if schema is None:
        schema = infer_csv_schema(spark, path, infer_rows)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return _read_by_name(spark, _as_paths(path), {f.name: f.dataType for f in schema.fields}).select(
        *[f"`{f.name}`" for f in schema.fields])


def csv_multi_scan(spark: SparkSession, paths: Sequence[str],
                   schema: T.StructType | None = None) -> DataFrame:
    """Many CSV files as one table with one schema (given, or ``csv_infer`` of all of them).

    Columns are matched by the names in each file's header. Empty cells are NULL for non-string columns
    and ``''`` for string columns. Zone-less datetimes are read as UTC instants.
    """
    paths = _as_paths(paths)
    if schema is None:
        schema = csv_infer(spark, paths)
    df = _read_by_name(spark, paths, {f.name: f.dataType for f in schema.fields})
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        out.append((F.coalesce(c, F.lit("")) if isinstance(f.dataType, T.StringType) else c)
                   .alias(f.name))
    return df.select(*out)


def parquet_scan(spark: SparkSession, path: str | Sequence[str],
                 options: dict | None = None) -> DataFrame:
    """Lazy parquet read (``file:``, ``hdfs:``, ``s3a:`` …); nothing is read until an action.

    Object-store endpoints and keys go in ``options`` as ``fs.s3a.*`` Hadoop
    settings and are applied to this session's Hadoop configuration.
    """
    options = dict(options or {})
    hadoop = {k: v for k, v in options.items() if k.startswith("fs.")}
    if hadoop:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for k, v in hadoop.items():
            conf.set(k, str(v))
    reader = spark.read
    for k, v in options.items():
        if not k.startswith("fs."):
            reader = reader.option(k, v)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def land_raw(spark: SparkSession, source_path: str, raw_dir: str,
             csv_name: str = "census.csv", parquet_name: str = "census.parquet",
             preview: int = 5) -> DataFrame:
    """Land a raw CSV in ``raw_dir`` (unless already there) and archive it as parquet.

    ``source_path`` is any Hadoop path. The CSV is copied unless ``raw_dir/csv_name``
    is complete: a plain file, or a folder with the ``_SUCCESS`` marker of a
    finished write (a half-written one is landed anew). Cells are copied as they
    are, and the copy finds the column types as it goes, so landing is two passes:
    the copy and the archive. The parquet archive is written when it has no such
    marker. Returns the landed table, read from the parquet archive.
    """
    raw_dir = raw_dir.rstrip("/")
    csv_path = f"{raw_dir}/{csv_name}"
    parquet_path = f"{raw_dir}/{parquet_name}"
    landed_now = not complete(spark, csv_path)
    schema = None
    if landed_now:
        cells = _read_by_name(spark, _as_paths(source_path))
        seen = Observation()
        cells.observe(seen, *_facts(cells)).write.mode("overwrite").csv(csv_path, header=True)
        schema = _scan_types(_typed(cells.columns, seen.get))
    if landed_now or not committed(spark, parquet_path):
        csv_scan(spark, csv_path, schema=schema).write.mode("overwrite").parquet(parquet_path)
    landed = spark.read.parquet(parquet_path)
    if preview:
        landed.limit(preview).collect()
    return landed
