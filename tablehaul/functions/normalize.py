"""Table-wide type normalisation: one Catalyst expression per column, no UDFs.

``normalize_table(df, source, target, types)`` rewrites every column of a table
read from ``source`` (postgres, mysql, mssql, oracle, sqlite, bigquery, trino,
csv, generator) into the representation ``target`` ("arrow" or "pandas") uses.
``types`` declares the source type of columns whose Spark type does not say it
(a uuid or json that arrived as text, a MySQL TINYINT, an unsigned BIGINT …);
other columns are classified from their Spark type.

Every rule accepts the value either already typed (as Spark's JDBC reader
maps it) or as text (CSV / text protocols), and is a plain column expression,
so a normalisation is one narrow projection fused into the scan's stage.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Saturation bounds for 'infinity' / '-infinity' temporal values.
DATE_MAX, DATE_MIN = "9999-12-31", "0001-01-01"
TS_MAX, TS_MIN = "9999-12-31 23:59:59.999999", "0001-01-01 00:00:00"
# Fixed value: the decimal type of Postgres numerics in Arrow output.
ARROW_DECIMAL = T.DecimalType(38, 10)

# Text formats of temporal values delivered as text.
TRINO_DATE = "yyyy-MM-dd"
TRINO_TIMESTAMP = "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]"
TIME_TEXT = "HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]"
ORACLE_DATE = "yyyy-MM-dd[ HH:mm:ss]"
BIGQUERY_DATETIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]"
BIGQUERY_TIME = "HH:mm:ss"

TEXT_TYPES = {"text", "varchar", "bpchar", "char", "name", "enum", "citext", "ltree", "lquery",
              "ltxtquery", "string", "nvarchar", "nchar", "ntext", "varchar2", "nvarchar2",
              "character", "character varying", "clob", "nclob", "long", "rowid", "longtext",
              "mediumtext", "tinytext", "set", "xml", "interval", "geography", "inet", "cidr",
              "macaddr"}
INT_TYPES = {"int2": T.ShortType(), "smallint": T.ShortType(), "int4": T.IntegerType(),
             "int": T.IntegerType(), "integer": T.IntegerType(), "int8": T.LongType(),
             "bigint": T.LongType(), "tinyint": T.ByteType(), "mediumint": T.IntegerType(),
             "year": T.ShortType(), "oid": T.LongType(), "int64": T.LongType(),
             "serial": T.IntegerType(), "bigserial": T.LongType()}
UNSIGNED = re.compile(r"^(tinyint|smallint|mediumint|int|integer|bigint) unsigned$")
ARRAY_ELEMS = {"_int2": T.ShortType(), "_int4": T.IntegerType(), "_int8": T.LongType(),
               "_float4": T.FloatType(), "_float8": T.DoubleType(), "_numeric": ARROW_DECIMAL,
               "_bool": T.BooleanType(), "_text": T.StringType(), "_varchar": T.StringType(),
               "_bpchar": T.StringType(), "_date": T.DateType(), "_timestamp": T.TimestampNTZType()}
# Types that take a length or precision which changes nothing in the mapping.
WITH_LENGTH = re.compile(r"^(varchar|char|bpchar|nvarchar|nchar|varchar2|nvarchar2|character varying|character|"
                         r"raw|binary|varbinary|float|tinyint|smallint|mediumint|int|integer|bigint|timestamp|"
                         r"timestamptz|datetime|datetime2|datetimeoffset|time)\s*\(\s*(\d+|max)(\s+(byte|char))?\s*\)(.*)$")


# ---- single-rule column functions ----------------------------------------------------------

def uuid_canonical(c: Column) -> Column:
    """Any spelling (braces, hyphens anywhere, upper case) -> lower-case 8-4-4-4-12; other text raises."""
    hexs = F.lower(F.translate(c.cast("string"), "{}-", ""))
    dashed = F.concat_ws("-", *[F.substring(hexs, start, size)
                                for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return (F.when(hexs.rlike("^[0-9a-f]{32}$"), dashed)
            .when(c.isNotNull(), F.raise_error(F.concat(F.lit("not a uuid: "), c.cast("string"))).cast("string")))


def json_compact(c: Column) -> Column:
    """JSON text -> compact JSON text (object keys sorted, numbers canonical).

    Text that does not parse strictly (an object with a key twice, say, which a text-preserving JSON type
    may hold) keeps its own text, trimmed: one odd document never fails the job.
    """
    text = c.cast("string")
    return F.coalesce(F.to_json(F.try_parse_json(text)), F.trim(text))


def map_json(c: Column) -> Column:
    """map<string, string?> (hstore) -> JSON object text, NULL values kept."""
    return F.to_json(c)


def time_text(c: Column) -> Column:
    """A time of day as ``HH:mm:ss`` plus ``.ffffff`` when there are microseconds."""
    ts = c if not isinstance(c, str) else F.col(c)
    micros = F.unix_micros(ts.cast("timestamp")) % 1_000_000
    return F.concat(F.date_format(ts, "HH:mm:ss"),
                    F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
                    .otherwise(F.lit("")))


def bool_text(c: Column) -> Column:
    """'t' / 'true' / '1' and 'f' / 'false' / '0' in any case, '' as NULL; anything else raises."""
    word = F.lower(F.trim(c))
    return (F.when(c.isNull() | (word == ""), F.lit(None).cast("boolean"))
            .when(word.isin("t", "true", "1"), F.lit(True)).when(word.isin("f", "false", "0"), F.lit(False))
            .otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), c)).cast("boolean")))


def array_text(c: Column, elem: T.DataType) -> Column:
    """Postgres array text ``{a,"b,c",NULL}`` -> array (NULL elements kept); ``{}`` -> empty;
    ``''`` -> NULL; other text shorter than ``{}`` raises. Commas, quotes and backslashes in a quoted
    element are its own."""
    body = F.substring(c, F.lit(2), F.length(c) - 2)  # strip the braces
    # an element, quoted or plain, up to the comma or the end
    parts = F.regexp_extract_all(F.concat(body, F.lit(",")), F.lit(r'\s*("(?:[^"\\]|\\.)*"|[^",]*)\s*,'), F.lit(1))

    def item(x):
        t = F.trim(x)
        bare = F.regexp_replace(F.substring(t, F.lit(2), F.length(t) - 2), r"\\(.)", "$1")
        return (F.when(t == "NULL", F.lit(None)).when(t.startswith('"'), bare).otherwise(t)).cast(elem)

    items = F.transform(parts, item)
    return (F.when(c.isNull() | (c == ""), F.lit(None).cast(T.ArrayType(elem)))
            .when(c == "{}", F.array().cast(T.ArrayType(elem)))
            .when(F.length(c) < 3, F.raise_error(F.concat(F.lit("bad array text: "), c))
                  .cast(T.ArrayType(elem)))
            .otherwise(items))


def sparsevec_dense(c: Column) -> Column:
    """``{i:v,…}/dim`` (1-based) -> dense array<float> with zeros filled in."""
    dim = F.regexp_extract(c, r"/(\d+)$", 1).cast("int")
    places = F.regexp_extract_all(c, F.lit(r"(\d+)\s*:"), F.lit(1)).cast("array<int>")
    values = F.regexp_extract_all(c, F.lit(r":\s*([^,}]+)"), F.lit(1)).cast("array<float>")
    entries = F.array_sort(F.zip_with(places, values, lambda p, v: F.struct(p.alias("at"), v.alias("v"))))

    def zeros(n):
        return F.array_repeat(F.lit(0.0).cast("float"), n.cast("int"))

    def run(e, k):  # the zeros before an entry, and the entry
        before = F.when(k > 0, F.element_at(entries, k)["at"]).otherwise(F.lit(0))
        return F.array_append(zeros(e["at"] - before - 1), e["v"])

    last = F.when(F.size(entries) > 0, F.element_at(entries, -1)["at"]).otherwise(F.lit(0))
    return F.when(c.isNull(), F.lit(None).cast("array<float>")).otherwise(
        F.concat(F.flatten(F.transform(entries, run)), zeros(dim - last)))


def bits_packed(c: Column) -> Column:
    """Bit text ``1010101010`` -> bytes, first bit most significant, last byte zero-padded."""
    nbytes = F.ceil(F.length(c) / 8).cast("int")
    padded = F.rpad(c, nbytes * 8, "0")
    hexes = F.transform(F.sequence(F.lit(0), nbytes - 1),
                        lambda i: F.lpad(F.conv(F.substring(padded, i * 8 + 1, 8), 2, 16), 2, "0"))
    return F.when(c.isNull(), F.lit(None).cast("binary")).otherwise(
        F.unhex(F.array_join(hexes, "")))


def bytea_hex(c: Column) -> Column:
    """Postgres ``\\x…`` hex text -> binary."""
    return F.unhex(F.regexp_replace(c, r"^\\x", ""))


def saturate_infinity(c: Column, kind: str) -> Column:
    """'infinity' / '-infinity' -> the type's max / min, then a regular cast of the rest."""
    text = F.lower(F.trim(c.cast("string")))
    hi, lo, cast = {"date": (DATE_MAX, DATE_MIN, "date"),
                    "timestamp": (TS_MAX, TS_MIN, "timestamp_ntz"),
                    "timestamptz": (TS_MAX, TS_MIN, "timestamp"),
                    "numeric": ("9" * 28 + "." + "9" * 10, "-" + "9" * 28 + "." + "9" * 10,
                                ARROW_DECIMAL)}[kind]
    return (F.when(text.isin("infinity", "+infinity"), F.lit(hi).cast(cast))
            .when(text == "-infinity", F.lit(lo).cast(cast))
            .otherwise(c.cast(cast)))


def epoch_text_timestamp(c: Column) -> Column:
    """Epoch seconds as decimal text -> timestamp, exact to the microsecond (no float)."""
    return F.timestamp_micros((c.cast("decimal(20,6)") * 1_000_000).cast("bigint"))


# ---- the rule table ------------------------------------------------------------------------

def _declared(name: str) -> str:
    """A declared type name in lower case, without a length or precision that changes nothing."""
    name = re.sub(r"\s+", " ", name.strip().lower())
    m = WITH_LENGTH.match(name)
    if m:
        return (m[1] + m[5]).strip()
    return name


def _spark_kind(dt: T.DataType) -> str:
    """A source-type name for a column that was not declared."""
    if isinstance(dt, T.ByteType):
        return "tinyint"
    if isinstance(dt, T.ShortType):
        return "int2"
    if isinstance(dt, T.IntegerType):
        return "int4"
    if isinstance(dt, T.LongType):
        return "int8"
    if isinstance(dt, T.FloatType):
        return "float4"
    if isinstance(dt, T.DoubleType):
        return "float8"
    if isinstance(dt, T.DecimalType):
        return f"numeric({dt.precision},{dt.scale})"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, T.StringType):
        return "text"
    if isinstance(dt, T.BinaryType):
        return "bytea"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, T.TimestampNTZType):
        return "timestamp"
    if isinstance(dt, T.TimestampType):
        return "timestamptz"
    if isinstance(dt, T.MapType):
        return "hstore"
    if isinstance(dt, T.TimeType):
        return "time"
    if isinstance(dt, T.ArrayType):
        return "array"
    return "other"


def normalize_column(df: DataFrame, name: str, source: str, target: str = "arrow",
                     src_type: str | None = None, u64: str = "double") -> Column:
    """The normalised value of column ``name`` (aliased to the same name).

    ``u64="decimal"`` keeps unsigned 64-bit values exact as decimal(20,0)
    instead of the lossy double of the reference mapping.
    """
    source, target = source.lower(), target.lower()
    if source in ("redshift", "postgresql"):
        source = "postgres"
    if target not in ("arrow", "pandas"):
        raise ValueError(f"unknown target {target!r}")
    field = df.schema[name]
    c = F.col(f"`{name}`")
    t = _declared(src_type) if src_type else _spark_kind(field.dataType)
    is_text = isinstance(field.dataType, T.StringType)
    pg_arrow = source == "postgres" and target == "arrow"

    def out(e):
        return e.alias(name)

    # integers
    if t in INT_TYPES:
        if source == "mysql" and t == "tinyint":
            return out(c.cast("long") != 0 if target == "arrow" else c.cast("long"))
        if pg_arrow and t != "oid":
            return out(c.cast(INT_TYPES[t]))
        return out(c.cast("long"))
    m = UNSIGNED.match(t)
    if m:
        if m.group(1) != "bigint":
            return out(c.cast("long"))
        return out(c.cast(T.DecimalType(20, 0)) if u64 == "decimal" else c.cast("double"))
    # floats
    if t in ("float4", "real", "float", "smallmoney", "binary_float"):
        keep = (pg_arrow and t != "float") or (source == "mssql" and t in ("real", "smallmoney") and target == "arrow")
        return out(c.cast("float" if keep else "double"))
    if t in ("float8", "double", "double precision", "money", "float64", "binary_double"):
        return out(c.cast("double"))
    # decimals
    dm = re.match(r"^(numeric|decimal|number|bignumeric|bigdecimal|dec)(\s*\((\d+|\*)(,\s*(-?\d+))?\))?$", t)
    if dm:
        # a precision alone means scale 0; neither means any scale
        scale = int(dm.group(5)) if dm.group(5) is not None else 0 if dm.group(3) not in (None, "*") else None
        if source == "oracle":
            return out(c.cast("long") if scale == 0 else c.cast("double"))
        if pg_arrow:
            return out(saturate_infinity(c, "numeric") if is_text else c.cast(ARROW_DECIMAL))
        return out(c.cast("double"))
    # booleans
    if t in ("bool", "boolean", "bit(1)") or (t == "bit" and source in ("mssql", "mysql")):
        return out(bool_text(c) if is_text else c.cast("boolean"))
    # text-like
    if t in ("uuid", "uniqueidentifier"):
        return out(uuid_canonical(c))
    if t in ("json", "jsonb"):
        return out(json_compact(c))
    if t == "hstore":
        return out(map_json(c) if isinstance(field.dataType, T.MapType) else c.cast("string"))
    if t in TEXT_TYPES:
        return out(c.cast("string"))
    if t in ("blob", "longblob", "mediumblob", "tinyblob", "blob_utf8"):
        return out(c.cast("string") if t == "blob_utf8" else c.cast("binary"))
    if t in ("bytea", "binary", "varbinary", "bytes", "image", "raw", "long raw", "bfile"):
        if source == "bigquery" and t == "bytes":
            return out(c.cast("string"))
        return out(bytea_hex(c) if is_text else c.cast("binary"))
    # temporal
    if t == "date" and source == "oracle":  # it has a time of day
        return out(F.to_timestamp_ntz(c, F.lit(ORACLE_DATE)) if is_text else c.cast("timestamp_ntz"))
    if t == "date":
        if is_text:
            e = saturate_infinity(c, "date") if source == "postgres" else F.to_date(c, TRINO_DATE)
        else:
            e = c.cast("date")
        if target == "pandas":
            e = e.cast("timestamp_ntz")
        return out(e)
    if t in ("timestamp", "datetime", "datetime2", "smalldatetime"):
        if not is_text:
            e = c.cast("timestamp_ntz")
        elif source == "postgres":
            e = saturate_infinity(c, "timestamp")
        elif source == "bigquery" and t == "timestamp":
            e = epoch_text_timestamp(c)  # an instant, delivered as epoch seconds
        elif source == "bigquery":
            e = F.to_timestamp_ntz(c, F.lit(BIGQUERY_DATETIME))
        else:
            e = F.to_timestamp_ntz(c, F.lit(TRINO_TIMESTAMP))
        return out(e)
    if t in ("timestamptz", "timestamp with time zone", "timestamp with local time zone", "datetimeoffset"):
        if is_text:
            e = saturate_infinity(c, "timestamptz") if source == "postgres" else c.cast("timestamp")
        else:
            e = c.cast("timestamp")
        if target == "pandas":
            # the UTC wall clock of the instant, whatever the session zone
            e = F.convert_timezone(None, F.lit("UTC"), e.cast("timestamp_ntz"))
        return out(e)
    if t in ("time", "timetz", "time with time zone", "time without time zone"):
        typed = isinstance(field.dataType, T.TimeType)
        if target == "pandas":
            return out(time_text(F.to_timestamp_ntz(c.cast("string"), F.lit(TIME_TEXT))
                                 if is_text or typed else c))
        return out(c if typed else c.cast("time") if is_text else time_text(c).cast("time"))
    # arrays and vectors
    if t in ARRAY_ELEMS:
        elem = ARRAY_ELEMS[t]
        if target == "pandas" and isinstance(elem, (T.FloatType, T.DecimalType)):
            elem = T.DoubleType()
        return out(array_text(c, elem) if is_text else c.cast(T.ArrayType(elem)))
    if t in ("vector", "halfvec"):
        elem = "double" if target == "pandas" else "float"
        return out(array_text(F.regexp_replace(F.regexp_replace(c, r"^\[", "{"), r"\]$", "}"),
                              T.FloatType()).cast(f"array<{elem}>")
                   if is_text else c.cast(f"array<{elem}>"))
    if t == "sparsevec":
        e = sparsevec_dense(c)
        return out(e.cast("array<double>") if target == "pandas" else e)
    if re.match(r"^(bit|bit varying|varbit)(\s*\(\d+\))?$", t):
        return out(bits_packed(c) if is_text else c.cast("binary"))
    if t == "array":
        elem = field.dataType.elementType
        if target == "pandas" and isinstance(elem, (T.FloatType, T.DecimalType)):
            return out(c.cast("array<double>"))
        return out(c)
    if src_type:
        raise ValueError(f"no rule for the declared type {src_type!r} of column {name!r}")
    return out(c)  # a type that no rule touches, as Spark read it


def normalize_table(df: DataFrame, source: str, target: str = "arrow",
                    types: dict | None = None, partitions: int | None = None,
                    u64: str = "double") -> DataFrame:
    """Every column through its rule, in one projection.

    Text parsing (JSON, arrays, regexes) is CPU-heavy per row: for an input in
    few splits, ``partitions`` deals the rows over so many tasks first. A declared
    type without a rule raises.
    """
    types = {k: v for k, v in (types or {}).items()}
    unknown = set(types) - set(df.columns)
    if unknown:
        raise KeyError(f"declared types for missing columns: {sorted(unknown)}")
    if partitions:
        df = df.repartition(partitions)
    return df.select(*[normalize_column(df, n, source, target, types.get(n), u64)
                       for n in df.columns])


def empty_as_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The CSV-protocol rule: ``''`` and NULL are the same value (opt in per column)."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*[F.nullif(F.col(f"`{n}`"), F.lit("")).alias(n) if n in cols
                       else F.col(f"`{n}`") for n in df.columns])


def resolve_dynamic(df: DataFrame, declared: dict | None = None, order_by: str | None = None) -> DataFrame:
    """Types of text columns from a dynamically typed source (SQLite rule).

    A declared type wins (by its name: BOOL -> boolean, DATE -> date, TIME -> time, DATETIME and
    TIMESTAMP -> timestamp; else by affinity: INT -> long, CHAR/CLOB/TEXT -> string, BLOB -> binary,
    REAL/FLOA/DOUB and all others -> double). Otherwise the first non-NULL
    value (in ``order_by`` order) decides: integer text -> long, decimal text ->
    double, else string. A column with no rows is string; a column whose
    values are all NULL raises. The first values are found with one
    aggregation (``min_by`` per column), so nothing but one row reaches the driver.
    """
    declared = {k: v.upper() for k, v in (declared or {}).items()}
    todo = [n for n in df.columns if n not in declared]
    firsts = {}
    if todo:
        key = F.col(order_by) if order_by else F.monotonically_increasing_id()
        keyed = df.withColumn("__tablehaul_order", key)
        row = keyed.agg(*[F.min_by(F.col(f"`{n}`"), F.when(F.col(f"`{n}`").isNotNull(),
                                                            F.col("__tablehaul_order")))
                          .alias(n) for n in todo], F.count(F.lit(1)).alias("__rows")).first()
        empty = row["__rows"] == 0
        for n in todo:
            v = row[n]
            if v is None and not empty:
                raise ValueError(f"cannot resolve the type of {n!r}: every value is NULL")
            firsts[n] = v

    def affinity(decl: str) -> str:
        named = {"BOOL": "boolean", "BOOLEAN": "boolean", "DATE": "date", "TIME": "time",
                 "DATETIME": "timestamp_ntz", "TIMESTAMP": "timestamp_ntz"}.get(re.sub(r"\s*\(.*", "", decl.strip()))
        if named:
            return named
        if "INT" in decl:
            return "long"
        if any(k in decl for k in ("CHAR", "CLOB", "TEXT")):
            return "string"
        if "BLOB" in decl:
            return "binary"
        if any(k in decl for k in ("REAL", "FLOA", "DOUB")):
            return "double"
        return "double"  # numeric affinity

    cols = []
    for n in df.columns:
        if n in declared:
            kind = affinity(declared[n])
        else:
            v = firsts[n]
            if v is None:
                kind = "string"
            elif re.match(r"^-?\d+$", str(v)):
                kind = "long"
            elif re.match(r"^-?(\d+\.\d*|\.\d+|\d+)([eE][-+]?\d+)?$", str(v)):
                kind = "double"
            else:
                kind = "string"
        c = F.col(f"`{n}`")
        text = isinstance(df.schema[n].dataType, T.StringType)
        cols.append((bool_text(c) if kind == "boolean" and text else c.cast(kind)).alias(n))
    return df.select(*cols)
