"""A page index: a table in a total order, in written ranges, so that a page at any depth reads one or two of them.

``build`` deals the rows out by the order (``order_by``, then all other columns, then a number that tells equal rows
apart, so a run of equal rows is cut as well) into parts of about PART_ROWS rows, sorts each part, and writes it to a folder of its own
with each row's place in its part. A range is ``range_rows`` rows of a part, one page of its Parquet file. Then it counts the rows of the
parts (from the files' footers) and writes the fences: for each range its part, its first key, how many rows lie before it and how many in
it. What the driver and the tasks learn of the order is for each part, not each range: small ranges make no more of them.

``page(offset, n)`` looks up the ranges that hold these rows among the fences and reads their parts' folders alone, with the places as
a filter that Parquet's statistics serve. Page 1 and page 10,000 cost the same. ``seek`` gives the offset of a key,
so a reader can go on from a key too. No task ranks more than the rows of one part.

An index belongs to one table: build it anew, in another folder, when the table changes. ``build`` runs when it is called.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.fs import committed, read_note, write_note
from .axis import orderable

RANGE_ROWS = 200_000
PART_ROWS = 200_000  # of a part, where ranges are smaller
PLACE_BITS = 33
LAYOUT = "parts"  # of the written files


def _keys(order_by: str | Sequence[str]) -> list[str]:
    return [order_by] if isinstance(order_by, str) else list(order_by)


class PageIndex:
    """A written index; ``build`` makes one, ``open`` finds it again."""

    def __init__(self, spark: SparkSession, path: str, order_by: list[str], schema: T.StructType):
        self.spark, self.path, self.order_by, self.schema = spark, path.rstrip("/"), order_by, schema

    @classmethod
    def build(cls, df: DataFrame, order_by: str | Sequence[str], path: str, range_rows: int = RANGE_ROWS) -> "PageIndex":
        """Index ``df`` under ``path``. Columns that can't be ordered (maps) don't count in the order of ties."""
        spark, keys, path = df.sparkSession, _keys(order_by), path.rstrip("/")
        if not keys or any(k not in df.columns for k in keys):
            raise ValueError(f"no such order: {keys}")
        order = [*keys, *(c for c in orderable(df) if c not in keys)]
        parts = max(1, -(-df.count() // (range_rows * max(1, PART_ROWS // range_rows))))
        dealt = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(parts, *[f"`{c}`" for c in order], "_salt")
        # within a task these ids count up in the order of the rows: the part above, the place below
        at = dealt.sortWithinPartitions(*[f"`{c}`" for c in order], "_salt").withColumn("_id", F.monotonically_increasing_id())
        at = at.withColumn("_part", F.shiftright("_id", PLACE_BITS).cast("int")).withColumn(
            "_place", F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
        # in the order that a write by folders asks for, so that it adds none of its own
        at = at.drop("_salt", "_id").sortWithinPartitions("_part", "_place")
        at.write.mode("overwrite").partitionBy("_part").option("parquet.page.row.count.limit", range_rows).parquet(f"{path}/rows")
        written = spark.read.schema(cls._stored(df.schema).add("_part", T.IntegerType())).parquet(f"{path}/rows")
        first = written.where(F.col("_place") % range_rows == 0).select("_part", F.col("_place").alias("start"), F.struct(*keys).alias("first"))
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
        counts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("rows")).withColumn("above", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        fences = first.join(counts, "_part").select(
            "_part", "start", "first", (F.col("above") + F.col("start")).alias("before"),
            F.least(F.lit(range_rows).cast("long"), F.col("rows") - F.col("start")).alias("n"))
        fences.write.mode("overwrite").parquet(f"{path}/fences")
        write_note(spark, f"{path}/fences", {"order_by": keys, "schema": df.schema.json(), "layout": LAYOUT})
        return cls(spark, path, keys, df.schema)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "PageIndex":
        """The index that was built under ``path``."""
        path = path.rstrip("/")
        note = read_note(spark, f"{path}/fences") if committed(spark, f"{path}/fences") else None
        if note is None:
            raise ValueError(f"no finished index at {path}")
        if note.get("layout") != LAYOUT:
            raise ValueError(f"{path} holds an index of another layout: build it anew")
        return cls(spark, path, note["order_by"], T.StructType.fromJson(json.loads(note["schema"])))

    @staticmethod
    def _stored(schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField("_place", T.LongType())])

    def fences(self) -> DataFrame:
        """(_part, start, first, before, n): one row per range; it begins at that place of its part."""
        keys = T.StructType([f for k in self.order_by for f in self.schema.fields if f.name == k])
        kind = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("first", keys),
                             T.StructField("before", T.LongType()), T.StructField("n", T.LongType())])
        return self.spark.read.schema(kind).parquet(f"{self.path}/fences")

    def count(self) -> int:
        return self.fences().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def page(self, offset: int, n: int, number: str | None = None) -> DataFrame:
        """Rows ``offset`` to ``offset + n - 1`` of the order, sorted; with ``number`` a column for the row's number (from 0)."""
        if offset < 0 or n < 0:
            raise ValueError("offset and n must be >= 0")
        meets = (F.col("before") < offset + n) & (F.col("before") + F.col("n") > offset)
        # the parts of a page's ranges: one or two, more only where the page is longer than a part
        above = (F.col("before") - F.col("start")).alias("above")
        hit = self.fences().where(meets).select("_part", above).distinct().orderBy("_part").collect() if n else []
        names = [f"`{f.name}`" for f in self.schema.fields]
        shown = [*names, F.col("_row").alias(number)] if number else names
        if not hit:
            empty = self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("_row", T.LongType())]))
            return empty.select(*shown)
        rows = None
        for r in hit:
            part = self.spark.read.schema(self._stored(self.schema)).parquet(f"{self.path}/rows/_part={r['_part']}")
            inside = (F.col("_place") >= offset - r["above"]) & (F.col("_place") < offset + n - r["above"])
            part = part.where(inside).withColumn("_row", F.col("_place") + F.lit(r["above"]))
            rows = part if rows is None else rows.unionAll(part)
        return rows.orderBy("_row").select(*shown)

    def first(self, n: int) -> DataFrame:
        """The first ``n`` rows as a table without an order: whole parts, and some of the last one."""
        cut = self.fences().where(F.col("before") < n).agg(F.max(F.struct("_part", "start", "before"))).first()[0]
        if cut is None or n <= 0:
            return self.page(0, 0)
        stored = self._stored(self.schema).add("_part", T.IntegerType())
        rows = self.spark.read.schema(stored).parquet(f"{self.path}/rows")
        whole = F.col("_part") < cut["_part"]
        part = (F.col("_part") == cut["_part"]) & (F.col("_place") < n - cut["before"] + cut["start"])
        return rows.where(whole | part).select(*[f"`{f.name}`" for f in self.schema.fields])

    def seek(self, values) -> int:
        """The number of rows whose keys come before ``values``: the offset of the first row at or after them."""
        given = list(values) if isinstance(values, (tuple, list)) else [values]
        if len(given) != len(self.order_by):
            raise ValueError("seek needs one value per order column")
        kinds = {f.name: f.dataType for f in self.schema.fields}
        key = F.struct(*[F.lit(v).cast(kinds[k]).alias(k) for k, v in zip(self.order_by, given)])
        # the last range that begins before the key has the border; all rows of earlier ones come before it
        cut = self.fences().where(F.col("first") < key).agg(F.max(F.struct("_part", "start", "before", "n"))).first()[0]
        if cut is None:
            return 0
        part = self.spark.read.schema(self._stored(self.schema)).parquet(f"{self.path}/rows/_part={cut['_part']}")
        part = part.where((F.col("_place") >= cut["start"]) & (F.col("_place") < cut["start"] + cut["n"]))
        return cut["before"] + part.where(F.struct(*[F.col(f"`{k}`") for k in self.order_by]) < key).count()
