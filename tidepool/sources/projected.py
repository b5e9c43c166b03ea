"""A projected table as a scan (S7): partitions computed, not listed.

The projection says which partitions can exist: an enumeration of symbols and a
range of hours (or days).  This Python data source makes its tasks from that grid
and the predicate alone.  Filters on the partition columns are taken at planning
time; a task opens the folders of its own locations, rendered from the template,
and a folder that is missing is empty.  Nothing above those folders is listed,
however many partitions the table has.

Rows: ``value`` (a line of text, gzip by extension) and the partition columns.
Lines are parsed by Spark's own JSON functions (``read_projected_json``).  The
class is made inside a function so that Spark ships it by value.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas as S
from ..fixed import NEWS_LOCATION_TEMPLATE

STEPS = {"hour": 3600, "day": 86400}


def projected_lines(format_name: str):
    """The data source class."""
    import datetime as dt
    import json

    from pyspark.sql.datasource import (
        DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
        LessThanOrEqual,
    )

    def parts(slot):
        return {"year": slot.year, "month": slot.month, "day": slot.day, "hour": slot.hour}

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.base, self.template = options["path"].rstrip("/"), options["template"]
            self.symbols = json.loads(options["symbols"])
            self.step = int(options["step"])
            self.start, self.end = (dt.datetime.fromisoformat(options[k]) for k in ("start", "end"))
            self.tasks = int(options["tasks"])
            self.tests = []

        def pushFilters(self, filters):  # noqa: N802
            compare = {EqualTo: lambda x, v: x == v, In: lambda x, v: x in v, GreaterThan: lambda x, v: x > v,
                       GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v,
                       LessThanOrEqual: lambda x, v: x <= v}
            for f in filters:
                name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
                if type(f) in compare and name in ("symbol", "year", "month", "day", "hour"):
                    self.tests.append((name, compare[type(f)], f.value))
                yield f  # Spark checks the rows too: a day-wide table has no hours to go by

        def partitions(self):
            symbols = [s for s in self.symbols if all(t(s, v) for n, t, v in self.tests if n == "symbol")]
            ignored = {"symbol"} | ({"hour"} if self.step == 86400 else set())
            at = dt.datetime.fromtimestamp(int(self.start.replace(tzinfo=dt.timezone.utc).timestamp())
                                           // self.step * self.step, dt.timezone.utc).replace(tzinfo=None)
            slots = []
            while at <= self.end:
                p = parts(at)
                if all(t(p[n], v) for n, t, v in self.tests if n not in ignored):
                    slots.append(at)
                at += dt.timedelta(seconds=self.step)
            grid = [(s, x) for s in symbols for x in slots]
            size = max(1, -(-len(grid) // self.tasks))
            return [InputPartition(grid[i:i + size]) for i in range(0, len(grid), size)] or [InputPartition([])]

        def read(self, partition):
            import gzip
            import io

            from pyarrow import fs
            store, root = fs.FileSystem.from_uri(self.base)
            for symbol, slot in partition.value:
                p = parts(slot)
                place = self.template.format(symbol=symbol, year=f"{p['year']:04d}", month=f"{p['month']:02d}",
                                             day=f"{p['day']:02d}", hour=f"{p['hour']:02d}").strip("/")
                found = store.get_file_info(fs.FileSelector(f"{root}/{place}", allow_not_found=True))
                for f in sorted(found, key=lambda f: f.base_name):
                    if f.type != fs.FileType.File or f.base_name[0] in "._":
                        continue
                    with store.open_input_stream(f.path, compression=None) as raw:
                        lines = gzip.GzipFile(fileobj=raw) if f.base_name.endswith(".gz") else raw
                        for line in io.BufferedReader(lines):
                            line = line.rstrip(b"\r\n")
                            if line:
                                yield (line.decode("utf-8", "replace"), symbol, p["year"], p["month"], p["day"],
                                       p["hour"] if self.step == 3600 else None)

    class ProjectedLines(DataSource):
        @classmethod
        def name(cls):
            return format_name

        def schema(self):
            return "value string, symbol string, year int, month int, day int, hour int"

        def reader(self, schema):
            return Reader(self.options)

    return ProjectedLines


def read_projected(spark: SparkSession, path: str, symbols: Sequence[str], start: str, end: str,
                   granularity: str = "hour", template: str = NEWS_LOCATION_TEMPLATE,
                   tasks: int | None = None) -> DataFrame:
    """The lines of the projected partitions in ``[start, end]`` (UTC, both
    inclusive).  ``where`` conditions on symbol, year, month, day and hour leave
    out folders before any is opened.  ``tasks`` bounds the number of tasks (by
    default four a core): neighbouring locations share one.
    """
    name = f"projected_{uuid4().hex}"
    spark.dataSource.register(projected_lines(name))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    import json
    r = spark.read.format(name).option("path", path).option("template", template)
    return (r.option("symbols", json.dumps(list(symbols))).option("start", start).option("end", end)
            .option("step", STEPS[granularity])
            .option("tasks", tasks or 4 * spark.sparkContext.defaultParallelism).load())


def read_projected_json(lines: DataFrame, schema: StructType = S.RAW_NEWS_DATA) -> DataFrame:
    """``read_projected`` rows as typed records: the fields, the partition columns
    (they win over fields of the same name) and ``_corrupt_record``."""
    full = StructType([*schema.fields, StructField(S.CORRUPT_COL, StringType())])
    r = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COL})
    places = [c for c in lines.columns if c != "value"]
    return lines.select(r.alias("r"), *places).select(
        *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields if f.name not in places], *places,
        F.col(f"r.{S.CORRUPT_COL}").alias(S.CORRUPT_COL))
