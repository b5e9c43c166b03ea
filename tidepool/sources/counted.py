"""A folder of text records as a stream admitted by count and age.

Spark's file source admits whole files.  The alerter's batches are counted in
records: a batch leaves as soon as ``maxRecords`` records wait, or when the oldest
of them has waited ``maxSeconds``.  This Python data source does that: an offset
says how many bytes of each file have been admitted, ``latestOffset`` looks no
further than ``maxRecords`` records ahead, and executors read the byte ranges
between two offsets.  Poll it with a short trigger (a second): no batch is made
while nothing is due.

Files are taken by modification time, then by name, and may still grow; a last
line without its line end counts once its file has been still for ``maxSeconds``.
A folder written by Spark's streaming file sink is read by the sink's log, so
files of failed attempts don't count.  Hidden files are skipped.  An offset
names the files of the last ``keepSeconds`` (a day); a file that appears with an
older modification time is not read, as with the file source's ``maxFileAge``.

Rows: ``value`` (the line), ``file``, ``at`` (its byte offset there).

Any store that pyarrow opens by URI can be read (local or mounted folders, HDFS,
object stores).  The class is made inside a function so that Spark ships it by
value, wherever this package is installed.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def counted_lines(format_name: str = "counted_lines"):
    """The data source class."""
    import json
    import time

    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    def opened(path):
        from pyarrow import fs
        return fs.FileSystem.from_uri(path)

    class Reader(DataSourceStreamReader):
        def __init__(self, options):
            self.path = options["path"]
            self.max_records = int(options.get("maxRecords", "100"))
            self.max_seconds = float(options.get("maxSeconds", "30"))
            self.keep = float(options.get("keepSeconds", "86400"))
            self.from_latest = options.get("startingAt", "earliest") == "latest"
            self.at = None      # end of the last planned batch
            self.since = None   # when the records waiting now were first seen

        # ---------------------------------------------------- listing
        def committed(self, store, root):
            """Names in the log of Spark's file sink, or None where the folder has no such log."""
            from pyarrow import fs
            folder = f"{root}/_spark_metadata"
            if store.get_file_info(folder).type != fs.FileType.Directory:
                return None
            logs = {f.base_name: f.path for f in store.get_file_info(fs.FileSelector(folder))
                    if f.base_name.removesuffix(".compact").isdigit()}
            compact = max((int(n.removesuffix(".compact")) for n in logs if n.endswith(".compact")), default=-1)
            names = set()
            for name, path in logs.items():
                n = int(name.removesuffix(".compact"))
                if n < compact or n == compact and not name.endswith(".compact"):
                    continue
                with store.open_input_stream(path) as f:
                    names |= {json.loads(x)["path"].rsplit("/", 1)[-1]
                              for x in f.read().decode().split("\n")[1:] if x}
            return names

        def files(self):
            """(modified, name, size) in the order of admission."""
            from pyarrow import fs
            store, root = opened(self.path)
            if store.get_file_info(root).type == fs.FileType.NotFound:
                return store, root, []
            only = self.committed(store, root)
            found = []
            for f in store.get_file_info(fs.FileSelector(root, recursive=True)):
                name = f.path[len(root):].lstrip("/")
                if f.type == fs.FileType.File and not any(p[0] in "._" for p in name.split("/")) and (
                        only is None or f.base_name in only):
                    found.append((f.mtime_ns / 1e9, name, f.size))
            return store, root, sorted(found)

        # ---------------------------------------------------- offsets
        def initialOffset(self):  # noqa: N802
            if not self.from_latest:
                return {"below": 0.0, "files": {}}
            _, _, found = self.files()
            return {"below": 0.0, "files": dict(sorted((n, size) for _, n, size in found))}

        def lines(self, store, path, begin, size, still, limit):
            """Ends of up to ``limit`` lines from ``begin``."""
            ends, at, rest = [], begin, b""
            with store.open_input_file(path) as f:
                f.seek(begin)
                while len(ends) < limit and at < size:
                    block = f.read(min(1 << 20, size - at))
                    if not block:
                        break
                    at += len(block)
                    rest += block
                    here = at - len(rest)
                    cut = 0
                    while len(ends) < limit and (to := rest.find(b"\n", cut)) >= 0:
                        cut = to + 1
                        ends.append(here + cut)
                    rest = rest[cut:]
            if rest and len(ends) < limit and still and at >= size:
                ends.append(size)
            return ends

        def latestOffset(self):  # noqa: N802
            if self.at is None:
                self.at = self.initialOffset()
            store, root, found = self.files()
            now, begun = time.time(), dict(self.at["files"])
            admitted, count, oldest = dict(begun), 0, None
            for modified, name, size in found:
                begin = begun.get(name, size if modified <= self.at["below"] else 0)
                if count >= self.max_records:
                    break
                if begin >= size:
                    continue
                ends = self.lines(store, f"{root}/{name}", begin, size, now - modified >= self.max_seconds,
                                  self.max_records - count)
                if ends:
                    admitted[name] = ends[-1]
                    count += len(ends)
                    oldest = modified if oldest is None else min(oldest, modified)
            if not count:
                self.since = None
                return self.at
            self.since = min(self.since or now, now)
            if count < self.max_records and now - min(self.since, oldest) < self.max_seconds:
                return self.at
            # files read to their end long ago need no entry any more
            below = max(self.at["below"], max(m for m, _, _ in found) - self.keep)
            done = {n for m, n, size in found if m <= below and begun.get(n, size) >= size}
            gone = set(begun) - {n for _, n, _ in found}
            kept = {n: b for n, b in admitted.items() if n not in done and n not in gone}
            return {"below": below, "files": dict(sorted(kept.items()))}

        def partitions(self, start, end):
            # after a restart Spark plans the last batch of its log first
            self.at, self.since = end, None
            return [InputPartition((n, start["files"].get(n, 0), b)) for n, b in end["files"].items()
                    if b > start["files"].get(n, 0)]

        def read(self, partition):
            name, begin, end = partition.value
            store, root = opened(self.path)
            with store.open_input_file(f"{root}/{name}") as f:
                f.seek(begin)
                at, rest = begin, b""
                while at + len(rest) < end:
                    block = f.read(min(1 << 20, end - at - len(rest)))
                    if not block:
                        break
                    *whole, rest = (rest + block).split(b"\n")
                    for line in whole:
                        yield line.rstrip(b"\r").decode("utf-8", "replace"), name, at
                        at += len(line) + 1
                if rest:
                    yield rest.rstrip(b"\r").decode("utf-8", "replace"), name, at

        def commit(self, end):
            pass

        def stop(self):
            pass

    class CountedLines(DataSource):
        @classmethod
        def name(cls):
            return format_name

        def schema(self):
            return "value string, file string, at bigint"

        def streamReader(self, schema):  # noqa: N802
            return Reader(self.options)

    return CountedLines


def counted_stream(spark: SparkSession, path: str, max_records: int = 100, max_seconds: float = 30,
                   keep_seconds: float = 86400, starting_at: str = "earliest") -> DataFrame:
    """The records of a folder, in batches of at most ``max_records`` that
    leave when full or when their oldest record has waited ``max_seconds``.
    ``starting_at="latest"`` skips what is there at the first start (W6)."""
    # a name of its own each time: sessions of one application share the names, not the sources
    name = f"counted_lines_{uuid4().hex}"
    spark.dataSource.register(counted_lines(name))
    uri = path if "://" in path or path.startswith("/") else path.removeprefix("file:")
    return (spark.readStream.format(name).option("path", uri).option("maxRecords", max_records)
            .option("maxSeconds", max_seconds).option("keepSeconds", keep_seconds)
            .option("startingAt", starting_at).load())
