"""A sink that a repeated micro-batch or job writes to once: data files, and a ledger that says which of them count.

A task writes its rows to a file of its own under `data/` and tells the driver its name.  When all tasks are done, one small file
under `ledger/` names the files of that run; it appears whole or not at all, and it is what makes them count.  A run that
is in the ledger already is not entered again, and its files are removed.  So whatever dies between writing, the
ledger and Spark's own checkpoint, each run is read once:

* before the ledger entry: the files belong to no run; the repeat writes new ones, `remove_unfinished` clears the old;
* after it: the repeat finds the entry and leaves everything as it is.

A run is a micro-batch of a named stream, or a batch job that names itself (`run`).
"""

from __future__ import annotations

import json
import time
import urllib.parse
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

FORMAT = "tracewell_ledger"
ENTRY = "run string, files array<struct<name:string,rows:bigint>>"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    rows: int


class _Ledger:
    """Both writers: what a task does, and what the driver does when all tasks are done."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = file_system(self.path)
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if out is None:
                    system.create_dir(f"{root}/data", recursive=True)
                    out = pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=system, compression="zstd")
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else None, rows)

    def enter(self, messages: list, run: str) -> None:
        system, root = file_system(self.path)
        if entered(system, root, run):
            self.remove(messages)
            return
        files = [{"name": m.name, "rows": m.rows} for m in messages if m is not None and m.name]
        system.create_dir(f"{root}/ledger", recursive=True)
        # Files whose names begin with a point are not read by Spark.
        draft = f"{root}/ledger/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps({"run": run, "files": files}).encode())
        system.move(draft, _entry(root, run))

    def remove(self, messages: list) -> None:
        system, root = file_system(self.path)
        for m in messages:
            if m is not None and m.name and system.get_file_info(f"{root}/data/{m.name}").is_file:
                system.delete_file(f"{root}/data/{m.name}")


def _entry(root: str, run: str) -> str:
    return f"{root}/ledger/{urllib.parse.quote(run, safe='')}.json"


def entered(system: fs.FileSystem, root: str, run: str) -> bool:
    return system.get_file_info(_entry(root, run)).is_file


class LedgerWriter(_Ledger, DataSourceArrowWriter):
    """A batch job: the run has the name that the job gives it."""

    def __init__(self, path: str, run: str):
        super().__init__(path)
        self.run = run

    def commit(self, messages: list) -> None:
        self.enter(messages, self.run)

    def abort(self, messages: list) -> None:
        self.remove(messages)


class LedgerStreamWriter(_Ledger, DataSourceStreamArrowWriter):
    """A stream: a run is a micro-batch."""

    def __init__(self, path: str, stream: str):
        super().__init__(path)
        self.stream = stream

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.enter(messages, f"{self.stream}/{batchId}")

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.remove(messages)


class LedgerSource(DataSource):
    """`path`, and `run` (batch) or `stream` (a name that goes with the checkpoint)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _option(self, name: str) -> str:
        if not self.options.get(name):
            raise ValueError(f"the option {name} is missing")
        return self.options[name]

    def writer(self, schema: T.StructType, overwrite: bool) -> LedgerWriter:
        if overwrite:
            raise ValueError("a ledger is only added to")
        return LedgerWriter(self._option("path"), self._option("run"))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> LedgerStreamWriter:  # noqa: N802
        return LedgerStreamWriter(self._option("path"), self._option("stream"))


def write_once(rows: DataFrame, path: str, run: str) -> None:
    """Add the rows as one run; a run of that name that is in the ledger stays as it is."""
    rows.sparkSession.dataSource.register(LedgerSource)
    rows.write.format(FORMAT).mode("append").option("path", path).option("run", run).save()


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """run, name and rows of every data file that counts."""
    entries = spark.read.schema(ENTRY).json(f"{path.rstrip('/')}/ledger")
    return entries.select("run", F.explode("files").alias("f")).select("run", "f.name", "f.rows")


def read_once(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all runs, each once.  File names come to the driver, as in any list of files that Spark reads."""
    root = path.rstrip("/")
    names = [f"{root}/data/{r['name']}" for r in read_entries(spark, path).select("name").toLocalIterator()]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*names)


def remove_unfinished(spark: SparkSession, path: str, older_seconds: int = 86_400) -> int:
    """Remove data files that no run names and that are too old to be of one in the making; how many."""
    known = {r["name"] for r in read_entries(spark, path).select("name").toLocalIterator()}
    system, root = file_system(path.rstrip("/"))
    before, n = time.time() - older_seconds, 0
    for info in system.get_file_info(fs.FileSelector(f"{root}/data", allow_not_found=True)):
        if info.base_name not in known and (info.mtime is None or info.mtime.timestamp() <= before):
            system.delete_file(info.path)
            n += 1
    return n
