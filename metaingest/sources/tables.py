"""Target tables as versions that share files: copy-on-write by bucket.

A table's rows lie in parquet files, each one of a bucket of the key columns. A
version is a list of files for every bucket. A new version rewrites the buckets
that a change touches and refers to the files of all others, so it costs what
changed and not what the table holds. It becomes current with one append to the
version log: a reader never sees a half-written version, and a failed write leaves
files that no version names.

The files of a table with one layout (keys and number of buckets) lie in one folder,
which is read as a bucketed table restricted to the version's files: joins on the
keys don't shuffle it, and files of other versions are not opened.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._cols import named, quoted
from ._files import FLAG, INT, LONG, TEXT, append_row, read_folder, schema_of

LOG_SCHEMA = schema_of(
    table_nm=TEXT,
    version=LONG,
    path=TEXT,
    key_names=T.ArrayType(TEXT),
    buckets=INT,
    row_total=LONG,
    table_schema=TEXT,
    files=T.MapType(INT, T.ArrayType(TEXT)),
    lists_all=FLAG,
    batches=T.MapType(TEXT, LONG),
)
ROWS_PER_BUCKET = 2_000_000
#: A log entry lists the rewritten buckets only; every so many versions one lists all.
VERSIONS_PER_LIST = 16

_writers: dict[str, threading.Lock] = {}


@dataclass(frozen=True)
class Version:
    """``files`` has the file names of each bucket, ``batches`` the last batch that
    each stream brought into the table."""

    table: str
    number: int
    path: str
    keys: tuple[str, ...]
    buckets: int
    rows: int
    schema: T.StructType
    files: dict[int, tuple[str, ...]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    def has_layout(self, keys: Sequence[str], buckets: int) -> bool:
        return self.buckets == buckets and list(self.keys) == list(keys)


class TableStore:
    """Versioned tables below ``<root>/tables``; one writer per table."""

    def __init__(self, spark: SparkSession, root: str, rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/tables"
        self.rows_per_bucket = rows_per_bucket
        self.log_path = f"{self.root}/_versions"

    # --- versions ---------------------------------------------------------

    def current(self, table: str) -> Version | None:
        log = self._log(table)
        last = log.agg(F.max(F.when(F.col("lists_all"), F.col("version")))).first()[0]
        versions = [] if last is None else self._versions(log.where(F.col("version") >= last))
        return versions[-1] if versions else None

    def _log(self, table: str) -> DataFrame:
        return read_folder(self.spark, f"{self.log_path}/{table}", LOG_SCHEMA)

    def _versions(self, log: DataFrame) -> list[Version]:
        """Versions of log entries, the first of which lists all of its files."""
        versions: list[Version] = []
        for row in log.orderBy("version").collect():
            files = {} if row["lists_all"] else dict(versions[-1].files)
            files.update({bucket: tuple(names) for bucket, names in row["files"].items()})
            versions.append(
                Version(
                    row["table_nm"],
                    row["version"],
                    row["path"],
                    tuple(row["key_names"]),
                    row["buckets"],
                    row["row_total"],
                    T.StructType.fromJson(json.loads(row["table_schema"])),
                    files,
                    dict(row["batches"]),
                )
            )
        return versions

    # --- reading ----------------------------------------------------------

    def read(self, table: str) -> DataFrame | None:
        """Current rows of a table, or None if it was never written."""
        version = self.current(table)
        return None if version is None else self.read_version(version)

    def read_version(self, version: Version, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of a version, or of some of its buckets."""
        wanted = version.files if buckets is None else buckets
        names = [name for bucket in wanted for name in version.files.get(bucket, ())]
        rows = self._folder(version.path, version.schema, version.keys, version.buckets)
        return rows.where(F.col("_metadata.file_name").isin(names)) if names else rows.where(F.lit(False))

    def _folder(self, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
        """All files of a folder as a bucketed table; files without a column have nulls in it."""
        name = self._catalog_name(path, schema)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
            key_list = ", ".join(map(quoted, keys))
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key_list}) SORTED BY ({key_list}) "
                f"INTO {buckets} BUCKETS LOCATION '{path}'"
            )
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    # --- layout -----------------------------------------------------------

    def bucket_count(self, rows: int, current: Version | None) -> int:
        """Buckets for a table of about that many rows: a power of two, doubled as it grows."""
        wanted = self.spark.sparkContext.defaultParallelism
        wanted = 1 << max(0, wanted - 1).bit_length()
        while wanted * self.rows_per_bucket < rows:
            wanted *= 2
        if current is None:
            return wanted
        return wanted if wanted > current.buckets * 2 else current.buckets

    @staticmethod
    def bucket_of(keys: Sequence[str], buckets: int) -> Column:
        """The bucket that Spark writes a row to."""
        return F.pmod(F.hash(*map(named, keys)), F.lit(buckets))

    def layout(self, rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
        """Rows placed the way the table's buckets are, with one exchange."""
        return rows.repartition(buckets, *map(named, keys))

    # --- writing ----------------------------------------------------------

    def writing(self, table: str) -> threading.Lock:
        """Held while a table's next version is made: this driver's threads take turns."""
        return _writers.setdefault(f"{self.root}/{table}", threading.Lock())

    def write(
        self,
        table: str,
        rows: DataFrame,
        keys: Sequence[str],
        buckets: int,
        count: Callable[[], int],
        previous: Version | None,
        touched: Iterable[int] | None = None,
        batches: dict[str, int] | None = None,
        adds: bool = False,
    ) -> Version:
        """Write the version after ``previous`` and make it current.

        ``rows`` are all rows of the ``touched`` buckets; the other buckets stay as
        they are in ``previous``. Without ``touched`` they are the whole table, which
        goes to a folder of its own. With ``adds`` they are further rows of a table whose
        files all stay. ``count()`` is asked for the number of rows of
        the table after they are written. ``batches`` are noted in the same append.
        """
        number = previous.number + 1 if previous else 1
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        shares = (touched is not None or adds) and previous is not None and previous.has_layout(keys, buckets)
        path = previous.path if shares else f"{self.root}/{table}/g{number:08d}-{uuid.uuid4().hex}"
        known = self._file_names(previous.path, previous.schema, keys, buckets) if shares else set()
        self._append(rows, path, schema, keys, buckets)
        written: dict[int, list[str]] = {bucket: [] for bucket in touched or ()} if shares else {}
        for name in self._file_names(path, schema, keys, buckets) - known:
            bucket = _bucket_in(name)
            kept = list(previous.files.get(bucket, ())) if shares and adds else []
            written.setdefault(bucket, kept).append(name)
        lists_all = not shares or number % VERSIONS_PER_LIST == 0
        files = {**(previous.files if shares else {}), **{b: tuple(sorted(names)) for b, names in written.items()}}
        batches = {**(previous.batches if previous else {}), **(batches or {})}
        listed = {b: list(names) for b, names in files.items() if lists_all or b in written}
        entry = (table, number, path, list(keys), buckets, count(), schema.json(), listed, lists_all, batches)
        append_row(self.spark, f"{self.log_path}/{table}", LOG_SCHEMA, entry)
        return Version(table, number, path, tuple(keys), buckets, entry[5], schema, files, batches)

    def note_batches(self, version: Version, batches: dict[str, int]) -> Version:
        """A version with the same files, after batches that changed nothing."""
        batches = {**version.batches, **batches}
        entry = (
            version.table, version.number + 1, version.path, list(version.keys), version.buckets, version.rows,
            version.schema.json(), {b: list(names) for b, names in version.files.items()}, True, batches,
        )
        append_row(self.spark, f"{self.log_path}/{version.table}", LOG_SCHEMA, entry)
        return Version(
            version.table, version.number + 1, version.path, version.keys, version.buckets, version.rows, version.schema,
            version.files, batches,
        )

    def _append(self, rows: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> None:
        # The table is made first: one made by the write would begin with an empty folder.
        self._folder(path, schema, keys, buckets)
        writer = rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
        writer.mode("append").saveAsTable(self._catalog_name(path, schema))

    def _file_names(self, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> set[str]:
        return {file.rsplit("/", 1)[-1] for file in self._folder(path, schema, keys, buckets).inputFiles()}

    def vacuum(self, table: str, keep: int = 2) -> int:
        """Remove the files that the newest ``keep`` versions don't name; returns how many.

        A reader of an older version fails, so keep as many as readers may use.
        """
        versions = self._versions(self._log(table))
        kept = {(v.path, name) for v in versions[-max(1, keep) :] for names in v.files.values() for name in names}
        removed = 0
        for version in {v.path: v for v in versions}.values():
            present = self._file_names(version.path, version.schema, version.keys, version.buckets)
            gone = [f"{version.path}/{name}" for name in present if (version.path, name) not in kept]
            removed += sum(self._delete(path) for path in gone)
            if len(gone) == len(present):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(version.path, version.schema)}")
                self._delete(version.path)
        return removed

    def _delete(self, path: str) -> bool:
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)

    @staticmethod
    def _catalog_name(path: str, schema: T.StructType) -> str:
        return "metaingest_" + hashlib.md5(f"{path} {schema.json()}".encode()).hexdigest()


def _bucket_in(file_name: str) -> int:
    """The bucket that Spark names in a bucketed file's name."""
    return int(file_name.split(".", 1)[0].rsplit("_", 1)[-1])
