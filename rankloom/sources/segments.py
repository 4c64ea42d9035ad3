"""An index as a folder of segments, and versions that list them.

A segment is a set of documents: its rows lie in one folder ``segment=<name>`` under each table of the index and
never change. A version is a small table in a folder of its own that lists the segments of the index at one
time; it counts from the moment Spark's writer marks the folder as complete. Whoever writes an index
writes segments first and the version last, so a reader sees either all of a change or nothing of it, and a
job that fails leaves only files that no version lists.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.durable import delete_folder

#: Bits of a block's number below the number of its segment.
BLOCK_BITS = 32


@dataclass(frozen=True)
class Segment:
    """One line of a version. ``n`` documents with tokens and ``total`` tokens more than before it, ``gone`` ids
    whose rows in older segments it replaces, ``impacts`` rows of score bounds."""

    name: str
    n: int
    total: int
    gone: int = 0
    impacts: int = 0

    @property
    def number(self) -> int:
        return int(self.name.split("-")[0])


@dataclass(frozen=True)
class Version:
    """What an index consists of."""

    number: int
    segments: tuple[Segment, ...]
    min_df: int
    buckets: int
    doc_buckets: int
    norms: str | None = None
    impact_rows: int = 0
    source: str | None = None  # what the last segment was made of, such as a micro-batch

    def next_name(self) -> str:
        """A new name; never used again, so a retried job cannot mix with an old one."""
        last = max((s.number for s in self.segments), default=-1)
        return f"{last + 1:06d}-{uuid.uuid4().hex[:12]}"

    def grown(self, segment: Segment, source: str | None = None) -> Version:
        return replace(self, number=self.number + 1, segments=(*self.segments, segment), norms=None, source=source)


_SETTINGS = [f.name for f in fields(Version) if f.name not in ("segments", "number")]
_LINES = "name string, n long, total long, gone long, impacts long, min_df long, buckets int, doc_buckets int, norms string, impact_rows long, source string"


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions of an index, in order."""
    context = spark.sparkContext
    pattern = context._jvm.org.apache.hadoop.fs.Path(f"{path}/versions/*/_SUCCESS")
    found = pattern.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(int(status.getPath().getParent().getName()) for status in found)


def read_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest complete version of an index, or the one of that number; None if there is none."""
    complete = _versions(spark, path)
    if not complete or (number is not None and number not in complete):
        return None
    number = complete[-1] if number is None else number
    rows = spark.read.schema(_LINES).json(f"{path}/versions/{number:08d}").collect()
    segments = tuple(
        Segment(r.name, r.n, r.total, r.gone, r.impacts) for r in sorted(rows, key=lambda r: r.name) if r.name is not None
    )
    return Version(number, segments, **{name: rows[0][name] for name in _SETTINGS})


def publish(spark: SparkSession, path: str, version: Version) -> None:
    """Make a version the newest one; fails when another writer was faster."""
    settings = {name: getattr(version, name) for name in _SETTINGS}
    lines = [asdict(s) | settings for s in version.segments] or [dict.fromkeys(("name", "n", "total", "gone", "impacts")) | settings]
    names = [part.split()[0] for part in _LINES.split(", ")]
    table = spark.createDataFrame([tuple(line[name] for name in names) for line in lines], _LINES)
    table.coalesce(1).write.json(f"{path}/versions/{version.number:08d}", mode="errorifexists")


def remove_unused(spark: SparkSession, path: str) -> None:
    """Delete all segments and norms that the newest version does not list, and all older versions.

    Run it when nobody writes the index or reads an older version.
    """
    version = read_version(spark, path)
    if version is None:
        return
    context = spark.sparkContext
    keep = {f"segment={s.name}" for s in version.segments} | {f"version={version.norms}"}
    for table in ("doc_terms", "term_stats", "postings", "gone", "impacts", "norms", "versions"):
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{path}/{table}")
        system = folder.getFileSystem(context._jsc.hadoopConfiguration())
        for status in system.listStatus(folder) if system.exists(folder) else []:
            name = status.getPath().getName()
            if name not in keep and name != f"{version.number:08d}":
                delete_folder(spark, status.getPath().toString())


def scan(spark: SparkSession, path: str, table: str, segments: tuple[Segment, ...], schema: T.StructType) -> DataFrame:
    """One scan over the folders of some segments, with the columns of ``schema`` and the ``segment``."""
    with_segment = T.StructType([*schema.fields, T.StructField("segment", T.StringType())])
    if not segments:
        return spark.createDataFrame([], with_segment)
    base = f"{path}/{table}"
    return (
        spark.read.schema(with_segment).option("basePath", base).parquet(*[f"{base}/segment={s.name}" for s in segments])
    )


def write_bucketed(df: DataFrame, folder: str, key: str, buckets: int, placed: bool = False) -> None:
    """Write ``df`` so that all rows of a key lie in one bucket, a file each; ``placed`` rows are dealt so already."""
    spark, name = df.sparkSession, f"rankloom_write_{uuid.uuid4().hex}"
    rows = df if placed else df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", folder).format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def bucketed_table(
    spark: SparkSession, base: str, schema: T.StructType, key: str, buckets: int, part: str, values: list[str]
) -> DataFrame:
    """Folders ``part=value`` under ``base`` as one table that is known to be bucketed.

    Joins and sums by the key need no shuffle. Spark knows buckets only of tables in its catalog, so one is
    registered under a name made of what it holds; it has no data of its own.
    """
    text = f"{spark.sparkContext.applicationId} {base} {key} {buckets} {schema.simpleString()} {' '.join(values)}"
    name = f"rankloom_{hashlib.sha256(text.encode()).hexdigest()[:32]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        quoted = base.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}, `{part}` string) USING parquet PARTITIONED BY (`{part}`) "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{quoted}'"
        )
        if values:
            spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION (`{part}` = '{v}')" for v in values))
    return spark.table(name)


def segment_number(segment: str = "segment") -> Column:
    """The number in a segment's name."""
    return F.split_part(segment, F.lit("-"), F.lit(1)).cast("long")
