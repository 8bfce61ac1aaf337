"""CSV call-detail drops, read by header name (A1, A2, A3).

Each file names its columns in its first line, in any order. Files are grouped
by that line, and each group is one CSV scan whose columns are then picked by
name: a column that a file lacks is NULL (the typed parse then quarantines what
it requires), one that is not in the schema is ignored, of two with one name
the last counts. Fields may be quoted, with separators, doubled quotes and
line ends inside (RFC 4180). Every field stays text; typing happens in
``operators.quality``.

Of a file only the first line passes through the driver, which opens the files
through their own file system. As a stream, ``drop_paths`` tells which files are new and keeps
the processed ones in the query's checkpoint, so a restart neither loses nor
repeats a file; ``streaming.ingest.start_drop_ingest`` reads each
micro-batch's files with ``read_files``.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import CDR_DATA_WIRE, CDR_VOICE_WIRE

# File-name prefixes of the two drops.
DATA_GLOB = "cdr_data_*"
VOICE_GLOB = "cdr_voice_*"
#: Longest first line read, and files opened at a time, by the driver.
HEADER_BYTES, OPEN_FILES = 1 << 16, 16
LISTED = "path string, modificationTime timestamp, length long, content binary"
CSV_OPTIONS = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _first_line(spark: SparkSession, path: str) -> str:
    """A file's first line without its end; '' of an empty file."""
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).open(jpath)
    try:
        # At most HEADER_BYTES are read, whatever the file holds.
        raw = bytes(stream.readNBytes(HEADER_BYTES))
    finally:
        stream.close()
    line = raw.split(b"\n", 1)[0]
    if len(line) == HEADER_BYTES:
        raise ValueError(f"{path}: no header line in the first {HEADER_BYTES} bytes")
    return line.decode("utf-8-sig").rstrip("\r")


def layouts(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header."""
    with ThreadPoolExecutor(OPEN_FILES) as pool:
        lines = list(pool.map(lambda p: _first_line(spark, p), paths))
    out: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(paths, lines):
        names = tuple(c.strip() for c in next(csv.reader([line]), []))
        out.setdefault(names, []).append(path)
    return out


def read_files(spark: SparkSession, paths: list[str], schema: StructType, multiline: bool = True) -> DataFrame:
    """Rows of the CSV files ``paths`` as text columns of ``schema``, matched by header name.

    ``multiline`` allows line ends inside quotes, for which a file is read by one task; without it
    large files are split."""
    out = spark.createDataFrame([], schema)
    for names, group in sorted(layouts(spark, sorted(paths)).items()):
        place = {name: i for i, name in enumerate(names)}
        if not any(f.name in place for f in schema.fields):
            raise ValueError(f"no column of {schema.fieldNames()} in the header {list(names)} of {group[0]}")
        wire = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
        # The schema is the header's, by position: columns get their names from this group's own header below.
        rows = spark.read.schema(wire).options(**CSV_OPTIONS).option("multiLine", multiline).option("enforceSchema", True).csv(group)
        out = out.unionByName(rows.select(*[
            (F.col(f"c{place[f.name]}") if f.name in place else F.lit(None).cast("string")).alias(f.name) for f in schema.fields]))
    return out


def drop_paths(spark: SparkSession, path: str, glob: str, streaming: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """(path) of every file of a drop; the listing alone, no file is opened."""
    r = (spark.readStream if streaming else spark.read).format("binaryFile").schema(LISTED).option("pathGlobFilter", glob)
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select("path")


def read_csv_drop(spark: SparkSession, path: str, schema: StructType, glob: str, streaming: bool = False,
                  max_files_per_trigger: int | None = None, multiline: bool = True) -> DataFrame:
    """All files of a drop folder, by header name.

    The streaming form is for drops whose headers are the schema's columns in their order: a file
    with any other header ends the stream, so no column is ever taken for another. Drops with
    headers of their own go through ``streaming.ingest.start_drop_ingest``."""
    if not streaming:
        return read_files(spark, [r["path"] for r in drop_paths(spark, path, glob).collect()], schema, multiline)
    r = (spark.readStream.schema(schema).options(**CSV_OPTIONS).option("multiLine", multiline).option("enforceSchema", False)
         .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


def read_cdr_data(spark: SparkSession, path: str, streaming: bool = False, glob: str = DATA_GLOB, **kw) -> DataFrame:
    """Data-usage drops ``cdr_data_*`` as text rows."""
    return read_csv_drop(spark, path, CDR_DATA_WIRE, glob, streaming, **kw)


def read_cdr_voice(spark: SparkSession, path: str, streaming: bool = False, glob: str = VOICE_GLOB, **kw) -> DataFrame:
    """Voice drops ``cdr_voice_*`` as text rows."""
    return read_csv_drop(spark, path, CDR_VOICE_WIRE, glob, streaming, **kw)
