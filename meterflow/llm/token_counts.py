"""Token counts of documents in flat token files without an index.

A flat file is the token identifiers of its documents one after another, two
bytes each, low byte first, each document closed by the end-of-document
identifier. ``count`` cuts files into blocks, finds the end identifiers of a
block with one vectorised comparison and gives, per block, the lengths between
them and the open lengths at its edges. A prefix sum over a file's blocks turns
them into document numbers, and pieces of one document are added up, so a
document may span any number of blocks and a file any number of tasks.

``write_flat`` makes such files from a table of texts with Spark's text writer,
whose line separator is the end identifier: a partition is a file.

Defined cases: a null or empty text is a document of no tokens; tokens after
the last end identifier are a document of their own, marked unclosed; a byte
left over at a file's end is ignored; repeated rows are documents of their own;
an empty table gives no file or an empty one, and no row; other columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import save

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed values of that vocabulary: its pattern of words, its end-of-document identifier.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
DTYPE = np.dtype("<u2")
WHOLE_FILE = 64 << 20   # files up to this size are read by Spark; larger ones in ranges
DOC = "file string, block long, rank long, tokens long, closed boolean"


def write_flat(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end: int = END) -> None:
    """Tokenise ``docs.text`` into flat files under ``path``, a file per partition, rows in order."""
    with open(vocabulary, "rb") as fh:
        shared = docs.sparkSession.sparkContext.broadcast(fh.read())

    def encode(batches):
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        coder = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                texts = batch.column(0)[at:at + 128].to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(
                    [np.array(coder.encode_ordinary(t or ""), DTYPE).tobytes() for t in texts], pa.binary())], ["value"])

    separator = end.to_bytes(2, "little").decode("latin-1")
    tokens = docs.select("text").mapInArrow(encode, "value binary").select(F.col("value").cast("string"))
    tokens.write.option("encoding", "ISO-8859-1").option("lineSep", separator).text(path)


def pieces(data: np.ndarray, end: int) -> tuple[np.ndarray, int]:
    """Lengths up to each end identifier of a block (the first may go on from before), and the open length after the last."""
    at = np.flatnonzero(data == end)
    return np.diff(at, prepend=-1) - 1, len(data) - (int(at[-1]) + 1 if len(at) else 0)


def _rows(file: str, blocks, end: int):
    for number, data in blocks:
        lengths, left = pieces(data, end)
        n = len(lengths) + 1
        yield pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array(np.full(n, number), pa.int64()),
                                          pa.array(np.arange(n), pa.int64()), pa.array(np.append(lengths, left), pa.int64()),
                                          pa.array(np.arange(n) < n - 1)], ["file", "block", "rank", "tokens", "closed"])


def _scan_whole(block_tokens: int, end: int):
    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(content.as_buffer(), DTYPE, content.as_buffer().size // 2)
                yield from _rows(file, ((i, data[k:k + block_tokens]) for i, k in enumerate(range(0, len(data), block_tokens))), end)
    return run


def _scan_range(block_tokens: int, end: int):
    def run(batches):
        for batch in batches:
            for file, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, name = pafs.FileSystem.from_uri(file)
                with fs.open_input_file(name) as f:
                    raw = f.read_at(2 * block_tokens, 2 * block_tokens * number)
                yield from _rows(file, [(number, np.frombuffer(raw, DTYPE, len(raw) // 2))], end)
    return run


def count(spark: SparkSession, path: str, end: int = END, block_tokens: int = 1 << 20, whole_file: int = WHOLE_FILE) -> DataFrame:
    """Per document: file, ordinal in the file (from 0), n_tokens, closed. ``path`` is a folder of flat files.

    Files over ``whole_file`` bytes are read block by block through the file system of their address."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    small = files.filter(F.col("length") <= whole_file).select("path", "content").mapInArrow(_scan_whole(block_tokens, end), DOC)
    found = small
    large = files.filter(F.col("length") > whole_file).select(
        F.col("path").alias("file"), F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 2) / (2 * block_tokens)))).alias("block"))
    if not large.isEmpty():
        found = small.unionByName(large.repartition("file", "block").mapInArrow(_scan_range(block_tokens, end), DOC))
    found = save(found, "token-pieces")
    # The prefix scan: documents closed in the blocks before. Blocks are one row each here.
    ends = found.groupBy("file", "block").agg(F.sum(F.col("closed").cast("long")).alias("ends"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = ends.select("file", "block", F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("first"))
    docs = found.join(first, ["file", "block"]).groupBy("file", (F.col("first") + F.col("rank")).alias("ordinal")).agg(
        F.sum("tokens").alias("n_tokens"), F.max("closed").alias("closed"))
    return docs.filter("closed or n_tokens > 0")


def part_number(file):
    """The partition that Spark's writer made a file from."""
    return F.regexp_extract(file, r"part-(\d+)[^/]*$", 1).cast("long")


def by_document(docs: DataFrame, counted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the files written from ``docs`` with its identifiers: a file holds a partition's rows in order.
    ``docs`` must be a scan of files, whose partitions and order are the same in each reading."""
    place = F.monotonically_increasing_id()
    ids = docs.select(F.col(id_col), F.spark_partition_id().cast("long").alias("part"), place.bitwiseAND((1 << 33) - 1).alias("ordinal"))
    return ids.join(counted.withColumn("part", part_number(F.col("file"))).drop("file"), ["part", "ordinal"], "left")
