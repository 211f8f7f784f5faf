"""Token counts by separator scan of flat token files (operator 2).

A flat token file is a run of little-endian uint16 ids without any index;
every document ends with the end-of-document id. Files are cut in fixed
blocks. Each block is searched for the id in one vectorised comparison; a
document that spans blocks is closed by the first separator of a later block,
which a prefix scan (from the file's end) over one small row per block
hands back. No file position is kept anywhere but in the scan.

``write_token_files`` makes such files from documents: Spark's text writer
with the separator as its line end. Ids beyond the vocabulary are free, so each
document may carry its doc_id as a header of reserved ids, which the scan
decodes; files of plain tokens have no header and number their documents.

Null and empty texts have 0 tokens. Repeated rows are documents of their own.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pricelake.session import scratch_path

#: Ids below END are tokens; above it they are digits of a header.
END = 50256
RADIX = 0xFFFF - END
HEADER = 5
BLOCK_BYTES = 1 << 20
#: Rows of one file at most; bounds a file by rows besides its input split.
FILE_ROWS = 50_000

_STARTS = pa.list_(pa.struct([("at", pa.int64()), ("stop", pa.int64()), ("doc_id", pa.int64())]))


def header(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """(n, HEADER) ids above END that spell each doc_id (or none) in base RADIX."""
    out = np.zeros((len(ids), HEADER), np.uint16)
    rest = ids.view(np.uint64).copy()
    for k in range(HEADER - 1, -1, -1):
        out[:, k] = (rest % np.uint64(RADIX)).astype(np.uint16) + np.uint16(END + 1)
        rest //= np.uint64(RADIX)
    out[~known] = END + RADIX  # the largest digit throughout: beyond 64 bits
    return out


def unheader(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc_id, known) from (n, HEADER) ids."""
    d = digits.astype(np.uint64) - np.uint64(END + 1)
    known = ~(d == RADIX - 1).all(axis=1)
    value = np.zeros(len(d), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(HEADER):
            value = value * np.uint64(RADIX) + d[:, k]
    return value.view(np.int64), known


def encoder(vocabulary: str, pattern: str):
    """A tiktoken encoding from a file of base64 ranks."""
    import tiktoken
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def write_token_files(docs: DataFrame, path: str, vocabulary: str, pattern: str, id_col: str = "doc_id",
                      text_col: str = "text", file_rows: int = FILE_ROWS) -> None:
    """Tokenise every whole text into flat files under ``path``."""

    def encode(batches):
        enc = encoder(vocabulary, pattern)
        for batch in batches:
            ids = batch.column("doc_id")
            head = header(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                          ids.is_valid().to_numpy(zero_copy_only=False))
            out = [h.tobytes() + np.array(enc.encode_ordinary(t or ""), np.uint16).tobytes()
                   for h, t in zip(head, batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    (src.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("encoding", "UTF-16LE").option("lineSep", chr(END)).option("maxRecordsPerFile", file_rows)
     .text(path))


def scan_token_files(spark: SparkSession, path: str, with_header: bool = True, block_bytes: int = BLOCK_BYTES,
                     end: int = END) -> DataFrame:
    """(file, ordinal, doc_id, n_tokens): one row per document of the files
    under ``path``; doc_id is null without headers."""
    width = 2 * (HEADER if with_header else 0)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    # a block reads on by a header (or one id), so a document's start is known where its separator stands
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(block_bytes)),
                      lambda o: F.struct(o.alias("offset"),
                                         F.substring("content", (o + 1).cast("int"), F.lit(block_bytes + max(width, 2))).alias("bytes")))
    blocks = (files.filter("length > 0").select(F.col("path").alias("file"), F.explode(cut).alias("b"))
              .select("file", "b.offset", "b.bytes"))

    def search(batches):
        for batch in batches:
            starts, firsts = [], []
            for o, raw in zip(batch.column("offset").to_pylist(), batch.column("bytes")):
                every = np.frombuffer(raw.as_buffer(), np.uint16)
                ids = every[:block_bytes // 2]
                at = np.flatnonzero(ids == end)
                base = o // 2
                firsts.append(int(at[0]) + base if len(at) else None)
                begin = at + 1
                if o == 0:
                    begin = np.concatenate(([0], begin))
                # a document begins behind each separator but the file's last
                begin = begin[begin < len(every)]
                ids_, known = np.zeros(len(begin), np.int64), np.zeros(len(begin), bool)
                if with_header and len(begin):
                    ids_, known = unheader(every[begin[:, None] + np.arange(HEADER)])
                # where each ends, if its separator is in this block
                stop = np.append(at, -1)[np.searchsorted(at, begin)]
                starts.append([{"at": a, "stop": e + base if e >= 0 else None, "doc_id": d if k else None}
                               for a, e, d, k in zip((begin + base).tolist(), stop.tolist(), ids_.tolist(), known.tolist())])
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("offset"),
                                              pa.array(starts, _STARTS), pa.array(firsts, pa.int64())],
                                             names=["file", "offset", "starts", "first_end"])

    found = blocks.mapInArrow(search, "file string, offset long, starts array<struct<at:long,stop:long,doc_id:long>>, first_end long")
    by_file = Window.partitionBy("file").orderBy("offset")  # a row per block of a file
    later = by_file.rowsBetween(1, Window.unboundedFollowing)
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select("file", "starts", F.min("first_end").over(later).alias("next_end"),
                            F.coalesce(F.sum(F.size("starts")).over(earlier), F.lit(0)).alias("before"))
    doc = stitched.select("file", "before", "next_end", F.posexplode("starts").alias("i", "s"))
    return doc.select("file", (F.col("before") + F.col("i")).alias("ordinal"), F.col("s.doc_id").alias("doc_id"),
                      (F.coalesce("s.stop", "next_end") - F.col("s.at") - F.lit(width // 2)).alias("n_tokens"))


def token_counts(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens) of every document, by way of flat token files."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_token_files(docs, path, vocabulary, pattern)
    return scan_token_files(spark, path).select("doc_id", "n_tokens")
