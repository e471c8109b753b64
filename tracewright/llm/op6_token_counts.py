"""Document lengths from flat token files without an index, by scanning for separators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.llm import blocks as B
from tracewright.llm.tokens import BLOCK, PIECES, encoder
from tracewright.llm.words import blobs
from tracewright.session import shared_folder


def write_token_files(
    documents: DataFrame, tokenizer: str, text: str = "text", width: int = 2,
) -> str:
    """Writes the documents' ids as little-endian integers of ``width`` bytes, an end id behind
    each document, into flat files in the shared folder; returns the folder.

    A tokenizer may use every id from 0, so ids are stored plus one and 0 is the end. Nulls are
    empty texts. The text writer puts the bytes down as they are, with the end for its line
    end, so Spark alone writes the files.
    """
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(pa.Table.from_batches([batch]), text, 1 << 20):
                ids, counts = encoder(tokenizer, PIECES).encode(blobs(part[text]), BLOCK)
                if len(ids) and int(ids.max()) + 1 >> (8 * width):
                    raise ValueError(f"ids must fit {width} bytes")
                raw, ends = (ids + 1).astype(kind).tobytes(), (np.cumsum(counts) * width).tolist()
                own = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary())], names=["ids"])

    folder = f"{shared_folder(documents.sparkSession).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    documents.select(text).mapInArrow(run, "ids binary").select(
        F.col("ids").cast("string")).write.option("lineSep", "\0" * width).text(folder)
    return folder


def token_counts(
    spark: SparkSession, folder: str, end_id: int = 0, width: int = 2, block_tokens: int = 1 << 20,
) -> DataFrame:
    """``file, document, start, n_tokens, ended`` of each document in the flat files of a folder.

    Documents are numbered in a file from 0; ``start`` is in tokens; the end id is not counted.
    ``ended`` is false for tokens behind the last end id. A file is searched block by block, each
    in one comparison; a prefix scan over the blocks of a file then finds where the documents
    began that a block ends. Empty files and folders give no rows; a file that is not a whole
    number of ids is an error. Spark hands a file to a task whole, up to 2 GB.
    """
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                raw = content.as_buffer()
                if len(raw) % width:
                    raise ValueError(f"{name} is not a whole number of ids")
                ids = np.frombuffer(raw, dtype=kind)
                for number, at in enumerate(range(0, len(ids), block_tokens)):
                    own = ids[at:at + block_tokens]
                    ends = np.flatnonzero(own == end_id) + at
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name]), pa.array([number], pa.int32()),
                        pa.array([at + len(own)], pa.int64()),
                        pa.array([ends.tolist()], pa.list_(pa.int64())),
                    ], names=["file", "block", "stop", "ends"])

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    blocks = files.mapInArrow(run, "file string, block int, stop long, ends array<long>")
    by_file = Window.partitionBy("file").orderBy("block")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "file", "ends", "stop",
        (F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(earlier), F.lit(-1)) + 1).alias("open"),
        F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)).alias("before"),
        F.lead("block").over(by_file).isNull().alias("last"))

    def document(number, start, end, ended):
        return F.struct(
            (F.col("before") + number).alias("document"), start.alias("start"),
            (end - start).alias("n_tokens"), F.lit(ended).alias("ended"))

    # What ended and what is left over come from one row, so the files are read once.
    own = F.transform("ends", lambda end, i: document(
        i, F.when(i == 0, F.col("open")).otherwise(F.get("ends", i - 1) + 1), end, True))
    start = F.coalesce(F.try_element_at("ends", F.lit(-1)) + 1, F.col("open"))
    rest = F.filter(
        F.array(document(F.size("ends"), start, F.col("stop"), False)),
        lambda left: F.col("last") & (left["n_tokens"] > 0))
    return blocks.select("file", F.inline(F.concat(own, rest)))
