"""Token counts of documents in flat token files without an index.

A flat file is a run of token ids in which one id ends each document. It is read
in blocks of fixed size, whatever documents they cut. Each block is searched for
the separator with one array operation; running sums over the blocks of a file
then give the number of the first document of a block and the tokens it brings
along, so that documents cut by block boundaries are put together.
"""

from __future__ import annotations

import base64
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationkit.llm.arrays import text_bytes
from stationkit.plans.stored import store

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SEPARATOR = 50256
BLOCK_TOKENS = 1 << 16
# Fixed value: how this vocabulary cuts a text before merging.
PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def encoder(ranks: dict[bytes, int]):
    """Function from texts to lists of token ids."""
    import tiktoken

    made = tiktoken.Encoding(
        "flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return lambda text: made.encode_ordinary(text)


def token_blocks(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokenise documents into flat files, one for each task, cut into blocks.

    Rows with ``data`` are blocks (``file, place``, ids of two bytes); rows
    with ``doc_id`` say which document is the ``place``-th of a file. A null text
    is an empty document: a separator alone.
    """
    lines = map(bytes.split, Path(vocabulary).read_bytes().splitlines())
    ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
    held = docs.sparkSession.sparkContext.broadcast(ranks)
    names = ["file", "place", "doc_id", "is_doc", "data"]

    def run(batches):
        encode = encoder(held.value)
        file = TaskContext.get().partitionId()
        rest, place, number = np.zeros(0, np.uint16), 0, 0

        def rows(ids, cut, end):
            nonlocal place, number
            places = list(range(number, number + len(ids)))
            number += len(ids)
            parts = []
            while len(cut) >= BLOCK_TOKENS or (end and len(cut)):
                parts.append(cut[:BLOCK_TOKENS].astype("<u2").tobytes())
                cut = cut[BLOCK_TOKENS:]
            block_places = list(range(place, place + len(parts)))
            place += len(parts)
            n = len(ids) + len(parts)
            return cut, pa.RecordBatch.from_arrays(
                [
                    pa.array([file] * n, pa.int64()),
                    pa.array(places + block_places, pa.int64()),
                    pa.array(list(ids) + [None] * len(parts), pa.int64()),
                    pa.array([True] * len(ids) + [False] * len(parts)),
                    pa.array([None] * len(ids) + parts, pa.binary()),
                ],
                names,
            )

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = text_bytes(batch.column("text"))
            for begin in range(0, len(ids), 256):
                pieces = [rest]
                for text in texts[begin : begin + 256]:
                    pieces.append(np.array(encode(text.decode("utf-8", "replace")), dtype=np.uint16))
                    pieces.append(np.array([SEPARATOR], dtype=np.uint16))
                rest, out = rows(ids[begin : begin + 256], np.concatenate(pieces), False)
                yield out
        _, out = rows([], rest, True)
        yield out

    kind = "file bigint, place bigint, doc_id bigint, is_doc boolean, data binary"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, kind)


def file_blocks(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks ``file, place, data`` of flat files of two-byte ids under a path.

    Spark reads a file as one value, so files may have up to 2 GB.
    """
    size = 2 * block_tokens
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    last = F.floor((F.col("length") - 1) / size)
    return files.withColumn("place", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).select(
        F.col("path").alias("file"), "place",
        F.expr(f"substring(content, cast(place * {size} + 1 as int), {size})").alias("data"),
    )


def count_tokens(parts: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """Columns ``file, place, n_tokens, closed``: the documents of each file in order.

    Tokens after the last separator are a document that is not closed. Separators
    are not counted; two in a row make a document without tokens. A null or
    empty block has no tokens. Files are independent of each other.
    """

    def run(batches):
        names = ["file", "block", "tokens", "ends", "head", "tail", "inner"]
        for batch in batches:
            out = []
            for data in batch.column("data").to_pylist():
                ids = np.frombuffer(data or b"", dtype="<u2")
                at = np.flatnonzero(ids == separator)
                head = int(at[0]) if len(at) else len(ids)
                tail = len(ids) - 1 - int(at[-1]) if len(at) else len(ids)
                out.append((len(ids), len(at), head, tail, (np.diff(at) - 1).tolist()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("place")]
                + [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                names,
            )

    kind_of_file = parts.schema["file"].dataType.simpleString()
    kind = (
        f"file {kind_of_file}, block bigint, tokens bigint, ends bigint, head bigint, tail bigint, "
        "inner array<bigint>"
    )
    found = store(parts.select("file", "place", "data").mapInArrow(run, kind), "separators").df
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("tokens").over(before), F.lit(0))
    scanned = (
        found.withColumn("start", start)
        .withColumn("number", F.coalesce(F.sum("ends").over(before), F.lit(0)))
        .withColumn("past", F.when(F.col("ends") > 0, F.col("start") + F.col("tokens") - F.col("tail")))
        .withColumn("open", F.coalesce(F.max("past").over(before), F.lit(0)))
    )
    sizes = F.concat(F.array(F.col("start") - F.col("open") + F.col("head")), "inner")
    closed = scanned.where("ends > 0").select("file", "number", F.posexplode(sizes).alias("i", "n_tokens"))
    closed = closed.select(
        "file", (F.col("number") + F.col("i")).alias("place"), "n_tokens", F.lit(True).alias("closed")
    )
    files = found.groupBy("file").agg(F.sum("tokens").alias("all"), F.sum("ends").alias("place"))
    used = closed.groupBy("file").agg(F.sum(F.col("n_tokens") + 1).alias("used"))
    left = F.col("all") - F.coalesce("used", F.lit(0))
    last = files.join(used, "file", "left").select(
        "file", "place", left.alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.union(last.where("n_tokens > 0"))


def document_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Token count of every document, by way of flat files: ``doc_id, n_tokens``.

    One row for each row of ``docs``, also for repeated or null numbers.
    """
    written = store(token_blocks(docs, vocabulary), "tokens").df
    counts = count_tokens(written.where("NOT is_doc"))
    named = written.where("is_doc").select("file", "place", "doc_id")
    return named.join(counts, ["file", "place"]).select("doc_id", "n_tokens")
