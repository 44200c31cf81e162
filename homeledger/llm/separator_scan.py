"""Token counts from flat token files by a separator scan (operator 1).

A token stream is a run of files of little-endian ids with an end-of-document
id after each document and no index; documents cross file ends freely.  Every
file is cut into blocks that are searched on their own with one vector
comparison each; a block knows how many tokens and ends it holds and where.  A
prefix scan over the blocks (first within groups of ``GROUP_FILES`` files, then
over the groups) gives each block its offset, the number of documents ended before
it and the place of the last end before it, which stitches the document that
crosses into it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homeledger.llm.shared import id_and_text
from homeledger.llm.tokens import word_ids
from homeledger.session import materialize, scratch_path

FILE_TOKENS = 4 << 20
BLOCK_TOKENS = 1 << 20
GROUP_FILES = 256


def _filesystem(uri: str):
    """(Arrow file system, path) of a folder any task can reach."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str,
                      file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Tokenise ``docs`` into one stream of flat files per task under ``folder``.

    Returns the written list ``kind, doc_id, stream, ordinal, file``: one row
    per document (its place in its stream) and one per file.  A retried task
    writes another stream, so only streams in the list count.
    """
    rows = id_and_text(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        tok = word_ids(tokenizer)
        end = end_id.to_bytes(tok.size, "little")
        stream = f"s{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        store, root = _filesystem(folder)
        most = file_tokens * tok.size
        held, ordinal, files = bytearray(), 0, []

        def close(size):
            name = f"{stream}-{len(files):06d}.bin"
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(bytes(held[:size]))
            del held[:size]
            files.append(name)

        names = ["kind", "doc_id", "stream", "ordinal", "file"]
        store.create_dir(root, recursive=True)
        for b in batches:
            first = ordinal
            for text in b.column(1).to_pylist():
                held += tok.text_ids(text)
                held += end
                ordinal += 1
                while len(held) >= most:
                    close(most)
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(["doc"] * n, pa.string()), b.column(0), pa.array([stream] * n, pa.string()),
                 pa.array(range(first, ordinal), pa.int64()), pa.nulls(n, pa.string())], names=names)
            id_type = b.column(0).type
        if held:
            close(len(held))
        if files:
            n = len(files)
            yield pa.RecordBatch.from_arrays(
                [pa.array(["file"] * n, pa.string()), pa.nulls(n, id_type), pa.array([stream] * n, pa.string()),
                 pa.array(range(n), pa.int64()), pa.array(files, pa.string())], names=names)

    return materialize(rows.mapInArrow(run, f"kind string, doc_id {kind}, stream string, ordinal long, file string"),
                       "token-list")


def find_ends(spark: SparkSession, folder: str, files: DataFrame, end_id: int, token_bytes: int,
              block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(stream, block, n_tokens, ends) of every block of the listed files (stream, ordinal, file)."""
    raw = (spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
           .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for name, data in zip(b.column(0), b.column(1)):
                ids = np.frombuffer(data.as_buffer(), f"<u{token_bytes}")
                n, ends = [], []
                for lo in range(0, len(ids), block_tokens):
                    part = ids[lo:lo + block_tokens]
                    n.append(len(part))
                    ends.append(np.flatnonzero(part == end_id).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()] * len(n), pa.string()), pa.array(range(len(n)), pa.int64()),
                     pa.array(n, pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
                    names=["file", "part", "n_tokens", "ends"])

    found = raw.mapInArrow(run, "file string, part long, n_tokens long, ends array<long>")
    order = F.struct(F.col("ordinal").alias("file"), F.col("part").alias("part"))
    return found.join(files.select("stream", "ordinal", "file"), "file").select(
        "stream", order.alias("block"), "n_tokens", "ends")


def stitch(blocks: DataFrame) -> DataFrame:
    """(stream, ordinal, start, n_tokens, ended) of every document from the blocks' ends.

    ``n_tokens`` leaves the end id out.  Tokens after a stream's last end form
    one more document with ``ended`` false.
    """
    b = (blocks.withColumn("grp", F.expr(f"block.file div {GROUP_FILES}")).withColumn("n_ends", F.size("ends").cast("long"))
         .withColumn("last", F.expr("get(ends, size(ends) - 1)")))
    inside = Window.partitionBy("stream", "grp").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    b = (b.withColumn("off", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
         .withColumn("ord", F.coalesce(F.sum("n_ends").over(inside), F.lit(0)))
         .withColumn("at", F.col("off") + F.col("last")).withColumn("prev", F.max("at").over(inside)))
    before = Window.partitionBy("stream").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("stream")
    groups = (b.groupBy("stream", "grp").agg(F.sum("n_tokens").alias("t"), F.sum("n_ends").alias("e"),
                                             F.max("at").alias("l"), F.max("block").alias("final"))
              .withColumn("g_off", F.coalesce(F.sum("t").over(before), F.lit(0)))
              .withColumn("g_ord", F.coalesce(F.sum("e").over(before), F.lit(0)))
              .withColumn("g_at", F.col("g_off") + F.col("l")).withColumn("g_prev", F.max("g_at").over(before))
              .withColumn("is_last", F.col("grp") == F.max("grp").over(whole))
              .select("stream", "grp", "g_off", "g_ord", "g_prev", "is_last", "final"))
    b = (b.join(groups, ["stream", "grp"])
         .withColumn("o", F.col("g_off") + F.col("off")).withColumn("k", F.col("g_ord") + F.col("ord"))
         .withColumn("p", F.coalesce(F.greatest("g_prev", F.col("g_off") + F.col("prev")), F.lit(-1))))
    ended = b.select("stream", "o", "k", "p", "ends", F.posexplode("ends").alias("i", "end")).select(
        "stream", (F.col("k") + F.col("i")).alias("ordinal"),
        (F.when(F.col("i") == 0, F.col("p")).otherwise(F.col("o") + F.expr("get(ends, i - 1)")) + 1).alias("start"),
        (F.col("o") + F.col("end")).alias("stop"), F.lit(True).alias("ended"))
    tail = b.where(F.col("is_last") & (F.col("block") == F.col("final"))).select(
        "stream", (F.col("k") + F.col("n_ends")).alias("ordinal"),
        (F.coalesce(F.col("o") + F.col("last"), F.col("p")) + 1).alias("start"),
        (F.col("o") + F.col("n_tokens")).alias("stop"), F.lit(False).alias("ended")).where("stop > start")
    return ended.unionByName(tail).select("stream", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"),
                                          "ended")


def token_counts(docs: DataFrame, tokenizer: str, end_id: int, token_bytes: int = 2,
                 file_tokens: int = FILE_TOKENS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens, start) of every document, counted in the flat files its tokens were written to.

    ``start`` is the document's place in its stream.  A null or empty text has 0
    tokens.  Null ids and repeated rows are documents of their own; an empty
    table gives an empty result; other columns are ignored, whatever their
    names; a very long text spans as many files and blocks as it needs.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    listed = write_token_files(docs, tokenizer, end_id, folder, file_tokens)
    files = listed.where("kind = 'file'")
    if not files.take(1):
        return listed.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("start")).limit(0)
    blocks = materialize(find_ends(spark, folder, files, end_id, token_bytes, block_tokens), "token-blocks")
    return listed.where("kind = 'doc'").select("doc_id", "stream", "ordinal").join(
        stitch(blocks), ["stream", "ordinal"]).select("doc_id", "n_tokens", "start")
