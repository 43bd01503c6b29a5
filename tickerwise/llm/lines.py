"""Line dedup: normalised lines held by several documents stay only in the document with the largest doc_id.

Lines are exploded to 128-bit keys, distinct documents are counted per key (two aggregations with map-side combine, so a
line held by a third of all documents is a handful of rows when it moves), keys over the threshold are joined back to
the lines, and each document is put together again by line position.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerwise.llm.common import Workspace

BLANK = b" \t\n\x0b\x0c\r"


def _keys(min_chars: int):
    def run(batches):
        for b in batches:
            ids, marks, rows, at, digests = b.column(0), b.column(1), [], [], []
            for r, text in enumerate(b.column(2)):
                data = (text.as_py() or "").encode().lower()  # bytes.lower() changes A-Z only
                for p, line in enumerate(data.split(b"\n")):
                    key = line.strip(BLANK)
                    if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                        rows.append(r)
                        at.append(p)
                        digests.append(hashlib.blake2b(key, digest_size=16).digest())
            pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            take = pa.array(rows, pa.int64())
            yield pa.record_batch([ids.take(take), marks.take(take), pa.array(at, pa.int32()), pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                                  names=["doc_id", "mark", "pos", "k1", "k2"])
    return run


def _reassemble(batches):
    for b in batches:
        lines, dropped, kept, digest = [], [], [], []
        for text, gone in zip(b.column(1), b.column(2)):
            have = (text.as_py() or "").split("\n")
            out = set(gone.as_py() or ())
            stay = "\n".join([x for i, x in enumerate(have) if i not in out])
            lines.append(len(have))
            dropped.append(len(out))
            kept.append(stay)
            digest.append(hashlib.sha256(stay.encode()).hexdigest())
        yield pa.record_batch([b.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digest, pa.string()),
                               pa.array(kept, pa.string()), b.column(3)],
                              names=["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text", "carry"])


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, carry: list[str] | None = None) -> DataFrame:
    """Drop lines that at least ``min_docs`` documents hold, except in the largest doc_id that holds them.

    A line's key: white space [\\x20\\x09-\\x0D] stripped, A-Z lower-cased; keys under ``min_chars`` code points never
    count.  Returns one row per input row: doc_id, n_lines (before), n_dropped, kept_sha256, kept_text, and ``carry`` (a
    struct of the named columns, unchanged).  Null or empty text: one empty line.  Rows with the same doc_id are one
    document.  A row without doc_id keeps all its lines and counts for nobody.  Every line of a document may go: the
    kept text is then empty.  Empty table: empty result.
    """
    work = Workspace(docs.sparkSession)
    rest = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text", rest.alias("carry"))
    lines = work.table(base.where("doc_id is not null").select("doc_id", "mark", "text")
                       .mapInArrow(_keys(min_chars), "doc_id long, mark long, pos int, k1 long, k2 long"), "lines")
    common = (lines.groupBy("k1", "k2").agg(F.count_distinct("doc_id").alias("held"), F.max("doc_id").alias("keeper"))
              .where(F.col("held") >= min_docs).select("k1", "k2", "keeper"))
    common = work.table(common, "common")  # both sides of the join are then dealt anew, so a hot line's rows can be split
    gone = (lines.join(common, ["k1", "k2"]).where("doc_id < keeper")
            .groupBy("doc_id", "mark").agg(F.collect_set("pos").alias("gone"))
            .select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "gone"))
    joined = base.join(gone, (base["doc_id"] == gone["d"]) & (base["mark"] == gone["m"]), "left").select("doc_id", "text", "gone", "carry")
    return joined.mapInArrow(_reassemble, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string, carry "
                             + base.schema["carry"].dataType.simpleString())
