"""Substring dedup by level-wise doubling: passages repeated at one length are extended to twice that length.

A window is ``window`` consecutive words of one document.  Levels run over lengths L, 2L, ... up to ``window`` (7, 13 by
default).  Below the last length a window is looked up through one of its sub-windows of that length: the one with the
smallest hash, which is the same wherever the window stands, so a repeated window is never lost and only about two in
``window - L + 2`` sub-windows travel.  Windows whose sub-window occurs in one document only are dropped; the rest go on
to twice the length, until none are left or the full length decides: a full window that also starts in a document with
a smaller doc_id has its words removed.

The exchange of keys is that of ``repeats``: safe for passages that a third of all documents hold.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerwise.llm.common import Workspace
from tickerwise.llm.repeats import Sender, repeated, schema
from tickerwise.llm.words import chunks, slide_min

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def lengths(window: int, start: int) -> list[int]:
    out = [min(start, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def _hashes(c, k: int = 0) -> np.ndarray:
    """Word hashes of a chunk, computed once."""
    if not hasattr(c, f"_hashes{k}"):
        setattr(c, f"_hashes{k}", c.hashes(k))
    return getattr(c, f"_hashes{k}")


def _anchors(c, window: int, length: int, second: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word: key, second key (if asked for) and validity of the window that starts there, at this level's length."""
    wh = _hashes(c)
    n = len(wh)
    key, key2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    fits = np.zeros(n, bool)
    if n >= window:
        fits[:n - window + 1] = c.row[:n - window + 1] == c.row[window - 1:]
        part, _ = c.shingles(wh, length)
        key[:n - window + 1] = slide_min(part[:n - length + 1], window - length + 1)
        if second:
            key2 = c.shingles(_hashes(c, 1), length, 1)[0] >> np.uint64(32)
    return key, key2, fits


def _emit(window: int, length: int, with_keys: bool):
    last = length == window

    def run(batches):
        sender = Sender(smaller=last, wide=last)
        for b in batches:
            docs = b.column(0)
            ids, there = docs.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), docs.is_valid().to_numpy(zero_copy_only=False)
            for c in chunks(b.column(1), "space", False):
                key, key2, fits = _anchors(c, window, length, second=last)
                fits &= there[c.lo:c.hi][c.row]
                if with_keys:
                    fits &= _candidates(c, window, b.column(3), int(b.column(2)[0].as_py()))
                if not last and len(fits):  # neighbours mostly share their sub-window
                    first = fits.copy()
                    first[1:] &= ~((key[1:] == key[:-1]) & fits[:-1] & (c.row[1:] == c.row[:-1]))
                    fits = first
                yield from sender.add(key[fits], key2[fits], ids[c.lo:c.hi][c.row[fits]])
        yield from sender.flush()
    return run


def _candidates(c, window: int, keys: pa.Array, length: int) -> np.ndarray:
    """Which windows of a chunk are still candidates: their key at ``length`` is among the row's surviving keys."""
    key, _, fits = _anchors(c, window, length)
    out = np.zeros(len(key), bool)
    for r in range(c.hi - c.lo):
        alive = keys[c.lo + r]
        if alive.is_valid and len(alive.values):
            s = slice(c.bound[r], c.bound[r + 1])
            out[s] = np.isin(key[s].view(np.int64), alive.values.to_numpy(zero_copy_only=False))
    return out & fits


def _finish(c, r: int, gone: np.ndarray | None) -> tuple[int, int, str]:
    words = c.word_bytes(r)
    kept = words if gone is None else [w for w, g in zip(words, gone) if not g]
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _covered(starts: np.ndarray, window: int) -> np.ndarray:
    n = len(starts)
    edge = np.zeros(n + window, np.int64)
    at = np.flatnonzero(starts)
    edge[at] += 1
    edge[at + window] -= 1
    return np.cumsum(edge)[:n] > 0


def _split(window: int, length: int, before: bool):
    """Rows (doc_id, text, [length, keys before,] keys): documents without a candidate get their result, the others go on."""
    def run(batches):
        for b in batches:
            rows = []
            for c in chunks(b.column(1), "space", False):
                alive = _candidates(c, window, b.column(b.num_columns - 1), length)
                if before:
                    alive &= _candidates(c, window, b.column(3), int(b.column(2)[0].as_py()))
                for r in range(c.hi - c.lo):
                    s = slice(c.bound[r], c.bound[r + 1])
                    d = b.column(0)[c.lo + r].as_py()
                    if alive[s].any():
                        rows.append((d, None, None, None, b.column(1)[c.lo + r].as_py(), length, b.column(b.num_columns - 1)[c.lo + r].as_py()))
                    else:
                        rows.append((d, *_finish(c, r, None), None, None, None))
            yield pa.record_batch([pa.array([x[i] for x in rows], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64())))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "text", "length", "keys"])
    return run


def _remove(window: int, with_text: bool):
    """Rows (doc_id, text, length, keys, keys that start in a smaller document): remove every covered word."""
    def run(batches):
        for b in batches:
            rows = []
            for c in chunks(b.column(1), "space", False):
                hit = _candidates(c, window, b.column(4), window)
                if b.num_rows and b.column(2)[0].is_valid:
                    hit &= _candidates(c, window, b.column(3), int(b.column(2)[0].as_py()))
                for r in range(c.hi - c.lo):
                    gone = _covered(hit[c.bound[r]:c.bound[r + 1]], window)
                    kept = [w for w, g in zip(c.word_bytes(r), gone) if not g] if with_text else None
                    rows.append((b.column(0)[c.lo + r].as_py(), *_finish(c, r, gone), b" ".join(kept).decode() if with_text else None))
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * with_text
            yield pa.record_batch([pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], names=names)
    return run


def _survivors(df: DataFrame, window: int, length: int, with_keys: bool) -> DataFrame:
    last = length == window
    found = repeated(df.mapInArrow(_emit(window, length, with_keys), schema(wide=last)), smaller=last, wide=last)
    return found.groupBy("doc").agg(F.collect_list("key").alias("found"))


def _level(source: DataFrame, window: int, length: int, with_keys: bool, work: Workspace) -> DataFrame:
    """One level written as a table: finished documents with their result, the others with text and surviving keys."""
    found = _survivors(source, window, length, with_keys)
    joined = source.join(found, source["doc_id"] == found["doc"], "left").drop("doc")
    return work.table(joined.mapInArrow(_split(window, length, with_keys), RESULT + ", text string, length int, keys array<long>"), f"level-{length}")


def substring_dedup(docs: DataFrame, window: int = 13, start: int = 7) -> DataFrame:
    """Remove words covered by a window that also starts in a document with a smaller ``doc_id``.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored.  Returns one row per input row: doc_id,
    n_words, n_removed, kept_sha256 (hash of the kept words joined by one space).  Null or empty text: no words.  A
    text shorter than the window loses nothing.  Rows with the same doc_id are one document: they never count against
    each other.  Rows without a doc_id pass unchanged and count for nobody.  Empty table: empty result.
    Windows are matched by two independent hashes of their words, of 64 and 32 bits.
    """
    spark = docs.sparkSession
    work = Workspace(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    levels = lengths(window, start)
    state, results = None, []
    for length in levels[:-1]:
        table = _level(base if state is None else state, window, length, state is not None, work)
        work.release()
        results.append(table.where("text is null").select("doc_id", "n_words", "n_removed", "kept_sha256"))
        state = table.where("text is not null").select("doc_id", "text", "length", "keys")
        if state.isEmpty():
            break
    if state is None:
        state = base.select("doc_id", "text", F.lit(None).cast("int").alias("length"), F.lit(None).cast("array<long>").alias("keys"))
    found = _survivors(state if len(levels) > 1 else base, window, window, len(levels) > 1)
    final = state.join(found, state["doc_id"] == found["doc"], "left").drop("doc").mapInArrow(_remove(window, False), RESULT)
    for r in results:
        final = final.unionByName(r)
    return final
