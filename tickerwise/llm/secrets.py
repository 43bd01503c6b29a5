"""Secret scan: fixed patterns, and dictionary-primed zstandard novelty of strings in a sensitive context.

The identifiers of all documents are counted; the commonest fill a dictionary of at most ``DICTIONARY`` bytes, which primes
the compressor.  A candidate is a long run of key characters shortly after a sensitive word.  What it adds to the
compressed size of the text around it, next to its length, is its novelty: identifiers, paths and prose repeat pieces of the
dictionary or of their surroundings, random strings do not.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerwise.llm.common import small_batches

DICTIONARY = 1 << 16  # bytes of the identifier dictionary, and so the most that reaches the driver
DISTINCT = 300_000    # identifiers that a task holds before it sends its counts on
REACH = 64            # code points from the end of a sensitive word to the start of a candidate
AROUND = 256          # code points on either side that a candidate is measured against
SHORTEST = 20         # characters of a candidate
NOVEL = 0.7           # compressed bytes a byte from which a candidate is reported
LEVEL = 12

# fixed values: the kinds of base spans in their order, and their patterns
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the same spans as [0-9a-f]+ of 32 characters or more, found faster
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SENSITIVE = re.compile(r"passw|pwd|secret|token|api.?key|private.?key|access.?key|credential|auth|bearer|signature", re.I | re.A)
HINTS = ("passw", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "signature")
RUN = re.compile(r"[A-Za-z0-9+/_.=~-]+")
IDENTIFIER = re.compile(r"\b[A-Za-z_]{4,24}\b", re.A)  # whole words: no pieces of keys


def _count(batches):
    """Identifiers of whole texts, whole words without digits: keys that are copied all over must not enter the dictionary."""
    seen: Counter = Counter()

    def batch():
        out = pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        seen.clear()
        return out

    for b in batches:
        for t in b.column(0).to_pylist():
            if t:
                seen.update(IDENTIFIER.findall(t))
            if len(seen) > DISTINCT:
                yield batch()
    if seen:
        yield batch()


def identifiers(docs: DataFrame, size: int = DICTIONARY) -> bytes:
    """The identifiers of all texts that save most (count x length), best last, in at most ``size`` bytes."""
    small_batches(docs.sparkSession)
    counts = docs.select("text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    best = counts.orderBy(F.desc(F.col("n") * F.length("word")), "word").limit(size // 5)  # an identifier takes five bytes or more
    # one row to the driver: the best of all tasks meet in a task, not there
    rows = best.agg(F.collect_list(F.struct("n", "word")).alias("best")).first()["best"]
    words, used = [], 0
    for r in sorted(rows, key=lambda r: (-r["n"] * len(r["word"]), r["word"])):
        used += len(r["word"]) + 1
        if used > size:
            break
        words.append(r["word"])
    return " ".join(reversed(words)).encode()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start, then kind."""
    spans = []
    low = text.lower()
    if any(w in low for w in WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, taken: list[tuple[int, int, int]]):
    """(start, end) of runs of key characters that start shortly after a sensitive word and meet no span of ``taken``."""
    low = text.lower()
    if not any(h in low for h in HINTS):
        return
    spans, at, done = sorted((s, e) for s, _, e in taken), 0, 0
    for hit in SENSITIVE.finditer(text):
        if hit.end() < done:
            continue  # inside a run that was looked at
        for m in RUN.finditer(text, max(hit.end(), done), hit.end() + REACH):
            if m.start() and RUN.match(text[m.start() - 1]):
                continue  # the rest of the sensitive word itself
            start, end = m.start(), RUN.match(text, m.start()).end()
            done = max(done, end)
            while at < len(spans) and spans[at][1] <= start:
                at += 1
            if end - start >= SHORTEST and not (at < len(spans) and spans[at][0] < end):
                yield start, end


class Novelty:
    """Compressed bytes that a string adds to the text around it, a byte of the string."""

    def __init__(self, dictionary: bytes):
        import zstandard
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
        if primed:
            primed.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_checksum=False).compress

    def __call__(self, text: str, start: int, end: int) -> float:
        string = text[start:end]
        around = (text[max(0, start - AROUND):start] + "\n" + text[end:end + AROUND]).replace(string, "")  # its own copies do not make it old
        around, own = around.encode(), string.encode()
        return (len(self.compress(around + b"\n" + own)) - len(self.compress(around))) / len(own)


def _scanner(dictionary: bytes, novel: float):
    def scan(batches):
        measure = Novelty(dictionary)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                base = base_spans(text or "")
                new = [(s, 3, e) for s, e in candidates(text or "", base)
                       if any(c.isdigit() for c in text[s:e]) and any(c.isalpha() for c in text[s:e]) and measure(text, s, e) >= novel]
                say = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
                kinds = [k for _, k, _ in base]
                rows.append((doc, kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(say(base).encode()).hexdigest(), len(new), say(base + new)))
            cols = list(zip(*rows)) or [()] * 7
            yield pa.record_batch([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.int64()),
                                   pa.array(cols[6], pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "n_novel", "spans"])
    return scan


def scan_secrets(docs: DataFrame, dictionary: bytes | None = None, novel: float = NOVEL) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, n_novel and spans (kind:start:end by start, then kind).

    Offsets count code points, the end is exclusive.  ``novel`` spans are strings of 20 or more key characters with letters and
    digits, at most 64 code points after a sensitive word, that the compressor cannot shorten below ``novel`` of their length; they never overlap
    a base span.

    Defined results: null and empty texts have no spans; repeated rows are scanned each; every text is scanned whole, in time linear in
    its length; an empty table gives no rows; other columns are not read.  The dictionary is made of ``docs`` unless one is given.
    """
    small_batches(docs.sparkSession)
    primed = identifiers(docs) if dictionary is None else dictionary
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_scanner(primed, novel), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, n_novel long, spans string"))
