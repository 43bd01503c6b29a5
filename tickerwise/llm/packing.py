"""Sum-of-squares online packing of tokenised documents into fixed windows.

Each task packs the documents of its partition in the order they come.  A document's full windows are cut off first; the
rest goes to the fill level that makes the sum of squared numbers of partially filled windows smallest.  The state is
an array with the number of open windows at each level, and the pieces in open windows.  Open windows are limited:
beyond the limit, and at the end, windows that lack at most ``max_gap`` tokens are closed with padding, and the pieces
of the others are cut to fill windows completely; what is left at the end fills windows whose lengths are powers of
two, which need no padding.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerwise.llm.common import small_batches

GENERATION = 300_000     # pieces in each of the two generations whose ids a worker remembers
LONGEST_CACHED = 64
JOINED = 2_000           # new pieces encoded in one call
_cache: dict[str, tuple] = {}

# fixed values: the tokenizer's rule for pieces, its special tokens, and the contractions it keeps whole
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]
SPECIAL = ["<|startoftext|>", "<|endoftext|>"]


def _plain() -> tuple[re.Pattern, re.Pattern]:
    """(texts whose pieces Python finds exactly as the tokenizer does, the pieces of such a lower-cased text).

    Those are texts of printable ASCII, ASCII white space and the Latin letters and signs up to U+024F: there normal form C changes
    nothing and lower-casing is one to one.  Capitals whose lower form is not one character of that range are left out.
    """
    within = {chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x250))}
    chars = sorted(c for c in within if c.lower() in within)
    group = lambda kind: "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind)
    letters, numbers = group("L"), group("N")
    blank = " \t\n\x0b\x0c\r"
    return (re.compile(f"[{re.escape(''.join(chars))}{blank}]*"),
            re.compile("|".join(CONTRACTIONS) + f"|[{letters}]+|[{numbers}]|[^{blank}{letters}{numbers}]+"))


def encoder(path: str):
    """texts -> their ids as little-endian 32-bit bytes, equal to the tokenizer's.

    The tokenizer cuts a text into pieces (letters, single digits, runs of signs) and encodes each on its own, so a text's
    ids are those of its pieces, one after the other, and a piece's ids can be remembered.  Texts with other characters or special
    tokens are cut at ASCII white space only, across which no step of the tokenizer looks, and these runs are
    encoded whole.
    """
    if path not in _cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers
        t = Tokenizer.from_file(path)
        model = json.loads(t.to_str())["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        bare = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=model["end_of_word_suffix"], cache_capacity=0))
        bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends = np.zeros(t.get_vocab_size(), bool)
        ends[[i for w, i in t.get_vocab().items() if w.endswith("</w>")]] = True
        _cache[path] = (t, bare, ends, [{}, {}], [{}, {}], *_plain())
    tokenizer, bare, ends, pieces, runs, plain, cut = _cache[path]

    def each(words: list[str], known: dict, key) -> dict:
        late = {}
        for w, e in zip(words, tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            (known if len(w) <= LONGEST_CACHED else late)[key(w)] = np.array(e.ids, "<u4").tobytes()
        return late

    def learn(fresh: list[str], known: dict) -> dict:
        """Ids of new pieces, by the tokenizer's model alone: they are lower-cased and cut already.  A piece ends with the only
        id of its kind, so many are encoded in one call."""
        late = {}
        for lo in range(0, len(fresh), JOINED):
            part = fresh[lo:lo + JOINED]
            ids = np.array(bare.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stop = np.flatnonzero(ends[ids]) + 1
            if len(stop) != len(part) or stop[-1] != len(ids):
                late |= each(part, known, lambda w: w)
                continue
            data, a = ids.tobytes(), 0
            for w, z in zip(part, stop.tolist()):
                (known if len(w) <= LONGEST_CACHED else late)[w] = data[4 * a:4 * z]
                a = z
        return late

    def learn_runs(fresh: list[bytes], known: dict) -> dict:
        return each([w.decode() for w in fresh], known, str.encode)

    def join(words: list[list], generations: list[dict], more) -> list[bytes]:
        """Ids of all words; words not met for a whole generation are forgotten."""
        need = set().union(*words)
        fresh = need.difference(generations[0])
        if len(generations[0]) + len(fresh) > GENERATION:
            generations[:] = {}, generations[0]
            fresh = need
        known, old = generations
        unknown = []
        for w in fresh:
            ids = old.get(w)
            if ids is None:
                unknown.append(w)
            else:
                known[w] = ids
        late = more(unknown, known)
        if late:
            return [b"".join([known[x] if x in known else late[x] for x in w]) for w in words]
        return [b"".join(map(known.__getitem__, w)) for w in words]

    def encode(texts: list[str]) -> list[bytes]:
        easy = [plain.fullmatch(t) is not None and not any(x in t for x in SPECIAL) for t in texts]
        found = join([cut.findall(t.lower()) for t, e in zip(texts, easy) if e], pieces, learn)
        rest = join([t.encode().split() for t, e in zip(texts, easy) if not e], runs, learn_runs)
        found, rest = iter(found), iter(rest)
        return [next(found if e else rest) for e in easy]
    return encode


class Levels:
    """Open windows by fill level; the level array drives the placement."""

    def __init__(self, window: int):
        self.window, self.count = window, np.zeros(window + 1, np.int64)
        self.at: list[list[list]] = [[] for _ in range(window)]
        self.open = 0

    def place(self, size: int, piece) -> list | None:
        """Put a piece in its best level; returns the window's pieces if that fills it."""
        n, w = self.count, self.window
        # change of the sum of squares: from level h to h + size (a full window no longer counts)
        change = 2 * n[size:w + 1] + 1
        change[-1] = 0
        change[1:] -= 2 * n[1:w - size + 1] - 1
        change[1:][n[1:w - size + 1] == 0] = np.iinfo(np.int64).max
        best = len(change) - 1 - int(np.argmin(change[::-1]))  # ties: the fullest window
        if best:
            pieces = self.at[best].pop()
            n[best] -= 1
        else:
            pieces = []
            self.open += 1
        pieces.append(piece)
        if best + size == w:
            self.open -= 1
            return pieces
        n[best + size] += 1
        self.at[best + size].append(pieces)
        return None

    def drain(self) -> list[tuple[int, list]]:
        """All open windows, fullest first; none stay."""
        out = [(h, p) for h in range(self.window - 1, 0, -1) for p in self.at[h]]
        self.__init__(self.window)
        return out


def _pack(path: str, window: int, end_id: int, max_gap: int, max_open: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, levels, rows, made = encoder(path), Levels(window), [], 0
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40

        def close(pieces, padded: int):
            nonlocal made
            offset, used = 0, sum(len(p[2]) // 4 for p in pieces)
            for doc, start, ids, total in pieces:
                n = len(ids) // 4
                rows.append((doc, start, n, zlib.crc32(ids), total, first + made, offset, used, padded) + ((ids,) if with_ids else ()))
                offset += n
            made += 1

        def settle(final: bool):
            rest = []
            for fill, pieces in levels.drain():
                if window - fill <= max_gap:
                    close(pieces, window)
                else:
                    rest += pieces
            left = sum(len(p[2]) // 4 for p in rest)
            held: list = []
            room = window if left >= window else _part(left)
            want = room
            for doc, start, ids, total in rest:
                at = 0
                while at < len(ids):
                    if not final and left < window and room == want:  # the tail stays open
                        tail = (doc, start + at // 4, ids[at:], total)
                        held.append(tail)
                        at = len(ids)
                        continue
                    take = min(room, (len(ids) - at) // 4)
                    held.append((doc, start + at // 4, ids[at:at + 4 * take], total))
                    at, room = at + 4 * take, room - take
                    if room == 0:
                        close(held, want)
                        held, left = [], left - want
                        room = want = window if left >= window else _part(left)
            if held:  # not final: one open window
                fill = sum(len(p[2]) // 4 for p in held)
                levels.at[fill].append(held)
                levels.count[fill] += 1
                levels.open += 1

        for b in batches:
            texts = b.column(1)
            for lo in range(0, len(texts), 512):
                part = [t or "" for t in texts.slice(lo, 512).to_pylist()]
                for r, ids in enumerate(encode(part)):
                    ids, doc = ids + end, b.column(0)[lo + r].as_py()
                    total = len(ids) // 4
                    whole = total // window * window
                    for s in range(0, whole, window):
                        close([(doc, s, ids[4 * s:4 * (s + window)], total)], window)
                    if total > whole:
                        full = levels.place(total - whole, (doc, whole, ids[4 * whole:], total))
                        if full:
                            close(full, window)
                    if levels.open > max_open:
                        settle(False)
                    if len(rows) >= 2_000:
                        yield _out(rows, with_ids)
                        rows.clear()
        settle(True)
        yield _out(rows, with_ids)
    return run


def _part(n: int) -> int:
    """Largest power of two within n (0 for 0)."""
    return 1 << (n.bit_length() - 1) if n else 0


COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, sequence_length long"


def _out(rows, with_ids: bool) -> pa.RecordBatch:
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
    if with_ids:
        names, cols = [*names, "ids"], [*cols, pa.array([r[-1] for r in rows], pa.binary())]
    return pa.record_batch(cols, names=names)


def pack(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, max_gap: int = 32, max_open: int = 1024,
         with_ids: bool = False) -> DataFrame:
    """Pack documents into windows; one row per piece.

    Returns doc_id, start (ids of the document before the piece), length, ids_crc32, doc_tokens, sequence_id, offset (in the
    sequence, gapless from 0), sequence_tokens, sequence_length (with padding: ``window`` or a power of two), and the
    ids as bytes if ``with_ids``.  A document's ids are the tokenizer's (file ``tokenizer``, the same path on every
    executor) plus ``end_id``; null or empty text has that one id.  Every id lies in exactly one piece.  Repeated rows
    and null doc_ids are ordinary rows.  Empty table: empty result.  Sequence ids hold the partition, so a repeated task gives the
    same ids.
    """
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pack(tokenizer, window, end_id, max_gap, max_open, with_ids), COLUMNS + (", ids binary" if with_ids else ""))
