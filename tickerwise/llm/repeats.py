"""Which keys are held by several documents: one exchange by key, safe for keys that a third of all documents hold.

Tasks pre-aggregate: what a task's own batch shows to be repeated is decided there, and a key leaves the batch as one
row.  A key's rows are then streamed in sorted order with one carried row, so no key is ever gathered in memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerwise.llm.common import partitions

FLUSH = 500_000  # keys pre-aggregated together in a task before they are sent
OPEN, REPEATED, DONE = 0, 1, 2  # state of a row: to be compared, known to be repeated, already decided


def schema(wide: bool) -> str:
    return "key long, " + "key2 long, " * wide + "doc long, state int"


def _distinct(key, key2, doc):
    order = np.lexsort((doc, key2, key))
    key, key2, doc = key[order], key2[order], doc[order]
    if len(key):
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (key2[1:] != key2[:-1]) | (doc[1:] != doc[:-1])
        key, key2, doc = key[new], key2[new], doc[new]
    return key, key2, doc


def _groups(key, key2):
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (key2[1:] != key2[:-1])
    return new, np.flatnonzero(new), np.cumsum(new) - 1


def _batch(key, key2, doc, state, wide: bool):
    i64 = lambda a: pa.array(a.view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64))
    cols = {"key": i64(key)} | ({"key2": i64(key2)} if wide else {}) | {"doc": i64(doc), "state": pa.array(state.astype(np.int32))}
    return pa.record_batch(cols)


class Sender:
    """Collects (key, key2, doc) arrays of one task and yields batches for the exchange.

    ``smaller``: a row is wanted if a smaller document holds its key; else if any other document does.
    """

    def __init__(self, smaller: bool, wide: bool):
        self.smaller, self.wide, self.parts, self.held = smaller, wide, [], 0

    def add(self, key, key2, doc):
        self.parts.append((key, key2, doc))
        self.held += len(key)
        if self.held >= FLUSH:
            yield from self.flush()

    def flush(self):
        if not self.parts:
            return
        key, key2, doc = _distinct(*(np.concatenate(x) for x in zip(*self.parts)))
        self.parts, self.held = [], 0
        if not len(key):
            return
        new, first, group = _groups(key, key2)
        several = np.diff(np.append(first, len(key))) > 1
        state = np.where(several[group] & (not self.smaller), REPEATED, OPEN)
        yield _batch(key[new], key2[new], doc[new], state[new], self.wide)
        decided = ~new if self.smaller else several[group]  # the batch itself holds another (a smaller) document with the key
        if decided.any():
            yield _batch(key[decided], key2[decided], doc[decided], np.full(int(decided.sum()), DONE), self.wide)


def _detect(smaller: bool, wide: bool):
    def run(batches):
        held = None  # the open key: (key, key2, first doc, repeated)
        for b in batches:
            key, doc, state = b.column(0).to_numpy(), b.column(1 + wide).to_numpy(), b.column(2 + wide).to_numpy()
            key2 = b.column(1).to_numpy() if wide else np.zeros(len(key), np.int64)
            done = state == DONE
            out = [(doc[done], key[done])]
            key, key2, doc, state = key[~done], key2[~done], doc[~done], state[~done]
            if len(key):
                new, first, group = _groups(key, key2)
                joins = held is not None and held[0] == key[0] and held[1] == key2[0]
                start = doc[first].copy()
                if joins:
                    start[0] = held[2]
                other = doc != start[group]
                if smaller:
                    out.append((doc[other], key[other]))
                    held = (key[-1], key2[-1], start[-1], False)
                else:
                    many = np.bincount(group, other | (state == REPEATED), len(first)) > 0
                    if joins:
                        if many[0] and not held[3]:
                            out.append((np.array([held[2]]), np.array([held[0]])))
                        many[0] |= held[3]
                    sent = many[group]
                    out.append((doc[sent], key[sent]))
                    held = (key[-1], key2[-1], start[-1], bool(many[-1]))
            yield pa.record_batch({"doc": pa.array(np.concatenate([o[0] for o in out])), "key": pa.array(np.concatenate([o[1] for o in out]))})
    return run


def repeated(rows: DataFrame, smaller: bool, wide: bool) -> DataFrame:
    """(doc, key) of the wanted rows; ``rows`` are a Sender's batches.  A pair may come more than once."""
    to = F.when(F.col("state") == DONE, F.xxhash64("key", "doc")).otherwise(F.col("key"))
    dealt = rows.repartition(partitions(rows.sparkSession), to).sortWithinPartitions("key", *["key2"] * wide, "doc")
    return dealt.mapInArrow(_detect(smaller, wide), "doc long, key long")
