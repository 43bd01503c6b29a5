"""Language ID by Bayesian evidence fusion.

The posterior over languages combines
* the text: byte-trigram likelihoods, counted per declared language over all labelled rows (hashed to a fixed number of
  features, so the model's size depends on the number of languages only) and tempered, as neighbouring trigrams overlap;
  every declared language is modelled: languages are trained and scored ``BLOCK`` at a time;
* the declared markup language: P(declared | language), counted by grouped aggregation against the text's own verdict;
* the address suffix: P(suffix | language), likewise;
* the host: a prior smoothed hierarchically, host -> registered domain -> suffix -> all, each level shrunk to the next by
  ``SHRINK`` pseudo-rows, with the row's own vote taken out.
Hosts, suffixes and declared values are aggregated with map-side combine and joined back to compact rows without texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerwise.llm.common import Workspace, sum_counters
from tickerwise.llm.words import chunks

FEATURES = 1 << 15
SLICE = 1 << 14
BLOCK = 64           # languages counted or scored in one pass: bounds a task's and the driver's memory, not the languages
FULL_WEIGHT = 60     # trigrams whose evidence counts in full; of longer texts the mean of as many
SHRINK = 20.0
MIN_TRIGRAMS = 3     # fewer: no text evidence, language undetermined
_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def _trigrams(c) -> tuple[np.ndarray, np.ndarray]:
    """(feature of each byte position that starts a trigram with a letter in its middle, row of it)."""
    b = _LETTER[c.buf].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    row = np.repeat(np.arange(c.hi - c.lo), np.diff(c.offsets))
    use = (b[1:-1] != 0x20) & (row[:-2] == row[2:])
    code = code[use] * np.uint32(2654435769)
    return (code >> np.uint32(17)).astype(np.int64), row[:-2][use]


class Likelihoods:
    """log P(trigram | language) in blocks of languages; all blocks but the first wait in the shared folder."""

    def __init__(self, spark):
        self.work, self.first, self.rest = Workspace(spark), np.zeros((0, FEATURES), np.float32), []

    def add(self, block: np.ndarray) -> None:
        if not len(self.first):
            self.first = block
            return
        name = f"likelihoods-{len(self.rest)}"
        self.rest.append(self.work.table(self.work.spark.createDataFrame([(block.tobytes(),)], "logp binary"), name))

    def __len__(self) -> int:
        return 1 + len(self.rest)

    def __iter__(self) -> Iterator[np.ndarray]:
        yield self.first
        for table in self.rest:
            yield np.frombuffer(table.first()["logp"], np.float32).reshape(-1, FEATURES)


def train(labelled: DataFrame) -> tuple[list[str], Likelihoods]:
    """Languages and log P(trigram | language) from all rows of (text, lang); null languages and texts are left out."""
    some = labelled.where("lang is not null and text is not null").select("text", "lang")
    languages = [r["lang"] for r in some.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    logp = Likelihoods(labelled.sparkSession)
    for lo in range(0, len(languages), BLOCK):
        part = languages[lo:lo + BLOCK]
        logp.add(_likelihood(some if len(languages) <= BLOCK else some.where(F.col("lang").isin(part)), part))
    return languages, logp


def _likelihood(some: DataFrame, languages: list[str]) -> np.ndarray:
    """log P(trigram | language) from rows of these languages only."""
    at = {x: i for i, x in enumerate(languages)}

    def count(batches):
        total = np.zeros((len(languages), FEATURES), np.int64)
        for b in batches:
            lang = np.array([at[x] for x in b.column(1).to_pylist()], np.int64)
            for c in chunks(b.column(0), "space", False):
                f, r = _trigrams(c)
                total += np.bincount(lang[c.lo:c.hi][r] * FEATURES + f, minlength=total.size).reshape(total.shape)
        flat = total.reshape(-1, SLICE)
        on = np.flatnonzero(flat.any(axis=1))
        yield pa.record_batch({"slice": pa.array(on, pa.int32()), "counts": pa.array([flat[s].tobytes() for s in on], pa.binary())})

    counts = np.zeros((len(languages) * FEATURES // SLICE, SLICE), np.int64)
    for s, c in sum_counters(some.mapInArrow(count, "slice int, counts binary")).items():
        counts[s] = c
    counts = counts.reshape(len(languages), FEATURES) + 0.5
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _score(logp: np.ndarray, last: bool):
    """(key, text, scores by the blocks before) -> tempered log likelihood per language, trigrams, and after the ``last``
    block the text's own verdict (-1: none), before it the text for the next one."""
    table = np.ascontiguousarray(logp.T)

    def run(batches):
        for b in batches:
            scores, count = [np.zeros((0, len(logp)))], [np.zeros(0, np.int64)]
            for c in chunks(b.column(1), "space", False):
                f, r = _trigrams(c)
                n = np.bincount(r, minlength=c.hi - c.lo)
                s = np.stack([np.bincount(r, table[f, k], minlength=c.hi - c.lo) for k in range(len(logp))], axis=1) if len(logp) else np.zeros((c.hi - c.lo, 0))
                scores.append(s * (np.minimum(n, FULL_WEIGHT) / np.maximum(n, 1) / 3)[:, None])
                count.append(n)
            s, n = np.concatenate(scores), np.concatenate(count)
            if b.num_columns > 2 and len(s):
                s = np.concatenate([b.column(2).flatten().to_numpy().reshape(len(s), -1), s], axis=1)
            if last:
                own = pa.array(np.where(n >= MIN_TRIGRAMS, s.argmax(axis=1) if s.shape[1] else -1, -1), pa.int32())
            else:
                own = b.column(1)
            yield pa.record_batch([b.column(0), pa.array(list(s), pa.list_(pa.float64())), pa.array(n, pa.int64()), own],
                                  names=["key", "scores", "trigrams", "top" if last else "text"])
    return run


def _fuse(languages: list[str], overall: np.ndarray):
    """Rows with counts per evidence value -> posterior."""
    k = len(languages)

    def votes(col):
        out, flat = np.zeros((len(col), k)), col.flatten()
        row = np.repeat(np.arange(len(col)), pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False))
        out[row, flat.field("top").to_numpy()] = flat.field("n").to_numpy()
        return out

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            top, n = col["top"].to_numpy(), col["trigrams"].to_numpy()
            own = np.zeros((len(top), k))
            own[np.flatnonzero(top >= 0), top[top >= 0]] = 1
            prior = (overall - own + 0.5) / (overall.sum() - own.sum(1, keepdims=True) + 0.5 * k)
            log = np.where((n >= MIN_TRIGRAMS)[:, None], col["scores"].flatten().to_numpy().reshape(-1, k), 0)
            for name in ("declared", "suffix"):  # likelihood of the value seen, add-one smoothed
                seen, have = votes(col[f"by_{name}"]), col[name].is_valid().to_numpy(zero_copy_only=False)
                log += np.where(have[:, None], np.log((seen - own + 1) / (overall - own + 2)), 0)
            for name in ("suffix", "domain", "host"):
                have = col[name].is_valid().to_numpy(zero_copy_only=False)[:, None]
                seen = np.where(have, votes(col[f"by_{name}"]) - own, 0)
                if name != "suffix":  # the suffix has its say as a likelihood; as a prior it only smooths the levels below
                    prior = (seen + SHRINK * prior) / (seen.sum(1, keepdims=True) + SHRINK)
            log += np.log(prior)
            log -= log.max(axis=1, keepdims=True)
            p = np.exp(log)
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            known = n >= MIN_TRIGRAMS
            pick = [languages[i] if ok else "und" for i, ok in zip(best, known)]
            yield pa.record_batch([col["key"], pa.array(pick), pa.array(np.where(known, p.max(axis=1), 0.0)),
                                   pa.array([languages[i] if i >= 0 else None for i in top], pa.string()), col["trigrams"]],
                                  names=["key", "language", "posterior", "text_language", "trigrams"])
    return run


def identify(items: DataFrame, languages: list[str], logp: Likelihoods, work: Workspace, name: str = "evidence") -> DataFrame:
    """Language of each row of (key, text, declared, host, domain, suffix); any of the last four may be null.

    Returns key, language ('und' under MIN_TRIGRAMS letter trigrams), posterior (0 for 'und'), text_language (by text
    alone) and trigrams.  Null text counts as empty.  Declared values and addresses that are new to the model are weak evidence,
    not errors.  Repeated rows are judged alike.  Without any language (empty training table) all rows are 'und'.
    """
    keys = ["declared", "suffix", "domain", "host"]
    packed = items.select(F.struct("key", *keys).alias("key"), "text")
    kind = packed.schema["key"].dataType.simpleString()
    for i, block in enumerate(logp):
        last = i + 1 == len(logp)
        rows = packed.mapInArrow(_score(block, last), f"key {kind}, scores array<double>, trigrams long, " + ("top int" if last else "text string"))
        packed = work.table(rows.select("key.*", "scores", "trigrams", "top") if last else rows.select("key", "text", "scores"), name if last else f"{name}-{i}")
        if i:
            work.drop(f"{name}-{i - 1}")
    scored = packed
    if not languages:
        return scored.select("key", F.lit("und").alias("language"), F.lit(0.0).alias("posterior"), F.lit(None).cast("string").alias("text_language"), "trigrams")
    overall = np.zeros(len(languages))
    for r in scored.where("top >= 0").groupBy("top").count().collect():
        overall[r["top"]] = r["count"]
    out = scored
    for k in keys:
        seen = scored.where(F.col(k).isNotNull() & (F.col("top") >= 0)).groupBy(k, "top").agg(F.count("*").cast("double").alias("n"))
        out = out.join(seen.groupBy(k).agg(F.collect_list(F.struct("top", "n")).alias(f"by_{k}")), k, "left")
    out = out.select("key", *keys, *[f"by_{k}" for k in keys], "scores", "trigrams", "top")
    inner = scored.schema["key"].dataType.simpleString()
    return out.mapInArrow(_fuse(languages, overall), f"key {inner}, language string, posterior double, text_language string, trigrams long")


def page_items(pages: DataFrame) -> DataFrame:
    """Evidence rows of raw pages: visible text, the html element's lang, host, registered domain and address suffix."""
    from tickerwise.llm.warc import plain_text
    host = F.lower(F.nullif(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))
    parts = F.split(host, r"\.")
    declared = F.nullif(F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1)), F.lit(""))
    return pages.select(F.struct(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id")).alias("key"),
                        plain_text(F.col("html")).alias("text"), declared.alias("declared"), host.alias("host"),
                        F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, -2, 2), ".")).alias("domain"),
                        F.when(F.size(parts) >= 2, F.element_at(parts, -1)).alias("suffix"))


def document_items(docs: DataFrame) -> DataFrame:
    """Evidence rows of documents: the declared language and, as host, the source; they have no address."""
    none = F.lit(None).cast("string")
    return docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id")).alias("key"),
                       "text", F.col("lang").alias("declared"), F.col("source").alias("host"), none.alias("domain"), none.alias("suffix"))


def accepted(min_posterior: float = 0.5) -> Column:
    """Keep what has a language at all and one that is likelier than all others together."""
    return (F.col("language") != "und") & (F.col("posterior") >= min_posterior)
