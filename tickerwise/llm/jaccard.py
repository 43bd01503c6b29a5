"""Exact n-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds its distinct word shingles.  In a set x with similarity threshold t at most
``slack = |x| - ceil(t|x|)`` shingles are missing from a partner.  So, with one global order of shingles, two similar sets
share at least l shingles among the first ``slack + l`` of each, for every l, and the same holds inside any part of the
shingle space of which a set has that many.  The order is by exact rarity.  Each document estimates from the counts of
its prefix shingles how many candidates it would meet; where that is many, it takes a longer prefix (larger l), and a
pair must share the smaller l of the two before it is verified.

Shape of the job (no step is quadratic in a class of copies, and only texts of likely partners travel):
1. One pass writes size and 128-bit digest, a second sends the shingles that are indexed: everything for small sets, for larger ones a
   fixed share of the hash space (``TIERS``, in slacks).  Sets just above a tier's limit are in both tiers.  Should a set have
   too few shingles in its share, all sets of its size and the sizes beside it are indexed in full as well.
2. Shingles held by one class of equal sets only are found in one exchange (``repeats``).  A set with more of them than
   its slack has no partner and is done.
3. The rest orders its shared shingles by count.  Prefix shingles of two or more classes make candidate links: pairs with
   enough matches where a shingle has few holders, a star around the smallest holder where it has many.
4. Connected candidates form clumps, cut into cells of bounded size by set size and hash; texts go to pairs of cells,
   where the multi-match test and then the exact similarity decide, and only a spanning forest of links comes out.
5. Connected components over classes give every document the smallest doc_id it reaches.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerwise.llm.common import Workspace, connected_components
from tickerwise.llm.repeats import Sender, repeated, schema
from tickerwise.llm.words import Chunk, chunks, mix

MAX_MATCH = 4       # longest prefix extension: up to 4 shared shingles are asked for
FEW = 16            # a shingle held by at most so many classes makes pairs, by more a star
CELL = 400          # documents of a clump that are compared in one task
CANDIDATES = 8      # estimated candidates per required match above which a prefix is lengthened
#: (smallest set size, indexed share of the shingles in slacks; None: all of them)
TIERS = [(0, None), (200, 2.5), (800, 1.7)]
_SALT = np.uint64(0xA0761D6478BD642F)
_PARTS = [np.uint64(k * 0x5851F42D4C957F2D % 2**64) for k in range(4)]  # the tiers, then sizes with a short set in full


def _rows(c: Chunk, n: int):
    """Per row of a chunk: distinct shingle hashes, sorted."""
    wh = c.hashes()
    sh, _ = c.shingles(wh, n)
    for r in range(c.hi - c.lo):
        a, b = c.bound[r], c.bound[r + 1]
        if b - a >= n:
            yield np.unique(sh[a:b - n + 1])
        elif b > a:  # fewer words than a shingle: the whole sequence is the only member
            acc = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in wh[a:b]:
                    acc = acc * np.uint64(0x9FB21C651E98DF25) + x
            yield mix(np.array([acc], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _need(n, num: int, den: int):
    return -(-num * n // den)


def _step(n: int, num: int, den: int) -> int:
    """Size step of a set: similar sets lie in the same step or in neighbouring ones."""
    return math.floor(math.log(n) / (1.01 * math.log(den / num)))


def _parts(shingle: int, num: int, den: int, full: frozenset | None):
    """What of a set is indexed in each part: its shingles, or None; ``full``: only sets of these size steps, in full."""
    tiers = [(lo, TIERS[k + 1][0] if k + 1 < len(TIERS) else None,
              None if share is None else np.uint64(min(2**64 - 1, int(min(1.0, share * (den - num) / den) * 2**64))))
             for k, (lo, share) in enumerate(TIERS)]

    def parts(h: np.ndarray) -> list:
        n, mine = len(h), [None] * 4
        if full is None:
            for k, (lo, above, limit) in enumerate(tiers):
                if n and lo <= n and (above is None or n * num < above * den):
                    mine[k] = h if limit is None else h[:np.searchsorted(h, limit, side="right")]
        elif n and _step(n, num, den) in full:
            mine[3] = h
        return mine
    return parts


def _digests(h: np.ndarray) -> tuple[int, int]:
    return int(mix(h).sum(dtype=np.uint64).view(np.int64)), int(mix(h ^ _SALT).sum(dtype=np.uint64).view(np.int64))


def _profile(shingle: int, num: int, den: int, lower: bool, full: frozenset | None = None):
    """(doc_id, text) -> size, digest and how many shingles each part indexes; the shingles themselves are not kept."""
    indexed = _parts(shingle, num, den, full)

    def run(batches):
        for b in batches:
            d1, d2, size, short, held = [], [], [], [], ([], [], [], [])
            for c in chunks(b.column(1), "space", lower):
                for h in _rows(c, shingle):
                    n, (x, y), mine = len(h), _digests(h), indexed(h)
                    d1.append(x)
                    d2.append(y)
                    size.append(n)
                    short.append(any(m is not None and len(m) < n and len(m) < n - _need(n, num, den) + MAX_MATCH for m in mine))
                    for part, m in zip(held, mine):
                        part.append(None if m is None else len(m))
            yield pa.record_batch([b.column(0), pa.array(size, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(short, pa.bool_()),
                                   *(pa.array(x, pa.int64()) for x in held)], names=["doc_id", "n", "d1", "d2", "short", "h0", "h1", "h2", "h3"])
    return run


PROFILE = "doc_id long, n long, d1 long, d2 long, short boolean, h0 long, h1 long, h2 long, h3 long"


def _node(d1, part: int):
    """A class of equal sets in one part: the digest with the part in its last two bits."""
    return (d1 & ~np.int64(3)) | np.int64(part)


def _index(shingle: int, num: int, den: int, lower: bool, full: frozenset | None = None):
    """texts -> rows (shingle of a part, class in that part) for the exchange; no table holds them in between."""
    indexed = _parts(shingle, num, den, full)

    def run(batches):
        sender = Sender(smaller=False, wide=False)
        for b in batches:
            for c in chunks(b.column(0), "space", lower):
                for h in _rows(c, shingle):
                    d1 = np.int64(_digests(h)[0])
                    for part, held in enumerate(indexed(h)):
                        if held is not None and len(held):
                            yield from sender.add(mix(held ^ _PARTS[part]), np.zeros(len(held), np.int64), np.full(len(held), _node(d1, part), np.int64))
        yield from sender.flush()
    return run


def _postings(sets: list[np.ndarray]):
    """Inverted index of a few sets: for set i, how many members each other set shares with it."""
    sizes = np.array([len(s) for s in sets])
    tokens, of = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(of, kind="stable")
    start = np.searchsorted(of[order], np.arange(len(tokens) + 1))
    by_token, first = owner[order], np.concatenate([[0], np.cumsum(sizes)])

    def shared(i: int) -> np.ndarray:
        mine = of[first[i]:first[i + 1]]
        lens = start[mine + 1] - start[mine]
        at = np.repeat(start[mine] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
        return np.bincount(by_token[at], minlength=len(sets))
    return shared


def _verify(shingle: int, num: int, den: int, lower: bool):
    """One pair of cells: multi-match test on the prefixes, exact similarity, spanning forest of the links."""
    def run(table: pa.Table) -> pa.Table:
        ids, side = table["rep"].to_numpy(), table["side"].to_numpy()
        match, home = table["match"].to_numpy(), table["home"].to_numpy()
        sets = [h for c in chunks(table["text"], "space", lower) for h in _rows(c, shingle)]
        prefixes = [np.unique(np.array(p, np.int64)) for p in table["prefix"].to_pylist()]
        n = np.array([len(s) for s in sets])
        parent = list(range(len(sets)))

        def root(i):
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i
        a, b = [], []
        if len(sets) > 1:
            near, all_of = _postings(prefixes), _postings(sets)
            later = np.arange(len(sets))
            for i in range(len(sets)):
                other = (home | (side != side[i])) & (later > i) & (np.minimum(n, n[i]) * den >= np.maximum(n, n[i]) * num)
                if not other.any():
                    continue
                other &= near(i) >= np.minimum(match, match[i])
                if other.any():
                    both = all_of(i)
                    for j in np.flatnonzero(other & (both * den >= num * (n + n[i] - both))):
                        x, y = root(i), root(int(j))
                        if x != y:
                            parent[x] = y
                            a.append(int(ids[i]))
                            b.append(int(ids[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _prefixes(profile: DataFrame, rows: DataFrame, num: int, den: int, work: Workspace) -> DataFrame:
    """Prefix shingles of classes that can have a partner: (node, rep, n, token, holders, pivot, pos); ``rows``: of ``_index``."""
    sizes = F.array(*[F.struct(F.lit(p).alias("part"), F.col(f"h{p}").alias("held")) for p in range(4)])
    nodes = (profile.select("doc_id", "n", "d1", F.explode(sizes).alias("p")).where("p.held is not null")
             .select("doc_id", "n", F.expr("(d1 & ~3L) | p.part").alias("node"), "p.held")
             .groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("held").alias("held")))
    found = repeated(rows, smaller=False, wide=False).select(F.col("doc").alias("node"), F.col("key").alias("token")).distinct()
    found = work.table(found, "repeated")
    seen = found.groupBy("node").agg(F.count("*").alias("seen"))
    slack = f"(n - (({num} * n + {den - 1}) div {den}))"
    alive = work.table(nodes.join(seen, "node").where(f"held - seen <= {slack}").select("node", "rep", "n", "held"), "alive")
    tokens = work.table(found.join(alive, "node"), "tokens")
    holders = tokens.groupBy("token").agg(F.count("*").alias("holders"), F.min("rep").alias("pivot")).where("holders > 1")
    holders = work.table(holders, "holders")  # both sides of the join are then dealt anew, so a hot shingle's rows can be split
    shared = tokens.join(holders, "token")
    # shingles nobody else holds come first in the order; they match nothing and only use up prefix places
    order = Window.partitionBy("node").orderBy("holders", "token")
    place = (F.row_number().over(order) - 1 + F.col("held") - F.count("*").over(Window.partitionBy("node"))).alias("pos")
    placed = shared.select("node", "rep", "n", "token", "holders", "pivot", place)
    out = work.table(placed.where(f"pos < {slack} + {MAX_MATCH}"), "prefix")
    for name in ("repeated", "tokens", "holders"):
        work.drop(name)
    return out


def _candidate_links(prefix: DataFrame, num: int, den: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(links between classes that may be similar, classes with required matches and prefix)."""
    need = f"(({num} * n + {den - 1}) div {den})"
    cost = [F.sum(F.when(F.expr(f"pos < n - {need} + {k}"), F.col("holders") - 1).otherwise(0)) for k in range(1, MAX_MATCH + 1)]
    match = F.when(cost[0] <= CANDIDATES, 1)
    for k in range(2, MAX_MATCH):
        match = match.when(cost[k - 1] <= CANDIDATES * k, k)
    match = F.least(match.otherwise(MAX_MATCH), F.expr(f"max({need})")).cast("int")
    ell = prefix.groupBy("node").agg(match.alias("match"))
    used = work.table(prefix.join(ell, "node").where(f"pos < n - {need} + match"), "used")
    few = (used.where(F.col("holders") <= FEW).groupBy("token").agg(F.collect_list(F.struct("node", "rep", "n", "match")).alias("m"))
           .where("size(m) > 1").select("m", F.explode("m").alias("a"))
           .select("a", F.explode(F.expr(f"filter(m, x -> x.rep > a.rep and least(x.n, a.n) * {den} >= greatest(x.n, a.n) * {num})")).alias("b"))
           .groupBy(F.col("a.node").alias("x"), F.col("b.node").alias("y"))
           .agg(F.count("*").alias("got"), F.min(F.least("a.match", "b.match")).alias("asked"), F.min("a.rep").alias("a"), F.min("b.rep").alias("b"))
           .where("got >= asked").select("a", "b"))
    many = used.where((F.col("holders") > FEW) & (F.col("rep") != F.col("pivot"))).select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    reps = used.groupBy("rep").agg(F.max("n").alias("n"), F.min("match").alias("match"), F.collect_set("token").alias("prefix"))
    return few.union(many), reps


def _cells(clumps: DataFrame, num: int, den: int) -> DataFrame:
    """Deal each clump's classes to pairs of cells so that every pair of similar size meets in a task.

    Sizes that differ by more than the threshold allows lie two or more steps apart, so a cell meets only its own and
    the neighbouring steps; a step of many classes is cut by hash.
    """
    width = 1.01 * math.log(den / num)
    size = clumps.groupBy("clump").agg(F.count("*").alias("total"))
    x = clumps.join(size, "clump").withColumn("step", F.when(F.col("total") > CELL, F.floor(F.log("n") / width)).otherwise(F.lit(0)).cast("long"))
    steps = x.groupBy("clump", "step").agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells"))
    nxt = steps.select("clump", (F.col("step") - 1).alias("step"), F.col("cells").alias("above"))
    prv = steps.select("clump", (F.col("step") + 1).alias("step"), F.col("cells").alias("below"))
    sized = steps.join(nxt, ["clump", "step"], "left").join(prv, ["clump", "step"], "left")
    y = x.join(sized, ["clump", "step"]).withColumn("cell", F.expr("cast(pmod(xxhash64(rep), cells) as int)"))
    task = "named_struct('s', {s}, 'i', {i}, 't', {t}, 'j', {j}, 'side', {side}, 'home', {home})"
    same = ("transform(sequence(0, cells - 1), k -> " + task.format(s="step", i="least(cell, k)", t="step", j="greatest(cell, k)",
                                                                    side="if(cell <= k, 0, 1)", home="cell = k") + ")")
    up = "transform(sequence(0, above - 1), k -> " + task.format(s="step", i="cell", t="step + 1", j="k", side="0", home="false") + ")"
    down = "transform(sequence(0, below - 1), k -> " + task.format(s="step - 1", i="k", t="step", j="cell", side="1", home="false") + ")"
    tasks = F.expr(f"concat({same}, if(above is null, array(), {up}), if(below is null, array(), {down}))")
    return y.select("clump", "rep", "match", "prefix", F.explode(tasks).alias("task")).select("clump", "rep", "match", "prefix", "task.*")


def ngram_jaccard(docs: DataFrame, shingle: int = 3, num: int = 90, den: int = 100, lower: bool = True) -> DataFrame:
    """Link documents whose sets of ``shingle``-word shingles have similarity >= num/den; return their components.

    ``docs`` needs ``doc_id`` (long) and ``text``.  Words are runs without ASCII white space, A-Z lower-cased if
    ``lower``.  Returns one row per input row: doc_id, n_shingles (set size), component_id (smallest doc_id reachable
    by links, itself included).  Fewer words than a shingle: the whole sequence is the one member.  No words or null
    text: empty set, linked with nothing.  Rows with the same doc_id are one document, linked with each other.  A row
    without doc_id is linked with nothing and has no component.  Empty table: empty result.
    Shingles are compared by 64-bit hashes within a pair, whole sets by 128-bit digests.
    """
    if not 0 < num < den:
        raise ValueError(f"threshold {num}/{den} must lie between 0 and 1")
    work = Workspace(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = work.table(base.mapInArrow(_profile(shingle, num, den, lower), PROFILE), "profile")
    some = profile.where("doc_id is not null and n > 0")
    texts = base.where("doc_id is not null").select("text")
    indexed, rows = some, texts.mapInArrow(_index(shingle, num, den, lower), schema(wide=False))
    short = {_step(r["n"], num, den) for r in some.where("short").select("n").distinct().collect()}  # sizes only: as many as the longest text allows
    if short:
        steps = frozenset(s + d for s in short for d in (-1, 0, 1))
        indexed = some.union(work.table(base.where("doc_id is not null").mapInArrow(_profile(shingle, num, den, lower, steps), PROFILE), "full").where("h3 is not null"))
        rows = rows.union(texts.mapInArrow(_index(shingle, num, den, lower, steps), schema(wide=False)))
    reps = some.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"))
    links, classes = _candidate_links(_prefixes(indexed, rows, num, den, work), num, den, work)
    clumps = connected_components(links, work, "clump").select(F.col("node").alias("rep"), F.col("component").alias("clump"))
    tasks = work.table(_cells(clumps.join(classes, "rep"), num, den), "tasks")
    work.release()
    wanted = tasks.select(F.col("rep").alias("wanted")).distinct()
    texts = base.join(wanted, F.col("doc_id") == F.col("wanted")).select(F.col("doc_id").alias("rep"), "text")
    verified = (tasks.join(texts, "rep").groupBy("clump", "s", "i", "t", "j")
                .applyInArrow(_verify(shingle, num, den, lower), "a long, b long"))
    same_id = some.groupBy("doc_id").agg(F.count_distinct("d1", "d2").alias("sets")).where("sets > 1").select("doc_id")
    own = (some.join(same_id, "doc_id").join(reps, ["d1", "d2", "n"]).where("rep <> doc_id")
           .select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct())
    found = connected_components(verified.union(own), work, "links")
    labelled = (reps.select("d1", "d2", "n", "rep").join(found, F.col("rep") == F.col("node"), "left")
                .select("d1", "d2", "n", F.coalesce("component", "rep").alias("component_id")))
    out = profile.select("doc_id", "n", "d1", "d2").join(labelled, ["d1", "d2", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
