"""Small hostile tables and brute-force answers, written without the operators' methods."""

from __future__ import annotations

import hashlib
import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
# names that operators use inside; as extra input columns they must neither clash nor matter
CLASH = ["key", "doc", "row", "mark", "n", "rep", "token", "shard", "h", "hits", "turns", "v", "list", "scores", "carry"]

_r = random.Random(5)
VOCAB = ["".join(_r.choice("abcdefghijklmnoprstuvwéñß") for _ in range(_r.randint(2, 9))) for _ in range(900)]


def prose(rng: random.Random, n: int, per_line: int = 12) -> str:
    out = []
    for i in range(n):
        w = rng.choice(VOCAB)
        out.append((w.capitalize() if i % 9 == 0 else w) + ("\n" if i % per_line == per_line - 1 else " "))
    return "".join(out).strip()


def edge_docs() -> list[tuple]:
    rng = random.Random(11)
    base, passage = prose(rng, 150), prose(rng, 60, 1000)
    rows = [(i, prose(rng, rng.randint(1, 220))) for i in range(1, 41)]
    rows += [(50 + i, base) for i in range(6)]                                     # exact copies
    for i in range(12):                                                            # near copies of one another
        w = base.split(" ")
        w[7 + 5 * i] = "changed" + str(i)
        rows.append((70 + i, " ".join(w)))
    rows += [(90 + i, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 30)) for i in range(8)]   # a shared passage
    rows += [(110, None), (111, ""), (112, " \t\n \x0b\f\r"), (113, "\n\n"), (114, "one"), (115, "one"), (116, "two words"),
             (117, "ÀÉ Ünï cödé \U0001f600 word"), (118, "x" * 5000), (119, "aa bb " * 4000), (120, "aa bb " * 4001)]
    rows += [(30, rows[29][1]), (30, rows[29][1])]                                  # repeated rows
    rows += [(31, "another text under a doc id that is taken " * 5)]                # one id, two texts
    rows += [(None, base), (None, None), (None, passage)]
    rows += [(200, prose(rng, 20_000))]                                             # a very long one
    rows += [(-5, base.upper()), (130, "  Same Line of Twenty Characters And More \nx"), (131, "same line of twenty characters and more"),
             (132, "y\nSAME LINE OF TWENTY CHARACTERS AND MORE\t\nsame line of twenty characters and more")]
    return rows


def doc_frame(spark, rows=None, clash: bool = True):
    from pyspark.sql import functions as F
    rows = edge_docs() if rows is None else rows
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA).repartition(3, "n_chars")
    for c in CLASH if clash else []:
        df = df.withColumn(c, F.lit(c))
    return df


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def space_words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum_words(text) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def multiset(rows) -> list:
    return sorted((tuple(r) for r in rows), key=repr)


def components(nodes, links) -> dict:
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def jaccard_answer(rows, n: int, num: int, den: int) -> list[tuple]:
    sets = []
    for i, t in rows:
        w = space_words(ascii_lower(t or ""))
        sets.append((i, frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    known = [(i, s) for i, s in sets if i is not None]
    links = [(i, j) for k, (i, s) in enumerate(known) for j, t in known[:k]
             if i == j or (s and t and den * len(s & t) >= num * len(s | t))]
    comp = components({i for i, _ in known}, links)
    return multiset((i, len(s), comp.get(i)) for i, s in sets)


def substring_answer(rows, n: int) -> list[tuple]:
    first: dict = {}
    for i, t in rows:
        w = space_words(t)
        for k in range(len(w) - n + 1 if i is not None else 0):
            key = tuple(w[k:k + n])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = space_words(t)
        gone = set()
        for k in range(len(w) - n + 1 if i is not None else 0):
            if first[tuple(w[k:k + n])] < i:
                gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return multiset(out)


def lines_answer(rows, min_chars=20, min_docs=3) -> list[tuple]:
    def key(line):
        return ascii_lower(line.strip(" \t\n\x0b\f\r"))
    held: dict = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (i is not None and len(held.get(key(x), ())) >= min_docs and i < max(held[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return multiset(out)


def contamination_answer(rows, items, n=10) -> list[tuple]:
    windows: dict = {}
    for item, t in items:
        w = alnum_words(t)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if w and item is not None else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w = alnum_words(t)
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (x := windows.get(tuple(w[k:k + size]))):
                    hit.update(range(k, k + size))
                    found |= x
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return multiset(out)
