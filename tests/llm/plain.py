"""Brute-force versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import combinations

import xxhash

SPACE = " \t\n\x0b\x0c\r"

#: Texts that every operator must bear.
EDGE_TEXTS = [
    None, "", " \n\t ", "word", "one two three four", "Ümläut ÑANDÚ 日本語 \U0001f600 naïve", "a" * 5000,
    " ".join(f"w{i % 977}" for i in range(20_000)), "same line\nsame line\nsame line\n" * 9, "x\n\n\ny", "| a | b |\n" * 30,
]


def edge_docs(spark, extra=()):
    """Documents with nulls in every column, repeated rows, and extra columns whose names clash with results."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "src", 1) for i, t in enumerate([*EDGE_TEXTS, *extra])]
    rows += [(None, None, None, None, None), (None, "null key " * 12, "fr", "src", 3), rows[4], rows[4], (900, rows[7][1], None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    clash = ("n_words", "kept", "fp", "root", "ids", "spans", "shard", "score", "key", "_hash", "margin", "section", "size")
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit("clash").alias(c) for c in clash))


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def words(text):
    return [w for w in re.split(f"[{SPACE}]+", text or "") if w]


def fingerprint(text):
    found = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, nodes):
    """The least member of each node's component."""
    links = defaultdict(set)
    for a, b in pairs:
        links[a].add(b)
        links[b].add(a)
    least = {}
    for node in sorted(nodes):
        if node not in least:
            queue = [node]
            least[node] = node
            while queue:
                for other in links[queue.pop()]:
                    if other not in least:
                        least[other] = node
                        queue.append(other)
    return least


def near_duplicates(rows):
    """(id, fingerprint, least id of the class) of (id, text) rows; ids must not be null."""
    prints = [(i, fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in prints})
    linked = [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= 4]
    root = classes(linked, distinct)
    least = {}
    for i, f in prints:
        least[root[f]] = min(least.get(root[f], i), i)
    return sorted((i, f"{f:016x}", least[root[f]]) for i, f in prints)


def repeat_words(text):
    found = words(text)
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    twice = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(8)})


def dup_lines(text):
    lines = [line for line in (text or "").split("\n") if words(line)]
    return len(lines) - len(set(lines))


ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def shingles(text, size=5):
    found = words((text or "").lower())
    return {" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def links(texts, similar=(85, 100)):
    """The pairs of ids whose sets of five-word shingles are so similar."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders, shared = defaultdict(list), defaultdict(int)
    for i in sorted(sets):
        for s in sets[i]:
            for other in holders[s]:
                shared[other, i] += 1
            holders[s].append(i)
    return [p for p, n in shared.items() if similar[1] * n >= similar[0] * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
