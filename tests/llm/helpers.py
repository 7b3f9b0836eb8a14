"""Small tables with every awkward case, for all operators."""

from __future__ import annotations

import random

WORDS = "the of and to in is that for on with as was at by an be this from are it or not have but they which one you".split()


def documents(spark, rows, extra=True):
    """rows: (doc_id, text) pairs. Extra columns have names that operators use themselves."""
    full = [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t), "x", 7) for i, t in rows]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    if extra:
        return spark.createDataFrame(full, kind + ", key string, cell long").repartition(3)
    return spark.createDataFrame([r[:5] for r in full], kind)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "a", "er", "ly"]) for _ in range(n))


def awkward() -> list[tuple[int, str | None]]:
    base = prose(1, 60)
    return [
        (1, base),
        (2, base),
        (3, base.replace("the", "THE", 1)),
        (4, base + " more"),
        (5, None),
        (6, ""),
        (7, "  \t\n "),
        (8, "a"),
        (9, "aaaa" * 500),
        (10, prose(2, 4000)),
        (11, prose(3, 30) + "\n" + base[:120] + "\n" + prose(4, 30)),
        (12, prose(5, 30) + "\n" + base[:120] + "\n" + prose(6, 30)),
        (13, "Ünïcode 日本語 😀 " + base[:80]),
        (14, "日本語テキスト" * 30),
        (15, prose(7, 25) + "\n" + prose(7, 25) + "\n" + prose(7, 25)),
        (2, base),
    ]


def components(nodes, links):
    """The smallest node that each reaches."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}
