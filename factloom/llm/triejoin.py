"""Jaccard join of the sets of one group over a prefix tree.

Tokens are put into one order (those of most sets first), every set is written in that order, and the sorted
sequences form a compressed tree. The tree is walked once for all sets together: a node holds, for each set
that can still match something below it, the overlap so far, and its children start from that. A set leaves a
subtree when, by the tokens that remain on either side, no sequence below can reach the threshold.
"""

from __future__ import annotations

import numpy as np


def join_group(sets: list[np.ndarray], num: int, den: int, cross: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links i-j with den * |intersection| >= num * |union|.

    With cross (a flag a set), only links between a flagged and an unflagged set are looked for. Sets are not
    empty. Links within a tree of the forest are not listed again, so the list has fewer entries than sets.
    """
    m = len(sets)
    if m < 2:
        return []
    size = np.fromiter(map(len, sets), np.int64, m)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    by_count = np.argsort(-counts, kind="stable")
    rank_of = np.empty(len(counts), np.int64)
    rank_of[by_count] = np.arange(len(counts))
    rank = rank_of[inverse]
    order = np.lexsort((rank, owner))
    rank, start = rank[order], np.r_[0, np.cumsum(size)]
    seqs = [rank[start[i] : start[i + 1]] for i in range(m)]
    by_seq = sorted(range(m), key=lambda i: seqs[i].astype(">u4").tobytes())
    seqs, size = [seqs[i] for i in by_seq], size[by_seq]
    flag = None if cross is None else np.asarray(cross)[by_seq]
    common = np.zeros(m + 1, np.int64)  # of each sequence with that before it
    for i in range(1, m):
        a, b = seqs[i - 1], seqs[i]
        n = min(len(a), len(b))
        differ = a[:n] != b[:n]
        k = int(differ.argmax()) if n else 0
        common[i] = k if n and differ[k] else n
    common[m] = 0
    # Sets by token, for tokens of two sets or more; and all (set, token) pairs in order, to count tokens up to one.
    token_sets = np.concatenate([np.full(len(s), i) for i, s in enumerate(seqs)])
    tokens = np.concatenate(seqs)
    shared = int((counts > 1).sum())
    keep = np.argsort(tokens, kind="stable")
    post, ptr = token_sets[keep], np.searchsorted(tokens[keep], np.arange(len(counts) + 1))
    width = len(counts) + 1
    pairs = token_sets * width + tokens
    begin = np.r_[0, np.cumsum(size)]
    parts = num + den
    label = np.arange(m)
    forest: list[tuple[int, int]] = []

    def overlap(edge: np.ndarray, of: np.ndarray) -> np.ndarray:
        edge = edge[edge < shared]
        if not len(edge):
            return np.zeros(len(of), np.int64)
        got = np.concatenate([post[ptr[t] : ptr[t + 1]] for t in edge.tolist()])
        return np.bincount(got, minlength=m)[of]

    # A node is the sequences lo..hi-1, which share their first `depth` tokens; `of` are the sets still in play.
    stack = [(0, m, 0, np.arange(m), np.zeros(m, np.int64))]
    while stack:
        lo, hi, depth, of, seen = stack.pop()
        below = common[lo + 1 : hi]
        until = len(seqs[lo]) if hi == lo + 1 else min(int(below.min()), len(seqs[lo]))
        if until > depth:
            seen = seen + overlap(seqs[lo][depth:until], of)
        inside = label[lo:hi]
        if hi == lo + 1 or (inside == inside[0]).all():
            alive = label[of] != inside[0]
        else:
            alive = np.ones(len(of), bool)
        alive &= of > lo  # each pair once: the later sequence looks for the earlier one
        least, most = size[lo:hi].min(), size[lo:hi].max()
        alive &= parts * (seen + (most - until)) >= num * (size[of] + most)
        last = int(seqs[lo][until - 1]) if until else -1
        passed = np.searchsorted(pairs, of * width + last, side="right") - begin[of]
        alive &= parts * (seen + size[of] - passed) >= num * (size[of] + least)
        of, seen = of[alive], seen[alive]
        if not len(of):
            continue
        if until == len(seqs[lo]):
            hit = of[parts * seen >= num * (size[of] + until)]
            if flag is not None:
                hit = hit[flag[hit] != flag[lo]]
            for j in hit.tolist():
                if label[j] != label[lo]:
                    forest.append((by_seq[lo], by_seq[j]))
                    label[label == label[j]] = label[lo]
        if hi == lo + 1:
            continue
        cuts = [lo, *(lo + 1 + np.flatnonzero(below == until)).tolist(), hi]
        # The sequence that ends in this node, if any, is the first; it has no child.
        children = [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if not (b == a + 1 and len(seqs[a]) == until)]
        stack += [(a, b, until, of, seen) for a, b in reversed(children)]
    return forest
