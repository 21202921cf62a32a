"""Plain versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _covered(rows: list[tuple[int, list | bytes]], length: int) -> dict[int, list[bool]]:
    """For each document, which places a window covers that also starts in a document of a smaller id."""
    first: dict = {}
    for id_, seq in sorted(rows, key=lambda x: x[0]):
        for i in range(len(seq) - length + 1):
            first.setdefault(seq[i : i + length] if isinstance(seq, bytes) else tuple(seq[i : i + length]), id_)
    out = {}
    for id_, seq in rows:
        gone = [False] * len(seq)
        for i in range(len(seq) - length + 1):
            if first[seq[i : i + length] if isinstance(seq, bytes) else tuple(seq[i : i + length])] < id_:
                gone[i : i + length] = [True] * length
        out[id_] = gone
    return out


def substrings(rows: list[tuple[int, str | None]], length: int = 13) -> set[tuple]:
    seqs = [(i, WORD.findall(t or "")) for i, t in rows]
    gone = _covered(seqs, length)
    return {(i, len(w), sum(gone[i]), sha(" ".join(x for x, g in zip(w, gone[i]) if not g).encode())) for i, w in seqs}


def suffixes(rows: list[tuple[int, str | None]], length: int = 50) -> set[tuple]:
    seqs = [(i, (t or "").encode()) for i, t in rows]
    gone = _covered(seqs, length)
    return {
        (i, len(b), sum(gone[i]), sum(g and not (k and gone[i][k - 1]) for k, g in enumerate(gone[i])),
         sha(bytes(x for x, g in zip(b, gone[i]) if not g)))
        for i, b in seqs
    }


def shingle_set(text: str | None) -> set[tuple]:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def near_duplicates(rows: list[tuple[int, str | None]], percent: int = 85) -> set[tuple]:
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    holders: dict = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in sets.items():
        for j in {j for x in s for j in holders[x] if j < i}:
            shared = len(s & sets[j])
            if 100 * shared >= percent * (len(s) + len(sets[j]) - shared):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {(i, len(s), top(i), top(i) == i) for i, s in sets.items()}
