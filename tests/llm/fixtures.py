"""Small documents with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

SPACES = "\x20\x09-\x0d"
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, key int"


def documents(spark, rows):
    """A ``documents`` table with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), "x", 1) for i, t in rows], SCHEMA)


def sentences(seed: int, count: int, words: int = 60) -> list[str]:
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcdeéüñ", k=rng.randint(1, 7))) for _ in range(400)]
    return [" ".join(rng.choices(pool, k=words)) for _ in range(count)]


def edited(text: str, edits: int, seed: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for place in rng.sample(range(len(words)), edits):
        words[place] = f"edit{rng.random()}"
    return " ".join(words)


def awkward() -> list[tuple[int | None, str | None]]:
    """Ids and texts: copies, near copies, nulls, blanks, short and very long texts, repeated rows and ids."""
    base = sentences(1, 6)
    rows: list[tuple[int | None, str | None]] = list(enumerate(base))
    rows += [(10, base[0]), (11, base[0].upper()), (12, base[1].replace(" ", "\n ")), (13, ""), (14, None), (15, " \t\n ")]
    rows += [(16, "only four words here"), (17, "Only  four words here"), (18, "one"), (19, "one"), (20, "a b c d e f g"), (21, "a b c d e f g h")]
    rows += [(22, " ".join(sentences(2, 60))), (23, " ".join(sentences(2, 60)) + " end"), (24, "x" * 30_000), (25, "r " * 50), (26, "é b c　d e f")]
    rows += [(27, base[3]), (27, base[3]), (28, base[4]), (28, base[5]), (None, base[2]), (None, None)]
    big = sentences(3, 1, 150)[0]
    rows += [(100 + k, edited(big, k % 14, k)) for k in range(60)]
    return rows


def words_of(text: str | None) -> list[str]:
    return re.findall(f"[^{SPACES}]+", text or "")


def groups(links, ids) -> dict:
    """Smallest id reachable, by id."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    found: dict = {}
    for start in sorted(ids):
        if start not in found:
            reach, stack = {start}, [start]
            while stack:
                for other in near[stack.pop()] - reach:
                    reach.add(other)
                    stack.append(other)
            found |= dict.fromkeys(reach, start)
    return found


def shingles(text: str | None) -> set:
    words = words_of((text or "").translate(ASCII_LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_duplicates(rows) -> Counter:
    sets = [(i, shingles(t)) for i, t in rows]
    known = [(i, s) for i, s in sets if i is not None]
    links = [
        (i, j) for k, (i, s) in enumerate(known) for j, z in known[:k] if i != j and s and 100 * len(s & z) >= 75 * len(s | z)
    ]
    component = groups(links, {i for i, _ in known})
    return Counter((i, len(s), component.get(i), i is None or component[i] == i) for i, s in sets)


def long_documents() -> list[tuple[int, str]]:
    """Texts over several pieces of ``flat.text_pieces``, one longer than a piece, with near copies and shared passages."""
    a, b = (" ".join(sentences(seed, 4_000, 40)) for seed in (21, 22))
    words = a.split(" ")
    shared = " ".join(words[5_000:5_120])
    rows = [(1, a), (2, edited(a, 30, 3)), (3, b[:300_000]), (4, f"{b[200_000:420_000]} {shared} end"), (5, shared), (6, f"{shared} {shared}")]
    return rows + [(10 + k, t) for k, t in enumerate(sentences(23, 40, 90))]
