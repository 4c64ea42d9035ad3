"""Plain Python models to compare small results with."""

from __future__ import annotations

import math
import re
from collections import Counter

from rankloom.functions.text import STOP_WORDS

WORD = re.compile(r"[#@\w](?:['\-]?\w){2,24}")


def kept(text: str | None) -> list[str]:
    return [w for w in WORD.findall((text or "").lower()) if w not in STOP_WORDS]


def bm25(docs: dict[int, str], query: str, k: int, min_df: int = 0, b: float = 0.7, k1: float = 1.5):
    """Ranked ``(doc_id, score)``; ties in the order of first meeting."""
    counts = {doc: Counter(kept(text)) for doc, text in docs.items()}
    lengths = {doc: sum(c.values()) for doc, c in counts.items() if c}
    df = Counter(term for c in counts.values() for term in c)
    index = {term for term, n in df.items() if n > min_df}
    n, mean = len(lengths), sum(lengths.values()) / len(lengths)
    scores: dict[int, float] = {}
    for term in kept(query):
        if term not in index:
            continue
        idf = math.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5))
        for doc in sorted(counts):
            tf = counts[doc][term]
            if tf:
                part = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[doc] / mean))
                scores[doc] = scores.get(doc, 0.0) + part
    met = {doc: place for place, doc in enumerate(scores)}
    return sorted(scores.items(), key=lambda item: (-round(item[1], 9), met[item[0]]))[:k]


def pagerank(edges: list[tuple], rounds: int = 6, reset: float = 0.15, rescale: bool = True) -> dict:
    links = set(edges)
    nodes = {v for edge in links for v in edge}
    degree = Counter(src for src, _ in links)
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(rounds):
        total = Counter()
        for src, dst in links:
            total[dst] += rank[src] / degree[src]
        rank = {v: reset + (1 - reset) * total[v] for v in nodes}
    scale = len(nodes) / sum(rank.values()) if rescale else 1.0
    return {v: r * scale for v, r in rank.items()}
