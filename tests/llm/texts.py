"""Texts that several test modules share."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """n words, the same for the same seed."""
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


def pairs(docs):
    return sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
