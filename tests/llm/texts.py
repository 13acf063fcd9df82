"""Small tables that hold what real ones hold at their edges, and plain versions of shared steps."""

from __future__ import annotations

import random
import re

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, part string, key string, node int, _gone int, _quality_text string, `odd name` int"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def edge_rows(seed: int = 7) -> list[tuple]:
    """Null, empty, wordless, very long and repeated texts, equal and missing ids, other columns with clashing names."""
    rng = random.Random(seed)
    base = sentence(rng, 80)
    words = base.split()
    texts = [
        (1, base), (2, base), (2, base), (3, " ".join(words[:40] + ["changed"] + words[41:])), (4, None), (5, ""), (6, " \t\n\r "),
        (7, "One"), (8, "ÄÖ ü x ×÷ 日本語 \U0001F600 é"), (9, sentence(rng, 20_000)), (None, base), (None, None),
        (10, "tick " * 300), (11, sentence(rng, 50) + "\n" + sentence(rng, 12) + "\n\n" + sentence(rng, 12)),
        (12, "Released under the MIT License.\n" + sentence(rng, 30)), (13, "x" * 100_000), (14, base + "\n" + sentence(rng, 60)),
    ]
    return [(i, t, ("en", "fr", None)[k % 3], f"s{k % 2}", len(t or ""), "a", "b", "c", 1, 2, "d", 3) for k, (i, t) in enumerate(texts)]


def edge_documents(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWERED))


def shingle_set(text: str | None, size: int = 5) -> frozenset:
    words = spaced((text or "").translate(LOWERED))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


class Groups:
    """Union-find for the plain versions."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
