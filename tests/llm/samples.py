"""Small document tables with the awkward cases."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int, pool: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def near_copies(seed: int = 3) -> list[tuple[int | None, str | None]]:
    """Texts, exact and edited copies, shared passages, short, empty and null texts, repeated rows."""
    rng = random.Random(seed)
    rows: list[tuple[int | None, str | None]] = []
    passage = words(60, seed + 1)
    for group in range(8):
        base = words(rng.randrange(30, 160), seed + 10 + group)
        for copy in range(rng.randrange(1, 14)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 9])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10_000)}"
            if rng.random() < 0.2:
                own += passage
            rows.append((len(rows) * 3 % 101 + 200 * (len(rows) // 101), " ".join(own)))
    rows += [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "One two Three"), (9005, "one TWO three"),
             (9006, "a b c d e f"), (9007, "a b  c d\te f"), (9008, " ".join(passage))]
    return rows


def table(spark, rows, extra: str = ""):
    return spark.createDataFrame([(d, t, "en", "s", None) for d, t in rows], SCHEMA)
