"""Small inputs with every odd case: nulls, empty, blank, long, repeated, clashing column names."""

from __future__ import annotations

import random

CLASHING = ("id", "row", "n", "key", "sid", "words", "order", "part", "hash")


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdeé ßñ日".replace(" ", "")) for _ in range(rng.randint(1, 7))) for _ in range(n)]


def documents(seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) rows: near and exact copies, shared passages, odd cases."""
    rng = random.Random(seed)
    passage = " ".join(words(rng, 60))
    texts: list[str | None] = [None, "", " \t\n", "one", "one two three", "One Two\x0bthree", "be " * 300, "x" * 700, passage]
    for _ in range(12):
        texts.append(" ".join(words(rng, rng.randint(5, 90))))
    for _ in range(8):
        base = rng.choice([t for t in texts if t and len(t) > 60])
        parts = base.split(" ")
        parts[rng.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    texts += [texts[10], texts[10], " ".join(words(rng, 30)) + "\n" + passage + "\n" + " ".join(words(rng, 20)),
              " ".join(words(rng, 4000)), passage + " tail", "a\x00b " * 60, "<|endoftext|> it's  I'LL  12ab x"]
    rows = [(i * 3, t, "en", None if i % 7 == 0 else f"src{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows=None, clash=True):
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)
    if clash:
        for name in CLASHING:
            df = df.selectExpr("*", f"cast(null as string) as {name}")
    return df
