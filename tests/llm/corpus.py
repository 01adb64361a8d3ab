"""Small corpora with the awkward rows that every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; an input may have them too.
CLASHING = "score double, shard int, copies bigint, h bigint, v string, label int, n int, run string, _row int"
SYLLABLES = {"en": "the and ing th er on wh sh", "de": "sch ung der keit pf ein", "fr": "eau eux que oi en"}


def text(rng: random.Random, lang: str, words: int) -> str:
    parts = SYLLABLES[lang].split()
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    lines = [" ".join(made[i : i + 12]) + "." for i in range(0, words, 12)]
    return "\n".join(lines)


def rows(n: int = 60, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        t = text(rng, lang, rng.randint(1, 120))
        out.append((i, t, lang, f"src{rng.randint(0, 3)}", len(t)))
    return out


def awkward() -> list[tuple]:
    """Nulls in every column, empty, wordless, one-word and long texts, repeated rows."""
    long = text(random.Random(9), "en", 30_000)
    return [
        (1000, None, "en", "src1", None), (1001, "", None, None, 0), (None, "the and", "en", "src1", 7),
        (1002, "!!! ... ", "en", "src1", 8), (1003, "the", "en", "", 3), (1004, "\n\n\n", "fr", "src2", 3),
        (1005, long, "en", "src1", len(long)), (1006, long, "en", "src0", len(long)),
        (1007, "same text of some words here", "en", "src1", 28),
        (1007, "same text of some words here", "en", "src1", 28),
        (1008, None, None, None, None), (1008, None, None, None, None),
    ]


def frame(spark, data: list[tuple], clashing: bool = False):
    df = spark.createDataFrame(data, DOCS)
    if clashing:
        for part in CLASHING.split(", "):
            name, kind = part.split(" ")
            df = df.selectExpr("*", f"cast(null as {kind}) as `{name}`")
    return df
