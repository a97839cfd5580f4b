"""Small tables and brute-force helpers."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(ascii_lower(text or ""))


def docs(spark, rows, extra: bool = False):
    """Documents from (doc_id, text) pairs; `extra` adds columns with names that operators use themselves."""
    df = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], DOCS)
    if not extra:
        return df
    names = ["_id", "_th", "_text", "_row", "_words", "_lines", "_kept", "pos", "node", "comp", "score", "n_words", "n_lines", "ids", "h1"]
    return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names])


def prose(rng, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))
