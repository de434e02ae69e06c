"""Small documents with every awkward case, and plain versions of what the operators do."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
_SYLLABLES = "the of and er in re on ti es or at en th ou ha ing ed tion ble ea".split()


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]
    text = " ".join(words)
    return text[:1].upper() + text[1:] + "."


def edited(rng: random.Random, text: str, every: int) -> str:
    words = text.split(" ")
    for i in range(0, len(words), every):
        words[i] = rng.choice(_SYLLABLES) + "x"
    return " ".join(words)


def rows(n: int = 60, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    texts: list[str | None] = [prose(rng, rng.randint(5, 160)) for _ in range(n)]
    shared = prose(rng, 60)
    for i in range(0, n, 7):
        texts[i] = f"{prose(rng, 20)} {shared}\n{prose(rng, 15)}"
    texts[4] = texts[3]
    for k in range(5):
        texts.append(edited(rng, texts[1] or "", 40 + k))
    texts += ["", "   \t\n ", None, "one", "a b c", "A b C", "é😀 ß naïve Ωμέγα don't 're!'s  x", "x" * 5000, "ab" * 300, prose(rng, 4000), "same line\n" * 30, "# $ % & | < > *" * 10]
    sources = ["b", "a", None, "c", "a"]
    out = [(i, t, ("en", "de", None)[i % 3], sources[i % 5], None if t is None or i % 11 == 0 else len(t)) for i, t in enumerate(texts)]
    return out


def clashing(df):
    """``df`` with extra columns under names that operators use inside."""
    for c in ("id", "text_", "score", "key", "spans", "size", "kind", "doc", "n_words", "__n"):
        df = df.selectExpr("*", f"cast(1 as int) as `{c}`")
    return df


def ascii_lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
