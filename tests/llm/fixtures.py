"""Small documents with the cases every operator must define: null, empty, blank, very long, equal and clashing."""

from __future__ import annotations

import random

SYLLABLES = "an the er in on re at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve".split()


def sentence(chance: random.Random, words: int) -> str:
    made = ["".join(chance.choice(SYLLABLES) for _ in range(chance.randint(1, 4))) for _ in range(words)]
    made[0] = made[0].capitalize()
    return " ".join(made) + chance.choice([".", "!", ", so it is.", "?\n"])


def text(chance: random.Random, words: int) -> str:
    parts, left = [], words
    while left > 0:
        n = min(left, chance.randint(4, 14))
        parts.append(sentence(chance, n))
        left -= n
    return " ".join(parts)


ODD = [
    None, "", "   \n\t", "one", "one two three", "don't stop, it's fine", "naïve café ÀÉÎ straße × ÷ ß", "İstanbul ǅ ﬁ ① ２",
    "x<|endoftext|>y <|startoftext|>", "a\x0bb\x0cc\x1cd\x85e\xa0f", "emoji 😀 and 漢字 テスト", "12.5 km, 3,000 $5 100%",
    "tab\tand\r\nlines\n\n\n  indented", "word " * 3000, "_under_score_ __x__ 'quoted' ''", "́ lone mark é",
]


def documents(seed: int = 5, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with copies, near copies and the odd texts."""
    chance = random.Random(seed)
    texts: list[str | None] = [text(chance, chance.choice([3, 8, 30, 90, 250])) for _ in range(n)]
    texts += ODD
    for k in range(0, 20, 2):
        words = (texts[k] or "").split(" ")
        texts.append(texts[k])
        if len(words) > 20:
            words[chance.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
            texts.append("  ".join(words).upper())
    rows = [(i, t, chance.choice(["en", "fr"]), f"src{min(chance.randint(0, 8), 3)}", len(t or "")) for i, t in enumerate(texts)]
    rows[4] = (*rows[4][:3], None, rows[4][4])
    rows.append(rows[3])
    return rows


DDL = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DDL)
