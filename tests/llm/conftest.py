from __future__ import annotations

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
#: The documents' columns and others whose names the operators use inside.
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, id long, h long, mark string, core string, "
        "slot int, slots string, v long, u1 string, part string, __at string, spans string, cluster string, unit string")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def frame(spark, rows):
    """Documents from (doc_id, text[, lang[, source]]) with clashing extra columns."""
    full = []
    for r in rows:
        d, t, lang, source = (*r, None, None)[:4] if len(r) < 4 else r
        full.append((d, t, lang, source, None if t is None else len(t), 7, 8, "m", "c", 1, "s", 2, "u", "p", "a", "x", "k", "w"))
    return spark.createDataFrame(full, DOCS)


@pytest.fixture()
def messy():
    """Nulls, empty, blank, short, repeated, very long and non-ASCII texts; a repeated row
    and a repeated id; ids out of order and a null id."""
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))
    line = "the quick brown fox jumps over the lazy dog again and again until night falls over the quiet town"
    return [(5, None, None, None), (3, "", "en", "a"), (9, " \t\n ", "en", "a"), (1, "one", "en", None), (2, "one two", "en", "b"),
            (4, line, "en", "b"), (8, line, "en", "b"), (6, line.upper(), "en", "b"), (10, line + " end", "en", "b"),
            (11, long, "en", "c"), (12, long + " tail", "en", "c"), (7, "日本語 テキスト 🙂🙂 Éa", "ja", "d"),
            (None, "no id here at all", "en", "a"), (4, line, "en", "b"), (13, "!!! ??? 123", None, "a"),
            (2, "other text under a used id", "en", "b"), (14, "a" * 3000, "en", "a"), (15, line + "\n" + line, "en", "a")]
