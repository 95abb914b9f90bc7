"""The contract's words, plainly."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_list(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))
