"""Patterns of secrets."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    """`group` is the part whose length, from `least` characters on, makes a match count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The three base rules. Only the letters of the names in `assign` stand for either case.
BASE = (
    Rule(
        "assign",
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", r"[0-9a-f]+", least=24, base=True),
)

# Public formats of well-known tokens.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    # A scheme is short: a longer run of its letters is not tried again from each of them.
    Rule("url_login", r"[a-z][a-z0-9+.-]{0,31}://[^\s:/@]{1,64}:[^\s:/@]{3,128}@"),
)
