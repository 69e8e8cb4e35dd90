"""Dotted-path patterns: ``*`` stands for exactly one whole segment."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_JAVA_SPECIAL = re.compile(r"([\\^$.|?*+()\[\]{}])")


def java_quote(text: str) -> str:
    """``text`` as a literal inside a Java regular expression."""
    return _JAVA_SPECIAL.sub(r"\\\1", text)


def pattern_regex(pattern: str) -> str:
    """Anchored regex of a pattern; every ``*`` segment is a capture group."""
    parts = ["([^.]*)" if seg == "*" else java_quote(seg) for seg in pattern.split(".")]
    return r"\A" + r"\.".join(parts) + r"\z"


def wildcards(pattern: str) -> int:
    return sum(seg == "*" for seg in pattern.split("."))


def fill_wildcards(pattern: str) -> str:
    """Regex replacement text that puts captures 1, 2, … back where ``pattern`` has ``*``."""
    out, n = [], 0
    for seg in pattern.split("."):
        if seg == "*":
            n += 1
            out.append(f"${n}")
        else:
            out.append(seg.replace("\\", "\\\\").replace("$", "\\$"))
    return ".".join(out)


def path_matches(path: Column, patterns: Sequence[str]) -> Column:
    """True when ``path`` matches any pattern (case-sensitive, segment counts equal)."""
    exact = [p for p in patterns if not wildcards(p)]
    wild = [p for p in patterns if wildcards(p)]
    tests = []
    if exact:
        tests.append(path.isin(*exact))
    if wild:
        tests.append(path.rlike("|".join(f"(?:{pattern_regex(p)})" for p in wild)))
    if not tests:
        return F.lit(False)
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]
