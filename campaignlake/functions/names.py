"""Header cleaning for delivered delimited files (metadata only, no Spark job)."""

from __future__ import annotations

import re


def clean_name(name: str) -> str:
    """'placement (сайт/приложение/соцсеть)' -> 'placement', 'User_id' -> 'user_id'.

    What follows an opening bracket explains the name and is cut when the name
    ends with a closing one.  The words that remain (runs of letters and
    digits) are joined by '_' in lower case; without any the name is 'col'.
    """
    text = (name or "").lstrip("\ufeff \t").rstrip()
    if text.endswith(")") and "(" in text:
        text = text.partition("(")[0]
    return "_".join(w.lower() for w in re.split(r"[\W_]", text) if w) or "col"


def clean_names(names: list[str]) -> list[str]:
    """Clean a header; later duplicates get a numeric suffix."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for raw in names:
        n = clean_name(raw)
        if n in seen:
            seen[n] += 1
            n = f"{n}_{seen[n]}"
        else:
            seen[n] = 1
        out.append(n)
    return out
