"""Column-name rules."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

_SEPARATORS = re.compile(r"[\s\-_]+")
# A new word starts at a capital that follows a small letter or digit, and at
# the last capital of a run when a small letter follows it (PULocation).
_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def to_snake_case(name: str) -> str:
    """``PULocationID`` -> ``pu_location_id``, ``Date of Last Change`` -> ``date_of_last_change``."""
    chunks = _SEPARATORS.split(name.strip())
    return "_".join(word for chunk in chunks for word in _WORD_START.split(chunk)).lower()


def snake_case_all(names: Iterable[str]) -> list[str]:
    """Snake-case every name; two names that become equal are an error."""
    out = [to_snake_case(n) for n in names]
    clashes = sorted(n for n, times in Counter(out).items() if times > 1)
    if clashes:
        raise ValueError(f"column names collide after renaming: {clashes}")
    return out
