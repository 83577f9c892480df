"""Table and column names that a catalog takes.

Letters and digits stay, in lower case; whatever else stands in a name becomes an underscore.
"""

from __future__ import annotations

import re
from pathlib import PurePosixPath

#: Longest name that catalogs store (a fixed value of the Hive metastore).
LONGEST = 128
_OTHER = re.compile(r"[\W_]")


class NameCollision(ValueError):
    """Two names became the same after cleaning."""


class UnusableName(ValueError):
    """A name that a catalog refuses: empty, or too long."""


def clean_name(name: str) -> str:
    """The cleaned name; an error when nothing is left or too much."""
    text = _OTHER.sub("_", name)
    cleaned = text.lower() if text.isascii() else "".join(map(str.lower, text))
    if not cleaned:
        raise UnusableName("a name is empty")
    if len(cleaned) > LONGEST:
        raise UnusableName(f"a name has {len(cleaned)} characters, {LONGEST} are the most: {cleaned}")
    return cleaned


def table_name(file_name: str) -> str:
    """The table of a file: its cleaned name without the last ending."""
    return clean_name(PurePosixPath(file_name).stem)


def clean_names(names: list[str]) -> list[str]:
    """Clean names in order; an error that lists the originals when some become the same."""
    origins: dict[str, list[str]] = {}
    for name in names:
        origins.setdefault(clean_name(name), []).append(name)
    same = {cleaned: given for cleaned, given in origins.items() if len(given) > 1}
    if same:
        raise NameCollision("; ".join(f"{given} all become {cleaned}" for cleaned, given in sorted(same.items())))
    return list(map(clean_name, names))
