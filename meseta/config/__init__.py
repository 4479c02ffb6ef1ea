"""Small JSON settings that ship with the package.

Their entries are fixed values: names and spellings that sources use.
"""

from __future__ import annotations

import json
from importlib.resources import files


def unique_entries(pairs: list[tuple[str, object]]) -> dict:
    """A JSON object whose keys are neither blank nor repeated, also not in another case or with blanks around."""
    seen: set[str] = set()
    for key, value in pairs:
        plain = key.strip().casefold()
        if not plain or (isinstance(value, str) and not value.strip()):
            raise ValueError(f"Blank entry: {key!r}: {value!r}")
        if plain in seen:
            raise ValueError(f"Repeated entry: {key!r}")
        seen.add(plain)
    return dict(pairs)


def load(name: str) -> dict:
    text = files(__name__).joinpath(f"{name}.json").read_text(encoding="utf-8")
    content = json.loads(text, object_pairs_hook=unique_entries)
    if not isinstance(content, dict):
        raise ValueError(f"{name}.json must hold a JSON object.")
    return content
