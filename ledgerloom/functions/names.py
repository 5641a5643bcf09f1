"""Column-name rules. They work on the handful of names of a schema, never on data."""

from __future__ import annotations

import re
import unicodedata

# Names that mark an id column, first match wins.
ID_NAMES = ["id", "id_", "_id", "pk", "primary_key", "key"]


def fold_accents(text: str) -> str:
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(ch for ch in decomposed if not unicodedata.combining(ch))


def clean_name(raw: str) -> str:
    """Lower-case ASCII-folded words joined by single underscores.

    >>> clean_name(" Remuneração e benefícios(%)")
    'remuneracao_e_beneficios'
    """
    words = re.sub(r"\W", "_", fold_accents(raw).strip().lower())
    return re.sub(r"_+", "_", words).strip("_") or "column"


def clean_names(raw: list[str], strict: bool = False) -> list[str]:
    """Cleaned names, each once: a repeated one gets ``_2``, ``_3``, or raises when ``strict``.

    A column already named ``id`` keeps that name whatever the others clean to.
    """
    taken = {"id"} if "id" in raw else set()
    out = []
    for name in raw:
        base = clean_name(name)
        if strict and base in taken and name != "id":
            raise ValueError(f"two columns are both named {base!r} after cleaning: {raw}")
        unique, n = base, 1
        while unique in taken and name != "id":
            n += 1
            unique = f"{base}_{n}"
        taken.add(unique)
        out.append(unique)
    return out


def unused(name: str, taken: list[str]) -> str:
    """``name``, or with underscores added until none of ``taken`` is called so."""
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name += "_"
    return name


def id_position(columns: list[str]) -> int | None:
    """Position of the id column, by the order of ``ID_NAMES`` and not of the columns."""
    lowered = [c.strip().lower() for c in columns]
    return next((lowered.index(name) for name in ID_NAMES if name in lowered), None)
