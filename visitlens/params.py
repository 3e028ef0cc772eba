"""Task parameters. A blank value means the parameter is absent."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

DEFAULT_RATIO = 0.01
MAX_RATIO = 0.1


def _text(doc: Mapping, name: str) -> str | None:
    value = doc.get(name)
    if value is None or not str(value).strip():
        return None
    return str(value)


def _list(doc: Mapping, name: str) -> tuple[str, ...]:
    value = _text(doc, name)
    if value is None:
        return ()
    return tuple(part.strip() for part in value.split(",") if part.strip())


def _int(doc: Mapping, name: str) -> int | None:
    value = _text(doc, name)
    return None if value is None else int(value)


def sampling_ratio(value: object) -> float:
    """The share to sample; anything missing, unreadable or outside (0, 0.1] gives 0.01."""
    try:
        ratio = float(str(value))
    except ValueError:
        return DEFAULT_RATIO
    return ratio if 0 < ratio <= MAX_RATIO else DEFAULT_RATIO


@dataclass(frozen=True)
class TaskParams:
    start_date: str | None = None
    end_date: str | None = None
    sex: str | None = None
    professionals: tuple[str, ...] = ()
    session_ratio: float = DEFAULT_RATIO
    sample_type: str = "bernoulli"
    start_age: int | None = None
    end_age: int | None = None
    cities: tuple[str, ...] = ()
    keywords: tuple[str, ...] = ()
    category_ids: tuple[str, ...] = ()

    @classmethod
    def from_document(cls, document: str | Mapping) -> "TaskParams":
        """Read a JSON text or a mapping; an empty document is an error."""
        doc = json.loads(document) if isinstance(document, str) else document
        if not doc:
            raise ValueError("the task has no parameters")
        return cls(
            start_date=_text(doc, "startDate"),
            end_date=_text(doc, "endDate"),
            sex=_text(doc, "sex"),
            professionals=_list(doc, "professionals"),
            session_ratio=sampling_ratio(_text(doc, "sessionRatio")),
            sample_type="poisson" if _text(doc, "sampleType") == "poisson" else "bernoulli",
            start_age=_int(doc, "startAge"),
            end_age=_int(doc, "endAge"),
            cities=_list(doc, "cities"),
            keywords=_list(doc, "keywords"),
            category_ids=_list(doc, "categoryIds"),
        )

    @property
    def needs_users(self) -> bool:
        return bool(
            self.sex or self.professionals or self.cities
            or self.start_age is not None or self.end_age is not None
        )
