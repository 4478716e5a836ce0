"""Argument checks. Every problem is reported in one ValueError."""

from __future__ import annotations

from dataclasses import dataclass, field

from parcelpulse.schema import INDICES, MAX_CLOUD_COVER, MIN_CLEAR_RATIO


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


@dataclass(frozen=True)
class Params:
    """Settings of one run."""

    indices: list = field(default_factory=list)
    collection: str | None = None
    batch_size_deg: float = 0.5
    save_cube: bool = False
    debug_cloud: bool = False
    max_cloud: float = MAX_CLOUD_COVER
    min_clear: float = MIN_CLEAR_RATIO
    per_item_scale: bool = False
    utc_day_match: bool = False

    def __post_init__(self):
        problems = [text.format(name=name, value=value) for name, value, text in self._faults()]
        if problems:
            raise ValueError(problems_text(problems))

    def _faults(self):
        """(argument, value, complaint) of every rule that is broken."""
        for name, holds, text in RULES:
            value = getattr(self, name)
            if not holds(value):
                yield name, value, text
        if isinstance(self.indices, (list, tuple)):
            for index in sorted({str(i) for i in self.indices} - set(INDICES)):
                yield "indices", index, "{value} is none of the {name}, which are " + ", ".join(INDICES)


def problems_text(problems: list[str]) -> str:
    return f"{len(problems)} problem(s) with the arguments: " + "; ".join(problems)


def _between(low: float, high: float):
    return lambda v: _is_number(v) and low <= v <= high


_SWITCH = "{name} is a switch and takes True or False, not {value!r}"
# What each argument must hold, and the complaint if it does not.
RULES = (
    ("collection", lambda v: isinstance(v, str), "{name} takes the collection's name, not {value!r}"),
    ("indices", lambda v: isinstance(v, (list, tuple)), "{name} takes a list of names, not {value!r}"),
    ("indices", lambda v: not isinstance(v, (list, tuple)) or len(v) > 0, "{name} names no index, is empty"),
    ("batch_size_deg", lambda v: _is_number(v) and 0 < v < 360, "{name} takes degrees above 0, not {value!r}"),
    ("max_cloud", _between(0, 100), "{name} takes a percentage, not {value!r}"),
    ("min_clear", _between(0, 1), "{name} takes a share from 0 to 1, not {value!r}"),
    *((name, lambda v: isinstance(v, bool), _SWITCH) for name in ("save_cube", "debug_cloud")),
    *((name, lambda v: isinstance(v, bool), _SWITCH) for name in ("per_item_scale", "utc_day_match")),
)
