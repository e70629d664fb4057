"""Settings of a run: typed, and checked when they are made."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, replace
from pathlib import Path

from .functions.names import quantile_name

WORLDS = ("observed", "counterfactual")
#: Vegetation classes that count as burnable wildland.
BURNABLE = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 14, 18, 19)


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass(frozen=True)
class Years:
    first: int
    last: int

    def __post_init__(self):
        _need(self.first <= self.last, f"first year {self.first} is after last year {self.last}")

    @property
    def all(self) -> range:
        return range(self.first, self.last + 1)


@dataclass(frozen=True)
class Bins:
    """Fine bins up to fine_max, coarse ones up to coarse_max, and one for all beyond."""

    fine_max: float = 80.0
    fine_step: float = 0.2
    coarse_max: float = 300.0
    coarse_step: float = 1.0

    def __post_init__(self):
        for step in (self.fine_step, self.coarse_step):
            _need(step > 0, f"a bin of width {step} holds nothing")
        _need(0 < self.fine_max < self.coarse_max, f"coarse bins from {self.fine_max} to {self.coarse_max}: the ends are out of order")

    @property
    def fine(self) -> int:
        return round(self.fine_max / self.fine_step)

    @property
    def coarse(self) -> int:
        return round((self.coarse_max - self.fine_max) / self.coarse_step)

    @property
    def count(self) -> int:
        return self.fine + self.coarse + 1


@dataclass(frozen=True)
class Settings:
    root: str = "data"
    archive: Years = Years(1979, 2024)
    reference: Years = Years(1991, 2020)
    quantiles: tuple[float, ...] = (0.90, 0.95, 0.99)
    bins: Bins = field(default_factory=Bins)
    burnable: tuple[int, ...] = BURNABLE
    vote: float = 0.5
    validation_cells: int = 3000
    seed: int = 42

    def __post_init__(self):
        _need(len(self.quantiles) > 0 and all(0 < q < 1 for q in self.quantiles), "quantiles must lie between 0 and 1")
        names = [quantile_name(q) for q in self.quantiles]
        _need(len(set(names)) == len(names), f"quantiles share a name: {names}")
        _need(0 <= self.vote <= 1, "vote must lie in [0, 1]")
        _need(self.validation_cells > 0, "validation_cells must be positive")

    @property
    def names(self) -> list[str]:
        return [quantile_name(q) for q in self.quantiles]

    def of_years(self, years: tuple[int, ...]) -> Settings:
        """The same with another reference period, of years in a row."""
        _need(years == tuple(range(years[0], years[-1] + 1)), f"years of a reference period with gaps: {years}")
        return replace(self, reference=Years(years[0], years[-1]))


def _each(kind: type):
    """A list of values of one kind."""
    return lambda values: tuple(kind(v) for v in values)


#: What a settings file holds: where, as what, and of which kind.
_KEYS = (
    ("paths.root", "root", str), ("archive.first_year", "archive_first", int), ("archive.last_year", "archive_last", int),
    ("reference.first_year", "reference_first", int), ("reference.last_year", "reference_last", int), ("reference.quantiles", "quantiles", _each(float)),
    ("histogram.fine_max", "fine_max", float), ("histogram.fine_step", "fine_step", float), ("histogram.coarse_max", "coarse_max", float), ("histogram.coarse_step", "coarse_step", float),
    ("histogram.validation_cells", "validation_cells", int), ("histogram.seed", "seed", int), ("mask.burnable_classes", "burnable", _each(int)), ("mask.vote_threshold", "vote", float),
)


def load(path: str | Path) -> Settings:
    """Settings from a TOML file with the tables and keys of _KEYS; all that is absent or of another kind is named at once."""
    with open(path, "rb") as f:
        tables = tomllib.load(f)
    found, wrong = {}, []
    for place, name, kind in _KEYS:
        table, key = place.split(".")
        try:
            found[name] = kind(tables[table][key])
        except (KeyError, TypeError, ValueError):
            wrong.append(place)
    _need(not wrong, f"{path}: no usable {', '.join(wrong)}")
    years = {k: Years(found.pop(f"{k}_first"), found.pop(f"{k}_last")) for k in ("archive", "reference")}
    bins = Bins(**{k: found.pop(k) for k in ("fine_max", "fine_step", "coarse_max", "coarse_step")})
    return Settings(bins=bins, **years, **found)
