"""Settings shared by several operators."""

from __future__ import annotations

from dataclasses import dataclass, field

# Default bin edges, group codes and attribute names.
INCOME_BREAKS = (-100_000, 50_000, 100_000, 100_000_000)
AGE_BREAKS = (0, 10, 20, 30, 40, 50, 60, 70, 80, 150)
GQ_AGE_BREAKS = (0, 18, 65, 150)
NOT_WORKING_CODE = "0009"
NOT_WORKING_GROUP = 99
MILITARY_GROUP = 55
HH_ATTRS = ("HH_Size", "HH_Type", "HH_Income")
P_ATTRS = ("Age", "Sex", "Race", "Hispanic", "Grade", "School_Type", "Occ_Group")
GQ_ATTRS = ("GQ_Sex", "GQ_Age", "GQ_Type")

# Names a user may ask for -> the one attribute name used in every table.
ATTR_ALIASES = {"Ethnicity": "Hispanic", "Occupation": "Occ_Group"}


def canonical(chars) -> list[str]:
    """Requested characteristics under their attribute names, without repeats, in the order asked."""
    known = {*HH_ATTRS, *P_ATTRS, *GQ_ATTRS}
    names = list(dict.fromkeys(ATTR_ALIASES.get(c, c) for c in chars))
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"unknown characteristics: {unknown}")
    return names


@dataclass(frozen=True)
class Breaks:
    """Bin edges; one object is passed to targets, seeds and group-quarters steps so they agree."""

    income: tuple = INCOME_BREAKS
    age: tuple = AGE_BREAKS
    gq_age: tuple = GQ_AGE_BREAKS


@dataclass(frozen=True)
class FitConfig:
    """Weighting: stop rule, guards and the sizes that choose the kernel.

    ``kernel_cells`` bounds the non-zero incidence cells one task may hold; larger pools are cut into parts of ``block_cells``
    instead, with the same results, and a task holds parts of ``group_cells``. ``task_cells`` bounds areas x support patterns
    handled at a time.
    """

    max_iter: int = 60
    tol: float = 1e-4
    floor: float = 1e-5
    keep: str = "best"  # or "last"
    max_levels: int = 5_000
    kernel_cells: int = 8_000_000
    block_cells: int = 2_000_000
    group_cells: int = 8_000_000
    task_cells: int = 2_000_000
    steps_per_stage: int = 6


@dataclass(frozen=True)
class DrawConfig:
    """Drawing: hash seed, integer weight scale and the number of rows one task sorts or numbers."""

    seed: int = 42
    scale: int = 1_000_000
    rows_per_task: int = 250_000


@dataclass(frozen=True)
class SynthConfig:
    breaks: Breaks = field(default_factory=Breaks)
    fit: FitConfig = field(default_factory=FitConfig)
    draw: DrawConfig = field(default_factory=DrawConfig)
