"""Settings records passed to operators. Every "now" is an explicit ``as_of``."""

from __future__ import annotations

from dataclasses import dataclass, field
from math import gcd


@dataclass(frozen=True)
class WindowSpec:
    """A time window: ``slide_s == size_s`` is a tumbling window.

    ``kinds`` names the breakdowns to compute besides the totals.
    """

    size_s: int = 300
    slide_s: int = 60
    max_articles: int = 1000
    top_keywords: int = 10
    length_unit: str = "chars"
    kinds: tuple[str, ...] = ("source", "source_type", "category", "keyword")

    def __post_init__(self) -> None:
        if self.size_s <= 0 or self.slide_s <= 0 or self.slide_s > self.size_s:
            raise ValueError("need 0 < slide_s <= size_s")
        if self.length_unit not in ("chars", "bytes"):
            raise ValueError("length_unit is 'chars' or 'bytes'")

    @classmethod
    def tumbling(cls, size_s: int = 60, **kw) -> "WindowSpec":
        return cls(size_s=size_s, slide_s=size_s, **kw)

    @property
    def size(self) -> str:
        return f"{self.size_s} seconds"

    @property
    def slide(self) -> str:
        return f"{self.slide_s} seconds"

    @property
    def pane_s(self) -> int:
        """Width of the disjoint panes that every window is a union of."""
        return gcd(self.size_s, self.slide_s)

    @property
    def minutes(self) -> float:
        return self.size_s / 60.0


# Breakdowns selected by the aggregation-type names a window configuration uses.
AGGREGATION_TYPES = {
    "basic": ("source",),
    "source_stats": ("source", "source_type"),
    "text_analysis": ("category", "keyword"),
}


def kinds_for(aggregation_types: list[str]) -> tuple[str, ...]:
    """Breakdowns to compute for a list of aggregation-type names."""
    unknown = [t for t in aggregation_types if t not in AGGREGATION_TYPES]
    if unknown:
        raise ValueError(f"unknown aggregation types: {unknown}")
    wanted = {k for t in aggregation_types for k in AGGREGATION_TYPES[t]}
    return tuple(k for k in ("source", "source_type", "category", "keyword") if k in wanted)


@dataclass(frozen=True)
class ValidationConfig:
    """Limits applied to an article. Lengths count UTF-8 bytes unless ``length_unit`` says chars."""

    max_title_length: int = 500
    max_description_length: int = 5000
    allowed_url_schemes: tuple[str, ...] = ("http", "https")
    allow_future_dates: bool = False
    min_year: int = 2000
    html_sanitize: bool = True
    remove_script_tags: bool = True
    length_unit: str = "bytes"
    date_mode: str = "strict"

    def __post_init__(self) -> None:
        if self.date_mode not in ("strict", "lenient"):
            raise ValueError("date_mode is 'strict' or 'lenient'")
        if self.length_unit not in ("chars", "bytes"):
            raise ValueError("length_unit is 'chars' or 'bytes'")


@dataclass(frozen=True)
class StreamSpec:
    """How a stream is cut into micro-batches and how long late rows are waited for."""

    watermark: str = "1 minute"
    trigger: dict = field(default_factory=lambda: {"availableNow": True})
