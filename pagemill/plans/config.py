"""The settings of a run, checked before it starts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import sites as S

FLAGS = (("name", "--name"), ("category", "--category"), ("everything", "--all"), ("max_articles", "--max-articles"), ("workers", "--workers"), ("limit", "--limit"), ("list_sites", "--list-sites"))
#: Whole numbers with their least and greatest values; a truth value is not a number.
RANGES = {"max_articles": (1, None), "workers": (1, None), "limit": (0, None), "rounds": (1, None), "hour": (0, 23), "minute": (0, 59)}


@dataclass(frozen=True)
class RunConfig:
    """P10, P11"""

    name: str = ""
    category: str = ""
    everything: bool = True
    list_sites: bool = False
    max_articles: int = 20
    workers: int = 8
    limit: int = 0
    rounds: int = 50
    hour: int = 18
    minute: int = 0
    utc_offset_hours: float = 8
    poll_seconds: float = 30

    def problems(self) -> list[str]:
        """What is wrong with these settings, in words."""
        out = [f"{f} is not text" for f in ("name", "category") if not isinstance(getattr(self, f), str)]
        out += [f"{f} is neither True nor False" for f in ("everything", "list_sites") if not isinstance(getattr(self, f), bool)]
        for field, (least, most) in RANGES.items():
            value = getattr(self, field)
            if type(value) is not int or value < least or (most is not None and value > most):
                out.append(f"{field} is not a whole number from {least}" + (f" to {most}" if most is not None else ""))
        if not self.list_sites and [bool(self.name), bool(self.category), self.everything is True].count(True) != 1:
            out.append("choose one of name, category and everything")
        if not 0 < self.poll_seconds <= 60:
            out.append("poll_seconds is not above 0 and at most 60")
        if not -24 < self.utc_offset_hours < 24:
            out.append("utc_offset_hours is not between -24 and 24")
        return out

    def validate(self) -> RunConfig:
        if found := self.problems():
            raise ValueError("; ".join(found))
        return self

    def arguments(self) -> list[str]:
        """The settings as command line flags; a number is always given, the others where they are set."""
        self.validate()
        given = [(flag, getattr(self, field)) for field, flag in FLAGS]
        return [x for flag, v in given if v or type(v) is int for x in ([flag] if v is True else [flag, str(v)])]

    def chosen(self, sites: DataFrame) -> DataFrame:
        """The sites of this run by their order: by name before category before all, the first `limit` (0: all)."""
        out = S.by_name(sites, self.name) if self.name else S.by_category(sites, self.category) if self.category else sites
        return out.orderBy("ord", "name").limit(self.limit) if self.limit else out
