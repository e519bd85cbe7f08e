"""Parameters of the jobs."""

from __future__ import annotations

from dataclasses import astuple, dataclass, field

from sentiseries.functions.scalars import Labels

# The communities, years and cut date the study looks at.
COMMUNITIES = (
    "vancouver", "Seattle", "sydney", "nyc", "ireland", "london", "newzealand", "toronto",
)
YEARS = (2019, 2020, 2021)
CUT_DATE = "2020-03-01"


@dataclass(frozen=True)
class Settings:
    raw_dir: str = "data/raw"
    input_dir: str = "data/input"
    output_dir: str = "data/output"
    communities: tuple[str, ...] = COMMUNITIES
    years: tuple[int, ...] = YEARS
    cut_date: str = CUT_DATE
    top_k: int = 40
    # Parts a community-month is ranked in first; None asks the session's settings.
    top_k_salts: int | None = None
    labels: Labels = field(default_factory=Labels)
    significant_cut: float = 0.5
    bin_width: float = 0.05
    alpha: float = 0.05
    table_format: str = "parquet"
    lexicon_path: str | None = None

    def of_months(self) -> dict:
        """The parameters that the monthly tables depend on; another value makes all months again."""
        return {
            "input": self.input_dir, "top_k": self.top_k, "labels": list(astuple(self.labels)), "significant_cut": self.significant_cut,
            "format": self.table_format, "lexicon": self.lexicon_path,
        }

    def table(self, name: str) -> str:
        return f"{self.output_dir.rstrip('/')}/{name}"
