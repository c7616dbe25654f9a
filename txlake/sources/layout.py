"""URIs of every layer below one base. Plain strings, so object stores work too."""

from __future__ import annotations

from dataclasses import dataclass

from txlake.operators.ingest import checked_date


@dataclass(frozen=True)
class Layout:
    base: str
    table: str = "transactions"

    def _uri(self, *parts: str) -> str:
        return "/".join((self.base.rstrip("/"), *parts))

    def landing(self, run_date: str) -> str:
        return self._uri("landing", self.table, f"ingest_date={checked_date(run_date)}")

    @property
    def raw(self) -> str:
        return self._uri("raw", self.table)

    @property
    def curated(self) -> str:
        return self._uri("curated", self.table)

    # The names of the outputs.

    @property
    def avg_risk_score_by_region(self) -> str:
        return self._uri("analytics", "avg_risk_score_by_region")

    @property
    def top3_receiving_address(self) -> str:
        return self._uri("analytics", "top3_receiving_address_by_latest_sale_amount")

    @property
    def quality_report(self) -> str:
        return self._uri("quality", f"{self.table}_quality_report")

    # What is kept by date, or by key, so that a day's run reads a day's rows.

    @property
    def raw_profiles(self) -> str:
        return self._uri("state", f"{self.table}_raw_profiles")

    @property
    def region_sums(self) -> str:
        return self._uri("state", f"{self.table}_region_sums")

    @property
    def daily_latest_sales(self) -> str:
        return self._uri("state", f"{self.table}_daily_latest_sales")

    @property
    def latest_sales(self) -> str:
        return self._uri("state", f"{self.table}_latest_sales")

    @property
    def daily_sketches(self) -> str:
        return self._uri("state", f"{self.table}_daily_sketches")
