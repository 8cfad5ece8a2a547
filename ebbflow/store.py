"""One entry point over a data folder: the tables by name, ready for the operators.

Layout below the root (any file system Spark reads):
  movement/        refined movement, parquet by yyyymm      (sinks.write_months)
  population/      refined hourly population, parquet by yyyymm
  census/          long census, parquet: areas, age_5_start, pop_5
  contacts/        contact matrices, parquet: setting, contact_idx, participant_idx, value
  ili/             season rows, one CSV per age group, code page 949
  ili_total/       season rows of all ages, code page 949
  claims/<setting> claims export, CSV
  employment/      employment table, CSV, code page 949
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ebbflow import vocab
from ebbflow.contracts import require_choice
from ebbflow.functions import calendar
from ebbflow.operators import census, claims, contact, employment, ili, mobility
from ebbflow.sources import readers


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def movement(self, first: str, last: str | None = None) -> DataFrame:
        return readers.months(self.spark, self._at("movement"), first, last or first)

    def population(self, first: str, last: str | None = None) -> DataFrame:
        return readers.months(self.spark, self._at("population"), first, last or first)

    def census(self) -> DataFrame:
        return readers.parquet(self.spark, self._at("census"))

    def population_15(self, provinces: list[str] | None = vocab.CAPITAL_SIDO_NAMES) -> DataFrame:
        return census.to_15_groups(self.census(), provinces)

    def daily_flow(
        self, yyyymm: str, daytype: str = "weekday", holidays="mobility", census_areas: bool = True
    ) -> DataFrame:
        """Mean daily flow of a month, by default between the areas of the census only."""
        index = mobility.area_index(self.population_15()) if census_areas else None
        return mobility.daily_flow(self.movement(yyyymm), daytype, holidays, index)

    def contacts(self) -> DataFrame:
        return contact.checked(readers.parquet(self.spark, self._at("contacts")))

    def contact_matrix(self, daytype: str | None = None, weights: dict | None = None) -> DataFrame:
        return contact.combine(self.contacts(), daytype, weights)

    def calendar(self, start_ymd: int, end_ymd: int) -> DataFrame:
        return calendar.calendar_between(self.spark, start_ymd, end_ymd)

    def ili(self, age_group: str | None = None) -> DataFrame:
        """Weekly rates of all ages together, or of one surveillance group."""
        if age_group is None:
            return ili.to_long(readers.ili_csv(self.spark, self._at("ili_total")))
        return ili.for_age(self.ili_by_age(), age_group)

    def ili_by_age(self) -> DataFrame:
        return ili.to_long(readers.ili_by_age_csv(self.spark, self._at("ili")), ("age_group",))

    def claims(self, setting: str = "outpatient_inpatient", **filters) -> DataFrame:
        require_choice(setting, vocab.CLAIMS_SETTINGS, "setting")
        raw = readers.claims_csv(self.spark, self._at("claims", setting))
        return claims.select(claims.normalise(raw), **filters)

    def employment(self, sex: str = "계") -> DataFrame:
        return employment.rates(readers.employment_csv(self.spark, self._at("employment")), sex)

    def area_rates(self, fill_under_15: float = 0.0, fill_unknown: float = 0.0) -> DataFrame:
        """Employment rate of every census area and age."""
        areas = self.census().select("admdong_cd").distinct()
        return employment.area_rates(
            areas, self.employment(), fill_under_15=fill_under_15, fill_unknown=fill_unknown
        )
