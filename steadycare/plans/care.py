"""From raw tables to features, model and scores.

What more than one step reads is staged: cleaned visits and dispenses (labels and as-of joins), targets
(site statistics and features) and the small site tables. Everything else stays lazy. Key shuffles
happen after the daily reduction, so each raw table is shuffled once, on (key, day), with duplicates already
combined.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from ..operators import clean, facility, history, targets, visits
from ..sources.staging import stage

Stage = Callable[[DataFrame, str], DataFrame]


def lazily(df: DataFrame, name: str) -> DataFrame:
    """Stage nothing: for small inputs or single-step queries."""
    return df


@dataclass
class Care:
    """Raw tables by name and the steps that lead from them to features.

    With `own_contacts_only` a patient is judged without other patients of the site, as when one
    patient is looked up alone: nothing is known after the last contact, so it has no label.

    `visit_columns` are the features of a visit that the caller reads, by default all. Others are neither made nor carried; rows
    and labels are the same. Laboratory history reads those in `history.LAB_INPUTS`.
    """

    raw: dict[str, DataFrame]
    start: str
    end: str
    stage: Stage = stage
    own_contacts_only: bool = False
    visit_columns: tuple[str, ...] | None = None

    @cached_property
    def lab(self) -> DataFrame:
        return clean.clean_lab_daily(self.raw["lab"], self.start)

    @cached_property
    def pharmacy(self) -> DataFrame:
        cleaned = clean.clean_pharmacy(self.raw["pharmacy"], self.start, self.end)
        return self.stage(cleaned, "pharmacy")

    @cached_property
    def visits(self) -> DataFrame:
        raw = clean.visit_inputs(self.raw["visits"])
        chosen = self.visit_columns
        wanted = None if chosen is None else visits.inputs_of(chosen)
        cleaned = clean.clean_visits(raw, self.raw["dem"], self.start, self.end, wanted)
        made = visits.demographics(visits.visit_features(cleaned))
        if chosen is not None:
            made = made.select(*history.SHARED_WITH_TARGET, *chosen)
        return self.stage(made, "visits")

    @cached_property
    def contacts(self) -> DataFrame:
        return targets.labelled_contacts(self.visits, self.pharmacy, self.raw["dem"])

    @cached_property
    def sites(self) -> DataFrame:
        return self.stage(targets.site_latest(self.visits), "sites")

    @cached_property
    def targets(self) -> DataFrame:
        if self.own_contacts_only:
            labelled = targets.before_last(self.contacts)
        else:
            labelled = targets.resolve_last(self.contacts, self.sites)
        return self.stage(labelled.select(*targets.TARGET_COLUMNS), "targets")

    @cached_property
    def history(self) -> DataFrame:
        return history.full_history(self.targets, self.visits, self.pharmacy, self.lab)

    @cached_property
    def rolling(self) -> DataFrame:
        """Site statistics from the lateness of targets alone: no as-of join is needed for them."""
        late = facility.with_period(history.lateness(self.targets))
        return self.stage(facility.site_rolling(facility.site_month(late)), "rolling")

    @cached_property
    def facilities(self) -> DataFrame:
        return self.stage(facility.facility_survey(self.raw["mfl"], self.raw["dhs"]), "facilities")

    @cached_property
    def features(self) -> DataFrame:
        return facility.facility_features(
            self.history, self.raw["mfl"], self.raw["dhs"], self.raw["txcurr"], self.rolling, self.facilities
        )

    @cached_property
    def latest_sites(self) -> DataFrame:
        return facility.latest_sites(
            self.targets, self.raw["mfl"], self.raw["dhs"], self.raw["txcurr"], self.rolling
        )

    def scoring_features(self, site_table: DataFrame) -> DataFrame:
        """Features whose facility columns come from the saved site table."""
        return facility.with_site_table(self.history, site_table)
