"""Refresh of the model from raw tables."""

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import underscore_names
from ..operators import evaluate, history, models, scoring, splits
from ..sources.layout import PatientTables
from ..sources.readers import CLINICAL_TABLES, rows_by_request
from ..sources.sinks import write_csv, write_model, write_site_table
from ..sources.staging import Resumable, stage
from .care import Care

ALWAYS = ("0001-01-01", "9999-12-31")


@dataclass
class Refreshed:
    model: object
    encoder: models.Encoder
    thresholds: DataFrame
    scored: DataFrame


@dataclass(frozen=True)
class RefreshSettings:
    refresh_date: str
    emr_allow: tuple[str, ...]
    emr_positive: str
    trainer: str = "gbt"
    parameters: dict = field(default_factory=dict)
    default_site: str | None = None


def refresh_model(features: DataFrame, settings: RefreshSettings, settle=stage) -> Refreshed:
    """Train on the first five months before the refresh date, set thresholds on the last one."""
    rows = splits.model_rows(
        underscore_names(features), settings.refresh_date, settings.emr_allow, settings.emr_positive
    )
    rows = settle(rows, "model_rows")
    split = splits.refresh_split(rows, settings.refresh_date)
    encoder = models.fit_encoder(rows, split.filter("slice = 'train'"), settle)
    encoded = settle(encoder.apply(split), "encoded")
    train, val = (encoded.filter(F.col("slice") == s) for s in ("train", "val"))
    more = {"settle": settle} if settings.trainer == "gbt" else {}
    model = models.TRAINERS[settings.trainer](train, val, **more, **settings.parameters)
    scored = settle(models.predict(model, val), "scored")
    thresholds = settle(evaluate.site_thresholds(rows, scored, settle=settle), "thresholds")
    return Refreshed(model, encoder, thresholds, scored)


def retrain(care: Care, settings: RefreshSettings, folder: str, at: datetime | None = None, settle=stage) -> str:
    """Features, site table, model, thresholds and scored validation rows, published under `folder`.

    The site table and the model are published when each is whole. With a `Resumable` for `settle`, and for the stage of `care`, a
    job that stopped goes on from the tables it has finished; what it staged is then removed at the end.
    """
    write_site_table(care.latest_sites, f"{folder}/sites", at.date() if at else None)
    done = refresh_model(care.features, settings, settle)
    report = evaluate.categorise(evaluate.with_thresholds(done.scored, done.thresholds))
    scored = {"scored": lambda path: write_csv(report.select("sitecode", "score", "pred_cat"), path)}
    version = write_model(f"{folder}/models", done.model.write(), done.encoder, done.thresholds, at, scored)
    if isinstance(settle, Resumable):
        settle.remove()
    return version


def score_requests(
    requests: DataFrame, raw: dict[str, DataFrame] | PatientTables, period: tuple[str, str], site_table: DataFrame,
    scorer: scoring.Scorer, thresholds: DataFrame, settings: RefreshSettings, settle=stage, on: date | None = None,
    visit_columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """Answer every request (patient, site, and dates `start` and `end`) with a score, a category and risk factors.

    A request without dates is for `period`, one without a site for all sites of its patient. From `PatientTables` only
    the buckets of requested patients are read. Only rows of a requested patient and period go on after the scan; from there
    on it is the same work as for training. A patient's answer does not depend on who else, or which other period, is
    requested. `visit_columns`: the visit features that the scorer reads, by default all; what the report reads is added to them.
    """
    first, last = (F.lit(day).cast("date") for day in period)
    asked = requests.withColumns(
        {
            "start": F.coalesce(F.col("start").cast("date"), first) if "start" in requests.columns else first,
            "end": F.coalesce(F.col("end").cast("date"), last) if "end" in requests.columns else last,
        }
    )
    tables = {name: raw.of_patients(name, asked) for name in CLINICAL_TABLES} if isinstance(raw, PatientTables) else raw
    wanted = {name: rows_by_request(tables[name], asked, name) for name in CLINICAL_TABLES}
    if visit_columns is not None:
        visit_columns = tuple(dict.fromkeys([*visit_columns, "emr", *scoring.VISIT_FACTORS, *history.LAB_INPUTS]))
    care = Care(wanted, *ALWAYS, stage=settle, own_contacts_only=True, visit_columns=visit_columns)
    scored = scoring.batch_score(
        care.scoring_features(site_table), scorer, thresholds, settings.emr_allow,
        settings.emr_positive, settings.default_site, on,
    )
    return scoring.answer_requests(asked, scored)
