"""Reports that read shared frames several times store them: no plan of theirs, stored frames included, has more than six scans."""

import re

import pytest

import __spark_entry__ as entry_points
from venuelake.plans import comps, finance, reservations
from venuelake.sources import sinks

SF = "/root/testdata/sf0.001"
REPORTS = ["rep_comp_flags", "rep_comp_actions", "rep_comp_roster", "rep_comp_risk", "rep_reservation_recon", "rep_reservation_rates", "rep_reservation_ghosts", "rep_event_roi", "rep_event_trend", "rep_insights_event"]


def scans(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return len(re.findall(r"^\(\d+\) Scan (?:parquet|csv|text)", df._jdf.queryExecution().explainString(mode), re.M))


@pytest.mark.parametrize("name", REPORTS)
def test_at_most_six_scans(spark, monkeypatch, name):
    counts, real = {}, sinks.stage

    def stage(df, purpose):
        counts[purpose] = scans(df)
        return real(df, purpose)

    for module in (sinks, comps, finance, reservations):
        monkeypatch.setattr(module, "stage", stage)
    counts["report"] = scans(entry_points.queries()[name](spark, SF))
    assert len(counts) > 1 and max(counts.values()) <= 6, counts
