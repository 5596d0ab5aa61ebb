"""Queries over events: every one of them counts."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from lurewatch.plans.catalog import CATALOG

START = datetime(2024, 3, 1, 12)


def test_every_event_is_dealt_to_the_mails_of_a_document(spark, tmp_path):
    """Twenty documents; 5 and 90 have an image-only mail besides, and no event turns to 90."""
    ids = [*range(19), 90]
    spark.createDataFrame([(i, "see https://bit.ly/x") for i in ids], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    stamps = [(e, START + timedelta(days=e % 7, seconds=e)) for e in range(70)]
    spark.createDataFrame(stamps, "event_id long, ts timestamp").write.parquet(f"{tmp_path}/events.parquet")

    want = {}
    span = max(int((t - START).total_seconds()) for _, t in stamps) + 1
    for mail in [*ids, -6, -91]:
        own = [t for e, t in stamps if e % len(ids) == max(mail, -1 - mail)]
        for t in own or [START + timedelta(seconds=mail * 7919 % span)]:
            want[t.date()] = want.get(t.date(), 0) + 1
    assert sum(want.values()) == 70 - 3 + 4 + 2  # three events turn to a document that is not there

    drift = CATALOG["drift_windows"][0](spark, str(tmp_path)).collect()
    assert {r.window_start.date(): r.n for r in drift} == want
    history = CATALOG["technique_prevalence"][0](spark, str(tmp_path)).collect()
    days = {date(1970, 1, 1) + timedelta(days=r.period): r.n for r in history if r.technique == "url_shortener"}
    assert days == want
    forecast = CATALOG["technique_forecast"][0](spark, str(tmp_path))
    last = {r.technique: r.p for r in forecast.groupBy("technique").agg(F.max("period").alias("p")).collect()}
    assert set(last.values()) == {max(r.period for r in history) + 3}
    assert CATALOG["trend_direction"][0](spark, str(tmp_path)).count() == CATALOG["technique_trend"][0](spark, str(tmp_path)).count() == 3
