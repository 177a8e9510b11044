"""Queries that need the mentions several times match the texts once."""

from newslens.operators import late
from newslens.plans.corpus import Corpus
from newslens.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def batch_matches(df) -> int:
    """How often the plan, as it was run, matches texts of the batch path."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("explode(picked")


def test_unified_reports_match_once(spark):
    assert batch_matches(QUERIES["tile_top_sources"](spark, SF)) == 1


def test_stored_mentions_are_not_matched_again(spark, monkeypatch):
    stored, written = late.stored, []
    monkeypatch.setattr(late, "stored", lambda rows: (written.append(rows), stored(rows))[1])
    QUERIES["latest_url_company_stored"](spark, SF)
    assert [batch_matches(rows) for rows in written] == [0, 0]


def test_refresh_reads_stored_tables_only(spark):
    files = QUERIES["refresh_incremental"](spark, SF).inputFiles()
    assert files and not [f for f in files if f.startswith(f"file://{SF}")]


def test_stored_view_has_the_same_rows(spark):
    made, stored = Corpus(spark, SF), Corpus(spark, SF).stored("articles", "mentions", "sentiment")
    for name in ("articles", "mentions", "pairs", "sentiment"):
        columns = getattr(made, name).columns
        assert getattr(made, name).exceptAll(getattr(stored, name).select(*columns)).isEmpty(), name
        assert getattr(made, name).count() == getattr(stored, name).count(), name
