"""The batch job run twice: numbers, repeated input, rejects and the log."""

from datetime import datetime

from conftest import tuples
from pyspark.sql import functions as F

from newslens.operators.numbering import number_inserted
from newslens.plans.batch import run_batch, stored
from newslens.sources.providers import rejects
from newslens.sources.tables import current

ITEM = '{{"url":"{}","title":"{}","publishedAt":"2024-01-0{}T10:00:00Z"}}'


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_two_runs(spark, rows, tmp_path):
    root = str(tmp_path / "batch")
    body = lambda *items: '{"status":"ok","articles":[' + ",".join(items) + "]}"
    first = [body(ITEM.format("u1", "alpha good", 1), ITEM.format("u2", "beta", 2)), "garbage", '{"status":"error"}']
    second = [body(ITEM.format("u2", "beta alpha", 3), ITEM.format("u3", "nothing", 3)), body(ITEM.format("u2", "beta alpha", 3))]
    landed = lambda bodies: rows([(b, datetime(2024, 2, 1)) for b in bodies], "body string, ingested_at timestamp_ntz")
    aliases = rows([(1, "Alpha"), (2, "beta")], "company_id bigint, alias string")
    words = rows([("good", 2.0)], "token string, valence double")
    run_batch(landed(first), aliases, words, root, "r1", ntz("2024-03-01"))
    before = {r.url: r.article_id for r in stored(spark, root, "articles").collect()}
    made = run_batch(landed(second), aliases, words, root, "r2", ntz("2024-03-02"))
    after = {r.url: r.article_id for r in made["articles"].collect()}
    assert set(before) == {"u1", "u2"} and before == {u: after[u] for u in before} and sorted(after.values()) == [1, 2, 3]
    pairs = {(u, c) for u, a in after.items() for _, a2, c in tuples(made["mentions"].select("mention_id", "article_id", "company_id")) if a == a2}
    assert pairs == {("u1", 1), ("u2", 1), ("u2", 2)}
    for name, number in (("mentions", "mention_id"), ("sentiment", "sentiment_id")):
        numbers = [r[number] for r in made[name].collect()]
        assert sorted(numbers) == [1, 2, 3]
    mart = {(str(r.metric_date), r.company_id): (r.article_count, r.updated_at.day) for r in made["daily_mart"].collect()}
    assert mart[("2024-01-01", 1)] == (1, 1) and mart[("2024-01-03", 1)] == (1, 2) and mart[("2024-01-03", 2)] == (1, 2)
    log = {r.run_id: r for r in spark.read.parquet(f"{root}/run_log").collect()}
    assert (log["r1"].status, log["r2"].status) == ("partial_success", "success")
    assert log["r1"].error_message == "2 responses could not be used"
    assert current(spark, f"{root}/rejects").count() == 0


def test_inserted_rows_are_worked_out_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    merged = rows([(7, "old"), (None, "new"), (None, "newer")], "id bigint, k string").mapInPandas(counting, "id bigint, k string")
    numbered = number_inserted(merged, ["k"], "id", rows([(7,)], "id bigint"))
    assert sorted(r.id for r in numbered.collect()) == [7, 8, 9]
    assert seen.value == 3


def test_rejects_are_listed_once_each(rows):
    bodies = ['{"status":"ok","articles":[]}', '{"status":"error"}', '{"status":"error","articles":{}}', "torn {", " ", None, '{"status":"error"}']
    listed = [tuple(r) for r in rejects(rows([(b,) for b in bodies], "body string")).collect()]
    expected = [(bodies[1], bodies[1]), (bodies[2], "articles is not a list"), ("torn {", "not json"), (" ", "blank body"), (None, "blank body"), (bodies[6], bodies[6])]
    assert sorted(map(str, listed)) == sorted(map(str, expected))
