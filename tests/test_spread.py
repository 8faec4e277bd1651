"""Tables of narrow rows are dealt to tasks by their rows, as splits by bytes would put them into few."""

from tessera import session
from tessera.plans import catalog


def test_tasks_grow_with_the_rows(spark, tmp_path, monkeypatch):
    spark.range(1000).repartition(6).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert session.spread(rows, "id").rdd.getNumPartitions() <= 6
    monkeypatch.setattr(session, "TASK_ROWS", 50, raising=False)
    dealt = session.spread(rows, "id")
    assert dealt.rdd.getNumPartitions() == 20 and sorted(r.id for r in dealt.collect()) == list(range(1000))


def test_answers_are_read_by_all_cores(spark, monkeypatch):
    asked: list[tuple[str, ...]] = []
    monkeypatch.setattr(catalog, "spread", lambda rows, *keys: asked.append(keys) or session.spread(rows, *keys))
    plan = catalog.QUERIES["normalised_answers"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert asked == [("p_partkey",)]
    assert plan.count("try_parse_json") + plan.count("parseJson") <= 2  # an answer is parsed in one place, not for each field
