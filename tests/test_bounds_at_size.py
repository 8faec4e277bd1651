"""What a task holds or reads is bounded by bytes, not by the rows or parts there are."""

import glob

from tessera.operators import extract, pages, resolve
from tessera.plans.resumable import ResumableRun


def test_pages_come_to_python_in_batches_of_bytes(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = spark.range(3).selectExpr("'u' as url", "concat('<p>', id, '</p>') as html")
    got = pages.to_pages(rows)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == 1 << 20
    assert sorted(r.markdown for r in got.collect()) == ["0", "1", "2"]


def test_a_part_is_gathered_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "16k")
    try:
        rows = spark.range(4000).selectExpr("id", "sha2(cast(id as string), 256) as said")
        run = ResumableRun(spark, f"file://{tmp_path}/run", "id", 2)
        assert run.gather(rows) == 4000
    finally:
        spark.conf.unset(size)
    for part in (0, 1):
        assert len(glob.glob(f"{tmp_path}/run/todo/*/__part={part}/*.parquet")) > 1
    assert sorted(r.id for r in run.gathered().collect()) == list(range(4000))


def test_names_are_made_once_and_by_all_tasks(spark):
    """a filter on names was moved below the dealing of pages, into a scan of one task, and names were made twice."""
    none = "cast(null as string)"
    rows = spark.range(40, numPartitions=1).selectExpr(
        "concat('https://x.example/cards/', id) as source_url", "'x' as issuer_id", "'X' as issuer_name", "false as is_listing", "concat('# Gold ', id, if(id < 30, ' Credit Card', '')) as markdown",
        f"{none} as force_card_name", f"{none} as force_category", f"{none} as force_network", "'s' as sha",
    )
    found = extract.cards(rows.repartition(4, "source_url"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    before_dealing = plan[plan.index("RepartitionByExpression") :].split("Range", 1)[0]
    assert "regexp" not in before_dealing.lower() and "RLIKE" not in before_dealing
    assert sorted(r.card_name for r in found.collect()) == sorted(f"Gold {i} Credit Card" for i in range(30))


def test_names_fold_without_a_call_for_each_group(spark):
    """groups of names went through Python one by one, milliseconds each, in the one task that their bytes filled."""
    rows = [("x", "Gold Star Card", 3), ("x", "gold star card", 1), ("x", "Star Gold", 2), ("x", "Blue Card", 4), (None, "Gold Star Card", 5), ("x", None, 6)]
    got = resolve.collapse_names(spark.createDataFrame(rows, "issuer_id string, card_name string, seq long"))
    assert "FlatMapGroups" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.seq, r.kept_by) for r in got.collect()) == [(1, 1), (2, 2), (3, 1), (4, 4), (5, 5), (6, 6)]


def test_the_daily_run_deals_its_pages(spark, tmp_path):
    """written pages are few splits, so one task or two extracted all of them."""
    none = "cast(null as string)"
    spark.range(8).selectExpr(
        "concat('https://x.example/cards/', id) as source_url", "'x' as issuer_id", "'X' as issuer_name", "false as is_listing", "concat('# Gold ', id, ' Credit Card') as markdown",
        f"{none} as force_card_name", f"{none} as force_category", f"{none} as force_network", "'s' as sha",
    ).coalesce(1).write.parquet(f"{tmp_path}/pages")
    found = extract.dealt_cards(spark.read.parquet(f"{tmp_path}/pages"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [source_url" in plan and found.count() == 8
