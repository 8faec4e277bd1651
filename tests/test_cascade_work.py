"""The cascade's costly work is done once: what is due is found once a run, and an answered name is made once."""

from tessera.operators import cascade, enrich
from tessera.plans import catalog


def test_pages_of_a_run_are_found_once(spark, monkeypatch):
    class Enough(Exception):
        pass

    def see(pages, *_, **__):
        plan = pages._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "sha2" not in plan, plan
        raise Enough

    monkeypatch.setattr(cascade, "extract_pages", see)
    try:
        catalog.cascade_three_runs(spark, "/root/testdata/sf0.001")
    except Enough:
        return
    raise AssertionError("no run was seen")


def test_answered_names_are_made_once(spark):
    found = spark.createDataFrame(
        [("u", 0, ("Silver Comet Card", "i")), ("u", 1, ("Golden Moon Card", "i")), ("u", 2, (None, "i")), ("v", 0, ("Apply for Silver Comet Card", "i")), ("w", 0, ("", "i")), ("x", 0, ("Blue Star Card", "j"))],
        "source_url string, pos int, card struct<card_name: string, issuer_id: string>",
    )
    pages = spark.createDataFrame([("u", "the silver comet", "p"), ("v", "silver comet", ""), ("w", "silver", "p")], "source_url string, markdown string, issuer_id string")
    rows = enrich.trusted(found, pages)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"(?<=\w)\s*\|") == 1, plan
    got = sorted((r.source_url, r.pos, r.card.card_name, r.card.issuer_id, r.issuer_id) for r in rows.collect())
    assert got == [("u", 0, "Silver Comet Card", "i", "p"), ("v", 0, "Silver Comet Card", "i", "i"), ("x", 0, "Blue Star Card", "j", "j")]
    assert rows.columns == ["source_url", "pos", "card", "issuer_id"]
