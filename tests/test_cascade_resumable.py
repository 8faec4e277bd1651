"""The cascade over runs in which providers fail, and a run that is killed between commits."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators import cascade, extract
from tessera.operators.registry import Registry
from tessera.plans.resumable import ResumableRun

PAGE = "source_url string, issuer_id string, issuer_name string, is_listing boolean, markdown string, force_card_name string, force_category string, force_network string, sha string"
FILL = " filler words of a page" * 12


def small(rows):
    """Rules that find the names after '#', so that the plan stays small."""
    name = F.regexp_extract("markdown", r"# (\w+ \w+ Card)", 1)
    return rows.where(name != "").select("source_url", F.lit(0).alias("pos"), "sha", "issuer_id", name.alias("card_name"), F.struct(F.lit(None).cast("double").alias("annual_fee_inr")).alias("fees"), F.lit(None).cast("string").alias("network"))


@pytest.fixture()
def keep(spark, tmp_path):
    def keep(df, name):
        path = str(tmp_path / f"{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return keep


def provider(down):
    """Answers for all pages but those of the sources that are down; names the page's own product."""

    def ask(prompts):
        out = []
        for p in prompts:
            source = p.split("SOURCE: ", 1)[1].split("\n", 1)[0]
            card = {"card_name": "Silver Comet Card", "issuer_id": "z", "fees": {"annual_fee_inr": 499}, "network": "Visa"}
            out.append(None if source in down else json.dumps({"cards": [] if "nothing" in source else [card]}))
        return out

    return ask


def test_three_runs_lose_nothing_and_repeat_nothing(spark, keep):
    def page(url, md, issuer="a", listing=False, sha="1"):
        return (url, issuer, "A", listing, md + FILL, None, None, None, sha)

    pages = [
        page("rule", "# Gold Star Card"), page("own", "# Any Other Card", issuer="b"), page("own-none", "text", issuer="b"), page("list", "text", listing=True),
        page("x1", "Silver Comet Card"), page("x2", "Silver Comet Card"), page("nothing", "text"), page("ungrounded", "text"), ("short", "a", "A", False, "x", None, None, None, "1"), ("null", "a", "A", None, None, None, None, None, "1"),
    ]
    own = Registry()
    own.register(["b"], small)
    down = [{"x1", "x2", "nothing"}, {"x2"}, set()]
    ledger, cards, handled = spark.createDataFrame([], cascade.ATTEMPTS), [], []
    for run, off in enumerate(down):
        rows = cascade.due(spark.createDataFrame(pages, PAGE), ledger)
        handled.append({r.source_url for r in rows.collect()})
        got = cascade.extract_pages(rows, f"t{run}", keep, own, small, provider(off))
        cards += [(r.source_url, r.card_name, r.fees.annual_fee_inr, r.issuer_id) for r in got.cards.collect()]
        ledger = keep(ledger.unionByName(got.attempts).unionByName(got.attempts), "ledger")  # reported twice
    assert handled[1:] == [{"x1", "x2", "nothing"}, {"x2"}]
    assert sorted(cards) == [("own", "Any Other Card", None, "b"), ("rule", "Gold Star Card", None, "a"), ("x1", "Silver Comet Card", 499.0, "a"), ("x2", "Silver Comet Card", 499.0, "a")]
    state = {r.source_url: (r.status, r.step, r.n_runs) for r in cascade.standing(ledger).collect()}
    assert state == {
        "rule": ("ok", "rules", 1), "own": ("ok", "extractor", 1), "own-none": ("empty", "extractor", 1), "list": ("empty", "listing", 1), "short": ("empty", "short", 1), "null": ("empty", "short", 1),
        "x1": ("ok", "provider", 2), "x2": ("ok", "provider", 3), "nothing": ("empty", "provider", 2), "ungrounded": ("empty", "provider", 1),
    }
    changed = spark.createDataFrame([page("rule", "# New Star Card", sha="2"), page("rule", "# Gold Star Card")], PAGE)
    assert [r.sha for r in cascade.due(changed, ledger).collect()] == ["2"]


def test_deepen_fills_gaps_of_rule_cards(spark, keep):
    pages = spark.createDataFrame([("u", "a", "A", False, "# Silver Comet Card" + FILL, None, None, None, "1"), ("v", "a", "A", True, "# Gold Star Card" + FILL, None, None, None, "1")], PAGE)
    got = cascade.extract_pages(pages, "t", keep, rules=small, provider=provider(set()), deepen=True)
    assert sorted((r.source_url, r.card_name, r.network, r.fees.annual_fee_inr) for r in got.cards.collect()) == [("u", "Silver Comet Card", "Visa", 499.0), ("v", "Gold Star Card", None, None)]
    failed = cascade.extract_pages(pages, "t", keep, rules=small, provider=provider({"u", "v"}), deepen=True)
    assert {r.network for r in failed.cards.collect()} == {None} and {r.status for r in failed.attempts.collect()} == {"ok"}


def test_rules_are_the_extractor_by_default(spark, keep):
    assert cascade.extract_pages.__defaults__[1] is extract.cards


def test_killed_run_repeats_one_part(spark, tmp_path, monkeypatch):
    rows = spark.range(100).select(F.concat(F.lit("u"), "id").alias("url"), (F.col("id") % 3).cast("string").alias("issuer"))
    done = []

    def work(part):
        done.append(sorted(r.url for r in part.collect()))
        return part.withColumn("error", F.when(F.col("url") == "u7", "down"))

    run = ResumableRun(spark, f"file://{tmp_path}/run", "url", parts=5)
    assert run.gather(rows.unionByName(rows.limit(10))) == 100 and run.results() is None
    commit, calls = ResumableRun._commit, []

    def killed(self, name, **said):
        calls.append(name)
        if len(calls) == 3:
            raise KeyboardInterrupt
        commit(self, name, **said)

    monkeypatch.setattr(ResumableRun, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        run.resume(work)
    monkeypatch.setattr(ResumableRun, "_commit", commit)
    assert run.results().count() + run.fails().count() == len(done[0]) + len(done[1])
    again = ResumableRun(spark, f"file://{tmp_path}/run", "url", parts=5)
    assert again.gather(rows) == 0
    assert len(again.resume(work)) == 3 and again.resume(work) == []
    assert len(done) == 6 and done[2] == done[3] and sorted(u for d in done[:2] + done[3:] for u in d) == sorted(f"u{i}" for i in range(100))
    assert sorted(r.url for r in again.results().collect()) == sorted(f"u{i}" for i in range(100) if i != 7)
    assert [r.url for r in again.fails().collect()] == ["u7"]
    assert again.gather(spark.createDataFrame([("u5", "0"), ("new", "0"), (None, "0")], "url string, issuer string")) == 1
    assert {r.issuer: (r.total, r.done, r.left) for r in again.status("issuer").collect()} == {"0": (35, 34, 1), "1": (33, 33, 0), "2": (33, 33, 0)}
    again.resume(work)
    assert again.results().count() == 100


def test_commits_are_not_overwritten(spark, tmp_path):
    run = ResumableRun(spark, f"file://{tmp_path}/run", "url")
    run._commit("done-0-0", kind="done", generation=0, part=0, path="", rows=0, fails=0)
    with pytest.raises(RuntimeError):
        run._commit("done-0-0", kind="done", generation=0, part=0, path="", rows=0, fails=0)
    assert ResumableRun(spark, f"file://{tmp_path}/run", "url").results() is None
