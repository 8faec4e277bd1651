"""Tables that grow with the input are never collected by the driver for a broadcast, however small they are here."""

import pytest

from tessera.llm import near, simhash
from tessera.llm.common import Scratch
from tessera.llm.graph import components


@pytest.fixture
def plans(monkeypatch):
    """The plans of all tables written and of the results read at the end."""
    seen: list[str] = []
    keep = Scratch.keep

    def spied(self, df, name):
        seen.append(f"{name}: {plan(df)}")
        return keep(self, df, name)

    monkeypatch.setattr(Scratch, "keep", spied)
    return seen


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def broadcast(plans):
    return [p.split(":")[0] for p in plans if "Broadcast" in p]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(10 * i + j, " ".join(f"w{i * 7 + k}" for k in range(60)) + f" x{j}" * (j % 2)) for i in range(20) for j in range(4)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_components(spark, plans):
    edges = spark.range(50).selectExpr("id as a", "id + 1 as b")
    out = components(edges, Scratch(spark, "test"))
    assert out.count() == 51 and broadcast([*plans, f"result: {plan(out)}"]) == [] and len(plans) > 4


def test_fingerprint_links(docs, plans):
    out = simhash.simhash_components(docs)
    assert out.count() == 80 and broadcast([*plans, f"result: {plan(out)}"]) == []


def test_near_groups(docs, plans):
    out = near.near_groups(docs)
    assert out.count() == 80 and broadcast([*plans, f"result: {plan(out)}"]) == []
