"""Every branch of the varied mapping's rules is reached on sf0.001, true and false."""

from collections import Counter

import pytest

from conftest import SF001
from sigmesh.plans.registry import load_all


@pytest.fixture(scope="module")
def run(spark):
    reg = load_all()
    return lambda name: reg[name].build(spark, SF001).collect()


def test_names(run):
    rows = run("varied_name_rules")
    for c in ("suspicious", "suspicious_retrain", "not_noise", "authority"):
        assert {r[c] for r in rows} == {True, False}, c
    assert any(r.suspicious != r.suspicious_retrain for r in rows)
    assert run("varied_registration_feed")


def test_lookups(run):
    assert Counter(r.action for r in run("varied_lookup_plan"))["lookup"] > 0 < Counter(r.action for r in run("varied_lookup_plan"))["heuristic"]
    rows = run("varied_preliminary")
    assert {r.verdict for r in rows} == {"SYNTHETIC", "REVIEW", "ORGANIC"} and len({r.score for r in rows}) >= 4


def test_pairs(run):
    assert {r.syndicated for r in run("varied_syndication")} == {True, False}
    rows = run("varied_edge_types")
    assert {r.similarity_type for r in rows} == {"structural_clone", "shared_journalistic", "topic_overlap"}
    assert {r.authority_discounted for r in rows} == {r.syndicated for r in rows} == {True, False}
    evidence = run("varied_evidence")
    assert len({r.tier for r in evidence}) == 3
    assert [(-r.similarity, r.domain_a, r.domain_b) for r in evidence] == sorted((-r.similarity, r.domain_a, r.domain_b) for r in evidence)


def test_monitor(run):
    rows = run("varied_run_timeline")
    assert {r.chip for r in rows} == {"HIGH", "MED", "OK"} and {r.threat for r in rows} == {"HIGH", "ELEVATED", "NORMAL"}
    (trend,) = run("varied_run_trend")
    assert trend.change != 0 and trend.arrow in "↑↓"
    assert len({r.freshness for r in run("varied_freshness")}) == 3


def test_pages(run):
    assert {bool(r.bylines) for r in run("varied_bylines")} == {True, False}
    assert all(r.bylines.count("|") == 0 or len(set(r.bylines.split("|"))) == len(r.bylines.split("|")) for r in run("varied_bylines"))
    assert run("varied_byline_outlets")
    assert {len(r.urls.split()) for r in run("varied_article_urls")} == {0, 3}
