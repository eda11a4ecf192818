"""The pipeline: every stage on what the one before kept, against brute force."""

from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from conftest import SMALL
from test_operators import EXAMPLES, brute_components, brute_hits, docs, labels, none  # noqa: F401

from zonetide.llm import common, mixing, quality, toxicity


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before each stage and after the last."""
    out = [common.table(spark, SMALL, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(common.stored(stage(spark, out[-1], SMALL), name))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns
    assert stages[-1].columns == [*stages[0].columns, "repetition"]


def test_classifiers_decide(spark, stages):
    labels = common.table(spark, SMALL, "labels")
    scored = toxicity.score(stages[0], toxicity.train(stages[0], labels)).where("not rejected")
    assert ids(stages[1]) == ids(scored)
    scored = quality.score(stages[1], quality.train(stages[1], labels)).where(f"score >= {quality.THRESHOLD}")
    assert ids(stages[2]) == ids(scored)
    assert len(ids(stages[2])) < len(ids(stages[1])) < len(ids(stages[0]))


def test_one_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    assert ids(stages[3]) == {c for _, c in brute_components(rows, 5, 80).values()}


def test_no_benchmark_window_stays(spark, stages):
    items = [tuple(r) for r in common.table(spark, SMALL, "benchmark").collect()]
    clean = {r["doc_id"] for r in stages[3].collect() if not brute_hits(r["text"], items)[1]}
    assert ids(stages[4]) == clean


def test_mix_comes_near_its_targets(stages):
    sized, plan = mixing.mixed(stages[4])
    targets = {r["source"]: r["target"] for r in plan.collect()}
    taken, largest = Counter(), defaultdict(int)
    for r in stages[5].collect():
        n = len(common.spaced_words(r["text"]))
        taken[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    words = {r["doc_id"]: r["size"] for r in sized.collect()}
    assert sum(targets.values()) == pytest.approx(1.5 * sum(words.values()))
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(words.values()) / 2


def test_run_applies_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    key = lambda r: (r["doc_id"], r["repetition"])
    assert sorted(map(key, got.collect())) == sorted(map(key, stages[-1].collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, docs, none, name):  # noqa: F811
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, docs, SMALL).count() <= 2 * len(EXAMPLES)
    assert stage(spark, none, SMALL).count() == 0
