"""Hard negatives against plain inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonetide.llm import negatives


@pytest.mark.parametrize("reach", [1, 3, 300, 40_000, 2**31])
@pytest.mark.parametrize("width", [1, 8, 13, 64])
def test_table_scores_are_inner_products(reach, width):
    draw = np.random.default_rng(reach + width)
    anchors, others = (draw.integers(-reach, reach, (n, width), endpoint=True) for n in (9, 70))
    others[0], others[1] = reach, -reach
    anchors[0] = -reach
    planes = negatives.planes_of(others, negatives.bits_of(others))
    if reach < 2**31 or width < 2:  # within 64 bits
        assert (negatives.Tables(anchors, reach).scores(planes) == others @ anchors.T).all()


def plain(rows):
    out = []
    rows = [(i, label, v) for i, label, v in rows if None not in (i, label, v) and None not in v]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for n, (anchor, label, v) in enumerate(rows):
        if anchor % 50:
            continue
        scored = [(-dot(v, w), i, m, other) for m, (i, other, w) in enumerate(rows) if m != n]
        same = sorted(s for s in scored if s[3] == label)[:5]
        for score, positive, _, _ in same:
            fit = sorted(s for s in scored if s[3] != label and 50 * -score <= 100 * -s[0] <= 95 * -score)[:3]
            out += [(anchor, positive, r + 1, s[1], -score, -s[0]) for r, s in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("block", [2, 4096])
def test_mining_equals_plain_search_with_ties_repeats_and_gaps(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "STEP", 7)
    monkeypatch.setattr(negatives, "TABLE", 3)
    draw = np.random.default_rng(4)
    rows = [(i * 10, int(draw.integers(3)), draw.integers(-3, 4, 6).tolist()) for i in range(120)]
    rows += [(50, 1, [2, 2, 2]), (50, 1, [2, 2, 2]), (7, 2, [3] * 6), (None, 1, [1] * 6), (100, None, [1] * 6), (150, 1, None), (200, 1, [])]
    rows += [(3, 0, [2] * 6)] * 40
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, v array<long>, score string").repartition(3)
    got = negatives.mine(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain([(i, label, v) for i, label, v in rows])


def test_vectors_that_take_no_part(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(50, [0.5, 0.25], 1), (1, [0.5, nan], 1), (2, [inf, 0.1], 1), (3, None, 1), (4, [0.5, None], 1), (5, [0.5, 0.5], 1), (6, [0.3, 0.3], 2), (7, [0.3, 0.3], 9), (8, [], 1), (9, [0.5, 0.5], None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted(map(tuple, negatives.op12_hard_negatives(spark, str(tmp_path)).collect()))
    # 128*128 + 64*128 = 24576; 76*128 + 76*64 = 14592; row 7 becomes label 0
    assert got == [(50, 5, 1, 6, 24576, 14592), (50, 5, 2, 7, 24576, 14592)]
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "none" / "embeddings.parquet"))
    assert negatives.op12_hard_negatives(spark, str(tmp_path / "none")).collect() == []
