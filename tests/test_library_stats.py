"""Mean quality halfway between two roundings."""

from __future__ import annotations

SCORES = [0.8039, 0.9072, 0.8407, 0.7462, 0.6896, 0.1782, 0.4326, 0.1579]


def test_mean_does_not_depend_on_the_order_of_rows(spark, tmp_path):
    """The exact mean is 0.5945375; added up as floats in this order it falls below."""
    from corpusloom.plans.corpus_queries import QUERIES

    rows = [(f"s{i}", 1, "a", "c", "l", x, None, "d", False) for i, x in enumerate(SCORES)]
    kind = "skill_id string, updated_at int, source string, category string, license string, quality_score double, superseded_by string, description string, deleted boolean"
    for name, given in (("one", rows), ("other", [(f"s{len(rows) - i}", *r[1:]) for i, r in enumerate(rows)])):
        spark.createDataFrame(given, kind).coalesce(1).write.parquet(str(tmp_path / name / "skills.parquet"))
        got = QUERIES["library_stats"](spark, str(tmp_path / name))
        assert {r.mean_quality for r in got.collect()} == {0.594538} and dict(got.dtypes)["mean_quality"] == "double"
