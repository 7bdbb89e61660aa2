"""Places in groups, and the queries that take them, without a window over a whole group."""

from creditspark.plans.ranking import with_places
from workload import fixtures as fx
from workload import queries


def test_places_of_null_groups_and_equal_rows(spark):
    rows = [(None, 3)] * 4 + [("a", i % 7) for i in range(30)] + [("b", 1)]
    found = with_places(spark.createDataFrame(rows, "g string, v int").repartition(5), ["g"], ["v"]).collect()
    for g in (None, "a", "b"):
        own = sorted((r.place, r.v) for r in found if r.g == g)
        assert own == list(enumerate(sorted(v for k, v in rows if k == g)))


def test_segments_are_cut_without_a_window_per_organisation(spark, monkeypatch):
    rows = [(f"o{i % 2}", i, 1, float(i % 50), 0.01 * (i % 11), i % 3 % 2, (i % 50) / 50) for i in range(400)]
    names = "new_org string, l_orderkey long, l_linenumber int, quantity double, discount double, new_target int, p double"
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().toString())
        return df

    monkeypatch.setattr(fx, "scored", lambda *_: spark.createDataFrame(rows, names))
    monkeypatch.setattr(queries, "written", kept)
    sizes = {r.segment: r.n_samples for r in queries.segment_sizes(spark, "").collect()}
    assert sizes == {f"o{i}-{s}": n for i in (0, 1) for s, n in (("b", 50), ("c", 51), ("d", 50))}
    assert all("row_number(" not in p for p in plans)
