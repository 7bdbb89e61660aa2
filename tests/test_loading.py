import datetime
import json
import uuid

import pytest

import creditspark as cs
from creditspark.sources import load


def raw(spark):
    rows = [
        ("a", "2023-01-05", "x", 0, 1.0, -999.0, 7),
        ("a", "2023-01-05", "x", 0, 2.0, 3.0, 7),
        ("b", "2023-02-06", "y", 1, float("nan"), -1.0, 7),
        ("c", "20230307", "y", 2, 1.0, 1.0, 7),
        ("d", "2023-03-08", "y", None, 1.0, 1.0, 7),
        ("e", "2023-03-09", "x", 1, 5.0, -1111.0, 7),
    ]
    return spark.createDataFrame(
        rows, "id string, day string, org string, label int, f double, g double, same int"
    )


def test_clean_sample_applies_all_steps(spark):
    clean = cs.clean_sample(raw(spark), "day", "label", "org", key_cols=["id", "absent"], drop_cols=["absent"])
    assert "same" not in clean.columns and "id" not in clean.columns
    rows = {(r.new_date, r.new_org): r for r in clean.collect()}
    assert set(rows) == {("20230105", "x"), ("20230206", "y"), ("20230309", "x")}
    assert rows["20230105", "x"].f == 1.0 and rows["20230206", "y"].f is None
    assert rows["20230309", "x"].new_date_ym == "202303"
    # Only the dropped copy of key "a" had a value for g: what is left is constant.
    assert "g" not in clean.columns


def test_sentinels_hit_numbers_only_and_nan_becomes_null(spark):
    df = spark.createDataFrame([(-999, "-999", -1.0), (5, "x", float("nan"))], "i int, s string, d double")
    assert [tuple(r) for r in cs.null_sentinels(df).collect()] == [(None, "-999", None), (5, "x", None)]


def test_dates_of_all_kinds_and_default_org(spark):
    day = datetime.date(2023, 1, 5)
    rows = [(day, datetime.datetime(2023, 1, 5, 7), "2023-01-05", "20230105", 0), (day, None, None, None, 1)]
    df = spark.createDataFrame(rows, "d date, t timestamp, s string, k string, y int")
    for column in "tsk":
        clean = cs.clean_sample(df.select(column, "y"), column, "y")
        assert [(r.new_date, r.new_org) for r in clean.orderBy("new_target").collect()] == [
            ("20230105", "default"), ("nan", "default")]


def test_dedupe_keeps_first_and_null_keys_are_equal(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "z"), (1, 9, "c")], "k int, o int, v string")
    assert sorted(map(tuple, cs.dedupe_first(df, ["k"], ["o"]).collect()), key=repr) == [(1, 9, "c"), (None, 1, "z")]


def test_missing_role_column_is_an_error(spark):
    with pytest.raises(ValueError, match="nope"):
        cs.clean_sample(raw(spark), "nope", "label")


def test_readers_and_writers(spark, tmp_path):
    df = raw(spark)
    cs.write_csv(df, f"{tmp_path}/c", bom=False)
    assert cs.read_table(spark, f"{tmp_path}/c", fmt="csv").count() == 6
    cs.write_csv(df, f"{tmp_path}/b", report_headers=True)
    parts = [p.read_bytes() for p in (tmp_path / "b").glob("part-*.csv")]
    assert all(p.startswith("\ufeffid,day,机构,".encode()) for p in parts)
    cs.write_json(df, f"{tmp_path}/j")
    assert cs.read_table(spark, f"{tmp_path}/j", fmt="json").count() == 6
    clean = cs.clean_sample(df, "day", "label", "org")
    cs.write_parquet(clean, f"{tmp_path}/p", by_month=True)
    assert (tmp_path / "p" / "new_date_ym=202301").exists()
    assert cs.load_sample(spark, f"{tmp_path}/j", "day", "label", org_col="org", fmt="json").count() == 4
    with pytest.raises(ValueError, match="format"):
        cs.read_table(spark, "x", fmt="xlsx")


def test_feature_list(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps(["f", "gone", "g"], indent=1))
    assert cs.read_feature_list(spark, f"{tmp_path}/f.json") == ["f", "gone", "g"]
    assert cs.read_feature_list(spark, f"{tmp_path}/f.json", raw(spark)) == ["f", "g"]
    assert cs.present(["g", "zz"], raw(spark)) == ["g"]
    cs.write_feature_list(spark, ["g", "größe"], f"{tmp_path}/list")
    assert cs.read_feature_list(spark, f"{tmp_path}/list") == ["g", "größe"]


@pytest.mark.parametrize("few", [True, False])
def test_clean_sample_evaluates_its_input_once(spark, tmp_path, monkeypatch, few):
    rows = [(i % 40 if i < 60 else i, "2023-01-05", i % 2, None if i % 7 == 0 else float(i * 31 % 17)) for i in range(300)]
    df = spark.createDataFrame(rows + rows[:5], "k int, day string, label int, x double").repartition(1)

    def counted(batches):
        (tmp_path / uuid.uuid4().hex).touch()
        yield from batches

    monkeypatch.setattr(load, "is_small", lambda *a, **b: few)
    clean = cs.clean_sample(df.mapInArrow(counted, df.schema), "day", "label", key_cols=["k"])
    first = {}
    for k, _, label, x in rows:
        # Lowest in all columns, nulls first.
        new = (label, x is not None, x or 0.0)
        first[k] = min(first.get(k, new), new)
    assert sorted((r.new_target, r.x is not None, r.x or 0.0) for r in clean.collect()) == sorted(first.values())
    assert len(list(tmp_path.iterdir())) == 1
