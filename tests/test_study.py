"""The study job: presets, and its verdicts on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from massloom.plans.registry import QUERIES
from massloom.plans.study import settings
from massloom.session import SHUFFLES_END, next_round


def test_presets():
    assert settings().rt_filter and settings().blank_multiplier == 5.0 and not settings().presence
    study = settings("study", min_files=3)
    assert (study.rt_filter, study.blank_multiplier, study.presence, study.min_files) == (False, 3.0, True, 3)
    with pytest.raises(ValueError):
        settings("lab")
    with pytest.raises(TypeError):
        settings("study", dot=1)


def test_study_job_names_and_removes_groups(spark):
    import __spark_entry__  # noqa: F401  registers the queries

    rows = QUERIES["study_unfiltered"](spark, "/root/testdata/sf0.001").collect()
    status = [r.filter_status for r in rows]
    print({s: status.count(s) for s in set(status)})
    assert len({r.group_id for r in rows}) == len(rows) and any(r.name for r in rows)
    assert 0 < status.count("") < len(rows) and "Blank" in status


def _left_on_disk(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.length())) if name.startswith("shuffle")}


def test_written_tables_leave_no_shuffle_files(spark):
    setting = spark.conf.get(SHUFFLES_END, "false")
    rows = spark.range(50_000).withColumn("k", F.col("id") % 9_973)
    before = _left_on_disk(spark)
    table = next_round(rows.repartition(4, "k").groupBy("k").agg(F.sum("id").alias("s")))
    assert not _left_on_disk(spark) - before
    assert table.count() == 9_973 and table.agg(F.sum("s")).first()[0] == 50_000 * 49_999 // 2
    assert spark.conf.get(SHUFFLES_END, "false") == setting


def test_association_copies_features_little(spark, monkeypatch):
    import __spark_entry__  # noqa: F401
    from massloom.operators import groups as G
    from massloom.plans import standin as S
    from massloom.plans.catalog.groups import features, hits

    d, real, copies, wide = "/root/testdata/sf0.001", G.band_join, [], []

    def counted(left, right, bands, keys=(), how="inner", salt=1, where=None):
        n = salt
        for b in bands:
            tol = F.col(b.tol) if isinstance(b.tol, str) else F.lit(b.reach())
            n = n * (1 + 2 * tol / b.bin_width())  # cells a row reaches, on average
        copies.append(right.agg(F.avg(n)).first()[0])
        wide.append("components" in left.columns)
        return real(left, right, bands, keys, how, salt, where)

    monkeypatch.setattr(G, "band_join", counted)
    h = hits(spark, d)
    out = G.associate(h.union(h.limit(50)), features(spark, d), S.groups(spark, d))
    assert len(copies) == 2 * G.PASSES and max(c for c in copies if c) < 2 and not any(wide)
    assert set(out.columns) == {*h.columns, "group_id", "weight"}
    once = G.associate(h, features(spark, d), S.groups(spark, d))
    assert once.count() > 100 and sorted(out.collect()) == sorted(once.collect())
    assert sorted(G.associate(h, features(spark, d), S.groups(spark, d), passes=1).collect()) == sorted(once.collect())
