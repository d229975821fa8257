"""Result tables and method lists as they are written."""

from pyspark.sql import functions as F

from massloom.operators.series import assign_series
from massloom.plans import standin as S
from massloom.plans.catalog.acquisition import WASTED, j22, series_sql, wasted
from massloom.plans.catalog.qc import verdicts
from massloom.plans.catalog.scans import sized
from massloom.plans.registry import ORACLES, query
from massloom.sources import sinks as K


def table(spark, d, kind):
    v = verdicts(spark, d).filter("reason <> ''").withColumn("stage", F.lit(1))
    g = sized(spark, d).withColumn("source", F.lit("MS2"))
    return K.result_rows(g, S.areas(spark, d), S.injections(spark, d), v, kind, ("blank", "standard"))


TABLE = f"""{S.cte('areas', 'injections')}, kept AS (SELECT * FROM groups WHERE m NOT IN (1, 2, 3)),
inj AS (SELECT * FROM injections WHERE role IN ('sample', 'qc')), c AS (SELECT a.*, i.role FROM areas a JOIN inj i USING (study_id, polarity, injection) SEMI JOIN kept USING (study_id, polarity, group_id)),
cv AS (SELECT study_id, polarity, group_id, 100 * stddev_samp(area) / avg(area) AS cv FROM c WHERE role = 'qc' AND area > 0 GROUP BY ALL HAVING count(*) >= 3)"""


@query("k1_final_rows", f"""WITH {TABLE} SELECT study_id, polarity, group_id, name, round(cv, 6) AS pooled_cv FROM kept LEFT JOIN cv USING (study_id, polarity, group_id)""")
def k1_final(spark, d):
    rows, _ = table(spark, d, "final")
    return rows.select("study_id", "polarity", "group_id", "name", F.round("pooled_cv", 6).alias("pooled_cv"))


@query("k1_normalised_areas", f"""WITH {TABLE}, nm AS (SELECT * FROM kept WHERE name IS NOT NULL), n AS (SELECT c.* FROM c SEMI JOIN nm USING (study_id, polarity, group_id)),
need AS (SELECT study_id, polarity, count(*) AS n FROM inj GROUP BY ALL), cp AS (SELECT study_id, polarity, group_id FROM n JOIN need USING (study_id, polarity) GROUP BY ALL HAVING count(*) = any_value(need.n)),
m1 AS (SELECT study_id, polarity, injection, median(area) AS md FROM n SEMI JOIN cp USING (study_id, polarity, group_id) GROUP BY ALL),
f1 AS (SELECT i.study_id, i.polarity, i.injection, coalesce(md / avg(md) OVER (PARTITION BY i.study_id, i.polarity), 1.0) AS f FROM inj i LEFT JOIN m1 USING (study_id, polarity, injection)),
m2 AS (SELECT study_id, polarity, injection, median(area / f) AS md FROM n JOIN f1 USING (study_id, polarity, injection) GROUP BY ALL),
f2 AS (SELECT study_id, polarity, injection, f * md / avg(md) OVER (PARTITION BY study_id, polarity) AS f FROM f1 JOIN m2 USING (study_id, polarity, injection))
SELECT study_id, polarity, group_id, injection, round(area / f / 1e9, 6) AS area FROM n JOIN f2 USING (study_id, polarity, injection)""")
def k1_norm(spark, d):
    _, cells = table(spark, d, "normalised")
    return cells.select("study_id", "polarity", "group_id", "injection", F.round(F.col("area") / 1e9, 6).alias("area"))


@query("k4_exclusion_list", f"""WITH {WASTED} SELECT study_id, polarity, printf('%.4f', mz) AS mass, scans AS wasted, CASE WHEN in_blank THEN 'yes' ELSE 'no' END AS in_blank FROM w""")
def k4(spark, d):
    out = K.exclusion_review(wasted(spark, d, False).withColumn("series", F.lit("")))
    return out.select("study_id", "polarity", F.col("`m/z`").alias("mass"), F.col("MS2 scans wasted").alias("wasted"), F.col("In blank").alias("in_blank"))


@query("k4_exclusion_instrument", f"""WITH RECURSIVE {WASTED}, grid AS (SELECT study_id, polarity, round(mz, 6) AS mz, scans FROM w), {series_sql('grid')}
SELECT study_id, polarity AS run_polarity, printf('%.4f', mz) AS mass, '' AS formula, '' AS species, 1::int AS cs, CASE WHEN polarity = '+' THEN 'Positive' ELSE 'Negative' END AS polarity, '' AS start, '' AS "end", '' AS ce, '' AS msx,
  CASE WHEN series = '' THEN 'background, never identified' ELSE series || ' contamination' END || ' (' || scans::varchar || ' MS2)' AS comment FROM grid JOIN labelled USING (study_id, polarity, mz)""")
def k4i(spark, d):
    rows = assign_series(wasted(spark, d, False).withColumn("mz", F.round("mz", 6)))
    return K.exclusion_instrument(rows).toDF("study_id", "run_polarity", "mass", "formula", "species", "cs", "polarity", "start", "end", "ce", "msx", "comment")


@query("k5_inclusion_list", f"""WITH {S.cte('groups')} SELECT study_id, group_id_mz AS mass, start_min, end_min FROM (SELECT study_id, printf('%.4f', mz + 0.00002) AS group_id_mz, printf('%.2f', greatest(rt - 1.503, 0)) AS start_min, printf('%.2f', rt + 1.503) AS end_min FROM groups) z""")
def k5(spark, d):
    out = K.inclusion_instrument(S.groups(spark, d).withColumn("mz", F.col("mz") + 0.00002), 1.503).toDF("study_id", "run_polarity", "mass", "formula", "species", "cs", "polarity", "start_min", "end_min", "ce", "msx", "comment")
    return out.select("study_id", "mass", "start_min", "end_min")


PLACE = "row_number() OVER (PARTITION BY study_id, polarity ORDER BY {order}) AS place"


@query("o3_groups_by_retention", f"""WITH {S.cte('groups')} SELECT study_id, polarity, group_id, {PLACE.format(order='rt, group_id')} FROM groups""")
def o3_groups(spark, d):
    return K.in_order(S.groups(spark, d), "groups").select("study_id", "polarity", "group_id", "place")


@query("o3_wasted_by_scans", f"""WITH {WASTED} SELECT study_id, polarity, round(mz, 6) AS mz, scans, {PLACE.format(order='scans DESC, mz')} FROM w""")
def o3_wasted(spark, d):
    rows = K.in_order(wasted(spark, d, False), "wasted")
    return rows.select("study_id", "polarity", F.round("mz", 6).alias("mz"), "scans", "place")


@query("o3_inclusion_by_area", f"""SELECT study_id, polarity, group_id, max_area, {PLACE.format(order='max_area, group_id')} FROM ({ORACLES['j22_inclusion']}) z""")
def o3_inclusion(spark, d):
    return K.in_order(j22(spark, d), "inclusion").select("study_id", "polarity", "group_id", "max_area", "place")
