"""Area-table filters and normalisation."""

from pyspark.sql import functions as F

from massloom.functions import roles
from massloom.operators import matrix as M
from massloom.plans import standin as S
from massloom.plans.registry import query

VIEWS = S.cte("areas", "injections")
CELLS = f"""{VIEWS},
cells AS (SELECT a.*, i.role, i.run_order, i.grp FROM areas a JOIN injections i
  USING (study_id, polarity, injection) WHERE a.area > 0),
nrole AS (SELECT study_id, polarity, count_if(role = 'sample') AS n_sample,
  count_if(role = 'blank') AS n_blank, count_if(role = 'qc') AS n_qc FROM injections GROUP BY ALL)"""


@query("p11_roles", f"""WITH {VIEWS} SELECT study_id, polarity, injection, role, run_order FROM injections""")
def p11(spark, d):
    i = S.injections(spark, d)
    return i.select("study_id", "polarity", "injection", roles.infer_role(F.col("injection")).alias("role"), "run_order")


@query("a9_pooled_cv", f"""WITH {CELLS}
SELECT study_id, polarity, group_id, count(*) AS n_pools,
  round(100 * stddev_samp(area) / avg(area), 6) AS pooled_cv
FROM cells WHERE role = 'qc' GROUP BY ALL HAVING count(*) >= 3""")
def a9(spark, d):
    out = M.pooled_cv(S.areas(spark, d), S.injections(spark, d))
    return out.withColumn("pooled_cv", F.round("pooled_cv", 6))


A13_SQL = f"""{CELLS},
lv AS (SELECT study_id, polarity, group_id, count_if(role = 'sample') AS detected,
    sum(CASE WHEN role = 'sample' THEN area ELSE 0 END) AS s, sum(CASE WHEN role = 'blank' THEN area ELSE 0 END) AS bl
  FROM cells GROUP BY ALL),
blank AS (SELECT g.study_id, g.polarity, g.group_id, coalesce(detected, 0) AS detected,
    coalesce(s, 0) / n_sample AS sample_level, coalesce(bl, 0) / n_blank AS blank_level,
    coalesce(detected, 0) >= 2 AND (coalesce(bl, 0) <= 0
      OR coalesce(s, 0) / n_sample >= 3.0e0 * (coalesce(bl, 0) / n_blank)) AS blank_pass
  FROM groups g LEFT JOIN lv USING (study_id, polarity, group_id) JOIN nrole USING (study_id, polarity))"""


@query("a13_blank_filter", f"WITH {A13_SQL} SELECT * FROM blank")
def a13(spark, d):
    out = M.blank_filter(S.groups(spark, d).select(*M.GROUP), S.areas(spark, d), S.injections(spark, d), multiplier=3.0)
    return out


A16_SQL = f"""csize AS (SELECT study_id, polarity, role, grp, count(*) AS n FROM injections
  WHERE role NOT IN ('blank', 'standard') GROUP BY ALL),
best AS (SELECT c.study_id, c.polarity, c.group_id, max(k) AS best_fraction FROM
   (SELECT study_id, polarity, group_id, role, grp, count(*) / any_value(n) AS k
    FROM cells JOIN csize USING (study_id, polarity, role, grp) WHERE n >= 3 GROUP BY ALL) c GROUP BY ALL)"""


@query("a16_presence", f"""WITH {CELLS}, {A16_SQL.replace('role, grp, count', "'c' AS role, grp, count").replace(
    'study_id, polarity, role, grp)', 'study_id, polarity, grp)')}
SELECT g.study_id, g.polarity, g.group_id, coalesce(best_fraction, 0) AS best_fraction,
  coalesce(best_fraction, 0) >= 0.6 - 1e-9 AS presence_pass
FROM groups g LEFT JOIN best USING (study_id, polarity, group_id)""" .replace(
    "FROM cells JOIN csize", "FROM (SELECT * FROM cells WHERE role NOT IN ('blank', 'standard')) JOIN csize"))
def a16(spark, d):
    return M.presence_filter(S.groups(spark, d).select(*M.GROUP), S.areas(spark, d), S.injections(spark, d), by=("grp",))


@query("flagship_filtered_areas", f"""WITH {A13_SQL},
pres AS (SELECT c.study_id, c.polarity, c.group_id, max(k) AS bf FROM (
    SELECT x.study_id, x.polarity, x.group_id, x.role, count(*) / any_value(n) AS k FROM cells x
    JOIN (SELECT study_id, polarity, role, count(*) AS n FROM injections GROUP BY ALL) z
    USING (study_id, polarity, role) WHERE x.role IN ('sample', 'qc') GROUP BY ALL) c GROUP BY ALL),
cv AS (SELECT study_id, polarity, group_id, 100 * stddev_samp(area) / avg(area) AS pooled_cv
  FROM cells WHERE role = 'qc' GROUP BY ALL HAVING count(*) >= 3)
SELECT g.study_id, g.polarity, g.group_id, g.name, round(g.mz, 6) AS mz, round(g.rt, 3) AS rt,
  round(cv.pooled_cv, 6) AS pooled_cv,
  CASE WHEN cv.pooled_cv IS NULL THEN '' WHEN cv.pooled_cv <= 20 THEN 'good' WHEN cv.pooled_cv <= 30 THEN 'acceptable'
    ELSE 'unreliable' END AS flag
FROM groups g JOIN blank b USING (study_id, polarity, group_id) JOIN pres p USING (study_id, polarity, group_id)
LEFT JOIN cv USING (study_id, polarity, group_id)
WHERE b.blank_pass AND p.bf >= 0.6 - 1e-9""")
def flagship(spark, d):
    """Blank filter, presence filter and pooled CV over one area table: the minimum useful slice."""
    g, a, i = S.groups(spark, d), S.areas(spark, d), S.injections(spark, d)
    kept = M.blank_filter(g, a, i, multiplier=3.0).filter("blank_pass").select(*g.columns)
    kept = M.presence_filter(kept, a, i).filter("presence_pass").select(*g.columns)
    out = kept.join(M.pooled_cv(a, i).select(*M.GROUP, "pooled_cv"), M.GROUP, "left")
    return out.select(*M.GROUP, "name", F.round("mz", 6).alias("mz"), F.round("rt", 3).alias("rt"),
                      F.round("pooled_cv", 6).alias("pooled_cv"), roles.qc_flag(F.col("pooled_cv")).alias("flag"))


FACTORS_SQL = f"""{CELLS},
inc AS (SELECT * FROM cells WHERE role IN ('sample', 'qc')),
need AS (SELECT study_id, polarity, count(*) AS n FROM injections WHERE role IN ('sample', 'qc') GROUP BY ALL),
complete AS (SELECT study_id, polarity, group_id FROM inc JOIN need USING (study_id, polarity)
  GROUP BY ALL HAVING count(*) = any_value(n)),
med AS (SELECT study_id, polarity, injection, median(area) AS med FROM inc
  SEMI JOIN complete USING (study_id, polarity, group_id) GROUP BY ALL),
fac AS (SELECT i.study_id, i.polarity, i.injection,
   coalesce(med / avg(med) OVER (PARTITION BY i.study_id, i.polarity), 1.0) AS factor
  FROM injections i LEFT JOIN med USING (study_id, polarity, injection) WHERE i.role IN ('sample', 'qc'))"""


@query("a10_median_factors", f"WITH {FACTORS_SQL} SELECT study_id, polarity, injection, round(factor, 9) AS factor FROM fac")
def a10(spark, d):
    return M.median_factors(S.areas(spark, d), S.injections(spark, d)).select(*M.INJ, F.round("factor", 9).alias("factor"))


@query("a11_recentre", f"""WITH {FACTORS_SQL},
m2 AS (SELECT study_id, polarity, injection, median(area / factor) AS med FROM cells
  JOIN fac USING (study_id, polarity, injection) GROUP BY ALL)
SELECT study_id, polarity, injection,
  round(CASE WHEN med > 0 THEN factor * med / avg(med) OVER (PARTITION BY study_id, polarity) ELSE factor END, 9) AS factor
FROM fac LEFT JOIN m2 USING (study_id, polarity, injection)""")
def a11(spark, d):
    a = S.areas(spark, d)
    f = M.recentre(a, M.median_factors(a, S.injections(spark, d)))
    return f.select(*M.INJ, F.round("factor", 9).alias("factor"))


@query("a12_median_normalise", f"""WITH {VIEWS},
m AS (SELECT study_id, polarity, injection, median(area) AS med FROM areas WHERE area > 0 GROUP BY ALL)
SELECT study_id, polarity, group_id, injection, round(area / med, 9) AS area FROM areas JOIN m USING (study_id, polarity, injection)""")
def a12(spark, d):
    return M.median_normalise(S.areas(spark, d)).withColumn("area", F.round("area", 9))


@query("a14_carryover", f"""WITH {CELLS},
sm AS (SELECT study_id, polarity, group_id, sum(CASE WHEN role = 'sample' THEN area ELSE 0 END) AS s FROM cells GROUP BY ALL),
bl AS (SELECT c.*, s / n_sample AS sample_mean FROM cells c JOIN sm USING (study_id, polarity, group_id)
  JOIN nrole USING (study_id, polarity) WHERE role = 'blank')
SELECT study_id, polarity, injection, run_order, count(*) AS features, cast(sum(area) AS bigint) AS total,
  round(sum(CASE WHEN sample_mean > area THEN area ELSE 0 END) / sum(area), 9) AS shared FROM bl GROUP BY ALL""")
def a14(spark, d):
    return M.carryover(S.areas(spark, d), S.injections(spark, d)).withColumn("shared", F.round("shared", 9))


@query("a15_blank_ratio", f"""WITH {CELLS},
lv AS (SELECT study_id, polarity, group_id, sum(CASE WHEN role = 'sample' THEN area ELSE 0 END) AS s,
   sum(CASE WHEN role = 'blank' THEN area ELSE 0 END) AS bl FROM cells GROUP BY ALL),
r AS (SELECT l.study_id, l.polarity, (s / n_sample) / (bl / n_blank) AS ratio, g.name IS NOT NULL AS named
  FROM lv l JOIN nrole USING (study_id, polarity) JOIN groups g USING (study_id, polarity, group_id) WHERE s > 0 AND bl > 0)
SELECT study_id, polarity, count(*) AS features, round(avg(CASE WHEN ratio < 3 THEN 1 ELSE 0 END), 9) AS below,
  round(avg(CASE WHEN named THEN CASE WHEN ratio < 3 THEN 1 ELSE 0 END END), 9) AS below_identified,
  round(median(ratio), 6) AS median_ratio, round(median(log10(ratio)), 6) AS median_log_ratio FROM r GROUP BY ALL""")
def a15(spark, d):
    out = M.blank_ratio(S.groups(spark, d), S.areas(spark, d), S.injections(spark, d))
    return out.select(*M.RUN, "features", F.round("below", 9).alias("below"),
                      F.round("below_identified", 9).alias("below_identified"),
                      F.round("median_ratio", 6).alias("median_ratio"),
                      F.round("median_log_ratio", 6).alias("median_log_ratio"))


@query("a41_normalised_totals", f"""WITH {CELLS},
t AS (SELECT study_id, polarity, injection, role, run_order, cast(sum(area) AS bigint) AS total FROM cells GROUP BY ALL),
r AS (SELECT *, total / median(total) OVER (PARTITION BY study_id, polarity, role) AS rel FROM t),
s AS (SELECT study_id, polarity, role, regr_slope(rel, run_order) * (max(run_order) - min(run_order)) AS trend FROM r GROUP BY ALL)
SELECT r.study_id, r.polarity, injection, r.role, run_order, total, round(rel, 9) AS relative, round(trend, 6) AS trend
FROM r JOIN s USING (study_id, polarity, role)""")
def a41(spark, d):
    out = M.normalised_totals(S.areas(spark, d), S.injections(spark, d))
    return out.withColumn("relative", F.round("relative", 9)).withColumn("trend", F.round("trend", 6))


@query("a39_gap_fill_rate", f"""WITH {CELLS},
b AS (SELECT study_id, polarity, group_id FROM groups), ns AS (SELECT study_id, polarity, n_sample FROM nrole),
t AS (SELECT study_id, polarity, count(*) AS r, any_value(n_sample) AS n FROM b JOIN ns USING (study_id, polarity) GROUP BY ALL),
w AS (SELECT study_id, polarity, count(*) AS was FROM cells WHERE role = 'sample' AND area % 7 <> 0 GROUP BY ALL),
f AS (SELECT study_id, polarity, count(*) AS now FROM cells WHERE role = 'sample' GROUP BY ALL),
g AS (SELECT study_id, polarity, count(DISTINCT group_id) AS r FROM areas GROUP BY ALL)
SELECT study_id, polarity, g.r * n AS cells, g.r * n - was AS gaps, now - was AS filled, g.r * n - now AS left_open
FROM t JOIN g USING (study_id, polarity) JOIN w USING (study_id, polarity) JOIN f USING (study_id, polarity)""")
def a39(spark, d):
    a = S.areas(spark, d)
    return M.gap_fill_rate(a.filter("area % 7 <> 0"), a, S.injections(spark, d))


@query("k1_result_matrix", f"""WITH {VIEWS},
p AS (PIVOT (SELECT study_id, polarity, group_id, injection, area FROM areas) ON injection IN
   ('S_05', 'S_06', 'QC_02', 'QC_07', 'Blank_00') USING first(area))
SELECT g.study_id, g.polarity, g.group_id, g.name, coalesce("S_05", 0) AS S_05, coalesce("S_06", 0) AS S_06,
  coalesce("QC_02", 0) AS QC_02, coalesce("QC_07", 0) AS QC_07, coalesce("Blank_00", 0) AS Blank_00
FROM groups g LEFT JOIN p USING (study_id, polarity, group_id)""")
def k1(spark, d):
    wanted = ["S_05", "S_06", "QC_02", "QC_07", "Blank_00"]
    return M.wide_matrix(S.groups(spark, d).select(*M.GROUP, "name"), S.areas(spark, d), wanted)


@query("a40_named_only_in_pools", f"""WITH {S.cte('injections', 'scans')}
SELECT s.study_id, s.polarity, name, count(*) AS spectra FROM
  (SELECT *, 'L' || cast(cast(floor(precursor_mz * 2) AS bigint) AS string) AS name FROM scans WHERE identified) s
  JOIN injections i USING (study_id, polarity, injection) GROUP BY ALL HAVING bool_and(role = 'qc')""")
def a40(spark, d):
    hits = S.scans(spark, d).filter("identified").withColumn(
        "name", F.concat(F.lit("L"), F.floor(F.col("precursor_mz") * 2).cast("string")))
    return M.named_only_in_pools(hits, S.injections(spark, d))
