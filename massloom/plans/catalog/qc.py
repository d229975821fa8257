"""Run-quality statistics."""

from pyspark.sql import functions as F

from massloom.operators import qc as K
from massloom.operators import matrix as M
from massloom.plans import standin as S
from massloom.plans.catalog.matrix import CELLS
from massloom.plans.registry import ORACLES, query


def named_groups(spark, d):
    return S.groups(spark, d).withColumn("source", F.when(F.col("m") == 3, "RT model").otherwise("MS2"))


def r(df, places, *cols):
    for c in cols:
        df = df.withColumn(c, F.round(c, places))
    return df


NORM = f"""{CELLS},
med AS (SELECT study_id, polarity, injection, median(area) AS med FROM cells GROUP BY ALL),
nc AS (SELECT c.* EXCLUDE (area), c.area / med AS area FROM cells c JOIN med USING (study_id, polarity, injection)),
grid AS (SELECT g.study_id, g.polarity, g.group_id, i.injection, i.role, i.run_order, coalesce(n.area, 0) AS area
  FROM groups g JOIN injections i USING (study_id, polarity) LEFT JOIN nc n USING (study_id, polarity, group_id, injection))"""


@query("a21_precision", f"""WITH {NORM},
f AS (SELECT study_id, polarity, group_id, stddev_samp(CASE WHEN role = 'qc' THEN area END) AS psd, avg(CASE WHEN role = 'qc' THEN area END) AS pm,
   stddev_samp(CASE WHEN role = 'sample' THEN area END) AS ssd, avg(CASE WHEN role = 'sample' THEN area END) AS sm,
   min(CASE WHEN role = 'qc' THEN area END) AS pmin FROM grid GROUP BY ALL),
v AS (SELECT *, 100 * psd / pm AS pcv, CASE WHEN sm > 0 THEN 100 * ssd / sm END AS scv, CASE WHEN ssd > 0 THEN psd / ssd END AS dr FROM f WHERE pmin > 0)
SELECT study_id, polarity, true AS usable, count(*) AS features, round(median(pcv), 6) AS median_pool_cv, round(median(scv), 6) AS median_sample_cv,
  round(median(dr), 6) AS median_d_ratio, round(avg(CASE WHEN pcv < 20 THEN 1 ELSE 0 END), 9) AS under_20,
  round(avg(CASE WHEN pcv < 30 THEN 1 ELSE 0 END), 9) AS under_30,
  round(avg(CASE WHEN dr IS NOT NULL THEN CASE WHEN dr < 0.5 THEN 1 ELSE 0 END END), 9) AS d_under_half FROM v GROUP BY ALL""")
def a21(spark, d):
    out = K.precision(S.groups(spark, d), S.areas(spark, d), S.injections(spark, d))
    out = r(out, 6, "median_pool_cv", "median_sample_cv", "median_d_ratio")
    return r(out, 9, "under_20", "under_30", "d_under_half").drop("reason", "total_features")


SUMNAME = """CASE WHEN name LIKE '%\\_%' ESCAPE '\\' THEN split_part(name, ' ', 1) || ' ' || (
   cast(regexp_extract(name, ' (\\d+):(\\d+)_', 1) AS int) + cast(regexp_extract(name, '_(\\d+):(\\d+)$', 1) AS int))::varchar || ':' || (
   cast(regexp_extract(name, ' (\\d+):(\\d+)_', 2) AS int) + cast(regexp_extract(name, '_(\\d+):(\\d+)$', 2) AS int))::varchar ELSE name END"""


@query("a22_coverage", f"""WITH {S.cte('groups')}, s AS (SELECT *, {SUMNAME} AS sum_name FROM groups)
SELECT study_id, polarity, count(*) AS rows, count(name) AS identified, count(DISTINCT sum_name) AS molecules,
  count_if(name IS NOT NULL AND m <> 3) AS by_ms2, count_if(name IS NOT NULL AND m = 3) AS by_rt_model,
  median(CASE WHEN name IS NOT NULL THEN dot END) AS dot_median, count_if(name IS NOT NULL AND dot < 700) AS dot_low FROM s GROUP BY ALL""")
def a22(spark, d):
    return K.coverage(named_groups(spark, d))


@query("a22_class_coverage", f"""WITH {S.cte('groups')}, s AS (SELECT *, {SUMNAME} AS sum_name FROM groups WHERE name IS NOT NULL)
SELECT study_id, polarity, lipid_class, count(DISTINCT sum_name) AS molecules, count(*) AS rows FROM s
GROUP BY GROUPING SETS ((study_id, polarity, lipid_class), (study_id, polarity))""")
def a22c(spark, d):
    return K.class_coverage(S.groups(spark, d))


def rank_of(partition, value):
    return (f"(rank() OVER (PARTITION BY {partition} ORDER BY {value}) + "
            f"(count(*) OVER (PARTITION BY {partition}, {value}) - 1) / 2.0)")


MISS = f"""{CELLS},
ng AS (SELECT study_id, polarity, count(*) AS features FROM groups GROUP BY ALL),
seen AS (SELECT study_id, polarity, group_id, count(*) AS k, avg(area) AS ms FROM cells WHERE role = 'sample' GROUP BY ALL),
rw AS (SELECT g.study_id, g.polarity, g.group_id, name IS NOT NULL AS named, coalesce(k, 0) AS k, ms, n_sample AS n
  FROM groups g LEFT JOIN seen USING (study_id, polarity, group_id) JOIN nrole USING (study_id, polarity)),
inj AS (SELECT i.study_id, i.polarity, i.injection, i.run_order, i.grp, features, count(c.group_id) AS detected, coalesce(sum(c.area), 0) AS total,
   1 - count(c.group_id) / any_value(features) AS missing FROM injections i JOIN ng USING (study_id, polarity)
   LEFT JOIN cells c USING (study_id, polarity, injection) WHERE i.role = 'sample' GROUP BY ALL)"""


@query("a23_missingness", f"""WITH {MISS},
b AS (SELECT study_id, polarity, any_value(n) AS injections, count(*) AS features, 1 - avg(k / n) AS missing_all,
   1 - avg(CASE WHEN named THEN k / n END) AS missing_identified, count_if(k = n) AS complete_all, count_if(named AND k = n) AS complete_identified,
   count_if(named) AS identified, count_if(k / n < 0.25) AS sparse FROM rw GROUP BY ALL),
q AS (SELECT study_id, polarity, quantile_cont(ms, 0.25) AS q1, quantile_cont(ms, 0.75) AS q3 FROM rw WHERE ms > 0 GROUP BY ALL),
gap AS (SELECT study_id, polarity, avg(CASE WHEN ms <= q1 THEN 1 - k / n END) - avg(CASE WHEN ms >= q3 THEN 1 - k / n END) AS gap
  FROM rw JOIN q USING (study_id, polarity) WHERE ms > 0 GROUP BY ALL),
rk AS (SELECT *, {rank_of('study_id, polarity', 'run_order')} AS ro, {rank_of('study_id, polarity', 'missing')} AS rm,
   {rank_of('study_id, polarity', 'total')} AS rt FROM inj),
cr AS (SELECT study_id, polarity, corr(ro, rm) AS vs_order, corr(rt, rm) AS vs_loading FROM rk GROUP BY ALL),
pp AS (SELECT study_id, polarity, sum(detected) / sum(features) AS p FROM inj GROUP BY ALL),
ch AS (SELECT study_id, polarity, sum(pow(detected - features * p, 2) / (features * p) + pow(features - detected - features * (1 - p), 2) / (features * (1 - p))) AS chi2
  FROM inj JOIN pp USING (study_id, polarity) GROUP BY ALL)
SELECT study_id, polarity, injections, features, round(missing_all, 9) AS missing_all, round(missing_identified, 9) AS missing_identified,
  complete_all, complete_identified, identified, sparse, round(gap, 9) AS abundance_gap, round(vs_order, 9) AS vs_order,
  round(vs_loading, 9) AS vs_loading, round(chi2, 4) AS chi2,
  CASE WHEN gap > 0.15 THEN 'MNAR' WHEN abs(vs_order) > 0.5 THEN 'MAR' ELSE 'inconclusive' END AS mechanism
FROM b JOIN gap USING (study_id, polarity) JOIN cr USING (study_id, polarity) JOIN ch USING (study_id, polarity)""")
def a23(spark, d):
    out = K.missingness(S.groups(spark, d), S.areas(spark, d), S.injections(spark, d))
    out = r(out, 9, "missing_all", "missing_identified", "abundance_gap", "vs_order", "vs_loading")
    return r(out, 4, "chi2").drop("mcar_p", "usable", "reason")


@query("a23_injection_missingness", f"""WITH {MISS} SELECT study_id, polarity, injection, features, detected, cast(total AS bigint) AS total,
  round(missing, 9) AS missing FROM inj""")
def a23i(spark, d):
    out = K.injection_missingness(S.groups(spark, d), S.areas(spark, d), S.injections(spark, d))
    return r(out, 9, "missing").select(*M.INJ, "features", "detected", "total", "missing")


RANKTEST = """x AS (SELECT * FROM src),
xr AS (SELECT *, {rank} AS r FROM x),
tie AS (SELECT {keys}, sum(t * t * t - t) AS ties FROM (SELECT {keys}, {value}, count(*) AS t FROM x GROUP BY ALL) GROUP BY ALL),
lv AS (SELECT {keys}, level, sum(r) AS rs, count(*) AS n FROM xr GROUP BY ALL),
ag AS (SELECT {keys}, count(*) AS levels, sum(n) AS nn, sum(rs * rs / n) AS s, arg_min(rs, level) AS rs1, arg_min(n, level) AS n1 FROM lv GROUP BY ALL)"""


@query("a29_confounding", f"""WITH {S.cte('injections')}, src AS (
  SELECT study_id, polarity, 'grp' AS factor, grp AS level, run_order FROM injections WHERE role = 'sample'),
{RANKTEST.format(rank=rank_of('study_id, polarity, factor', 'run_order'), keys='study_id, polarity, factor', value='run_order')}
SELECT study_id, polarity, factor, levels, round(rs1 - n1 * (n1 + 1) / 2, 6) AS statistic FROM ag""")
def a29(spark, d):
    return r(K.confounding(S.injections(spark, d), ["grp"]), 6, "statistic").drop("p", "confounded")


@query("a29_missing_by_factor", f"""WITH {MISS}, src AS (SELECT study_id, polarity, 'grp' AS factor, grp AS level, missing FROM inj),
{RANKTEST.format(rank=rank_of('study_id, polarity, factor', 'missing'), keys='study_id, polarity, factor', value='missing')},
sp AS (SELECT study_id, polarity, max(m) - min(m) AS spread FROM (SELECT study_id, polarity, level, avg(missing) AS m FROM src GROUP BY ALL) GROUP BY ALL)
SELECT study_id, polarity, factor, levels, round(rs1 - n1 * (n1 + 1) / 2, 6) AS statistic, round(spread, 9) AS spread FROM ag JOIN sp USING (study_id, polarity)""")
def a29m(spark, d):
    out = K.missing_by_factor(S.groups(spark, d), S.areas(spark, d), S.injections(spark, d), ["grp"])
    return r(r(out, 6, "statistic"), 9, "spread").drop("p")


HITS = f"""{S.cte('scans', 'injections')}, hits AS (SELECT s.study_id, s.polarity, s.injection, i.run_order, (value - 250) / 50e0 + s.inj_id * 0.05e0 AS delta_ppm
  FROM scans s JOIN injections i USING (study_id, polarity, injection) WHERE i.role IN ('sample', 'qc')),
pi AS (SELECT study_id, polarity, injection, run_order, count(*) AS n, median(delta_ppm) AS median_ppm,
  quantile_cont(delta_ppm, 0.75) - quantile_cont(delta_ppm, 0.25) AS iqr_ppm FROM hits GROUP BY ALL HAVING count(*) >= 20)"""


def hits(spark, d):
    return S.scans(spark, d).selectExpr("*", "1 AS rank", "(value - 250) / 50e0 + inj_id * 0.05e0 AS delta_ppm")


@query("a24_injection_mass_accuracy", f"""WITH {HITS} SELECT study_id, polarity, injection, run_order, n, round(median_ppm, 9) AS median_ppm, round(iqr_ppm, 9) AS iqr_ppm FROM pi""")
def a24i(spark, d):
    return r(K.mass_accuracy(hits(spark, d), S.injections(spark, d))[0], 9, "median_ppm", "iqr_ppm")


@query("a24_run_mass_accuracy", f"""WITH {HITS}, k AS (SELECT *, {rank_of('study_id, polarity', 'run_order')} AS a, {rank_of('study_id, polarity', 'median_ppm')} AS b FROM pi)
SELECT study_id, polarity, round(median(median_ppm), 9) AS median_ppm, round(max(median_ppm) - min(median_ppm), 9) AS spread_ppm,
  cast(sum(n) AS bigint) AS n_matches, round(regr_slope(median_ppm, run_order) * (max(run_order) - min(run_order)), 6) AS drift_ppm,
  round(corr(a, b), 9) AS rho FROM k GROUP BY ALL HAVING count(*) >= 6""")
def a24(spark, d):
    out = K.mass_accuracy(hits(spark, d), S.injections(spark, d))[1].filter("rho IS NOT NULL")
    return r(r(out, 9, "median_ppm", "spread_ppm", "rho"), 6, "drift_ppm")


PAIRS = "p AS (SELECT g.study_id, g.polarity, g.group_id AS id_a, h.group_id AS id_b FROM groups g JOIN groups h ON h.b = g.b AND h.m = 1 AND g.m = 0)"
BOTH = f"""{CELLS}, {PAIRS},
xy AS (SELECT p.*, x.area AS x, y.area AS y FROM p JOIN cells x ON x.group_id = id_a AND x.role <> 'blank' JOIN cells y ON y.group_id = id_b AND y.injection = x.injection)"""


def pairs(spark, d):
    g = S.groups(spark, d)
    a = g.filter("m = 0").selectExpr("study_id", "polarity", "b", "group_id AS id_a")
    return a.join(g.filter("m = 1").selectExpr("b", "group_id AS id_b"), "b").drop("b")


@query("a30_pair_pearson", f"""WITH {BOTH} SELECT study_id, polarity, id_a, id_b, count(x) AS n_shared, CASE WHEN count(x) >= 5 THEN round(corr(x, y), 9) END AS r
FROM p LEFT JOIN xy USING (study_id, polarity, id_a, id_b) GROUP BY ALL""")
def a30p(spark, d):
    return r(K.pair_corr(pairs(spark, d), S.areas(spark, d), S.injections(spark, d)), 9, "r")


@query("a30_pair_spearman", f"""WITH {BOTH}, k AS (SELECT *, {rank_of('id_a, id_b', 'x')} AS rx, {rank_of('id_a, id_b', 'y')} AS ry FROM xy)
SELECT study_id, polarity, id_a, id_b, count(rx) AS n_shared, CASE WHEN count(rx) >= 8 THEN round(corr(rx, ry), 9) END AS r
FROM p LEFT JOIN k USING (study_id, polarity, id_a, id_b) GROUP BY ALL""")
def a30s(spark, d):
    return r(K.pair_corr(pairs(spark, d), S.areas(spark, d), S.injections(spark, d), 8, method="spearman"), 9, "r")


W10 = f"""{CELLS},
so AS (SELECT study_id, polarity, injection, run_order, row_number() OVER (PARTITION BY study_id, polarity ORDER BY run_order) AS pos,
  count(*) OVER (PARTITION BY study_id, polarity) AS n FROM injections WHERE role = 'sample'),
det AS (SELECT c.study_id, c.polarity, c.group_id FROM cells c JOIN so USING (study_id, polarity, injection) GROUP BY ALL HAVING count(*) >= 0.8 * any_value(n)),
gr AS (SELECT d.*, so.injection, so.run_order, so.pos, coalesce(a.area, 0) AS area FROM det d JOIN so USING (study_id, polarity)
  LEFT JOIN areas a USING (study_id, polarity, group_id, injection)),
k1 AS (SELECT *, {rank_of('study_id, polarity, group_id', 'run_order')} AS ro, {rank_of('study_id, polarity, group_id', 'area')} AS ra FROM gr),
k2 AS (SELECT *, {rank_of('study_id, polarity, group_id', 'run_order')} AS ro, {rank_of('study_id, polarity, group_id', 'area')} AS ra FROM gr WHERE pos > 6),
rho AS (SELECT study_id, polarity, group_id, coalesce(corr(ro, ra), 0) AS rho FROM k1 GROUP BY ALL),
rhol AS (SELECT study_id, polarity, group_id, coalesce(corr(ro, ra), 0) AS rho_late FROM k2 GROUP BY ALL),
ld AS (SELECT study_id, polarity, injection, run_order, sum(area) AS t FROM areas JOIN so USING (study_id, polarity, injection) GROUP BY ALL),
lr AS (SELECT *, {rank_of('study_id, polarity', 'run_order')} AS a, {rank_of('study_id, polarity', 't')} AS b FROM ld),
lrho AS (SELECT study_id, polarity, corr(a, b) AS loading_rho FROM lr GROUP BY ALL),
drift AS (SELECT study_id, polarity, count(*) AS tested, count_if(abs(rho) >= 0.5) AS drifting, count_if(abs(rho_late) >= 0.5) AS drifting_late,
   median(abs(rho)) AS mar FROM rho JOIN rhol USING (study_id, polarity, group_id) GROUP BY ALL)"""


@query("w10_run_order_drift", f"""WITH {W10} SELECT study_id, polarity, tested, drifting, drifting_late, round(mar, 9) AS median_abs_rho,
  round(loading_rho, 9) AS loading_rho FROM drift JOIN lrho USING (study_id, polarity)""")
def w10(spark, d):
    out = K.run_order_drift(S.areas(spark, d), S.injections(spark, d))
    return r(out, 9, "median_abs_rho", "loading_rho").drop("loading_rho_late")


@query("a31_pool_drift", f"""WITH {NORM},
po AS (SELECT study_id, polarity, injection, row_number() OVER (PARTITION BY study_id, polarity ORDER BY run_order) AS pos,
  count(*) OVER (PARTITION BY study_id, polarity) AS n FROM injections WHERE role = 'qc'),
v AS (SELECT c.study_id, c.polarity, c.group_id, c.area, pos, n, count(*) OVER (PARTITION BY c.study_id, c.polarity, c.group_id) AS k FROM nc c JOIN po USING (study_id, polarity, injection)),
f AS (SELECT *, {rank_of('study_id, polarity, group_id', 'area')} AS ra FROM v WHERE k = n),
p AS (SELECT study_id, polarity, group_id, coalesce(corr(pos, ra), 0) AS rho, log2(max(CASE WHEN pos = n THEN area END) / max(CASE WHEN pos = 1 THEN area END)) AS lf FROM f GROUP BY ALL)
SELECT study_id, polarity, count(*) AS features, round(median(abs(rho)), 9) AS median_abs_rho, round(median(abs(lf)), 9) AS median_abs_log_fold,
  count_if(round(abs(rho), 12) >= 0.6) AS systematic FROM p GROUP BY ALL""")
def a31(spark, d):
    out = K.pool_drift(S.areas(spark, d), S.injections(spark, d))
    return r(out, 9, "median_abs_rho", "median_abs_log_fold").select("study_id", "polarity", "features", "median_abs_rho", "median_abs_log_fold", "systematic")


PROFILE = f"""{NORM},
rf AS (SELECT study_id, polarity, group_id, median(area) AS ref FROM grid WHERE role = 'sample' GROUP BY ALL HAVING median(area) > 0),
pk AS (SELECT g.*, {rank_of('g.study_id, g.polarity, g.injection', 'ref')} AS rr, {rank_of('g.study_id, g.polarity, g.injection', 'g.area')} AS ra
  FROM grid g JOIN rf USING (study_id, polarity, group_id)),
pr AS (SELECT study_id, polarity, injection, role, coalesce(corr(rr, ra), 0) AS rho FROM pk GROUP BY ALL),
ps AS (SELECT *, round(rho, 12) < round(min(CASE WHEN role = 'sample' THEN rho END) OVER (PARTITION BY study_id, polarity), 12) AS below_sample_band FROM pr)"""


@query("a32_profile_screen", f"WITH {PROFILE} SELECT study_id, polarity, injection, role, round(rho, 9) AS rho, below_sample_band FROM ps")
def a32(spark, d):
    return r(K.profile_screen(S.areas(spark, d), S.injections(spark, d)), 9, "rho").drop("run_order")


@query("a34_verdict", f"""WITH p AS ({ORACLES['a21_precision']}), dr AS ({ORACLES['w10_run_order_drift']}), ps AS ({ORACLES['a32_profile_screen']}),
f AS (SELECT study_id, polarity, count_if(below_sample_band AND role <> 'blank') AS failed FROM ps GROUP BY ALL), j AS (SELECT *, CASE WHEN tested > 0 THEN drifting / tested ELSE 0 END AS share FROM p LEFT JOIN dr USING (study_id, polarity) LEFT JOIN f USING (study_id, polarity))
SELECT study_id, polarity, median_pool_cv, round(share, 6) AS drift_share, coalesce(failed, 0) AS failed, CASE WHEN NOT usable THEN 'cannot be assessed' WHEN median_pool_cv > 30 OR share > 0.3 OR failed > 0 THEN 'not fit' ELSE 'fit' END AS verdict FROM j""")
def a34(spark, d):
    g, a, i = S.groups(spark, d), S.areas(spark, d), S.injections(spark, d)
    out = K.verdict(K.precision(g, a, i), K.run_order_drift(a, i), K.profile_screen(a, i))
    return r(out, 6, "median_pool_cv", "drift_share")


@query("j30_annotation_ambiguity", f"""WITH {CELLS}, w AS (SELECT study_id, polarity, avg(fwhm) AS win FROM groups WHERE name IS NOT NULL GROUP BY ALL),
pr AS (SELECT a.study_id, a.polarity, a.group_id AS id_a, b.group_id AS id_b, a.name AS name_a, b.name AS name_b FROM groups a JOIN groups b USING (study_id, polarity)
  JOIN w USING (study_id, polarity) WHERE a.name IS NOT NULL AND b.name IS NOT NULL AND a.name <> b.name AND (a.rt, a.mz, a.group_id) < (b.rt, b.mz, b.group_id)
  AND abs(a.mz - b.mz) <= 40 AND abs(a.rt - b.rt) <= win)
SELECT study_id, polarity, id_a, id_b FROM pr""")
def j30(spark, d):
    out = K.annotation_ambiguity(S.groups(spark, d), S.areas(spark, d), S.injections(spark, d), mz_window=40.0)
    return out.select("study_id", "polarity", "id_a", "id_b")


@query("j30_repeated_names", f"""WITH {S.cte('groups')} SELECT study_id, polarity, name, count(*) AS rows, round(max(rt) - min(rt), 6) AS rt_spread
FROM groups WHERE name IS NOT NULL GROUP BY ALL HAVING count(*) > 1""")
def j30n(spark, d):
    return r(K.repeated_names(S.groups(spark, d)), 6, "rt_spread")


def verdicts(spark, d):
    return S.groups(spark, d).selectExpr(
        "study_id", "polarity", "group_id", "CASE m WHEN 1 THEN concat('Adduct pair: the [M+Na]+ of ', 'PC') WHEN 2 THEN 'M+1 isotope' "
        "WHEN 3 THEN concat('Split peak, merged into x at ', cast(b AS string)) ELSE '' END AS reason")


@query("a33_filter_activity", f"""WITH {S.cte('groups')} SELECT study_id, polarity, CASE m WHEN 1 THEN 'Adduct pair' WHEN 2 THEN 'M+1 isotope' ELSE 'Split peak' END AS reason,
  count(*) AS removed FROM groups WHERE m IN (1, 2, 3) GROUP BY ALL""")
def a33(spark, d):
    return K.filter_activity(verdicts(spark, d))


@query("a37_elution_points", f"""WITH {S.cte('areas')}, mx AS (SELECT group_id, max(area) AS max_area FROM areas GROUP BY ALL),
g AS (SELECT groups.*, coalesce(max_area, 0) AS max_area, {SUMNAME} AS sum_name FROM groups LEFT JOIN mx USING (group_id) WHERE name IS NOT NULL AND m NOT IN (1, 2, 3)),
k AS (SELECT *, row_number() OVER (PARTITION BY study_id, polarity, sum_name ORDER BY max_area DESC, group_id) AS rn FROM g)
SELECT study_id, polarity, sum_name, group_id, round(rt, 6) AS rt, CASE WHEN lipid_class IN ('PC', 'PE') THEN 'Glycerophospholipids'
  WHEN lipid_class = 'TG' THEN 'Glycerolipids' ELSE 'Sphingolipids' END AS category FROM k WHERE rn = 1""")
def a37(spark, d):
    mx = S.areas(spark, d).groupBy("group_id").agg(F.max("area").alias("max_area"))
    g = S.groups(spark, d).join(mx, "group_id", "left").na.fill(0, ["max_area"])
    g = g.join(verdicts(spark, d).select("group_id", "reason"), "group_id")
    return r(K.elution_points(g), 6, "rt")


@query("a42_corpus_summary", f"""WITH {S.cte('groups')}, g AS (SELECT study_id, CASE WHEN p_partkey % 11 = 0 THEN 'DECOY_ ' || name ELSE name END AS name FROM groups)
SELECT study_id, count(*) AS groups, count_if(name NOT LIKE 'DECOY%') AS identified, count_if(name LIKE 'DECOY%') AS decoys,
  round(count_if(name LIKE 'DECOY%') / count(name), 9) AS decoy_share FROM g GROUP BY ALL""")
def a42(spark, d):
    g = S.groups(spark, d).withColumn("name", F.when(F.col("p_partkey") % 11 == 0, F.concat(F.lit("DECOY_ "), "name")).otherwise(F.col("name")))
    return r(K.corpus_summary(g), 9, "decoy_share")


@query("f5_gram", f"""WITH {CELLS},
us AS (SELECT study_id, polarity, injection, role, row_number() OVER (PARTITION BY study_id, polarity ORDER BY run_order) - 1 AS pos FROM injections WHERE role IN ('sample', 'qc')),
ft AS (SELECT c.study_id, c.polarity, c.group_id FROM cells c JOIN nrole USING (study_id, polarity) WHERE role IN ('sample', 'qc') GROUP BY ALL
  HAVING count_if(role = 'sample') >= 0.5 * any_value(n_sample)),
x AS (SELECT f.*, u.pos, log10(coalesce(a.area, 0) + 1) AS x FROM ft f JOIN us u USING (study_id, polarity) LEFT JOIN areas a USING (study_id, polarity, group_id, injection)),
s AS (SELECT study_id, polarity, group_id, avg(x) AS mu, stddev_samp(x) AS sd FROM x GROUP BY ALL),
z AS (SELECT x.study_id, x.polarity, x.group_id, pos, (x - mu) / sqrt(sd) AS z FROM x JOIN s USING (study_id, polarity, group_id) WHERE sd > 1e-9)
SELECT p.study_id, p.polarity, cast(p.pos AS int) AS i, cast(q.pos AS int) AS j, round(sum(p.z * q.z), 6) AS dot, count(*) AS n_features
FROM z p JOIN z q USING (study_id, polarity, group_id) GROUP BY ALL""")
def f5g(spark, d):
    return r(K.gram(S.areas(spark, d), S.injections(spark, d)), 6, "dot").select("study_id", "polarity", "i", "j", "dot", "n_features")


@query("f5_score_space")
def f5(spark, d):
    s = K.score_space(K.gram(S.areas(spark, d), S.injections(spark, d)))
    return r(s, 6, "pc1", "pc2", "pc3", "explained1", "explained2", "t2", "robust_t2", "dmodx", "neighbour")


@query("f6_contrast")
def f6(spark, d):
    return r(K.contrast(K.score_space(K.gram(S.areas(spark, d), S.injections(spark, d)))), 6, "pool_spread", "sample_spread", "ratio")


@query("u4_outliers_in_both", f"""WITH {S.cte('injections')}, f AS (SELECT study_id, polarity, injection FROM injections WHERE
   CASE WHEN polarity = '+' THEN inj_id % 3 = 0 ELSE inj_id % 2 = 0 END)
SELECT study_id, injection AS sample FROM f WHERE polarity = '+' INTERSECT SELECT study_id, injection FROM f WHERE polarity = '-'""")
def u4(spark, d):
    from massloom.functions.roles import sample_key
    f = S.injections(spark, d).filter("CASE WHEN polarity = '+' THEN inj_id % 3 = 0 ELSE inj_id % 2 = 0 END")
    f = f.withColumn("injection", F.concat("injection", F.when(F.col("polarity") == "+", "_Pos").otherwise("_Neg")))
    return K.outliers_in_both(f, sample_key(F.col("injection")))
