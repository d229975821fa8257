"""Retention models and names drawn from them."""

from pyspark.sql import functions as F

from massloom.functions import ions
from massloom.functions import names as N
from massloom.operators import acquisition as A
from massloom.operators import retention as R
from massloom.plans import standin as S
from massloom.plans.catalog.groups import FEAT, features
from massloom.plans.registry import query

RT2 = "5e0 + 0.15e0 * carbons - 0.30e0 * double_bonds + ((p_partkey * 31) % 101) / 1000e0"


def series_groups(spark, d):
    """Named groups whose retention follows carbons and double bonds."""
    return S.groups(spark, d).withColumn("rt", F.expr(RT2)).withColumn("n_features", F.lit(20)).withColumn("keep", F.lit(True)).withColumn(
        "max_area", F.col("p_partkey").cast("double"))


FIT = f"""{S.cte('groups')}, p AS (SELECT study_id, polarity, lipid_class, cast(carbons AS double) AS c, cast(double_bonds AS double) AS d, {RT2} AS y FROM groups WHERE name IS NOT NULL),
q AS (SELECT study_id, polarity, lipid_class, count(*) AS n, avg(c) AS mc, avg(d) AS md, avg(y) AS my, covar_pop(c, c) AS cc, covar_pop(d, d) AS dd, covar_pop(y, y) AS yy,
  covar_pop(c, d) AS cd, covar_pop(c, y) AS cy, covar_pop(d, y) AS dy, max(y) - min(y) AS span, count(DISTINCT c) AS lv FROM p GROUP BY ALL HAVING count(*) >= 8 AND count(DISTINCT c) >= 3),
b AS (SELECT *, (cy * dd - dy * cd) / (cc * dd - cd * cd) AS b1, (dy * cc - cy * cd) / (cc * dd - cd * cd) AS b2 FROM q WHERE cc * dd - cd * cd > 1e-12)"""


@query("f4_class_selectivity", f"""WITH {FIT} SELECT study_id, polarity, lipid_class, n, round(my - b1 * mc - b2 * md, 6) AS intercept, round(b1, 6) AS per_carbon, round(b2, 6) AS per_db,
  round((b1 * cy + b2 * dy) / yy, 6) AS r2, round(span, 6) AS span FROM b""")
def f4(spark, d):
    g = series_groups(spark, d).filter("name IS NOT NULL")
    out = R.class_selectivity(g)
    for c in ("intercept", "per_carbon", "per_db", "r2", "span"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query("f1_rt_models")
def f1(spark, d):
    out = R.fit_rt_models(series_groups(spark, d))
    for c in ("intercept", "per_carbon", "per_db", "r2", "residual_sd"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query("f2_rt_model_filter")
def f2(spark, d):
    g = series_groups(spark, d).withColumn("rt", F.when(F.col("p_partkey") % 50 == 0, F.col("rt") + 4.0).otherwise(F.col("rt")))
    out = R.rt_model_filter(g, R.fit_rt_models(g))
    return out.withColumn("rt_error", F.round("rt_error", 6)).withColumn("rt_z", F.round("rt_z", 4)).withColumn("rt_r2", F.round("rt_r2", 6))


@query("j16_extend_identifications")
def j16(spark, d):
    g = series_groups(spark, d)
    models = R.fit_rt_models(g)
    hidden = g.withColumn("name", F.when(F.col("m") < 4, F.col("name")))
    cand = g.filter("name IS NOT NULL AND m >= 4").selectExpr("name AS cand_name", "mz AS cand_mz", "polarity", "adduct AS cand_adduct").distinct()
    return R.extend_identifications(hidden, models, cand)


def fa_groups(spark, d):
    """Groups moved onto the fatty-acid grid, retention rising with carbons."""
    g = S.groups(spark, d).withColumn("polarity", F.lit("-")).withColumn("k", F.expr("cast(p_partkey % 17 AS int)"))
    return g.selectExpr("study_id", "polarity", "group_id", "cast(null AS string) AS name", "true AS keep", "cast(p_partkey AS double) AS max_area", "5 AS n_features",
                        f"(14 + k) * 12e0 + 2 * (14 + k) * {ions.FA_HYDROGEN} + 2 * {ions.FA_OXYGEN} - {ions.FA_PROTON} + if(k % 2 = 0, -2 * {ions.FA_HYDROGEN}, 0e0) + (p_partkey % 7) * 0.001e0 AS mz",
                        "4e0 + 0.5e0 * k + if(k % 2 = 0, -0.6e0, 0e0) + (p_partkey % 5) * 0.01e0 + if(p_partkey % 41 = 0, 6e0, 0e0) AS rt")


@query("j17_fatty_acid_names")
def j17(spark, d):
    return R.annotate_fatty_acids(fa_groups(spark, d), ions.fatty_acid_grid(spark)).withColumn("rt_error", F.round("rt_error", 6))


@query("f3_fit_series")
def f3(spark, d):
    p = fa_groups(spark, d).withColumn("k", F.expr("cast(max_area % 17 AS int)")).selectExpr(
        "study_id", "polarity", "14 + k AS carbons", "if(k % 2 = 0, 1, 0) AS double_bonds", "rt")
    out = R.fit_series(p.groupBy("study_id", "polarity", "carbons", "double_bonds").agg(F.min("rt").alias("rt")))
    for c in ("intercept", "per_carbon", "per_db", "per_c2", "r2", "residual_sd"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query("w6_rt_correction")
def w6(spark, d):
    out = R.rt_correction(features(spark, d))
    return out.withColumn("knot_rt", F.round("knot_rt", 6)).withColumn("shift", F.round("shift", 6))


@query("w6_as_of_lookup", f"""WITH {FEAT}, k AS (SELECT study_id, polarity, injection, rt_aligned AS t, rt_measured - rt_aligned AS s FROM ft),
q AS (SELECT study_id, polarity, injection, group_id, rt_measured AS rt FROM ft),
j AS (SELECT q.*, (SELECT min((t, s)) FROM k WHERE k.study_id = q.study_id AND k.polarity = q.polarity AND k.injection = q.injection AND k.t > q.rt) AS nx FROM q)
SELECT study_id, polarity, injection, group_id, round(CASE WHEN nx IS NULL THEN 0 ELSE rt - nx[2] END, 8) AS corrected_rt FROM j""")
def w6b(spark, d):
    f = features(spark, d)
    knots = f.selectExpr("study_id", "polarity", "injection", "rt_aligned AS knot_rt", "rt_measured - rt_aligned AS shift")
    out = R.corrected_rt(f.selectExpr("study_id", "polarity", "injection", "group_id", "rt_measured AS rt"), knots)
    return out.select("study_id", "polarity", "injection", "group_id", F.round("corrected_rt", 8).alias("corrected_rt"))


#: Families of eight groups, a CH2 apart and later at each step; families sit a thousandth of a mass unit apart, every seventh lacks a rung.
LADDER_GROUPS = """SELECT study_id, polarity, group_id, cast(null AS string) AS name, NOT (floor(group_id / 8) % 7 = 0 AND group_id % 8 = 3) AS keep, 12 AS n_features, cast((group_id * 7919) % 10007 AS double) AS max_area,
  250e0 + (cast(floor(group_id / 8) AS bigint) * 7919 % 14009) / 1000e0 + (group_id % 8) * 14.01565e0 AS mz, 2e0 + (group_id % 8) * 0.4e0 + (group_id % 13) * 0.01e0 AS rt
FROM (SELECT CASE WHEN floor(group_id / 8) % 4 < 2 THEN 'A' ELSE 'B' END AS study_id, CASE WHEN floor(group_id / 8) % 2 = 0 THEN '+' ELSE '-' END AS polarity, group_id FROM {groups}) x"""


@query("w9_unclaimed_series", f"""WITH RECURSIVE {S.cte('groups')}, f AS (SELECT * FROM ({LADDER_GROUPS.format(groups='groups')}) z WHERE keep),
nx AS (SELECT l.study_id, l.polarity, l.group_id AS low, arg_max(h.group_id, (h.max_area, -h.group_id)) AS high FROM f l JOIN f h ON h.study_id = l.study_id AND h.polarity = l.polarity AND abs(l.mz + {A.CH2} - h.mz) <= 0.01 AND h.rt > l.rt GROUP BY ALL),
p(study_id, polarity, series, rung, group_id) AS (SELECT study_id, polarity, group_id, 0, group_id FROM f UNION ALL SELECT p.study_id, p.polarity, series, rung + 1, high FROM p JOIN nx ON nx.study_id = p.study_id AND nx.polarity = p.polarity AND nx.low = p.group_id),
m AS (SELECT p.*, f.mz, f.rt, f.max_area AS area FROM p JOIN f USING (study_id, polarity, group_id)),
st AS (SELECT study_id, polarity, series, (arg_max(rt, rung) - arg_min(rt, rung)) / (count(*) - 1) AS mean_step, arg_min(area, rung) AS a0 FROM m GROUP BY ALL HAVING count(*) >= 4),
g AS (SELECT m.*, mean_step, a0 FROM m JOIN st USING (study_id, polarity, series) WHERE mean_step BETWEEN 0.05 AND 3),
c AS (SELECT * FROM g x WHERE NOT EXISTS (SELECT 1 FROM g y WHERE y.study_id = x.study_id AND y.polarity = x.polarity AND y.group_id = x.series AND y.rung > 0 AND (y.a0 > x.a0 OR (y.a0 = x.a0 AND y.series < x.series))))
SELECT study_id, polarity, series, cast(rung + 1 AS int) AS member, group_id, round(mz, 5) AS mz, round(rt, 5) AS rt, area, round(mean_step, 6) AS mean_step FROM c""")
def w9(spark, d):
    g = spark.sql(LADDER_GROUPS, groups=S.groups(spark, d))
    out = R.unclaimed_series(g, tol=0.01)
    return out.withColumn("mz", F.round("mz", 5)).withColumn("rt", F.round("rt", 5)).withColumn("mean_step", F.round("mean_step", 6))


DIM = f"""{S.cte('groups')}, nm AS (SELECT DISTINCT name || ' ' || adduct || ';' AS fullname, name AS body, adduct, lipid_class FROM groups WHERE name IS NOT NULL)"""
from massloom.plans.catalog.qc import SUMNAME  # noqa: E402


@query("p3_p8_lipid_dimension", f"""WITH {DIM}, s AS (SELECT fullname AS name, body, adduct, lipid_class, {SUMNAME.replace('name', 'body')} AS sum_name FROM nm)
SELECT name, body AS lipid_name, adduct, right(adduct, 1) AS sign, CASE WHEN adduct LIKE '%]+' THEN '+' ELSE '-' END AS polarity_by_name, lipid_class,
  CASE lipid_class WHEN 'GlcCer[NS]' THEN 'HexCer[NS]' ELSE lipid_class END AS canonical_class, sum_name, '' AS prefix,
  cast(regexp_extract(sum_name, ' (\\d+):(\\d+)$', 1) AS int) AS carbons, cast(regexp_extract(sum_name, ' (\\d+):(\\d+)$', 2) AS int) AS double_bonds,
  lipid_class || '|' || array_to_string(list_sort(string_split(split_part(body, ' ', 2), '_')), '_') AS chain_key,
  replace(sum_name, ' ', '|') AS sum_key,
  CASE lipid_class WHEN 'Cer[NS]' THEN 'Cer' WHEN 'GlcCer[NS]' THEN 'HexCer' ELSE lipid_class END || ' ' || split_part(body, ' ', 2) AS shorthand,
  CASE WHEN lipid_class IN ('PC', 'PE') THEN 'Glycerophospholipids' WHEN lipid_class = 'TG' THEN 'Glycerolipids' ELSE 'Sphingolipids' END AS category FROM s""")
def p3(spark, d):
    n = S.groups(spark, d).filter("name IS NOT NULL").select(F.concat("name", F.lit(" "), "adduct", F.lit(";")).alias("name"))
    return N.lipid_dimension(n).drop("keys")


@query("p20_comparison_keys", f"""WITH {DIM}, s AS (SELECT DISTINCT body, lipid_class, {SUMNAME.replace('name', 'body')} AS sum_name FROM nm)
SELECT body AS name, CASE WHEN body LIKE '%\\_%' ESCAPE '\\' THEN replace(lipid_class, 'GlcCer', 'HexCer') || ' ' || array_to_string(list_sort(string_split(split_part(body, ' ', 2), '_')), '_') ELSE '' END AS molecular,
  replace(sum_name, 'GlcCer', 'HexCer') AS species, upper(lipid_class) || '|' || split_part(sum_name, ' ', 2) AS composition FROM s""")
def p20(spark, d):
    n = S.groups(spark, d).filter("name IS NOT NULL").select("name").distinct()
    k = N.comparison_keys(F.col("name"))
    return n.select("name", k["molecular"].alias("molecular"), k["species"].alias("species"), N.composition_key(F.col("name")).alias("composition"))


@query("p20_family_keys", f"""WITH {DIM}, s AS (SELECT DISTINCT {SUMNAME.replace('name', 'body')} AS name, lipid_class FROM nm)
SELECT name, CASE lipid_class WHEN 'Cer[NS]' THEN 'Cer' WHEN 'GlcCer[NS]' THEN 'HexCer' ELSE lipid_class END AS family, '' AS kind,
  cast(regexp_extract(name, ' (\\d+):(\\d+)$', 1) AS int) AS carbons, cast(regexp_extract(name, ' (\\d+):(\\d+)$', 2) AS int) AS double_bonds FROM s""")
def p20f(spark, d):
    n = S.groups(spark, d).filter("name IS NOT NULL").select(N.sum_composition(F.col("name")).alias("name")).distinct()
    return n.withColumn("k", N.family_key(F.col("name"))).select("name", "k.*")


@query("p9_p12_ion_masses", f"""WITH {S.cte('groups')}, i AS (SELECT DISTINCT carbons AS c, double_bonds AS db FROM groups),
m AS (SELECT c, db, 'C' || c::varchar || 'H' || (2 * c - 2 * db)::varchar || 'O2' AS formula, c * 12.0e0 + (2 * c - 2 * db) * 1.007825035e0 + 2 * 15.99491463e0 AS mass FROM i)
SELECT formula, round(mass, 5) AS mass, mass - floor(mass) <= 0.00115e0 * mass + 0.03e0 AS plausible, round(60000e0 * sqrt(200 / mass), 4) AS power, round(mass / (60000e0 * sqrt(200 / mass)), 9) AS width FROM m""")
def p9(spark, d):
    i = S.groups(spark, d).selectExpr("concat('C', carbons, 'H', 2 * carbons - 2 * double_bonds, 'O2') AS formula").distinct()
    m = ions.formula_mass(F.col("formula"))
    i = i.withColumn("m", m)
    return i.select("formula", F.round("m", 5).alias("mass"), ions.plausible_mass(F.col("m")).alias("plausible"),
                    F.round(ions.resolving_power(F.col("m"), 60000), 4).alias("power"), F.round(ions.peak_width(F.col("m"), 60000), 9).alias("width"))
