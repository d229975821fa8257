"""Raw-scan jobs, calibration, standards."""

from pyspark.sql import functions as F

from massloom.operators import calibrate as C
from massloom.operators import scans as X
from massloom.operators.matrix import presence_cells
from massloom.plans import standin as S
from massloom.plans.catalog.acquisition import ms1
from massloom.plans.catalog.groups import FEAT, features
from massloom.plans.catalog.qc import HITS, hits
from massloom.plans.registry import query

#: Retention that a target is looked for at: ten places, whose windows of 1.2 minutes cover the gradient.
CENTRE = "(0.3e0 + {k} % 10 * 0.5e0)"
MS1 = f"""{S.cte('spectra')}, ms1 AS (SELECT {S.SCAN_INJECTION} AS injection, vec_id AS scan_no, {S.GRADIENT_RT} AS rt, mz, intensity FROM spectra_peaks),
tg AS (SELECT DISTINCT {S.SCAN_INJECTION} AS injection, k AS target_id, 100e0 + 10 * k + 0.004e0 AS t_mz, {CENTRE.format(k='k')} - 0.6e0 AS t_lo, {CENTRE.format(k='k')} + 0.6e0 AS t_hi FROM spectra_peaks)"""


def scan_injections(spark, d):
    return S.spectra(spark, d).selectExpr("'A' AS study_id", "'+' AS polarity", f"{S.SCAN_INJECTION} AS injection").distinct()


def targets(spark, d):
    centre = CENTRE.format(k="target_id")
    return scan_injections(spark, d).selectExpr("*", "explode(sequence(0, 63)) AS target_id").selectExpr(
        "*", "100e0 + 10 * target_id + 0.004e0 AS t_mz", f"{centre} AS centre", f"{centre} - 0.6e0 AS t_lo", f"{centre} + 0.6e0 AS t_hi")


@query("j19_xic", f"""WITH {MS1}, ax AS (SELECT DISTINCT injection, scan_no, rt FROM ms1),
s AS (SELECT t.injection, t.target_id, scan_no, sum(intensity) AS signal FROM ms1 m JOIN tg t ON m.injection = t.injection AND rt >= t_lo AND rt < t_hi
  AND mz >= t_mz - t_mz * 10e-6 AND mz < t_mz + t_mz * 10e-6 GROUP BY ALL)
SELECT t.injection, cast(t.target_id AS int) AS target_id, a.scan_no, round(coalesce(signal, 0), 6) AS signal FROM tg t JOIN ax a ON a.injection = t.injection AND a.rt >= t_lo AND a.rt < t_hi
LEFT JOIN s ON s.injection = t.injection AND s.target_id = t.target_id AND s.scan_no = a.scan_no""")
def j19(spark, d):
    return X.xic(ms1(spark, d), targets(spark, d)).select("injection", "target_id", "scan_no", F.round("signal", 6).alias("signal"))


def _peak_sql(source: str, half: str) -> str:
    """Apex and signal to noise of each (key) trace of ``source`` (key, rt, signal, centre): flank median and deviation, tallest core scan, run above the limit."""
    return f"""xs AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rt, signal) - 1 AS i, abs(rt - centre) <= {half} AS core FROM {source}),
fl AS (SELECT key, median(signal) FILTER (NOT core) AS base, count(*) FILTER (NOT core) AS n, count(*) AS size FROM xs GROUP BY ALL),
sg AS (SELECT key, base, n, size, median(abs(signal - base)) FILTER (NOT core) * 1.4826e0 AS mad FROM xs JOIN fl USING (key) GROUP BY ALL),
ap AS (SELECT key, arg_max((signal, i, rt), (signal, -i)) FILTER (core) AS top FROM xs GROUP BY ALL),
lm AS (SELECT key, n, size, top[1] AS s, top[2] AS ai, top[3] AS apex_rt, base, CASE WHEN mad > 0 THEN mad ELSE greatest(base, 1) * 0.1e0 END AS sigma FROM sg JOIN ap USING (key)),
rn AS (SELECT key, coalesce(max(i) FILTER (NOT signal > base + sigma AND i < ai), -1) AS lo, coalesce(min(i) FILTER (NOT signal > base + sigma AND i > ai), any_value(size)) AS hi FROM xs JOIN lm USING (key) GROUP BY ALL),
pk AS (SELECT key, apex_rt, (s - base) / sigma AS sn FROM lm JOIN rn USING (key) WHERE n >= 3 AND s > 0 AND s - base > 0 AND hi - lo - 1 >= 3)"""


@query("w7_peak_test", f"""WITH {MS1}, ax AS (SELECT DISTINCT injection, scan_no, rt FROM ms1),
s AS (SELECT t.injection, t.target_id, scan_no, sum(intensity) AS signal FROM ms1 m JOIN tg t ON m.injection = t.injection AND rt >= t_lo AND rt < t_hi AND mz >= t_mz - t_mz * 40e-6 AND mz < t_mz + t_mz * 40e-6 GROUP BY ALL),
src AS (SELECT (t.injection, t.target_id) AS key, a.rt, coalesce(signal, 0) AS signal, {CENTRE.format(k='t.target_id')} AS centre FROM tg t JOIN ax a ON a.injection = t.injection AND a.rt >= t_lo AND a.rt < t_hi LEFT JOIN s ON s.injection = t.injection AND s.target_id = t.target_id AND s.scan_no = a.scan_no),
{_peak_sql('src', '0.2e0')}
SELECT key[1] AS injection, cast(key[2] AS int) AS target_id, round(apex_rt, 6) AS apex_rt, round(sn, 6) AS sn FROM (SELECT DISTINCT key FROM src) LEFT JOIN pk USING (key)""")
def w7(spark, d):
    tr = X.traces(X.xic(ms1(spark, d), targets(spark, d), ppm=40.0)).withColumn("centre", F.expr(CENTRE.format(k="target_id")))
    out = tr.withColumn("p", X.peak_test(F.col("trace"), F.col("centre"), F.lit(0.2)))
    return out.select("injection", "target_id", F.round("p.apex_rt", 6).alias("apex_rt"), F.round("p.sn", 6).alias("sn"))


@query("w8_signal_to_noise", f"""WITH {MS1}, t AS (SELECT injection, target_id, t_mz, {CENTRE.format(k='target_id')} AS c FROM tg), ax AS (SELECT DISTINCT injection, scan_no, rt FROM ms1),
w AS (SELECT t.*, scan_no, rt FROM t JOIN ax USING (injection) WHERE rt >= c - 2.5e0 AND rt < c + 0.25e0 + 1e-9),
x AS (SELECT w.injection, w.target_id, w.scan_no, w.rt, c, coalesce(max(intensity) FILTER (mz >= t_mz - t_mz * 12.5e-6 AND mz < t_mz + t_mz * 12.5e-6), 0) AS signal FROM w JOIN ms1 m USING (injection, scan_no) GROUP BY ALL),
l AS (SELECT injection, target_id, median(signal) AS md, count(*) AS n FROM x WHERE rt > c - 2.5e0 AND rt < c - 1.0e0 GROUP BY ALL),
d AS (SELECT injection, target_id, CASE WHEN any_value(n) >= 8 THEN median(abs(signal - md)) * 1.4826e0 END AS sigma FROM x JOIN l USING (injection, target_id) WHERE rt > c - 2.5e0 AND rt < c - 1.0e0 GROUP BY ALL),
h AS (SELECT injection, target_id, max(signal) AS top FROM x WHERE abs(rt - c) <= 0.25e0 GROUP BY ALL)
SELECT t.injection, cast(t.target_id AS int) AS target_id, round(CASE WHEN top > 0 AND sigma IS NOT NULL THEN top / greatest(sigma, 1) END, 6) AS snr FROM t LEFT JOIN d USING (injection, target_id) LEFT JOIN h USING (injection, target_id)""")
def w8(spark, d):
    f = targets(spark, d).selectExpr("study_id", "polarity", "injection", "target_id", "t_mz AS mz", "centre AS rt", "0.5e0 AS fwhm")
    return X.signal_to_noise(f, ms1(spark, d)).select("injection", "target_id", F.round("snr", 6).alias("snr"))


@query("j45_gapfill_null", f"""WITH {MS1}, ax AS (SELECT DISTINCT injection, scan_no, rt FROM ms1),
po AS (SELECT injection, target_id, kind, t_mz + dm AS t_mz, {CENTRE.format(k='target_id')} + dt AS centre FROM tg, (VALUES ('real', 0e0, 0e0), ('wrong mass', 0.3713e0, 0e0), ('wrong time', 0e0, 3e0)) v(kind, dm, dt)),
w AS (SELECT po.*, scan_no, rt FROM po JOIN ax USING (injection) WHERE rt >= centre - 0.6000000000000001e0 AND rt < centre + 0.6000000000000001e0),
src AS (SELECT (w.injection, w.target_id, kind) AS key, w.rt, centre, coalesce(sum(intensity) FILTER (mz >= t_mz - t_mz * 40e-6 AND mz < t_mz + t_mz * 40e-6), 0) AS signal FROM w JOIN ms1 m USING (injection, scan_no) GROUP BY key, w.rt, centre),
{_peak_sql('src', '0.2e0')}
SELECT injection, cast(target_id AS int) AS target_id, kind, round(coalesce(sn, 0), 6) AS sn FROM po LEFT JOIN pk ON pk.key = (injection, target_id, kind)""")
def j45(spark, d):
    p = targets(spark, d).selectExpr("study_id", "polarity", "injection", "target_id", "t_mz", "centre")
    return X.gapfill_null(p, ms1(spark, d), ppm=40.0).select("injection", "target_id", "kind", F.round("sn", 6).alias("sn"))


def scan_groups(spark, d):
    """The stand-in scans as one study: groups at the 64 masses."""
    g = targets(spark, d).selectExpr("study_id", "polarity", "cast(target_id AS bigint) AS group_id", "t_mz AS mz", "centre AS rt").distinct()
    a = X.ms1_peaks(ms1(spark, d)).withColumn("group_id", F.floor((F.col("mz") - 99.9) / 10).cast("bigint")).filter(f"abs(rt - {CENTRE.format(k='group_id')}) <= 0.05 AND (group_id + scan_no) % 7 <> 0")
    a = a.groupBy("study_id", "polarity", "group_id", "injection").agg((F.sum("intensity") * 3).alias("area"))
    i = scan_injections(spark, d).withColumn("role", F.lit("sample"))
    return g, a, i


@query("j20_fill_gaps")
def j20(spark, d):
    g, a, i = scan_groups(spark, d)
    out = X.fill_gaps(g, a, i, ms1(spark, d), 0.05, ppm=40.0, min_features=10, max_spread=50.0)
    return out.withColumn("area", F.round("area", 6))


@query("j21_absences_with_signal", f"""WITH {S.cte('groups', 'areas', 'injections')}, k AS (SELECT *, grp AS cell FROM injections WHERE role NOT IN ('blank', 'standard')), cl AS (SELECT *, count(*) OVER (PARTITION BY study_id, polarity, cell) AS sz FROM k), c AS (SELECT * FROM cl WHERE sz >= 3),
ng AS (SELECT study_id, polarity, count(*) AS g FROM groups GROUP BY ALL), t AS (SELECT study_id, polarity, g * count(DISTINCT cell) AS cells FROM c JOIN ng USING (study_id, polarity) GROUP BY study_id, polarity, g),
b AS (SELECT DISTINCT a.study_id, a.polarity, group_id, cell FROM areas a JOIN c USING (study_id, polarity, injection) WHERE area > 0 AND area % 5 = 0),
n AS (SELECT DISTINCT a.study_id, a.polarity, group_id, cell FROM areas a JOIN c USING (study_id, polarity, injection) WHERE area > 0 EXCEPT SELECT * FROM b)
SELECT study_id, polarity, cells - (SELECT count(*) FROM b WHERE b.study_id = t.study_id AND b.polarity = t.polarity) AS tested, (SELECT count(*) FROM n WHERE n.study_id = t.study_id AND n.polarity = t.polarity) AS with_signal FROM t""")
def j21(spark, d):
    a = S.areas(spark, d)
    cells = presence_cells(S.injections(spark, d), ("grp",))
    return X.absences_with_signal(S.groups(spark, d), a.filter("area % 5 = 0"), a, cells)


@query("w14_build_traces", f"""WITH {S.cte('spectra')}, p AS (SELECT {S.SCAN_INJECTION} AS inj, vec_id AS scan_no, {S.GRADIENT_RT} AS rt, mz, intensity FROM spectra_peaks WHERE intensity >= 30),
a AS (SELECT *, CASE WHEN (mz - lag(mz) OVER w) / mz * 1e6 <= 10 THEN 0 ELSE 1 END AS st FROM p WINDOW w AS (PARTITION BY inj ORDER BY mz, scan_no)),
b AS (SELECT *, sum(st) OVER (PARTITION BY inj ORDER BY mz, scan_no ROWS UNBOUNDED PRECEDING) AS mi FROM a),
c AS (SELECT *, CASE WHEN rt - lag(rt) OVER w <= 0.5 THEN 0 ELSE 1 END AS s2 FROM b WINDOW w AS (PARTITION BY inj, mi ORDER BY rt, mz)),
e AS (SELECT *, sum(s2) OVER (PARTITION BY inj, mi ORDER BY rt, mz ROWS UNBOUNDED PRECEDING) AS ri FROM c)
SELECT inj AS injection, round(max(intensity), 6) AS height, round(sum(intensity), 6) AS area, round(max(rt) - min(rt), 6) AS length, count(DISTINCT scan_no) AS n_scans FROM e GROUP BY inj, mi, ri""")
def w14(spark, d):
    t = X.build_traces(ms1(spark, d), noise=30.0, gap=0.5)
    return t.select("injection", F.round("height", 6).alias("height"), F.round("area", 6).alias("area"), F.round("length", 6).alias("length"), "n_scans")


@query("w14_build_features", f"""WITH {S.cte('spectra')}, p AS (SELECT {S.SCAN_INJECTION} AS inj, vec_id AS scan_no, {S.GRADIENT_RT} AS rt, mz, intensity FROM spectra_peaks WHERE intensity >= 30),
a AS (SELECT *, CASE WHEN (mz - lag(mz) OVER w) / mz * 1e6 <= 10 THEN 0 ELSE 1 END AS st FROM p WINDOW w AS (PARTITION BY inj ORDER BY mz, scan_no)),
b AS (SELECT *, sum(st) OVER (PARTITION BY inj ORDER BY mz, scan_no ROWS UNBOUNDED PRECEDING) AS mi FROM a),
c AS (SELECT *, CASE WHEN rt - lag(rt) OVER w <= 0.5 THEN 0 ELSE 1 END AS s2 FROM b WINDOW w AS (PARTITION BY inj, mi ORDER BY rt, mz)),
e AS (SELECT *, sum(s2) OVER (PARTITION BY inj, mi ORDER BY rt, mz ROWS UNBOUNDED PRECEDING) AS ri FROM c), f AS (SELECT *, max(intensity) OVER (PARTITION BY inj, mi, ri) AS top FROM e),
g AS (SELECT inj, arg_max(mz, intensity) AS mz, arg_max(rt, intensity) AS rt, sum(intensity) AS area, max(rt) FILTER (intensity >= top / 2) - min(rt) FILTER (intensity >= top / 2) AS fwhm, max(rt) - min(rt) AS length FROM f GROUP BY inj, mi, ri)
SELECT inj AS injection, round(mz, 6) AS mz, round(rt, 6) AS rt, round(area, 6) AS area, round(fwhm, 6) AS fwhm, 1::int AS charge FROM g WHERE length >= 0.05 AND fwhm BETWEEN 0 AND 10""")
def w14f(spark, d):
    f = X.build_features(ms1(spark, d), noise=30.0, gap=0.5, fwhm_range=(0.0, 10.0), need_isotope=False)
    return f.select("injection", F.round("mz", 6).alias("mz"), F.round("rt", 6).alias("rt"), F.round("area", 6).alias("area"), F.round("fwhm", 6).alias("fwhm"), "charge")


def raw_features(spark, d):
    return features(spark, d).selectExpr("study_id", "polarity", "injection", "group_id AS feature_id", "mz", "rt_measured AS rt", "area", "fwhm")


@query("w15_align_rt", f"""WITH {FEAT}, n AS (SELECT study_id, polarity, injection, count(*) AS n FROM ft GROUP BY ALL),
r AS (SELECT study_id, polarity, arg_max(injection, (n, injection)) AS ref FROM n GROUP BY ALL),
b AS (SELECT f.*, ref FROM ft f JOIN r USING (study_id, polarity)),
pr AS (SELECT x.study_id, x.polarity, x.injection, x.group_id, x.rt_measured AS rt, arg_min(y.rt_measured, abs(x.rt_measured - y.rt_measured)) AS rr FROM b x JOIN b y ON y.study_id = x.study_id AND y.polarity = x.polarity
  AND y.injection = x.ref AND x.injection <> x.ref AND abs(x.mz - y.mz) / y.mz * 1e6 <= 10 AND abs(x.rt_measured - y.rt_measured) <= 0.5 GROUP BY ALL),
l AS (SELECT study_id, polarity, injection, regr_slope(rr, rt) AS s, regr_intercept(rr, rt) AS i FROM pr GROUP BY ALL HAVING count(*) >= 3)
SELECT study_id, polarity, injection, group_id AS feature_id, round(CASE WHEN s IS NULL THEN rt_measured ELSE i + s * rt_measured END, 8) AS rt_aligned, s IS NOT NULL OR injection = ref AS aligned
FROM b LEFT JOIN l USING (study_id, polarity, injection)""")
def w15(spark, d):
    return X.align_rt(raw_features(spark, d)).select("study_id", "polarity", "injection", "feature_id", F.round("rt_aligned", 8).alias("rt_aligned"), "aligned")


def _link_round(n: int, rest: str) -> str:
    """One round inside each isolated mass and time island: the largest open feature is the centre, the nearest of each injection joins it."""
    return f"""c{n} AS (SELECT study_id, polarity, mi, ri, arg_min((injection, group_id, mz, rt_aligned), (-area, group_id, injection)) AS c FROM {rest} GROUP BY ALL),
d{n} AS (SELECT e.*, c[1] || '/' || c[2]::varchar AS link, pow(abs(mz - c[3]) / c[3] * 1e6 / 10, 2) + pow(abs(rt_aligned - c[4]) / 0.25, 2) AS d FROM {rest} e JOIN c{n} USING (study_id, polarity, mi, ri)),
l{n} AS (SELECT *, row_number() OVER (PARTITION BY study_id, polarity, injection, mi, ri ORDER BY d, area DESC, group_id) AS k FROM d{n}),
r{n} AS (SELECT * EXCLUDE (link, d, k) FROM l{n} WHERE k > 1)"""


@query("w16_link_features", f"""WITH {FEAT}, a AS (SELECT *, CASE WHEN (mz - lag(mz) OVER w) / mz * 1e6 <= 10 THEN 0 ELSE 1 END AS st FROM ft WINDOW w AS (PARTITION BY study_id, polarity ORDER BY mz, injection, group_id)),
b AS (SELECT *, sum(st) OVER (PARTITION BY study_id, polarity ORDER BY mz, injection, group_id ROWS UNBOUNDED PRECEDING) AS mi FROM a),
c AS (SELECT *, CASE WHEN rt_aligned - lag(rt_aligned) OVER w <= 0.25 THEN 0 ELSE 1 END AS s2 FROM b WINDOW w AS (PARTITION BY study_id, polarity, mi ORDER BY rt_aligned, injection, group_id)),
e AS (SELECT *, sum(s2) OVER (PARTITION BY study_id, polarity, mi ORDER BY rt_aligned, injection, group_id ROWS UNBOUNDED PRECEDING) AS ri FROM c),
{_link_round(1, 'e')}, {_link_round(2, 'r1')}
SELECT study_id, polarity, injection, group_id AS feature_id, link FROM l1 WHERE k = 1 UNION ALL SELECT study_id, polarity, injection, group_id, link FROM l2 WHERE k = 1""")
def w16(spark, d):
    f = features(spark, d).withColumn("feature_id", F.col("group_id"))
    return X.link_features(f).select("study_id", "polarity", "injection", "feature_id", "link")


CONF = f"""{FEAT}, hh AS (SELECT study_id, polarity, injection, mz * (1 + (group_id % 7) * 1e-6) AS pmz, rt_measured + (group_id % 5) * 0.1e0 AS rt, 400 + group_id % 300 AS dot FROM ft WHERE group_id % 2 = 0),
fo AS (SELECT * FROM ft WHERE group_id % 3 <> 0)"""


def confident(spark, d):
    f = features(spark, d)
    h = f.filter("group_id % 2 = 0").selectExpr("study_id", "polarity", "injection", "mz * (1 + (group_id % 7) * 1e-6) AS precursor_mz", "rt_measured + (group_id % 5) * 0.1e0 AS rt", "400 + group_id % 300 AS dot", "800 AS reverse_dot")
    return h, f.filter("group_id % 3 <> 0").selectExpr("study_id", "polarity", "injection", "group_id", "mz", "rt_measured AS rt")


@query("j18_recover_features", f"""WITH {CONF} SELECT t.study_id, t.polarity, t.injection, t.group_id FROM ft t
WHERE EXISTS (SELECT 1 FROM hh h WHERE h.study_id = t.study_id AND h.polarity = t.polarity AND h.injection = t.injection AND dot > 500 AND abs(pmz - t.mz) / t.mz * 1e6 < 20 AND abs(h.rt - t.rt_measured) < 0.25)
 AND NOT EXISTS (SELECT 1 FROM fo f WHERE f.study_id = t.study_id AND f.polarity = t.polarity AND f.injection = t.injection AND abs(f.mz - t.mz) / t.mz * 1e6 < 20 AND abs(f.rt_measured - t.rt_measured) < 0.25)""")
def j18(spark, d):
    h, f = confident(spark, d)
    t = features(spark, d).selectExpr("study_id", "polarity", "injection", "group_id", "mz", "rt_measured AS rt")
    return X.recover_features(t, f.drop("group_id"), h).select("study_id", "polarity", "injection", "group_id")


@query("j46_detection_recall", f"""WITH {CONF}, q AS (SELECT * FROM hh WHERE dot > 500),
a AS (SELECT *, CASE WHEN (pmz - lag(pmz) OVER w) / pmz * 1e6 <= 20 THEN 0 ELSE 1 END AS st FROM q WINDOW w AS (PARTITION BY study_id, polarity, injection ORDER BY pmz, rt)),
b AS (SELECT *, sum(st) OVER (PARTITION BY study_id, polarity, injection ORDER BY pmz, rt ROWS UNBOUNDED PRECEDING) AS mi FROM a),
c AS (SELECT *, CASE WHEN rt - lag(rt) OVER w <= 0.25 THEN 0 ELSE 1 END AS s2 FROM b WINDOW w AS (PARTITION BY study_id, polarity, injection, mi ORDER BY rt, pmz)),
e AS (SELECT *, sum(s2) OVER (PARTITION BY study_id, polarity, injection, mi ORDER BY rt, pmz ROWS UNBOUNDED PRECEDING) AS ri FROM c),
o AS (SELECT study_id, polarity, injection, min((pmz, rt)) AS t FROM e GROUP BY study_id, polarity, injection, mi, ri)
SELECT study_id, polarity, injection, count(*) AS targets, count_if(EXISTS (SELECT 1 FROM fo f WHERE f.study_id = o.study_id AND f.polarity = o.polarity AND f.injection = o.injection AND abs(o.t[1] - f.mz) / o.t[1] * 1e6 < 20 AND abs(o.t[2] - f.rt_measured) < 0.25)) AS found FROM o GROUP BY ALL""")
def j46(spark, d):
    h, f = confident(spark, d)
    return X.detection_recall(h, f.drop("group_id"))


@query("s21_injection_polarity", f"""WITH {S.cte('scans')}, s AS (SELECT study_id, injection, ms2_id, CASE WHEN ms2_id % 4 = 0 THEN NULL ELSE polarity END AS stated FROM scans)
SELECT study_id, injection, coalesce(arg_min(stated, ms2_id), '+') AS polarity FROM s GROUP BY ALL""")
def s21(spark, d):
    s = S.scans(spark, d).selectExpr("study_id", "injection", "ms2_id AS scan_no", "if(ms2_id % 4 = 0, null, polarity) AS stated")
    return X.injection_polarity(s)


@query("f11_merge_frames", f"""WITH {S.cte('spectra')} SELECT vec_id, count(*) AS n_peaks, round(sum(intensity * 3), 6) AS total FROM spectra_peaks GROUP BY ALL""")
def f11(spark, d):
    s = S.spectra(spark, d).selectExpr("vec_id", "flatten(transform(peaks, p -> array(p, named_struct('mz', p.mz * (1 + 20e-6), 'intensity', p.intensity), named_struct('mz', p.mz * (1 + 50e-6), 'intensity', p.intensity)))) AS peaks")
    out = X.merge_frames(s)
    return out.select("vec_id", F.size("peaks").cast("long").alias("n_peaks"), F.round(F.aggregate(F.col("peaks.intensity"), F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("j31_file_mass_drift", f"""WITH {MS1}, c AS (SELECT DISTINCT k AS cal_id, 100e0 + 10 * k + 0.004e0 AS cal_mz, {CENTRE.format(k='k')} AS cal_rt FROM spectra_peaks),
b AS (SELECT injection, cal_id, cal_mz, arg_max(mz, (intensity, -scan_no, -mz)) AS mz FROM ms1 JOIN c ON abs(mz - cal_mz) / cal_mz * 1e6 < 30 AND abs(rt - cal_rt) < 0.6 GROUP BY ALL)
SELECT injection, count(*) AS n, CASE WHEN count(*) >= 20 THEN round(median((mz - cal_mz) / cal_mz * 1e6), 6) END AS offset_ppm,
  round(CASE WHEN count(*) >= 20 THEN stddev_pop((mz - cal_mz) / cal_mz * 1e6) ELSE 0 END, 6) AS spread_ppm FROM b GROUP BY ALL""")
def j31(spark, d):
    c = targets(spark, d).selectExpr("study_id", "polarity", "target_id AS cal_id", "t_mz AS cal_mz", "centre AS cal_rt").distinct()
    out = C.file_mass_drift(ms1(spark, d), c, rt_window=0.6)
    return out.select("injection", "n", F.round("offset_ppm", 6).alias("offset_ppm"), F.round("spread_ppm", 6).alias("spread_ppm"))


@query("p15_apply_file_calibration", f"""WITH {S.cte('spectra')}, o AS (SELECT vec_id, (vec_id % 6) * 1e0 AS off FROM spectra),
a AS (SELECT p.vec_id, mz, intensity, precursor_mz, CASE WHEN off >= 2 THEN off ELSE 0 END AS ppm FROM spectra_peaks p JOIN o USING (vec_id))
SELECT vec_id, any_value(ppm) AS calibrated_ppm, round(any_value(precursor_mz * (1 - ppm * 1e-6)), 8) AS precursor_mz, round(sum(mz * (1 - ppm * 1e-6)), 6) AS sum_mz FROM a GROUP BY ALL""")
def p15(spark, d):
    s = S.spectra(spark, d).selectExpr("'A' AS study_id", "'+' AS polarity", "concat('S_', vec_id % 6) AS injection", "vec_id", "precursor_mz", "peaks")
    o = s.select("study_id", "polarity", "injection").distinct().withColumn("offset_ppm", F.substring("injection", 3, 9).cast("double"))
    out = C.apply_file_calibration(s, o)
    return out.select("vec_id", "calibrated_ppm", F.round("precursor_mz", 8).alias("precursor_mz"), F.round(F.aggregate(F.col("peaks.mz"), F.lit(0.0), lambda a, x: a + x), 6).alias("sum_mz"))


@query("a25_mass_offset", f"""WITH {HITS} SELECT study_id, polarity, 'mass_offset_ppm' AS parameter, 0.0::double AS previous, round(median(delta_ppm), 9) AS measured, round(greatest(-25, least(25, median(delta_ppm))), 9) AS value, false AS clamped, '' AS skipped_reason FROM hits GROUP BY ALL""")
def a25(spark, d):
    h = hits(spark, d).join(S.injections(spark, d).filter("role IN ('sample', 'qc')").select("study_id", "polarity", "injection"), ["study_id", "polarity", "injection"])
    out = C.derive_setting("mass_offset_ppm", h, "delta_ppm")
    return out.withColumn("measured", F.round("measured", 9)).withColumn("value", F.round("value", 9))


@query("a25_peak_width", f"""WITH {S.cte('scans')} SELECT study_id, polarity, 'max_fwhm' AS parameter, 20.0::double AS previous, round(quantile_cont(value / 10, 0.99), 9) AS measured,
  round(greatest(5, least(300, quantile_cont(value / 10, 0.99))), 9) AS value, false AS clamped, '' AS skipped_reason FROM scans GROUP BY ALL""")
def a25w(spark, d):
    out = C.derive_setting("max_fwhm", S.scans(spark, d).withColumn("w", F.col("value") / 10), "w")
    return out.withColumn("measured", F.round("measured", 9)).withColumn("value", F.round("value", 9))


NOISE = f"""{S.cte('spectra')}, p AS (SELECT 'A' AS study_id, '+' AS polarity, intensity AS v FROM spectra_peaks WHERE intensity > 0),
q AS (SELECT quantile_cont(v, 0.1) AS p10 FROM p), fl AS (SELECT study_id, polarity, count(*) AS n, median(CASE WHEN v <= p10 THEN v END) AS floor FROM p, q GROUP BY ALL)"""


@query("a26_noise_floor", f"WITH {NOISE} SELECT study_id, polarity, n, round(floor, 9) AS floor, round(500 / floor, 6) AS ratio, 500 / floor BETWEEN 2 AND 15 AS plausible FROM fl")
def a26(spark, d):
    f = C.noise_check(C.noise_floor(X.ms1_peaks(ms1(spark, d))), 500.0)
    return f.select("study_id", "polarity", "n", F.round("floor", 9).alias("floor"), F.round("ratio", 6).alias("ratio"), "plausible")


@query("a26_peak_cap", f"""WITH {NOISE}, k AS (SELECT count(DISTINCT vec_id) * 20 AS keep FROM spectra_peaks), r AS (SELECT v, row_number() OVER (ORDER BY v DESC) AS rn FROM p)
SELECT 'A' AS study_id, '+' AS polarity, v AS threshold FROM r, k WHERE rn = keep""")
def a26c(spark, d):
    return C.peak_cap(ms1(spark, d), cap=20)


def axis_spectra(spark, d):
    """Spectra whose peak 8 (mass 180 + label / 1000) stands for a calibrant near 184.0733."""
    return S.spectra(spark, d).selectExpr("'A' AS study_id", "'+' AS polarity", "'S_0' AS injection", "vec_id AS ms2_id", "'orbitrap' AS analyzer",
                                          "transform(peaks, p -> named_struct('mz', p.mz + 4.07e0, 'intensity', p.intensity)) AS peaks")


AXIS = f"""{S.cte('spectra')}, s AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY intensity DESC) AS rk, max(intensity) OVER (PARTITION BY vec_id) AS base FROM spectra_peaks),
er AS (SELECT vec_id, c.cal, mz + 4.07e0 - c.cal AS e FROM s JOIN (VALUES (184.0733e0), (264.2686e0)) c(cal) ON abs(mz + 4.07e0 - c.cal) <= 0.05 WHERE rk <= 10 AND intensity >= 0.02 * base)"""


@query("j32_ms2_axis_errors", f"WITH {AXIS} SELECT vec_id AS ms2_id, cal AS calibrant, round(e, 9) AS error_da FROM er")
def j32(spark, d):
    return C.ms2_axis_errors(axis_spectra(spark, d)).select("ms2_id", "calibrant", F.round("error_da", 9).alias("error_da"))


@query("a27_ms2_axis", f"""WITH {AXIS}, m AS (SELECT count(*) AS n, median(e) AS o FROM er), dv AS (SELECT abs(e - o) AS dv FROM er, m)
SELECT n AS n_peaks, round(o, 9) AS offset_da, round(avg(CASE WHEN dv <= 0.01 THEN 1 ELSE 0 END), 9) AS configured_capture, round(avg(CASE WHEN dv <= 0.005 THEN 1 ELSE 0 END), 9) AS capture_005 FROM dv, m GROUP BY ALL""")
def a27(spark, d):
    out = C.ms2_axis(C.ms2_axis_errors(axis_spectra(spark, d)))
    return out.select("n_peaks", F.round("offset_da", 9).alias("offset_da"), F.round("configured_capture", 9).alias("configured_capture"), F.round(F.get("capture", F.lit(0)), 9).alias("capture_005"))


def standards(spark, d):
    """A standards mix read off the part table: thirty formulas, masses computed from them."""
    s = S.read(spark, d, "part").selectExpr("concat('std ', p_size) AS standard", "concat('C', 20 + p_size, 'H', 30 + 2 * p_size, 'D7NO8P') AS formula").distinct()
    s = s.withColumn("adduct", F.lit("[M+H]+")).withColumn("polarity", F.lit("+"))
    return C.with_standard_mz(s)


STD = f"""{S.cte('areas', 'injections')}, st AS (SELECT DISTINCT 'std ' || p_size::varchar AS standard, (20 + p_size) * 12.0e0 + (30 + 2 * p_size) * 1.00782503207e0 + 7 * 2.01410177785e0 + 14.0030740048e0 + 8 * 15.9949146196e0 + 30.97376163e0 + 1.007276466e0 AS mz0 FROM part),
mx AS (SELECT group_id, max(area) AS max_area FROM areas GROUP BY ALL), gg AS (SELECT g.*, coalesce(max_area, 0) AS max_area FROM groups g LEFT JOIN mx USING (group_id) WHERE polarity = '+'),
mt AS (SELECT g.study_id, g.polarity, standard, mz0, g.group_id, g.mz, g.max_area FROM gg g JOIN st ON abs(g.mz - mz0) / mz0 * 1e6 <= 400),
bs AS (SELECT study_id, polarity, standard, mz0, arg_max((group_id, mz), (max_area, -group_id)) AS b FROM mt GROUP BY ALL)"""


def sized(spark, d):
    mx = S.areas(spark, d).groupBy("group_id").agg(F.max("area").alias("max_area"))
    return S.groups(spark, d).join(mx, "group_id", "left").na.fill(0, ["max_area"])


@query("j25_standards_performance", f"""WITH {STD}, c AS (SELECT b.study_id, b.polarity, standard, count(*) AS k, median(area) AS med FROM bs b JOIN areas a ON a.group_id = b.b[1] JOIN injections i ON i.study_id = a.study_id AND i.polarity = a.polarity AND i.injection = a.injection AND i.role = 'standard' WHERE area > 0 GROUP BY ALL)
SELECT r.study_id, '+' AS polarity, st.standard, round(mz0, 6) AS expected_mz, b IS NOT NULL AS found, round(b[2], 6) AS observed_mz, round((b[2] - mz0) / mz0 * 1e6, 4) AS mass_error_ppm, coalesce(k, 0) AS detected_in,
  CASE WHEN b IS NOT NULL THEN coalesce(med, 0) END AS median_area FROM (SELECT DISTINCT study_id FROM groups) r CROSS JOIN st LEFT JOIN bs USING (study_id, standard, mz0) LEFT JOIN c ON c.study_id = r.study_id AND c.standard = st.standard""")
def j25(spark, d):
    out = C.standards_performance(sized(spark, d), S.areas(spark, d), S.injections(spark, d), standards(spark, d), tol=400.0)
    return out.select("study_id", "polarity", "standard", F.round("expected_mz", 6).alias("expected_mz"), "found", F.round("observed_mz", 6).alias("observed_mz"),
                      F.round("mass_error_ppm", 4).alias("mass_error_ppm"), "detected_in", "median_area")


@query("j25_mix_present", f"""WITH {STD}, ns AS (SELECT study_id, polarity, count_if(role = 'sample') AS n FROM injections GROUP BY ALL),
k AS (SELECT m.study_id, m.polarity, standard, m.group_id, count(i.injection) AS k FROM mt m LEFT JOIN areas a ON a.group_id = m.group_id AND a.area > 0 LEFT JOIN injections i ON i.study_id = a.study_id AND i.polarity = a.polarity AND i.injection = a.injection AND i.role = 'sample' GROUP BY ALL),
s AS (SELECT study_id, polarity, standard, max(k) AS k FROM k GROUP BY ALL)
SELECT ns.study_id, ns.polarity, n AS injections, coalesce(count_if(k >= greatest(1, round_even(n * 0.5, 0))), 0) AS standards_found, coalesce(count_if(k >= greatest(1, round_even(n * 0.5, 0))), 0) >= 2 AS present
FROM ns LEFT JOIN s USING (study_id, polarity) GROUP BY ALL""")
def j25m(spark, d):
    return C.mix_present(S.groups(spark, d), S.areas(spark, d), S.injections(spark, d), standards(spark, d), tol=400.0)


@query("j25_check_offset", f"""WITH {STD}, so AS (SELECT study_id, polarity, median((b[2] - mz0) / mz0 * 1e6) AS s FROM bs GROUP BY ALL), dv AS (SELECT DISTINCT study_id, polarity, 1.5e0 AS dp FROM groups)
SELECT study_id, polarity, dp AS derived_ppm, round(s, 4) AS standards_ppm, round(s - dp, 4) AS difference_ppm, CASE WHEN s IS NULL THEN 'not comparable' WHEN abs(s - dp) <= 3 THEN 'agree' ELSE 'DISAGREE' END AS verdict FROM dv LEFT JOIN so USING (study_id, polarity)""")
def j25o(spark, d):
    derived = S.groups(spark, d).select("study_id", "polarity").distinct().withColumn("derived_ppm", F.lit(1.5))
    out = C.check_offset(derived, C.standards_offset(sized(spark, d), standards(spark, d), tol=400.0))
    return out.withColumn("standards_ppm", F.round("standards_ppm", 4)).withColumn("difference_ppm", F.round("difference_ppm", 4))


