"""Acquisition diagnostics and mass lists."""

from pyspark.sql import functions as F

from massloom.functions import ions
from massloom.operators import acquisition as A
from massloom.operators import series as R
from massloom.operators.band import Band, band_exists, band_join, islands, spread
from massloom.plans import standin as S
from massloom.plans.registry import query

SC = S.cte("scans", "injections")
CLUSTERS = f"""{SC},
g AS (SELECT *, CASE WHEN (precursor_mz - lag(precursor_mz) OVER w) / precursor_mz * 1e6 <= 10 THEN 0 ELSE 1 END AS st
  FROM scans WINDOW w AS (PARTITION BY study_id, polarity ORDER BY precursor_mz, ms2_id)),
c AS (SELECT *, cast(sum(st) OVER (PARTITION BY study_id, polarity ORDER BY precursor_mz, ms2_id ROWS UNBOUNDED PRECEDING) AS bigint) AS cluster FROM g),
cl AS (SELECT study_id, polarity, cluster, avg(precursor_mz) AS mz, count(*) AS scans, min(rt) AS rt_lo, max(rt) AS rt_hi,
  bool_or(identified) AS any_identified FROM c GROUP BY ALL)"""


@query("w1_cluster_mz", f"""WITH {CLUSTERS} SELECT study_id, polarity, cluster, round(mz, 6) AS mz, scans,
  round(rt_lo, 6) AS rt_lo, round(rt_hi, 6) AS rt_hi, any_identified FROM cl""")
def w1(spark, d):
    c = A.cluster_mz(S.scans(spark, d))
    return c.select("study_id", "polarity", "cluster", F.round("mz", 6).alias("mz"), "scans",
                    F.round("rt_lo", 6).alias("rt_lo"), F.round("rt_hi", 6).alias("rt_hi"), "any_identified")


@query("w1_islands", f"WITH {CLUSTERS} SELECT study_id, polarity, ms2_id, cluster FROM c")
def w1_islands(spark, d):
    return islands(S.scans(spark, d), "precursor_mz", 10.0, "ppm", ["study_id", "polarity"]).select(
        "study_id", "polarity", "ms2_id", "cluster")


WASTED = f"""{CLUSTERS},
gr AS (SELECT study_id, polarity, max(rt) - min(rt) AS gradient FROM scans GROUP BY ALL),
bp AS (SELECT study_id, polarity, precursor_mz AS bmz FROM scans WHERE inj_id IN (0, 1)),
w AS (SELECT cl.*, (rt_hi - rt_lo) / gradient AS gradient_fraction,
   EXISTS (SELECT 1 FROM bp WHERE bp.study_id = cl.study_id AND bp.polarity = cl.polarity AND abs(bmz - mz) <= 0.01) AS in_blank
  FROM cl JOIN gr USING (study_id, polarity)
  WHERE scans >= 2 AND NOT any_identified AND (rt_hi - rt_lo) / gradient >= 0.2)"""


def wasted(spark, d, require_blank=True):
    s = S.scans(spark, d)
    return A.find_wasted(s, s.filter("inj_id IN (0, 1)"), min_scans=2, min_fraction=0.2, require_blank=require_blank)


@query("a17_wasted_precursors", f"""WITH {WASTED} SELECT study_id, polarity, round(mz, 6) AS mz, scans,
  round(gradient_fraction, 6) AS gradient_fraction, in_blank FROM w
WHERE in_blank OR NOT EXISTS (SELECT 1 FROM bp WHERE bp.study_id = w.study_id AND bp.polarity = w.polarity)""")
def a17(spark, d):
    return wasted(spark, d).select("study_id", "polarity", F.round("mz", 6).alias("mz"), "scans",
                                   F.round("gradient_fraction", 6).alias("gradient_fraction"), "in_blank")


@query("j23_in_blank", f"WITH {WASTED} SELECT study_id, polarity, round(mz, 6) AS mz, in_blank FROM w")
def j23(spark, d):
    return wasted(spark, d, False).select("study_id", "polarity", F.round("mz", 6).alias("mz"), "in_blank")


#: Hundredths of a whole number ``d`` of millionths, halves to the even one.
CELL = "(d // 10000 + CASE WHEN d % 10000 > 5000 OR (d % 10000 = 5000 AND d // 10000 % 2 = 1) THEN 1 ELSE 0 END) / 100.0::double AS cell"


def series_sql(source: str, keys: str = "study_id, polarity", discover: bool = True) -> str:
    """CTEs up to ``labelled`` (keys, mz, series): one recursive step is one unit over the sorted masses of each run.

    ``fst`` holds the place of the first mass from each whole number on; ``nxt`` the place of each mass's next rung.
    """
    names = "[" + ", ".join(f"'{n}'" for n in R.REPEATS) + "]"
    steps = "[" + ", ".join(f"{x!r}::double" for x in R.REPEATS.values()) + "]"
    n, free = len(R.REPEATS), f"unnest(list_filter(p.m, lambda x, i: p.l[i] = '' AND p.turn >= {len(R.REPEATS)}))"
    more = f"(turn < {n} OR len(list_filter(t, lambda f: f)) > len(list_filter(l, lambda x: x <> '')))" if discover else "false"
    return f"""sorted_masses AS (SELECT {keys}, list(DISTINCT mz ORDER BY mz) AS m FROM {source} GROUP BY {keys}),
pass AS (
  SELECT {keys}, m, list_transform(m, lambda x: '') AS l, list_transform(range(0, 2500), lambda k: len(list_filter(m, lambda x: x < k)) + 1) AS fst, 0 AS turn, true AS going FROM sorted_masses
  UNION ALL
  SELECT {keys}, m, list_transform(t, lambda f, i: CASE WHEN l[i] = '' AND f THEN label ELSE l[i] END), fst, turn + 1, turn + 1 < {n} OR {more}
  FROM (SELECT *, list_reduce(list_prepend({{'s': 0, 't': list_transform(l, lambda x: x <> '')}}, list_transform(list_filter(range(1, len(m) + 1), lambda i: nxt[i] <> 0), lambda i: {{'s': i, 't': []::boolean[]}})), lambda a, x:
      CASE WHEN a.t[x.s] THEN a ELSE list_transform([list_reduce(list_prepend([x.s], list_transform(range(0, 100), lambda i: []::bigint[])), lambda p, e:
        CASE WHEN nxt[p[-1]] = 0 OR a.t[nxt[p[-1]]] THEN p ELSE list_append(p, nxt[p[-1]]) END)], lambda p: CASE WHEN len(p) >= CASE WHEN turn < {n} THEN 3 ELSE 4 END
        THEN {{'s': x.s, 't': list_transform(a.t, lambda f, k: f OR list_contains(p, k))}} ELSE a END)[1] END).t AS t
    FROM (SELECT *, list_transform(m, lambda x, i: CASE WHEN l[i] <> '' THEN 0 ELSE coalesce(list_sort(list_transform(list_filter(range(fst[cast(floor(x + step - 0.02) AS int) + 1], fst[cast(floor(x + step + 0.02) AS int) + 2]),
          lambda j: l[j] = '' AND abs(x + step - m[j]) <= 0.01), lambda j: {{'e': abs(x + step - m[j]), 'h': -m[j], 'j': j}}))[1].j, 0) END) AS nxt
      FROM (SELECT p.*, coalesce(({names})[turn + 1], 'unnamed Δ' || printf('%.3f', step)) AS label FROM (SELECT p.*, coalesce(({steps})[turn + 1], (
          SELECT arg_max(st, (c, -fa, -fb)) FROM (SELECT count(*) AS c, sum(d)::bigint / count(*) / 1e6 AS st, min({{'a': a, 'b': b}}).a AS fa, min({{'a': a, 'b': b}}).b AS fb
            FROM (SELECT *, {CELL}
              FROM (SELECT a, b, cast(round_even((b - a) * 1e6, 0) AS bigint) AS d FROM (SELECT {free} AS a) u, (SELECT {free} AS b) v WHERE b - a BETWEEN 19 AND 201) y WHERE d BETWEEN 20000000 AND 200000000) x
            WHERE abs(cell - round_even(cell / {R.CH2}, 0) * {R.CH2}) > {R.CH2_GUARD} GROUP BY cell HAVING count(*) >= 3) w)) AS step
        FROM pass p WHERE going) p WHERE step IS NOT NULL) q) r) z
), last_pass AS (SELECT {keys}, m, l FROM pass QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY turn DESC) = 1
), labelled AS (SELECT {keys}, unnest(m) AS mz, unnest(l) AS series FROM last_pass)"""


@query("w2_series", f"""WITH RECURSIVE {CLUSTERS}, grid AS (SELECT study_id, polarity, cluster, round(mz, 6) AS mz, scans FROM cl), {series_sql('grid')}
SELECT study_id, polarity, cluster, mz, scans, series FROM grid JOIN labelled USING (study_id, polarity, mz)""")
def w2(spark, d):
    c = A.cluster_mz(S.scans(spark, d)).select("study_id", "polarity", "cluster", F.round("mz", 6).alias("mz"), "scans")
    return R.assign_series(c)


@query("w2_delta_votes", f"""WITH {CLUSTERS}, grid AS (SELECT study_id, polarity, round(mz, 6) AS mz FROM cl),
p AS (SELECT a.study_id, a.polarity, cast(round_even((b.mz - a.mz) * 1e6, 0) AS bigint) AS d FROM grid a JOIN grid b ON a.study_id = b.study_id AND a.polarity = b.polarity AND b.mz - a.mz BETWEEN 19 AND 201),
v AS (SELECT study_id, polarity, {CELL}, count(*) AS n, sum(d)::bigint / count(*) / 1e6 AS step FROM p WHERE d BETWEEN 20000000 AND 200000000 GROUP BY ALL)
SELECT study_id, polarity, cell, n, round(step, 6) AS step FROM v WHERE abs(cell - round_even(cell / {R.CH2}, 0) * {R.CH2}) > {R.CH2_GUARD}""")
def w2_votes(spark, d):
    c = A.cluster_mz(S.scans(spark, d)).select("study_id", "polarity", F.round("mz", 6).alias("mz"))
    return R.delta_votes(c).select("study_id", "polarity", "cell", "n", F.round("step", 6).alias("step"))


@query("a18_duty_cycle", f"""WITH {WASTED},
t AS (SELECT study_id, polarity, count(*) AS total_ms2 FROM scans GROUP BY ALL),
s AS (SELECT study_id, polarity, cast(sum(scans) AS bigint) AS wasted_ms2, count(*) AS precursors FROM w GROUP BY ALL)
SELECT study_id, polarity, total_ms2, coalesce(wasted_ms2, 0) AS wasted_ms2, coalesce(precursors, 0) AS precursors,
  round(coalesce(wasted_ms2, 0) / total_ms2, 9) AS wasted_fraction FROM t LEFT JOIN s USING (study_id, polarity)""")
def a18(spark, d):
    out = A.duty_cycle(wasted(spark, d, False), S.scans(spark, d))
    return out.withColumn("wasted_fraction", F.round("wasted_fraction", 9))


@query("a18_series_breakdown", f"""WITH RECURSIVE {WASTED}, grid AS (SELECT study_id, polarity, round(mz, 6) AS mz, scans FROM w), {series_sql('grid')},
t AS (SELECT study_id, polarity, count(*) AS total_ms2 FROM scans GROUP BY ALL)
SELECT study_id, polarity, CASE WHEN series = '' THEN 'unassigned' ELSE series END AS series, count(*) AS precursors, cast(sum(scans) AS bigint) AS scans, round(sum(scans) / any_value(total_ms2), 9) AS share
FROM grid JOIN labelled USING (study_id, polarity, mz) JOIN t USING (study_id, polarity) GROUP BY ALL""")
def a18b(spark, d):
    s = S.scans(spark, d)
    rows = R.assign_series(wasted(spark, d, False).select("study_id", "polarity", F.round("mz", 6).alias("mz"), "scans"))
    return A.series_breakdown(rows, s).withColumn("share", F.round("share", 9))


def scan_table(spark, d):
    """Every event is a scan; views are MS1.  Isolation width and reuse vary by injection."""
    return S.scans(spark, d).selectExpr(
        "study_id", "polarity", "injection", "inj_id", "ms2_id AS scan_no", "rt",
        "if(event_type = 'view', 1, 2) AS ms_level",
        "if(event_type = 'view' OR inj_id = 3, null, if(inj_id % 7 = 0, 100 + ms2_id % 2, precursor_mz)) AS isolation_target",
        "if(event_type = 'view' OR inj_id = 3, null, CASE WHEN inj_id = 4 THEN 60e0 WHEN inj_id % 7 = 0 THEN 10e0 ELSE 0.5e0 END) AS isolation_lower",
        "event_type <> 'view' AND inj_id <> 3 AS has_selection",
        "if(event_type = 'view', null, least(value, 60e0)) AS injection_time", "value * user_id AS tic")


SCAN_TABLE = f"""{SC}, st AS (SELECT study_id, polarity, injection, inj_id, ms2_id AS scan_no, rt,
  CASE WHEN event_type = 'view' THEN 1 ELSE 2 END AS ms_level,
  CASE WHEN event_type = 'view' OR inj_id = 3 THEN NULL WHEN inj_id % 7 = 0 THEN 100 + ms2_id % 2 ELSE precursor_mz END AS isolation_target,
  CASE WHEN event_type = 'view' OR inj_id = 3 THEN NULL WHEN inj_id = 4 THEN 60e0 WHEN inj_id % 7 = 0 THEN 10e0 ELSE 0.5e0 END AS isolation_lower,
  event_type <> 'view' AND inj_id <> 3 AS has_selection,
  CASE WHEN event_type = 'view' THEN NULL ELSE least(value, 60e0) END AS injection_time, value * user_id AS tic FROM scans)"""


TYPES = f"""{SCAN_TABLE}, ty AS (SELECT study_id, polarity, injection, count_if(ms_level = 1) AS n_ms1, count_if(ms_level > 1) AS n_ms2,
   count_if(ms_level > 1 AND has_selection) AS n_selected, count(isolation_target) AS n_targets,
   count(DISTINCT round_even(isolation_target, 1)) AS n_windows, max(isolation_lower) * 2 AS width FROM st GROUP BY ALL),
tt AS (SELECT *, n_targets / greatest(n_windows, 1) AS reuse FROM ty),
tc AS (SELECT *, CASE WHEN n_ms2 = 0 THEN CASE WHEN n_ms1 > 0 THEN 'MS1 only' ELSE 'unknown' END
   WHEN n_selected = 0 AND n_targets = 0 THEN 'all-ion' WHEN width >= 100 THEN 'all-ion'
   WHEN width >= 5 AND reuse >= 20 THEN 'DIA' ELSE 'DDA' END AS acquisition FROM tt)"""


@query("a28_acquisition_type", f"""WITH {TYPES} SELECT study_id, polarity, injection, n_ms1, n_ms2, n_targets, n_windows, width, acquisition,
   acquisition IN ('DDA', 'unknown') AS searchable FROM tc""")
def a28(spark, d):
    return A.searchable(A.acquisition_type(scan_table(spark, d))).select(
        "study_id", "polarity", "injection", "n_ms1", "n_ms2", "n_targets", "n_windows", "width", "acquisition", "searchable")


@query("a28_study_warnings", f"""WITH {TYPES} SELECT study_id, polarity, sum(n_ms2) = 0 AND sum(n_ms1) > 0 AS no_ms2,
  sum(n_ms2) > 0 AND sum(n_selected) + sum(n_targets) = 0 AS no_selection, bool_or(acquisition = 'DIA') AS any_dia FROM tc GROUP BY ALL""")
def a28w(spark, d):
    return A.study_warnings(A.acquisition_type(scan_table(spark, d)))


@query("w11_cycle_budget", f"""WITH {SCAN_TABLE},
p AS (SELECT *, lag(ms_level) OVER w AS l, (rt - lag(rt) OVER w) * 60000 AS dt, row_number() OVER w AS pos FROM st
  WINDOW w AS (PARTITION BY study_id, polarity, injection ORDER BY scan_no)),
a AS (SELECT study_id, polarity, injection, median(CASE WHEN l = 2 AND ms_level = 2 THEN dt END) AS ms2_cost,
   median(CASE WHEN l = 2 AND ms_level = 1 THEN dt END) + median(CASE WHEN l = 1 AND ms_level = 2 THEN dt END) AS ms1_cost FROM p GROUP BY ALL),
q AS (SELECT study_id, polarity, injection, pos - lag(pos) OVER w - 1 AS n, (rt - lag(rt) OVER w) * 60000 AS c FROM p WHERE ms_level = 1
  WINDOW w AS (PARTITION BY study_id, polarity, injection ORDER BY scan_no)),
b AS (SELECT study_id, polarity, injection, median(c) AS cycle, cast(median(n) AS double) AS ms2_per_cycle FROM q GROUP BY ALL)
SELECT study_id, polarity, injection, round(ms2_cost, 4) AS ms2_cost, round(ms1_cost, 4) AS ms1_cost, round(cycle, 4) AS cycle, ms2_per_cycle
FROM a JOIN b USING (study_id, polarity, injection)""")
def w11(spark, d):
    out = A.cycle_budget(scan_table(spark, d))
    return out.select("study_id", "polarity", "injection", F.round("ms2_cost", 4).alias("ms2_cost"),
                      F.round("ms1_cost", 4).alias("ms1_cost"), F.round("cycle", 4).alias("cycle"), "ms2_per_cycle")


@query("w12_injection_time", f"""WITH {SCAN_TABLE}, m AS (SELECT *, max(injection_time) OVER (PARTITION BY study_id, polarity) AS ceiling
  FROM st WHERE ms_level = 2 AND injection_time IS NOT NULL),
a AS (SELECT study_id, polarity, count(*) AS ms2, avg(CASE WHEN injection_time >= ceiling - 1e-9 THEN 1 ELSE 0 END) AS at_ceiling,
  median(injection_time) AS median_time, median(CASE WHEN injection_time >= ceiling - 1e-9 THEN tic END) AS ta,
  median(CASE WHEN injection_time < ceiling - 1e-9 THEN tic END) AS te FROM m GROUP BY ALL)
SELECT study_id, polarity, ms2, round(at_ceiling, 9) AS at_ceiling, round(median_time, 6) AS median_time,
  round(te / greatest(ta, 1), 6) AS tic_ratio FROM a""")
def w12(spark, d):
    out = A.injection_time_audit(scan_table(spark, d))
    return out.select("study_id", "polarity", "ms2", F.round("at_ceiling", 9).alias("at_ceiling"),
                      F.round("median_time", 6).alias("median_time"), F.round("tic_ratio", 6).alias("tic_ratio"))


def ms1(spark, d):
    """Each embedding is an MS1 scan of an injection."""
    return S.spectra(spark, d).selectExpr("'A' AS study_id", "'+' AS polarity", f"{S.SCAN_INJECTION} AS injection",
                                          "vec_id AS scan_no", f"{S.GRADIENT_RT} AS rt", "peaks")


@query("w13_survey_peaks", f"""WITH {S.cte('spectra')}
SELECT {S.SCAN_INJECTION} AS injection, vec_id AS scan_no, round(mz, 6) AS mz, round(intensity, 6) AS intensity FROM spectra_peaks""")
def w13(spark, d):
    out = A.survey_peaks(ms1(spark, d))
    return out.select("injection", "scan_no", F.round("mz", 6).alias("mz"), F.round("intensity", 6).alias("intensity"))


@query("a19_modifier", f"""WITH RECURSIVE {SC}, grid AS (SELECT DISTINCT study_id, polarity, injection, round(precursor_mz, 4) AS mz FROM scans), {series_sql('grid', 'study_id, polarity, injection', False)},
c AS (SELECT study_id, polarity, count_if(series = 'sodium formate') AS formate, count_if(series = 'sodium acetate') AS acetate FROM labelled GROUP BY ALL)
SELECT *, CASE WHEN greatest(formate, acetate) >= 30 AND (least(formate, acetate) = 0 OR greatest(formate, acetate) >= 2 * least(formate, acetate)) THEN CASE WHEN formate >= acetate THEN 'formate' ELSE 'acetate' END END AS call,
  CASE WHEN greatest(formate, acetate) = 0 THEN 'no series' WHEN greatest(formate, acetate) < 30 THEN 'too thin' WHEN least(formate, acetate) > 0 AND greatest(formate, acetate) < 2 * least(formate, acetate) THEN 'both present' ELSE '' END AS reason FROM c""")
def a19(spark, d):
    s = S.scans(spark, d).selectExpr("study_id", "polarity", "injection", "precursor_mz AS mz")
    return A.detect_modifier(s)


G_AREA = f"""{S.cte('areas', 'injections', 'scans')},
mx AS (SELECT study_id, polarity, group_id, cast(max(area) AS double) AS max_area FROM areas GROUP BY ALL),
gg AS (SELECT g.study_id, g.polarity, g.group_id, g.mz, g.rt, g.fwhm, coalesce(max_area, 0) AS max_area, g.m <> 2 AS keep,
  g.name IS NOT NULL AND g.group_id % 3 = 0 AS identified FROM groups g LEFT JOIN mx USING (study_id, polarity, group_id)),
lib AS (SELECT group_id AS entry, mz + 0.002e0 AS lib_mz, adduct FROM groups WHERE group_id % 2 = 0)"""


def area_groups(spark, d, areas=None):
    """Groups with their largest area; ``areas`` is their table, where it is at hand."""
    mx = (S.areas(spark, d) if areas is None else areas).groupBy("study_id", "polarity", "group_id").agg(F.max("area").cast("double").alias("max_area"))
    g = S.groups(spark, d).join(spread(mx), ["study_id", "polarity", "group_id"], "left").na.fill(0.0, ["max_area"])
    return g.selectExpr("study_id", "polarity", "group_id", "mz", "rt", "fwhm", "max_area", "m <> 2 AS keep",
                        "name IS NOT NULL AND group_id % 3 = 0 AS identified")


@query("j22_inclusion", f"""WITH {G_AREA},
lim AS (SELECT study_id, polarity, median(CASE WHEN identified AND max_area > 0 THEN max_area END) AS ceil, avg(fwhm) * 6 AS win FROM gg GROUP BY ALL)
SELECT gg.study_id, gg.polarity, gg.group_id, round(mz, 6) AS mz, round(rt, 6) AS rt, max_area,
  (SELECT count(*) FROM lib WHERE abs(lib_mz - gg.mz) < 0.01) AS n_matches
FROM gg JOIN lim USING (study_id, polarity) WHERE keep AND NOT identified AND max_area > 0 AND max_area < ceil
 AND NOT EXISTS (SELECT 1 FROM scans s WHERE s.study_id = gg.study_id AND s.polarity = gg.polarity
   AND abs(s.precursor_mz - gg.mz) <= 0.01 AND abs(s.rt - gg.rt) <= win)
 AND EXISTS (SELECT 1 FROM lib WHERE abs(lib_mz - gg.mz) < 0.01)""")
def j22(spark, d):
    lib = S.groups(spark, d).filter("group_id % 2 = 0").selectExpr("mz + 0.002e0 AS precursor_mz")
    out = A.inclusion_candidates(area_groups(spark, d), S.scans(spark, d), lib)
    return out.withColumn("mz", F.round("mz", 6)).withColumn("rt", F.round("rt", 6))


@query("j24_safe_exclusions", f"""WITH {WASTED}, gr2 AS (SELECT * FROM ({S.GROUPS.format(part='part')}) z),
l AS (SELECT polarity, mz + 0.002e0 AS lib_mz FROM gr2 WHERE group_id % 2 = 0),
i AS (SELECT study_id, polarity, mz AS lipid_mz FROM gr2 WHERE name IS NOT NULL),
r AS (SELECT w.study_id, w.polarity, w.mz,
  EXISTS (SELECT 1 FROM l WHERE l.polarity = w.polarity AND abs(w.mz - lib_mz) / w.mz * 1e6 <= 10) AS hits_library,
  EXISTS (SELECT 1 FROM i WHERE i.study_id = w.study_id AND i.polarity = w.polarity AND abs(w.mz - lipid_mz) / w.mz * 1e6 <= 10) AS hits_identified,
  EXISTS (SELECT 1 FROM i WHERE i.study_id = w.study_id AND i.polarity = w.polarity AND abs(w.mz - lipid_mz) <= 0.55) AS co_isolated FROM w)
SELECT study_id, polarity, round(mz, 6) AS mz, hits_library, hits_identified, co_isolated, NOT (hits_library OR hits_identified) AS safe FROM r""")
def j24(spark, d):
    g = S.groups(spark, d)
    lib = g.filter("group_id % 2 = 0").selectExpr("polarity", "mz + 0.002e0 AS lib_mz")
    idn = g.filter("name IS NOT NULL").selectExpr("study_id", "polarity", "mz AS lipid_mz")
    out = A.safe_exclusions(wasted(spark, d, False).select("study_id", "polarity", "mz"), lib, idn)
    return out.withColumn("mz", F.round("mz", 6))


@query("band_join_pairs", f"""WITH {S.cte('groups', 'scans')}
SELECT s.ms2_id, g.group_id FROM scans s JOIN groups g ON s.study_id = g.study_id AND s.polarity = g.polarity
 AND abs(s.precursor_mz - g.mz) / g.mz * 1e6 < 90 AND abs(s.rt - g.rt) <= 5.5""")
def band_pairs(spark, d):
    s = S.scans(spark, d).select("study_id", "polarity", "ms2_id", "precursor_mz", F.col("rt").alias("scan_rt"))
    g = S.groups(spark, d).select("study_id", "polarity", "group_id", "mz", "rt")
    return band_join(s, g, [Band("precursor_mz", "mz", 90.0, "ppm", strict=True), Band("scan_rt", "rt", 5.5)],
                     keys=["study_id", "polarity"], salt=4).select("ms2_id", "group_id")


@query("p28_fatty_acid_hits", f"""WITH {S.cte('scans')}, gc AS (SELECT c, d FROM range(12, 31) t(c), range(0, 7) u(d)
   WHERE d <= CASE WHEN c % 2 = 1 THEN 1 ELSE greatest(0, least(6, 1 + (c - 3) // 3)) END),
fa AS (SELECT c, d, c * 12.0e0 + (2 * c - 2 * d) * 1.0078250319e0 + 2 * 15.9949146221e0 - 1.00727646e0 AS mz FROM gc)
SELECT ms2_id, EXISTS (SELECT 1 FROM fa WHERE abs(precursor_mz - mz) <= 0.05) AS near_fatty_acid FROM scans""")
def p28(spark, d):
    grid = ions.fatty_acid_grid(spark)
    return band_exists(S.scans(spark, d).select("ms2_id", "precursor_mz"), grid, Band("precursor_mz", "fa_mz", 0.05),
                       "near_fatty_acid").select("ms2_id", "near_fatty_acid")
