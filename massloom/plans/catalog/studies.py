"""Polarity, library and comparison jobs."""

from pyspark.sql import functions as F

from massloom.functions.roles import sample_key
from massloom.operators import compare as C
from massloom.operators import library as L
from massloom.operators import polarity as P
from massloom.plans import standin as S
from massloom.plans.catalog.acquisition import area_groups
from massloom.plans.catalog.qc import SUMNAME, rank_of
from massloom.plans.catalog.spectra import library, ms2
from massloom.plans.registry import ORACLES, query

BASE = S.cte("groups")
TABLE = "tb(lipid_class, assigned) AS (SELECT DISTINCT lipid_class, CASE WHEN lipid_class IN ('PC', 'SM', 'TG') THEN '+' ELSE '-' END FROM groups WHERE b % 6 <> 7)"


def table(spark, d):
    """Class-polarity table of the stand-in classes."""
    return S.groups(spark, d).select("lipid_class").distinct().withColumn("assigned", F.when(F.col("lipid_class").isin("PC", "SM", "TG"), "+").otherwise("-"))


def ident(spark, d):
    return S.groups(spark, d).withColumn("identified", F.col("name").isNotNull())


@query("a20_validate_classes", f"""WITH {BASE}, {TABLE}, s AS (SELECT study_id, lipid_class, bool_or(polarity = '+') AS in_pos, bool_or(polarity = '-') AS in_neg, count(*) AS rows FROM groups
  WHERE name IS NOT NULL AND NOT (lipid_class = 'TG' AND polarity = '+') GROUP BY ALL),
l AS (SELECT study_id, tb.* FROM (SELECT DISTINCT study_id FROM groups) CROSS JOIN tb WHERE lipid_class <> 'SM')
SELECT study_id, lipid_class, coalesce(in_pos, false) AS in_pos, coalesce(in_neg, false) AS in_neg, coalesce(rows, 0) AS rows, assigned,
  CASE WHEN in_pos AND in_neg AND assigned IS NULL THEN 'undecided' WHEN in_pos IS NULL THEN 'stale' WHEN in_pos AND in_neg THEN 'shared' WHEN assigned IS NOT NULL THEN 'moot' ELSE 'single' END AS status
FROM s FULL JOIN l USING (study_id, lipid_class)""")
def a20(spark, d):
    g = ident(spark, d).filter("NOT (lipid_class = 'TG' AND polarity = '+')")
    return P.validate_classes(g, table(spark, d).filter("lipid_class <> 'SM'"))


@query("j27_apply_polarity", f"""WITH {BASE}, {TABLE} SELECT g.study_id, g.polarity, g.group_id, name IS NULL OR assigned = g.polarity AS polarity_kept,
  CASE WHEN name IS NOT NULL AND assigned <> g.polarity THEN 'polarity: ' || g.lipid_class || ' assigned to ' || CASE WHEN assigned = '+' THEN 'Pos' ELSE 'Neg' END ELSE '' END AS reason
FROM groups g JOIN tb USING (lipid_class)""")
def j27(spark, d):
    return P.apply_polarity(ident(spark, d), table(spark, d)).select("study_id", "polarity", "group_id", "polarity_kept", "reason")


def carry_groups(spark, d):
    """Retentions coarse enough for sum compositions of one polarity to meet chains of the other."""
    return S.groups(spark, d).withColumn("rt", F.expr("5e0 + carbons * 0.1e0 + (p_partkey % 5) * 0.06e0"))


@query("j26_carry_chains", f"""WITH {BASE}, {TABLE}, g AS (SELECT *, 5e0 + carbons * 0.1e0 + (p_partkey % 5) * 0.06e0 AS rt2, {SUMNAME} AS sn FROM groups WHERE name IS NOT NULL),
o AS (SELECT g.study_id, tb.assigned AS polarity, g.polarity AS source, name AS chains, sn, rt2 FROM g JOIN tb USING (lipid_class) WHERE name LIKE '%\\_%' ESCAPE '\\' AND tb.assigned <> g.polarity
  UNION ALL SELECT study_id, polarity, polarity, name, sn, rt2 FROM g WHERE name LIKE '%\\_%' ESCAPE '\\'),
h AS (SELECT g.study_id, g.polarity, g.group_id, o.chains, arg_min((o.source, o.rt2 - g.rt2), (abs(o.rt2 - g.rt2), o.source)) AS b FROM g JOIN o ON o.study_id = g.study_id AND o.polarity = g.polarity AND o.sn = g.name
  WHERE g.name NOT LIKE '%\\_%' ESCAPE '\\' AND abs(o.rt2 - g.rt2) <= 0.2 GROUP BY ALL)
SELECT study_id, polarity, group_id, any_value(chains) AS chains, any_value(b[1]) AS chains_from, round(any_value(b[2]), 6) + 0 AS rt_delta FROM h GROUP BY ALL HAVING count(*) = 1""")
def j26(spark, d):
    return P.carry_chains(carry_groups(spark, d), table(spark, d)).withColumn("rt_delta", F.round("rt_delta", 6) + 0)


@query("j28_polarity_agreement", f"""WITH {S.cte('areas', 'injections')}, c AS (SELECT a.*, i.grp, g.lipid_class || ' ' || g.carbons::varchar AS nm FROM areas a JOIN injections i USING (study_id, polarity, injection) JOIN groups g USING (study_id, polarity, group_id)
  WHERE area > 0 AND g.name IS NOT NULL),
p AS (SELECT study_id, polarity, group_id, nm, avg(CASE WHEN grp = 'control' THEN log2(area) END) - avg(CASE WHEN grp = 'case' THEN log2(area) END) AS ch FROM c GROUP BY ALL),
m AS (SELECT study_id, polarity, nm, median(ch) AS ch FROM p WHERE ch IS NOT NULL GROUP BY ALL),
b AS (SELECT x.study_id, x.nm, x.ch AS pos, y.ch AS neg FROM m x JOIN m y ON x.study_id = y.study_id AND x.nm = y.nm AND x.polarity = '+' AND y.polarity = '-'),
k AS (SELECT *, {rank_of('study_id', 'pos')} AS rp, {rank_of('study_id', 'neg')} AS rn FROM b)
SELECT study_id, 'case' AS base, 'control' AS level, count(*) AS shared, round(corr(rp, rn), 9) AS rho, count_if(pos * neg < 0) AS opposite, round(count_if(pos * neg < 0) / count(*), 9) AS opposite_fraction FROM k GROUP BY ALL""")
def j28(spark, d):
    g = S.groups(spark, d).withColumn("name", F.when(F.col("name").isNotNull(), F.concat("lipid_class", F.lit(" "), F.col("carbons").cast("string"))))
    out = P.polarity_agreement(P.fold_changes(S.areas(spark, d), g, S.injections(spark, d), "grp"))[1]
    return out.withColumn("rho", F.round("rho", 9)).withColumn("opposite_fraction", F.round("opposite_fraction", 9))


@query("k6_combine", f"""WITH {S.cte('areas')} SELECT study_id, polarity, group_id, injection AS sample, area, CASE WHEN polarity = '+' THEN 'Pos' ELSE 'Neg' END AS mode FROM areas""")
def k6(spark, d):
    a = S.areas(spark, d).withColumn("injection", F.concat("injection", F.when(F.col("polarity") == "+", "_Pos").otherwise("_neg")))
    key = F.regexp_replace("injection", "(?i)_(pos|neg)$", "")
    return P.combine(S.groups(spark, d).select("study_id", "polarity", "group_id"), a, key).select("study_id", "polarity", "group_id", "sample", "area", "mode")


@query("j47_resolve_injection", f"""WITH {S.cte('injections')}, i AS (SELECT DISTINCT study_id, injection || '_Pos' AS injection, injection AS base, inj_id FROM injections)
SELECT study_id, injection, 'arm' || (inj_id % 2)::varchar AS arm, CASE WHEN inj_id % 4 = 0 THEN 'exact' ELSE 'sample key' END AS matched_by FROM i""")
def j47(spark, d):
    i = S.injections(spark, d).select("study_id", "injection", "inj_id").distinct()
    names = i.selectExpr("study_id", "if(inj_id % 4 = 0, concat(injection, '_Pos'), injection) AS name", "concat('arm', inj_id % 2) AS arm")
    return P.resolve_injection(names, i.select("study_id", F.concat("injection", F.lit("_Pos")).alias("injection")), sample_key(F.col("name")))


# ---- library ----------------------------------------------------------------------------------

LIBN = f"""{S.cte('spectra')}, lb AS (SELECT vec_id, label, precursor_mz, CASE WHEN vec_id % 10 = 0 THEN 'DECOY_ ' ELSE '' END || 'PC ' || (14 + label % 9)::varchar || ':0_18:' || (label % 4)::varchar AS lipid FROM spectra WHERE is_library),
top AS (SELECT vec_id, max(intensity) AS top FROM spectra_peaks GROUP BY ALL), kp AS (SELECT p.vec_id, p.k, mz FROM spectra_peaks p JOIN top USING (vec_id) WHERE is_library AND intensity / top * 999 >= 5)"""


@query("f8_make_decoys", f"""WITH {LIBN} SELECT vec_id AS entry_seq, 'DECOY_ ' || any_value(lipid) || ' [M-H]-;' AS name, count(*) AS n_peaks, round(sum(round(mz + 2 * 14.015650e0, 4)), 3) AS sum_mz FROM kp JOIN lb USING (vec_id) GROUP BY ALL""")
def f8(spark, d):
    out = L.make_decoys(library(spark, d), 2)
    return out.select("entry_seq", "name", F.size("peaks").cast("long").alias("n_peaks"), F.round(F.aggregate(F.col("peaks.mz"), F.lit(0.0), lambda a, x: a + x), 3).alias("sum_mz"))


def plain_library(spark, d):
    return library(spark, d).withColumn("peaks", F.transform("peaks", lambda p: p.withField("annotation", F.lit("Head_[]")).withField("chain", F.lit(""))))


@query("f8_head_group_decoys", f"""WITH {LIBN} SELECT vec_id AS entry_seq, count(*) AS n_peaks, round(sum(round(mz + 6.3721e0, 4)), 3) AS sum_mz FROM kp GROUP BY ALL""")
def f8h(spark, d):
    out = L.head_group_decoys(plain_library(spark, d))
    return out.select("entry_seq", F.size("peaks").cast("long").alias("n_peaks"), F.round(F.aggregate(F.col("peaks.mz"), F.lit(0.0), lambda a, x: a + x), 3).alias("sum_mz"))


@query("j33_screen_decoys")
def j33(spark, d):
    lib = library(spark, d)
    return L.screen_decoys(L.make_decoys(lib.filter("entry_seq % 10 <> 0"), 1), lib.filter("entry_seq % 10 <> 0"))


@query("j34_infer_chain_peaks")
def j34(spark, d):
    lib = plain_library(spark, d).selectExpr("concat('X ', cast(14 + entry_seq % 9 AS string), ':0_18:', cast(entry_seq % 4 AS string)) AS name",
                                             "transform(peaks, (p, i) -> named_struct('mz', round(p.mz + if(i % 3 = 0, 14.01565e0 * (entry_seq % 9), 0e0), 4), 'intensity', p.intensity)) AS peaks").dropDuplicates(["name"])
    return L.infer_chain_peaks(lib).select("name", F.size("moved").alias("n_moved"))


@query("j35_holdout", f"""WITH {LIBN} SELECT vec_id AS entry_seq FROM lb WHERE lipid LIKE 'DECOY%' OR label % 5 <> 2""")
def j35(spark, d):
    lib = library(spark, d)
    held = S.spectra(spark, d).filter("label % 5 = 2").selectExpr("concat('PC ', cast(32 + label % 9 AS string), ':', cast(label % 4 AS string)) AS name").distinct()
    keep = L.holdout(lib, held)
    return keep.select("entry_seq")


@query("p23_exclude_classes", f"""WITH {S.cte('groups')} SELECT group_id FROM groups WHERE name IS NOT NULL AND lipid_class NOT IN ('TG', 'SM')""")
def p23(spark, d):
    from massloom.operators.search import exclude_classes
    lib = S.groups(spark, d).filter("name IS NOT NULL").selectExpr("group_id", "concat(if(group_id % 2 = 0, 'DECOY_ ', ''), name, ' ', adduct) AS name")
    return exclude_classes(lib, ["tg", "SM"]).select("group_id")


def recipes(spark, d):
    """One recipe per class that the given table names, one or two chains, sizes from its own rows."""
    g = S.groups(spark, d).groupBy("lipid_class").agg((14 + F.max("carbons") % 3).cast("int").alias("c_min"), F.max("carbons").alias("c"))
    return g.selectExpr("lipid_class", "'[M+NH4]+' AS adduct", "if(lipid_class IN ('PC', 'PE', 'TG'), 2, 1) AS n_chains", "c_min", "22 AS c_max", "4 AS db_max",
                        "92.0473441e0 AS base_mass", "13.9792642e0 AS chain_mass", "18.0338254e0 AS adduct_mass",
                        "array(named_struct('loss', 35.0371149e0, 'intensity', 999e0, 'annotation', 'N-1H-5O-1_Neutral Loss_[]')) AS losses", "if(lipid_class IN ('PC', 'PE', 'TG'), 49.0163800e0, null) AS chain_loss")


@query("f9_enumerate_library", """WITH g AS (SELECT DISTINCT lc FROM (VALUES ('x')) t(lc)), rc AS (SELECT lipid_class, cast(14 + max(carbons) % 3 AS int) AS c_min, CASE WHEN lipid_class IN ('PC', 'PE', 'TG') THEN 2 ELSE 1 END AS nc FROM gr GROUP BY ALL),
ch AS (SELECT c, dd FROM range(12, 23) a(c), range(0, 5) b(dd) WHERE dd <= CASE WHEN c % 2 = 1 THEN 1 ELSE greatest(0, least(6, 1 + (c - 3) // 3)) END),
e AS (SELECT lipid_class, lipid_class || ' ' || c::varchar || ':' || dd::varchar AS lipid, 92.0473441e0 + c * 12.0e0 + (2 * c - 2 * dd) * 1.0078250319e0 + 13.9792642e0 + 18.0338254e0 AS mz FROM rc JOIN ch ON c >= c_min WHERE nc = 1
 UNION ALL SELECT lipid_class, lipid_class || ' ' || x.c::varchar || ':' || x.dd::varchar || '_' || y.c::varchar || ':' || y.dd::varchar, 92.0473441e0 + (x.c + y.c) * 12.0e0 + (2 * (x.c + y.c) - 2 * (x.dd + y.dd)) * 1.0078250319e0 + 2 * 13.9792642e0 + 18.0338254e0
  FROM rc JOIN ch x ON x.c >= c_min JOIN ch y ON y.c > x.c OR (y.c = x.c AND y.dd >= x.dd) WHERE nc = 2)
SELECT lipid_class, lipid, round(mz, 6) AS precursor_mz FROM e""".replace("WITH g AS (SELECT DISTINCT lc FROM (VALUES ('x')) t(lc)),", f"WITH gr AS ({S.GROUPS.format(part='part')}),"))
def f9(spark, d):
    return L.enumerate_library(recipes(spark, d)).select("lipid_class", "lipid", F.round("precursor_mz", 6).alias("precursor_mz"))


@query("j50_verify_enumeration", f"""SELECT lipid || ' [M+NH4]+' AS name, 'precursor' AS problem, round(precursor_mz, 4) AS mine, round(precursor_mz + 0.01, 4) AS theirs FROM ({ORACLES['f9_enumerate_library']}) e WHERE cast(floor(precursor_mz) AS bigint) % 7 = 0""")
def j50(spark, d):
    e = L.enumerate_library(recipes(spark, d))
    off = e.withColumn("precursor_mz", F.when(F.floor("precursor_mz") % 7 == 0, F.col("precursor_mz") + 0.01).otherwise(F.col("precursor_mz")))
    return L.verify_enumeration(e, off).select("name", "problem", F.round("mine", 4).alias("mine"), F.round("theirs", 4).alias("theirs"))


@query("f10_import_class", f"""WITH {LIBN} SELECT vec_id AS entry_seq, 'BA ' || vec_id::varchar || ':1;O4_16:0' AS name FROM kp WHERE vec_id % 2 = 0 GROUP BY vec_id HAVING count(*) >= 3""")
def f10(spark, d):
    lib = library(spark, d).withColumn("compound_class", F.when(F.col("entry_seq") % 2 == 0, "BileAcid").otherwise("Other")).withColumn(
        "name", F.concat(F.lit("ST "), F.col("entry_seq").cast("string"), F.lit(":1;4O/(FA 16:0)")))
    return L.import_class(lib, "BileAcid|BASulfate", ("ST", "BA")).select("entry_seq", "name")


# ---- comparisons ------------------------------------------------------------------------------

@query("j36_fragmentation_audit", f"""WITH {S.cte('groups', 'scans')}, mv(kind, dm, dt) AS (VALUES ('real', 0e0, 0e0), ('decoy m/z', 3.111e0, 0e0), ('decoy m/z', -3.111e0, 0e0), ('decoy m/z', 7.377e0, 0e0), ('decoy m/z', -7.377e0, 0e0), ('decoy RT', 0e0, 4e0), ('decoy RT', 0e0, -4e0)),
p AS (SELECT g.study_id, g.polarity, g.group_id, CASE WHEN name IS NULL THEN 'unidentified' ELSE 'MS2' END AS evidence, kind, mz + dm AS pm, rt + dt AS pr FROM groups g CROSS JOIN mv),
h AS (SELECT *, EXISTS (SELECT 1 FROM scans s WHERE s.study_id = p.study_id AND s.polarity = p.polarity AND abs(pm - s.precursor_mz) / pm * 1e6 <= 100.01 AND abs(pr - s.rt) <= 1.0) AS hit FROM p)
SELECT study_id, polarity, evidence, kind, count(*) AS n, count_if(hit) AS fragmented, round(count_if(hit) / count(*), 9) AS share FROM h GROUP BY ALL""")
def j36(spark, d):
    g = S.groups(spark, d).withColumn("evidence", F.when(F.col("name").isNull(), "unidentified").otherwise("MS2"))
    return C.fragmentation_audit(g, S.scans(spark, d), ppm=100.0, rt_tol=1.0).withColumn("share", F.round("share", 9))


@query("j36_failed_spectra", f"""WITH {S.cte('groups', 'spectra')}, sp AS (SELECT CASE WHEN vec_id % 4 < 2 THEN 'A' ELSE 'B' END AS study_id, CASE WHEN vec_id % 2 = 0 THEN '+' ELSE '-' END AS polarity, vec_id, any_value(precursor_mz) AS pm, (vec_id % 997) / 40e0 AS rt, sum(intensity) AS tic, count(*) AS np,
  coalesce(sum(intensity) FILTER (abs(mz - CASE WHEN vec_id % 2 = 0 THEN 178.295e0 ELSE 97.473e0 END) < 0.01), 0) AS art FROM spectra_peaks WHERE NOT is_library GROUP BY vec_id),
g AS (SELECT study_id, polarity, CASE WHEN name IS NULL THEN 'unidentified' ELSE 'MS2' END AS evidence, 760e0 + m * 0.004e0 AS mz, rt FROM groups)
SELECT g.study_id, g.polarity, evidence, count(*) AS spectra, round(median(tic), 6) AS median_tic, median(np) AS median_peaks, round(median(art / tic), 6) AS artefact_share
FROM sp JOIN g ON g.study_id = sp.study_id AND g.polarity = sp.polarity AND abs(pm - mz) / mz * 1e6 <= 10 AND abs(sp.rt - g.rt) <= 0.5 WHERE tic > 0 GROUP BY ALL""")
def j36f(spark, d):
    g = S.groups(spark, d).withColumn("mz", F.lit(760.0) + F.col("m") * 0.004).withColumn("evidence", F.when(F.col("name").isNull(), "unidentified").otherwise("MS2"))
    spread = ms2(spark, d).withColumn("study_id", F.when(F.col("ms2_id") % 4 < 2, "A").otherwise("B")).withColumn("polarity", F.when(F.col("ms2_id") % 2 == 0, "+").otherwise("-"))
    out = C.failed_spectra(g, spread, {"+": 178.295, "-": 97.473}, rt_tol=0.5)
    for c in ("median_tic", "artefact_share"):
        out = out.withColumn(c, F.round(c, 6))
    return out


def missing_inputs(spark, d):
    g = S.groups(spark, d)
    ours = g.filter("p_partkey % 3 = 0")
    unf = g.filter("p_partkey % 2 = 0").withColumn("reason", F.when(F.col("m") > 10, "Blank").otherwise("")).withColumn(
        "name", F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("X"), "name")).otherwise(F.col("name")))
    hits = g.filter("p_partkey % 5 = 0 AND name IS NOT NULL").withColumn("name", F.concat("name", F.lit(" "), "adduct"))
    return g.filter("name IS NOT NULL"), ours, unf, hits


@query("j37_trace_missing", f"""WITH {BASE}, s AS (SELECT *, {SUMNAME} AS sn FROM groups WHERE name IS NOT NULL),
fr AS (SELECT study_id, polarity, sn, arg_min((mz, rt), group_id) AS p FROM s GROUP BY ALL), gone AS (SELECT * FROM fr WHERE NOT EXISTS (SELECT 1 FROM s WHERE p_partkey % 3 = 0 AND s.study_id = fr.study_id AND s.polarity = fr.polarity AND s.sn = fr.sn)),
u AS (SELECT study_id, polarity, group_id, mz, rt, CASE WHEN p_partkey % 4 = 0 THEN 'X' ELSE '' END || sn AS us, CASE WHEN p_partkey % 4 = 0 THEN 'X' ELSE '' END || name AS un, CASE WHEN m > 10 THEN 'Blank' ELSE 'kept' END AS why FROM s WHERE p_partkey % 2 = 0),
n AS (SELECT gone.study_id, gone.polarity, sn, arg_max(why, group_id) FILTER (us = sn) AS why, arg_min(un, group_id) FILTER (us <> sn) AS un FROM gone JOIN u ON u.study_id = gone.study_id AND u.polarity = gone.polarity AND abs(u.mz - p[1]) <= 0.01 AND abs(u.rt - p[2]) <= 0.5 GROUP BY ALL)
SELECT study_id, polarity, sn AS sum_name, CASE WHEN why IS NOT NULL THEN 'filtered: ' || why WHEN EXISTS (SELECT 1 FROM s WHERE p_partkey % 5 = 0 AND s.study_id = gone.study_id AND s.polarity = gone.polarity AND s.sn = gone.sn) THEN 'identified, no feature'
  WHEN un IS NOT NULL THEN 'named differently: ' || un ELSE 'never fragmented' END AS verdict FROM gone LEFT JOIN n USING (study_id, polarity, sn)""")
def j37(spark, d):
    return C.trace_missing(*missing_inputs(spark, d))


@query("j38_compare_results", f"""WITH {BASE}, s AS (SELECT *, {SUMNAME} AS sn FROM groups WHERE name IS NOT NULL),
k AS (SELECT study_id, polarity, 'molecule' AS level, sn AS k, bool_or(p_partkey % 3 = 0) AS o, bool_or(p_partkey % 2 = 0) AS r FROM s WHERE p_partkey % 3 = 0 OR p_partkey % 2 = 0 GROUP BY ALL
 UNION ALL SELECT study_id, polarity, 'exact', name, bool_or(p_partkey % 3 = 0), bool_or(p_partkey % 2 = 0) FROM s WHERE p_partkey % 3 = 0 OR p_partkey % 2 = 0 GROUP BY ALL),
c AS (SELECT *, split_part(k, ' ', 1) AS lipid_class FROM k)
SELECT study_id, polarity, level, lipid_class, count_if(o) AS ours, count_if(r) AS reference, count_if(o AND r) AS shared FROM c GROUP BY GROUPING SETS ((study_id, polarity, level, lipid_class), (study_id, polarity, level))""")
def j38(spark, d):
    g = S.groups(spark, d)
    return C.compare_results(g.filter("p_partkey % 3 = 0"), g.filter("p_partkey % 2 = 0"))


@query("j38_recovery_split", f"""WITH {BASE}, s AS (SELECT *, {SUMNAME} AS sn FROM groups WHERE name IS NOT NULL), o AS (SELECT DISTINCT study_id, polarity, sn FROM s WHERE p_partkey % 3 = 0),
r AS (SELECT DISTINCT study_id, polarity, sn FROM s WHERE p_partkey % 2 = 0),
f AS (SELECT r.*, EXISTS (SELECT 1 FROM o WHERE o.study_id = r.study_id AND o.polarity = r.polarity AND o.sn = r.sn) AS h, EXISTS (SELECT 1 FROM o WHERE o.study_id = r.study_id AND o.polarity <> r.polarity AND o.sn = r.sn) AS t FROM r)
SELECT study_id, polarity, CASE WHEN h THEN 'recovered' WHEN sn LIKE 'SM%' THEN 'standard' WHEN t THEN 'other polarity' ELSE 'absent' END AS fate, count(*) AS molecules FROM f GROUP BY ALL""")
def j38s(spark, d):
    g = S.groups(spark, d)
    return C.recovery_split(g.filter("p_partkey % 2 = 0"), g.filter("p_partkey % 3 = 0"), "SM")


@query("j39_list_agreement", f"""WITH {BASE}, s AS (SELECT study_id, p_partkey, replace({SUMNAME}, 'GlcCer', 'HexCer') AS sp, CASE WHEN name LIKE '%\\_%' ESCAPE '\\' THEN replace(lipid_class, 'GlcCer', 'HexCer') || ' ' || array_to_string(list_sort(string_split(split_part(name, ' ', 2), '_')), '_') END AS mol FROM groups WHERE name IS NOT NULL),
k AS (SELECT study_id, 'species' AS level, sp AS key, bool_or(p_partkey % 2 = 0) AS p, bool_or(p_partkey % 3 = 0) AS o FROM s WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0 GROUP BY ALL
 UNION ALL SELECT study_id, 'molecular', mol, bool_or(p_partkey % 2 = 0), bool_or(p_partkey % 3 = 0) FROM s WHERE mol IS NOT NULL AND (p_partkey % 2 = 0 OR p_partkey % 3 = 0) GROUP BY ALL)
SELECT study_id, level, count_if(p) AS published, count_if(o) AS ours, count_if(p AND o) AS shared, round(100 * count_if(p AND o) / count_if(p), 6) AS of_theirs, round(100 * count_if(p AND o) / count_if(o), 6) AS of_ours, 'ok' AS status FROM k GROUP BY ALL""")
def j39(spark, d):
    g = S.groups(spark, d).filter("name IS NOT NULL")
    pub = g.filter("p_partkey % 2 = 0").select("study_id", F.translate("name", "_", "/").alias("name"))
    pub = pub.union(pub.select("study_id", F.concat("name", F.lit(" (d7)"))))
    out = C.list_agreement(pub, g.filter("p_partkey % 3 = 0").select("study_id", "name"))
    return out.withColumn("of_theirs", F.round("of_theirs", 6)).withColumn("of_ours", F.round("of_ours", 6))


def species_inputs(spark, d):
    g = area_groups(spark, d).select("group_id", F.col("max_area").alias("area"))
    return S.groups(spark, d).join(g, "group_id").withColumn("source", F.when(F.col("m") == 3, "RT model").otherwise("MS2")).withColumn("cv", F.lit(10.0))


def consensus(spark, d):
    from massloom.functions.names import family_key, sum_composition
    g = S.groups(spark, d).filter("name IS NOT NULL AND p_partkey % 2 = 0").withColumn("k", family_key(sum_composition(F.col("name"))))
    return g.selectExpr("k.family AS family", "k.kind AS kind", "k.carbons AS carbons", "k.double_bonds AS double_bonds").distinct().withColumn(
        "grp", F.col("carbons") % 7 * 10 + F.col("double_bonds")).withColumn("tier", F.when(F.col("carbons") % 2 == 0, "Ref").otherwise("Inf")).withColumn("value", F.col("carbons") * 1.5 + F.col("double_bonds") * 7 % 5)


SPECIES = f"""{S.cte('areas')}, mx AS (SELECT group_id, max(area)::double AS area FROM areas GROUP BY ALL), s AS (SELECT g.*, coalesce(area, 0) AS area, {SUMNAME} AS sn FROM groups g LEFT JOIN mx USING (group_id) WHERE name IS NOT NULL),
k AS (SELECT *, CASE split_part(sn, ' ', 1) WHEN 'Cer[NS]' THEN 'Cer' WHEN 'GlcCer[NS]' THEN 'HexCer' ELSE split_part(sn, ' ', 1) END AS family, m <> 3 AS is_ms2 FROM s),
sp AS (SELECT study_id, family, carbons, double_bonds, arg_max((is_ms2, area, polarity), (is_ms2, area)) AS best FROM k GROUP BY ALL),
co AS (SELECT DISTINCT family, carbons, double_bonds, carbons % 7 * 10 + double_bonds AS grp, CASE WHEN carbons % 2 = 0 THEN 'Ref' ELSE 'Inf' END AS tier, carbons * 1.5 + double_bonds * 7 % 5 AS value FROM k WHERE p_partkey % 2 = 0)"""


@query("j40_consensus_recall", f"""WITH {SPECIES}, en AS (SELECT grp, tier, max(family) AS entry_family FROM co GROUP BY ALL),
fo AS (SELECT study_id, grp, tier, bool_or(best[1]) AS ms2 FROM co JOIN sp USING (family, carbons, double_bonds) GROUP BY ALL)
SELECT st.study_id, en.tier, entry_family, count(*) AS entries, count_if(coalesce(ms2, false)) AS ms2, count(ms2) AS any_source FROM en CROSS JOIN (SELECT DISTINCT study_id FROM sp) st LEFT JOIN fo ON fo.study_id = st.study_id AND fo.grp = en.grp AND fo.tier = en.tier
WHERE entry_family IN ('PC', 'PE', 'TG', 'SM', 'Cer', 'HexCer') GROUP BY ALL""")
def j40(spark, d):
    return C.consensus_score(C.species_table(species_inputs(spark, d)), consensus(spark, d), ["PC", "PE", "TG", "SM", "Cer", "HexCer"])[0]


@query("j40_consensus_precision", f"""WITH {BASE}, s AS (SELECT *, {SUMNAME} AS sn FROM groups WHERE name IS NOT NULL), k AS (SELECT *, CASE split_part(sn, ' ', 1) WHEN 'Cer[NS]' THEN 'Cer' WHEN 'GlcCer[NS]' THEN 'HexCer' ELSE split_part(sn, ' ', 1) END AS family, split_part(sn, ' ', 2) AS cd FROM s),
sp AS (SELECT study_id, family, cd, CASE WHEN bool_or(m <> 3) THEN 'MS2' ELSE 'RT model' END AS source FROM k GROUP BY ALL), ls AS (SELECT DISTINCT family, cd FROM k WHERE p_partkey % 2 = 0)
SELECT study_id, family, source, count(*) AS species, count_if((family, cd) IN (SELECT (family, cd) FROM ls)) AS listed FROM sp WHERE family IN (SELECT family FROM ls) GROUP BY ALL""")
def j40p(spark, d):
    return C.consensus_score(C.species_table(species_inputs(spark, d)), consensus(spark, d), ["PC"])[1]


@query("j40_consensus_quant", f"""WITH {SPECIES}, pt AS (SELECT study_id, family, best[3] AS polarity, value, best[2] AS area FROM co JOIN sp USING (family, carbons, double_bonds) WHERE tier = 'Ref' AND best[1] AND best[2] > 0),
pl AS (SELECT study_id, family, arg_max(polarity, (n, polarity)) AS polarity FROM (SELECT study_id, family, polarity, count(*) AS n FROM pt GROUP BY ALL) GROUP BY ALL), kp AS (SELECT pt.* FROM pt JOIN pl USING (study_id, family, polarity)),
r AS (SELECT *, {rank_of('study_id, family', 'value')} AS rv, {rank_of('study_id, family', 'area')} AS ra FROM kp)
SELECT study_id, family, round(coalesce(CASE WHEN max(rv) > min(rv) AND max(ra) > min(ra) THEN corr(rv, ra) END, 0), 6) AS rho, count(*) AS n FROM r GROUP BY ALL HAVING count(*) >= 5""")
def j40q(spark, d):
    return C.consensus_quant(C.species_table(species_inputs(spark, d)), consensus(spark, d)).withColumn("rho", F.round("rho", 6))


@query("j41_miss_reasons", f"""WITH {BASE}, s AS (SELECT *, replace({SUMNAME}, 'GlcCer', 'HexCer') AS sp FROM groups WHERE name IS NOT NULL), k AS (SELECT *, split_part(split_part(sp, ' ', 1), '[', 1) AS cls FROM s),
ms AS (SELECT study_id, sp, any_value(cls) AS cls, any_value(carbons) AS carbons, min(CASE WHEN p_partkey % 13 = 0 THEN 0.5e0 ELSE rt END) AS rt FROM k WHERE p_partkey % 2 = 0 AND NOT EXISTS (SELECT 1 FROM k o WHERE o.p_partkey % 3 = 0 AND o.study_id = k.study_id AND o.sp = k.sp) GROUP BY ALL),
lb AS (SELECT * FROM k WHERE p_partkey % 5 <> 0 AND lipid_class <> 'SM')
SELECT study_id, sp AS species, CASE WHEN (cls = 'TG' AND carbons < 34) OR (cls = 'PC' AND carbons < 31) THEN 'chemically impossible' WHEN rt <= 1 THEN 'void' WHEN cls NOT IN (SELECT cls FROM lb) THEN 'class absent' WHEN sp NOT IN (SELECT sp FROM lb) THEN 'species absent'
  WHEN NOT EXISTS (SELECT 1 FROM lb WHERE lb.sp = ms.sp AND NOT (ms.study_id = 'B' AND lb.polarity = '-')) THEN 'wrong polarity' ELSE 'not detected' END AS reason FROM ms""")
def j41(spark, d):
    g = S.groups(spark, d).filter("name IS NOT NULL")
    pub = g.filter("p_partkey % 2 = 0").selectExpr("study_id", "name", "if(p_partkey % 13 = 0, 0.5e0, rt) AS rt")
    lib = g.filter("p_partkey % 5 <> 0 AND lipid_class <> 'SM'").selectExpr("concat(name, ' ', adduct) AS name", "polarity")
    runs = g.filter("NOT (study_id = 'B' AND polarity = '-')").select("study_id", "polarity").distinct()
    return C.miss_reasons(pub, g.filter("p_partkey % 3 = 0").select("study_id", "name"), lib, {"TG": 34, "PC": 31}, runs)


@query("j42_quant_agreement", f"""WITH {S.cte('areas')}, a AS (SELECT a.study_id, a.injection AS sample, area, {SUMNAME.replace('name', 'g.name')} AS sn, p_partkey FROM areas a JOIN groups g USING (study_id, polarity, group_id) WHERE g.name IS NOT NULL),
o AS (SELECT study_id, sn, sample, median(area) AS b FROM a WHERE p_partkey % 2 = 0 GROUP BY ALL), r AS (SELECT study_id, sn, sample, median(area * (1 + p_partkey % 3)) AS a FROM a WHERE p_partkey % 3 <> 0 GROUP BY ALL)
SELECT study_id, sn AS sum_name, count(*) AS n, round(corr(log10(a), log10(b)), 9) AS r, round(median(b / a), 9) AS ratio FROM o JOIN r USING (study_id, sn, sample) WHERE a > 0 AND b > 0 GROUP BY ALL HAVING count(*) >= 5""")
def j42(spark, d):
    a = S.areas(spark, d).join(S.groups(spark, d).select("group_id", "name", "p_partkey"), "group_id").filter("name IS NOT NULL").withColumnRenamed("injection", "sample")
    out = C.quant_agreement(a.filter("p_partkey % 2 = 0"), a.filter("p_partkey % 3 <> 0").withColumn("area", F.col("area") * (1 + F.col("p_partkey") % 3)))
    return out.withColumn("r", F.round("r", 9)).withColumn("ratio", F.round("ratio", 9))


@query("j42_rt_agreement", f"""WITH {BASE}, s AS (SELECT study_id, group_id, p_partkey, {SUMNAME} AS sp, 5e0 + carbons * 0.1e0 + (p_partkey % 5) * 0.2e0 AS rt FROM groups WHERE name IS NOT NULL),
p AS (SELECT study_id, sp, median(rt) AS there FROM s WHERE p_partkey % 2 = 0 GROUP BY ALL), o AS (SELECT study_id, sp, arg_min((rt, p_partkey % 5), group_id) AS x FROM s GROUP BY ALL),
d AS (SELECT study_id, abs(x[1] - there) AS d, x[2] >= 2 AS flagged FROM o JOIN p USING (study_id, sp))
SELECT study_id, count(*) AS shared, round(median(d), 6) AS median_gap, round(max(d), 6) AS max_gap, round(avg(CASE WHEN d > 0.5 THEN 0 ELSE 1 END), 6) AS within, count_if(flagged) AS flagged, count_if(flagged AND d > 0.5) AS flagged_bad, count_if(NOT flagged) AS clean, count_if(NOT flagged AND d > 0.5) AS clean_bad FROM d GROUP BY ALL""")
def j42r(spark, d):
    g = S.groups(spark, d).filter("name IS NOT NULL").withColumn("rt", F.expr("5e0 + carbons * 0.1e0 + (p_partkey % 5) * 0.2e0")).withColumn("rt_z", (F.col("p_partkey") % 5).cast("double"))
    out = C.rt_agreement(g, g.filter("p_partkey % 2 = 0").select("study_id", "name", "rt"))
    for c in ("median_gap", "max_gap", "within"):
        out = out.withColumn(c, F.round(c, 6))
    return out


def elution(spark, d):
    from massloom.functions.roles import elution_volume
    return S.groups(spark, d).filter("name IS NOT NULL").withColumn("ev", elution_volume(F.col("rt"), F.lit(260.0)))


@query("j43_coisolation", f"""WITH {BASE}, e AS (SELECT *, rt * 260.0e0 AS ev FROM groups WHERE name IS NOT NULL)
SELECT a.study_id, a.polarity, a.group_id, count(b.group_id) AS neighbours FROM e a LEFT JOIN e b ON b.study_id = a.study_id AND b.polarity = a.polarity AND b.group_id <> a.group_id AND abs(a.ev - b.ev) <= 150 AND abs(a.mz - b.mz) <= 25 GROUP BY ALL""")
def j43(spark, d):
    return C.coisolation(elution(spark, d), 150.0, 25.0)


@query("a36_method_summary", f"""WITH {BASE}, e AS (SELECT *, rt * 260.0e0 AS ev FROM groups WHERE name IS NOT NULL), g AS (SELECT *, ev - lag(ev) OVER (PARTITION BY study_id, polarity ORDER BY ev) AS gap FROM e)
SELECT study_id, polarity, count(*) AS n, round(quantile_cont(rt, 0.99) - quantile_cont(rt, 0.01), 6) AS window_min, round(quantile_cont(ev, 0.99) - quantile_cont(ev, 0.01), 4) AS window_ul, round(median(gap), 6) AS median_gap_ul FROM g GROUP BY ALL""")
def a36(spark, d):
    out = C.method_summary(elution(spark, d), 25.0)
    return out.select("study_id", "polarity", "n", F.round("window_min", 6).alias("window_min"), F.round("window_ul", 4).alias("window_ul"), F.round("median_gap_ul", 6).alias("median_gap_ul"))


def ion_list(spark, d):
    return S.groups(spark, d).selectExpr("polarity", "concat('L', group_id) AS name", "500e0 + (b % 400) * 0.503e0 + (m % 4) * 0.011e0 AS mz")


@query("j44_resolution_at_risk", f"""WITH {BASE}, i AS (SELECT DISTINCT polarity, 'L' || group_id::varchar AS name, 500e0 + (b % 400) * 0.503e0 + (m % 4) * 0.011e0 + k * 1.0033548e0 AS mz, k FROM groups, range(0, 3) t(k))
SELECT a.polarity, a.name AS name_a, cast(a.k AS int) AS iso_a, b.name AS name_b, cast(b.k AS int) AS iso_b, round(b.mz - a.mz, 7) AS delta FROM i a JOIN i b ON a.polarity = b.polarity AND b.mz > a.mz AND a.name <> b.name
 AND b.mz - a.mz <= a.mz / (60000e0 * sqrt(200 / a.mz)) AND b.mz - a.mz > a.mz / (120000e0 * sqrt(200 / a.mz))""")
def j44(spark, d):
    return C.resolution_at_risk(ion_list(spark, d)).select("polarity", "name_a", "iso_a", "name_b", "iso_b", F.round("delta", 7).alias("delta"))


@query("a38_paired_methods", f"""WITH {S.cte('groups', 'scans')}, ex AS (SELECT polarity, precursor_mz AS em FROM scans WHERE inj_id IN (0, 1)), s AS (SELECT CASE WHEN inj_id % 2 = 0 THEN 'with lists' ELSE 'without lists' END AS arm, polarity, EXISTS (SELECT 1 FROM ex WHERE ex.polarity = scans.polarity AND abs(precursor_mz - em) / precursor_mz * 1e6 <= 10) AS hit FROM scans)
SELECT arm, polarity, count(*) AS ms2_scans, round(avg(CASE WHEN hit THEN 1 ELSE 0 END), 9) AS on_excluded_mass FROM s GROUP BY ALL""")
def a38(spark, d):
    s = S.scans(spark, d).selectExpr("if(inj_id % 2 = 0, 'with lists', 'without lists') AS arm", "polarity", "precursor_mz")
    ex = S.scans(spark, d).filter("inj_id IN (0, 1)").selectExpr("polarity", "precursor_mz AS ex_mz")
    rows = S.groups(spark, d).selectExpr("if(group_id % 2 = 0, 'with lists', 'without lists') AS arm", "polarity", "name", "if(m = 3, 'RT model', 'MS2') AS source")
    return C.paired_methods(s, ex, rows).select("arm", "polarity", "ms2_scans", F.round("on_excluded_mass", 9).alias("on_excluded_mass"))
