"""Association, vote, purity, redundancy rules, names inside a table."""

from pyspark.sql import functions as F

from massloom.functions import ions
from massloom.functions.peaks import FWHM_TO_SIGMA, GAUSS_BASE
from massloom.operators import groups as G
from massloom.operators.band import apart, spread
from massloom.plans import standin as S
from massloom.plans.catalog.acquisition import area_groups
from massloom.plans.catalog.matrix import CELLS
from massloom.plans.catalog.qc import SUMNAME, rank_of
from massloom.plans.registry import query
from massloom.session import cut_lineage, next_round

BASE = S.cte("groups")
# wider peaks than the stand-in's, so the sweep window holds its planted pairs
WIDE = f"""{BASE}, w AS (SELECT *, 0.4e0 AS fw FROM groups)"""
ADD = """ad(adduct, adduct_rank, adduct_mass, pol) AS (VALUES ('[M+H]+', 0, 1.007825035e0, '+'), ('[M+Ac-H]-', 1, 2 * 12.0e0 + 3 * 1.007825035e0 + 2 * 15.99491463e0, '-'),
 ('[M-H]-', 2, -1.007825035e0, '-'), ('[M+NH4]+', 3, 14.003074e0 + 4 * 1.007825035e0, '+'), ('[M]+', 4, 0e0, '+'), ('[M+Na]+', 5, 22.9897677e0, '+'),
 ('[M+K]+', 6, 38.9637074e0, '+'), ('[M+C2H6N2]+', 7, 2 * 12.0e0 + 6 * 1.007825035e0 + 2 * 14.003074e0, '+'), ('[M+Cl]-', 8, 34.96885272e0, '-'),
 ('[M+H-H2O]+', 9, -1.007825035e0 - 15.99491463e0, '+'))"""
LATER = "CASE WHEN (a.rt, a.group_id) > (b.rt, b.group_id) THEN a.fw ELSE b.fw END / 2"


def wide(spark, d):
    g = S.groups(spark, d).withColumn("fwhm", F.lit(0.4))
    return g.withColumn("adduct", F.when(F.col("name").isNotNull(), F.col("adduct")))


@query("j8_isotope_pairs", f"""WITH {WIDE} SELECT a.study_id, a.polarity, a.group_id AS light, b.group_id AS heavy FROM w a JOIN w b USING (study_id, polarity)
WHERE a.group_id <> b.group_id AND abs(a.mz + 1.003 - b.mz) < 0.01 AND abs(a.rt - b.rt) < {LATER}""")
def j8(spark, d):
    return G.isotope_pairs(wide(spark, d))


@query("j9_adduct_known", f"""WITH {WIDE}, {ADD} SELECT DISTINCT a.study_id, a.polarity, a.group_id AS known, b.group_id AS other FROM w a JOIN ad x ON x.adduct = a.adduct AND a.name IS NOT NULL
JOIN w b USING (study_id, polarity) CROSS JOIN ad y WHERE a.group_id <> b.group_id AND abs(a.rt - b.rt) < {LATER}
 AND abs(b.mz - y.adduct_mass - (a.mz - x.adduct_mass)) / (a.mz - x.adduct_mass) * 1e6 < 20""")
def j9(spark, d):
    return G.adduct_pairs_known(wide(spark, d), ions.adduct_table(spark))


@query("j9_adduct_unknown", f"""WITH {WIDE}, {ADD} SELECT DISTINCT a.study_id, a.polarity, a.group_id AS later, b.group_id AS earlier FROM w a JOIN w b USING (study_id, polarity)
CROSS JOIN ad x CROSS JOIN ad y WHERE (a.rt, a.group_id) > (b.rt, b.group_id) AND abs(a.rt - b.rt) < {LATER} AND x.adduct_rank <> y.adduct_rank
 AND abs(b.mz - y.adduct_mass - (a.mz - x.adduct_mass)) / (a.mz - x.adduct_mass) * 1e6 < 20""")
def j9u(spark, d):
    return G.adduct_pairs_unknown(wide(spark, d).withColumn("adduct", F.lit(None).cast("string")), ions.adduct_table(spark))


@query("j10_in_source", f"""WITH {WIDE}, f AS (SELECT *, unnest([mz + 21.98194e0, mz - 40.0, mz / 2]) AS fm FROM w WHERE name IS NOT NULL)
SELECT DISTINCT a.study_id, a.polarity, a.group_id AS parent, b.group_id AS fragment FROM f a JOIN w b USING (study_id, polarity)
WHERE a.group_id <> b.group_id AND abs(a.rt - b.rt) < {LATER} AND abs(fm - b.mz) / b.mz * 1e6 < 20""")
def j10(spark, d):
    g = wide(spark, d).withColumn("fragments", F.when(F.col("name").isNotNull(), F.array(F.col("mz") + 21.98194, F.col("mz") - 40.0, F.col("mz") / 2)))
    return G.in_source_pairs(g)


DIMER_MZ = "CASE WHEN m = 3 THEN 2 * (mz - 0.0002e0 - s * 1.007825035e0) + s * 1.007825035e0 ELSE mz END"


@query("j11_dimer", f"""WITH {BASE}, w AS (SELECT * EXCLUDE (mz, s), {DIMER_MZ} AS mz FROM (SELECT *, 0.4e0 AS fw, CASE WHEN polarity = '+' THEN 1 ELSE -1 END AS s FROM groups)), {ADD} SELECT DISTINCT a.study_id, a.polarity, a.group_id AS monomer, b.group_id AS dimer FROM w a JOIN w b USING (study_id, polarity)
JOIN ad x ON x.pol = a.polarity WHERE a.group_id <> b.group_id AND abs(a.rt - b.rt) < {LATER}
 AND abs((a.mz - adduct_mass) * 2 - (b.mz - adduct_mass)) / CASE WHEN (a.rt, a.group_id) > (b.rt, b.group_id) THEN b.mz - adduct_mass ELSE (a.mz - adduct_mass) * 2 END * 1e6 < 20""")
def j11(spark, d):
    g = wide(spark, d).withColumn("s", F.expr("if(polarity = '+', 1, -1)"))
    return G.dimer_pairs(g.withColumn("mz", F.expr(DIMER_MZ)).drop("s"), ions.adduct_table(spark))


@query("j12_redundant", f"""WITH {WIDE}, s AS (SELECT *, {SUMNAME} AS sn FROM w WHERE name IS NOT NULL)
SELECT a.study_id, a.polarity, a.group_id AS later, b.group_id AS earlier FROM s a JOIN s b USING (study_id, polarity, sn)
WHERE (a.rt, a.group_id) > (b.rt, b.group_id) AND abs(a.rt - b.rt) < {LATER}""")
def j12(spark, d):
    from massloom.functions.names import sum_composition
    return G.redundant_pairs(wide(spark, d).withColumn("sum_name", sum_composition(F.col("name"))))


def sweep_input(spark, d, areas):
    from massloom.functions.names import sum_composition
    g = wide(spark, d).join(spread(area_groups(spark, d, areas).select("group_id", "max_area")), "group_id")
    g = next_round(g)  # the group table is read by six rules
    return g.withColumn("sum_name", sum_composition(F.col("name"))).withColumn("fragments", F.when(
        F.col("name").isNotNull(), F.array(F.col("mz") + 21.98194, F.col("mz") / 2)))


SWEEP = f"""{CELLS}, {ADD}, mx AS (SELECT study_id, polarity, group_id, cast(max(area) AS double) AS max_area FROM areas GROUP BY ALL),
w AS MATERIALIZED (SELECT g.* EXCLUDE (adduct), CASE WHEN name IS NOT NULL THEN adduct END AS adduct, coalesce(max_area, 0) AS max_area, {SUMNAME} AS sn, 0.4e0 AS fw FROM groups g LEFT JOIN mx USING (study_id, polarity, group_id)),
nb AS MATERIALIZED (SELECT a.study_id, a.polarity, a.group_id AS ai, b.group_id AS bi, a.mz AS am, b.mz AS bm, a.adduct AS aa, b.adduct AS ba, a.name AS an, a.sn AS asn, b.sn AS bsn,
  (a.rt, a.group_id) > (b.rt, b.group_id) AS fwd FROM w a JOIN w b USING (study_id, polarity) WHERE a.group_id <> b.group_id AND abs(a.rt - b.rt) < 0.4e0 / 2),
ru AS (SELECT *, 'isotope' AS rule, fwd AS forward FROM nb WHERE abs(am + 1.003 - bm) < 0.01
 UNION ALL SELECT nb.*, 'known', fwd FROM nb JOIN ad x ON x.adduct = aa WHERE EXISTS (SELECT 1 FROM ad y WHERE abs(bm - y.adduct_mass - (am - x.adduct_mass)) / (am - x.adduct_mass) * 1e6 < 20)
 UNION ALL SELECT DISTINCT nb.*, 'unknown', true FROM nb CROSS JOIN ad x CROSS JOIN ad y WHERE fwd AND aa IS NULL AND ba IS NULL AND x.adduct_rank <> y.adduct_rank AND abs(bm - y.adduct_mass - (am - x.adduct_mass)) / (am - x.adduct_mass) * 1e6 < 20
 UNION ALL SELECT *, 'source', fwd FROM nb WHERE an IS NOT NULL AND least(abs(am + 21.98194e0 - bm), abs(am / 2 - bm)) / bm * 1e6 < 20
 UNION ALL SELECT DISTINCT nb.*, 'dimer', fwd FROM nb JOIN ad x ON x.pol = polarity WHERE abs((am - adduct_mass) * 2 - (bm - adduct_mass)) / CASE WHEN fwd THEN bm - adduct_mass ELSE (am - adduct_mass) * 2 END * 1e6 < 20
 UNION ALL SELECT *, 'redundant', true FROM nb WHERE fwd AND asn = bsn),
pr AS (SELECT study_id, polarity, CASE WHEN fwd THEN ai ELSE bi END AS later, CASE WHEN fwd THEN bi ELSE ai END AS earlier, rule, forward FROM ru),
tr AS (SELECT study_id, polarity, later, earlier, count(*) AS n, CASE WHEN min(x.area) = max(x.area) OR min(y.area) = max(y.area) THEN 0 ELSE corr(x.area, y.area) END AS r
  FROM (SELECT DISTINCT study_id, polarity, later, earlier FROM pr) p JOIN cells x USING (study_id, polarity) JOIN cells y USING (study_id, polarity, injection)
  WHERE x.group_id = later AND y.group_id = earlier AND x.role IN ('sample', 'qc', 'standard') GROUP BY ALL),
sw AS (SELECT pr.*, coalesce(n, 0) < 5 OR r >= 0.5 AS tracks FROM pr LEFT JOIN tr USING (study_id, polarity, later, earlier))"""


@query("j8_j12_sweep_pairs", f"WITH {SWEEP} SELECT * FROM sw")
def sweep(spark, d):
    areas = next_round(S.areas(spark, d))  # read by the groups and the correlation
    return G.sweep_pairs(sweep_input(spark, d, areas), ions.adduct_table(spark), areas, S.injections(spark, d)).select(
        "study_id", "polarity", "later", "earlier", "rule", "forward", "tracks")


def _drop(condition: str, group: str, reason: str, into: str = "NULL") -> str:
    """One more entry of a walk's log where ``condition`` holds."""
    return f"CASE WHEN {condition} THEN [{{'id': {group}, 'reason': '{reason}', 'into': {into}::BIGINT}}] ELSE [] END"


# one pair of every run a step; ``dead`` lists what is dropped, ``log`` all verdicts in their order
SWEEP_WALK = f"""WITH RECURSIVE {SWEEP},
st AS MATERIALIZED (SELECT s.*, l.name IS NOT NULL AS ln, e.name IS NOT NULL AS en, l.max_area AS la, e.max_area AS ea, CASE WHEN l.mz > e.mz THEN later ELSE earlier END AS heavy, CASE WHEN l.mz > e.mz THEN l.name ELSE e.name END IS NOT NULL AS hn,
  row_number() OVER (PARTITION BY study_id, polarity ORDER BY l.rt, later, e.rt DESC, earlier DESC) AS i
  FROM (SELECT study_id, polarity, later, earlier, bool_or(tracks) AS tracks, bool_or(rule = 'isotope') AS iso, bool_or(rule = 'known') AS kn, bool_or(rule = 'unknown') AS un, bool_or(rule = 'source' AND forward) AS sf,
    bool_or(rule = 'source' AND NOT forward) AS sb, bool_or(rule = 'dimer') AS di, bool_or(rule = 'redundant') AS re FROM sw GROUP BY ALL) s
  JOIN w l USING (study_id, polarity) JOIN w e USING (study_id, polarity) WHERE l.group_id = later AND e.group_id = earlier),
walk AS (SELECT DISTINCT study_id, polarity, 0::BIGINT AS i, []::BIGINT[] AS dead, []::STRUCT(id BIGINT, reason VARCHAR, "into" BIGINT)[] AS log FROM st
 UNION ALL SELECT study_id, polarity, i, list_distinct(dead || list_transform(acts, lambda x: x.id)), log || acts FROM (
  SELECT *, a4 || {_drop("re AND ln AND en", "CASE WHEN win = later THEN earlier ELSE later END", "Redundant Identification", "win")} AS acts FROM (
  SELECT *, CASE WHEN gl <> ge THEN CASE WHEN ge THEN later ELSE earlier END WHEN la > ea THEN later ELSE earlier END AS win FROM (
  SELECT *, list_contains(dead || list_transform(a4, lambda x: x.id), later) AS gl, list_contains(dead || list_transform(a4, lambda x: x.id), earlier) AS ge FROM (
  SELECT *, a3 || {_drop("sf", "earlier", "In-source fragment")} || {_drop("sb AND NOT sf", "later", "In-source fragment")} || {_drop("di AND tracks AND NOT hn", "heavy", "Dimer")} AS a4 FROM (
  SELECT *, a2 || {_drop("un AND tracks AND NOT ln AND NOT en AND len(a2) = 0 AND NOT gl0 AND NOT ge0", "CASE WHEN la < ea THEN later ELSE earlier END", "Adduct of existing peak")} AS a3 FROM (
  SELECT *, a1 || {_drop("kn AND tracks AND ln <> en AND len(a1) = 0 AND NOT gl0 AND NOT ge0", "CASE WHEN ln THEN earlier ELSE later END", "Adduct of existing identified peak")} AS a2 FROM (
  SELECT *, {_drop("iso AND tracks AND NOT hn AND NOT list_contains(dead, heavy)", "heavy", "M+1 isotope")} AS a1 FROM (
  SELECT st.*, dead, log, list_contains(dead, later) AS gl0, list_contains(dead, earlier) AS ge0 FROM walk JOIN st ON st.study_id = walk.study_id AND st.polarity = walk.polarity AND st.i = walk.i + 1) z1) z2) z3) z4) z5) z6) z7) z8),
fin AS (SELECT study_id, polarity, unnest(log) AS e, generate_subscripts(log, 1) AS k FROM (SELECT *, row_number() OVER (PARTITION BY study_id, polarity ORDER BY i DESC) AS rn FROM walk) z WHERE rn = 1)
SELECT study_id, polarity, e.id AS group_id, arg_max(e.reason, k) AS reason, arg_max(e."into", k) AS merged_into FROM fin GROUP BY ALL"""


@query("j8_j12_sweep_verdicts", SWEEP_WALK)
def sweep_verdicts(spark, d):
    areas = next_round(S.areas(spark, d))  # read by the groups and the correlation
    g = sweep_input(spark, d, areas)
    pairs = G.sweep_pairs(g, ions.adduct_table(spark), areas, S.injections(spark, d))
    return G.resolve_sweep(pairs, g)


@query("j13_correlated_unidentified", f"""WITH {CELLS}, g AS (SELECT *, 0.4e0 AS fw FROM groups),
p AS (SELECT u.study_id, u.polarity, u.group_id AS ua, i.group_id AS ib FROM g u JOIN g i USING (study_id, polarity) WHERE u.name IS NULL AND i.name IS NOT NULL AND abs(u.rt - i.rt) < 0.4e0 / 0.5),
c AS (SELECT p.study_id, p.polarity, ua, ib, corr(x.area, y.area) AS r, count(*) AS n FROM p JOIN cells x ON x.group_id = ua AND x.role <> 'blank'
  JOIN cells y ON y.group_id = ib AND y.injection = x.injection GROUP BY ALL)
SELECT DISTINCT study_id, polarity, ua AS group_id, 'Correlated with identified peak' AS reason FROM c WHERE n >= 5 AND r >= 0.95""")
def j13(spark, d):
    g = wide(spark, d).withColumn("keep", F.lit(True)).withColumn("identified", F.col("name").isNotNull())
    return G.correlated_unidentified(g, S.areas(spark, d), S.injections(spark, d))


def pair_groups(spark, d):
    from massloom.functions.names import sum_composition
    return S.groups(spark, d).withColumn("keep", F.lit(True)).withColumn("sum_name", sum_composition(F.col("name")))


ADDUCT_PAIRS = f"""{CELLS}, {ADD}, s AS (SELECT g.*, {SUMNAME} AS sn FROM groups g WHERE name IS NOT NULL),
c AS (SELECT a.study_id, a.polarity, a.group_id AS parent, b.group_id AS ghost, y.adduct AS as_adduct, y.adduct_rank, a.sn = b.sn AS same_molecule
 FROM s a JOIN ad x ON x.adduct = a.adduct JOIN s b USING (study_id, polarity) JOIN ad y ON y.pol = b.polarity
 WHERE a.group_id <> b.group_id AND abs(a.rt - b.rt) <= 0.09e0 AND NOT (a.sn = b.sn AND a.adduct = b.adduct) AND abs(abs(a.mz - b.mz) - 1.0033548) >= 0.01
  AND abs(b.mz - y.adduct_mass - (a.mz - x.adduct_mass)) / (a.mz - x.adduct_mass) * 1e6 < 10),
ac AS (SELECT study_id, polarity, parent, ghost, arg_min(as_adduct, adduct_rank) AS as_adduct, any_value(same_molecule) AS same_molecule FROM c GROUP BY ALL)"""
CANONICAL = " ".join(f"WHEN '{c}' THEN adduct = '{a}'" for c, a in G.CANONICAL_ADDUCT.items())


@query("j14_adduct_pair_candidates", f"WITH {ADDUCT_PAIRS} SELECT * FROM ac")
def j14c(spark, d):
    return G.adduct_pair_candidates(pair_groups(spark, d), ions.adduct_table(spark))


# one accusation of every run a step; ``gone`` lists the removed rows
ADDUCT_WALK = f"""WITH RECURSIVE {ADDUCT_PAIRS}, id AS (SELECT *, least(parent, ghost) AS id_a, greatest(parent, ghost) AS id_b FROM ac),
xy AS (SELECT study_id, polarity, id_a, id_b, x.area AS x, y.area AS y FROM (SELECT DISTINCT study_id, polarity, id_a, id_b FROM id) p JOIN cells x USING (study_id, polarity) JOIN cells y USING (study_id, polarity, injection)
  WHERE x.group_id = id_a AND y.group_id = id_b AND x.role IN ('sample', 'qc', 'standard')),
rk AS (SELECT *, {rank_of('id_a, id_b', 'x')} AS rx, {rank_of('id_a, id_b', 'y')} AS ry FROM xy),
ok AS (SELECT study_id, polarity, id_a, id_b FROM rk GROUP BY ALL HAVING count(*) >= 8 AND min(rx) < max(rx) AND min(ry) < max(ry) AND corr(rx, ry) >= 0.8),
gr AS (SELECT *, (coalesce(CASE lipid_class {CANONICAL} END, adduct IN ('[M+H]+', '[M-H]-')), coalesce(dot, 0)) AS support FROM groups),
gd AS (SELECT id.*, p.support AS ps, g.support AS gs, (p.rt, parent) AS pk, (g.rt, ghost) AS gk, p.name AS pn, p.rt AS prt, count(*) OVER (PARTITION BY study_id, polarity, id_a, id_b) > 1 AS two
  FROM id SEMI JOIN ok USING (study_id, polarity, id_a, id_b) JOIN gr p USING (study_id, polarity) JOIN gr g USING (study_id, polarity) WHERE p.group_id = parent AND g.group_id = ghost),
st AS MATERIALIZED (SELECT study_id, polarity, parent, ghost, 'Adduct pair: ' || CASE WHEN same_molecule THEN 'the same molecule on its ' ELSE 'the ' END || as_adduct || ' of ' || pn || ' at ' || format('{{:.3f}}', prt) || ' min' AS reason,
  row_number() OVER (PARTITION BY study_id, polarity ORDER BY least(pk, gk), greatest(pk, gk)) AS i FROM gd WHERE ps > gs OR (ps = gs AND (NOT two OR pk < gk))),
walk AS (SELECT DISTINCT study_id, polarity, 0::BIGINT AS i, []::BIGINT[] AS gone, []::STRUCT(id BIGINT, reason VARCHAR)[] AS log FROM st
 UNION ALL SELECT study_id, polarity, i, CASE WHEN hit THEN list_append(gone, ghost) ELSE gone END, CASE WHEN hit THEN list_append(log, {{'id': ghost, 'reason': reason}}) ELSE log END
  FROM (SELECT st.*, gone, log, NOT list_contains(gone, parent) AND NOT list_contains(gone, ghost) AS hit FROM walk JOIN st ON st.study_id = walk.study_id AND st.polarity = walk.polarity AND st.i = walk.i + 1) z),
fin AS (SELECT study_id, polarity, unnest(log) AS e FROM (SELECT *, row_number() OVER (PARTITION BY study_id, polarity ORDER BY i DESC) AS rn FROM walk) z WHERE rn = 1)
SELECT study_id, polarity, e.id AS group_id, e.reason AS reason, NULL::BIGINT AS merged_into FROM fin"""


@query("j14_remove_adduct_pairs", ADDUCT_WALK)
def j14(spark, d):
    return G.remove_adduct_pairs(pair_groups(spark, d), ions.adduct_table(spark), S.areas(spark, d), S.injections(spark, d))


@query("j15_split_candidates", f"""WITH {BASE} SELECT a.study_id, a.polarity, a.name, a.group_id AS first, b.group_id AS second FROM groups a JOIN groups b USING (study_id, polarity, name, adduct)
WHERE (a.rt, a.group_id) < (b.rt, b.group_id) AND abs(a.rt - b.rt) <= 0.18e0 AND abs(a.mz - b.mz) / b.mz * 1e6 <= 10""")
def j15c(spark, d):
    return G.split_peak_candidates(pair_groups(spark, d))


# the groups around a lipid are pieces of its peak, whose shares are steady, change from injection to injection, or both
SPLIT_GROUPS = """SELECT g.study_id, g.polarity, g.group_id, g.m, g.b, p.mz + g.m % 4 * 0.0002e0 AS mz, p.rt + g.m % 4 * 0.02e0 AS rt, g.fwhm, p.name, p.adduct
FROM {groups} g JOIN {groups} p ON p.group_id = g.b"""
SPLIT_AREAS = """SELECT a.study_id, a.polarity, a.injection, a.group_id, cast((1000000 + area_raw % 100000) * CASE WHEN g.b % 3 = 0 THEN CASE g.m WHEN 0 THEN 20 + 15 * (slot % 4) WHEN 3 THEN 80 - 15 * (slot % 4) ELSE 4 + 9 * (slot % 2) END
   WHEN g.b % 3 = 1 THEN CASE g.m WHEN 0 THEN 50 WHEN 1 THEN 20 WHEN 2 THEN 18 ELSE 12 END ELSE CASE g.m WHEN 0 THEN 30 + 10 * (slot % 3) WHEN 1 THEN 25 WHEN 2 THEN 12 + slot % 2 ELSE 60 - 10 * (slot % 3) END END AS bigint) AS area
FROM (SELECT a.study_id, a.polarity, a.injection, a.group_id, a.area AS area_raw, i.inj_id % 4 + i.inj_id % 3 AS slot FROM {areas} a JOIN {injections} i ON a.study_id = i.study_id AND a.polarity = i.polarity AND a.injection = i.injection) a
JOIN {groups} g ON a.group_id = g.group_id"""


def split_groups(spark, d):
    return spark.sql(SPLIT_GROUPS, groups=spread(S.groups(spark, d))).withColumn("keep", F.lit(True))


def split_areas(spark, d):
    return spark.sql(SPLIT_AREAS, groups=spread(S.groups(spark, d)), areas=S.areas(spark, d), injections=S.injections(spark, d))


def _cv(v: str) -> str:
    return f"CASE WHEN len(list_filter({v}, lambda x: x > 0)) >= 3 AND list_avg({v}) > 0 THEN 100 * list_stddev_samp({v}) / list_avg({v}) END"


# one pair of every run a step; ``into`` lists the absorbed rows, ``vecs`` the summed areas of the rows that absorbed them
SPLIT_WALK = f"""WITH RECURSIVE {S.cte('areas', 'injections')}, sg AS ({SPLIT_GROUPS.format(groups='groups')}), sa AS ({SPLIT_AREAS.format(groups='groups', areas='areas', injections='injections')}),
np AS (SELECT study_id, polarity, count(*) AS np FROM injections WHERE role = 'qc' GROUP BY ALL HAVING count(*) >= 3),
vc AS MATERIALIZED (SELECT study_id, polarity, group_id, list(coalesce(area, 0)::DOUBLE ORDER BY role = 'sample', injection) AS v FROM sg JOIN injections USING (study_id, polarity) LEFT JOIN sa USING (study_id, polarity, group_id, injection)
  WHERE role IN ('sample', 'qc') GROUP BY ALL),
st AS MATERIALIZED (SELECT a.study_id, a.polarity, a.name, a.group_id AS f, b.group_id AS s, a.rt AS frt, b.rt AS srt, x.v AS fv, y.v AS sv, np, row_number() OVER (PARTITION BY a.study_id, a.polarity ORDER BY a.rt, a.group_id, b.rt, b.group_id) AS i
  FROM sg a JOIN sg b ON a.study_id = b.study_id AND a.polarity = b.polarity AND a.name = b.name AND a.adduct = b.adduct JOIN np ON np.study_id = a.study_id AND np.polarity = a.polarity JOIN vc x ON x.group_id = a.group_id JOIN vc y ON y.group_id = b.group_id
  WHERE (a.rt, a.group_id) < (b.rt, b.group_id) AND abs(a.rt - b.rt) <= 0.18e0 AND abs(a.mz - b.mz) / b.mz * 1e6 <= 10),
walk AS (SELECT DISTINCT study_id, polarity, 0::BIGINT AS i, []::BIGINT[] AS gone, []::STRUCT(id BIGINT, v DOUBLE[])[] AS vecs, []::STRUCT(id BIGINT, "into" BIGINT, kind VARCHAR, reason VARCHAR)[] AS log FROM st
 UNION ALL SELECT study_id, polarity, i, CASE WHEN kind IS NULL THEN gone ELSE list_append(gone, lose) END, CASE WHEN kind IS NULL THEN vecs ELSE list_append(vecs, {{'id': win, 'v': t}}) END,
  CASE WHEN kind IS NULL THEN log ELSE list_append(log, {{'id': lose, 'into': win, 'kind': kind, 'reason': 'Split peak, merged into ' || name || ' at ' || format('{{:.3f}}', wrt) || ' min'}}) END FROM (
  SELECT *, CASE WHEN list_contains(gone, win) OR list_contains(gone, lose) THEN NULL WHEN cw * 1.5 <= greatest(cl, cm) AND cl IS NOT NULL AND cm IS NOT NULL THEN 'precision' WHEN len(k) < 6 OR 100 * list_stddev_samp(q) / list_avg(q) > 25 THEN NULL
    WHEN list_sum(list_transform(k, lambda x: (l[x] - al) * (m[x] - am))) / sqrt(list_sum(list_transform(k, lambda x: (l[x] - al) ** 2)) * list_sum(list_transform(k, lambda x: (m[x] - am) ** 2))) >= 0.8 THEN 'systematic' END AS kind FROM (
  SELECT *, {_cv('l[1:np]')} AS cl, {_cv('m[1:np]')} AS cm, {_cv('t[1:np]')} AS cw, list_transform(k, lambda x: l[x] / m[x]) AS q, list_avg(list_transform(k, lambda x: l[x])) AS al, list_avg(list_transform(k, lambda x: m[x])) AS am FROM (
  SELECT *, list_transform(range(1, len(l) + 1), lambda x: l[x] + m[x]) AS t, list_filter(range(1, len(l) + 1), lambda x: l[x] > 0 AND m[x] > 0) AS k FROM (
  SELECT *, CASE WHEN sw THEN s ELSE f END AS win, CASE WHEN sw THEN f ELSE s END AS lose, CASE WHEN sw THEN v2 ELSE v1 END AS l, CASE WHEN sw THEN v1 ELSE v2 END AS m, CASE WHEN sw THEN srt ELSE frt END AS wrt FROM (
  SELECT *, list_max(v1) < list_max(v2) AS sw FROM (
  SELECT st.*, gone, vecs, log, coalesce(list_filter(vecs, lambda x: x.id = f)[-1].v, fv) AS v1, coalesce(list_filter(vecs, lambda x: x.id = s)[-1].v, sv) AS v2
   FROM walk JOIN st ON st.study_id = walk.study_id AND st.polarity = walk.polarity AND st.i = walk.i + 1) z1) z2) z3) z4) z5) z6),
fin AS MATERIALIZED (SELECT study_id, polarity, unnest(log) AS e FROM (SELECT *, row_number() OVER (PARTITION BY study_id, polarity ORDER BY i DESC) AS rn FROM walk) z WHERE rn = 1),
fo AS (SELECT study_id, polarity, e.id AS id, e."into" AS top FROM fin UNION ALL SELECT fo.study_id, fo.polarity, fo.id, fin.e."into" FROM fo JOIN fin ON fin.study_id = fo.study_id AND fin.polarity = fo.polarity AND fin.e.id = fo.top)
SELECT study_id, polarity, e.id AS group_id, e."into" AS merged_into, top AS survivor, e.kind AS kind, e.reason AS reason FROM fin JOIN fo USING (study_id, polarity)
WHERE fo.id = e.id AND NOT EXISTS (SELECT 1 FROM fin n WHERE n.study_id = fo.study_id AND n.polarity = fo.polarity AND n.e.id = fo.top)"""


@query("j15_merge_split_peaks", SPLIT_WALK)
def j15(spark, d):
    return G.merge_split_peaks(split_groups(spark, d), split_areas(spark, d), S.injections(spark, d))


def features(spark, d, areas=None):
    """One feature per detected cell; measured retention drifts with run order.  ``areas`` is their table, where it is at hand."""
    a = (S.areas(spark, d) if areas is None else areas).join(S.injections(spark, d).select("study_id", "polarity", "injection", "run_order"), ["study_id", "polarity", "injection"])
    return a.join(spread(S.groups(spark, d).select("study_id", "polarity", "group_id", "mz", "rt", "fwhm")), ["study_id", "polarity", "group_id"]).selectExpr(
        "study_id", "polarity", "group_id", "injection", "run_order", "mz * (1 + (run_order % 5) * 1e-7) AS mz", "rt AS rt_aligned",
        "rt + run_order * 0.001e0 + rt * 0.0005e0 AS rt_measured", "fwhm", "cast(area AS double) AS area")


FEAT = f"""{S.cte('areas', 'injections')}, ft AS (SELECT a.study_id, a.polarity, a.group_id, a.injection, i.run_order, i.role, g.mz * (1 + (i.run_order % 5) * 1e-7) AS mz, g.rt AS rt_aligned,
  g.rt + i.run_order * 0.001e0 + g.rt * 0.0005e0 AS rt_measured, g.fwhm, cast(a.area AS double) AS area FROM areas a JOIN injections i USING (study_id, polarity, injection)
  JOIN groups g USING (study_id, polarity, group_id))"""


@query("a7_build_groups", f"""WITH {FEAT} SELECT study_id, polarity, group_id, round(arg_max(mz, area), 6) AS mz, round(avg(rt_aligned), 6) AS rt, round(avg(fwhm), 6) AS fwhm,
  max(area) AS max_area, count(*) AS n_features, count_if(role <> 'blank') AS n_files FROM ft GROUP BY ALL HAVING count_if(role <> 'blank') >= 2""")
def a7(spark, d):
    g = G.build_groups(features(spark, d), S.injections(spark, d))
    return g.select("study_id", "polarity", "group_id", F.round("mz", 6).alias("mz"), F.round("rt", 6).alias("rt"), F.round("fwhm", 6).alias("fwhm"), "max_area", "n_features", "n_files")


# features of both polarities linked into one group per study, with masses up to 39 ppm apart
IONS = """SELECT a.study_id, g.b AS group_id, CASE WHEN i.run_order % 6 = 5 THEN '-' ELSE '+' END AS polarity, a.injection, p.mz * (1 + ((i.run_order * 7 + a.group_id) % 40) * 1e-6) AS mz, a.area
FROM {areas} a JOIN {injections} i ON a.study_id = i.study_id AND a.polarity = i.polarity AND a.injection = i.injection JOIN {groups} g ON a.group_id = g.group_id JOIN {groups} p ON p.group_id = g.b"""
LINKED = ["study_id", "group_id"]


def linked(spark, d):
    return spark.sql(IONS, areas=S.areas(spark, d), injections=S.injections(spark, d), groups=S.groups(spark, d))


# one feature of every group a step
ION_WALK = f"""WITH RECURSIVE {S.cte('areas', 'injections')}, lf AS MATERIALIZED ({IONS.format(areas='areas', injections='injections', groups='groups')}),
st AS MATERIALIZED (SELECT study_id, group_id, mz, row_number() OVER (PARTITION BY study_id, group_id ORDER BY injection, mz) AS i FROM lf),
walk AS (SELECT DISTINCT study_id, group_id, 0::BIGINT AS i, []::DOUBLE[] AS ions FROM st
 UNION ALL SELECT st.study_id, st.group_id, st.i, CASE WHEN len(list_filter(ions, lambda x: abs(st.mz - x) / x * 1e6 < 20)) = 0 THEN list_append(ions, st.mz) ELSE ions END
  FROM walk JOIN st ON st.study_id = walk.study_id AND st.group_id = walk.group_id AND st.i = walk.i + 1),
pk AS (SELECT study_id, group_id, arg_max(ions, i) AS ions FROM walk GROUP BY ALL)"""


@query("a5_distinct_ions", f"""{ION_WALK}
SELECT study_id, group_id, round(unnest(ions), 9) AS mz, generate_subscripts(ions, 1)::int AS ion_rank FROM pk""")
def a5(spark, d):
    return G.distinct_ions(linked(spark, d), LINKED).withColumn("mz", F.round("mz", 9))


@query("a5_quant_ions", f"""{ION_WALK},
fl AS (SELECT study_id, group_id, bool_or(polarity = '+') AS positive, bool_or(polarity = '-') AS negative, max(area) AS top FROM lf GROUP BY ALL),
qi AS (SELECT study_id, group_id, arg_min((mz, polarity), (injection, mz)) AS q FROM lf JOIN fl USING (study_id, group_id) WHERE area = top GROUP BY ALL)
SELECT study_id, group_id, positive, negative, round(q[1], 9) AS quant_ion, q[2] AS quant_polarity, len(ions) AS n_ions FROM fl JOIN qi USING (study_id, group_id) JOIN pk USING (study_id, group_id)""")
def a5q(spark, d):
    return G.quant_ions(linked(spark, d), LINKED).withColumn("quant_ion", F.round("quant_ion", 9))


@query("a6_run_fwhm",f"WITH {BASE} SELECT study_id, polarity, round(avg(fwhm), 9) AS run_fwhm FROM groups GROUP BY ALL")
def a6(spark, d):
    return G.run_fwhm(S.groups(spark, d)).withColumn("run_fwhm", F.round("run_fwhm", 9))


@query("j6_isobaric_neighbours", f"""WITH {FEAT} SELECT a.study_id, a.polarity, a.injection, a.group_id AS id_a, b.group_id AS id_b FROM ft a JOIN ft b USING (study_id, polarity, injection)
WHERE a.group_id <> b.group_id AND abs(a.mz - b.mz) / least(a.mz, b.mz) * 1e6 < 5 AND abs(a.rt_aligned - b.rt_aligned) < 0.54e0""")
def j6(spark, d):
    return G.isobaric_neighbours(features(spark, d), S.groups(spark, d))


def hits(spark, d, table=None):
    """Two spectra per named feature, a few of them off the peak.  ``table`` holds the features, where it is at hand."""
    # a feature becomes two wide rows, so its partitions are not left to be merged by the bytes of the narrow ones
    f = apart(features(spark, d) if table is None else table, "group_id").join(spread(S.groups(spark, d).select("group_id", "name", "adduct", "dot")), "group_id").filter("name IS NOT NULL")
    f = f.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return f.selectExpr(
        "study_id", "polarity", "injection", "group_id * 2 + copy AS ms2_id", "1 AS rank",
        "concat(if((group_id + run_order) % 9 = 0, regexp_replace(name, '(\\\\d+):(\\\\d+)$', '20:2'), name), ' ', adduct) AS name",
        "mz * (1 + (copy * 30 - 3) * 1e-6) AS precursor_mz", "mz AS library_mz", "cast(dot + 20 * copy AS double) AS dot", "cast(dot + 150 AS double) AS reverse_dot",
        "rt_measured + copy * 0.02e0 + if(group_id % 31 = 0, 0.5e0, 0e0) AS rt", "rt_measured + copy * 0.02e0 + if(group_id % 31 = 0, 0.5e0, 0e0) AS corrected_rt",
        "group_id % 4 <> 0 AS optimal_polarity", "cast(60 + group_id % 41 AS int) AS purity",
        "array(named_struct('name', concat(name, ' ', adduct), 'share', cast(60 + group_id % 41 AS int)), named_struct('name', concat('PC 16:0_18:1 ', adduct), 'share', cast(40 - group_id % 41 AS int))) AS components")


def _relative(fwhm: str, apex: str, t: str) -> str:
    x = f"(floor(({t} - {apex}) / ({fwhm} / 12e0) + 0.5e0) / 12e0)"
    return f"""CASE WHEN {fwhm} > 0 AND {t} - {apex} >= -3e0 * {fwhm} AND {t} - {apex} <= {71 / 12 - 3!r}::double * {fwhm} THEN pow({GAUSS_BASE!r}::double, -({x} * {x}) / {2.0 / FWHM_TO_SIGMA ** 2!r}::double) ELSE 0.001e0 END"""


ASSOCIATED = f"""{FEAT}, k AS (SELECT f.study_id, f.polarity, f.injection, f.group_id * 2 + copy AS ms2_id, CASE WHEN (f.group_id + f.run_order) % 9 = 0 THEN regexp_replace(g.name, '(\\d+):(\\d+)$', '20:2') ELSE g.name END || ' ' || g.adduct AS name,
  f.mz * (1 + (copy * 30 - 3) * 1e-6) AS prec, f.rt_measured + copy * 0.02e0 + CASE WHEN f.group_id % 31 = 0 THEN 0.5e0 ELSE 0e0 END AS rt, g.dot + 20 * copy AS dot, g.dot + 150 AS reverse_dot
  FROM ft f JOIN groups g USING (study_id, polarity, group_id) CROSS JOIN (VALUES (0), (1)) c(copy) WHERE g.name IS NOT NULL),
rw AS (SELECT study_id, polarity, avg(fwhm) AS w FROM groups GROUP BY ALL),
cd AS (SELECT k.*, f.group_id, f.mz AS f_mz, f.rt_aligned AS f_rt, f.fwhm, f.area, g.rt AS group_rt, w FROM k JOIN ft f ON f.study_id = k.study_id AND f.polarity = k.polarity AND f.injection = k.injection AND abs(k.prec - f.mz) / f.mz * 1e6 < 20 AND abs(k.rt - f.rt_measured) <= f.fwhm * 2
  JOIN groups g ON g.group_id = f.group_id JOIN rw ON rw.study_id = k.study_id AND rw.polarity = k.polarity WHERE k.dot > 500 AND k.reverse_dot > 700 AND abs(prec - g.mz) / g.mz * 1e6 < 20 AND abs(k.rt - f.rt_aligned) <= 1
  AND floor(g.rt / 0.1e0) BETWEEN floor((k.rt - w * 3) / 0.1e0) AND floor((k.rt + w * 3) / 0.1e0)),
fr AS (SELECT * FROM cd WHERE NOT EXISTS (SELECT 1 FROM ft n WHERE n.study_id = cd.study_id AND n.polarity = cd.polarity AND n.injection = cd.injection AND n.group_id <> cd.group_id AND abs(cd.f_mz - n.mz) / n.mz * 1e6 < 5 AND abs(cd.f_rt - n.rt_aligned) < w * 6
  AND n.area * {_relative('n.fwhm', 'n.rt_aligned', 'cd.rt')} > cd.area * {_relative('cd.fwhm', 'cd.f_rt', 'cd.rt')})),
asc_ AS (SELECT study_id, polarity, injection, ms2_id, arg_min((group_id, {_relative('fwhm', 'f_rt', 'rt')}), (group_rt, group_id)) AS b FROM fr GROUP BY ALL)"""


@query("j7_associate", f"WITH {ASSOCIATED} SELECT study_id, polarity, injection, ms2_id, b[1] AS group_id, round(b[2], 6) AS weight FROM asc_")
def j7(spark, d):
    out = G.associate(hits(spark, d), features(spark, d), S.groups(spark, d))
    return out.select("study_id", "polarity", "injection", "ms2_id", "group_id", F.round("weight", 6).alias("weight"))


def named(spark, d):
    """Hits already attached to their group, with a height weight, for the vote."""
    n = G.name_columns(hits(spark, d).selectExpr("*", "cast(floor(ms2_id / 2) AS bigint) AS group_id", "if(ms2_id % 2 = 0, 1e0, 0.5e0) AS weight"))
    return cut_lineage(n)  # read by the vote, the candidates, the purity and the support


HITS = f"""{FEAT}, h0 AS (SELECT f.*, g.name AS gname, g.adduct, g.dot AS gdot, c.copy FROM ft f JOIN groups g USING (study_id, polarity, group_id) CROSS JOIN (VALUES (0), (1)) c(copy)
   WHERE g.name IS NOT NULL),
h AS (SELECT study_id, polarity, injection, group_id, group_id * 2 + copy AS ms2_id, CASE WHEN (group_id + run_order) % 9 = 0 THEN regexp_replace(gname, '(\\d+):(\\d+)$', '20:2') ELSE gname END AS name,
  gname, gdot + 20 * copy AS dot, copy, group_id % 4 <> 0 AS optimal, CASE WHEN copy = 0 THEN 1e0 ELSE 0.5e0 END AS weight, 60 + group_id % 41 AS share FROM h0),
hs AS (SELECT *, {SUMNAME} AS sum_name FROM h),
vt AS (SELECT study_id, polarity, group_id, sum_name, count(*) AS votes, min((injection, ms2_id)) AS arr FROM hs GROUP BY ALL),
vote AS (SELECT study_id, polarity, group_id, sum_name, votes FROM (SELECT *, row_number() OVER (PARTITION BY study_id, polarity, group_id ORDER BY votes DESC, arr) AS rn FROM vt) z WHERE rn = 1)"""


@query("a2_vote_sum_name", f"WITH {HITS} SELECT * FROM vote")
def a2(spark, d):
    return G.vote_sum_name(named(spark, d))


@query("a3_pool_candidates", f"""WITH {HITS}, p AS (SELECT h.study_id, h.polarity, h.group_id, h.name AS lipid_name, cast(max(dot) AS double) AS max_dot, count(*) AS spectra,
   count(DISTINCT injection) AS files, min((injection, ms2_id)) AS arr, bool_or(optimal) AS pref FROM hs h SEMI JOIN vote USING (study_id, polarity, group_id, sum_name) GROUP BY ALL)
SELECT study_id, polarity, group_id, lipid_name, max_dot, spectra, files, cast(row_number() OVER (PARTITION BY study_id, polarity, group_id ORDER BY pref DESC, spectra DESC, arr) AS int) AS candidate_rank FROM p""")
def a3(spark, d):
    n = named(spark, d)
    return G.pool_candidates(n, G.vote_sum_name(n)).select("study_id", "polarity", "group_id", "lipid_name", "max_dot", "spectra", "files", "candidate_rank")


@query("a4_weighted_purity", f"""WITH {HITS}, r AS (SELECT h.* FROM hs h SEMI JOIN vote USING (study_id, polarity, group_id, sum_name) WHERE optimal),
c AS (SELECT study_id, polarity, group_id, weight, gname AS comp, floor(share * weight + 0.5) AS v FROM r UNION ALL
      SELECT study_id, polarity, group_id, weight, 'PC 16:0_18:1', floor((100 - share) * weight + 0.5) FROM r),
s AS (SELECT study_id, polarity, group_id, comp, sum(v) AS v, sum(weight) AS w FROM c GROUP BY ALL)
SELECT study_id, polarity, group_id, round(max(v) / sum(w), 9) AS group_purity, sum(w) AS purity_weight FROM s GROUP BY ALL""")
def a4(spark, d):
    n = named(spark, d)
    return G.weighted_purity(n, G.vote_sum_name(n)).select("study_id", "polarity", "group_id", F.round("group_purity", 9).alias("group_purity"), "purity_weight")


def _chains(x: str) -> str:
    return f"(split_part({x}, ' ', 1) || '|' || array_to_string(list_sort(string_split(split_part({x}, ' ', 2), '_')), '_'))"


def _summed(x: str) -> str:
    return "(" + SUMNAME.replace("name", x) + ")"


REPORTED = f"""{HITS}, ca AS (SELECT h.study_id, h.polarity, h.group_id, h.name AS lipid_name, count(*) AS spectra, min((injection, ms2_id)) AS arr, bool_or(optimal) AS pref FROM hs h SEMI JOIN vote USING (study_id, polarity, group_id, sum_name) GROUP BY ALL),
tp AS (SELECT study_id, polarity, group_id, lipid_name AS top_name FROM (SELECT *, row_number() OVER (PARTITION BY study_id, polarity, group_id ORDER BY pref DESC, spectra DESC, arr) AS rn FROM ca) z WHERE rn = 1),
ro AS (SELECT h.* FROM hs h SEMI JOIN vote USING (study_id, polarity, group_id, sum_name) WHERE optimal),
cm AS (SELECT study_id, polarity, group_id, weight, gname AS comp, floor(share * weight + 0.5) AS v, (injection, ms2_id, 0) AS arr FROM ro UNION ALL SELECT study_id, polarity, group_id, weight, 'PC 16:0_18:1', floor((100 - share) * weight + 0.5), (injection, ms2_id, 1) FROM ro),
sm AS (SELECT study_id, polarity, group_id, comp, sum(v) AS v, sum(weight) AS w, min(arr) AS arr FROM cm GROUP BY ALL),
pu AS (SELECT study_id, polarity, group_id, arg_min(comp, (-v, arr)) AS top_comp, max(v) / sum(w) AS gp, count(*) AS n, sum(v) AS total FROM sm GROUP BY ALL),
rp AS (SELECT *, CASE WHEN coalesce(gp, 0) < 75 OR (60 + group_id % 41 < 75 AND top_name <> sum_name) THEN sum_name ELSE top_name END AS name FROM vote JOIN tp USING (study_id, polarity, group_id) LEFT JOIN pu USING (study_id, polarity, group_id))"""


@query("p24_reported_name", f"""WITH {REPORTED}, own AS (SELECT DISTINCT study_id, polarity, group_id FROM rp JOIN sm USING (study_id, polarity, group_id) WHERE {_chains('sm.comp')} = {_chains('rp.name')})
SELECT rp.study_id, rp.polarity, rp.group_id, rp.name, split_part(top_name, ' ', 1) AS lipid_class,
  CASE WHEN rp.name NOT LIKE '%\\_%' ESCAPE '\\' THEN '' WHEN top_comp IS NULL THEN 'not eligible' WHEN own.group_id IS NOT NULL THEN 'fragments' ELSE 'library name' END AS chain_evidence,
  CASE WHEN top_comp IS NULL THEN '' WHEN top_comp = rp.name OR {_chains('top_comp')} = {_chains('rp.name')} OR {_summed('top_comp')} = {_summed('rp.name')} THEN 'self' ELSE top_comp END AS purity_source
FROM rp LEFT JOIN own USING (study_id, polarity, group_id)""")
def p24(spark, d):
    n = named(spark, d)
    v = G.vote_sum_name(n)
    out = G.evidence_labels(G.reported_name(v, G.pool_candidates(n, v), G.weighted_purity(n, v)))
    return out.select("study_id", "polarity", "group_id", "name", "lipid_class", "chain_evidence", "purity_source")


@query("a8_support_scores_adduct", f"""WITH {REPORTED}, x AS (SELECT h.*, f.mz AS lib_mz, g.mz AS quant, g.adduct, g.dot AS gd FROM hs h JOIN rp USING (study_id, polarity, group_id, sum_name) JOIN ft f USING (study_id, polarity, group_id, injection) JOIN groups g USING (study_id, polarity, group_id)
  WHERE rp.name = h.sum_name OR h.name = rp.top_name),
s AS (SELECT study_id, polarity, group_id, count(*) AS ms2_spectra, count(DISTINCT injection) AS ms2_files, max(dot)::double AS dot, (max(gd) + 150)::double AS reverse_dot, cast(max(share) AS int) AS purity, any_value(adduct) AS adducts, any_value(quant) AS quant, arg_min(lib_mz, abs(lib_mz - quant)) AS theo FROM x GROUP BY ALL)
SELECT * EXCLUDE (quant, theo), round(theo, 6) AS theoretical_mz, round((quant - theo) / theo * 1e6, 6) AS mass_error_ppm FROM s""")
def a8(spark, d):
    n = named(spark, d)
    v = G.vote_sum_name(n)
    rep = G.reported_name(v, G.pool_candidates(n, v), G.weighted_purity(n, v))
    out = G.support_scores_adduct(rep, n, S.groups(spark, d))
    return out.select("study_id", "polarity", "group_id", "ms2_spectra", "ms2_files", "dot", "reverse_dot", "purity", "adducts",
                      F.round("theoretical_mz", 6).alias("theoretical_mz"), F.round("mass_error_ppm", 6).alias("mass_error_ppm"))


@query("k3_spectral_components", f"""WITH {REPORTED} SELECT sm.study_id, sm.polarity, sm.group_id, rp.name, comp AS component, round(v / total * 100, 2) AS share, CASE WHEN {_summed('rp.name')} = {_summed('comp')} THEN 'yes' ELSE 'no' END AS isomer,
  cast(row_number() OVER (PARTITION BY sm.study_id, sm.polarity, sm.group_id ORDER BY v DESC, comp) AS int) AS component_rank FROM sm JOIN rp USING (study_id, polarity, group_id) WHERE n >= 2 AND total > 0""")
def k3(spark, d):
    n = named(spark, d)
    v = G.vote_sum_name(n)
    return G.spectral_components(G.reported_name(v, G.pool_candidates(n, v), G.weighted_purity(n, v)))


@query("k2_associated_spectra", f"""WITH {ASSOCIATED} SELECT k.study_id, k.polarity, k.injection, k.ms2_id, 1::int AS rank, k.name, coalesce(b[1]::varchar, '') AS group_ids, CASE WHEN b IS NULL THEN '' ELSE 'Associated' END AS associated
FROM k LEFT JOIN asc_ USING (study_id, polarity, injection, ms2_id)""")
def k2(spark, d):
    h = hits(spark, d)
    out = G.with_links(h, G.associate(h, features(spark, d), S.groups(spark, d)))
    return out.select("study_id", "polarity", "injection", "ms2_id", "rank", "name", "group_ids", "associated")


MAXA = f"""{S.cte('areas')}, mx AS (SELECT group_id, cast(max(area) AS double) AS max_area FROM areas GROUP BY ALL),
ga AS (SELECT g.*, coalesce(max_area, 0) AS max_area FROM groups g LEFT JOIN mx USING (group_id))"""


def sized(spark, d):
    return S.groups(spark, d).join(area_groups(spark, d).select("group_id", "max_area"), "group_id")


@query("w3_duplicate_names", f"""WITH {BASE}, c AS (SELECT *, count(*) OVER (PARTITION BY study_id, polarity, name) AS m_,
  row_number() OVER (PARTITION BY study_id, polarity, name ORDER BY rt, group_id) AS n_ FROM groups WHERE name IS NOT NULL)
SELECT study_id, polarity, group_id, n_::varchar || ' of ' || m_::varchar AS duplicate FROM c WHERE m_ > 1""")
def w3(spark, d):
    return G.duplicate_names(S.groups(spark, d))


@query("w3_lipid_keys", f"""WITH {MAXA}, c AS (SELECT *, count(*) OVER (PARTITION BY study_id, polarity, name) AS m_,
  row_number() OVER (PARTITION BY study_id, polarity, name ORDER BY max_area DESC, group_id) AS n_ FROM ga WHERE name IS NOT NULL)
SELECT study_id, polarity, group_id, CASE WHEN m_ = 1 THEN name WHEN n_ <= 26 THEN name || chr(cast(96 + n_ AS int))
  ELSE name || chr(cast(96 + (n_ - 1) // 26 AS int)) || chr(cast(97 + (n_ - 1) % 26 AS int)) END AS lipid_key FROM c""")
def w3k(spark, d):
    return G.lipid_keys(sized(spark, d))


@query("w4_duplicate_verdicts", f"""WITH {BASE}, x AS (SELECT *, (p_partkey % 60) + 0.5e0 AS cv, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE (p_partkey % 13) - 2e0 END AS z FROM groups WHERE name IS NOT NULL),
c AS (SELECT *, count(*) OVER w AS m_, count(z) OVER w AS s_, min(abs(z)) OVER w AS mz_ FROM x WINDOW w AS (PARTITION BY study_id, polarity, name)),
t AS (SELECT *, concat_ws('; ', CASE WHEN cv > 30 THEN 'unreliable' END, CASE WHEN s_ = m_ AND mz_ > 3 THEN 'class model?' END) AS t FROM c WHERE m_ > 1)
SELECT study_id, polarity, group_id, CASE WHEN t = '' THEN 'isomer?' ELSE t END AS duplicate_verdict FROM t""")
def w4(spark, d):
    g = S.groups(spark, d).withColumn("pooled_cv", F.col("p_partkey") % 60 + F.lit(0.5)).withColumn(
        "rt_z", F.when(F.col("p_partkey") % 5 == 0, None).otherwise(F.col("p_partkey") % 13 - F.lit(2.0)))
    return G.duplicate_verdicts(g)


@query("w5_class_rt_filter", f"""WITH {BASE}, n AS (SELECT *, m <> 2 AS keep FROM groups WHERE name IS NOT NULL),
m1 AS (SELECT study_id, polarity, lipid_class, median(rt) AS md FROM n GROUP BY ALL HAVING count(*) > 4),
d1 AS (SELECT n.*, abs(rt - md) AS dv FROM n JOIN m1 USING (study_id, polarity, lipid_class)),
m2 AS (SELECT study_id, polarity, lipid_class, median(dv) / 0.6745 AS win FROM d1 GROUP BY ALL)
SELECT study_id, polarity, group_id, 'RT out of class range' AS reason FROM d1 JOIN m2 USING (study_id, polarity, lipid_class) WHERE win > 0 AND keep AND dv > win""")
def w5(spark, d):
    g = S.groups(spark, d).withColumn("keep", F.col("m") != 2).withColumn("identified", F.col("name").isNotNull())
    return G.class_rt_filter(g, multiplier=1.0)
