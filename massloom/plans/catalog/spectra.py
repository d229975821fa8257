"""Search, artefact screen, decoys."""

from pyspark.sql import functions as F

from massloom.operators import search as Q
from massloom.plans import standin as S
from massloom.plans.registry import query

PEAKS = f"""{S.cte('spectra')},
top AS (SELECT vec_id, max(intensity) AS top FROM spectra_peaks GROUP BY ALL),
kept AS (SELECT p.vec_id, p.label, is_library, precursor_mz, k, mz, intensity / top * 999 AS intensity
  FROM spectra_peaks p JOIN top USING (vec_id) WHERE intensity / top * 999 >= 5)"""
CANDS = f"""{PEAKS},
cand AS (SELECT s.vec_id AS ms2_id, l.vec_id AS entry_seq, s.precursor_mz, l.precursor_mz AS library_mz
  FROM spectra s JOIN spectra l ON NOT s.is_library AND l.is_library
   AND abs(s.precursor_mz - l.precursor_mz) < 0.01
   AND s.precursor_mz > (SELECT least(999, min(precursor_mz)) FROM spectra WHERE is_library)
   AND s.precursor_mz < (SELECT max(precursor_mz) FROM spectra WHERE is_library))"""
# peaks lie 10 Da apart, so a library peak has at most one partner and the greedy walk is a join on k
SCORED = f"""{CANDS},
sw AS (SELECT *, pow(mz, 0.9) * pow(intensity, 1.2) AS w, pow(0.9 * mz * pow(intensity / 2, 1.2), 2) AS ua,
   pow(0.9 * mz * pow(intensity, 1.2), 2) AS ul FROM kept),
tot AS (SELECT vec_id, sum(ua) AS ua, sum(ul) AS ul FROM sw GROUP BY ALL),
mt AS (SELECT c.ms2_id, c.entry_seq, sum(s.w * l.w) AS n, sum(s.w * s.w) AS ss, sum(l.w * l.w) AS ll,
   sum(s.ua) AS sua, sum(l.ul) AS lul FROM cand c JOIN sw s ON s.vec_id = c.ms2_id
   JOIN sw l ON l.vec_id = c.entry_seq AND l.k = s.k AND abs(s.mz - l.mz) <= 0.01 GROUP BY ALL),
sc AS (SELECT c.*, coalesce(1000 * n * n / ((ss + ts.ua - sua) * (ll + tl.ul - lul)), 0) AS dot,
   coalesce(1000 * n * n / (ss * ll), 0) AS reverse_dot
  FROM cand c LEFT JOIN mt USING (ms2_id, entry_seq) JOIN tot ts ON ts.vec_id = c.ms2_id JOIN tot tl ON tl.vec_id = c.entry_seq)"""


def ms2(spark, d):
    """Sample spectra of the stand-in, one injection per vector id modulo 24."""
    s = S.spectra(spark, d).filter("NOT is_library")
    return s.selectExpr("'A' AS study_id", "'+' AS polarity", "cast(vec_id % 24 AS string) AS injection",
                        "vec_id AS ms2_id", "precursor_mz", "(vec_id % 997) / 40e0 AS rt", "peaks", "label")


def library(spark, d):
    s = S.spectra(spark, d).filter("is_library")
    return s.selectExpr(
        "'standin' AS library", "0 AS lib_rank", "vec_id AS entry_seq",
        "concat(if(vec_id % 10 = 0, 'DECOY_ ', ''), 'PC ', cast(14 + label % 9 AS string), ':0_18:', "
        "cast(label % 4 AS string), ' [M-H]-;') AS name", "precursor_mz", "true AS is_native",
        "vec_id % 3 <> 0 AS optimal_polarity",
        "transform(peaks, (p, k) -> named_struct('mz', p.mz, 'intensity', p.intensity, "
        "'annotation', concat('C1_Alkyl Fragment_[', if(k % 2 = 0, concat(cast(14 + label % 9 AS string), ':0'), "
        "concat('18:', cast(label % 4 AS string))), ']'), 'type', 'C1_Alkyl Fragment', "
        "'chain', if(k % 2 = 0, concat(cast(14 + label % 9 AS string), ':0'), "
        "concat('18:', cast(label % 4 AS string))))) AS peaks").withColumn(
        "peaks", Q.scale_peaks(F.col("peaks"), ("annotation", "type", "chain")))


@query("p1_scale_peaks", f"""WITH {PEAKS} SELECT vec_id, count(*) AS n_peaks, round(sum(intensity), 6) AS total,
  round(max(intensity), 6) AS top FROM kept GROUP BY ALL""")
def p1(spark, d):
    s = S.spectra(spark, d).withColumn("peaks", Q.scale_peaks(F.col("peaks")))
    return s.select("vec_id", F.size("peaks").cast("long").alias("n_peaks"), F.round(
        F.aggregate(F.col("peaks.intensity"), F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
        F.round(F.array_max("peaks.intensity"), 6).alias("top"))


@query("j1_library_candidates", f"WITH {CANDS} SELECT ms2_id, entry_seq, round(library_mz, 4) AS library_mz FROM cand")
def j1(spark, d):
    # rounded once an entry and not once a pair
    entries = library(spark, d).withColumn("shown_mz", F.round("precursor_mz", 4))
    return Q.candidates(ms2(spark, d), entries, keep=["shown_mz"]).select("ms2_id", "entry_seq", F.col("shown_mz").alias("library_mz"))


@query("j2_similarity", f"""WITH {SCORED} SELECT ms2_id, entry_seq, round(dot, 6) AS dot, round(reverse_dot, 6) AS reverse_dot FROM sc""")
def j2(spark, d):
    pairs = Q.candidates(Q.prepare_spectra(ms2(spark, d)), Q.prepare_library(library(spark, d)), blocks=Q.BLOCK)
    return Q.score(pairs, columns=["ms2_id", "entry_seq"]).select("ms2_id", "entry_seq", F.round("dot", 6).alias("dot"),
                                 F.round("reverse_dot", 6).alias("reverse_dot"))


RANKED = f"""{SCORED},
lo AS (SELECT least(999, min(precursor_mz)) AS lo FROM spectra WHERE is_library),
rk AS (SELECT sc.*, row_number() OVER (PARTITION BY ms2_id ORDER BY round(dot, 9) DESC,
   floor((library_mz - lo) / 0.001e0), library_mz DESC, entry_seq) AS rank FROM sc, lo WHERE dot > 1)"""


@query("j3_search_top1", f"""WITH {RANKED} SELECT ms2_id, entry_seq, round(dot, 6) AS dot, round(reverse_dot, 6) AS reverse_dot,
  floor((precursor_mz - library_mz) / library_mz * 1e6 * 1e4 + 0.5) / 1e4 AS delta_ppm FROM rk WHERE rank = 1""")
def j3(spark, d):
    h = Q.search(ms2(spark, d), library(spark, d))
    return h.select("ms2_id", "entry_seq", F.round("dot", 6).alias("dot"), F.round("reverse_dot", 6).alias("reverse_dot"),
                    "delta_ppm")


@query("o1_search_top5", f"""WITH {RANKED} SELECT ms2_id, entry_seq, cast(rank AS int) AS rank, round(dot, 6) AS dot FROM rk WHERE rank <= 5""")
def o1(spark, d):
    h = Q.search(ms2(spark, d), library(spark, d), max_results=5)
    return h.select("ms2_id", "entry_seq", "rank", F.round("dot", 6).alias("dot"))


@query("j4_purity")
def j4(spark, d):
    chains = library(spark, d).selectExpr("explode(peaks.chain) AS chain", "'Alkyl' AS base").distinct()
    return Q.purity(ms2(spark, d), library(spark, d), chains).select(
        "ms2_id", "name", "purity", F.size("components").alias("n_components"), F.size("explained").alias("n_explained"))


@query("j5_potential_fragments")
def j5(spark, d):
    chains = library(spark, d).selectExpr("explode(peaks.chain) AS chain", "'Alkyl' AS base").distinct()
    h = Q.potential_fragments(Q.purity(ms2(spark, d), library(spark, d), chains))
    return h.select("ms2_id", "name", "purity", F.size("fragments").alias("n_fragments"))


@query("p29_sn_evidence", f"""WITH {RANKED},
t AS (SELECT ms2_id, entry_seq, l.label FROM rk JOIN spectra l ON l.vec_id = entry_seq WHERE rank = 1),
kl AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY k) - 1 AS pos FROM kept),
-- chain by the position of a peak before scaling, as the stand-in library annotates it
o AS (SELECT t.ms2_id, max(CASE WHEN l.k % 2 = 0 THEN coalesce(s.intensity, 0) END) AS a,
   max(CASE WHEN l.k % 2 = 1 THEN coalesce(s.intensity, 0) END) AS b
  FROM t JOIN kept l ON l.vec_id = t.entry_seq LEFT JOIN kept s ON s.vec_id = t.ms2_id AND s.k = l.k GROUP BY ALL),
c AS (SELECT t.*, (14 + label % 9)::varchar || ':0' AS c1, '18:' || (label % 4)::varchar AS c2, a, b,
   entry_seq % 10 = 0 AS decoy FROM t JOIN o USING (ms2_id)),
n AS (SELECT *, CASE WHEN decoy THEN 'class not covered' WHEN c1 = c2 THEN 'identical chains'
   WHEN least(a, b) <= 0 THEN 'only one chain''s fragment observed'
   WHEN greatest(a, b) / least(a, b) < 1.5 THEN 'inconclusive' END AS sn_note FROM c)
SELECT ms2_id, sn_note, round(CASE WHEN sn_note IS NULL THEN greatest(a, b) / least(a, b) END, 6) AS sn_ratio,
  CASE WHEN sn_note IS NULL THEN CASE WHEN a >= b THEN c1 ELSE c2 END END AS sn_chain FROM n""")
def p29(spark, d):
    h = Q.search(ms2(spark, d).withColumn("polarity", F.lit("-")), library(spark, d), keep_peaks=True)
    return Q.sn_evidence(h).select("ms2_id", "sn_note", F.round("sn_ratio", 6).alias("sn_ratio"), "sn_chain")


@query("a1_artefact_screen", f"""WITH {PEAKS},
p AS (SELECT vec_id, k, mz, intensity, cast(round_even(mz / 0.1, 0) AS bigint) AS bin FROM spectra_peaks),
b AS (SELECT vec_id, arg_max(bin, intensity) AS base_bin FROM p GROUP BY ALL),
n AS (SELECT count(DISTINCT vec_id) AS n FROM p),
a AS (SELECT bin, count(DISTINCT p.vec_id) AS present, count(DISTINCT CASE WHEN base_bin = bin THEN p.vec_id END) AS as_base,
   avg(mz) AS mz, stddev_samp(mz) AS sd, count(*) AS c FROM p JOIN b USING (vec_id) GROUP BY ALL)
SELECT round(mz, 6) AS mz, round(present / n, 9) AS fraction, round(as_base / n, 9) AS base_fraction,
  round(CASE WHEN c > 2 THEN 1000 * sd ELSE 0 END, 6) AS spread_mda FROM a, n
WHERE present / n >= 0.5 AND as_base / n >= 0.01 AND mz - floor(mz) > 0.00115 * mz - 1.0""")
def a1(spark, d):
    s = S.spectra(spark, d).selectExpr("'A' AS study_id", "'+' AS polarity", "peaks")
    out = Q.screen_artefacts(s, min_fraction=0.5, min_base_fraction=0.01, defect_margin=-1.0)
    return out.select(F.round("mz", 6).alias("mz"), F.round("fraction", 9).alias("fraction"),
                      F.round("base_fraction", 9).alias("base_fraction"), F.round("spread_mda", 6).alias("spread_mda"))


@query("p13_strip_peaks", f"""WITH {S.cte('spectra')} SELECT vec_id, count_if(abs(mz - 300.05) > 0.1) AS n_left,
  count_if(abs(mz - 300.05) <= 0.1) AS n_removed FROM spectra_peaks GROUP BY ALL""")
def p13(spark, d):
    s = S.spectra(spark, d).selectExpr("'A' AS study_id", "'+' AS polarity", "vec_id", "peaks")
    bad = s.select("study_id", "polarity").distinct().withColumn("mz", F.lit(300.05))
    out = Q.strip_artefacts(s, bad)
    return out.select("vec_id", F.size("peaks").cast("long").alias("n_left"), F.col("n_removed").cast("long").alias("n_removed"))


@query("a35_decoy_rate", f"""WITH {RANKED}, t(threshold) AS (VALUES (0.0::double), (200.0::double), (500.0::double), (700.0::double))
SELECT threshold, count_if(entry_seq % 10 = 0) AS decoys, count_if(entry_seq % 10 <> 0) AS targets,
  round(count_if(entry_seq % 10 = 0) / count(*), 9) AS decoy_share
FROM rk JOIN t ON dot >= threshold WHERE rank = 1 GROUP BY ALL""")
def a35(spark, d):
    out = Q.decoy_rate(Q.search(ms2(spark, d), library(spark, d)), [0.0, 200.0, 500.0, 700.0])
    return out.select("threshold", "decoys", "targets", F.round("decoy_share", 9).alias("decoy_share"))


@query("j49_search_exactness", f"""WITH {RANKED}, h AS (SELECT ms2_id, rk.precursor_mz AS pm, (ms2_id % 997) / 40e0 AS rt, CASE WHEN entry_seq % 10 = 0 THEN 'DECOY_ ' ELSE '' END || (14 + l.label % 9)::varchar || '/' || (l.label % 4)::varchar AS name, dot
  FROM rk JOIN spectra l ON l.vec_id = entry_seq WHERE rank = 1),
p AS (SELECT a.ms2_id, arg_min((a.name = b.name AND b.ms2_id % 3 <> 0, abs(a.dot - b.dot - CASE WHEN b.ms2_id % 5 = 0 THEN 1 ELSE 0 END) < 1e-9, b.ms2_id), (abs(a.rt - b.rt - 0.001e0), b.ms2_id)) AS m
  FROM h a JOIN h b ON a.ms2_id % 24 = b.ms2_id % 24 AND abs(a.pm - b.pm) <= 0.003 AND abs(a.rt - b.rt - 0.001e0) <= 0.003 GROUP BY ALL)
SELECT ms2_id, m[3] AS other_id, m[1] AS same_name, m[2] AS same_score, NOT m[1] AND m[2] AS tie FROM p""")
def j49(spark, d):
    """A search against one whose every third name, every fifth score and every retention differ."""
    h = Q.search(ms2(spark, d), library(spark, d))
    other = h.withColumn("name", F.when(F.col("ms2_id") % 3 == 0, F.concat("name", F.lit("x"))).otherwise(F.col("name"))).withColumn(
        "dot", F.col("dot") + F.when(F.col("ms2_id") % 5 == 0, 1.0).otherwise(0.0)).withColumn("rt", F.col("rt") + 0.001)
    return Q.search_exactness(h, other).select("ms2_id", "other_id", "same_name", "same_score", "tie")
