"""Domain tables defined by arithmetic on the given tables.

Real scans are not part of the test data, so each domain table is a projection or aggregate of a
given one.  The same SELECT text runs here through ``spark.sql`` and, with table names filled in,
in the reference SQL; the two therefore see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from massloom.operators.band import spread


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


_KEYS = """p_partkey AS group_id, p_partkey % 20 AS m,
  p_partkey - CASE WHEN p_partkey % 20 IN (1, 2, 3) THEN p_partkey % 20 ELSE 0 END AS b, p_partkey"""

GROUPS = f"""
SELECT CASE WHEN b % 80 < 40 THEN 'A' ELSE 'B' END AS study_id,
  CASE WHEN b % 40 < 20 THEN '+' ELSE '-' END AS polarity,
  group_id, m, b,
  300e0 + ((b * 7919) % 120011) / 100e0
    + CASE m WHEN 1 THEN 21.98194e0 WHEN 2 THEN 1.00335e0 WHEN 3 THEN 0.0002e0 ELSE 0e0 END AS mz,
  1e0 + ((b * 37) % 2399) / 100e0
    + CASE m WHEN 1 THEN 0.01e0 WHEN 2 THEN 0.005e0 WHEN 3 THEN 0.02e0 ELSE 0e0 END AS rt,
  0.09e0 AS fwhm,
  CASE WHEN m = 2 OR (m > 3 AND p_partkey % 4 = 3) THEN NULL
    WHEN b % 40 < 20 THEN cls || ' ' || cast(c1 AS string) || ':' || cast(d1 AS string) || '_'
      || cast(c2 AS string) || ':' || cast(d2 AS string)
    ELSE cls || ' ' || cast(c1 + c2 AS string) || ':' || cast(d1 + d2 AS string) END AS name,
  CASE WHEN b % 40 >= 20 THEN '[M-H]-' WHEN m = 1 THEN '[M+Na]+' ELSE '[M+H]+' END AS adduct,
  cls AS lipid_class, c1 + c2 AS carbons, d1 + d2 AS double_bonds,
  500 + (p_partkey * 13) % 500 AS dot, p_partkey
FROM (SELECT *, 14 + b % 8 AS c1, b % 3 AS d1,
    16 + b % 7 + CASE WHEN m = 1 THEN 2 ELSE 0 END AS c2, b % 4 + CASE WHEN m = 1 THEN 3 ELSE 0 END AS d2,
    CASE b % 6 WHEN 0 THEN 'PC' WHEN 1 THEN 'PE' WHEN 2 THEN 'TG' WHEN 3 THEN 'SM'
      WHEN 4 THEN 'Cer[NS]' ELSE 'GlcCer[NS]' END AS cls
  FROM (SELECT {_KEYS} FROM {{part}}) k) n"""

AREA_BASE = """
SELECT l_partkey AS b, l_orderkey % 24 AS inj_id,
  cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS bigint) AS raw
FROM {lineitem} GROUP BY l_partkey, l_orderkey % 24"""

_INJECTION = """CASE WHEN inj_id IN (0, 1) THEN 'Blank_0' || cast(inj_id AS string)
    WHEN inj_id % 5 = 2 THEN 'QC_' || lpad(cast(inj_id AS string), 2, '0')
    WHEN inj_id = 23 THEN 'Std_Mix_23' ELSE 'S_' || lpad(cast(inj_id AS string), 2, '0') END"""

AREAS = f"""
SELECT g.study_id, g.polarity, g.group_id, {_INJECTION} AS injection,
  cast(a.raw * CASE g.m WHEN 1 THEN 30 WHEN 2 THEN 15 WHEN 3 THEN 20 + 10 * (a.inj_id % 5) ELSE 100 END
    * CASE WHEN a.inj_id IN (0, 1) AND g.b % 10 <> 0 THEN 5 ELSE 100 END AS bigint) AS area
FROM {{groups}} g JOIN {{area_base}} a ON g.b = a.b"""

INJECTIONS = f"""
SELECT study_id, polarity, inj_id, {_INJECTION} AS injection,
  CASE WHEN inj_id IN (0, 1) THEN 'blank' WHEN inj_id % 5 = 2 THEN 'qc' WHEN inj_id = 23 THEN 'standard'
    ELSE 'sample' END AS role,
  cast(inj_id + 1 AS int) AS run_order, CASE WHEN inj_id % 2 = 0 THEN 'case' ELSE 'control' END AS grp
FROM (SELECT study_id, polarity, cast({{series}} AS bigint) AS inj_id FROM (SELECT DISTINCT study_id, polarity FROM {{groups}}) r) i"""

SCANS = f"""
SELECT CASE WHEN event_id % 7 < 4 THEN 'A' ELSE 'B' END AS study_id,
  CASE WHEN event_id % 3 < 2 THEN '+' ELSE '-' END AS polarity, {_INJECTION} AS injection, inj_id,
  event_id AS ms2_id, 100e0 + value AS precursor_mz,
  {{micros}} / 60e6 * 25e0 / 43200e0 AS rt,
  event_type = 'purchase' AS identified, event_type, user_id, value
FROM (SELECT *, event_id % 24 AS inj_id FROM {{events}}) e"""


def cte(*names: str) -> str:
    """WITH clause text (without the keyword) for the named views, for the reference SQL."""
    order = ["groups", "area_base", "areas", "injections", "scans", "spectra_peaks", "spectra"]
    needs = {"areas": {"groups", "area_base"}, "injections": {"groups"}, "spectra": {"spectra_peaks"}}
    wanted = set(names)
    for n in names:
        wanted |= needs.get(n, set())
    text = {"groups": GROUPS.format(part="part"), "area_base": AREA_BASE.format(lineitem="lineitem"),
            "areas": AREAS.format(groups="groups", area_base="area_base"),
            "injections": INJECTIONS.format(series="unnest(range(0, 24))", groups="groups"),
            "scans": SCANS.format(events="events", micros="(epoch_us(ts) - 1704067200000000)"),
            "spectra_peaks": SPECTRA_PEAKS_SQL, "spectra": SPECTRA_SQL}
    return ",\n".join(f"{n} AS ({text[n]})" for n in order if n in wanted)


def groups(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(GROUPS, part=read(spark, d, "part"))


def areas(spark: SparkSession, d: str) -> DataFrame:
    base = spark.sql(AREA_BASE, lineitem=read(spark, d, "lineitem"))
    return spark.sql(AREAS, groups=spread(groups(spark, d)), area_base=base)


def injections(spark: SparkSession, d: str) -> DataFrame:
    text = INJECTIONS.replace("cast({series} AS bigint)", "explode(sequence(0L, 23L))")
    return spark.sql(text, groups=groups(spark, d))


def scans(spark: SparkSession, d: str) -> DataFrame:
    text = SCANS.replace("{micros}", "timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)")
    return spark.sql(text, events=read(spark, d, "events"))


SPECTRA_PEAKS_SQL = """
SELECT vec_id, label, vec_id % 5 = 0 AS is_library, 760e0 + label * 0.004e0 AS precursor_mz, k,
  100e0 + 10 * k + label / 1000e0 AS mz, abs(cast(embedding[k + 1] AS double)) * 1000 AS intensity
FROM (SELECT vec_id, label, embedding, unnest(range(0, 64)) AS k FROM embeddings) e"""
SPECTRA_SQL = """
SELECT vec_id, label, is_library, precursor_mz FROM spectra_peaks GROUP BY ALL"""


#: Five hundred embeddings are the scans of six injections over one gradient of five minutes; more embeddings are more injections.
SCAN_INJECTION = "concat('S_', cast(cast(floor(vec_id / 500) AS bigint) * 6 + vec_id % 6 AS string))"
GRADIENT_RT = "(vec_id % 500) / 100e0"


def spectra(spark: SparkSession, d: str) -> DataFrame:
    """One row per embedding with a 64-peak array; every fifth is a library entry."""
    return read(spark, d, "embeddings").selectExpr(
        "vec_id", "label", "vec_id % 5 = 0 AS is_library", "760e0 + label * 0.004e0 AS precursor_mz",
        "transform(embedding, (e, k) -> named_struct('mz', 100e0 + 10 * k + label / 1000e0, "
        "'intensity', abs(cast(e AS double)) * 1000)) AS peaks")
