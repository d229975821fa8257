"""Spectrum files: MSP libraries, MGF peak lists, mzML scans.  All are read as splittable records."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from massloom.functions.numeric import half_up
from massloom.functions.peaks import scale_peaks, split_annotation

NATIVE_MARKER = "LipiDex"  # fixed value: comment text that marks a library whose peaks carry chain annotations
LOW_MASS, RAW_FLOOR = 61.0, 1.0
_NUMBER = r"[-+0-9.eE]+"


def _records(spark: SparkSession, paths, separator: str) -> DataFrame:
    """Text records split at ``separator`` with ``file``, ``block`` (offset of the split) and ``idx``."""
    raw = spark.read.option("lineSep", separator).text(paths)
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("idx"))


def _line(lines: Column, pattern: str) -> Column:
    return F.get(F.filter(lines, lambda x: x.rlike(pattern)), F.lit(0))


def read_msp(spark: SparkSession, paths, crlf: bool = False, library: str | None = None, native_marker: str = NATIVE_MARKER) -> DataFrame:
    """Library spectra, one row per entry.

    Two dialects: the adduct inside the name, or in ``PRECURSORTYPE:`` and then appended to it (with
    ``crlf``, records end in CRLF pairs).  A peak is kept when it lies more than 2 Da under the
    precursor; intensities are scaled to 999 and peaks under 5 dropped; annotations are read only
    where the entry is marked native.  ``entry_seq`` (split, record in it) orders the entries of a file.
    """
    rows = _records(spark, paths, "\r\n\r\n" if crlf else "\n\n")
    lines = F.transform(F.split("value", "\n"), lambda x: F.regexp_replace(x, r"\r$", ""))
    rows = rows.withColumn("lines", lines).withColumn("start", F.array_max(F.transform(
        "lines", lambda x, i: F.when(x.contains("Num Peaks:"), i)))).filter("start IS NOT NULL")
    name = F.regexp_extract(_line(F.col("lines"), r"^[^:]*(Name|NAME):"), r"^[^:]*:.(.*)$", 1)
    kind = F.trim(F.regexp_extract(_line(F.col("lines"), r"(?i)^PRECURSORTYPE:"), r":(.*)$", 1))
    precursor = F.regexp_extract(_line(F.col("lines"), r"PRECURSORMZ:"), rf"({_NUMBER})\s*$", 1)
    rows = (rows.withColumn("precursor_mz", precursor.try_cast("double"))
            .withColumn("name", F.when(kind != "", F.concat(name, F.lit(" "), kind)).otherwise(name))
            .withColumn("is_native", F.exists("lines", lambda x: x.contains(native_marker) | x.rlike(r"(?i)^ISLIPIDEX: TRUE")))
            .withColumn("optimal_polarity", F.exists("lines", lambda x: x.contains("OptimalPolarity=true") | x.rlike(r"(?i)^OPTIMALPOLARITY: TRUE"))))
    rows = rows.filter("precursor_mz > 0")
    body = F.filter(F.slice("lines", F.col("start") + 2, F.greatest(F.size("lines"), F.lit(1))), lambda x: x.contains(".") & x.rlike(rf"^{_NUMBER}[\t ]"))

    def peak(x: Column) -> Column:
        note = F.when(F.col("is_native"), F.regexp_extract(x, r'"(.*)"', 1)).otherwise("")
        a = split_annotation(note)
        return F.struct(F.regexp_extract(x, rf"^({_NUMBER})", 1).cast("double").alias("mz"),
                        F.regexp_extract(x, rf"^{_NUMBER}[\t ]({_NUMBER})", 1).cast("double").alias("intensity"),
                        note.alias("annotation"), a["type"].alias("type"), a["chain"].alias("chain"))

    rows = rows.withColumn("peaks", F.filter(F.transform(body, peak), lambda p: F.col("precursor_mz") - p["mz"] > 2.0))
    rows = rows.withColumn("peaks", scale_peaks(F.col("peaks"), ("annotation", "type", "chain")))
    lib = F.lit(library) if library else F.substring_index("file", "/", -1)
    return rows.select(lib.alias("library"), F.struct("block", "idx").alias("entry_seq"),
                       "name", "precursor_mz", "is_native", "optimal_polarity", "peaks")


def _injection() -> Column:
    return F.regexp_replace(F.substring_index("file", "/", -1), r"(?i)\.(mgf|mzml)$", "")


def read_mgf(spark: SparkSession, paths, min_mz: float = LOW_MASS) -> DataFrame:
    """MS2 spectra of MGF files: ``injection, ms2_id, polarity, precursor_mz, rt, peaks``.

    ``ms2_id`` counts ``END IONS`` from 0, spectra without peaks included.  Precursor and retention
    are rounded half up to three decimals; the 1.5 Da cut uses the unrounded precursor.
    """
    rows = _records(spark, paths, "END IONS").filter(F.col("value").rlike("="))
    place = ["file", "block", "idx"]
    numbers = rows.select(*place, (F.row_number().over(Window.partitionBy("file").orderBy("block", "idx")) - 1).cast("int").alias("ms2_id"))
    rows = rows.join(numbers, place)
    rows = rows.withColumn("lines", F.filter(F.transform(F.split("value", "\n"), lambda x: F.regexp_replace(x, r"\r$", "")), lambda x: ~x.startswith("#")))
    first = lambda key: F.regexp_extract(_line(F.col("lines"), key), rf"=\s*({_NUMBER})", 1).try_cast("double")
    charge = _line(F.col("lines"), "CHARGE")
    rows = rows.withColumn("p", F.coalesce(first("PEPMASS="), F.lit(0.0))).withColumn("t", F.coalesce(first("RTINSECONDS"), F.lit(0.0)) / 60)
    body = F.filter("lines", lambda x: x.contains(".") & ~x.contains("TITLE") & ~x.contains("=") & x.rlike(rf"^{_NUMBER} "))
    rows = rows.withColumn("body", body).filter(F.size("body") > 0)
    peaks = F.transform("body", lambda x: F.struct(F.substring_index(x, " ", 1).cast("double").alias("mz"),
                                                   F.get(F.split(x, " "), F.lit(1)).cast("double").alias("intensity")))
    kept = F.filter(peaks, lambda k: (F.col("p") - k["mz"] > 1.5) & (k["mz"] > min_mz) & (k["intensity"] > RAW_FLOOR))
    return rows.select(_injection().alias("injection"), "ms2_id", F.when(F.coalesce(charge, F.lit("")).contains("-"), "-").otherwise("+").alias("polarity"),
                       half_up(F.col("p"), 3).alias("precursor_mz"), half_up(F.col("t"), 3).alias("rt"), kept.alias("peaks"))


# ---- mzML -------------------------------------------------------------------------------------

_CV = "array<struct<_accession: string, _name: string, _value: string, _unitName: string>>"
MZML_SCHEMA = (f"_index long, _id string, cvParam {_CV}, scanList struct<scan: array<struct<cvParam: {_CV}>>>, "
               f"precursorList struct<precursor: array<struct<isolationWindow: struct<cvParam: {_CV}>, "
               f"selectedIonList: struct<selectedIon: array<struct<cvParam: {_CV}>>>>>>, "
               f"binaryDataArrayList struct<binaryDataArray: array<struct<cvParam: {_CV}, binary: string>>>")


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _decode(payload: pa.Array, wide: pa.Array, packed: pa.Array) -> pa.Array:
    """Binary arrays of one batch: 32- or 64-bit little-endian floats, zlib-packed or plain."""
    out = []
    for raw, is64, zipped in zip(payload.to_pylist(), wide.to_pylist(), packed.to_pylist()):
        if raw is None:
            out.append([])
            continue
        data = zlib.decompress(raw) if zipped and raw else raw
        out.append(np.frombuffer(data, dtype="<f8" if is64 else "<f4").astype(float))
    return pa.array(out, pa.list_(pa.float64()))


def _cv(params: Column, accession: str) -> Column:
    return F.get(F.filter(params, lambda c: c["_accession"] == accession), F.lit(0))


def _has(params: Column, accession: str) -> Column:
    return F.exists(F.coalesce(params, F.array().cast(_CV.replace(": ", ":"))), lambda c: c["_accession"] == accession)


def _spectra(spark: SparkSession, paths) -> DataFrame:
    rows = (spark.read.format("xml").option("rowTag", "spectrum").option("ignoreNamespace", "true").schema(MZML_SCHEMA).load(paths)
            .withColumn("file", F.col("_metadata.file_path")))
    scan = F.get(F.col("scanList.scan"), F.lit(0))["cvParam"]
    rt = _cv(scan, "MS:1000016")
    seconds = rt["_unitName"] == "second"
    return (rows.withColumn("injection", _injection()).withColumn("scan_no", F.col("_index"))
            .withColumn("ms_level", _cv(F.col("cvParam"), "MS:1000511")["_value"].cast("int"))
            .withColumn("rt", F.when(seconds, rt["_value"].cast("double") / 60).otherwise(rt["_value"].cast("double")))
            .withColumn("stated", F.when(_has(F.col("cvParam"), "MS:1000129"), "-").when(_has(F.col("cvParam"), "MS:1000130"), "+"))
            .withColumn("tic", _cv(F.col("cvParam"), "MS:1000285")["_value"].cast("double"))
            .withColumn("injection_time", _cv(scan, "MS:1000927")["_value"].cast("double")))


def _with_peaks(rows: DataFrame) -> DataFrame:
    arrays = F.col("binaryDataArrayList.binaryDataArray")
    pick = lambda acc: F.get(F.filter(arrays, lambda a: F.exists(a["cvParam"], lambda c: c["_accession"] == acc)), F.lit(0))
    out = rows.withColumn("__m", pick("MS:1000514")).withColumn("__i", pick("MS:1000515"))
    read = lambda c: _decode(F.unbase64(F.regexp_replace(F.col(f"{c}.binary"), r"\s", "")), _has(F.col(f"{c}.cvParam"), "MS:1000523"),
                             _has(F.col(f"{c}.cvParam"), "MS:1000574"))
    out = out.withColumn("__mz", read("__m")).withColumn("__in", read("__i"))
    zipped = F.transform(F.arrays_zip("__mz", "__in"), lambda p: F.struct(p["__mz"].alias("mz"), p["__in"].alias("intensity")))
    return out.withColumn("peaks", zipped).drop("__m", "__i", "__mz", "__in")


def read_mzml_ms1(spark: SparkSession, paths) -> DataFrame:
    """MS1 scans: ``injection, scan_no, rt, peaks``."""
    return _with_peaks(_spectra(spark, paths).filter("ms_level = 1")).select("injection", "scan_no", "rt", "stated", "peaks")


def read_mzml_ms2(spark: SparkSession, paths, min_mz: float = LOW_MASS, exclude_mz: tuple[float, ...] = (), exclude_tol: float = 0.06) -> DataFrame:
    """MS2 spectra with the MGF filters, listed masses excluded; ``ms2_id`` counts every MS2 scan, those
    without a precursor included."""
    rows = _spectra(spark, paths).filter("ms_level = 2")
    rows = rows.withColumn("ms2_id", (F.row_number().over(Window.partitionBy("file").orderBy("scan_no")) - 1).cast("int"))
    ion = F.get(F.get(F.col("precursorList.precursor"), F.lit(0))["selectedIonList"]["selectedIon"], F.lit(0))["cvParam"]
    rows = rows.withColumn("p", _cv(ion, "MS:1000744")["_value"].cast("double")).filter("p IS NOT NULL")
    bad = F.array(*[F.lit(float(m)) for m in exclude_mz]).cast("array<double>")
    kept = F.filter("peaks", lambda k: (F.col("p") - k["mz"] > 1.5) & (k["mz"] > min_mz) & (k["intensity"] > RAW_FLOOR)
                    & ~F.exists(bad, lambda b: F.abs(k["mz"] - b) <= exclude_tol))
    return _with_peaks(rows).select("injection", "ms2_id", F.coalesce("stated", F.lit("+")).alias("polarity"), half_up(F.col("p"), 3).alias("precursor_mz"),
                                    half_up(F.col("rt"), 3).alias("rt"), kept.alias("peaks"))


def read_scan_table(spark: SparkSession, paths) -> DataFrame:
    """Scan headers without peaks: level, time, isolation window, injection time, total signal."""
    rows = _spectra(spark, paths)
    first = F.get(F.col("precursorList.precursor"), F.lit(0))
    window = first["isolationWindow"]["cvParam"]
    return rows.select("injection", "scan_no", "ms_level", "rt", "stated", "tic", "injection_time",
                       _cv(window, "MS:1000827")["_value"].cast("double").alias("isolation_target"),
                       _cv(window, "MS:1000828")["_value"].cast("double").alias("isolation_lower"),
                       (F.size(F.coalesce(first["selectedIonList"]["selectedIon"]["cvParam"], F.array())) > 0).alias("has_selection"))


def incomplete_files(spark: SparkSession, paths) -> DataFrame:
    """mzML files that never close: ``file``.  Line scan, split across tasks; only a flag is kept."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("value").contains("</mzML>").alias("closed"))
    return lines.groupBy("file").agg(F.bool_or("closed").alias("closed")).filter("NOT closed").select("file")
