"""Readers on small hand-written files."""

import base64
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from massloom.sources import spectra as R
from massloom.sources import tables as T

MSP = """Name: PC 16:0_18:1 [M+H]+;
MW: 760.58
PRECURSORMZ: 760.5851
Comment: Name=PC Mass=760.58 OptimalPolarity=true Type=LipiDex
Num Peaks: 4
184.0733 500 "C5H15NO4P_Fragment_[]"
504.3449 999 "O-1_Alkyl Fragment_[16:0]"
478.3292 4 "O-1_Alkyl Fragment_[18:1]"
759.0000 100 "near_Fragment_[]"

Name: PE 34:1 [M-H]-;
PRECURSORMZ: 716.5236
Comment: plain
Num Peaks: 1
255.2330 10

"""
MSP2 = "NAME: CE 18:1\r\nPRECURSORMZ: 668.6340\r\nPRECURSORTYPE: [M+NH4]+\r\nISLIPIDEX: TRUE\r\nOPTIMALPOLARITY: TRUE\r\nNum Peaks: 1\r\n369.3516\t999\t\"C27H45_Fragment_[]\"\r\n\r\n"
MGF = """BEGIN IONS
TITLE=one
PEPMASS=500.12345 100.0
RTINSECONDS=90.5
CHARGE=1-
100.5 10.0
499.0 50.0
60.5 30.0
200.25 0.5
END IONS
BEGIN IONS
TITLE=empty
PEPMASS=300.0
END IONS
BEGIN IONS
PEPMASS=400.0005
RTINSECONDS=120
CHARGE=1+
150.1 20.0
END IONS
"""


def test_msp_dialects(spark, tmp_path):
    (tmp_path / "a.msp").write_text(MSP)
    rows = {r["name"]: r for r in R.read_msp(spark, str(tmp_path / "a.msp")).collect()}
    pc = rows["PC 16:0_18:1 [M+H]+;"]
    assert pc["is_native"] and pc["optimal_polarity"] and pc["precursor_mz"] == 760.5851
    # the precursor region and peaks under 5 of 999 are gone
    assert [round(p["mz"], 4) for p in pc["peaks"]] == [184.0733, 504.3449]
    assert pc["peaks"][1]["type"] == "O-1_Alkyl Fragment" and pc["peaks"][1]["chain"] == "16:0"
    pe = rows["PE 34:1 [M-H]-;"]
    assert not pe["is_native"] and pe["peaks"][0]["intensity"] == pytest.approx(999.0) and pe["peaks"][0]["type"] is None
    (tmp_path / "b.msp").write_bytes(MSP2.encode())
    ce = R.read_msp(spark, str(tmp_path / "b.msp"), crlf=True).collect()
    assert len(ce) == 1 and ce[0]["name"] == "CE 18:1 [M+NH4]+" and ce[0]["optimal_polarity"] and len(ce[0]["peaks"]) == 1


def test_mgf_numbering_and_filters(spark, tmp_path):
    (tmp_path / "S_01.mgf").write_text(MGF)
    rows = sorted(R.read_mgf(spark, str(tmp_path / "S_01.mgf")).collect(), key=lambda r: r["ms2_id"])
    assert [r["ms2_id"] for r in rows] == [0, 2] and rows[0]["injection"] == "S_01"
    assert rows[0]["precursor_mz"] == 500.123 and rows[0]["rt"] == 1.508 and rows[0]["polarity"] == "-"
    assert [p["mz"] for p in rows[0]["peaks"]] == [100.5]
    assert rows[1]["precursor_mz"] == 400.001 and rows[1]["polarity"] == "+"


def _array(values, code, accession, packed):
    raw = struct.pack(f"<{len(values)}{code}", *values)
    text = base64.b64encode(zlib.compress(raw) if packed else raw).decode()
    bits = "MS:1000523" if code == "d" else "MS:1000521"
    comp = "MS:1000574" if packed else "MS:1000576"
    return (f'<binaryDataArray><cvParam accession="{bits}" name="b" value=""/><cvParam accession="{comp}" name="c" value=""/>'
            f'<cvParam accession="{accession}" name="a" value=""/><binary>{text}</binary></binaryDataArray>')


def _spectrum(index, level, mz, inten, precursor=None, code="d", packed=True):
    pre = "" if precursor is None else (
        f'<precursorList><precursor><isolationWindow><cvParam accession="MS:1000827" name="t" value="{precursor}"/>'
        f'<cvParam accession="MS:1000828" name="l" value="0.5"/></isolationWindow><selectedIonList><selectedIon>'
        f'<cvParam accession="MS:1000744" name="m" value="{precursor}"/></selectedIon></selectedIonList></precursor></precursorList>')
    return (f'<spectrum index="{index}" id="scan={index}"><cvParam accession="MS:1000511" name="ms level" value="{level}"/>'
            f'<cvParam accession="MS:1000130" name="positive scan" value=""/><scanList><scan>'
            f'<cvParam accession="MS:1000016" name="t" value="{60 * (index + 1)}" unitName="second"/></scan><scan/></scanList>{pre}'
            f'<binaryDataArrayList>{_array(mz, code, "MS:1000514", packed)}{_array(inten, code, "MS:1000515", packed)}</binaryDataArrayList></spectrum>')


def test_mzml_scans(spark, tmp_path):
    body = (_spectrum(0, 1, [100.0, 200.5], [10.0, 20.0]) + _spectrum(1, 2, [90.0, 120.06, 150.0], [5.0, 9.0, 7.0], 300.12345, "f", False)
            + _spectrum(2, 2, [80.0], [4.0]) + _spectrum(3, 2, [99.0], [8.0], 310.0))
    (tmp_path / "S_01.mzML").write_text(f"<mzML><run><spectrumList>\n{body}\n</spectrumList></run></mzML>")
    (tmp_path / "S_02.mzML").write_text("<mzML><run><spectrumList>\n<spectrum index=\"0\" id=\"x\">")
    one = str(tmp_path / "S_01.mzML")
    ms1 = R.read_mzml_ms1(spark, one).collect()
    assert len(ms1) == 1 and [p["mz"] for p in ms1[0]["peaks"]] == [100.0, 200.5] and ms1[0]["rt"] == 1.0
    ms2 = sorted(R.read_mzml_ms2(spark, one, exclude_mz=(120.0,)).collect(), key=lambda r: r["ms2_id"])
    assert [r["ms2_id"] for r in ms2] == [0, 2]  # the scan without a precursor is counted
    assert ms2[0]["precursor_mz"] == 300.123 and [p["mz"] for p in ms2[0]["peaks"]] == [90.0, 150.0]
    head = {r["scan_no"]: r for r in R.read_scan_table(spark, one).collect()}
    assert head[1]["isolation_target"] == 300.12345 and head[1]["has_selection"] and not head[2]["has_selection"]
    bad = R.incomplete_files(spark, str(tmp_path / "*.mzML")).collect()
    assert len(bad) == 1 and bad[0]["file"].endswith("S_02.mzML")


def test_hits_and_cells(spark, tmp_path):
    head = ",".join(list(T.HIT_COLUMNS)[:14])
    (tmp_path / "S_01_Results.csv").write_text(
        f"{head},Potential Fragments\n1,2.5,1,PC 34:1 [M+H]+;,760.58,760.585,1.0,900,950,82,PC 34:1 [M+H]+(82) / PE 1:0 [M+H]+(18),true,true,lib,184.07 | 504.3 | x\n"
        "2,bad,1,PC,1,1,1,1,1,0,,true,true,lib,\n")
    rows = T.read_hits(spark, str(tmp_path / "S_01_Results.csv")).collect()
    assert len(rows) == 1 and rows[0]["injection"] == "S_01" and rows[0]["optimal_polarity"] is True
    assert [tuple(c) for c in rows[0]["components"]] == [("PC 34:1 [M+H]+", 82), ("PE 1:0 [M+H]+", 18)] and rows[0]["fragments"] == [184.07, 504.3]
    sn = spark.createDataFrame([("18:1 favoured sn-2 (2.5x)",), ("class not covered",)], "c string").select(T.parse_sn(F.col("c")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in sn] == [("18:1", 2.5), ("", 0.0)]


def test_results_wide_to_long(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Compound Group,Retention Time (min),Quant Ion,Identification,S_01,QC.02\n1,1.5,760.5,PC 34:1,10,0\n2,2.5,700.1,,5,7\n")
    rows, areas = T.read_results(spark, str(tmp_path / "r.csv"))
    assert rows.count() == 2 and sorted(tuple(r) for r in areas.collect()) == [(1, "S_01", 10.0), (2, "QC.02", 7.0), (2, "S_01", 5.0)]
    (tmp_path / "e.csv").write_text("Compound Group,Quant Ion,S_01\n")
    rows, areas = T.read_results(spark, str(tmp_path / "e.csv"))
    assert rows.count() == 0 and areas.columns == ["group_id", "injection", "area"] and areas.count() == 0


def test_nested_export(spark, tmp_path):
    (tmp_path / "n.csv").write_text("Checked,Name,RT [min]\n,Checked,Study File ID,Area\n,,Checked,m/z\nF,A,1.5\n,F,F1,100\n,,F,700.1\n,,F,701.1\nF,B,2.5\n,F,F2,50\n,,F,800.2\n")
    rows = sorted(T.read_nested_export(spark, str(tmp_path / "n.csv")).collect(), key=lambda r: r["line"])
    assert [r["level"] for r in rows] == [0, 1, 2, 2, 0, 1, 2]
    assert rows[3]["group_line"] == rows[0]["line"] and rows[6]["group_line"] == rows[4]["line"] and rows[6]["compound_line"] == rows[5]["line"]
    assert rows[0]["fields"]["Name"] == "A" and rows[1]["fields"]["Study File ID"] == "F1" and rows[6]["fields"]["m/z"] == "800.2"


def test_sequence(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Bracket Type=4,\nSample Type,File Name,Sample ID,Path\nUnknown,a,GE8,D:/pos\nQC,b,RH5,D:/pos\nUnknown,a,GE8,D:/neg\n")
    got = {r["name"]: r["run_order"] for r in T.read_sequence(spark, str(tmp_path / "s.csv")).collect()}
    assert got == {"a": 1, "a_Pos": 1, "b": 2, "b_Pos": 2, "a_Neg": 3}
    types = {r["name"]: r["sample_type"] for r in T.read_sample_types(spark, str(tmp_path / "s.csv")).collect()}
    assert types == {"a": "Unknown", "b": "QC"}
    (tmp_path / "t.csv").write_text("Bracket Type=4\nFile Name,Sample ID\nx,Inj_07\ny,Inj_03\n")
    assert {r["name"]: r["run_order"] for r in T.read_sequence(spark, str(tmp_path / "t.csv")).collect()} == {"x": 7, "y": 3}


def test_run_order_from_stamps(spark):
    files = spark.createDataFrame([("A", "x", "2026-01-01 10:00:00"), ("A", "y", "2026-01-01 09:00:00"), ("A", "z", "2026-01-01 11:00:00"), ("B", "p", None), ("B", "q", "2026-01-01 09:00:00")],
                                  "study_id string, injection string, s string").withColumn("stamp", F.to_timestamp("s"))
    plan = spark.createDataFrame([("A", "x", 1), ("A", "y", 2), ("A", "z", 3), ("B", "p", 1), ("B", "q", 2)], "study_id string, injection string, planned_order int")
    got = {(r["study_id"], r["injection"]): (r["run_order"], r["order_source"], r["n_moved"]) for r in T.run_order_from_stamps(files.drop("s"), plan).collect()}
    assert got[("A", "y")] == (1, "acquisition timestamp", 2) and got[("A", "z")][0] == 3 and got[("B", "p")] == (1, "sequence file", 0)


def test_small_tables(spark, tmp_path):
    (tmp_path / "a1.csv").write_text("Name,Formula,Loss,Polarity,Charge\n[M+H]+,H1,FALSE,+,1\n[M-H]-,H-1,TRUE,-,1\n")
    (tmp_path / "a2.csv").write_text("Name,Formula,Loss,Polarity,Charge\n[M+H]+,H2,FALSE,+,1\n[M+Na]+,Na1,FALSE,+,\n")
    add = {r["adduct"]: r for r in T.read_adducts(spark, [str(tmp_path / "a1.csv"), str(tmp_path / "a2.csv")]).collect()}
    assert add["[M+H]+"]["adduct_mass"] == pytest.approx(1.007825035) and add["[M-H]-"]["adduct_mass"] == pytest.approx(-1.007825035) and add["[M+Na]+"]["charge"] == 1
    (tmp_path / "c.csv").write_text("Name,Base,Formula,Enabled\n16:0,Alkyl,C16H31O2,true\n2:0,Alkyl,C2H3O2,false\n")
    assert T.read_chains(spark, str(tmp_path / "c.csv")).count() == 2
    (tmp_path / "p.csv").write_text("class,polarity,basis,note\n# why\nPC,Pos,chemistry,x\nPE,negative,chemistry,y\n")
    (tmp_path / "q.csv").write_text("class,polarity,basis,note\nPE,+,study,z\n")
    pol = {r["lipid_class"]: (r["assigned"], r["origin"]) for r in T.read_class_polarity(spark, str(tmp_path / "p.csv"), str(tmp_path / "q.csv")).collect()}
    assert pol == {"PC": ("+", "default"), "PE": ("+", "study")}
    (tmp_path / "w.csv").write_text("class,polarity,basis,note\nPE,maybe,,\n")
    with pytest.raises(Exception, match="unreadable polarity"):
        T.read_class_polarity(spark, str(tmp_path / "w.csv")).collect()
    (tmp_path / "m.csv").write_text("sample,group\nS1 , case\nS2,control\n")
    assert [tuple(r) for r in T.read_metadata(spark, str(tmp_path / "m.csv"), ["group"]).collect()] == [("S1", "case"), ("S2", "control")]
    (tmp_path / "std.csv").write_text("name,formula,adduct,polarity\nd7 PC,C41H73D7NO8P,[M+H]+,+\n")
    assert T.read_standards(spark, str(tmp_path / "std.csv")).collect()[0]["expected_mz"] == pytest.approx(753.6134, abs=1e-3)
    (tmp_path / "rt.csv").write_text("name,retention\nFA 18:1,10.36\nFA x,9\n")
    assert [tuple(r) for r in T.read_anchors(spark, str(tmp_path / "rt.csv")).collect()] == [(18, 1, 10.36)]
    (tmp_path / "cons.csv").write_text("source,tier,name,value\nB,Ref,PC O-34:1/P-34:0/33:1,2.5\n")
    got = sorted((r["alternative"], r["kind"], r["carbons"], r["double_bonds"]) for r in T.read_consensus(spark, str(tmp_path / "cons.csv")).collect())
    assert got == [("PC 33:1", "", 33, 1), ("PC O-34:1", "ether", 34, 1), ("PC P-34:0", "ether", 34, 1)]


def test_distinct_files(spark):
    rows = [("A", "/x/s1.raw", 10, b"a"), ("A", "/x/s1.mzML", 12, b"b"), ("A", "/x/long_s1.mzML", 12, b"b"), ("A", "/x/s2.mzML", 12, b"c")]
    f = spark.createDataFrame([r[:3] for r in rows], "study_id string, path string, size long")
    chunks = spark.createDataFrame([(path, k, part) for _, path, _, last in rows for k, part in enumerate([b"same head", last])], "path string, chunk_no int, data binary")
    assert sorted(r["path"] for r in T.distinct_files(f, chunks).collect()) == ["/x/s1.mzML", "/x/s2.mzML"]


def test_attach_measured_rt(spark):
    f = spark.createDataFrame([("A", "+", 1, "S1", 700.0, 5.0, 5.0, 100.0), ("A", "+", 2, "S1", 800.0, 6.0, 6.0, 100.0)],
                              "study_id string, polarity string, group_id long, injection string, mz double, rt_aligned double, group_rt double, area double")
    u = spark.createDataFrame([("A", "+", "S1", 700.001, 5.05, 99.0), ("A", "+", "S1", 800.0, 6.05, 50.0)], "study_id string, polarity string, injection string, u_mz double, u_rt double, u_area double")
    w = spark.createDataFrame([("A", "+", 0.1)], "study_id string, polarity string, run_fwhm double")
    got = {r["group_id"]: r["rt_measured"] for r in T.attach_measured_rt(f, u, w).collect()}
    assert got == {1: 5.05, 2: None}


def test_ordered(spark, tmp_path):
    """Places equal a plain sort by run, with a run that holds most rows, null keys, ties and an empty table."""
    import random

    from massloom.sources import sinks
    r = random.Random(5)
    data = [("A" if r.random() < 0.8 else r.choice(["B", None]), r.choice("+-"), i, r.choice([1.0, 2.0, None, r.random()])) for i in range(3000)]
    rows = spark.createDataFrame(data, "study_id string, polarity string, group_id long, rt double").repartition(7)
    got = {x.group_id: x.place for x in sinks.in_order(rows, "groups").collect()}
    want, seen = {}, {}
    for study, polarity, i, _ in sorted(data, key=lambda x: (x[3] is not None, x[3] or 0.0, x[2])):
        seen[study, polarity] = want[i] = seen.get((study, polarity), 0) + 1
    assert got == want
    assert sinks.in_order(rows.filter("false"), "groups").count() == 0
    sinks.write_ordered(rows.withColumn("scans", rows["group_id"] % 9).withColumn("mz", rows["group_id"].cast("double")), "wasted", str(tmp_path / "w"), "parquet")
    import pyarrow.parquet as pq
    read = [x for f in sorted((tmp_path / "w").glob("*.parquet")) for x in pq.read_table(f).to_pylist() if x["study_id"] == "A" and x["polarity"] == "+"]
    assert [x["place"] for x in read] == list(range(1, len(read) + 1))
    assert [(-x["scans"], x["mz"]) for x in read] == sorted((-x["scans"], x["mz"]) for x in read)
