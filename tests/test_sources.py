"""CSV discovery, scan and sink round trip on the fixture exports."""

import csv
import os
import tempfile

import pytest

from roasline.operators import normalize as N
from roasline.sources import csv_io as S
from roasline.sources.fixtures import raw_exports

from conftest import SF_SMALL


def _sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_round_trip_and_discovery(spark):
    raw = raw_exports(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="roasline-src-", dir=os.environ.get("TMPDIR", "/tmp"))
    names = {"google": "google_ads_campaigns", "bing": "bing_campaign_report", "meta": "meta_ads_insights"}
    for p, df in raw.items():
        out = f"{d}/{p}_dir"
        df.coalesce(1).write.option("header", True).csv(out)
        part = [f for f in os.listdir(out) if f.endswith(".csv")][0]
        os.link(f"{out}/{part}", f"{d}/{names[p]}.csv")
    found = S.export_files(spark, d)
    assert {p: [os.path.basename(x) for x in v] for p, v in found.items()} == {p: [f"{n}.csv"] for p, n in names.items()}
    loaded = S.load_exports(spark, d)
    direct = N.normalize_all(raw)
    via_csv = N.normalize_all(loaded)
    assert _sorted_rows(direct) == _sorted_rows(via_csv)
    summary = {r.platform: (r.rows, r.columns) for r in S.dataset_summary(loaded).collect()}
    assert summary["google"][1] == 10 and summary["meta"][1] == 8


def test_all_files_count_and_columns_go_by_name(spark):
    """Three files a platform, each with another column order and one with columns nobody knows."""
    raw = raw_exports(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="roasline-src-", dir=os.environ.get("TMPDIR", "/tmp"))
    stems = {"google": "google_ads", "bing": "microsoft", "meta": "facebook"}
    for p, df in raw.items():
        rows = [tuple(r) for r in df.collect()]
        for n in range(3):
            order = list(range(len(df.columns)))
            order = order[n:] + order[:n]
            with open(f"{d}/{stems[p]}_2024-0{n + 1}.csv", "w", newline="") as file:
                out = csv.writer(file)
                out.writerow([df.columns[k] for k in order] + (["reach", "cpc"] if n == 2 else []))
                out.writerows([["" if r[k] is None else r[k] for k in order] + (["9", "8"] if n == 2 else []) for r in rows[n::3]])
    loaded = S.load_exports(spark, d)
    assert {p: f.count() for p, f in loaded.items()} == {p: f.count() for p, f in raw.items()}
    assert _sorted_rows(N.normalize_all(loaded)) == _sorted_rows(N.normalize_all(raw))


def test_discovery_errors(spark):
    d = tempfile.mkdtemp(prefix="roasline-src-", dir=os.environ.get("TMPDIR", "/tmp"))
    with pytest.raises(FileNotFoundError):
        S.export_files(spark, d)
    with pytest.raises(FileNotFoundError):
        S.export_files(spark, d + "/missing")
    open(f"{d}/google.csv", "w").write("a\n1\n")
    with pytest.raises(FileNotFoundError, match="bing, meta"):
        S.export_files(spark, d)
    with pytest.raises(ValueError, match="more than one"):
        S.by_platform({"google_bing.csv": "x"})


def test_parquet_sink_round_trip(spark):
    raw = raw_exports(spark, SF_SMALL)
    u = N.normalize_all(raw)
    d = tempfile.mkdtemp(prefix="roasline-sink-", dir=os.environ.get("TMPDIR", "/tmp"))
    S.write_table(u, f"{d}/unified", partition_by=["channel"])
    back = spark.read.parquet(f"{d}/unified").select(*u.columns)
    assert _sorted_rows(back) == _sorted_rows(u)


def test_unreadable_lines_are_set_apart(spark):
    d = tempfile.mkdtemp(prefix="roasline-src-", dir=os.environ.get("TMPDIR", "/tmp"))
    good = ['1,2,3', '"a ""q""",b,"c,d"', ',,', '1,12" wide,3', '"",x,y', '5,6,']
    bad = ['1,2', '1,2,3,4', '"1,2,3', '1,"2,3', '1,2,"3', 'rest"']
    with open(f"{d}/a.csv", "w", encoding="utf-8-sig", newline="") as file:
        file.write("\r\n".join(["x,y,z", *good, "", *bad, "x,y,z", "7,8,9"]) + "\r\n")
    with open(f"{d}/b.csv", "w") as file:
        file.write('"z","x"\n9,8\n7\n')
    with open(f"{d}/c.csv", "w") as file:
        file.write("x,y,z\n")
    files = [f"{d}/{n}.csv" for n in "abc"]
    rows = {tuple(r) for r in S.read_exports(spark, files).select("x", "y", "z").collect()}
    assert rows == {("1", "2", "3"), ('a "q"', "b", "c,d"), (None, None, None), ("1", '12" wide', "3"), (None, "x", "y"), ("5", "6", None),
                    ("7", "8", "9"), ("8", None, "9")} and S.read_exports(spark, files).count() == 8
    apart = [(os.path.basename(r.file), r.n_fields, r.line) for r in S.quarantined(spark, files).collect()]
    assert sorted(apart) == sorted([("a.csv", 3, line) for line in bad] + [("b.csv", 2, "7")])
    counts = {os.path.basename(r.file): (r.rows, r.bad_rows) for r in S.quarantine_counts(spark, files).collect()}
    assert counts == {"a.csv": (13, 6), "b.csv": (2, 1)}
    with pytest.raises(ValueError, match="reserved"):
        open(f"{d}/d.csv", "w").write("x,_file\n")
        S.read_exports(spark, [f"{d}/d.csv"])
