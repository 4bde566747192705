"""CSV alias mapping and the third-party converter (FIXTURES 3, CSV aliases)."""

from tsquality.sources.csv import convert_to_standard, parse_csv_rows, read_csv


def test_alias_rows(spark):
    rows = [("1", "", "A", "", "2024-01-01 10:00:00", "", "", "", "1"),
            ("2", "", "", "B", "", "", "2024-01-01T10:00:00+01:00", "", "0"),
            ("3", "", "", "B", "", "", "", "1", ""),
            ("4", "", "", "B", "", "", "01/02/2024", "1", "")]
    cols = "n string, meter_id string, meterId string, id string, time string, timestamp string, datetime string, " \
           "consumption string, kwh string"
    got = {r["n"]: r for r in parse_csv_rows(spark.createDataFrame(rows, cols), keep=("n",)).collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"]["meter_id"], str(got["1"]["timestamp"]), got["1"]["consumption_kwh"]) == \
        ("A", "2024-01-01 10:00:00", 1.0)
    assert (got["2"]["meter_id"], str(got["2"]["timestamp"]), got["2"]["consumption_kwh"]) == \
        ("B", "2024-01-01 09:00:00", 0.0)


def test_converter(spark):
    rows = [("1", "", "2024-01-01 10:00:00", "3"), ("2", "X", "2024-01-01T10:00:00", "x"),
            ("3", "Y", "2024-01-01 10:00:00Z", "2.5")]
    df = spark.createDataFrame(rows, "n string, id string, time string, value string")
    got = {r["n"]: r for r in convert_to_standard(df, keep=("n",)).collect()}
    assert set(got) == {"1", "3"}
    assert (got["1"]["meter_id"], got["1"]["timestamp"], got["1"]["consumption_kwh"]) == \
        ("UNKNOWN", "2024-01-01T10:00:00", 3.0)
    assert got["3"]["timestamp"] == "2024-01-01T10:00:00Z"


def test_csv_file_round_trip(spark, tmp):
    import os
    p = os.path.join(tmp, "in.csv")
    with open(p, "w") as f:
        f.write("meter_id,timestamp,consumption_kwh\nMETER_0001,2024-01-01T00:00:00,1.25\n")
    df = parse_csv_rows(read_csv(spark, p))
    assert [(r.meter_id, r.consumption_kwh) for r in df.collect()] == [("METER_0001", 1.25)]


def test_files_with_different_headers(spark, tmp):
    """Columns go by name, not by the first file's order; doubled quotes, line breaks and dropped rows."""
    import os

    from pyspark.sql import Observation
    files = {"a.csv": "meter_id,timestamp,kwh\nM1,2024-01-01T00:00:00,1.25\nM1,never,1\nM1,2024-01-01T01:00:00,x\n",
             "b.csv": "kwh,time,id\n9.0,2024-01-01 02:00:00,M8\n",
             "c.csv": 'id,time,consumption\n"M ""9""\n10",2024-01-01 03:00:00,2\n,2024-01-01 03:00:00,2\n',
             "d.csv": ""}
    for name, text in files.items():
        with open(os.path.join(tmp, name), "w") as f:
            f.write(text)
    seen = Observation("rows")
    got = parse_csv_rows(read_csv(spark, tmp), observation=seen).collect()
    assert sorted((r.meter_id, r.timestamp.hour, r.consumption_kwh) for r in got) == \
        [('M "9"\n10', 3, 2.0), ("M1", 0, 1.25), ("M8", 2, 9.0)]
    assert seen.get == {"rows": 6, "dropped": 3}


def test_missing_path_fails(spark, tmp):
    import pytest
    with pytest.raises(Exception):
        read_csv(spark, tmp + "/none").count()


def test_stream_of_mixed_headers(spark, tmp):
    """Files of three headers, one with line breaks and a byte order mark, in one stream; a file too wide fails it."""
    import os

    import pytest

    from tsquality.sources.csv import stream_csv
    files = {"a.csv": "meter_id,timestamp,kwh\n007,2024-01-01T00:00:00,1.25\nM1,never,1\n",
             "b.csv": "﻿kwh,time,other,id\n9.0,2024-01-01 02:00:00,x,M8\n9.5,2024-01-01 02:30:00,x,M8\n",
             "c.csv": 'id,time,consumption\n"M ""9""\n10",2024-01-01 03:00:00,2\n', "d.csv": "", "e.csv": "id,time\n"}
    os.makedirs(f"{tmp}/in")
    for name, text in files.items():
        with open(f"{tmp}/in/{name}", "w") as f:
            f.write(text)
    for k, per in enumerate((None, 1)):
        rows = parse_csv_rows(stream_csv(spark, f"{tmp}/in", files_per_trigger=per))
        rows.writeStream.option("checkpointLocation", f"{tmp}/c{k}").trigger(availableNow=True) \
            .start(f"{tmp}/out{k}", format="parquet").awaitTermination()
        got = spark.read.parquet(f"{tmp}/out{k}").collect()
        assert sorted((r.meter_id, r.timestamp.hour, r.consumption_kwh) for r in got) == \
            [("007", 0, 1.25), ('M "9"\n10', 3, 2.0), ("M8", 2, 9.0), ("M8", 2, 9.5)]
    with pytest.raises(Exception, match="more than 2 columns"):
        stream_csv(spark, f"{tmp}/in", most_columns=2).writeStream.option("checkpointLocation", f"{tmp}/cx") \
            .trigger(availableNow=True).start(f"{tmp}/outx", format="parquet").awaitTermination()


def test_headers_by_tasks(spark, tmp):
    """Many files, split ones too, blank first lines, repeated names and names that differ in case alone."""
    import os

    from tsquality.session import settings
    from tsquality.sources.csv import file_headers
    for k in range(60):
        with open(os.path.join(tmp, f"{k:03d}.csv"), "w") as f:
            header = ("\n\nid,time,kwh,id", "kwh,ID,time")[k % 2]
            f.write(header + "\n" + "".join(f"{k},2024-01-01 00:{m:02d}:00,{m},z\n" if k % 2 == 0 else f"{m},{k},2024-01-01 00:{m:02d}:00\n"
                                            for m in range(60)))
    assert file_headers(spark, tmp).count() == 60
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "500b", "spark.sql.files.openCostInBytes": "0"}):
        df = read_csv(spark, tmp, multi_line=False)
        assert sorted(df.columns) == ["ID_", "id", "kwh", "time"]
        got = df.collect()
    assert len(got) == 3600
    assert {(r.id, r.ID_, r.time[-5:-3], r.kwh) for r in got} == {
        (str(k) if k % 2 == 0 else None, str(k) if k % 2 else None, f"{m:02d}", str(m)) for k in range(60) for m in range(60)}
