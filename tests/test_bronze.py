"""Sessions whose files have different headers."""

from pyarrow import fs

from sixfold.sources import bronze
from sixfold.sources.bronze import read_dataset


def test_each_file_by_its_own_header(spark, tmp_path):
    files = {
        "laps_2024_A_R.csv": "Time,Driver,LapTime\n1.0,VER,90.5\n2.0,HAM,\n",
        "laps_2024_B_R.csv": "Driver,Time,LapTime\nALO,3.0,91.5\n",  # another order
        "laps_2024_C_Q.csv": "Time,Driver\n4.0,NOR\n",  # one column less
        "laps_2024_D_R.csv": '﻿Time,"Driver",LapTime,Extra\n5.0,"SAI, C",92.5,x\n',  # one more, a byte order mark, quotes
        "laps_2024_E_R.csv": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = read_dataset(spark, str(tmp_path), "laps")
    rows = {(r.session_id, r.Time, r.Driver, r.LapTime, r.Extra) for r in got.collect()}
    assert rows == {
        ("2024_A_R", "1.0", "VER", "90.5", None),
        ("2024_A_R", "2.0", "HAM", None, None),
        ("2024_B_R", "3.0", "ALO", "91.5", None),
        ("2024_C_Q", "4.0", "NOR", None, None),
        ("2024_D_R", "5.0", "SAI, C", "92.5", "x"),
    }
    numbers = [r._row for r in got.collect()]
    assert len(set(numbers)) == len(numbers)


def test_only_the_beginning_of_a_file_is_read(spark, tmp_path, monkeypatch):
    name = "laps_2024 Ü+[x]_R.csv"
    long = "c" * 40_000  # a header longer than what is read at once
    (tmp_path / name).write_bytes(f"Time,{long}\r\n".encode() + b"1.0,2\r\n" * 5_000_000)
    (tmp_path / "laps_B.csv").write_text("Time,Driver")
    (tmp_path / "laps_C.csv").write_text("")
    files = bronze._files(spark, str(tmp_path), "laps", "csv", None)
    assert sorted((r.path.rpartition("/")[2], r.line) for r in bronze.first_lines(files).collect()) == [(name, f"Time,{long}"), ("laps_B.csv", "Time,Driver")]
    taken = []

    class Counting:
        def open_input_stream(self, place, buffer_size):
            stream = fs.LocalFileSystem().open_input_stream(place, buffer_size=buffer_size)
            read = stream.read

            class Stream:
                __enter__ = lambda self: self
                __exit__ = lambda *a: stream.close()

                def read(self, n):
                    out = read(n)
                    taken.append(len(out))
                    return out

            return Stream()

    monkeypatch.setattr(bronze, "file_system", lambda path: (Counting(), path))
    assert bronze.first_line(str(tmp_path / name)) == f"Time,{long}" and sum(taken) < 3 * bronze.HEAD + 1
    # Where Arrow cannot open a path, Spark's reader finds the same lines.
    monkeypatch.setattr(bronze, "file_system", lambda path: (_ for _ in ()).throw(OSError()))
    (tmp_path / name).write_text("Time,Driver\n1,2\n")
    files = bronze._files(spark, str(tmp_path), "laps", "csv", {"2024 Ü+[x]_R", "B"})
    assert sorted((r.path.rpartition("/")[2], r.line) for r in bronze.first_lines(files).collect()) == [(name, "Time,Driver"), ("laps_B.csv", "Time,Driver")]
