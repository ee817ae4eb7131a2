"""Sinks, publisher, status records, manifests and the FAILFAST reader."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from ratewise.operators.concentration import concentration, item_frequency
from ratewise.schemas import RATINGS
from ratewise.sources import digest, manifest
from ratewise.sources.delimited import parse_lines
from ratewise.sources.eventlog import publish_events, read_event_log, write_status
from ratewise.sources.files import load_columns, write_csv, write_parquet
from ratewise.sources.manifest import file_manifest, validate_manifest

EVENTS = "timestamp double, user_id long, k int, num_recommendations int, movie_ids array<bigint>, latency_ms double"


def test_publish_to_files_and_failure_isolated(spark, scratch):
    ev = spark.createDataFrame([(1.0, 7, 2, 2, [101, 102], 3.5)], EVENTS)
    for fmt in ("text", "json"):
        assert publish_events(ev, fmt, f"{scratch}/topic-{fmt}") is True
        row = read_event_log(spark, f"{scratch}/topic-{fmt}").first()
        assert (row["user_id"], row["k"], row["movie_ids"]) == (7, 2, [101, 102])
    # a sink that is not available must not raise
    assert publish_events(ev, "no-such-sink-format", options={"topic": "x"}) is False


def test_status_and_count_sinks(spark, scratch):
    ev = spark.createDataFrame([(1.0, 1, 2, 2, [101, 102], 1.0), (2.0, 2, 1, 1, [101], 1.0)], EVENTS)
    freq = item_frequency(ev)
    freq.write.mode("overwrite").json(f"{scratch}/counts")
    rows = {r["movie_id"]: r["count"] for r in spark.read.json(f"{scratch}/counts").collect()}
    assert rows == {101: 2, 102: 1}
    write_status(concentration(freq), f"{scratch}/status")
    st = spark.read.json(f"{scratch}/status").first()
    assert st["total"] == 3 and st["top_movie_share"] == pytest.approx(2 / 3)


def test_failfast_reader(spark, scratch):
    with open(f"{scratch}/bad.jsonl", "w") as f:
        f.write('{"movie_ids": [1]}\n{oops\n')
    with pytest.raises(Exception):
        read_event_log(spark, f"{scratch}/bad.jsonl", mode="FAILFAST").collect()


def test_parse_lines_and_file_sinks(spark, scratch):
    lines = spark.createDataFrame([("1::10::5::1000",), ("2::x::3::1001",)], "value string")
    parsed = parse_lines(lines, RATINGS).collect()
    assert tuple(parsed[0]) == (1, 10, 5, 1000) and parsed[1]["movie_id"] is None
    df = parse_lines(lines, RATINGS)
    write_parquet(df, f"{scratch}/p")
    write_csv(df, f"{scratch}/c")
    assert load_columns(spark, f"{scratch}/p", ["user_id", "rating"]).columns == ["user_id", "rating"]
    assert spark.read.option("header", True).csv(f"{scratch}/c").count() == 2


def test_manifest_validation(spark, scratch):
    os.makedirs(f"{scratch}/data")
    for name, body in [("a.dat", b"alpha"), ("b.dat", b"")]:
        with open(f"{scratch}/data/{name}", "wb") as f:
            f.write(body)
    actual = file_manifest(spark, f"{scratch}/data", "*.dat")
    got = {r["file"]: (r["bytes"], r["md5"]) for r in actual.collect()}
    assert got["a.dat"] == (5, hashlib.md5(b"alpha").hexdigest())
    expected = spark.createDataFrame(
        [("a.dat", hashlib.md5(b"alpha").hexdigest()), ("b.dat", "x"), ("c.dat", "y")], "file string, md5 string")
    problems = {r["file"]: r["problem"] for r in validate_manifest(actual, expected).collect()}
    assert problems == {"b.dat": "missing_or_empty", "c.dat": "missing_or_empty"}
    wrong = spark.createDataFrame([("a.dat", "0" * 32)], "file string, md5 string")
    assert validate_manifest(actual, wrong).first()["problem"] == "md5_mismatch"


def test_manifest_reads_large_files_in_ranges(spark, scratch, monkeypatch):
    """Each task gets one file and reads one range of it; digests are those of the whole files."""
    os.makedirs(f"{scratch}/data")
    sizes = {"a": 1, "b": 127, "c": 128, "d e": 129, "f": 256, "g#%41?.gz": 1000, "h": 1025, "i": 64, "j": 0}
    for name, size in sizes.items():
        with open(f"{scratch}/data/{name}", "wb") as f:
            f.write(bytes((7 * i + size) % 251 for i in range(size)))
    advance = manifest._advance

    def checked(start, range_bytes):
        def run(batches):
            from ratewise.sources import manifest as m
            pieces, read, files = m._pieces, [], []

            def counted(path, begin, stop):
                read.append(stop - begin)
                return pieces(path, begin, stop)
            m._pieces = counted
            try:
                for batch in advance(start, range_bytes)(batches):
                    files.append(batch.num_rows)
                    yield batch
            finally:
                m._pieces = pieces
            assert sum(files) <= 1 and sum(read) <= range_bytes
        return run
    monkeypatch.setattr(manifest, "_advance", checked)
    rows = file_manifest(spark, f"{scratch}/data", range_bytes=128).collect()
    expected = set()
    for name, size in sizes.items():
        with open(f"{scratch}/data/{name}", "rb") as f:
            expected.add((name, size, hashlib.md5(f.read()).hexdigest()))
    assert len(rows) == len(sizes) - 1 and {tuple(r) for r in rows} == {e for e in expected if e[1]}
    with pytest.raises(ValueError):
        file_manifest(spark, f"{scratch}/data", range_bytes=100)


def test_manifest_of_a_file_above_two_gigabytes(spark, scratch):
    """Longer than the binary-file source can hold as one value; the file is sparse, it takes no disk."""
    size = (1 << 31) + 5
    os.makedirs(f"{scratch}/data")
    with open(f"{scratch}/data/long.dat", "wb") as f:
        f.truncate(size)
        f.seek(size - 3)
        f.write(b"end")
    with open(f"{scratch}/data/long.dat", "rb") as f:
        whole = hashlib.file_digest(f, "md5").hexdigest()
    assert [tuple(r) for r in file_manifest(spark, f"{scratch}/data", "*.dat").collect()] == [("long.dat", size, whole)]


def test_md5_state_handed_on(monkeypatch):
    text = bytes(i * i % 256 for i in range(5000))
    for cut in (0, 64, 640, 4992):
        state = digest.carry_md5([text[:cut]], None, 0, False)
        assert digest.carry_md5([text[cut:cut + 10], text[cut + 10:]], state, cut, True) == hashlib.md5(text).digest()
    with pytest.raises(ValueError):
        digest.carry_md5([b"x"], None, 0, False)
    # above 2**32 bits the count has a second word
    done, part, state = 0, bytes(1 << 26), None
    whole = hashlib.md5()
    for _ in range(9):
        state = digest.carry_md5([part], state, done, False)
        done += len(part)
        whole.update(part)
    whole.update(text)
    assert digest.carry_md5([text], state, done, True) == whole.digest()
    # without OpenSSL's functions a file is hashed by one task
    monkeypatch.setattr(manifest, "can_carry", lambda: False)
    monkeypatch.setattr(manifest, "_pieces", lambda path, start, stop: iter([text[start:stop]]))
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([{"path": "file:/x", "length": 5000, "state": None, "md5": None}])
    assert next(manifest._advance(0, 64)([batch])).to_pylist()[0]["md5"] == hashlib.md5(text).hexdigest()


def test_manifest_of_files_only_spark_opens(spark, scratch, monkeypatch):
    """A file the executors can't open through pyarrow is digested as one value, as before."""
    os.makedirs(f"{scratch}/data")
    with open(f"{scratch}/data/a.dat", "wb") as f:
        f.write(b"alpha" * 100)

    def closed(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("length"), pa.array([False] * batch.num_rows)],
                                             ["length", "opened"])
    monkeypatch.setattr(manifest, "_opened", closed)
    rows = file_manifest(spark, f"{scratch}/data", range_bytes=64).collect()
    assert [tuple(r) for r in rows] == [("a.dat", 500, hashlib.md5(b"alpha" * 100).hexdigest())]


def test_windowed_latency_stream(spark, scratch):
    from ratewise.streaming.windows import run_to_parquet, windowed_latency
    src = f"{scratch}/lat"
    df = spark.createDataFrame(
        [(f"2024-01-01 00:0{i}:00", float(v)) for i, v in enumerate([5, 1, 4, 2])] + [("2024-01-01 01:00:00", 9.0)],
        "ts string, latency_ms double").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    run_to_parquet(spark, windowed_latency(stream), f"{scratch}/lat-out", f"{scratch}/lat-ck")
    row = spark.read.parquet(f"{scratch}/lat-out").first()
    assert (row["requests"], row["p50_ms"], row["p95_ms"]) == (4, 2.0, 5.0)
