import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from ratewise.sources import commits, topic as topics
from ratewise.sources.eventlog import append_events, parse_event_lines, read_event_log
from ratewise.streaming.drain import _append_new, drain, drain_topic, reached_offsets


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("".join(line + "\n" for line in lines))


def event(user, items=(7,)):
    return json.dumps({"timestamp": 1.0, "user_id": user, "k": 1, "num_recommendations": len(items),
                       "movie_ids": list(items), "latency_ms": 2.0})


def users(spark, log):
    return sorted(r.user_id for r in read_event_log(spark, log).collect())


def test_two_checkpoints_share_a_log(spark, scratch):
    log = f"{scratch}/log"
    put(f"{scratch}/a", "1.txt", [event(1), event(2)])
    put(f"{scratch}/b", "1.txt", [event(3), "no json"])
    assert drain(spark, log, "text", f"{scratch}/a", checkpoint=f"{scratch}/c1").appended == 2
    got = drain(spark, log, "text", f"{scratch}/b", checkpoint=f"{scratch}/c2")
    assert (got.appended, got.quarantined) == (1, 1)
    put(f"{scratch}/a", "2.txt", [event(4)])
    assert drain(spark, log, "text", f"{scratch}/a", checkpoint=f"{scratch}/c1").appended == 1
    assert users(spark, log) == [1, 2, 3, 4]
    assert commits.read_lines(spark, f"{log}.bad").collect()[0].value == "no json"


def test_lost_progress_folder_loses_no_line(spark, scratch):
    log, src = f"{scratch}/log", f"{scratch}/a"
    put(src, "1.txt", [event(1), event(2)])
    drain(spark, log, "text", src)
    shutil.rmtree(f"{log}.progress")
    os.remove(f"{src}/1.txt")                            # the source has moved on
    put(src, "2.txt", [event(5)])
    drain(spark, log, "text", src)
    assert users(spark, log) == [1, 2, 5]


def test_repeated_and_dead_writes(spark, scratch):
    log = f"{scratch}/log"
    frame = spark.createDataFrame([(event(1),)], "value string")

    def write(folder):
        frame.write.text(folder)
        return 1

    first = commits.write_once(spark, log, "w", 0, write)
    again = commits.write_once(spark, log, "w", 0, lambda folder: pytest.fail("written twice"))
    assert first == again
    frame.write.text(f"{log}/data/w-1-dead")            # an attempt that died before its commit
    assert users(spark, log) == [1]
    assert append_events(read_event_log(spark, log), log) == 1   # plain appended files stand beside
    assert users(spark, log) == [1, 1]
    assert not commits.create_once(spark, commits.commit_path(log, "w", 0), "{}")
    with pytest.raises(ValueError):
        commits.write_once(spark, log, "no/slash", 0, write)
    assert commits.read_lines(spark, f"{scratch}/nothing").count() == 0


def records(spark, lo, hi):
    return spark.range(lo, hi).select("id", F.concat(F.lit("u"), F.col("id") % 5).alias("who"),
                                      F.format_string('{"user_id":%d,"k":1,"movie_ids":[%d]}', "id", "id").alias("line"))


def test_topic_offsets_are_dense_and_replay(spark, scratch):
    path = f"{scratch}/topic"
    assert topics.end_offsets(spark, path) == {}
    first = topics.publish(records(spark, 0, 40), path, 3, "who", "line", "id")
    second = topics.publish(records(spark, 40, 60), path, 3, "who", "line", "id")
    assert topics.publish(records(spark, 0, 0), path, 3, "who", "line", "id") == second
    rows = topics.read_topic(spark, path).collect()
    assert len(rows) == 60 and {r.key for r in rows} == {f"u{k}" for k in range(5)}
    for p, end in second.items():
        mine = sorted((r.offset, json.loads(r.value)["user_id"]) for r in rows if r.partition == p)
        assert [o for o, _ in mine] == list(range(end))
        assert [u for _, u in mine] == sorted(u for _, u in mine)       # appends follow one another
    late = topics.read_topic(spark, path, first).collect()
    assert sorted(r.value for r in late) == sorted(r.value for r in rows if r.offset >= first.get(r.partition, 0))


def test_topic_drains_once_in_limited_batches(spark, scratch):
    path, log = f"{scratch}/topic", f"{scratch}/log"
    topics.publish(records(spark, 0, 50), path, 4, "who", "line", "id")
    assert drain_topic(spark, log, path, limit=4).appended == 50
    assert len(commits.committed(spark, log)) >= 4       # several batches
    assert drain_topic(spark, log, path).appended == 0
    shutil.rmtree(f"{log}.progress")
    topics.publish(records(spark, 50, 70).union(spark.createDataFrame([(99, "u1", "no json")], "id long, who string, line string")),
                   path, 4, "who", "line", "id")
    got = drain_topic(spark, log, path, limit=100)
    assert (got.appended, got.quarantined) == (20, 1)
    assert users(spark, log) == list(range(70))
    assert reached_offsets(spark, log, path) == topics.end_offsets(spark, path)
    # a second drain that has read the same records commits none of them
    assert _append_new(spark, log, path, topics.read_topic(spark, path)) == (0, 0)
    assert parse_event_lines(commits.read_lines(spark, log)).count() == 70


def test_topic_from_stored_offsets(spark, scratch):
    path, log = f"{scratch}/topic", f"{scratch}/log"
    first = topics.publish(records(spark, 0, 30), path, 2, "who", "line", "id")
    topics.publish(records(spark, 30, 45), path, 2, "who", "line", "id")
    assert drain_topic(spark, log, path, starting=first).appended == 15
    assert users(spark, log) == list(range(30, 45))
