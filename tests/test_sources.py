from __future__ import annotations

import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from motorpulse.schemas import ENVELOPE
from motorpulse.session import (
    kafka_package,
    object_store_settings,
    session,
    shared_folder,
    state_store_settings,
)
from motorpulse.sources import (
    FileTopic,
    KafkaTopic,
    available_topics,
    merge_topics,
    split_topics,
)
from motorpulse.sources import messages
from motorpulse.streaming import start_appending


def test_split_topics():
    assert split_topics(" a, b ,,c ") == ["a", "b", "c"]
    with pytest.raises(ValueError):
        split_topics(" , ")


def test_kafka_source_options():
    topic = KafkaTopic("h:1", "a, b", options={"maxOffsetsPerTrigger": "10"})
    assert topic.source_options() == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10",
    }
    later = KafkaTopic("h:1", "al.*", pattern=True, starting="earliest").source_options()
    assert later["subscribePattern"] == "al.*" and later["startingOffsets"] == "earliest"
    assert "subscribe" not in later


def test_kafka_sink_takes_one_topic():
    assert KafkaTopic("h:1", "a").sink_options() == {"kafka.bootstrap.servers": "h:1", "topic": "a"}
    for topic in (KafkaTopic("h:1", "a,b"), KafkaTopic("h:1", "a", pattern=True)):
        with pytest.raises(ValueError):
            topic.sink_options()


def _topic(spark, folder, name, *values):
    topic = FileTopic(f"{folder}/{name}", name)
    if values:
        topic.append(spark.createDataFrame([(v,) for v in values], "value string"))
    return topic


def test_available_topics(spark, folder):
    here, gone = _topic(spark, folder, "here", "x"), _topic(spark, folder, "gone")
    assert available_topics(spark, [here]) == [here]
    with pytest.warns(UserWarning, match="gone"):
        assert available_topics(spark, [gone, here]) == [here]
    with pytest.raises(RuntimeError, match="gone"):
        available_topics(spark, [gone])


def test_merged_topics_keep_copies_and_names(spark, folder):
    topics = [_topic(spark, folder, "a", "x", "x"), _topic(spark, folder, "b", "x")]
    merged = merge_topics([t.batch(spark) for t in topics])
    assert merged.columns == ["topic", "timestamp", "value"]
    assert sorted((r.topic, bytes(r.value)) for r in merged.collect()) == [
        ("a", b"x"), ("a", b"x"), ("b", b"x"),
    ]


def test_merged_topics_stream(spark, folder):
    topics = [_topic(spark, folder, "a", "x"), _topic(spark, folder, "b", "y")]
    query = (
        merge_topics([t.stream(spark) for t in topics])
        .writeStream.format("memory").queryName("merged").trigger(availableNow=True)
        .option("checkpointLocation", f"{folder}/c").start()
    )
    query.awaitTermination()
    found = spark.table("merged").collect()
    assert sorted((r.topic, bytes(r.value)) for r in found) == [("a", b"x"), ("b", b"y")]


def test_topic_of_json_files(spark, folder):
    topic = FileTopic(f"{folder}/json", "json", format="json")
    topic.append(spark.createDataFrame([('{"a":1}',)], "value string"))
    batch = topic.batch(spark)
    assert [(f.name, f.dataType) for f in batch.schema] == [(f.name, f.dataType) for f in ENVELOPE]
    (row,) = batch.collect()
    assert bytes(row.value) == b'{"a":1}' and row.timestamp is not None


def test_kafka_package_names_this_spark():
    assert kafka_package("4.1.2") == "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"


def test_object_store_settings():
    plain = object_store_settings("http://store:9000", "key", "secret")
    assert plain["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert plain["spark.hadoop.fs.s3a.access.key"] == "key"
    own = object_store_settings("https://store")
    assert own["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert not any("key" in k for k in own)


def test_session_settings(spark):
    ours = session("again", settings=state_store_settings())
    try:
        assert ours.conf.get("spark.sql.session.timeZone") == "UTC"
        assert "RocksDB" in ours.conf.get("spark.sql.streaming.stateStore.providerClass")
    finally:
        for key in state_store_settings():
            spark.conf.unset(key)
    with pytest.raises(RuntimeError, match="packages"):
        session("again", packages=[kafka_package()])


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


# The commit log of file topics ---------------------------------------------------------


def _values(df):
    return sorted(bytes(r.value).decode() for r in df.collect())


def _drained(spark, topic, folder):
    """All that a stream with a checkpoint has seen of a topic, run after run."""
    seen = FileTopic(f"{folder}/seen", "seen")
    start_appending(topic.stream(spark), seen, f"{folder}/c", trigger={"availableNow": True}).awaitTermination()
    return _values(seen.batch(spark)) if seen.exists(spark) else []


def test_a_batch_that_died_while_writing_is_not_seen(spark, folder):
    topic = _topic(spark, folder, "t", "a")
    broken = spark.range(8, numPartitions=4).select(
        F.when(F.col("id") < 7, F.col("id").cast("string")).otherwise(F.raise_error(F.lit("lost"))).alias("value")
    )
    with pytest.raises(Exception, match="lost"):
        topic.append(broken, 0, "w")
    assert _values(topic.batch(spark)) == ["a"] and _drained(spark, topic, folder) == ["a"]
    topic.append(spark.createDataFrame([("b",), ("c",)], "value string"), 0, "w")
    assert _drained(spark, topic, folder) == ["a", "b", "c"]


@pytest.mark.parametrize("dies_in", ["_commit", "move_into"])
def test_a_batch_that_died_in_its_commit_is_seen_once(spark, folder, monkeypatch, dies_in):
    topic = FileTopic(f"{folder}/t", "t")
    rows = spark.createDataFrame([(str(k),) for k in range(20)], "value string").repartition(4)

    def die(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(FileTopic if dies_in == "_commit" else messages, dies_in, die)
        with pytest.raises(RuntimeError, match="lost"):
            topic.append(rows, 3, "w")
    assert _drained(spark, topic, folder) == []
    assert topic.committed(spark, "writer=w/batch_id=3") is (dies_in == "move_into")
    for _ in range(2):
        topic.append(rows, 3, "w")  # the replay, and one too many
        assert _drained(spark, topic, folder) == sorted(map(str, range(20)))


def test_a_move_that_was_cut_off_is_finished(spark, folder, monkeypatch):
    """A store that moves file by file leaves both folders behind when it dies."""
    topic = FileTopic(f"{folder}/t", "t")
    rows = spark.createDataFrame([(str(k),) for k in range(20)], "value string").repartition(4)
    with monkeypatch.context() as patch:
        patch.setattr(messages, "move_into", lambda *_: None)
        topic.append(rows, 0, "w")
    staged, shown = Path(folder, "t/_staged/writer=w/batch_id=0"), Path(folder, "t/writer=w/batch_id=0")
    shown.mkdir(parents=True)
    first, second = sorted(staged.glob("*.parquet"))[:2]
    first.rename(shown / first.name)
    shutil.copy(second, shown / second.name)  # copied and not yet deleted
    assert len(_drained(spark, topic, folder)) < 20
    topic.append(rows, 0, "w")
    assert _drained(spark, topic, folder) == sorted(map(str, range(20))) and not staged.exists()


def test_batches_from_before_the_log_are_not_added_again(spark, folder):
    topic = FileTopic(f"{folder}/t", "t")
    rows = spark.createDataFrame([("a", None)], "value string, timestamp timestamp")
    rows.write.parquet(f"{folder}/t/writer=w/batch_id=0")
    topic.append(rows, 0, "w")
    assert _values(topic.batch(spark)) == ["a"]


def test_two_writers_may_number_their_batches_alike(spark, folder):
    topic = FileTopic(f"{folder}/t", "t")
    for writer in "vw":
        topic.append(spark.createDataFrame([(writer,)], "value string"), 0, writer)
    assert _values(topic.batch(spark)) == ["v", "w"]
    log = json.loads(Path(folder, "t/_commits/writer=v/batch_id=0").read_text())
    assert log["files"] == sorted(p.name for p in Path(folder, "t/writer=v/batch_id=0").glob("*.parquet"))
