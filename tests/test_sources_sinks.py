"""Sources, sinks, recovery."""

from __future__ import annotations

import os
import re
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows_of
from streams import finish, run_to_end, stream_of, wait_until, write_batch
from weir.operators import records
from weir.operators.running import running_sum
from weir.sinks import console, jdbc, partitioned, routed, upsert
from weir.sinks import kafka as kafka_sink
from weir.sources import kafka as kafka_source
from weir.sources import sequence, tail, text
from weir.streaming import recovery


def write_lines(directory, *batches):
    os.makedirs(directory, exist_ok=True)
    for batch in batches:
        index = len(os.listdir(directory))
        path = os.path.join(directory, f"{index:05d}.txt")
        with open(path, "w") as file:
            file.writelines(line + "\n" for line in batch)
        os.utime(path, (1_700_000_000 + index,) * 2)


def drain(writer, checkpoint):
    query = recovery.checkpointed(writer, str(checkpoint)).start()
    finish(query)
    return query


# Sources


def test_lines(spark, tmp_path):
    write_lines(tmp_path / "in", ["a b", "c"], ["d"])
    assert rows_of(text.read_lines(spark, str(tmp_path / "in"))) == [("a b",), ("c",), ("d",)]
    stream = text.stream_lines(spark, str(tmp_path / "in"), 1)
    counted = records.word_count(records.flat_map_words(stream))
    got = run_to_end(counted, tmp_path / "cp", "complete")
    assert rows_of(got, "word", "cnt") == [("a", 1), ("b", 1), ("c", 1), ("d", 1)]


def test_kafka_options():
    options = kafka_source.topic_options(["h1:9092", "h2:9092"], "wc", group="g", read_committed=True)
    assert options == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "wc",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
        "kafka.isolation.level": "read_committed",
    }
    assert kafka_sink.sink_options(["h:1"], "out")["kafka.transaction.timeout.ms"] == "60000"


def test_kafka_records(spark):
    rows = spark.createDataFrame([("ä", 1), ("b", 2)], "value STRING, id INT")
    got = kafka_sink.as_records(rows, record_id="id").collect()
    assert [(bytes(r.key), bytes(r.value)) for r in got] == [(b"1", "ä".encode()), (b"2", b"b")]
    again = kafka_sink.as_records(rows).collect()
    assert [r.key for r in again] == [r.key for r in kafka_sink.as_records(rows).collect()]


def test_sequence(spark, tmp_path):
    assert [r.n for r in sequence.sequence(spark).collect()] == list(range(100))
    sequence.register(spark)
    name = "s" + uuid.uuid4().hex
    query = (
        spark.readStream.format("weir_sequence").load()
        .writeStream.format("memory").queryName(name)
        .option("checkpointLocation", str(tmp_path)).trigger(processingTime="200 milliseconds").start()
    )
    try:
        assert wait_until(lambda: spark.table(name).count() == 100), query.exception()
        sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        assert sizes == [50, 50]
    finally:
        query.stop()


def test_ticker(spark, tmp_path):
    sequence.register(spark)
    name = "s" + uuid.uuid4().hex
    query = (
        spark.readStream.format("weir_ticker").options(interval="0.5", parallelism="3").load()
        .writeStream.format("memory").queryName(name)
        .option("checkpointLocation", str(tmp_path)).trigger(processingTime="500 milliseconds").start()
    )
    try:
        assert wait_until(lambda: spark.table(name).count() >= 9), query.exception()
    finally:
        query.stop()
    values = [r.value for r in spark.table(name).collect()]
    found = [re.fullmatch(r"([012]) --> (\d{1,2})", v) for v in values]
    assert all(found)
    assert {m.group(1) for m in found} == {"0", "1", "2"}


def test_tail_batches_are_bounded(spark, tmp_path):
    """A backlog in bounded batches, also after a restart; one file has a long line."""
    tail.register(spark)
    folder, seen = tmp_path / "logs", []
    folder.mkdir()
    lines = {"0": [f"a{i}" * 3 for i in range(200)], "1": ["b" * 900] + [f"b{i}" for i in range(50)], "22": ["c"]}
    for name, content in lines.items():
        (folder / f"{name}.txt").write_text("\n".join(content) + "\n", encoding="utf-8")
    (folder / "note.md").write_text("x\n")

    def collect(batch, batch_id):
        seen.append((batch_id, [r.value for r in batch.collect()]))

    def run(until):
        stream = spark.readStream.format("weir_tail").options(
            path=f"file://{folder}", max_bytes=300, split_bytes=64, progress=str(tmp_path / "plan.json")
        ).load()
        query = stream.writeStream.foreachBatch(collect).option("checkpointLocation", str(tmp_path / "cp")).start()
        assert wait_until(lambda: len({b for b, _ in seen}) >= until)
        query.stop()

    run(3)
    run(6)
    first = len(seen)
    with open(folder / "22.txt", "a", encoding="utf-8") as file:
        file.write("later\nunfinished")
    total = sum(map(len, lines.values())) + 1
    with pytest.raises(Exception, match="max_bytes needs"):
        lost = spark.readStream.format("weir_tail").options(path=str(folder), max_bytes=300).load()
        run_to_end(lost, tmp_path / "lost")
    stream_done = lambda: len({v for _, vs in seen for v in vs}) >= total
    stream = spark.readStream.format("weir_tail").options(
        path=str(folder), max_bytes=300, progress=str(tmp_path / "plan.json")
    ).load()
    query = stream.writeStream.foreachBatch(collect).option("checkpointLocation", str(tmp_path / "cp")).start()
    assert wait_until(stream_done)
    query.stop()
    batches = dict(seen)  # a replayed batch is the same
    assert all(batches[b] == vs for b, vs in seen) and first >= 6
    got = [v for b in sorted(batches) for v in batches[b]]
    assert sorted(got) == sorted([f"{i}:{x}" for i, xs in lines.items() for x in xs] + ["22:later"])
    sizes = [sum(len(v.split(":", 1)[1]) + 1 for v in vs) for vs in batches.values()]
    assert max(sizes) <= 2 * 300 + 901 and sorted(sizes)[-2] <= 2 * 300


def test_tail_resumes_at_its_offsets(spark, tmp_path):
    tail.register(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "0.txt").write_text("héllo\nworld\npart", encoding="utf-8")
    (folder / "1.txt").write_text("x\n")
    (folder / "notes.md").write_text("ignored\n")
    out = str(tmp_path / "out")

    def run():
        # 7-byte splits cut through lines and characters
        stream = spark.readStream.format("weir_tail").options(path=str(folder), split_bytes=7).load()
        query = (
            stream.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(processingTime="200 milliseconds").start()
        )
        return query

    def values():
        return sorted(r.value for r in spark.read.schema("value STRING").parquet(out).collect())

    first = ["0:héllo", "0:world", "1:x"]
    query = run()
    try:
        assert wait_until(lambda: os.path.isdir(out) and values() == first), query.exception()
    finally:
        query.stop()
    with open(folder / "0.txt", "a", encoding="utf-8") as file:
        file.write("ial\nlast\n")
    (folder / "2.txt").write_text("new\n")
    query = run()
    try:
        expected = sorted([*first, "0:partial", "0:last", "2:new"])
        assert wait_until(lambda: values() == expected), (values(), query.exception())
    finally:
        query.stop()


# Sinks


def test_console_labels(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "k STRING, n INT")
    assert console.labelled(rows, "late ").first()[0] == 'late > {"k":"a","n":1}'
    write_lines(tmp_path / "in", ["a"])
    stream = text.stream_lines(spark, str(tmp_path / "in"))
    drain(console.print_stream(stream, "odd "), tmp_path / "cp")


def test_instance_writer(spark, tmp_path):
    write_lines(tmp_path / "in", ["a", "b", "c"])
    out = str(tmp_path / "out")
    os.makedirs(out)

    def write(instance, epoch, row):
        with open(os.path.join(out, uuid.uuid4().hex), "w") as file:
            file.write(f"{instance}:{epoch}:{row.value}")

    stream = text.stream_lines(spark, str(tmp_path / "in"))
    drain(partitioned.foreach_instance(stream, write), tmp_path / "cp")
    got = sorted(open(os.path.join(out, f)).read().split(":")[2] for f in os.listdir(out))
    assert got == ["a", "b", "c"]


def test_routes(spark, tmp_path):
    write_lines(tmp_path / "in", ["7", "8"], ["abc"])
    stream = text.stream_lines(spark, str(tmp_path / "in"), 1)
    drain(routed.write_routes(stream, str(tmp_path / "out")), tmp_path / "cp")
    routed.RoutedFiles(str(tmp_path / "out"))(spark.createDataFrame([("abc",)], "value STRING"), 1)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(got, "output", "value") == [
        ("even", "8"), ("main", "7"), ("main", "8"), ("main", "abc"), ("odd", "7"), ("text", "abc")
    ]


def test_jdbc(spark, tmp_path):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    properties = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    for i in range(3):
        write_batch(tmp_path / "in", [{"id": i, "name": f"dog{i}"}])
    stream = stream_of(spark, tmp_path / "in", "id INT, name STRING")
    insert = jdbc.JdbcInsert(url, "dog", properties)
    drain(jdbc.write_jdbc(stream, insert, None), tmp_path / "cp")
    reader = spark.read.format("jdbc").options(url=url, dbtable="dog", **properties)
    assert rows_of(reader.load()) == [(0, "dog0"), (1, "dog1"), (2, "dog2")]


def test_jdbc_retries(spark):
    waits, attempts = [], []
    insert = jdbc.JdbcInsert("jdbc:none:", "dog", retries=5, sleep=waits.append)

    def failing(batch):
        attempts.append(1)
        if len(attempts) < 4:
            raise ConnectionRefusedError("down")

    insert._insert = failing
    insert(None, 0)
    assert len(attempts) == 4 and waits == [1.0, 2.0, 4.0]
    attempts.clear()
    insert._insert = lambda batch: attempts.append(1) or (_ for _ in ()).throw(ConnectionRefusedError("down"))
    with pytest.raises(OSError):
        insert(None, 0)
    assert len(attempts) == 6
    # what trying again cannot help fails at once
    attempts.clear()
    insert._insert = lambda batch: attempts.append(1) or (_ for _ in ()).throw(ValueError("no such column"))
    with pytest.raises(ValueError):
        insert(None, 0)
    assert len(attempts) == 1


def test_transient_failures():
    yes = ["java.sql.SQLTransientConnectionException: x", "SQLState: 08006", "Deadlock found", "Connection reset by peer"]
    no = ["java.sql.SQLSyntaxErrorException: near", "SQLState: 42P01", "duplicate key", "value too long"]
    assert all(jdbc.is_transient(Exception(m)) for m in yes) and not any(jdbc.is_transient(Exception(m)) for m in no)
    wrapped = RuntimeError("job aborted")
    wrapped.__cause__ = Exception("Communications link failure")
    assert jdbc.is_transient(wrapped)


def test_upsert_log(spark, tmp_path):
    batches = [[("a", 0, 1), ("b", 1, 1), ("a", 2, 2)], [("a", 3, 3), ("c", 4, 1)]]
    for batch in batches:
        write_batch(tmp_path / "in", [{"word": w, "seq": s, "cnt": c} for w, s, c in batch])
    stream = stream_of(spark, tmp_path / "in", "word STRING, seq BIGINT, cnt BIGINT")
    log = upsert.UpsertLog(str(tmp_path / "log"), ["word"], "seq")
    drain(stream.writeStream.foreachBatch(log), tmp_path / "cp")
    expected = [("a", 3, 3), ("b", 1, 1), ("c", 4, 1)]
    assert rows_of(log.read(spark), "word", "seq", "cnt") == expected
    replay = spark.createDataFrame(batches[1], "word STRING, seq BIGINT, cnt BIGINT")
    log(replay, 1)
    assert rows_of(log.read(spark), "word", "seq", "cnt") == expected
    small = log.compact(spark, str(tmp_path / "compacted"))
    assert rows_of(small.read(spark), "word", "seq", "cnt") == expected


@pytest.mark.parametrize("fanout", [2, 3])
def test_upsert_table_levels(spark, tmp_path, fanout):
    """Thirty batches, replays and a merge that was cut off; few runs are read."""
    table = upsert.UpsertTable(str(tmp_path / "t"), ["k", "j"], "seq", buckets=5, fanout=fanout)
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    latest, schema = {}, "k STRING, j INT, seq BIGINT, v DOUBLE"
    for n in range(14):
        rows = [(None if i % 4 == 0 else f"k{(n * i) % 11}", i % 3 or None, n * 10 + i, None if i == 5 else n + i / 4) for i in range(8)]
        latest.update({r[:2]: r for r in rows})
        batch = spark.createDataFrame(rows, schema)
        table(batch, n)
        if n in (3, 9):
            table(batch, n)  # replayed, after it may have been merged
        if n == 6:
            (tmp_path / "t" / "run=0-99").mkdir()  # a merge that did not end
    expected = sorted(latest.values(), key=repr)
    assert rows_of(table.read(spark), "k", "j", "seq", "v") == expected
    runs = table.runs(spark)
    assert runs[0][0] == 0 and runs[-1][1] == 13 and all(a[1] + 1 == b[0] for a, b in zip(runs, runs[1:]))
    assert len(runs) <= fanout * 3
    wanted = spark.createDataFrame([(None, 1), ("k3", 2), ("none", 9)], "k STRING, j INT")
    found = table.lookup(wanted)
    assert rows_of(found, "k", "j", "seq", "v") == [r for r in expected if r[:2] in {(None, 1), ("k3", 2)}]
    one = table.lookup(wanted.where("j = 9"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan or one.count() == 0
    assert table.vacuum(spark) > 0 and rows_of(table.read(spark), "k", "j", "seq", "v") == expected


def test_upsert_table_reads_do_not_grow_with_batches():
    """Runs after n batches, by the merging rule alone."""
    table = upsert.UpsertTable("unused", ["k"], "seq", fanout=4)
    runs, most, rewritten = [], 0, 0
    for n in range(1000):
        runs.append((n, n))
        while chosen := table._full(runs):
            at = runs.index(chosen[0])
            runs[at : at + len(chosen)] = [(chosen[0][0], chosen[-1][1])]
            rewritten += chosen[-1][1] - chosen[0][0] + 1
        most = max(most, len(runs))
    assert most <= 4 * 5 and rewritten <= 1000 * 5


def test_key_value_upsert(spark, tmp_path):
    out = str(tmp_path / "store")
    os.makedirs(out)

    def put(rows):
        for row in rows:
            with open(os.path.join(out, row.word), "w") as file:
                file.write(str(row.cnt))

    sink = upsert.KeyValueUpsert(["word"], "seq", put)
    batch = spark.createDataFrame([("a", 0, 1), ("a", 1, 2), ("b", 2, 1)], "word STRING, seq INT, cnt INT")
    sink(batch, 0)
    sink(batch, 0)
    assert {f: open(os.path.join(out, f)).read() for f in os.listdir(out)} == {"a": "2", "b": "1"}


# Recovery


def test_resumes_after_failure_exactly_once(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), tmp_path / "cp"
    write_lines(source, ["one", "two"], ["error 1", "three"], ["four"])

    def start():
        stream = text.stream_lines(spark, str(source), 1)
        merged = records.validate_fail_fast(stream)
        writer = merged.writeStream.format("parquet").option("path", out)
        return recovery.checkpointed(writer, str(checkpoint)).start()

    with pytest.raises(StreamingQueryException):
        finish(start())
    bad = source / "00001.txt"
    stamp = os.stat(bad).st_mtime
    bad.write_text("fixed\nthree\n")
    os.utime(bad, (stamp, stamp))
    finish(start())
    got = spark.read.parquet(out)
    assert rows_of(got) == [("fixed",), ("four",), ("one",), ("three",), ("two",)]


def test_restart_policy_runs_query_to_its_end(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), tmp_path / "cp"
    write_lines(source, ["one"], ["error 1"], ["two"])
    bad = source / "00001.txt"

    def start():
        stream = text.stream_lines(spark, str(source), 1)
        writer = records.validate_fail_fast(stream).writeStream.format("parquet").option("path", out)
        return recovery.checkpointed(writer, str(checkpoint)).start()

    def repair(delay):
        assert delay == 2.0
        stamp = os.stat(bad).st_mtime
        bad.write_text("fixed\n")
        os.utime(bad, (stamp, stamp))

    assert recovery.run_with_restarts(start, recovery.FixedDelay(3, 2.0), sleep=repair) == 1
    assert rows_of(spark.read.parquet(out)) == [("fixed",), ("one",), ("two",)]


def test_policies():
    fixed = recovery.FixedDelay(3, 10.0)
    assert [fixed.next_delay(0) for _ in range(4)] == [10.0, 10.0, 10.0, None]
    rate = recovery.FailureRate(3, 30.0, 2.0)
    assert [rate.next_delay(t) for t in (0, 20, 40)] == [2.0, 2.0, 2.0]
    assert rate.next_delay(45) is None


def test_stateful_totals_survive_restart(spark, tmp_path):
    """Totals after a stop and a restart equal those of one run."""
    rows = [{"k": "ab"[i % 2], "seq": i, "v": i} for i in range(10)]
    schema = "k STRING, seq BIGINT, v BIGINT"
    out = str(tmp_path / "log")

    def run():
        stream = stream_of(spark, tmp_path / "in", schema)
        totals = stream.groupBy("k").agg(F.sum("v").alias("total"), F.max("seq").alias("seq"))
        log = upsert.UpsertLog(out, ["k"], "seq")
        drain(totals.writeStream.outputMode("update").foreachBatch(log), tmp_path / "cp")
        return log

    write_batch(tmp_path / "in", rows[:4])
    run()
    write_batch(tmp_path / "in", rows[4:])
    log = run()
    batch = running_sum(spark.createDataFrame(rows, schema), ["k"], "seq", "v")
    expected = batch.where("seq >= 8").select("k", "total")
    assert rows_of(log.read(spark), "k", "total") == rows_of(expected)


def test_union_chain_fails_and_resumes(spark, tmp_path):
    """A topic merged with a fault-injecting stream, filtered, written exactly once."""
    topic, faults, out = tmp_path / "topic", tmp_path / "faults", str(tmp_path / "out")
    write_lines(topic, ["spark hadoop"], ["error from the topic", "hive"], ["hive"])
    write_lines(faults, ["fine"], ["error injected"])

    def start():
        checked = records.validate_fail_fast(text.stream_lines(spark, str(faults), 1))
        merged = records.union_all(checked, text.stream_lines(spark, str(topic), 1))
        kept = kafka_sink.as_records(merged.where(records.not_prefixed("value", "error")))
        writer = kept.writeStream.format("parquet").option("path", out)
        return recovery.checkpointed(writer, str(tmp_path / "cp")).start()

    with pytest.raises(StreamingQueryException):
        finish(start())
    bad = faults / "00001.txt"
    stamp = os.stat(bad).st_mtime
    bad.write_text("mended\n")
    os.utime(bad, (stamp, stamp))
    finish(start())
    got = spark.read.parquet(out).select(F.decode("value", "UTF-8").alias("v"))
    assert rows_of(got) == [("fine",), ("hive",), ("hive",), ("mended",), ("spark hadoop",)]


def test_record_operators_on_a_stream(spark, tmp_path):
    write_lines(tmp_path / "in", ["spark,3", "hive,4"], ["spark,5"])
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("n", T.IntegerType())])
    stream = text.stream_lines(spark, str(tmp_path / "in"), 1)
    parsed = records.parse_delimited(stream, schema)
    shouted = records.map_upper(parsed, "key").where(records.positive("n"))
    both = records.co_map(
        shouted, parsed, {"key": F.col("key"), "n": F.col("n")}, {"key": F.col("key"), "n": -F.col("n")}
    )
    assert rows_of(run_to_end(both, tmp_path / "cp")) == sorted(
        [("SPARK", 3), ("HIVE", 4), ("SPARK", 5), ("spark", -3), ("hive", -4), ("spark", -5)], key=repr
    )
