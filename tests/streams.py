"""Small file streams for tests: one file per micro-batch."""

from __future__ import annotations

import json
import os
import time
import uuid


def write_batch(directory, records):
    """Add one file of JSON records; files are read in order of their time."""
    os.makedirs(directory, exist_ok=True)
    index = len(os.listdir(directory))
    path = os.path.join(directory, f"{index:05d}.json")
    with open(path, "w") as file:
        file.writelines(json.dumps(r) + "\n" for r in records)
    stamp = 1_700_000_000 + index
    os.utime(path, (stamp, stamp))
    return path


def stream_of(spark, directory, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(directory))


def run_to_end(frame, checkpoint, mode="append"):
    """Drive a stream over everything available; returns its rows."""
    name = "t" + uuid.uuid4().hex
    query = (
        frame.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    )
    finish(query)
    return frame.sparkSession.table(name)


def finish(query, seconds=120):
    if not query.awaitTermination(seconds):
        query.stop()
        raise AssertionError("stream did not end in time")
    if query.exception() is not None:
        raise query.exception()


def wait_until(condition, seconds=90):
    deadline = time.time() + seconds
    while time.time() < deadline:
        if condition():
            return True
        time.sleep(0.5)
    return False
