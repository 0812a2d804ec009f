"""State kept up batch by batch equals the state of all rows, and leaves other buckets alone."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from tidemark.streaming.state import bucket_of, keep_state, read_state

SCHEMA = "pk STRING, op STRING, v INT, commit_ord LONG, ord LONG, ordinal INT"


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def land(spark, folder, rows, buckets=8):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/landed")
    run(spark, folder, buckets)


def run(spark, folder, buckets=8):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/landed")
    keep_state(stream, f"{folder}/out", f"{folder}/checkpoint", ["pk"], buckets).awaitTermination()


def state_of(spark, folder, deleted=False):
    return {r["pk"]: (r["op"], r["v"]) for r in read_state(spark, f"{folder}/out", deleted).collect()}


def test_state_after_every_batch(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"k{rng.randrange(30)}" if n % 9 else None, rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), n, n // 3, n, 0) for n in range(200)]
    rng.shuffle(rows)  # changes come late, also after the delete of their key
    last = {}
    for i in range(4):
        part = rows[i * 50 : (i + 1) * 50]
        land(spark, tmp_path, part + part[:5])
        for row in part:
            if row[0] not in last or row[4] > last[row[0]][4]:
                last[row[0]] = row
        assert state_of(spark, tmp_path, deleted=True) == {k: (r[1], r[2]) for k, r in last.items()}
        assert state_of(spark, tmp_path) == {k: (r[1], r[2]) for k, r in last.items() if r[1] != "DELETE"}


def test_only_touched_buckets_are_written_and_a_retry_changes_nothing(spark, tmp_path):
    land(spark, tmp_path, [(f"k{n}", "INSERT", n, n, n, 0) for n in range(100)])
    before = files(tmp_path / "out" / "rows")
    land(spark, tmp_path, [("k7", "UPDATE", 700, 200, 200, 0)])
    after = files(tmp_path / "out" / "rows")
    bucket = spark.sql("select 'k7' as pk").select(bucket_of(["pk"], 8)).first()[0]
    assert {name: after[name] for name in before} == before
    assert {name.rsplit("/", 1)[0] for name in set(after) - set(before)} == {f"batch=1/bucket={bucket}"}
    expected = {f"k{n}": ("INSERT", n) for n in range(100)} | {"k7": ("UPDATE", 700)}
    assert state_of(spark, tmp_path) == expected
    # The second batch as after a loss of its commit.
    (tmp_path / "checkpoint" / "commits" / "1").unlink()
    (tmp_path / "checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    run(spark, tmp_path)
    assert state_of(spark, tmp_path) == expected


def test_a_batch_without_rows(spark, tmp_path):
    spark.createDataFrame([("k", "INSERT", 1, 1, 1, 0)], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/landed")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/landed").where(F.col("v") > 5)
    keep_state(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", ["pk"]).awaitTermination()
    assert state_of(spark, tmp_path) == {}
    land(spark, tmp_path, [("k", "UPDATE", 9, 2, 2, 0)], buckets=256)
    assert state_of(spark, tmp_path) == {"k": ("UPDATE", 9)}
