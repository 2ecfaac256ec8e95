"""Streams over files that arrive in several batches: evaluation questions, and sessions whose state ends."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from tidewell.streaming import jobs as ST


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def test_questions_once_and_whole(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    line = lambda q, a="yes", c=("x",), s=0: json.dumps({"ts": at(s).isoformat(), "question": q, "answer": a, "contexts": list(c)}, ensure_ascii=False)
    first = [line(" one? "), line("two?", a=" "), line("three?", c=()), line("", s=3), "not json", line("one?", s=9), json.dumps({"question": "no time?"})[:-3], ""]
    (log / "a.txt").write_text("\n".join(first) + "\n")
    (log / "b.txt").write_text("\n".join([line("one?", s=60), line("네 번째?", s=61), line("four?", c=("", "y"))]) + "\n")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(log))
    got = ST.run_append(ST.question_set(stream, "1 day"), str(tmp_path / "job")).collect()
    assert sorted(r.question for r in got) == ["four?", "one?", "네 번째?"]
    assert all(r.reference_answer == "" and r.gold_contexts == [] for r in got)


def plain_sessions(rows, gap, n):
    out = {}
    for u in {r[0] for r in rows}:
        mine = sorted((t, x) for k, t, x in rows if k == u)
        held = []
        for t, x in mine:
            if held and t - held[-1][-1][0] <= gap:
                held[-1].append((t, x))
            else:
                held.append([(t, x)])
        for s in held:
            out[u, at(s[0][0])] = (at(s[-1][0]), len(s), "\n".join(x for _, x in s[-n:]))
    return out


def run(spark, tmp_path, batches, gap, n, late, name):
    folder = tmp_path / name
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame([(k, at(t), x) for k, t, x in rows], "u int, ts timestamp_ntz, line string")
        frame.coalesce(1).write.parquet(str(folder / f"batch-{i}"))
    like = spark.read.parquet(str(folder / "batch-0"))
    stream = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))
    job = ST.sessions(stream, "u", "ts", "line", gap, n, late)
    found = ST.run_update(job, str(tmp_path / f"job-{name}"), ["u", "session_start"]).filter("n_total > 0").collect()
    return {(r.u, r.session_start): (r.session_end, r.n_total, r.history) for r in found}


def test_sessions_in_any_order_of_batches(spark, tmp_path):
    rng = random.Random(1)
    rows = [(u, rng.randrange(20_000), f"l{k}") for k in range(300) for u in (k % 3,)]
    cut = [rows[i::4] for i in range(4)]
    assert run(spark, tmp_path, cut, 300, 3, "30 days", "any") == plain_sessions(rows, 300, 3)


def test_state_of_ended_sessions_is_freed(spark, tmp_path):
    rows = [(u, t, f"{u}-{t}") for u in range(40) for t in (0, 10, 500)]
    batches = [rows, [(99, 90_000, "later")], [(99, 190_000, "latest")], [(99, 290_000, "last")]]
    folder = tmp_path / "in"
    for i, b in enumerate(batches):
        spark.createDataFrame([(k, at(t), x) for k, t, x in b], "u int, ts timestamp_ntz, line string").coalesce(1).write.parquet(str(folder / f"b{i}"))
    like = spark.read.parquet(str(folder / "b0"))
    stream = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))
    rest = []
    job = ST.sessions(stream, "u", "ts", "line", 60, 5, "1 minute")
    q = job.writeStream.outputMode("update").foreachBatch(lambda b, n: rest.append(b.count())).option("checkpointLocation", str(tmp_path / "progress"))
    q = q.trigger(availableNow=True).start()
    q.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(held) >= 40 and held[-1] <= 1 and sum(rest) >= 80
