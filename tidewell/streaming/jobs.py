"""Structured Streaming forms of the monitoring and append jobs.

Each job reads files as a stream and keeps its progress and output in the shared folder.
Aggregates run in update mode: every micro-batch appends the groups it changed with its batch
number, and ``current`` reads the newest row of each group, so late rows still count.
"""

from __future__ import annotations

import heapq
import itertools
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.maintenance import append_unseen, content_hash
from ..session import new_folder


def stream_files(spark: SparkSession, folder: str, like: DataFrame, glob: str = "*.parquet", per_batch: int | None = None) -> DataFrame:
    """The files of ``folder`` whose names match ``glob``; a name without a wildcard is one file, or a folder of files.

    A stream takes a single file only by a pattern, so such a name becomes one that fits it alone.
    """
    reader = spark.readStream.schema(like.schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    if any(mark in glob for mark in "*?[{"):
        return reader.option("pathGlobFilter", glob).parquet(folder)
    return reader.parquet(f"{folder}/{glob[:-1]}[{glob[-1]}]")


def job_folder(spark: SparkSession, name: str) -> str:
    return new_folder(spark, f"stream-{name}")


def run_append(stream: DataFrame, folder: str) -> DataFrame:
    """Process what is there now into an append-only table and read it back."""
    spark = stream.sparkSession
    q = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def run_update(stream: DataFrame, folder: str, keys: Sequence[str]) -> DataFrame:
    """Process what is there now, keeping changed groups per micro-batch, and read the current ones."""
    spark = stream.sparkSession
    rest = [c for c in stream.columns if c not in keys]

    def store(batch: DataFrame, number: int) -> None:
        # Overwriting the batch's own folder makes a repeated batch harmless.
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    q = (
        stream.writeStream.outputMode("update").foreachBatch(store)
        .option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    rows = spark.read.option("basePath", f"{folder}/rows").parquet(f"{folder}/rows")
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__r"))
    return newest.select(*keys, "__r.*")


def _timed(stream: DataFrame, ts: str, late: str) -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def hourly_rate(stream: DataFrame, ts: str, by: str, flag: Column, late: str = "1 hour") -> DataFrame:
    """Flagged rows, rows and percent per hour and group."""
    hours = _timed(stream, ts, late).groupBy(F.window(ts, "1 hour").alias("w"), by)
    out = hours.agg(F.sum(flag.cast("bigint")).alias("flagged"), F.count(F.lit(1)).alias("total"))
    return out.select(
        by, F.col("w.start").cast("timestamp_ntz").alias("bin"), "flagged", "total", (F.col("flagged") * 100.0 / F.col("total")).alias("rate")
    )


def alerts(stream: DataFrame, limits: DataFrame, group: str, params: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Readings outside the limits of their (group, param), row by row."""
    cells = F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).alias("reading")) for p in params])
    long = stream.select(group, *ids, F.inline(cells))
    joined = long.join(limits, [group, "param"])
    outside = (F.col("reading") < F.col("lower")) | (F.col("reading") > F.col("upper"))
    return joined.filter(outside).select(*ids, group, "param", "reading")


def distinct_per_day(stream: DataFrame, keys: Sequence[str], ts: str, late: str = "1 day") -> DataFrame:
    """Each key once per day; a day's keys are forgotten once the watermark has passed it."""
    daily = stream.select(*keys, F.date_trunc("day", F.col(ts).cast("timestamp")).alias("day")).withWatermark("day", late)
    return daily.dropDuplicates([*keys, "day"]).select(*keys, F.col("day").cast("timestamp_ntz").alias("day"))


def question_set(stream: DataFrame, within: str = "30 days", item: str = "value") -> DataFrame:
    """Evaluation questions from a log of JSON lines (ts, question, answer, contexts), each question once.

    Lines that are no JSON, and lines without a question, an answer or a context, are left out.  Of lines that
    repeat a question the first to arrive is kept; a question is forgotten ``within`` after its time, so the
    state holds the questions of that span and no more.
    """
    kind = "ts timestamp, question string, answer string, contexts array<string>"
    line = stream.select(F.from_json(item, kind).alias("l")).select("l.*")
    strip = lambda c: F.btrim(c, F.lit(" \t\n\r\x0b\x0c"))
    told = line.select("ts", strip("question").alias("question"), strip("answer").alias("answer"), "contexts")
    whole = told.filter((F.col("question") != "") & (F.col("answer") != "") & (F.size("contexts") > 0) & F.col("ts").isNotNull())
    once = whole.withWatermark("ts", within).dropDuplicatesWithinWatermark(["question"])
    return once.select("question", F.lit("").alias("reference_answer"), F.array().cast("array<string>").alias("gold_contexts"))


def corpus_add(stream: DataFrame, seed: DataFrame, text: str, order_by: Sequence[str], folder: str) -> DataFrame:
    """Append unseen contents to a corpus that starts as ``seed``; a repeated batch replaces itself.

    Contents are hashed once, when they come in; a batch is compared with stored hashes.
    """
    spark = stream.sparkSession
    seed.select(content_hash(text)).write.mode("overwrite").parquet(f"{folder}/seed")

    def add(batch: DataFrame, number: int) -> None:
        seen = spark.read.parquet(f"{folder}/seed")
        if number > 0:
            stored = spark.read.parquet(f"{folder}/rows").filter(F.col("batch") < number)
            seen = seen.unionByName(stored.select("content_hash"))
        append_unseen(seen, batch, text, order_by).write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    q = stream.writeStream.foreachBatch(add).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.option("basePath", f"{folder}/rows").parquet(f"{folder}/rows").drop("batch", "content_hash")


def session_history(stream: DataFrame, key: str, ts: str, line: str, n: int = 20) -> DataFrame:
    """Last ``n`` lines per key; the state holds only those, whatever the order of arrival."""
    rows = stream.select(key, F.unix_micros(F.col(ts).cast("timestamp")).alias("__t"), F.col(line).cast("string").alias("__line"))

    def keep(who, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(zip(*state.get)) if state.exists else []
        total = held[0][2] if held else 0
        held = [(t, x) for t, x, _ in held]
        for pdf in chunks:
            total += len(pdf)
            recent = pdf.nlargest(n, "__t")
            held = sorted([*held, *zip(recent["__t"].tolist(), recent["__line"].tolist())])[-n:]
        state.update(([t for t, _ in held], [x for _, x in held], [total] * len(held)))
        yield pd.DataFrame({key: [who[0]], "n_lines": [len(held)], "n_total": [total], "history": ["\n".join(x for _, x in held)]})

    kind = stream.schema[key].dataType.simpleString()
    return rows.groupBy(key).applyInPandasWithState(
        keep,
        f"`{key}` {kind}, n_lines bigint, n_total bigint, history string",
        "times array<bigint>, lines array<string>, totals array<bigint>",
        "update",
        GroupStateTimeout.NoTimeout,
    )


def sessions(stream: DataFrame, key: str, ts: str, line: str, gap_s: int, n: int = 20, late: str = "1 hour") -> DataFrame:
    """Sessions per key: a new one begins where more than ``gap_s`` seconds pass without a line.

    Columns key, session_start, session_end, n_total and history, the last ``n`` lines.  The state of a key holds
    the sessions that a line can still reach, each with its last ``n`` lines; a timer set to the watermark at
    which the first of them ends frees it, and with its last session the key.  Lines may arrive in any order: one
    that closes a gap joins two sessions, and the later start is reported once more with ``n_total`` 0.
    """
    micro = lambda c: F.unix_micros(F.col(c))
    timed = _timed(stream, ts, late).filter(F.col(ts).isNotNull())
    rows = timed.select(F.col(key), F.col(ts).alias("__ts"), micro(ts).alias("__t"), F.coalesce(F.col(line).cast("string"), F.lit("")).alias("__line"))
    gap = gap_s * 1_000_000

    def join_up(parts: list[list]) -> list[list]:
        """Sessions (start, end, lines in all, last lines) in order, those within the gap made one."""
        out: list[list] = []
        for start, end, total, last in sorted(parts, key=lambda p: p[:2]):
            if out and start - out[-1][1] <= gap:
                held = out[-1]
                out[-1] = [held[0], max(held[1], end), held[2] + total, sorted(heapq.nlargest(n, [*held[3], *last]))]
            else:
                out.append([start, end, total, last])
        return out

    def keep(who, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [[s, e, c, [tuple(x) for x in last]] for s, e, c, last in json.loads(state.get[0])] if state.exists else []
        before = {s: (e, c) for s, e, c, _ in held}
        if not state.hasTimedOut:
            for pdf in chunks:
                if pdf.empty:
                    continue
                new = sorted(zip(pdf["__t"].tolist(), pdf["__line"].tolist()))
                times = np.array([t for t, _ in new], np.int64)
                ends = [*(np.flatnonzero(np.diff(times) > gap) + 1).tolist(), len(new)]
                parts = [[new[a][0], new[b - 1][0], b - a, new[max(a, b - n) : b]] for a, b in itertools.pairwise([0, *ends])]
                held = join_up([*held, *parts])
            changed = [s for s in held if before.get(s[0]) != (s[1], s[2])]
            gone = sorted(set(before) - {s[0] for s in held})
            out = [(who[0], s, e, c, "\n".join(x for _, x in last)) for s, e, c, last in changed] + [(who[0], s, s, 0, "") for s in gone]
            yield pd.DataFrame(out, columns=[key, "start", "end", "n_total", "history"])
        mark = state.getCurrentWatermarkMs() * 1000
        held = [s for s in held if s[1] + gap >= mark]
        if held:
            state.update((json.dumps(held),))
            state.setTimeoutTimestamp(max(mark, min(s[1] for s in held) + gap) // 1000 + 1)
        elif state.exists:
            state.remove()

    kind = stream.schema[key].dataType.simpleString()
    found = rows.groupBy(key).applyInPandasWithState(
        keep, f"`{key}` {kind}, start bigint, end bigint, n_total bigint, history string", "sessions string", "update", GroupStateTimeout.EventTimeTimeout
    )
    stamp = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return found.select(key, stamp("start").alias("session_start"), stamp("end").alias("session_end"), "n_total", "history")


def sliding_error(stream: DataFrame, ts: str, by: str, actual: str, predicted: str, size: str = "1 day", step: str = "6 hours", late: str = "1 hour"):
    """Row count, MAE and RMSE per sliding window and group."""
    err = F.col(actual) - F.col(predicted)
    out = _timed(stream, ts, late).groupBy(F.window(ts, size, step).alias("w"), by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse")
    )
    return out.select(by, F.col("w.start").cast("timestamp_ntz").alias("bin"), "n", "mae", "rmse")
