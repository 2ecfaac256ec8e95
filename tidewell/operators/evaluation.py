"""Conversation logs, evaluation records and local text scores."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import strings as S
from .relational import dedupe_first, top_per_key

# Speaker prefixes of a written-out history.
PREFIXES = {"user": "사용자:", "other": "어시스턴트:"}
PAIR_CHARS = r"\p{L}\p{N}_"
#: Rows whose words a task holds at a time.
FEW = 256


def question_answers(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """User turns with the assistant turn that follows; joined on (conversation, turn), so a long one is spread."""
    q = turns.filter(F.col(role) == "user").select(conv, turn, S.safe_str(text).alias("question"))
    a = turns.filter(F.col(role) == "assistant").select(conv, (F.col(turn) - 1).alias(turn), S.safe_str(text).alias("answer"))
    return q.join(a, [conv, turn])


def eval_set_from_log(log: DataFrame, order_by: Sequence[str], max_items: int = 500) -> DataFrame:
    """Distinct questions of complete log lines, first kept, at most ``max_items`` in log order."""
    full = log.withColumns({"question": S.safe_str("question"), "answer": S.safe_str("answer")}).filter(
        (F.col("question") != "") & (F.col("answer") != "") & (F.coalesce(F.size("contexts"), F.lit(0)) > 0)
    )
    return dedupe_first(full, ["question"], order_by).orderBy(*order_by).limit(max_items)


def drop_reason(question: Column, answer: Column, contexts: Column) -> Column:
    """Why a sample is dropped (answer before contexts), null when it is kept."""
    empty = F.coalesce(F.size(contexts), F.lit(0)) <= 0
    return (
        F.when(S.safe_str(question) == "", "empty_question")
        .when(S.safe_str(answer) == "", "empty_answer")
        .when(empty, "empty_context")
    )


def eval_records(df: DataFrame, question: str, reference: str | None) -> DataFrame:
    """Records with reference and empty gold contexts; blank questions are left out."""
    ref = S.safe_str(reference) if reference else F.lit("")
    out = df.withColumn("question", S.safe_str(question)).filter(F.col("question") != "")
    return out.withColumn("reference_answer", ref).withColumn("gold_contexts", F.array().cast("array<string>"))


def has_reference(records: DataFrame) -> DataFrame:
    """One row: records, and whether any reference is present, which decides the metric list."""
    n_ref = F.count_if(S.safe_str("reference_answer") != "")
    wide = F.lit("faithfulness,answer_relevancy,context_precision,context_recall")
    return records.agg(F.count(F.lit(1)).alias("n"), n_ref.alias("n_reference")).withColumn(
        "metrics", F.when(F.col("n_reference") > 0, wide).otherwise("faithfulness,answer_relevancy")
    )


def history_text(
    turns: DataFrame, conv: str, turn: str, role: str, text: str, n: int = 20, prefixes: Mapping[str, str] = PREFIXES
) -> DataFrame:
    """Last ``n`` non-blank lines of each conversation with the speaker in front."""
    said = turns.withColumn("__s", S.safe_str(text)).filter(F.col("__s") != "")
    line = F.concat_ws(" ", F.when(F.col(role) == "user", prefixes["user"]).otherwise(prefixes["other"]), F.col("__s"))
    last = top_per_key(said.select(conv, turn, line.alias("__line")), [conv], F.desc(turn), n)
    lines = F.sort_array(F.collect_list(F.struct(turn, "__line")))
    return last.groupBy(conv).agg(F.count(F.lit(1)).alias("n_lines"), F.array_join(lines.getField("__line"), "\n").alias("history"))


def user_history(turns: DataFrame, conv: str, turn: str, role: str, text: str, max_chars: int = 2000) -> DataFrame:
    """User lines from the start, cut to ``max_chars``; at most that many lines can matter."""
    line = F.concat(F.col(role), F.lit(":"), S.truncate(F.coalesce(text, F.lit("")), max_chars))
    said = turns.filter(F.col(role) == "user").select(conv, turn, line.alias("__line"))
    head = top_per_key(said, [conv], turn, max_chars)
    lines = F.sort_array(F.collect_list(F.struct(turn, "__line")))
    return head.groupBy(conv).agg(S.truncate(F.array_join(lines.getField("__line"), "\n"), max_chars).alias("history"))


def context_fallback(lists: Sequence[Column], k: int = 4, max_chars: int = 800) -> Column:
    """First ``k`` texts of the first non-empty list, each cut to ``max_chars``, blanks left out."""
    first = F.coalesce(*[F.when(F.size(c) > 0, c) for c in lists], F.array().cast("array<string>"))
    kept = F.filter(F.slice(first, 1, k), lambda x: F.coalesce(x != "", F.lit(False)))
    return F.transform(kept, lambda x: F.substring(x, 1, max_chars))


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"([{PAIR_CHARS}]{{2,}})"), F.lit(1))


def _grams(texts: list[list[str]]) -> Counter:
    """How often words and neighbouring pairs stand in texts."""
    held: Counter = Counter()
    for words in texts:
        held.update(words)
        held.update(zip(words, words[1:]))
    return held


def _cosine(a: Counter, b: Counter) -> float:
    """Cosine of the tf-idf vectors of two texts; 0 if one of them is empty."""
    square = (1.0 + math.log(1.5)) ** 2
    both = a.keys() & b.keys()
    size = lambda side: (shared := sum(side[t] ** 2 for t in both)) + square * (sum(n * n for n in side.values()) - shared)
    return sum(a[t] * b[t] for t in both) / (math.sqrt(size(a)) * math.sqrt(size(b))) if both else 0.0


def _cosines(df: DataFrame, ids: list[str], pairs: Mapping[str, tuple[Column, Column]], keep: Mapping[str, Column]) -> DataFrame:
    """Rows with ids, a cosine column for each pair, and the columns to keep; rows with a null id are left out.

    Rows that share their ids are one text: their terms are counted together.  The texts of an id meet once and
    their terms are compared there, so no row moves for a term.
    """
    sides = list({id(c): c for pair in pairs.values() for c in pair}.values())
    place = {id(c): i for i, c in enumerate(sides)}
    row = F.struct(*[c.alias(f"s{i}") for i, c in enumerate(sides)], F.struct(F.lit(True).alias("row"), *[c.alias(n) for n, c in keep.items()]).alias("kept"))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids])
    met = df.filter(whole).select(*ids, row.alias("__row")).repartition(*ids).groupBy(*ids).agg(F.collect_list("__row").alias("__rows"))
    met = met.select(*ids, F.col("__rows.kept").alias("__kept"), *[F.transform(f"__rows.s{i}", lambda c: _words(c)).alias(f"__s{i}") for i in range(len(sides))])
    wanted = [(place[id(a)], place[id(b)]) for a, b in pairs.values()]
    schema = T.StructType([*met.schema.fields[: len(ids) + 1], *[T.StructField(n, T.DoubleType()) for n in pairs]])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, FEW):
                b = whole.slice(at, FEW)
                terms = [list(map(_grams, column.to_pylist())) for column in b.columns[len(ids) + 1 :]]
                made = [pa.array(list(map(_cosine, terms[i], terms[j])), pa.float64()) for i, j in wanted]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(ids) + 1], *made], schema.names)

    rows = met.mapInArrow(compare, schema).select(*ids, *pairs, F.explode("__kept").alias("__row"))
    return rows.select(*ids, *pairs, *[F.col(f"__row.{n}") for n in keep])


def tfidf_pairs(df: DataFrame, id_cols: Sequence[str], pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Cosine of uni- and bigram tf-idf vectors of two texts, the idf fitted on just the two.

    A term in one text weighs ln(3/2) + 1, in both 1.  Blank or wordless texts, and rows with a null id, give 0.
    """
    ids = list(id_cols)
    long = lambda rows, value: rows.select(*ids, F.inline(F.array(*[F.struct(F.lit(n).alias("pair"), value(n).alias("cosine")) for n in pairs])))
    some_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ids])
    return long(_cosines(df, ids, pairs, {}), F.col).unionByName(long(df.filter(some_null), lambda n: F.lit(0.0)))


def fast_eval(df: DataFrame, id_cols: Sequence[str], question: str, answer: str, contexts: str) -> DataFrame:
    """Answer relevancy, context alignment, context count and answer length per row."""
    a = F.coalesce(F.col(answer), F.lit(""))
    pairs = {"answer_relevancy": (F.col(question), a), "context_alignment": (a, F.array_join(contexts, " "))}
    return _cosines(df, list(id_cols), pairs, {"ctx_count": F.size(contexts), "ans_len": F.length(a)})
