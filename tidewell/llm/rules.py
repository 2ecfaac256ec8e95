"""Quality rules: a table of thresholds compiled into one projection of Spark functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ids_and_texts

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to a in is that for it was on with be as by are this at".split(),
    "de": "der die und in den von zu das mit auf sich des für ist im dem nicht ein eine".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par pas au sur".split(),
    "es": "de la que el en y los se del las por un no con una su es para al".split(),
}


@dataclass(frozen=True)
class Rule:
    """A ratio of two measures (the second at least 1) and the limits it must keep; ``base`` rules are hard."""

    name: str
    over: str
    under: str | None = None
    least: float | None = None
    most: float | None = None
    base: bool = False


#: The threshold table.  A measure over nothing is the measure itself.
RULES = (
    Rule("few_words", "n_words", least=10, base=True),
    Rule("repeated_words", "n_repeat_words", "n_words", most=0.2, base=True),
    Rule("many_words", "n_words", most=1_000_000),
    Rule("word_length", "word_chars", "n_words", least=3.0, most=10.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=0.4),
    Rule("open_lines", "n_open_lines", "n_lines", most=0.5),
    Rule("listed_lines", "n_listed_lines", "n_lines", most=0.9),
)


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _repeat_words(words: str, window: int = WINDOW) -> str:
    """SQL of the words that lie in some window found twice or more.

    Windows are compared by hash first: where all hashes differ no window repeats.  Elsewhere the windows
    themselves are sorted, equal neighbours mark their starts, and each start adds the words it covers beyond
    the start before it.
    """
    rest = ", ".join(f"get({words}, i + {k})" for k in range(1, window))
    cut = f"slice({words}, 1, size({words}) - {window - 1})"
    hashes = f"transform({cut}, (x, i) -> xxhash64(x, {rest}))"
    sorted_windows = f"sort_array(transform({cut}, (x, i) -> struct(concat_ws(' ', x, {rest}) AS g, i AS i)))"
    starts = "sort_array(transform(filter(s, (e, k) -> e.g = get(s, k - 1).g OR e.g = get(s, k + 1).g), e -> e.i))"
    covered = (
        f"aggregate({_let(sorted_windows, 's', starts)}, named_struct('last', -{window}, 'n', 0L), "
        f"(a, p) -> named_struct('last', p, 'n', a.n + least({window}, p - a.last)), a -> a.n)"
    )
    repeated = _let(hashes, "h", "size(array_distinct(h)) < size(h)")
    return f"CASE WHEN size({words}) <= {window} THEN 0L WHEN {repeated} THEN {covered} ELSE 0L END"


def measures(stop_words: dict[str, list[str]] = STOP_WORDS) -> dict[str, Column]:
    """The measured columns over ``text``, ``words`` and ``lines`` (those with a word)."""
    stops = sorted({w for listed in stop_words.values() for w in listed})
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in stops)
    size = lambda e: F.expr(f"CAST(size({e}) AS LONG)")
    return {
        "n_words": size("words"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": F.expr("CAST(size(lines) - size(array_distinct(lines)) AS LONG)"),
        "n_repeat_words": F.expr(_repeat_words("words")),
        "n_lines": size("lines"),
        "n_open_lines": size(r"filter(lines, l -> rtrim(l) LIKE '%...' OR rtrim(l) LIKE '%…')"),
        "n_listed_lines": size(r"filter(lines, l -> ltrim(l) LIKE '- %' OR ltrim(l) LIKE '* %' OR ltrim(l) LIKE '• %')"),
        "n_stop_words": size(f"filter(words, w -> w IN ({listed}))") if stops else F.lit(0).cast("long"),
    }


def broken(rule: Rule) -> Column:
    """Whether a row breaks the rule."""
    value = F.col(rule.over).cast("double")
    if rule.under:
        value = value / F.greatest(F.col(rule.under), F.lit(1)).cast("double")
    out = F.lit(False)
    if rule.least is not None:
        out = out | (value < F.lit(float(rule.least)))
    if rule.most is not None:
        out = out | (value > F.lit(float(rule.most)))
    return out


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    stop_words: dict[str, list[str]] = STOP_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Measures and verdict of every document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_lines, n_open_lines, n_listed_lines, n_stop_words, failed_rules.

    The rules become columns of one projection; nothing is shuffled and no user function runs.  ``kept`` is
    false where any rule breaks, ``base_failed`` where a base rule does, ``failed_rules`` names the broken
    ones, comma-joined in the order of the table.  Lines count if they hold a word.  Ratios over nothing are
    over 1.  Null and empty texts have no words, so they fail the least word count; a text of any length is
    measured whole, with memory in proportion to it; every row, repeated or without id, is judged for itself;
    an empty table gives no rows.
    """
    texts = ids_and_texts(docs, id_col, text_col)
    cut = texts.select(
        "doc_id",
        "text",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.expr(r"filter(split(text, '\n'), l -> l RLIKE '[^\\x20\\x09-\\x0D]')").alias("lines"),
    )
    measured = cut.select("doc_id", *(c.alias(n) for n, c in measures(stop_words).items()))
    wrong = F.filter(F.array(*(F.when(broken(r), F.lit(r.name)) for r in rules)), lambda x: x.isNotNull())
    hard = F.lit(False)
    for rule in rules:
        if rule.base:
            hard = hard | broken(rule)
    return measured.withColumn("wrong", wrong).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        hard.alias("base_failed"),
        (F.size("wrong") == 0).alias("kept"),
        "n_lines",
        "n_open_lines",
        "n_listed_lines",
        "n_stop_words",
        F.array_join("wrong", ",").alias("failed_rules"),
    )
