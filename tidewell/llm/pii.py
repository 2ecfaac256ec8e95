"""Personal data: base patterns, and identifiers found by bootstrapped contexts, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import whole_text
from tidewell.session import drop_settled, settle

KINDS = ("email", "ip", "card", "phone")
# The base patterns.  Java needs possessive repeats to scan long runs without recursion, and a
# run of characters that may begin a match is tried from its first character only (\G: or from where the last
# match ended), as its other characters cannot begin one when the first does not.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a kind's pattern to be tried.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
#: Runs of tokens that hold a digit or an at sign: the candidates of the method.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [^\s0-9@]*+[0-9@]\S*+)*+"
EDGE = r"[\p{Punct}&&[^+@]]"
# The last word of a text and the one before it, read backwards.
LAST_WORDS = r"^[^\p{L}]*+([\p{L}]++)(?:[^\p{L}]++([\p{L}]++))?"
#: Rounds of scoring, distinct seeds that a pattern needs, and the score from which it and its finds count.
ROUNDS, SUPPORT, TRUST = 3, 5, 0.8


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn sum divisible by ten."""
    backwards = F.reverse(digits)
    numbers = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(backwards, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    return F.aggregate(numbers, F.lit(0), lambda total, n: total + n - F.when(n > 9, 9).otherwise(0)) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the kind's base pattern passes its check."""
    digits = _digits(value)
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 4).try_cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def fits(kind: str, core: Column) -> Column:
    """Whether a candidate could be an identifier of the kind, valid or not: what a pattern's score is out of."""
    count = F.length(_digits(core))
    if kind == "email":
        return core.rlike(r"^[^\s@]+@[^\s@]+$")
    if kind == "ip":
        return core.rlike(r"^[0-9]+(?:\.[0-9]+){3}$")
    if kind == "card":
        return core.rlike(r"^[0-9][0-9 -]*[0-9]$") & count.between(12, 19)
    return core.rlike(r"^\+?[0-9(][0-9().\x20-]*[0-9]$") & ~core.rlike(r"^[0-9]+(?:\.[0-9]+)*+$") & count.between(7, 15)


def _matches(text: Column, pattern: str, hint: str) -> tuple[Column, Column]:
    """Matches of the pattern, and the texts between them."""
    here = text.rlike(hint)
    empty = F.array().cast("array<string>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(here, found).otherwise(empty), F.when(here, F.split(text, pattern, -1)).otherwise(empty)


def _placed(rows: DataFrame, found: str, gaps: str, *more: str) -> DataFrame:
    """row, value, start, end of each match: a match starts after all gaps and matches before it."""
    each = rows.where(F.size(found) > 0).select("row", F.posexplode(F.arrays_zip(F.col(found).alias("value"), F.col(gaps).alias("gap"), *more)).alias("at", "m"))
    each = each.where("m.value is not null").select("row", "at", "m.*").withColumn("size", F.length("value"))
    upto = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    return each.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.col("size"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document, written once: row, doc_id, and per kind the matches and the lengths between them;
    for candidates also the end of the text before each."""
    text = F.col("text")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), whole_text(docs[text_col]).alias("text"))
    columns = []
    for kind in KINDS:
        found, between = _matches(text, BASE[kind], HINTS[kind])
        columns += [found.alias(kind), F.transform(between, F.length).alias(f"{kind}_gaps")]
    found, between = _matches(text, CANDIDATE, "[0-9@]")
    word = lambda back, n: F.reverse(F.regexp_extract(back, LAST_WORDS, n))
    left = lambda g: F.concat_ws(" ", word(F.reverse(g), 2), word(F.reverse(g), 1))
    before = F.transform(between, lambda g: F.struct(F.length(g).alias("n"), left(g).alias("left")))
    return settle(rows.select("doc_id", *columns, found.alias("candidate"), before.alias("before")).withColumn("row", F.monotonically_increasing_id()))


def base_spans(scanned: DataFrame) -> DataFrame:
    """row, kind, start, end of the base matches that pass their check."""
    parts = []
    for kind in KINDS:
        placed = _placed(scanned, kind, f"{kind}_gaps")
        parts.append(placed.where(valid(kind, F.col("value"))).select("row", F.lit(kind).alias("kind"), "start", "end"))
    return reduce(DataFrame.unionByName, parts)


def _trimmed(value: str) -> Column:
    return F.regexp_replace(F.regexp_replace(value, rf"^(?:{EDGE}(?!\())*+", ""), rf"{EDGE}+$", "")


def _seed(kind: str, core: Column) -> Column:
    return core.rlike("^(?:" + BASE[kind] + ")$") & valid(kind, core)


def _pieces(placed: DataFrame) -> DataFrame:
    """row, start, value, lefts: runs of several tokens cut at the tokens that fit a kind by themselves.

    A run that is as a whole a valid base match stays whole, and so do tokens between cuts, such as the groups of
    a spaced number.  Pieces share the words before their run.
    """
    whole = reduce(lambda a, b: a | b, (F.coalesce(_seed(k, _trimmed("value")), F.lit(False)) for k in KINDS))
    placed = placed.withColumn("cut", F.col("value").contains(" ") & ~whole)
    tokens = placed.where("cut").select("row", "at", "lefts", "start", F.posexplode(F.split("value", " ")).alias("p", "token"))
    run = Window.partitionBy("row", "at").orderBy("p")
    before = F.coalesce(F.sum(F.length("token") + 1).over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    alone = reduce(lambda a, b: a | b, (F.coalesce(fits(k, _trimmed("token")), F.lit(False)) for k in KINDS))
    tokens = tokens.withColumn("begin", F.col("start") + before).withColumn("alone", alone)
    opens = F.col("alone") | F.coalesce(F.lag("alone").over(run), F.lit(False))
    tokens = tokens.withColumn("piece", F.sum(opens.cast("int")).over(run))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p", "token"))), lambda t: t["token"]), " ")
    parts = tokens.groupBy("row", "at", "piece").agg(F.min("begin").alias("start"), joined.alias("value"), F.max("lefts").alias("lefts"))
    return placed.where("not cut").select("row", "start", "value", "lefts").unionByName(parts.select("row", "start", "value", "lefts"))


def candidates(scanned: DataFrame) -> DataFrame:
    """row, start, end, kind, instance, seed, patterns: a row for each kind that a candidate could be, or one of null kind.

    The punctuation around a candidate is not part of it.  Its patterns are the word and the two words before
    it; it is a seed of a kind if it is as a whole a valid base match.
    """
    rows = scanned.withColumn("gaps", F.transform("before", lambda b: b["n"])).withColumn("lefts", F.transform("before", lambda b: b["left"]))
    placed = _pieces(_placed(rows, "candidate", "gaps", "lefts"))
    lead = F.length(F.regexp_extract("value", rf"^(?:{EDGE}(?!\())*+", 0))
    placed = placed.withColumn("core", _trimmed("value")).withColumn("start", F.col("start") + lead).withColumn("end", F.col("start") + F.length("core"))
    words = F.regexp_extract_all(F.lower("lefts"), F.lit(r"[\p{L}]+"), F.lit(0))
    one, two = F.element_at("w", -1), F.concat_ws(" ", F.slice("w", -2, 2))
    kinds = []
    for kind in KINDS:
        seed = _seed(kind, F.col("core"))
        kinds.append(F.when(fits(kind, F.col("core")), F.struct(F.lit(kind).alias("kind"), F.coalesce(seed, F.lit(False)).alias("seed"))))
    patterns = F.when(F.size("w") >= 2, F.array(F.concat(F.lit("1:"), one), F.concat(F.lit("2:"), two))).when(F.size("w") == 1, F.array(F.concat(F.lit("1:"), one)))
    return (
        placed.where(F.length("core") > 0)
        .withColumn("w", words)
        .select("row", "start", "end", F.lower("core").alias("instance"), patterns.alias("patterns"), F.explode_outer(F.filter(F.array(*kinds), lambda k: k.isNotNull())).alias("k"))
        .select("row", "start", "end", "instance", "patterns", "k.kind", "k.seed")
    )


def bootstrap(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, trust: float = TRUST) -> DataFrame:
    """kind, instance of the unseen identifiers that trusted patterns discover.

    The graph links patterns with instances.  A pattern's score is the mean score of its instances, if it has
    ``support`` distinct seeds at least: those that could not be of the kind score 0, unseen ones that could
    are left out until a pattern has scored them.  An unseen instance takes the best score of its patterns if
    that is ``trust`` or more, else none; seeds keep 1.  Both sides are scored in turn, from tables of distinct
    links that are combined before each shuffle.
    """
    # distinct instances of each pattern, whatever they could be
    alike = found.where("patterns is not null").select("instance", F.explode("patterns").alias("pattern")).distinct()
    totals = settle(alike.groupBy("pattern").agg(F.count("*").alias("all")))
    edges = settle(
        found.where("patterns is not null and kind is not null")
        .select("kind", "instance", "seed", F.explode("patterns").alias("pattern"))
        .groupBy("kind", "pattern", "instance")
        .agg(F.max("seed").alias("seed"))
    )
    scores = settle(edges.groupBy("kind", "instance").agg(F.when(F.max("seed"), F.lit(1.0)).alias("score")))
    for _ in range(rounds):
        patterns = (
            edges.join(scores, ["kind", "instance"])
            .groupBy("kind", "pattern")
            .agg(F.sum("score").alias("sum"), F.count("score").alias("scored"), F.count("*").alias("fit"), F.sum(F.col("seed").cast("int")).alias("seeds"))
            .where(F.col("seeds") >= support)
            .join(totals, "pattern")
            .withColumn("trust", F.col("sum") / (F.col("scored") + F.col("all") - F.col("fit")))
            .where(F.col("trust") >= trust)
        )
        best = edges.join(patterns.select("kind", "pattern", "trust"), ["kind", "pattern"], "left").groupBy("kind", "instance")
        new = settle(best.agg(F.when(F.max("seed"), F.lit(1.0)).otherwise(F.max("trust")).alias("score"), F.max("seed").alias("known")))
        drop_settled(scores)
        scores = new
    return scores.where((F.col("score") >= trust) & ~F.col("known")).select("kind", "instance") if rounds else scores.select("kind", "instance").limit(0)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document.

    Counts and base_sha256 are of the base spans, ``spans`` lists these and the discovered ones as
    kind:start:end by start and then kind, in code points, ends exclusive.  A discovered span never overlaps a
    base span.  Null and empty texts have no spans; each row reports for itself, whatever its doc_id; an
    empty table gives no rows.
    """
    scanned = scan(docs, id_col, text_col)
    base = settle(base_spans(scanned))
    found = settle(candidates(scanned))
    seen = base.select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"))
    unseen = found.where("kind is not null and not seed").join(bootstrap(found), ["kind", "instance"], "left_semi")
    extra = unseen.join(seen, (F.col("row") == F.col("r")) & (F.col("start") < F.col("e")) & (F.col("end") > F.col("s")), "left_anti")
    every = base.withColumn("own", F.lit(True)).unionByName(extra.select("row", "kind", "start", "end").withColumn("own", F.lit(False)))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    gathered = every.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", order.alias("o"), "kind", "end", "own"))).alias("all"))
    out = scanned.select("row", "doc_id").join(gathered, "row", "left")
    spans = F.coalesce("all", F.array().cast("array<struct<start: bigint, o: bigint, kind: string, end: bigint, own: boolean>>"))
    own = F.filter(spans, lambda x: x["own"])
    count = lambda kind: F.size(F.filter(own, lambda x: x["kind"] == kind))
    text = lambda list_: F.array_join(F.transform(list_, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.select(
        "doc_id",
        *(count(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(text(own), 256).alias("base_sha256"),
        text(spans).alias("spans"),
    )
