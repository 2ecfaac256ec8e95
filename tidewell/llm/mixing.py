"""Mixing sources to target weights: raked token weights and calibrated sampling, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import whole_text
from tidewell.session import drop_settled, settle

#: Raking rounds.
ROUNDS = 12
#: Listed shares that leave less than this leave nothing.
LEAST_LEFT = 1e-9
UNKNOWN = "unknown"
# Target shares of languages; what they leave goes to languages not listed, by their tokens.  As
# all four leave nothing, languages not listed then keep their own share of the tokens.
LANG_SHARES = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
# Target shares of topics; texts of no other topic are prose.
TOPIC_SHARES = {"prose": 0.7, "table": 0.05, "shout": 0.05, "figures": 0.2}
SOURCE_POWER = 0.7


def n_words(text: Column) -> Column:
    """Words between white space of the whole text: the token weight."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: Column) -> Column:
    """Topic by the form of the whole text: columns, exclamations, figures, or prose."""
    size = F.greatest(F.length(text), F.lit(1))
    share = lambda chars: (F.length(text) - F.length(F.translate(text, chars, ""))) / size
    return (
        F.when(share("|") >= 0.02, "table").when(share("!") >= 0.02, "shout").when(share("0123456789") >= 0.005, "figures").otherwise("prose")
    )


def unit(doc_id: Column) -> Column:
    """Number in [0, 1) from the id alone, the same on every run: the first 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / 4294967296.0


def shares_of(cells: DataFrame, dim: str, shares: dict[str, float] | None, power: float) -> DataFrame:
    """Columns <dim>, goal: target share of each level present, summing to 1.

    Listed shares count for the levels present; unlisted levels divide what is left by tokens to ``power``.  If
    the listed ones leave nothing, unlisted levels keep their share of the tokens and listed ones divide the rest.
    """
    levels = cells.groupBy(dim).agg(F.sum("tokens").alias("t")).where("t > 0")
    listed = reduce(lambda c, kv: c.when(F.col(dim) == kv[0], F.lit(float(kv[1]))), (shares or {}).items(), F.when(F.lit(False), F.lit(0.0)))
    levels = levels.select(dim, "t", listed.alias("listed"), F.when(listed.isNull(), F.pow(F.col("t").cast("double"), power)).alias("own"))
    sums = levels.agg(
        F.coalesce(F.sum("listed"), F.lit(0.0)).alias("given"),
        F.coalesce(F.sum("own"), F.lit(0.0)).alias("rest"),
        (F.coalesce(F.sum(F.when(F.col("listed").isNull(), F.col("t"))), F.lit(0)) / F.sum("t")).alias("unlisted"),
    )
    full = (F.col("rest") > 0) & (F.col("given") >= 1 - LEAST_LEFT)
    left = F.when(full, F.col("unlisted")).otherwise(F.greatest(1 - F.col("given"), F.lit(0.0)))
    raw = levels.join(sums).select(
        dim,
        F.coalesce(
            F.when(full, F.col("listed") / F.col("given") * (1 - F.col("unlisted"))).otherwise(F.col("listed")), F.when(F.col("rest") > 0, left * F.col("own") / F.col("rest")), F.lit(0.0)
        ).alias("raw"),
        "given",
        "rest",
    )
    whole = F.when(F.col("rest") > 0, F.lit(1.0)).otherwise(F.col("given"))
    return raw.select(dim, F.when(whole > 0, F.col("raw") / whole).otherwise(F.lit(0.0)).alias("goal"))


def rake(cells: DataFrame, dims: dict[str, dict[str, float] | None], rounds: int = ROUNDS, power: float = SOURCE_POWER) -> DataFrame:
    """Iterative proportional fitting of the cells' token shares (column weight) to every margin's goals.

    ``cells`` holds a row per combination of levels with its tokens; each step scales the cells of a level so
    that their weights sum to the level's goal.  A step's sums are combined before they are shuffled and joined
    back, and its cells are written once, so that no step computes the ones before it again.
    """
    total = cells.agg(F.sum("tokens").cast("double").alias("all"))
    fitted = cells.where("tokens > 0").join(total).select(*dims, "docs", "tokens", (F.col("tokens") / F.col("all")).alias("weight"))
    for dim, shares in dims.items():
        goals = shares_of(cells, dim, shares, power).select(F.col(dim).alias("level"), F.col("goal").alias(f"goal_{dim}"))
        fitted = fitted.join(goals, F.col(dim) == F.col("level")).drop("level")
    fitted = settle(fitted)
    for _ in range(rounds):
        for dim in dims:
            margin = fitted.groupBy(F.col(dim).alias("level")).agg(F.sum("weight").alias("now"))
            weight = F.when(F.col("now") > 0, F.col("weight") * F.col(f"goal_{dim}") / F.col("now")).otherwise(F.lit(0.0))
            step = settle(fitted.join(margin, F.col(dim) == F.col("level")).withColumn("weight", weight).drop("level", "now"))
            drop_settled(fitted)
            fitted = step
    return fitted.select(*dims, "docs", "tokens", "weight")


def calibrate(cells: DataFrame, budget: float) -> DataFrame:
    """Adds probability: min(1, scale x weight / tokens), with the scale at which ``budget`` tokens are expected.

    The expectation is the tokens of the cells taken whole and scale times the weight of the others, so it rises
    along straight pieces that get flatter.  Each step follows the piece at hand to the budget, which never
    passes the scale sought, and takes whole the cells it passes; where it passes none the budget is met
    exactly.  A step is one aggregate, whatever the number of cells and however unequal their weights.  A budget
    above the tokens of all cells with weight takes these whole.
    """
    rated = settle(cells.withColumn("ratio", F.col("weight") / F.col("tokens")))
    scale, taken = 0.0, -1
    while True:
        whole = F.col("ratio") * F.lit(scale) >= 1
        given, left, count = rated.where("weight > 0").agg(
            F.coalesce(F.sum(F.when(whole, F.col("tokens"))), F.lit(0)).cast("double"),
            F.coalesce(F.sum(F.when(~whole, F.col("weight"))), F.lit(0.0)),
            F.count_if(whole),
        ).first()
        if count == taken or left <= 0 or given >= budget:
            break
        scale, taken = (budget - given) / left, count
    p = F.when(F.col("weight") > 0, F.least(F.lit(1.0), F.col("ratio") * F.lit(scale))).otherwise(F.lit(0.0))
    return rated.withColumn("probability", p).drop("ratio")


def mixed(
    docs: DataFrame,
    dims: dict[str, Column],
    shares: dict[str, dict[str, float] | None],
    keep: float = 0.5,
    rounds: int = ROUNDS,
    power: float = SOURCE_POWER,
    id_col: str = "doc_id",
    text_col: str = "text",
    slim: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Cells with their fitted weight and probability, and documents with dims, n_tokens, u and their own columns.

    ``slim`` rows have doc_id and no other column of their own; they are written once, so each text is read once.

    ``dims`` names a column expression for each margin (null levels are the level "unknown"), ``shares`` the
    target shares of its levels, ``keep`` the share of all tokens that the sample is to hold.
    """
    text = whole_text(docs[text_col])
    levels = [F.coalesce(c.cast("string"), F.lit(UNKNOWN)).alias(f"·{d}") for d, c in dims.items()]
    own = [docs[id_col].cast("long").alias("doc_id")] if slim else ["*"]
    rows = docs.select(*own, *levels, n_words(text).alias("·tokens"), unit(docs[id_col]).alias("·u"))
    rows = settle(rows) if slim else rows
    cells = settle(
        rows.groupBy(*(F.col(f"·{d}").alias(d) for d in dims)).agg(F.count("*").alias("docs"), F.sum("·tokens").alias("tokens"))
    )
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    fitted = calibrate(rake(cells, {d: shares.get(d) for d in dims}, rounds, power), keep * total)
    return fitted, rows


def default_dims(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> dict[str, Column]:
    return {"source": docs[source_col], "lang": docs[lang_col], "topic": topic_of(whole_text(docs[text_col]))}


DEFAULT_SHARES = {"source": None, "lang": LANG_SHARES, "topic": TOPIC_SHARES}


def _join(rows: DataFrame, fitted: DataFrame, dims: dict) -> DataFrame:
    cells = fitted.select(*(F.col(d).alias(f"·cell_{d}") for d in dims), F.col("weight").alias("·weight"), F.col("probability").alias("·p"))
    same = reduce(lambda a, b: a & b, (F.col(f"·{d}") == F.col(f"·cell_{d}") for d in dims))
    return rows.join(cells, same, "left")


def mix_report(docs: DataFrame, keep: float = 0.5, shares: dict | None = None, id_col: str = "doc_id") -> DataFrame:
    """A row per document: its levels, tokens, its cell's fitted share of tokens, its probability and the draw.

    Null levels are "unknown"; null and empty texts have no tokens, probability 0 and are not sampled; repeated
    rows of an id share one draw, rows without id the draw of the empty id; an empty table gives no rows.
    """
    dims = default_dims(docs)
    fitted, rows = mixed(docs, dims, shares or DEFAULT_SHARES, keep, id_col=id_col, slim=True)
    p = F.when(F.col("·tokens") > 0, F.coalesce("·p", F.lit(0.0))).otherwise(0.0)
    return _join(rows, fitted, dims).select(
        "doc_id",
        *(F.col(f"·{d}").alias(d) for d in dims),
        F.col("·tokens").alias("n_tokens"),
        F.round(F.coalesce("·weight", F.lit(0.0)), 6).alias("cell_share"),
        F.round(p, 6).alias("probability"),
        (F.col("·u") < p).alias("sampled"),
    )


def sample_mix(docs: DataFrame, keep: float = 0.5, shares: dict | None = None, id_col: str = "doc_id") -> DataFrame:
    """The sampled documents with all their columns."""
    dims = default_dims(docs)
    fitted, rows = mixed(docs, dims, shares or DEFAULT_SHARES, keep, id_col=id_col)
    drawn = _join(rows, fitted, dims).where((F.col("·tokens") > 0) & (F.col("·u") < F.col("·p")))
    return drawn.select(*(F.col(f"`{c}`") for c in docs.columns))
