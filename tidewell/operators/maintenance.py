"""Inserts, updates, deletes, normalisation and audits of tables, each as a new DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import earliest, join_on_keys, with_position
from .relational import dedupe_first


#: Tables that wide feedback rows are normalised to.
TABLES = ("app_user", "model", "feedback", "tag", "feedback_tag")


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: str, id_col: str, order_by: Sequence[str]) -> DataFrame:
    """``target`` with the unseen keys of ``incoming`` added under new dense ids; ``is_new`` marks them.

    Join it on ``key`` to get the id of any key, old or new.  A null key is a key like any other.
    """
    known = target.select(F.col(key).alias("__k"))
    fresh = incoming.join(known, F.col(key).eqNullSafe(F.col("__k")), "left_anti")
    fresh = fresh.groupBy(key).agg(earliest(order_by).alias("__first"))
    top = F.coalesce(target.agg(F.max(id_col)).scalar(), F.lit(0))
    fresh = with_position(fresh, ["__first", key], name="__rn").select(key, (F.col("__rn") + top).alias(id_col))
    old = target.select(key, id_col).withColumn("is_new", F.lit(False))
    return old.unionByName(fresh.withColumn("is_new", F.lit(True)))


def dimension(rows: DataFrame, name: str, order_by: Sequence[str], id_col: str) -> DataFrame:
    """Distinct names with dense ids in order of first appearance."""
    first = rows.filter(F.col(name).isNotNull()).groupBy(name).agg(earliest(order_by).alias("__first"))
    return with_position(first, ["__first", name], name=id_col).select(id_col, name)


def normalise_feedback(wide: DataFrame, line: str = "line", tables: Sequence[str] = TABLES) -> dict[str, DataFrame]:
    """Wide feedback rows to user, model, feedback, tag and feedback_tag tables; only those asked for are built.

    Of rows with the same ``feedback_id`` the first gives the fields, while the tags of all
    of them are linked.  ``tags`` is an array, ``line`` the unique order of the rows.  Feedback without user
    or model keeps a null there, rows without ``feedback_id`` are one feedback.
    """
    wants = lambda *names: any(n in tables for n in names)
    out: dict[str, DataFrame] = {}
    if wants("app_user", "feedback"):
        out["app_user"] = dimension(wide, "user_name", [line], "user_id")
    if wants("model", "feedback"):
        out["model"] = dimension(wide, "model_name", [line], "model_id")
    if wants("feedback", "feedback_tag"):
        first = with_position(dedupe_first(wide, ["feedback_id"], [line]), [line], name="feedback_pk")
    if wants("feedback"):
        named = first.join(out["app_user"], "user_name", "left").join(out["model"], "model_name", "left")
        out["feedback"] = named.select(
            "feedback_pk", "feedback_id", "user_id", "model_id", "prompt_text", "response_text", "rating", F.col("tags").alias("tags_array")
        )
    if wants("tag", "feedback_tag"):
        tagged = wide.select("feedback_id", line, F.posexplode("tags").alias("pos", "tag_name"))
        out["tag"] = dimension(tagged, "tag_name", [line, "pos"], "tag_id")
    if wants("feedback_tag"):
        link = tagged.select("feedback_id", "tag_name").distinct().join(out["tag"], "tag_name")
        out["feedback_tag"] = join_on_keys(link, first.select("feedback_id", "feedback_pk"), ["feedback_id"]).select("feedback_pk", "tag_id")
    return {name: out[name] for name in tables}


def last_changes(changes: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key: of each field the last value that is not null, by ``order_by``."""
    fields = [c for c in changes.columns if c != key and c not in order_by]
    last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order_by))).alias(c)
    return changes.groupBy(key).agg(*map(last, fields))


def rejected_changes(target: DataFrame, changes: DataFrame, key: str, unique: str) -> DataFrame:
    """Changes whose new unique value another key already has, or the change of a smaller key claims.

    A change that keeps its key's own value claims nothing.
    """
    holders = target.select(F.col(key).alias("__k"), F.col(unique).alias("__u"))
    taken = changes.join(holders, (F.col(unique) == F.col("__u")) & (F.col(key) != F.col("__k")), "left_semi")
    claims = changes.filter(F.col(unique).isNotNull()).join(holders, (F.col(key) == F.col("__k")) & (F.col(unique) == F.col("__u")), "left_anti")
    firsts = claims.groupBy(unique).agg(F.min(key).alias("__first"))
    later = claims.join(firsts, unique).filter(F.col(key) != F.col("__first"))
    unknown = changes.join(target.select(key), key, "left_anti")
    reason = lambda df, why: df.select(key, F.lit(why).alias("reason"))
    every = reason(taken, "taken").unionByName(reason(later, "claimed")).unionByName(reason(unknown, "unknown key"))
    return every.groupBy(key).agg(F.max("reason").alias("reason"))


def update_by_key(
    target: DataFrame, changes: DataFrame, key: str, unique: str | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Non-null fields of ``changes`` replace those of the same key; changes breaking uniqueness are left out.

    Repeated changes of a key count as one, of which ``order_by`` (by default the fields themselves) says
    what comes last; a row of the target is never doubled.
    """
    if order_by is None:
        order_by = [f"__o_{c}" for c in changes.columns if c != key]
        changes = changes.withColumns({f"__o_{c}": F.col(c) for c in changes.columns if c != key})
    changes = last_changes(changes, key, order_by)
    if unique:
        changes = changes.join(rejected_changes(target, changes, key, unique), key, "left_anti")
    fields = [c for c in changes.columns if c != key]
    new = changes.select(key, *[F.col(c).alias(f"__n_{c}") for c in fields])
    out = target.join(new, key, "left")
    return out.withColumns({c: F.coalesce(f"__n_{c}", c) for c in fields}).drop(*[f"__n_{c}" for c in fields])


def delete_cascade(
    tables: Mapping[str, DataFrame], gone: DataFrame, parent: str, key: str, children: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Remove keys from the parent and the rows that refer to them from each child (table -> column)."""
    keys = gone.select(F.col(key).alias("__k")).distinct()
    out = {parent: tables[parent].join(keys, F.col(key) == F.col("__k"), "left_anti")}
    for name, ref in children.items():
        out[name] = tables[name].join(keys, F.col(ref) == F.col("__k"), "left_anti")
    return out


def apply_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in defaults.items()})


# -- audits ------------------------------------------------------------------------------


def audit_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def audit_fk(child: DataFrame, ref: str, parent: DataFrame, key: str, not_null: bool = False) -> DataFrame:
    """Child rows whose reference has no parent; a null reference passes unless ``not_null``."""
    known = parent.select(F.col(key).alias("__k"))
    lost = child.join(known, F.col(ref) == F.col("__k"), "left_anti")
    return lost if not_null else lost.filter(F.col(ref).isNotNull())


def audit_check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking a rule, once per rule; a rule that is null passes."""
    broken = F.array_compact(F.array(*[F.when(~c, F.lit(n)) for n, c in rules.items()]))
    return df.withColumn("rule_name", F.explode(broken))


def audit_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null count of each column in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "n_null")


def audit_length(df: DataFrame, bounds: Mapping[str, int]) -> DataFrame:
    """Rows whose text is longer, or whose vector has another length, than declared."""
    rules = {}
    for c, n in bounds.items():
        if isinstance(df.schema[c].dataType, T.ArrayType):
            rules[f"dimension({c}) = {n}"] = F.size(c) == n
        else:
            rules[f"length({c}) <= {n}"] = F.length(c) <= n
    return audit_check(df, rules)


# -- corpora -----------------------------------------------------------------------------


def content_hash(text: str) -> Column:
    return F.sha2(text, 256).alias("content_hash")


def append_unseen(stored: DataFrame, incoming: DataFrame, text: str, order_by: Sequence[str]) -> DataFrame:
    """Incoming rows, with their ``content_hash``, whose hash is not among the stored ones, each content (null is one) once."""
    known = stored.select(F.col("content_hash").alias("__h_stored"))
    fresh = incoming.withColumn("content_hash", content_hash(text)).join(known, F.col("content_hash").eqNullSafe(F.col("__h_stored")), "left_anti")
    return dedupe_first(fresh, ["content_hash"], order_by)


def corpus_append(corpus: DataFrame, incoming: DataFrame, text: str, order_by: Sequence[str]) -> DataFrame:
    """Incoming rows whose content is not stored yet, each content once; appending twice adds nothing."""
    return append_unseen(corpus.select(content_hash(text)), incoming, text, order_by)


def corpus_status(chunks: DataFrame, by: str) -> DataFrame:
    """Chunks, documents and characters per collection."""
    per_doc = chunks.groupBy(by, "doc_id").agg(F.count(F.lit(1)).alias("__n"), F.sum(F.length("text")).alias("__c"))
    return per_doc.groupBy(by).agg(
        F.sum("__n").alias("n_chunks"), F.count(F.lit(1)).alias("n_documents"), F.sum("__c").alias("n_chars")
    )
