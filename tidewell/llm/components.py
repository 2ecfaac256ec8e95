"""Connected components of a link table, all inside Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import drop_settled, settle


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.sum((F.col("lo") % 1_000_003).cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def smallest_reachable(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node and component (the smallest node reachable) of every linked node but the smallest itself.

    Links are long pairs in any order; repeated links and links of a node to itself add nothing, a link with
    a null end is no link, no links give no rows.  Large-star and small-star steps alternate: each link is
    hung onto the smallest neighbour of its lower end, then onto that of its upper end.  The number of links
    never grows, smallest neighbours are combined before the shuffle, and each round is written to the shared
    folder, so a hub of any degree costs no more than its links.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = settle(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(high.alias("hi"), low.alias("lo"))
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        smallest = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("low"))
        hung = (
            edges.join(smallest, F.col("lo") == F.col("node"), "left")
            .select("hi", F.coalesce("low", "lo").alias("lo"))
            .distinct()
        )
        smallest = hung.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("low"))
        both = hung.join(smallest, F.col("hi") == F.col("node")).select("hi", "lo", "low")
        turned = (
            both.select(
                F.explode(F.array(F.struct("hi", F.col("low").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("low").alias("lo")))).alias("e")
            )
            .select("e.*")
            .where("hi <> lo")
            .distinct()
        )
        new = settle(turned)
        drop_settled(edges)
        edges, before, state = new, state, _state(new)
        if state == before:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
