"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.session import run_folder, stored


def components(links: DataFrame) -> DataFrame:
    """``v`` and ``label`` (smallest vertex of its component) for every vertex of ``links`` (columns ``a``, ``b``).

    Every round takes the smallest label among neighbours and then follows labels one step, so long chains end
    in a logarithmic number of rounds. Each round is written to the shared folder; only a count reaches the driver.
    Repeated and turned links count once, a vertex linked with itself is a component, links with a null end do not
    count, an empty table gives an empty one.
    """
    folder = run_folder(links.sparkSession, "components")
    links = links.where("a is not null and b is not null")
    both = stored(links.select(F.col("a").alias("v"), F.col("b").alias("u"))
                  .union(links.select(F.col("b").alias("v"), F.col("a").alias("u"))).distinct(), f"{folder}/links")
    labels = stored(both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("label")),
                    f"{folder}/0")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels.select(F.col("v").alias("u"), "label"), "u").groupBy("v") \
            .agg(F.min("label").alias("near"))
        lower = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("l"))
        step = labels.select(F.col("v").alias("l"), F.col("label").alias("next"))
        found = stored(lower.join(step, "l", "left").select(
            "v", "old", F.least("l", F.coalesce("next", "l")).alias("label")), f"{folder}/{turn}")
        changed = not found.where("label <> old").isEmpty()
        labels = found.select("v", "label")
        if not changed:
            return labels
