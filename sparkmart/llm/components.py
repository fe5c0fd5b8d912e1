"""Connected components of a link table, as Spark joins (no link or component reaches the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import land


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp): ``comp`` is the least node of the component; only nodes with a link appear.

    Each round takes the least label among a node and its neighbours and then jumps to the label
    of that label, so chains shorten by more than half a round.  Every round is landed in the
    shared folder.  ``links`` has long columns a, b; self links and repeats do no harm; empty
    links give an empty result.
    """
    both = land(links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
                .where("a <> b").distinct(), name + "-links")
    state = land(both.groupBy(F.col("a").alias("node"))
                 .agg(F.least(F.min("a"), F.min("b")).alias("comp")), name)
    while True:
        near = (both.join(state, both.b == state.node).groupBy(F.col("a").alias("n"))
                .agg(F.min("comp").alias("best")))
        step = (state.join(near, state.node == F.col("n"))
                .select("node", F.col("comp").alias("was"), F.least("comp", "best").alias("comp")))
        jump = state.select(F.col("node").alias("j"), F.col("comp").alias("to"))
        new = land(step.join(jump, step.comp == F.col("j"), "left")
                   .select("node", F.least("comp", F.coalesce("to", "comp")).alias("comp"), "was"), name)
        if new.where("comp <> was").limit(1).count() == 0:
            return new.select("node", "comp")
        state = new.select("node", "comp")
