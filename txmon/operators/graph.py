"""Communities of accounts linked through shared counterparties.

Connected components of the bipartite account-counterparty graph by
iterative min-label propagation: every round is two grouped minimums
(partial aggregation, so a counterparty shared by a third of all accounts is
still combined map-side) and a join; the labels are checkpointed each round
to cut lineage, and jump to their own label's label, so that long chains need
few rounds.  Stops when no label changes, however many rounds that takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmon.session import checkpoint_dir


def shared_counterparty_components(wide: DataFrame) -> DataFrame:
    """(account_id, component_id) where component_id is the smallest account id in the component."""
    checkpoint_dir(wide.sparkSession)
    edges = (wide.filter(F.col("counterparty_account").isNotNull() & (F.col("counterparty_account") != ""))
             .select("account_id", F.col("counterparty_account").alias("cp")).distinct())
    edges = edges.checkpoint(eager=True)
    labels = edges.select("account_id").distinct().withColumn("label", F.col("account_id"))
    while True:
        cp_label = edges.join(labels, "account_id").groupBy("cp").agg(F.min("label").alias("cp_label"))
        proposed = edges.join(cp_label, "cp").groupBy("account_id").agg(F.min("cp_label").alias("p"))
        new = (labels.join(proposed, "account_id", "left")
               .select("account_id", F.least("label", F.coalesce("p", F.col("label"))).alias("label"),
                       (F.coalesce("p", F.col("label")) < F.col("label")).alias("_changed")))
        new = new.checkpoint(eager=True)
        if new.filter("_changed").isEmpty():
            labels = new.drop("_changed")
            break
        # pointer jumping: a label is an account, whose own label is as small or smaller
        jump = new.select(F.col("account_id").alias("label"), F.col("label").alias("_next"))
        labels = (new.drop("_changed").join(jump, "label", "left")
                  .select("account_id", F.least("label", F.coalesce("_next", F.col("label"))).alias("label"))
                  .checkpoint(eager=True))
    return labels.withColumnRenamed("label", "component_id")


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component_id").agg(F.count("*").alias("accounts"))
