"""Wallets that spend together: components, edges, and rows that share an attribute."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletgraph.operators.graph import SMALL, connected_components
from walletgraph.operators.normalize import dictionary
from walletgraph.shared import Table

#: Wallets of a cluster in one row.
MEMBERS = 1000
#: Pairs (tx, wallet) of a part that links are made from.
PAIRS = 1_000_000


def star_edges(pairs: DataFrame, tx: str = "tx", wallet: str = "wallet") -> DataFrame:
    """Each wallet of a transaction with the smallest one: as many edges as pairs (repeated ones go when they are contracted), never all pairs of a transaction."""
    least = F.min(wallet).over(Window.partitionBy(tx))  # one shuffle; a transaction's rows are bounded by its block
    return pairs.where(F.col(tx).isNotNull() & F.col(wallet).isNotNull()).select(F.col(wallet).alias("a"), least.alias("b"))


def components(pairs: DataFrame, tx: str = "tx", wallet: str = "wallet", small: int = SMALL) -> DataFrame:
    """(wallet, component): the smallest wallet that it is linked to; wallets that are alone are their own."""
    return connected_components(star_edges(pairs, tx, wallet), small=small).select(F.col("node").alias(wallet), "component")


def cluster(pairs: DataFrame, tx: str = "tx", wallet: str = "wallet") -> DataFrame:
    """(wallet, cluster_id): dense ids from 0 in the order of the components' smallest wallets."""
    found = components(pairs, tx, wallet)
    return found.join(dictionary(found, "component", "cluster_id"), "component").select(wallet, "cluster_id")


def positions(found: DataFrame, wallet: str = "wallet", group: str = "component") -> DataFrame:
    """(group, position, wallet): each group's wallets in order, from 0; no task holds a whole group."""
    key = F.struct(F.col(group).alias("g"), F.col(wallet).alias("w"))
    placed = Table(dictionary(found.withColumn("__key", key), "__key", "__n").select("__key.g", "__key.w", "__n"), "positions")
    first = placed.df.groupBy("g").agg(F.min("__n").alias("__first"))
    return placed.df.join(first, "g").select(F.col("g").alias(group), (F.col("__n") - F.col("__first")).alias("position"), F.col("w").alias(wallet))


def members(found: DataFrame, wallet: str = "wallet", group: str = "component", size: int = MEMBERS) -> DataFrame:
    """(group, part, members): each group's wallets in order, `size` of them a row."""
    rows = found.select(group, wallet).where(F.col(group).isNotNull()).distinct()
    return cut(Table(rows, "members").df, wallet, group, size)


def cut(rows: DataFrame, wallet: str, group: str, size: int = MEMBERS) -> DataFrame:
    """The same from a written table of distinct rows without null groups.

    Groups that fit a row are gathered as they are; only the rows of larger ones are put in order by position."""
    rows = rows.select(F.col(group).alias("g"), F.col(wallet).alias("w"))
    large = Table(rows.groupBy("g").count().where(F.col("count") > size).select("g"), "large").df
    if large.isEmpty():
        return _gathered(rows).withColumnRenamed("g", group)
    placed = positions(rows.join(large, "g", "left_semi"), "w", "g").withColumn("part", F.expr(f"position DIV {size}"))
    parts = placed.groupBy("g", "part").agg(F.sort_array(F.collect_list("w")).alias("members"))
    return _gathered(rows.join(large, "g", "left_anti")).unionByName(parts).withColumnRenamed("g", group)


def _gathered(rows: DataFrame) -> DataFrame:
    return rows.groupBy("g").agg(F.sort_array(F.collect_list("w")).alias("members")).select("g", F.lit(0).cast("long").alias("part"), "members")


def sizes(found: DataFrame, group: str = "component") -> DataFrame:
    return found.groupBy(group).agg(F.count("*").alias("n_wallets"))


def spend_edges(pairs: DataFrame, tx: str = "tx", wallet: str = "wallet") -> DataFrame:
    """Distinct (a, b), a < b, of wallets in one transaction: a report of links; components use stars.

    The number of parts follows the rows, so that a task's table of edges doesn't.
    A transaction of n inputs has n (n - 1) / 2 of them; n is bounded by its block's size, some thousands."""
    rows = Table(pairs.select(F.col(tx).alias("tx"), F.col(wallet).alias("wallet")).where("tx is not null and wallet is not null"), "pairs").df
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PAIRS))
    left, right = (rows.select("tx", F.col("wallet").alias(x)).repartition(parts, "tx") for x in "ab")
    # Edges meet before they are made distinct: tables of those of one task would be large and hardly smaller than what goes in.
    return left.join(right, "tx").where("a < b").select("a", "b").repartition(parts, "a", "b").distinct()


def neighbors(pairs: DataFrame, of, tx: str = "tx", wallet: str = "wallet") -> DataFrame:
    """Distinct other wallets in the transactions of one wallet."""
    own = pairs.where(F.col(wallet) == of).select(tx).distinct()
    return pairs.join(own, tx, "left_semi").where((F.col(wallet) != of) & F.col(wallet).isNotNull()).select(wallet).distinct()


def one_hop_label(pairs: DataFrame, tx: str = "tx", wallet: str = "wallet") -> DataFrame:
    """(wallet, label): the smallest of itself and its direct neighbours; the label of a single round, no component."""
    least = pairs.groupBy(tx).agg(F.min(wallet).alias("m"))
    return pairs.join(least, tx).groupBy(wallet).agg(F.min("m").alias("label"))


def match_rows(df: DataFrame, attributes: list[str], row: str) -> DataFrame:
    """Rows that share a value of an attribute, directly or through others, are one wallet.

    Attributes that a row lacks are filled from its wallet where known. Identifier counts wallets: those
    with all attributes known first, each in the order of its first row. Missing values match nothing.
    """
    values = df.select(F.col(row).alias("r"), F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in attributes))).alias("x")).where("x.v is not null")
    first = values.groupBy("x").agg(F.min("r").alias("b"))
    edges = values.join(first, "x").select(F.col("r").alias("a"), "b").unionByName(df.select(F.col(row).alias("a"), F.col(row).alias("b")))
    found = connected_components(edges).select(F.col("node").alias(row), "component")
    joined = df.join(found, row)
    wallets = joined.groupBy("component").agg(*(F.max(c).alias(f"__{c}") for c in attributes))
    lacks = F.greatest(*(F.col(f"__{c}").isNull().cast("int") for c in attributes)) if len(attributes) > 1 else F.col(f"__{attributes[0]}").isNull().cast("int")
    wallets = wallets.withColumn("__order", F.struct(lacks, "component"))
    ids = dictionary(wallets, "__order", "Identifier")
    rest = [c for c in df.columns if c not in attributes]
    return joined.join(wallets.join(ids, "__order"), "component").select(*rest, *(F.coalesce(c, f"__{c}").alias(c) for c in attributes), "Identifier")


def visited_order(found: DataFrame, seed: str, wallet: str = "wallet") -> DataFrame:
    """(wallet, cluster_id from 1): clusters numbered as a walk from seeds in the order of `seed` would meet them."""
    first = found.groupBy("component").agg(F.min(seed).alias("__first"))
    ids = dictionary(first.withColumn("__key", F.struct("__first", "component")), "__key", "n")
    return found.join(ids.select("__key.component", (F.col("n") + 1).alias("cluster_id")), "component").select(wallet, "cluster_id")
