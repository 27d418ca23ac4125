"""Pairs of users and goods in two factors, so that no exchange ever carries a pair.

Goods that stand in the same categories (equally often) reach the same users and are one class.
What users reach is told apart by class, where repeats meet; the goods of a class come in last, by
a join behind which every pair stands once. So shuffles and files grow with users x classes and
with the goods, and only the rows that a caller reads grow with the pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from shelfwise.session import staged

#: Class of the null goods; ids of other classes are not negative.
NO_GOODS = -1


def goods_classes(listed: DataFrame, count: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Goods of (category, goods_id) rows by the set of their categories: (category, class) and (class, goods_id).

    With ``count`` goods are of one class if they agree in that column, too, and it comes with the first
    frame. Rows are distinct. Goods that are null have a class as all others.
    """
    own = ["category"] if count is None else ["category", count]
    sets = listed.groupBy("goods_id").agg(F.array_sort(F.collect_set(F.struct(*own))).alias("_in"))
    known = staged(sets.select("_in").distinct().withColumn("class", F.monotonically_increasing_id()), "classes")
    members = staged(sets.join(known, "_in").select("class", "goods_id"), "class-goods")
    return known.select("class", F.inline("_in")), members


@dataclass(frozen=True)
class ClassedPairs:
    """Distinct pairs of user and goods: those of ``users`` (user_id, class) and ``members`` (class, goods_id),
    and those of ``single`` (user_id, goods_id), which are none of the others. Whatever more is known of
    the goods stands in ``members`` and ``single``.
    """
    users: DataFrame
    members: DataFrame
    single: DataFrame

    def rows(self) -> DataFrame:
        """All pairs; nothing is exchanged behind the join."""
        found = self.users.join(self.members, "class").drop("class")
        return found.unionByName(self.single)

    def with_goods(self, facts: DataFrame) -> ClassedPairs:
        """The pairs whose goods have a row in ``facts``, with its columns."""
        return ClassedPairs(self.users, staged(self.members.join(facts, "goods_id"), "class-goods"),
                            staged(self.single.join(facts, "goods_id"), "single-goods"))

    def goods(self) -> DataFrame:
        return self.members.select("goods_id").unionByName(self.single.select("goods_id")).distinct()

    def owners(self) -> DataFrame:
        """Users who have a pair."""
        filled = self.members.select("class").distinct()
        return self.users.join(filled, "class", "left_semi").select("user_id").unionByName(
            self.single.select("user_id")).distinct()

    def per_user(self, **sums) -> DataFrame:
        """The number of goods (n_goods) and sums of whole numbers that depend on the goods, from sums per class."""
        facts = [F.count(F.lit(1)).alias("n_goods"), *[F.sum(value).alias(name) for name, value in sums.items()]]
        per_class = self.users.join(self.members.groupBy("class").agg(*facts), "class").drop("class")
        alone = self.single.groupBy("user_id").agg(*facts)
        return per_class.unionByName(alone).groupBy("user_id").agg(
            *[F.sum(name).alias(name) for name in ("n_goods", *sums)])
