"""Candidate goods from what a user follows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise import settings as S
from shelfwise.functions.arrays import typed_id
from shelfwise.operators.classes import NO_GOODS, ClassedPairs, goods_classes
from shelfwise.operators.groups import dense_ranks, null_safe_join
from shelfwise.operators.tag_batches import carriers, tag_matches
from shelfwise.session import small_enough, staged

#: Rows of goods and tag of one day that may be sent to every task.
DAY_TAG_ROWS = 2_000_000


def followed(focus: DataFrame, kind: str, name: str, like: DataFrame | None = None) -> DataFrame:
    """Followed values of one kind, in the id type that ``name`` has in ``like``."""
    value = F.col("value") if like is None else typed_id("value", like.schema[name].dataType)
    return focus.filter(F.col("type") == kind).select("user_id", value.alias(name))


@dataclass(frozen=True)
class ShopGoods:
    """``shop_follow_goods`` by its two sides."""
    focus: DataFrame
    goods_static: DataFrame

    def followed(self) -> DataFrame:
        return followed(self.focus, S.FOCUS_SHOP, "shop_id", self.goods_static)

    def rows(self) -> DataFrame:
        return self.goods_static.select("shop_id", "goods_id").join(self.followed(), "shop_id").select("user_id", "goods_id")


def shop_follow_goods(focus: DataFrame, goods_static: DataFrame) -> DataFrame:
    """All goods of the followed shops; a pair may repeat."""
    return ShopGoods(focus, goods_static).rows()


def listed_goods(category_top: DataFrame) -> DataFrame:
    return category_top.filter(F.col("category").isNotNull()).select("goods_id", "category").distinct()


def _reached(own: DataFrame, category_top: DataFrame, how: str) -> tuple[DataFrame, DataFrame]:
    """Classes that users reach over their categories, and the goods of the classes. With ``how`` "left" a
    category without goods reaches the null goods, which has a class of its own so that a user has it once."""
    listed = listed_goods(category_top)
    known = F.col("goods_id").isNotNull()
    classes, members = goods_classes(listed.filter(known))
    null_goods = listed.filter(~known).select(F.lit(NO_GOODS).cast("bigint").alias("class"), "category")
    found = own.join(classes.select("class", "category").unionByName(null_goods), "category", how).select(
        "user_id", F.coalesce("class", F.lit(NO_GOODS).cast("bigint")).alias("class")).distinct()
    return found, members


def _with_null_goods(users: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs of users and goods, those of the null goods beside the join."""
    none = users.filter(F.col("class") == NO_GOODS).select(
        "user_id", F.lit(None).cast(members.schema["goods_id"].dataType).alias("goods_id"))
    return users.join(members, "class").select("user_id", "goods_id").unionByName(none)


@dataclass(frozen=True)
class ReachedGoods:
    """Top goods of categories (user_id, category), distinct pairs, by the two sides. With ``how`` "left" a category
    without goods reaches the null goods."""
    own: DataFrame
    category_top: DataFrame
    how: str

    def rows(self) -> DataFrame:
        return _with_null_goods(*_reached(self.own, self.category_top, self.how))


def by_category(focus: DataFrame, category_top: DataFrame) -> ReachedGoods:
    """The two sides of ``category_follow_goods``."""
    return ReachedGoods(followed(focus, S.FOCUS_CATEGORY, "category"), category_top, "inner")


def by_goods(top_categories: DataFrame, category_top: DataFrame) -> ReachedGoods:
    """The two sides of ``goods_follow_goods``."""
    return ReachedGoods(top_categories.select("user_id", "category"), category_top, "left")


def category_follow_goods(focus: DataFrame, category_top: DataFrame) -> DataFrame:
    """Top goods of the followed categories, distinct pairs."""
    return by_category(focus, category_top).rows()


def followed_goods(focus: DataFrame, goods_static: DataFrame, category_top: DataFrame) -> ClassedPairs:
    """Followed goods and top goods of the followed categories, without null goods."""
    users, members = _reached(followed(focus, S.FOCUS_CATEGORY, "category"), category_top, "inner")
    users = staged(users.filter(F.col("class") != NO_GOODS), "user-classes")
    own = followed(focus, S.FOCUS_GOODS, "goods_id", goods_static).filter(F.col("goods_id").isNotNull()).distinct()
    placed = own.join(members, "goods_id", "left")
    alone = null_safe_join(placed, users, ["user_id", "class"], "left_anti").select("user_id", "goods_id")
    return ClassedPairs(users, members, staged(alone, "single-goods"))


def goods_follow_categories(focus: DataFrame, goods_category: DataFrame) -> DataFrame:
    """Categories of the followed goods, one row per followed goods and category.

    Users appear for every other followed value too, with a null category. Those rows
    take no part in the join, so only followed goods are shuffled for it.
    """
    goods = followed(focus, S.FOCUS_GOODS, "goods_id", goods_category)
    matched = goods.join(goods_category.select("goods_id", "category"), "goods_id", "left")
    others = focus.filter(~F.col("type").eqNullSafe(F.lit(S.FOCUS_GOODS)))
    return matched.select("user_id", "category").unionByName(
        others.select("user_id", F.lit(None).cast("string").alias("category")))


def category_follow_count(focus: DataFrame, goods_category: DataFrame) -> DataFrame:
    """Followed goods per user and category; the null category counts none."""
    return goods_follow_categories(focus, goods_category).groupBy("user_id", "category").agg(
        F.count("category").alias("n_goods"))


def user_top_categories(focus: DataFrame, goods_category: DataFrame, k: int = S.USER_CATEGORY_RANKS,
                        distinct_first: bool = False) -> DataFrame:
    """Categories with the k highest counts per user.

    ``distinct_first`` makes every category count once, so that all share rank 1.
    """
    counts = category_follow_count(focus, goods_category)
    if distinct_first:
        return counts.select("user_id", "category", F.lit(1).alias("rank"))
    return dense_ranks(counts, ["user_id"], "n_goods", "rank", k).select("user_id", "category", "rank")


def goods_follow_goods(top_categories: DataFrame, category_top: DataFrame) -> DataFrame:
    """Top goods of a user's own categories, distinct; a user without any has a null goods."""
    return by_goods(top_categories, category_top).rows()


@dataclass(frozen=True)
class TagOverlap:
    """Followed tags (user_id, tag, n), the goods of one day (goods_id, tag, rows), and how many tags a pair must share."""
    tags: DataFrame
    carried: DataFrame
    min_tags: int
    few: bool

    def rows(self) -> DataFrame:
        """user_id, goods_id, support_by_tag. A day of few goods is sent to the users, whose pairs then need no exchange;
        otherwise tags are joined first and counted by (user, goods) afterwards, with partial sums: nothing is dealt
        out by user, and Spark splits tags or pairs that are hot."""
        if self.few:
            return tag_matches(self.tags, self._goods(), [], ["goods_id"], "support_by_tag", self.min_tags, rest=True)
        counted = self.tags.join(self.carried, "tag").groupBy("user_id", "goods_id").agg(
            F.sum(F.col("n") * F.col("rows")).alias("support_by_tag"))
        unmet = (self.tags.join(self.carried.select("tag").distinct(), "tag", "left_anti").groupBy("user_id")
                 .agg(F.sum("n").alias("support_by_tag"))
                 .withColumn("goods_id", F.lit(None).cast(self.carried.schema["goods_id"].dataType)))
        return counted.unionByName(unmet).filter(F.col("support_by_tag") >= self.min_tags)

    def tops(self, sale: DataFrame, k: int) -> DataFrame:
        """``tag_goods_top``; ranks of few goods are taken where their pairs are found."""
        if not self.few:
            return tag_goods_top(self.rows(), sale, k)
        priced = self._goods().join(sale.select("goods_id", "sale", "prediction"), "goods_id", "left")
        return tag_matches(self.tags, priced, [], ["goods_id"], "support_by_tag", self.min_tags, rest=True,
                           tops={"rank_sale": "sale", "rank_prediction": "prediction"}, k=k)

    def _goods(self) -> DataFrame:
        return carriers(self.carried, ["goods_id"], "rows")


def followed_overlap(focus: DataFrame, day: DataFrame, min_tags: int = S.MIN_SHARED_TAGS,
                     max_rows: int = DAY_TAG_ROWS) -> TagOverlap:
    """The two sides of ``tag_overlap``. A goods row counts a tag once."""
    tags = followed(focus, S.FOCUS_TAG, "tag").groupBy("user_id", "tag").agg(F.count(F.lit(1)).alias("n"))
    carried = staged(day.select("goods_id", F.explode(F.array_distinct("tags")).alias("tag")).groupBy(
        "goods_id", "tag").agg(F.count(F.lit(1)).alias("rows")), "carried-tags")
    return TagOverlap(tags, carried, min_tags, small_enough(carried, max_rows))


def tag_overlap(focus: DataFrame, day: DataFrame, min_tags: int = S.MIN_SHARED_TAGS) -> DataFrame:
    """Goods of one day that carry at least ``min_tags`` followed tags of a user.

    A goods row counts a tag once. Followed tags that no goods carries count for a null goods.
    """
    return followed_overlap(focus, day, min_tags).rows()


def tag_goods_top(overlap: DataFrame | TagOverlap, sale: DataFrame, k: int = S.TAG_RANKS) -> DataFrame:
    """Overlap goods that rank within k by sale or by forecast for the user."""
    if isinstance(overlap, TagOverlap):
        return overlap.tops(sale, k)
    priced = overlap.join(sale.select("goods_id", "sale", "prediction"), "goods_id", "left")
    ranked = dense_ranks(priced, ["user_id"], "sale", "rank_sale")
    ranked = dense_ranks(ranked, ["user_id"], "prediction", "rank_prediction")
    kept = (F.col("rank_sale") <= k) | (F.col("rank_prediction") <= k)
    return ranked.filter(kept).select("user_id", "goods_id", "support_by_tag", "rank_sale", "rank_prediction")


@dataclass(frozen=True)
class TagTops:
    """``tag_goods_top`` by its sides."""
    focus: DataFrame
    overlap: TagOverlap
    sale: DataFrame
    k: int = S.TAG_RANKS

    def rows(self) -> DataFrame:
        return tag_goods_top(self.overlap, self.sale, self.k)

    def goods(self) -> DataFrame:
        """goods_id, entries, at (a number from 0) and the ranks among all goods of a day that was checked to be small.
        The last is the null goods for which tags that no goods carries count."""
        priced = carriers(self.overlap.carried, ["goods_id"], "rows").join(
            self.sale.select("goods_id", "sale", "prediction"), "goods_id", "left")
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in priced.schema]
        both = priced.withColumn("_rest", F.lit(False)).unionByName(
            priced.sparkSession.range(1).select(*rest, F.lit(True).alias("_rest")))
        levels = [F.dense_rank().over(Window.orderBy(F.col(c).desc_nulls_last())).alias(f"rank_{c}") for c in ("sale", "prediction")]
        at = F.row_number().over(Window.orderBy("_rest", "goods_id")) - 1
        return staged(both.select("goods_id", "entries", at.alias("at"), *levels), "tagged-goods")
