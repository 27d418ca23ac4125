"""What a user is about: tags with frequencies, and goods."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import settings as S
from shelfwise.operators.classes import ClassedPairs
from shelfwise.operators.follow import followed
from shelfwise.operators.groups import block_list, first_rows, in_blocks
from shelfwise.operators.sales import known_amount
from shelfwise.operators.user_lists import FIRST, GROUP, LIST_ROWS, SECOND, Numbered, grouped, numbered_values, user_blocks
from shelfwise.session import small_enough, staged


def shop_hot_input(goods_static: DataFrame, day: DataFrame) -> DataFrame:
    """Every goods of every shop with its tags and amount of one day, where known."""
    return goods_static.select("goods_id", "shop_id").join(
        known_amount(day).select("goods_id", "tags", "amount"), "goods_id", "left")


def shop_hot_goods(goods_static: DataFrame, day: DataFrame, n: int = S.SHOP_TOP) -> DataFrame:
    """The n goods with the highest amount per shop; unknown amounts come last."""
    order = [F.col("amount").desc_nulls_last(), F.col("goods_id")]
    return first_rows(shop_hot_input(goods_static, day), ["shop_id"], order, n).select(
        "shop_id", "goods_id", "tags")


def user_tags(focus: DataFrame) -> DataFrame:
    return followed(focus, S.FOCUS_TAG, "tag")


def user_goods_tags(focus: DataFrame, day: DataFrame) -> DataFrame:
    """Followed goods with each of their tags of one day; null tag when there are none."""
    goods = followed(focus, S.FOCUS_GOODS, "goods_id", day)
    tags = day.select("goods_id", F.explode("tags").alias("tag"))
    return goods.join(tags, "goods_id", "left").select("user_id", "goods_id", "tag")


def user_shop_tags(focus: DataFrame, shop_hot: DataFrame) -> DataFrame:
    """Followed shops with each tag of their hot goods; null tag when there are none."""
    shops = followed(focus, S.FOCUS_SHOP, "shop_id", shop_hot)
    tags = shop_hot.select("shop_id", F.explode("tags").alias("tag"))
    return shops.join(tags, "shop_id", "left").select("user_id", "tag")


def tag_sources(tags: DataFrame, goods_tags: DataFrame, shop_tags: DataFrame) -> DataFrame:
    """The three tag sources under each other, repeats kept."""
    return (tags.select("user_id", "tag").unionByName(goods_tags.select("user_id", "tag"))
            .unionByName(shop_tags.select("user_id", "tag")))


def user_tag_frequency(tags: DataFrame, goods_tags: DataFrame, shop_tags: DataFrame) -> DataFrame:
    """How often each tag occurs for a user; one row per user and tag, never a map."""
    return (tag_sources(tags, goods_tags, shop_tags).filter(F.col("tag").isNotNull())
            .groupBy("user_id", "tag").agg(F.count(F.lit(1)).alias("n")))


def user_tag_list(tags: DataFrame, block: int = S.LIST_BLOCK) -> DataFrame:
    """Tags per user with repeats in blocks of ``block`` values, nulls skipped; a user of null tags has an empty block 0.

    Repeats are counted before the exchange and written out again inside the blocks.
    """
    counted = tags.groupBy("user_id", "tag").agg(F.count("tag").alias("copies"))
    dealt = in_blocks(counted, ["user_id"], ["tag"], block)
    return dealt.groupBy("user_id", "block").agg(block_list("tag").alias("tags"))


def user_goods(pairs: DataFrame | ClassedPairs) -> DataFrame:
    """Distinct goods per user; one row per user and goods."""
    if isinstance(pairs, ClassedPairs):
        return pairs.rows().filter(F.col("goods_id").isNotNull()).select("user_id", "goods_id")
    return pairs.filter(F.col("goods_id").isNotNull()).select("user_id", "goods_id").distinct()


def _places_in(pairs: ClassedPairs, max_rows: int) -> tuple[DataFrame, Numbered, tuple] | None:
    """What users have as rows of kind and number, and the goods behind the numbers; none if these are too many."""
    goods = numbered_values(pairs.goods(), max_rows)
    if goods is None or not small_enough(pairs.members, max_rows):
        return None
    classes = numbered_values(pairs.members.select("class"), max_rows)
    rows = classes.coded(pairs.users, "class", GROUP).unionByName(goods.coded(pairs.single, "goods_id", FIRST))
    return rows, goods, grouped(classes, pairs.members.select("class", "goods_id"), goods)


def user_goods_set(pairs: DataFrame | ClassedPairs, block: int = S.LIST_BLOCK, max_rows: int = LIST_ROWS) -> DataFrame:
    """Distinct goods per user, in order, in blocks. Pairs in factors stay apart if their goods are few, so that none is
    exchanged; others are dealt out by ranges."""
    placed = _places_in(pairs, max_rows) if isinstance(pairs, ClassedPairs) else None
    if placed is not None:
        rows, goods, in_class = placed
        return user_blocks(rows, block, goods, in_class).select("user_id", "block", F.col("first").alias("goods"))
    dealt = in_blocks(user_goods(pairs).withColumn("copies", F.lit(1)), ["user_id"], ["goods_id"], block)
    return dealt.groupBy("user_id", "block").agg(block_list("goods_id").alias("goods"))


def history_list(recent: DataFrame, block: int = S.LIST_BLOCK) -> DataFrame:
    """Recently shown goods per user, repeats kept, in blocks."""
    rows = recent.withColumnRenamed("goods_id", "tag")
    return user_tag_list(rows, block).withColumnRenamed("tags", "goods")


def user_profile(frequency: DataFrame, pairs: DataFrame | ClassedPairs, block: int = S.LIST_BLOCK,
                 max_rows: int = LIST_ROWS) -> DataFrame:
    """Tag frequencies and goods of every user that has either; block k holds the k-th block of both."""
    if isinstance(pairs, ClassedPairs):
        frequency = staged(frequency, "frequency")
        placed, tags = _places_in(pairs, max_rows), numbered_values(frequency.select("tag"), max_rows)
        if placed is not None and tags is not None:
            rows, goods, in_class = placed
            known = rows.unionByName(tags.coded(frequency, "tag", SECOND, "n"))
            return user_blocks(known, block, goods, in_class, tags).select(
                "user_id", "block", F.map_from_entries("second").alias("tags"), F.col("first").alias("goods"))
    dealt = in_blocks(frequency.withColumn("copies", F.lit(1)), ["user_id"], ["tag"], block)
    tags = dealt.groupBy("user_id", "block").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("tag", "n")))).alias("tags"))
    return tags.join(user_goods_set(pairs, block), ["user_id", "block"], "full")
