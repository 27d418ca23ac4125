"""Recommendations from follow rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfwise import settings as S
from shelfwise.functions.dates import pt_text
from shelfwise.operators import follow, rules, sales
from shelfwise.operators.catalog import category_explode
from shelfwise.session import prepared, staged
from shelfwise.sources.partitions import PartitionedTable, day_to_run, read_partitions
from shelfwise.sources.tables import save_partition_table


@dataclass(frozen=True)
class RuleInputs:
    """Source frames; ``goods_dynamic``, ``forecast`` and ``recommend`` are partitioned by ``pt``. As a
    ``PartitionedTable`` the first two tell their latest day without a scan."""

    focus: DataFrame
    goods_static: DataFrame
    goods_dynamic: DataFrame | PartitionedTable
    forecast: DataFrame | PartitionedTable
    potential: DataFrame
    recommend: DataFrame


def rule_sources(inputs: RuleInputs, as_of: str, sale: DataFrame, min_tags: int = S.MIN_SHARED_TAGS,
                 distinct_first: bool = False) -> tuple[rules.Source, ...]:
    """Goods by followed goods, shops, categories and tags, each by its two sides, and what was shown lately.

    The category tops are read more than once, so they are written once.
    """
    listed = category_explode(inputs.goods_static)
    top = staged(sales.category_top(sale, listed, inputs.goods_static, as_of), "category-top")
    own = follow.user_top_categories(inputs.focus, listed, distinct_first=distinct_first)
    day = read_partitions(inputs.goods_dynamic, pt_text(as_of, dashed=True))
    overlap = follow.followed_overlap(inputs.focus, day, min_tags)
    return (
        follow.by_goods(own, top),
        follow.ShopGoods(inputs.focus, inputs.goods_static),
        follow.by_category(inputs.focus, top),
        follow.TagTops(inputs.focus, overlap, sale),
        rules.recent_pairs(inputs.recommend, as_of),
    )


def rule_sale(inputs: RuleInputs, as_of: str, days: int = S.SALE_DAYS) -> DataFrame:
    """Sale and forecast per goods, written once for all its readers."""
    prepared(inputs.focus.sparkSession)
    return staged(sales.sale_with_forecast(
        sales.sale_window(inputs.goods_dynamic, as_of, days), inputs.forecast), "sale")


def rule_candidates(inputs: RuleInputs, as_of: str, sale: DataFrame, min_tags: int = S.MIN_SHARED_TAGS,
                    distinct_first: bool = False) -> DataFrame | rules.Pairs:
    support = rules.support_counts(*rule_sources(inputs, as_of, sale, min_tags, distinct_first))
    return rules.candidates(support, sales.newuser_pool(sale, inputs.goods_static, as_of))


def rule_priorities(inputs: RuleInputs, as_of: str, days: int = S.SALE_DAYS,
                    min_tags: int = S.MIN_SHARED_TAGS, distinct_first: bool = False) -> DataFrame | rules.Pairs:
    """Priorities of all candidates, written once because three lists read them; of ``Pairs`` the goods rows are written."""
    sale = rule_sale(inputs, as_of, days)
    found = rule_candidates(inputs, as_of, sale, min_tags, distinct_first)
    ranked = rules.candidate_priorities(found, inputs.goods_static, inputs.potential, sale, as_of)
    return ranked.stored() if isinstance(ranked, rules.Pairs) else staged(ranked, "priorities")


def listable_pairs(inputs: RuleInputs, as_of: str, sale: DataFrame, min_tags: int = S.MIN_SHARED_TAGS,
                   distinct_first: bool = False, min_hot: float = S.MIN_HOT,
                   max_rows: int = rules.GOODS_ROWS) -> DataFrame | rules.Pairs:
    """Priorities of the candidates that a list can hold, by goods reduced before they meet users.

    Both lists ask for fresh goods with a hot priority above ``min_hot``, which depends on the
    goods alone. Ranks among goods are taken first, so no rank shifts. Users and goods stay apart if
    the goods are few (``rules.support_counts``), so that no pair is exchanged or stored.
    """
    usable = staged(rules.fresh_with_flag(inputs.goods_static, inputs.potential, as_of).join(
        sale.filter(F.col("sale") > min_hot).select("goods_id", "sale", "prediction"), "goods_id"), "usable-goods")
    ids = usable.select("goods_id")
    listed = category_explode(inputs.goods_static)
    top = staged(sales.category_top(sale, listed, inputs.goods_static, as_of).join(ids, "goods_id", "left_semi"), "category-top")
    own = follow.user_top_categories(inputs.focus, listed, distinct_first=distinct_first)
    day = read_partitions(inputs.goods_dynamic, pt_text(as_of, dashed=True))
    overlap = follow.followed_overlap(inputs.focus, day, min_tags)
    shops = inputs.goods_static.join(ids, "goods_id", "left_semi")
    newuser = sales.newuser_pool(sale, inputs.goods_static, as_of).select("user_id", "goods_id")
    shown = rules.recent_pairs(inputs.recommend, as_of)
    # Goods that no list can hold need not be known as shown; a null user was shown nothing, since null equals none.
    met = shown.filter(F.col("user_id").isNotNull()).join(ids, "goods_id", "left_semi").select("user_id", "goods_id")
    support = rules.gathered_support(follow.by_goods(own, top), follow.ShopGoods(inputs.focus, shops),
                                     follow.by_category(inputs.focus, top), follow.TagTops(inputs.focus, overlap, sale), met, max_rows)
    if support is not None:
        found = rules.candidates(support, newuser.withColumn("total_support", F.lit(1)))
        return found.each(lambda rows: rules.scored(rows.join(usable, "goods_id"))).stored()
    sources = (
        follow.goods_follow_goods(own, top),
        follow.shop_follow_goods(inputs.focus, shops),
        follow.category_follow_goods(inputs.focus, top),
        follow.tag_goods_top(overlap, sale).join(ids, "goods_id", "left_semi"),
    )
    pairs = reduce(DataFrame.unionByName, [p.select("user_id", "goods_id") for p in sources]).filter(
        F.col("goods_id").isNotNull()).distinct()
    found = pairs.join(shown.distinct(), ["user_id", "goods_id"], "left_anti").unionByName(newuser)
    return staged(rules.scored(found.withColumn("total_support", F.lit(1)).join(usable, "goods_id")), "priorities")


def rules_recommend(inputs: RuleInputs, as_of: str, days: int = S.SALE_DAYS,
                    min_tags: int = S.MIN_SHARED_TAGS, k: int = S.LIST_LENGTH,
                    distinct_first: bool = False, dedupe_fallback: bool = False) -> DataFrame:
    """Hot and potential list of every user, each with exactly k slots."""
    sale = rule_sale(inputs, as_of, days)
    hot, potential = rules.both_lists(listable_pairs(inputs, as_of, sale, min_tags, distinct_first), k)
    return rules.newuser_fallback(rules.result_lists(hot, potential, k), k, dedupe_fallback)


def run_rules(inputs: RuleInputs, as_of: str | None, table: str, **options) -> bool:
    """Compute the day's lists and write them as the day's partition of ``table``.

    ``as_of=None`` takes the latest day of the products; a day they lack is refused. The result is staged first: it may depend on earlier partitions of the same table.
    """
    as_of = day_to_run(inputs.goods_dynamic, as_of)
    result = staged(rules_recommend(inputs, as_of, **options), "recommend")
    return save_partition_table(result, table, pt_text(as_of))
