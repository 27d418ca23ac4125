"""Evidence counting, freshness, priorities and the hot and potential lists."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from shelfwise import settings as S
from shelfwise.functions.arrays import append_missing, fill_slots
from shelfwise.functions.dates import on_sale_less_than, pt_text
from shelfwise.operators.evidence import GOODS_ROWS, Evidence, PairMark, gathered
from shelfwise.operators.follow import ReachedGoods, ShopGoods, TagTops
from shelfwise.operators.groups import dense_ranks, first_rows, lists_of
from shelfwise.session import staged

EVIDENCE = ["goods", "shop", "category", "tag", "history"]

Source = DataFrame | ReachedGoods | ShopGoods | TagTops


@dataclass(frozen=True)
class Support:
    """``support_counts`` by users and by goods, which meet where rows are asked for."""
    evidence: Evidence

    def rows(self) -> DataFrame:
        return self.evidence.counts()

    def sums(self, mark: PairMark) -> DataFrame:
        """The number of pairs and the sum of their marks by user and counts; pairs are made, but not handed on."""
        return self.evidence.count_sums(mark)


@dataclass(frozen=True)
class Pairs:
    """Candidates, and what is computed from them, by users and by goods: a user's candidates come with all their rows
    in ``goods``. The few users of the new-user pool stand in ``others`` as pairs, with the same columns."""
    evidence: Evidence
    goods: DataFrame
    others: DataFrame
    without: Best | None = None

    def rows(self) -> DataFrame:
        return self.evidence.pairs(self.goods, self.without and self.without.goods()).unionByName(self.others)

    def sums(self, mark: PairMark, group: Sequence[str] = (), totals: Sequence[str] = ()) -> DataFrame:
        """The number of pairs, the sum of their marks and sums of other columns by user and columns of the goods; pairs
        are made, but not handed on."""
        own = self.evidence.sums(self.goods, mark, group, totals, self.without and self.without.goods())
        if own is None:
            return summed(self.rows(), mark, group, totals)
        return own.unionByName(summed(self.others, mark, group, totals))

    def each(self, change: Callable[[DataFrame], DataFrame]) -> Pairs:
        """A change that goes by the goods alone."""
        return replace(self, goods=change(self.goods), others=change(self.others))

    def stored(self) -> Pairs:
        return replace(self, goods=staged(self.goods, "goods-rows"), others=staged(self.others, "few-users"))

    def best(self, by: str, k: int) -> DataFrame:
        """user_id, goods_id, rank of the k best values of a user; all ties stay."""
        found = self.evidence.best(self.goods, by, k, self.without and self.without.goods())
        return found.unionByName(dense_ranks(self.others, ["user_id"], by, "rank", k).select("user_id", "goods_id", "rank"))


@dataclass(frozen=True)
class Best:
    """The pairs within the k best values of a user."""
    pairs: Pairs
    by: str
    k: int
    null_safe: bool = False  #: null is a user like all others

    def rows(self) -> DataFrame:
        return self.pairs.best(self.by, self.k).select("user_id", "goods_id")

    def goods(self) -> tuple[DataFrame, str, int, bool]:
        return self.pairs.goods, self.by, self.k, self.null_safe

    def of_others(self) -> DataFrame:
        return _ranked(self.pairs.others, self.by, self.k).select("user_id", "goods_id")


def summed(rows: DataFrame, mark: PairMark, group: Sequence[str] = (), totals: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy("user_id", *group).agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sum(mark.value).alias("pair_marks"), *[F.sum(c).alias(c) for c in totals])


def sums_of(pairs: DataFrame | Support | Pairs | Best, mark: PairMark, group: Sequence[str] = (),
            totals: Sequence[str] = ()) -> DataFrame:
    """The sums of ``Pairs.sums`` of any form of pairs. ``group`` of a ``Support`` are its counts."""
    if isinstance(pairs, Pairs):
        return pairs.sums(mark, group, totals)
    return pairs.sums(mark) if isinstance(pairs, Support) else summed(rows_of(pairs), mark, group, totals)


def rows_of(pairs: Source | Support | Pairs | Best) -> DataFrame:
    return pairs if isinstance(pairs, DataFrame) else pairs.rows()


def _keys(rows: DataFrame) -> list[str]:
    """The key columns: goods rows by themselves have no user."""
    return [c for c in ("user_id", "goods_id") if c in rows.columns]


def recent_pairs(recommend: DataFrame, as_of: str, days: int = S.REPEAT_FREE_DAYS,
                 kind: str | None = None) -> DataFrame:
    """(user, goods) shown in the ``days`` days before ``as_of``, of one kind or of any."""
    window = (F.col("pt") >= pt_text(as_of, -days)) & (F.col("pt") < pt_text(as_of))
    shown = recommend.filter(window)
    if kind is not None:
        shown = shown.filter(F.col("type") == kind)
    return shown.select("user_id", F.explode("values").alias("goods_id"))


def labelled_evidence(by_goods: Source, by_shop: Source, by_category: Source,
                      by_tag: Source, history: DataFrame) -> DataFrame:
    """All sources under each other, with a 1 in the column of their own source."""
    parts = []
    for own, source in zip(EVIDENCE, (by_goods, by_shop, by_category, by_tag, history)):
        flags = [F.lit(int(name == own)).alias(f"support_by_{name}") for name in EVIDENCE]
        parts.append(rows_of(source).select("user_id", "goods_id", *flags))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def support_counts(by_goods: Source, by_shop: Source, by_category: Source, by_tag: Source, history: DataFrame,
                   max_rows: int = GOODS_ROWS) -> DataFrame | Support:
    """Evidence per (user, goods). Sources that are all given by their sides stay apart if their goods are few, so that
    no pair is exchanged; otherwise partial sums are taken before the exchange."""
    support = gathered_support(by_goods, by_shop, by_category, by_tag, history, max_rows)
    if support is not None:
        return support
    rows = labelled_evidence(by_goods, by_shop, by_category, by_tag, history)
    return rows.groupBy("user_id", "goods_id").agg(
        *[F.sum(f"support_by_{name}").alias(f"total_support_{name}") for name in EVIDENCE])


def gathered_support(by_goods: Source, by_shop: Source, by_category: Source, by_tag: Source, history: DataFrame,
                     max_rows: int = GOODS_ROWS) -> Support | None:
    """Evidence that stays by users and by goods; none if a source is not given by its sides or the goods are too many."""
    if any(isinstance(s, DataFrame) for s in (by_goods, by_shop, by_category, by_tag)):
        return None
    evidence = gathered(by_goods, by_shop, by_category, by_tag, history, max_rows)
    return None if evidence is None else Support(evidence)


def candidates(support: DataFrame | Support, newuser: DataFrame) -> DataFrame | Pairs:
    """Supported pairs that were not shown lately, and the new-user pool unfiltered."""
    if isinstance(support, Support):
        newuser = staged(newuser.select("user_id", "goods_id", "total_support"), "newuser")
        users = newuser.select("user_id").distinct()
        goods = support.evidence.places.select("goods_id", F.lit(1).alias("total_support"))
        own = support.evidence.of_users(users, "left_semi").pairs(goods)
        return Pairs(support.evidence.of_users(users, "left_anti"), goods, own.unionByName(newuser))
    supported = sum((F.col(f"total_support_{name}") for name in EVIDENCE[:-1]), F.lit(0)) >= 1
    kept = support.filter(supported & (F.col("total_support_history") == 0))
    return kept.select("user_id", "goods_id", F.lit(1).alias("total_support")).unionByName(
        newuser.select("user_id", "goods_id", "total_support"))


def fresh_with_flag(goods_static: DataFrame, potential: DataFrame, as_of: str,
                    days: int = S.FRESH_DAYS) -> DataFrame:
    """Fresh goods with a 0/1 mark for being potential goods, one row per goods."""
    marks = potential.select("goods_id").distinct().withColumn("support_by_potentialhot", F.lit(1))
    fresh = goods_static.filter(on_sale_less_than(as_of, days)).select("goods_id")
    return fresh.join(marks, "goods_id", "left").select(
        "goods_id", F.coalesce("support_by_potentialhot", F.lit(0)).alias("support_by_potentialhot"))


def fresh_candidates(candidates: DataFrame | Pairs, goods_static: DataFrame, potential: DataFrame,
                     as_of: str, days: int = S.FRESH_DAYS) -> DataFrame | Pairs:
    fresh = fresh_with_flag(goods_static, potential, as_of, days)
    return _each(candidates, lambda rows: rows.join(fresh, "goods_id").select(
        *_keys(rows), "total_support", "support_by_potentialhot"))


def _each(pairs: DataFrame | Pairs, change: Callable[[DataFrame], DataFrame]) -> DataFrame | Pairs:
    return pairs.each(change) if isinstance(pairs, Pairs) else change(pairs)


def scored(rows: DataFrame) -> DataFrame:
    """Priorities from support, potential mark, sale and forecast."""
    supported = F.col("total_support") == 1
    promising = supported & (F.col("support_by_potentialhot") > 0)
    return rows.select(
        *_keys(rows),
        F.when(supported, F.col("sale")).otherwise(0).alias("priority_hot"),
        F.when(promising, F.col("prediction") + S.POTENTIAL_BONUS).otherwise(0).alias("priority_potential"),
        "sale", "prediction",
    ).distinct()


def priorities(fresh: DataFrame | Pairs, sale: DataFrame) -> DataFrame | Pairs:
    """Hot and potential priority per pair; null where sale or forecast is missing."""
    known = sale.select("goods_id", "sale", "prediction")
    return _each(fresh, lambda rows: scored(rows.join(known, "goods_id", "left")))


def candidate_priorities(candidates: DataFrame | Pairs, goods_static: DataFrame, potential: DataFrame,
                         sale: DataFrame, as_of: str, days: int = S.FRESH_DAYS) -> DataFrame | Pairs:
    """Freshness and priorities in one pass over the candidates.

    Everything known of a goods is joined first, goods by goods, so the large candidate
    side meets a single join, which Spark can split where one goods is very popular.
    """
    goods = fresh_with_flag(goods_static, potential, as_of, days).join(
        sale.select("goods_id", "sale", "prediction"), "goods_id", "left")
    return _each(candidates, lambda rows: scored(rows.join(goods, "goods_id")))


def _ranked(priorities: DataFrame | Pairs, by: str, k: int) -> DataFrame:
    if isinstance(priorities, Pairs):
        return priorities.best(by, k)
    return dense_ranks(priorities, ["user_id"], by, "rank", k).select("user_id", "goods_id", "rank")


def hot_list(priorities: DataFrame | Pairs, k: int = S.LIST_LENGTH, min_hot: float = S.MIN_HOT) -> DataFrame:
    """Goods within the k best hot priorities of a user; all ties stay."""
    return _ranked(_each(priorities, lambda rows: rows.filter(F.col("priority_hot") > min_hot)), "priority_hot", k)


def hot_to_delete(priorities: DataFrame | Pairs, k: int = S.LIST_LENGTH) -> DataFrame | Best:
    """The same ranks without the lower limit, for the potential list to leave out."""
    if isinstance(priorities, Pairs):
        return Best(priorities, "priority_hot", k)
    return _ranked(priorities, "priority_hot", k).select("user_id", "goods_id")


def minus_hot(priorities: DataFrame | Pairs, to_delete: DataFrame | Best,
              min_potential: float = S.MIN_POTENTIAL) -> DataFrame | Pairs:
    rest = _each(priorities, lambda rows: rows.filter(F.col("priority_potential") >= min_potential))
    keys = ["user_id", "goods_id"]
    if isinstance(rest, Pairs) and isinstance(to_delete, Best) and to_delete.pairs.evidence is rest.evidence:
        return replace(rest, others=rest.others.join(to_delete.of_others(), keys, "left_anti"), without=to_delete)
    return rows_of(rest).join(rows_of(to_delete), keys, "left_anti")


def potential_list(priorities: DataFrame | Pairs, k: int = S.LIST_LENGTH, min_hot: float = S.MIN_HOT,
                   min_potential: float = S.MIN_POTENTIAL,
                   to_delete: DataFrame | Best | None = None) -> DataFrame:
    """Goods within the k best potential priorities, without those of ``hot_to_delete``."""
    if to_delete is None:
        to_delete = hot_to_delete(priorities, k)
    rest = minus_hot(priorities, to_delete, min_potential)
    return _ranked(_each(rest, lambda rows: rows.filter(F.col("priority_hot") > min_hot)), "priority_potential", k)


def both_lists(priorities: DataFrame | Pairs, k: int = S.LIST_LENGTH, min_hot: float = S.MIN_HOT,
               min_potential: float = S.MIN_POTENTIAL) -> tuple[DataFrame, DataFrame]:
    """``hot_list`` and ``potential_list`` of pairs that all have a hot priority above ``min_hot``.

    Ranked once; what neither list can hold is gone before the result is stored. ``Pairs`` are ranked where they are made.
    """
    if isinstance(priorities, Pairs):
        gone = replace(hot_to_delete(priorities, k), null_safe=True)
        return hot_list(priorities, k, min_hot), potential_list(priorities, k, min_hot, min_potential, gone)
    ranked = dense_ranks(priorities.filter(F.col("priority_hot") > min_hot), ["user_id"], "priority_hot", "rank")
    useful = staged(ranked.filter((F.col("rank") <= k) | (F.col("priority_potential") >= min_potential)).select(
        "user_id", "goods_id", "rank", "priority_potential"), "ranked")
    hot = useful.filter(F.col("rank") <= k).select("user_id", "goods_id", "rank")
    rest = useful.filter(F.col("rank") > k).drop("rank")
    return hot, _ranked(rest, "priority_potential", k)


def result_lists(hot: DataFrame, potential: DataFrame, k: int = S.LIST_LENGTH) -> DataFrame:
    """Lists per user and type, ordered by rank then goods, cut at k."""
    rows = hot.withColumn("type", F.lit(S.HOT)).unionByName(
        potential.withColumn("type", F.lit(S.POTENTIAL)))
    cut = first_rows(rows, ["user_id", "type"], [F.col("rank"), F.col("goods_id")], k)
    return lists_of(cut, ["user_id", "type"])


def newuser_fallback(lists: DataFrame, k: int = S.LIST_LENGTH, dedupe_fallback: bool = False) -> DataFrame:
    """Exactly k slots per list; empty ones are filled from the new user's list of that type.

    By position, so a filled slot may repeat a goods; with ``dedupe_fallback`` only goods
    not yet in the list are used. The new user has one list per type, and those reach
    every task as one map.
    """
    lists = staged(lists, "lists")
    own = lists.filter((F.col("user_id") == S.NEW_USER) & F.col("type").isin(S.HOT, S.POTENTIAL))
    per_type = own.groupBy("type").agg(F.first("values").alias("values"))
    known = per_type.agg(F.map_from_entries(F.collect_list(F.struct("type", "values")))).scalar()
    fill = append_missing if dedupe_fallback else fill_slots
    return lists.withColumn("fallback", F.try_element_at(known, F.col("type"))).select(
        "user_id", "type", fill(F.col("values"), F.col("fallback"), k).alias("values"))
