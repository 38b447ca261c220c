"""The layer tables and what each is built from.

``Layers`` wires the operators together. Without a store a table is a lazy DataFrame, so a query plans only
what it needs; only pinned tables, which their readers go through several times, are written to the scratch
folder first. With a store, all tables that others read are written once and read back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import RLock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from shelflift.operators import (
    bi, campaign, cannibal, clean, experiment, kpi, placebo, recommend, segments, uplift, weekly,
)
from shelflift.params import Params
from shelflift.sources.tables import materialize, read_table, scratch_path


@dataclass(frozen=True)
class Table:
    layer: str
    build: Callable[["Layers"], DataFrame]
    stored: bool = False
    cluster_by: tuple[str, ...] = ()
    pinned: bool = False
    bucket_by: tuple[str, ...] = ()  # by these columns the table's plan has dealt its rows


class Layers:
    """Tables by name, each built from the raw tables or from other tables."""

    def __init__(self, raw: Mapping[str, DataFrame], params: Params = Params(), store: str | None = None):
        self.raw, self.p, self.store = raw, params, store.rstrip("/") if store else None
        self._cache: dict[str, DataFrame] = {}
        self._reused: dict[str, str] = {}
        self._lazy: set[str] = set()
        self._pinned = {name for name, table in TABLES.items() if table.pinned}
        self._locks = {name: RLock() for name in TABLES}

    def path(self, name: str) -> str:
        return self._reused.get(name) or f"{self.store}/{TABLES[name].layer}/{name}"

    def build(self, name: str) -> DataFrame:
        """The table's plan, without storing it."""
        return TABLES[name].build(self)

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._cache:
                table = TABLES[name]
                df, layout = table.build(self), {"cluster_by": table.cluster_by, "bucket_by": table.bucket_by, "dealt": True}
                if self.store and table.stored:
                    df = materialize(df, self.path(name), **layout)
                elif name in self._pinned:
                    df = materialize(df, scratch_path(df.sparkSession, name), **(layout if table.bucket_by else {}))
                else:
                    self._lazy.add(name)
                self._cache[name] = df
            return self._cache[name]

    def pin(self, name: str) -> None:
        """Write a table to the scratch folder when it is next asked for, as several readers of it are about to be built."""
        with self._locks[name]:
            self._pinned.add(name)
            if name in self._lazy:
                self._lazy.discard(name)
                del self._cache[name]

    def store_all(self, names: Sequence[str], at_once: int = 4) -> None:
        """Build and store tables, several at a time. A table that another needs first is built by whoever asks for it first; the others wait for it."""
        in_thread = inheritable_thread_target(next(iter(self.raw.values())).sparkSession)
        with ThreadPoolExecutor(at_once) as pool:
            running = [pool.submit(in_thread(lambda name=name: self[name])) for name in names]
            try:
                for one in running:
                    one.result()
            except BaseException:
                for one in running:
                    one.cancel()
                raise

    def reuse(self, spark: SparkSession, name: str, path: str) -> DataFrame:
        """Take the table from where an earlier run has stored it instead of building it."""
        self._reused[name] = path
        self._cache[name] = read_table(spark, path)
        return self._cache[name]

    def take(self, name: str, df: DataFrame) -> None:
        """Use ``df`` as the table instead of building it."""
        self._cache[name] = df


def _members(design: str) -> Callable[[Layers], DataFrame]:
    return lambda L: campaign.did_members(L["campaign_spend"], design)


def _campaign_results(L: Layers) -> DataFrame:
    designs = {
        campaign.NEVER: (L["did_never"], L["pretrend_never"]),
        campaign.OTHER_TIMES: (L["did_other"], L["pretrend_other"]),
    }
    return campaign.campaign_results(designs, L["campaign_overview"])


def _bi_row_counts(L: Layers) -> DataFrame:
    """The views go through the trips in seven ways, so these are summed once, and what the views need is built at the same time, the longest first."""
    views = {"dim_week": "dim_week", "fact_baskets": "fact_baskets", "fact_category_week": "fact_category_week", "dim_household": "dim_household",
             "promo_uplift": "bi_promo_uplift", "promo_cannibalisation": "bi_promo_cannibalisation", "campaign_results": "bi_campaign_results"}
    L.pin("baskets")
    L.store_all(["bi_promo_uplift", "did_never", "dim_household", "did_other", *views.values()])
    return bi.bi_row_counts({view: L[name] for view, name in views.items()})


# How the large tables of product, store and week are laid out, so that a reader of some products skips the rest.
PAIR_WEEK = ("product_id", "store_id", "week_no")
PAIR = ("product_id", "store_id")

TABLES: dict[str, Table] = {
    # clean
    "transactions": Table("clean", lambda L: clean.clean_transactions(L.raw["transaction_data"], L.raw["product"]), True, pinned=True),
    "promotions": Table("clean", lambda L: clean.clean_promotions(L.raw["causal_data"]), True, PAIR_WEEK, pinned=True),
    "promo_stores": Table("clean", lambda L: clean.promo_stores(L["promotions"]), True),
    "weekly_product_store_sales": Table("clean", lambda L: clean.weekly_product_store_sales(
        L.raw["transaction_data"], L.raw["product"], L["promotions"], L["promo_stores"], L.p),
        True, PAIR_WEEK, pinned=True),
    "weekly_category_sales": Table("clean", lambda L: clean.weekly_category_sales(L["transactions"]), True),
    "baskets": Table("clean", lambda L: clean.baskets(L["transactions"]), True),
    "households": Table("clean", lambda L: clean.households(
        L["baskets"], L.raw["campaign_table"], L.raw["coupon_redempt"], L.raw["hh_demographic"]), True),
    "coupons": Table("clean", lambda L: clean.clean_coupons(L.raw["coupon"])),
    "campaigns": Table("clean", lambda L: clean.campaigns(L.raw["campaign_desc"], L.raw["campaign_table"])),
    # uplift
    "season_index": Table("analysis", lambda L: uplift.season_index(L["weekly_product_store_sales"], L.p), True,
        pinned=True),
    "ps_weeks": Table("analysis", lambda L: uplift.ps_weeks(L["weekly_product_store_sales"], L["season_index"])),
    "timeline": Table("analysis", lambda L: uplift.promotion_timeline(L["ps_weeks"], L["promotions"], L.p)),
    "pair_timeline": Table("analysis", lambda L: uplift.pair_timeline(L["timeline"], L.p), True, PAIR_WEEK, True, PAIR),
    "ps_candidates": Table("analysis", lambda L: uplift.ps_candidates(L["ps_weeks"], L.p)),
    "promo_weeks": Table("analysis", lambda L: uplift.promo_weeks(L["pair_timeline"], L.p)),
    "baseline": Table("analysis", lambda L: uplift.baseline(L["pair_timeline"], L.p)),
    "promo_week_uplift": Table("analysis", lambda L: uplift.promo_week_uplift(L["pair_timeline"], L.p), True),
    "pull_forward": Table("analysis", lambda L: uplift.pull_forward(L["promo_week_uplift"])),
    "uplift_summary": Table("analysis", lambda L: uplift.uplift_summary(L["promo_week_uplift"], L.p), True, pinned=True),
    "uplift_by_type_share": Table("analysis", lambda L: uplift.uplift_by_type_share(L["uplift_summary"])),
    "uplift_additivity": Table("analysis", lambda L: uplift.uplift_additivity(L["uplift_summary"])),
    "placement_labels": Table("analysis", lambda L: uplift.placement_labels(L["uplift_summary"])),
    "placement_highlights": Table("analysis", lambda L: uplift.placement_highlights(L["placement_labels"])),
    "placebo_test": Table("analysis", lambda L: placebo.placebo_test(L["pair_timeline"], L.p)),
    "placebo_summary": Table("analysis", lambda L: placebo.placebo_summary(L["placebo_test"])),
    # cannibalisation
    "ps_all_baseline": Table("analysis", lambda L: cannibal.ps_all_baseline(L["pair_timeline"], L.p)),
    "promoted_product_weeks": Table("analysis", lambda L: cannibal.promoted_product_weeks(L["pair_timeline"], L.p)),
    "subcat_weeks": Table("analysis", lambda L: cannibal.subcat_weeks(L["pair_timeline"], L.p), True,
        pinned=True),
    "subcat_baseline": Table("analysis", lambda L: cannibal.subcat_baseline(L["subcat_weeks"], L.p)),
    "cannibalisation_summary": Table("analysis", lambda L: cannibal.cannibalisation_summary(
        L["subcat_weeks"], L.p), True, pinned=True),
    "cannibalisation_report": Table("analysis", lambda L: cannibal.cannibalisation_report(
        L["cannibalisation_summary"], L.p)),
    "cannibalised_share": Table("analysis", lambda L: cannibal.cannibalised_share(L["cannibalisation_summary"])),
    "cannibalised_by_department": Table("analysis", lambda L: cannibal.cannibalised_by_department(
        L["cannibalisation_summary"], L.p)),
    # campaigns
    "daily_spend": Table("analysis", lambda L: campaign.daily_spend(L["baskets"]), True, pinned=True),
    "spend_index": Table("analysis", lambda L: campaign.spend_index(L["daily_spend"]), pinned=True),
    "never_targeted": Table("analysis", lambda L: campaign.never_targeted(L["baskets"], L.raw["campaign_table"])),
    "campaign_reach_response": Table("analysis", lambda L: campaign.campaign_reach_response(
        L["campaigns"], L.raw["campaign_table"], L.raw["coupon_redempt"], L.p)),
    "campaign_overview": Table("analysis", lambda L: campaign.campaign_overview(L["campaign_reach_response"])),
    "campaign_spend": Table("analysis", lambda L: campaign.campaign_spend(
        L["spend_index"], L["campaigns"], L.raw["campaign_table"], L.p), True, pinned=True),
    "did_members_never": Table("analysis", _members(campaign.NEVER), True, pinned=True),
    "did_members_other": Table("analysis", _members(campaign.OTHER_TIMES), True, pinned=True),
    "did_panel_never": Table("analysis", lambda L: campaign.did_panel(
        L["did_members_never"], L["campaigns"], L.p), True, pinned=True),
    "did_panel_other_times": Table("analysis", lambda L: campaign.did_panel(
        L["did_members_other"], L["campaigns"], L.p), True, pinned=True),
    "did_per_campaign": Table("analysis", lambda L: campaign.did_per_campaign(L["did_panel_never"])),
    "did_never": Table("analysis", lambda L: campaign.did_by_type(L["did_panel_never"], L.p), True),
    "did_other": Table("analysis", lambda L: campaign.did_by_type(L["did_panel_other_times"], L.p), True),
    "pretrend_never": Table("analysis", lambda L: campaign.pretrend_by_type(L["did_panel_never"], L.p), True),
    "pretrend_other": Table("analysis", lambda L: campaign.pretrend_by_type(L["did_panel_other_times"], L.p), True),
    "did_summary": Table("analysis", lambda L: campaign.did_summary(
        L["did_never"], L["pretrend_never"], L["did_other"], L["pretrend_other"])),
    "event_study": Table("analysis", lambda L: campaign.event_study(
        L["spend_index"], L["campaigns"], L["did_panel_never"], L.p)),
    "campaign_did": Table("analysis", _campaign_results, True),
    # segments
    "rfm_base": Table("analysis", lambda L: segments.rfm_base(L["baskets"], L.p), True, pinned=True),
    "trip_gaps": Table("analysis", lambda L: segments.trip_gaps(L["baskets"])),
    "gap_stats": Table("analysis", lambda L: segments.gap_stats(L["trip_gaps"])),
    "recent_13w": Table("analysis", lambda L: segments.recent_13w(L["baskets"], L.p)),
    "rfm_scores": Table("analysis", lambda L: segments.rfm_scores(L["rfm_base"])),
    "household_rfm": Table("analysis", lambda L: segments.household_rfm(
        L["rfm_scores"], L["gap_stats"], L["recent_13w"], L.p), True, pinned=True),
    "rfm_segment_summary": Table("analysis", lambda L: segments.rfm_segment_summary(L["household_rfm"])),
    "churn_flags": Table("analysis", lambda L: segments.churn_flags(L["household_rfm"])),
    "churn_backtest": Table("analysis", lambda L: segments.churn_backtest(L["baskets"], L.p)),
    "churn_backtest_ratio": Table("analysis", lambda L: segments.churn_backtest_ratio(L["churn_backtest"])),
    "retention_by_quarter": Table("analysis", lambda L: segments.retention_by_quarter(L["baskets"], L.p)),
    "redemption_by": Table("analysis", lambda L: segments.redemption_by(L["households"], L["household_rfm"])),
    "redemption_chi_square": Table("analysis", lambda L: segments.redemption_chi_square(L["redemption_by"])),
    "income_band": Table("analysis", lambda L: segments.household_income_bands(L["households"])),
    # dashboards
    "dim_week": Table("bi", lambda L: bi.dim_week(L["baskets"], L.p), True),
    "fact_baskets": Table("bi", lambda L: bi.fact_baskets(L["baskets"]), True, ("week_no", "basket_id")),
    "fact_category_week": Table(
        "bi", lambda L: bi.fact_category_week(L["weekly_category_sales"]), True, ("week_no", "department", "commodity_desc")),
    "dim_household": Table("bi", lambda L: bi.dim_household(L["household_rfm"], L["households"]), True, pinned=True),
    "bi_promo_uplift": Table("bi", lambda L: uplift.bi_promo_uplift(L["uplift_summary"]), True),
    "bi_promo_cannibalisation": Table("bi", lambda L: cannibal.bi_promo_cannibalisation(
        L["cannibalisation_summary"]), True),
    "bi_campaign_results": Table("bi", lambda L: L["campaign_did"].select("*"), True),
    "bi_row_counts": Table("bi", _bi_row_counts),
    # weekly report
    "latest_complete_week": Table("report", lambda L: weekly.latest_complete_week(L["dim_week"])),
    "weekly_category_report": Table("report", lambda L: weekly.weekly_category_report(
        L["fact_category_week"], weekly.report_week(L["dim_week"]))),
    "weekly_department_report": Table("report", lambda L: weekly.weekly_department_report(L["weekly_category_report"])),
    "weekly_headline": Table("report", lambda L: weekly.weekly_headline(
        L["fact_baskets"], weekly.report_week(L["dim_week"]))),
    "weekly_movers": Table("report", lambda L: weekly.weekly_movers(L["weekly_category_report"], L.p)),
    # KPI trees
    "kpi_sales_tree": Table("kpi", lambda L: kpi.kpi_sales_tree(L.raw["transaction_data"])),
    "kpi_rebuild_check": Table("kpi", lambda L: kpi.kpi_rebuild_check(L["kpi_sales_tree"])),
    "kpi_discounts": Table("kpi", lambda L: kpi.kpi_discounts(L.raw["transaction_data"])),
    "discount_counts": Table("kpi", lambda L: kpi.discount_counts(L.raw["transaction_data"]), pinned=True),
    "kpi_discount_describe": Table("kpi", lambda L: kpi.kpi_discount_describe(L["discount_counts"])),
    "kpi_campaign_reach": Table("kpi", lambda L: kpi.kpi_campaign_reach(
        L.raw["transaction_data"], L.raw["campaign_desc"], L.raw["campaign_table"], L.raw["hh_demographic"])),
    "kpi_items_per_trip": Table("kpi", lambda L: kpi.kpi_items_per_trip(L.raw["transaction_data"])),
    "kpi_rolling_4w": Table("kpi", lambda L: kpi.kpi_rolling_4w(L["baskets"])),
    "kpi_wow": Table("kpi", lambda L: kpi.kpi_wow(L["baskets"])),
    "kpi_net_extra": Table("kpi", lambda L: kpi.kpi_net_extra(L["uplift_summary"], L["cannibalisation_summary"])),
    "kpi_responder_retention": Table("kpi", lambda L: segments.responder_retention(
        L["baskets"], L.raw["coupon_redempt"], L.p)),
    # recommendations and the coupon test
    "promo_type_economics": Table("recommend", lambda L: recommend.promo_type_economics(
        L["uplift_summary"], L["cannibalisation_summary"])),
    "rec_display_on_mailer": Table("recommend", lambda L: recommend.rec_display_on_mailer(
        L["promo_type_economics"], L["dim_household"], L.p)),
    "rec_slot_upgrade": Table("recommend", lambda L: recommend.rec_slot_upgrade(L["uplift_summary"])),
    "rec_cut_departments": Table("recommend", lambda L: recommend.rec_cut_departments(
        L["promo_week_uplift"], L["cannibalisation_summary"], L.p)),
    "avg_coupon_value": Table("recommend", lambda L: recommend.avg_coupon_value(L["transactions"])),
    "rec_at_risk_value": Table("recommend", lambda L: recommend.rec_at_risk_value(
        L["dim_household"], L["avg_coupon_value"], L.p)),
    "rec_summary": Table("recommend", lambda L: recommend.rec_summary(
        L["rec_display_on_mailer"], L["rec_cut_departments"], L["rec_at_risk_value"], L["dim_household"], L.p)),
    "experiment_pool": Table("recommend", lambda L: experiment.experiment_pool(L["dim_household"])),
    "ab_pool_stats": Table("recommend", lambda L: experiment.ab_pool_stats(L["experiment_pool"], L["baskets"], L.p)),
    "ab_sample_size": Table("recommend", lambda L: experiment.ab_sample_size(L["ab_pool_stats"], L.p)),
    "ab_sample_size_exact": Table("recommend", lambda L: experiment.ab_sample_size_exact(L["ab_pool_stats"], L.p)),
    "ab_sample_size_prop": Table("recommend", lambda L: experiment.ab_sample_size_prop(L["churn_backtest"], L.p)),
    "ab_assignment": Table("recommend", lambda L: experiment.ab_assignment(L["experiment_pool"])),
    "ab_balance": Table("recommend", lambda L: experiment.ab_balance(L["ab_assignment"], L["baskets"], L.p)),
    "ab_readout": Table("recommend", lambda L: experiment.ab_readout(
        L["ab_assignment"], L["baskets"], L["transactions"], L.p.pool_first_week - 4)),
}
