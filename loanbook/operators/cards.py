"""Card book: quarterly portfolio, rankings, delinquency, roll rate and wallet share."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions import buckets as B
from loanbook.functions import metrics as M
from loanbook.functions import rules as R
from loanbook.operators.entity import attach_cluster
from loanbook.operators.vintage import retail_rows, with_terms
from loanbook.sources.hot import UNKNOWN, HotKeys

AUTHORISED_USER = "O04"


def eligible_accounts(prod: DataFrame) -> DataFrame:
    """Active accounts that are not suppressed."""
    return prod.where((F.col("active") == 1) & F.col("suppress_indicator").isNull())


def card_base(
    trend: DataFrame, prod: DataFrame, unique_rows: DataFrame, clusters: DataFrame, caps: DataFrame, p: P.RunParams,
    hot: HotKeys = UNKNOWN,
) -> DataFrame:
    """Card rows from history (T) and current state (P) with rule columns, city and cluster.

    Cards of authorised users and of unknown ownership are dropped, as are
    balances above the cap of their type. History is unique by account and
    month and `unique_rows` by account, so rows stay unique.
    """
    cards = eligible_accounts(prod).where(F.col("account_type").isin(*p.card_types))
    history = trend.where(F.col("act_reported_dt") <= F.lit(p.as_of))
    rows = retail_rows(with_terms(history, cards), "T").unionByName(retail_rows(cards, "P"))
    owners = attach_cluster(
        unique_rows.where(F.col("ownership_ind") != AUTHORISED_USER).select("account_key", "consumer_key", "city"),
        clusters, known=hot.consumers,
    ).drop("consumer_key")
    limits = caps.where(F.col("active") == 1).select("account_type", F.col("balance_cap").alias("cap"))
    capped = rows.join(limits, "account_type", "left").where(
        F.col("cap").isNull() | (F.col("current_balance") <= F.col("cap"))
    )
    return capped.drop("cap").join(owners, "account_key")


def _live() -> Column:
    return (F.col("not_closed_ind") == "Y") & F.col("das").isin(*P.ACTIVE_BOOK)


def _first_quarter(quarters: tuple[date, ...]) -> Column:
    """Position of the first quarter end on or after the report date."""
    days = F.array(*[F.lit(q) for q in quarters])
    return F.size(F.filter(days, lambda q: q < F.col("act_reported_dt")))


SPINE_COLUMNS = ("lender_id", "das", "mob", "city", "derived_dpd", "current_balance", "sanctioned_amount",
                 "not_closed_ind")


def quarter_rows(cards: DataFrame, quarters: tuple[date, ...]) -> DataFrame:
    """The state of every card at every quarter end.

    A card shows its current row from the first quarter end it covers; before
    that, its newest history row so far. History is reduced to at most one row
    per (card, quarter) first and each row then fills the quarters up to the
    next one, so the quarters need no loop and no range join.
    """
    last = len(quarters)
    placed = cards.withColumn("q", _first_quarter(quarters)).where(F.col("q") < last)
    current = placed.where(F.col("ind") == "P")
    newest = placed.where(F.col("ind") == "T").groupBy("account_key", "q").agg(
        F.max_by(F.struct(*SPINE_COLUMNS), "act_reported_dt").alias("row")
    )
    following = F.lead("q").over(Window.partitionBy("account_key").orderBy("q"))
    starts = current.select("account_key", F.col("q").alias("current_from"))
    history = newest.withColumn("next_q", following).join(starts, "account_key", "left").withColumn(
        "until", F.least(F.coalesce("next_q", F.lit(last)), F.coalesce("current_from", F.lit(last))) - 1
    ).where(F.col("until") >= F.col("q"))
    ends = F.array(*[F.lit(q) for q in quarters])
    past = history.select(
        "account_key", F.lit("T").alias("data_ind"), F.explode(F.sequence("q", "until")).alias("at"), "row.*"
    )
    now = current.select(
        "account_key", F.lit("P").alias("data_ind"),
        F.explode(F.sequence("q", F.lit(last - 1))).alias("at"), *SPINE_COLUMNS,
    )
    return past.unionByName(now).withColumn("reported_dt", F.element_at(ends, F.col("at") + 1)).drop("at")


def quarter_spine_agg(cards: DataFrame, quarters: tuple[date, ...], low_balance: int) -> DataFrame:
    """Active cards per quarter end, lender, row kind, age and city.

    Corrected: groups are the shown keys, and averages carry their sums, so
    that later averages can be weighted.
    """
    limit = "coalesce(sanctioned_amount, 0)"
    utilisation = R.ratio(F.col("current_balance"), F.col("sanctioned_amount"), 100, 4).cast("decimal(18,4)")
    rows = quarter_rows(cards, quarters).where(_live()).withColumn("utilisation", R.zero_if_null(utilisation))
    low = f"current_balance < {low_balance}"
    aggs = ["count_if(derived_dpd <= 180) as active_cards_dpd180",
            "sum(if(derived_dpd <= 180, current_balance, 0)) as total_active_pos_dpd180"]
    for n in (30, 60, 90):
        late = f"derived_dpd > {n} and derived_dpd <= 180"
        aggs.append(f"count_if({late}) as loans_dpd_gtr_{n}")
        aggs.append(f"sum(if({late}, current_balance, 0)) as pos_dpd_gtr_{n}")
    aggs += [
        "count(account_key) as active_cards", "sum(current_balance) as total_active_pos",
        "sum(utilisation) as utilisation_sum", f"sum({limit}) as credit_limit_sum",
        f"count_if({low}) as low_utilization_loan", f"sum(if({low}, utilisation, 0)) as low_utilisation_sum",
        f"sum(if({low}, {limit}, 0)) as low_credit_limit_sum",
    ]
    grouped = rows.groupBy("reported_dt", "lender_id", "data_ind", "mob", "city").agg(*[F.expr(a) for a in aggs])
    return grouped.select(
        "*", _average("utilisation_sum", "active_cards").alias("average_utilization_percent"),
        _average("credit_limit_sum", "active_cards").alias("average_credit_limit"),
        _average("low_utilisation_sum", "low_utilization_loan").alias("low_utilization_pf_percent"),
        _average("low_credit_limit_sum", "low_utilization_loan").alias("average_low_credit_limit"),
    )


def _average(total: str, count: str) -> Column:
    return R.ratio(F.col(total), F.col(count), 1, 4)


def _peer(p: P.RunParams) -> Column:
    return R.peer_group(F.col("lender_id"), p.card_groups, p.card_group_default, p.card_lender)


def cc_acquisitions_rank(cards: DataFrame, p: P.RunParams) -> DataFrame:
    """New cards per month and peer group, with the self lender's rank among the listed lenders."""
    new = cards.where(
        (F.col("ind") == "P") & F.col("disbursed_on").between(F.lit(p.look_back_start), F.lit(p.as_of))
        & (F.col("derived_dpd") <= 180) & F.col("das").isin(*P.ACTIVE_BOOK)
    )
    per_lender = new.groupBy("disbursed_dt", "lender_id").agg(F.count("account_key").alias("n"))
    listed = F.col("lender_id").isin(*p.ranked_lenders)
    place = F.rank().over(Window.partitionBy("disbursed_dt", listed).orderBy(F.col("n").desc()))
    own = listed & (F.col("lender_id") == p.card_lender)
    ranked = per_lender.withColumn("own_rank", F.when(own, place))
    return ranked.groupBy("disbursed_dt", _peer(p).alias("peer_group")).agg(
        F.sum("n").alias("total_cc_acquisitions"), F.coalesce(F.max("own_rank"), F.lit(0)).alias("rank")
    )


def cc_early_delinquency(spine: DataFrame, quarters: DataFrame, p: P.RunParams) -> DataFrame:
    """Fiscal quarter x peer group at three, six and twelve months on book."""
    rows = spine.where(F.col("mob").isin(2, 5, 11)).withColumn("yyyymm", R.yyyymm(F.col("reported_dt")))
    dated = rows.join(F.broadcast(quarters), "yyyymm")
    sums = {"active_cards": "active_cards_dpd180", "loans_dpd_gtr_30": "loans_dpd_gtr_30",
            "loans_dpd_gtr_90": "loans_dpd_gtr_90", "total_active_pos": "total_active_pos",
            "pos_dpd_gtr_30": "pos_dpd_gtr_30", "pos_dpd_gtr_90": "pos_dpd_gtr_90"}
    grouped = dated.groupBy(F.col("fyq").alias("financial_qtr"), _peer(p).alias("peer_group"), "mob").agg(
        *[F.sum(c).alias(name) for name, c in sums.items()]
    )
    return grouped.withColumn("mob", F.col("mob") + 1)


def cc_top_cities(spine: DataFrame, p: P.RunParams) -> DataFrame:
    """Largest cities per peer group by active cards now, and the same cities a year earlier."""
    year_ago = P.shift_months(p.as_of, -12)
    rows = spine.where(F.col("city").isNotNull() & F.col("reported_dt").isin(p.as_of, year_ago))
    cities = rows.groupBy("reported_dt", _peer(p).alias("peer_group"), "city").agg(*[F.expr(e) for e in (
        "sum(active_cards) as total_active_cards", "sum(total_active_pos) as total_active_pos",
        "sum(utilisation_sum) as utilisation_sum", "sum(credit_limit_sum) as credit_limit_sum",
    )])
    now = F.col("reported_dt") == F.lit(p.as_of)
    order = Window.partitionBy("peer_group").orderBy(F.col("total_active_cards").desc(), "city")
    top = cities.where(now).withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= p.top_cities)
    kept = cities.join(top.select("peer_group", "city"), ["peer_group", "city"], "left_semi")
    return kept.select(
        "reported_dt", "peer_group", "city", "total_active_cards", "total_active_pos",
        _average("utilisation_sum", "total_active_cards").alias("average_utilization_percent"),
        _average("credit_limit_sum", "total_active_cards").alias("average_credit_limit"),
    )


def cc_portfolio(spine: DataFrame, p: P.RunParams) -> DataFrame:
    return spine.groupBy("reported_dt", _peer(p).alias("peer_group")).agg(
        F.sum("active_cards").alias("active_cards"), F.sum("total_active_pos").alias("total_active_pos")
    )


def cc_self_rank(spine: DataFrame, p: P.RunParams) -> DataFrame:
    """Rank of the self lender by active cards among the listed lenders, per quarter end."""
    per_lender = spine.where(F.col("lender_id").isin(*p.ranked_lenders)).groupBy("reported_dt", "lender_id").agg(
        F.sum("active_cards").alias("n")
    )
    place = F.rank().over(Window.partitionBy("reported_dt").orderBy(F.col("n").desc()))
    return per_lender.select("reported_dt", "lender_id", place.alias("rank")).where(
        F.col("lender_id") == p.card_lender
    )


def cc_low_utilisation(spine: DataFrame, p: P.RunParams) -> DataFrame:
    """Share and averages of cards with a low balance, weighted by cards."""
    sums = spine.groupBy("reported_dt", _peer(p).alias("peer_group")).agg(*[F.expr(f"sum({c}) as {c}") for c in (
        "low_utilization_loan", "active_cards", "low_utilisation_sum", "low_credit_limit_sum"
    )])
    return sums.select(
        "reported_dt", "peer_group",
        R.ratio(F.col("low_utilization_loan"), F.col("active_cards"), 100, 4).alias("low_utilization_percent"),
        _average("low_utilisation_sum", "low_utilization_loan").alias("low_utilization_pf_percent"),
        _average("low_credit_limit_sum", "low_utilization_loan").alias("average_low_credit_limit"),
    )


def cc_delinquency_pct(spine: DataFrame, p: P.RunParams) -> DataFrame:
    """Mean over the spine groups of their delinquent share of cards and of balance."""
    def mean(part: str, whole: str) -> Column:
        share = R.ratio(F.abs(part), F.abs(whole), 100, 6).cast("decimal(18,6)")
        return R.ratio(F.sum(share), F.count(share), 1, 4)

    return spine.groupBy("reported_dt", _peer(p).alias("peer_group")).agg(
        *[mean(f"loans_dpd_gtr_{n}", "active_cards_dpd180").alias(f"loan_{n}_plus_percent") for n in (30, 60, 90)],
        *[mean(f"pos_dpd_gtr_{n}", "total_active_pos_dpd180").alias(f"portfolio_{n}_plus_percent")
          for n in (30, 60, 90)],
    )


# fixed values: cumulative bands that each DPD band belongs to
CUMULATIVE = {
    "No Due": ("No Due",), "1_30": ("1+",), "30_60": ("1+", "30+"), "60_90": ("1+", "30+", "60+"),
    "90_180": ("1+", "30+", "60+", "90+"),
}


def _cumulative(band: str) -> Column:
    arms = None
    for label, names in CUMULATIVE.items():
        test, value = F.col(band) == label, F.array(*[F.lit(n) for n in names])
        arms = F.when(test, value) if arms is None else arms.when(test, value)
    return arms


def roll_pairs(cards: DataFrame, p: P.RunParams, lags: tuple[int, ...]) -> DataFrame:
    """A live card's month beside its month a lag later, for every lag, as counted bands and balances.

    A card's months become one map from month to rows, and every lag is read
    from it: the card base is scanned and shuffled once, by account, whatever
    the number of lags, and is not joined with itself.
    """
    start = P.shift_months(p.as_of, -p.roll_back_months)
    rows = cards.where((F.col("ind") == "T") & _live() & (F.col("derived_dpd") <= 180)).select(
        "account_key", F.col("act_reported_dt").alias("day"), F.struct(
            "lender_id", B.bucket(F.col("derived_dpd"), B.DPD_FLOW5).alias("band"), F.col("current_balance").alias("balance")
        ).alias("row"),
    ).repartition(F.col("account_key"))
    per_day = rows.groupBy("account_key", "day").agg(F.collect_list("row").alias("rows"))
    months = F.map_from_entries(F.collect_list(F.struct("day", "rows")))
    book = per_day.groupBy("account_key").agg(months.alias("months")).select(F.explode("months").alias("day", "rows"), "months")
    seen = book.where(
        F.col("day").between(F.lit(start), F.lit(p.as_of)) & F.month("day").isin(*p.roll_months)
    ).withColumn("lag", F.explode(F.array(*[F.lit(n) for n in lags])))
    later = F.last_day(F.add_months("day", F.col("lag")))
    both = seen.withColumn("later", F.col("months")[later]).where("later is not null")
    return both.select("lag", F.col("day").alias("reported_dt_from"), F.explode("rows").alias("was"), "later").select(
        "lag", "reported_dt_from", "was", F.explode("later").alias("now")
    ).select(
        "lag", "reported_dt_from", "was.lender_id", F.col("was.band").alias("dpd_from"), F.col("was.balance").alias("balance_from"),
        F.col("now.band").alias("dpd_to"), F.col("now.balance").alias("balance_to"),
    )


def roll_rate(cards: DataFrame, p: P.RunParams) -> DataFrame:
    """Where cards of each DPD band at a quarter end stand twelve months later, in cumulative bands."""
    return roll_rates(cards, p, (12,)).drop("lag")


def roll_rates(cards: DataFrame, p: P.RunParams, lags: tuple[int, ...]) -> DataFrame:
    """Roll rates over several lags, in months.

    Pairs are counted by plain band first; cumulative bands are spread over
    those few counts instead of over the cards.
    """
    pairs = roll_pairs(cards, p, lags)
    counted = pairs.groupBy("lag", "reported_dt_from", _peer(p).alias("peer_group"), "dpd_from", "dpd_to").agg(
        F.count(F.lit(1)).alias("n"), F.sum("balance_from").alias("b_from"), F.sum("balance_to").alias("b_to")
    )
    spread = counted.withColumn("new_dpd_from", F.explode(_cumulative("dpd_from"))).withColumn(
        "new_dpd_to", F.explode(_cumulative("dpd_to"))
    )
    keys = ["lag", "reported_dt_from", "peer_group", "new_dpd_from"]
    cells = spread.groupBy(*keys, "new_dpd_to").agg(
        F.sum("n").alias("active_cards"), F.sum("b_from").alias("balance_from"),
        F.sum("b_to").alias("current_balance_to"),
    )
    whole = Window.partitionBy(*keys)
    totals = cells.select(
        "*", F.sum("active_cards").over(whole).alias("total_dpd"), F.sum("balance_from").over(whole).alias("total_cb")
    )
    return totals.select(
        *keys, "new_dpd_to", "total_dpd", "total_cb", "active_cards", "current_balance_to",
        R.ratio(F.col("active_cards"), F.col("total_dpd"), 100).alias("loans_flow_rate_percent"),
        R.ratio(F.col("current_balance_to"), F.col("total_cb"), 100).alias("portfolio_flow_rate_percent"),
    )


def wallet_rows(cards: DataFrame, p: P.RunParams) -> DataFrame:
    """Live card rows at the end date and a year earlier: history of that month end plus current rows."""
    dates = (P.shift_months(p.as_of, -12), p.as_of)
    days = F.explode(F.array(*[F.lit(d) for d in dates])).alias("reported_on")
    rows = cards.where(_live()).select("*", days)
    history = (F.col("ind") == "T") & (F.col("act_reported_dt") == F.col("reported_on"))
    current = (F.col("ind") == "P") & (F.col("act_reported_dt") <= F.col("reported_on"))
    return rows.where(history | current).select(
        F.col("reported_on").alias("reported_dt"), "clst_id", "lender_id", "current_balance"
    )


def share_of_wallet(cards: DataFrame, p: P.RunParams) -> DataFrame:
    """Card balance that each lender's customers hold in total and with that lender.

    Balances are summed per (cluster, lender) and per cluster before the one
    join that replaces a query per lender.
    """
    low = F.when(F.col("current_balance") < p.low_balance, F.col("current_balance")).otherwise(0)
    held = wallet_rows(cards, p).groupBy("reported_dt", "clst_id", "lender_id").agg(
        F.sum("current_balance").alias("own"), F.sum(low).alias("own_low")
    )
    total = held.groupBy("reported_dt", "clst_id").agg(F.sum("own").alias("whole"), F.sum("own_low").alias("whole_low"))
    asked = held.where(F.col("lender_id").isin(*p.wallet_lenders))
    return asked.join(total, ["reported_dt", "clst_id"]).groupBy("reported_dt", "lender_id").agg(
        F.sum("whole").alias("clst_base_cb"), F.sum("own").alias("bank_cb"),
        F.sum("whole_low").alias("low_clst_base_cb"), F.sum("own_low").alias("low_bank_cb"),
    )


def all_product_base(
    trend: DataFrame, prod: DataFrame, account_clusters: DataFrame, cards: DataFrame, p: P.RunParams
) -> DataFrame:
    """All-product rows at every quarter end for clusters that held a card in the look-back."""
    accounts = eligible_accounts(prod)
    quarters = p.quarter_ends
    day = F.col("act_reported_dt")
    past = retail_rows(
        with_terms(trend.where(day.isin(*quarters)), accounts), "T"
    ).withColumn("reported_dt", F.col("act_reported_dt"))
    current = retail_rows(accounts.where(day <= F.lit(quarters[-1])), "P")
    ends = F.array(*[F.lit(q) for q in quarters])
    at = F.explode(F.filter(ends, lambda q: q >= F.col("reported_on"))).alias("reported_dt")
    reported = accounts.select("account_key", day.alias("reported_on"))
    now = current.join(reported, "account_key").select("*", at).drop("reported_on")
    holders = cards.where(
        ((F.col("ind") == "T") & day.between(F.lit(p.look_back_start), F.lit(p.as_of))
         & F.month(day).isin(3, 6, 9, 12))
        | ((F.col("ind") == "P") & (day <= F.lit(quarters[-1])))
    ).select("clst_id").distinct()
    members = account_clusters.distinct().join(holders, "clst_id", "left_semi")
    return past.unionByName(now).join(members, "account_key").select(
        F.col("ind").alias("data_ind"), "reported_dt", "clst_id", "account_key", "lender_id", "account_type", "das",
        "closed_dt", "not_closed_ind", "derived_dpd", "current_balance", "amount_overdue_total", "chargeoff_amt",
        "sanctioned_amount", "mob", F.col("disbursed_on").alias("disbursed_dt"),
    )


def new_vs_known(base: DataFrame, p: P.RunParams) -> DataFrame:
    """New and known customers to credit, lender group and card product, per quarter end and peer group.

    Rows are counted per (cluster, peer, product) first; the partition sizes
    are sums over those counts, so a large cluster is a handful of rows.
    """
    counted = base.groupBy("reported_dt", "clst_id", _peer(p).alias("peer_group"), "account_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    size = lambda *more: F.sum("n").over(Window.partitionBy("clst_id", "reported_dt", *more))
    sized = counted.select(
        "*", size().alias("rw"), size("peer_group").alias("rw_peer"), size("account_type").alias("rw_product")
    )
    card = F.col("account_type") == P.CARD_TYPE
    return sized.groupBy("reported_dt", "peer_group").agg(
        M.sum_if(F.col("rw") == 1, F.col("n"), "ntc"), M.sum_if(F.col("rw_peer") == 1, F.col("n"), "ntb"),
        M.sum_if(F.col("rw_peer") > 1, F.col("n"), "etb"),
        M.sum_if(card & (F.col("rw_product") == 1), F.col("n"), "ntp"),
        M.sum_if(card & (F.col("rw_product") > 1), F.col("n"), "ktp"),
    )
