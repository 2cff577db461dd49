"""Flow rate: loans at an observation month against their state some months later."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions import buckets as B
from loanbook.functions import rules as R
from loanbook.operators.cards import AUTHORISED_USER, eligible_accounts
from loanbook.operators.vintage import retail_rows, with_terms
from loanbook.plans.skew import pick_last


def _live() -> Column:
    return (F.col("not_closed_ind") == "Y") & F.col("das").isin(*P.ACTIVE_BOOK)


def flow_base(
    trend: DataFrame, prod: DataFrame, unique_rows: DataFrame, caps: DataFrame, p: P.RunParams, lapses: tuple[int, ...],
) -> DataFrame:
    """The newest row of each account in the observation month and the later ones, with state, under the caps of their type.

    A card whose ownership is unknown is dropped together with cards of
    authorised users; other products keep every ownership. History is shuffled
    once, by account; all that follows by account needs no other shuffle of it.
    """
    ends = [p.as_of, *[P.shift_months(p.as_of, lapse) for lapse in lapses]]
    accounts = eligible_accounts(prod).where(F.col("account_type").isin(*p.flow_account_types))
    day = F.col("act_reported_dt")
    in_month = functools.reduce(operator.or_, [day.between(F.lit(end.replace(day=1)), F.lit(end)) for end in ends])
    seen = trend.where(in_month).withColumn("month", F.last_day(day)).repartition(F.col("account_key"))
    seen = pick_last(seen, ["account_key", "month"], [day], trend.columns).withColumn("act_reported_dt", F.col("month"))
    rows = retail_rows(with_terms(seen, accounts), "T").where(
        (F.col("act_reported_dt") != F.lit(p.as_of)) | (F.col("disbursed_on") <= F.lit(p.as_of))
    )
    owners = unique_rows.select("account_key", "state", "ownership_ind")
    limits = caps.where(F.col("active") == 1).select("account_type", "balance_cap", "amount_cap")
    return rows.join(owners, "account_key", "left").where(
        ~((F.col("account_type") == P.CARD_TYPE) & (F.col("ownership_ind") == AUTHORISED_USER))
    ).join(limits, "account_type").where(
        (F.col("current_balance") <= F.col("balance_cap")) & (F.col("sanctioned_amount") <= F.col("amount_cap"))
    )


def transitions(base: DataFrame, p: P.RunParams, lapses: tuple[int, ...]) -> DataFrame:
    """Every account's state in the observation month beside its state some months later, a row per lag.

    An account's months become one map; the lags are read from it, so the
    history meets itself without a join.
    """
    band = F.when(_live(), B.bucket(F.col("derived_dpd"), B.DPD_FLOW9))
    state = F.struct(
        "account_type", "lender_id", "state", "disbursed_dt", "mob", "sanctioned_amount", band.alias("dpd_lbop"),
        F.coalesce(band, F.when(F.col("das").isin(*P.WRITTEN_OFF), F.lit("Written Off"))).alias("dpd_tl"),
        F.col("current_balance").alias("balance_tl"), F.col("chargeoff_amt").alias("chargeoff_tl"),
    )
    months = F.map_from_entries(F.collect_list(F.struct(F.col("act_reported_dt").alias("key"), state.alias("value"))))
    book = base.groupBy("account_key").agg(months.alias("months"))
    lags = F.array(*[
        F.struct(F.lit(lapse).alias("lapse"), F.lit(P.shift_months(p.as_of, lapse)).alias("later")) for lapse in lapses
    ])
    pairs = book.withColumn("seen", F.col("months")[F.lit(p.as_of)]).where("seen is not null").select(
        "account_key", "seen", "months", F.explode(lags).alias("lag")
    ).withColumn("then", F.col("months")[F.col("lag.later")]).where("then is not null")
    seen = ("account_type", "lender_id", "state", "disbursed_dt", "mob", "sanctioned_amount", "dpd_lbop")
    return pairs.select(
        "account_key", F.col("lag.lapse").alias("lapse"), *[f"seen.{c}" for c in seen], F.lit(p.as_of).alias("loan_book_obs_prd"),
        F.col("lag.later").alias("time_lapsed"), *[f"then.{c}" for c in ("dpd_tl", "balance_tl", "chargeoff_tl")],
    )


def flow_rate(
    trend: DataFrame, prod: DataFrame, unique_rows: DataFrame, caps: DataFrame, account_types: DataFrame,
    quarters: DataFrame, p: P.RunParams, lapses: tuple[int, ...] | None = None,
) -> DataFrame:
    """Live loans and later balances by product, lender group, ticket, state, bands, origination and age.

    One lag, that of the run, or all of `lapses` from one scan of history.
    `batch_run` is the partition a run replaces. Lender group and ticket size
    are this library's choice where no expression is given.
    """
    wanted = lapses or (p.time_lapse_months,)
    pairs = transitions(flow_base(trend, prod, unique_rows, caps, p, wanted), p, wanted)
    names = account_types.where(F.col("active") == 1).select("account_type", F.col("account_name").alias("product"))
    rows = pairs.join(F.broadcast(names), "account_type").withColumn(
        "yyyymm", R.yyyymm(F.col("disbursed_dt"))
    ).join(F.broadcast(quarters), "yyyymm", "left")
    run = "|".join(["-".join(p.flow_account_types), p.self_lender, f"{p.as_of:%Y%m}", ""])
    keyed = rows.select(
        "product",
        R.peer_group(F.col("lender_id"), p.card_groups, p.card_group_default, p.card_lender).alias("lender_type"),
        B.bucket(F.col("sanctioned_amount"), B.AMOUNT10).alias("ticket_size_lbop"), "state", "loan_book_obs_prd",
        "time_lapsed", "dpd_lbop", "dpd_tl",
        B.origination_period(F.col("disbursed_dt"), P.shift_months(p.as_of, -36), F.col("fyq")).alias(
            "origination_period"
        ),
        B.bucket(F.col("mob"), B.MOB13).alias("mob_bucket"), F.concat(F.lit(run), F.col("lapse").cast("string")).alias("batch_run"),
        "account_key", "balance_tl", "chargeoff_tl",
    )
    keys = [c for c in keyed.columns if c not in ("account_key", "balance_tl", "chargeoff_tl")]
    return keyed.groupBy(*keys).agg(
        F.count("account_key").alias("live_loans"), F.sum("balance_tl").alias("current_balance_tl"),
        F.sum("chargeoff_tl").alias("total_written_off_amount"),
    )
