"""The bucketed fact table: cleaned account grain, rollup and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions import buckets as B
from loanbook.functions import rules as R
from loanbook.operators.entity import attach_cluster, cluster_min_disbursal, latest_consumer
from loanbook.operators.intervals import AS_OFS, per_date
from loanbook.operators.par import BANDS, METRICS
from loanbook.plans.skew import pick_first, skew_join
from loanbook.sources.hot import UNKNOWN, HotKeys

PERSON = ("consumer_key", "gender", "age", "age_as_on_dt", "birth_dt", "occupation", "monthly_income", "state",
          "district", "pin_code")
SHARED_MONEY = ("amount_overdue_total", "chargeoff_amt", "current_balance", "disbursed_amount", "min_amount_due")


def mfi_step1(snapshot: DataFrame, clusters: DataFrame, consumer: DataFrame, hot: HotKeys = UNKNOWN) -> DataFrame:
    """Snapshot rows, of one date or several, with their newest consumer row, cluster and the cluster's first disbursal by then.

    All three are looked up by consumer alone, the first disbursals of several
    dates as a list, so that the rows are moved once. Rows of `portfolios` are
    moved once for all their dates and leave repeated per date.
    """
    people = latest_consumer(consumer).select(*PERSON)
    loans = per_date(snapshot.select("consumer_key", "disbursed_dt", AS_OFS)) if AS_OFS in snapshot.columns else snapshot
    first = cluster_min_disbursal(loans.select("as_of", "consumer_key", "disbursed_dt"), clusters, ("as_of",)).groupBy("consumer_key").agg(
        F.collect_list(F.struct("as_of", "min_disb_dt")).alias("firsts")
    )
    named = skew_join(snapshot, people, ["consumer_key"], "inner", "account_key", known=hot.consumers)
    rows = attach_cluster(named, clusters, known=hot.consumers)
    dated = skew_join(rows, first, ["consumer_key"], "left", "account_key", known=hot.consumers)
    dated = per_date(dated) if AS_OFS in dated.columns else dated
    by_then = F.filter("firsts", lambda one: one["as_of"] == F.col("as_of"))["min_disb_dt"]
    return dated.select("as_of", *[c for c in rows.columns if c not in ("as_of", AS_OFS)], F.array_max(by_then).alias("min_disb_dt"))


def reportable(rows: DataFrame, largest: int) -> DataFrame:
    """Rows with a reported status and an amount a ledger can hold."""
    return rows.where(~F.col("account_status").isin(*P.NOT_REPORTED) & R.storable(F.col("disbursed_amount"), largest))


# columns of the cleaned grain that no other is derived from, and what they are in the rows of `mfi_step1`
PASSED_ON = {"account_nbr": "account_nbr", "clst_id": "clst_id", "high_credit": "high_credit", "rpt_dt": "act_reported_dt"}


def unread(columns: tuple[str, ...] | None) -> list[str]:
    """Columns of `mfi_step1` that `mfi_step2` can do without if only `columns` of the cleaned grain are wanted."""
    return ["data_ind", *[source for name, source in PASSED_ON.items() if name not in columns]] if columns else []


def group_share(rows: DataFrame, lender: str, category: str, per: tuple[str, ...] = ()) -> DataFrame:
    """Absolute amounts; loans of the group category at the group lender get 1/n of theirs.

    n is the number of such loans in the group, for each value of the columns `per` by itself.
    Only such loans are joined to their number; all others stay where they lie. `rows` are read three times.
    """
    grouped = F.coalesce((F.col("lender_id") == lender) & (F.col("loan_category") == category), F.lit(False))
    loans = rows.where(grouped)
    sizes = loans.groupBy(*per, "group_id").agg(F.count(F.lit(1)).alias("members"))
    kept = [c for c in rows.columns if c not in SHARED_MONEY]

    def share(name: str) -> Column:
        part = F.round((F.abs(name).cast("double") / F.col("members")).cast("decimal(38,8)"), 2)
        return R.zero_if_null(part.cast("decimal(18,2)")).alias(name)

    shared = loans.join(sizes, [*per, "group_id"], "left").select(*kept, *[share(c) for c in SHARED_MONEY])
    return rows.where(~grouped).select(*kept, *[F.abs(c).alias(c) for c in SHARED_MONEY]).unionByName(shared)


def geo_key_join(rows: DataFrame, geo: DataFrame) -> DataFrame:
    """Geography key by state, district and the digits of the pin; missing parts match missing parts."""
    places = geo.where(F.col("active") == 1).select(
        "sdp_key", *[F.col(c).alias(f"g_{c}") for c in ("state", "district", "pin_code")]
    )
    pin = R.clean_digits(F.col("pin_code"))
    on = (
        F.col("state").eqNullSafe(F.col("g_state")) & F.col("district").eqNullSafe(F.col("g_district"))
        & pin.eqNullSafe(F.col("g_pin_code"))
    )
    return rows.join(F.broadcast(places), on).drop("g_state", "g_district", "g_pin_code")


def mfi_step2(
    step1: DataFrame, lenders: DataFrame, purposes: DataFrame, occupations: DataFrame, geo: DataFrame,
    p: P.RunParams, columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """Cleaned account grain: one row per account and date with dimension keys and row rules, or those of them in `columns`.

    Lenders, purposes, occupations and places are masters of code lists and are broadcast.
    Rows are moved by account alone: an account's rows of several dates then lie
    side by side and compress to little more than one. `step1` may lack the columns `unread`.
    """
    raw = reportable(step1, p.largest_amount).withColumn("dpd", R.clean_digits(F.col("days_past_due")).try_cast("int"))
    day, closed = F.col("as_of"), F.col("closed_dt")
    raw = raw.withColumn(
        "mfi_das",
        R.mfi_status(*[F.col(c) for c in ("chargeoff_amt", "closed_dt")], day,
                     *[F.col(c) for c in ("dpd", "amount_overdue_total", "disbursed_amount", "account_status")]),
    )
    shared = group_share(raw, p.group_lender, p.group_category, ("as_of",))
    keyed = geo_key_join(shared, geo)
    active_lenders = lenders.where(F.col("active") == 1).select("lender_id", "contri_key")
    joined = keyed.join(F.broadcast(active_lenders), "lender_id", "left").join(
        F.broadcast(purposes), ["lender_id", "loan_purpose"], "left"
    ).join(F.broadcast(occupations), ["lender_id", "occupation"], "left")
    joined = joined.withColumns({c: F.lit(None) for c in unread(columns) if c not in joined.columns})
    cleaned = joined.select(
        "as_of", "account_key", "account_nbr", "lender_id", "sdp_key", "contri_key", "clst_id", "min_disb_dt",
        R.active_lender(F.col("mfi_das"), closed, day, F.col("lender_id")).alias("active_lender"),
        "mfi_das", "das", "closed_dt", "dpd",
        F.col("amount_overdue_total").alias("amt_due"), F.col("chargeoff_amt").alias("charge_amt"),
        F.col("current_balance").alias("cur_bal"), F.col("disbursed_amount").alias("disb_amt"),
        F.col("disbursed_dt").alias("disb_dt"), F.abs("high_credit").alias("high_credit"),
        R.freq_or_na(F.col("instal_freq")).alias("instal_freq"), F.col("loan_category").alias("ln_cat"),
        F.coalesce("purpose_status", F.lit("NA")).alias("ln_purpose"),
        F.coalesce("occupation_category", F.lit("NULL")).alias("occupation"),
        F.col("act_reported_dt").alias("rpt_dt"), "consumer_key", "group_id", "centre_id",
        R.age_at_reported(day, *[F.col(c) for c in ("birth_dt", "age", "age_as_on_dt")]).alias("age"),
        R.tenure_months(F.col("num_installment"), F.col("instal_freq")).alias("num_instal"),
        R.tenure_months(F.col("num_installment"), F.col("instal_freq"), "floor").alias("new_num_instal"),
        "num_installment", "gender", F.abs("monthly_income").alias("monthly_income"),
        F.trim("loan_cycle_id").alias("loan_cycle_id"), "suppress_indicator", "min_amount_due",
    )
    order = [F.col(c) for c in ("das", "sdp_key", "ln_purpose", "occupation", "consumer_key")]
    return pick_first(cleaned.repartition("account_key"), ["account_key", "as_of"], order, columns and list(columns))


ROLLUP_KEYS = [
    "sdp_key", "contri_key", "load_yyyymm", "disb_yyyymm", "min_disb_yyyymm", "ln_cat", "loan_account_status", "dpd",
    "overdue_ind", "das", "loan_ticket_size", "loan_cycle_id", "loan_cycle_id_new", "num_instal", "new_num_instal",
    "instal_freq", "borrower_income", "gender", "age", "ln_purpose", "occupation", "suppress_indicator",
    "min_amt_due", "min_amt_due_calc", "min_amt_due_both",
]


# columns of the cleaned grain that a rollup reads, with its keys account_key and as_of
ROLLUP_INPUT = (
    "sdp_key", "contri_key", "min_disb_dt", "mfi_das", "closed_dt", "dpd", "amt_due", "charge_amt", "cur_bal", "disb_amt", "disb_dt",
    "instal_freq", "ln_cat", "ln_purpose", "occupation", "consumer_key", "group_id", "centre_id", "age", "num_instal", "new_num_instal",
    "num_installment", "gender", "monthly_income", "loan_cycle_id", "suppress_indicator", "min_amount_due",
)
DATED = ("load_yyyymm", "min_disb_yyyymm", "loan_account_status", "das", "age")  # labels that depend on the date of the portfolio
MEMBERS = {"centre_id": "total_centres", "group_id": "total_groups", "consumer_key": "total_consumers"}
SUMS = {"cur_bal": "total_outstanding_amount", "disb_amt": "total_disbursed_amount", "amt_due": "total_overdue_amount",
        "charge_amt": "total_write_off_amount"}


def fact_rollup(step2: DataFrame, categories: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sums and distinct counts by 25 labels, or by those of them in `by`, each label named once before grouping.

    Corrected: the disbursal month is grouped as shown, not by day. Accounts
    are one row each, so their distinct count is a row count. Groups of all
    labels are about as many as the accounts, see `_counted_in_place`; those of
    few labels shrink before they are moved.
    """
    known = F.broadcast(categories.select(F.col("loan_category").alias("ln_cat"), F.lit(True).alias("known")))
    rows = step2.join(known, "ln_cat", "left")
    dpd, due, amount = F.col("dpd"), F.col("amt_due"), F.col("disb_amt")
    calc = R.min_due_calc(amount, F.col("num_installment"))
    labelled = rows.select(
        "sdp_key", "contri_key",
        R.yyyymm(F.col("as_of")).alias("load_yyyymm"), R.yyyymm(F.col("disb_dt")).alias("disb_yyyymm"),
        R.yyyymm(F.col("min_disb_dt")).alias("min_disb_yyyymm"),
        F.when(F.col("known"), F.col("ln_cat")).otherwise(F.lit("NA")).alias("ln_cat"),
        R.loan_state(F.col("closed_dt"), F.col("as_of"), F.col("mfi_das")).alias("loan_account_status"),
        B.dpd14(dpd, due, amount).alias("dpd"), R.overdue_ind(dpd, due, amount).alias("overdue_ind"),
        F.col("mfi_das").alias("das"), B.bucket(F.abs(amount), B.TICKET30).alias("loan_ticket_size"),
        B.cycle3(F.col("loan_cycle_id")).alias("loan_cycle_id"),
        B.cycle9(F.col("loan_cycle_id")).alias("loan_cycle_id_new"),
        B.bucket(F.col("num_instal"), B.INSTAL4).alias("num_instal"),
        B.bucket(F.col("new_num_instal"), B.INSTAL4).alias("new_num_instal"), "instal_freq",
        B.bucket(F.col("monthly_income"), B.INCOME7).alias("borrower_income"), "gender",
        B.bucket(F.col("age"), B.AGE12).alias("age"), R.purpose_code(F.col("ln_purpose")).alias("ln_purpose"),
        R.occupation_code(F.col("occupation")).alias("occupation"),
        R.suppress_code(F.col("suppress_indicator")).alias("suppress_indicator"),
        B.bucket(F.col("min_amount_due"), B.MIN_DUE13).alias("min_amt_due"),
        B.bucket(calc, B.MIN_DUE13).alias("min_amt_due_calc"),
        B.bucket(F.coalesce("min_amount_due", calc), B.MIN_DUE13).alias("min_amt_due_both"),
        "centre_id", "group_id", "account_key", "consumer_key", "cur_bal", "disb_amt", "amt_due", "charge_amt",
        "disb_dt",
    )
    if by is None:
        return _counted_in_place(labelled, ROLLUP_KEYS)
    return labelled.groupBy(*by).agg(
        F.count_distinct("centre_id").alias("total_centres"), F.count_distinct("group_id").alias("total_groups"),
        F.count("account_key").alias("total_accounts"), F.count_distinct("consumer_key").alias("total_consumers"),
        *[F.expr(f"coalesce(sum({c}), 0) as {name}") for c, name in SUMS.items()], F.min("disb_dt").alias("oldest_loan"),
    )


def _counted_in_place(labelled: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and distinct counts of many small groups: the rows are moved once, by group, and never copied.

    Inside a task the rows of a group are sorted by each kind of member in turn,
    and a member counts where it differs from the one before. All of it may
    spill; neither a group nor a table of groups is held in memory. A digest of
    the labels that do not change with the date says where a row goes, so that
    rows of an account's dates, alike in nearly all columns, lie side by side
    and compress to little more than one. It and the other labels settle nearly
    every comparison and leave later sorts little to do. Such rows unpack to many
    times their compressed size, by which adaptive execution would put several
    parts in a task; the number of parts is given, so that it does not.
    """
    dated = [c for c in DATED if c in keys]
    lasting = [c for c in keys if c not in dated]
    parts = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = labelled.withColumn("digest", F.xxhash64(*lasting) if lasting else F.lit(0)).repartition(parts, "digest")
    counted = placed.select("digest", *keys, *MEMBERS, *SUMS, "disb_dt", F.col("account_key").isNotNull().alias("is_account"))
    group = Window.partitionBy("digest", *dated, *lasting)
    for member in MEMBERS:
        new = F.col(member).isNotNull() & ~F.col(member).eqNullSafe(F.lag(member).over(group.orderBy(member)))
        counted = counted.withColumn(f"new_{member}", new)
    ordered = group.orderBy(member)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = {name: F.count_if(f"new_{c}").over(whole).alias(name) for c, name in MEMBERS.items()}
    return counted.select(
        *keys, F.row_number().over(ordered).alias("row_of_group"),
        counts["total_centres"], counts["total_groups"], F.count_if("is_account").over(whole).alias("total_accounts"), counts["total_consumers"],
        *[F.coalesce(F.sum(c).over(whole), F.lit(0)).alias(name) for c, name in SUMS.items()], F.min("disb_dt").over(whole).alias("oldest_loan"),
    ).where("row_of_group = 1").drop("row_of_group")


# label column -> (dimension, key column, join kind). Inner joins drop rows
# whose label the dimension does not hold as active.
FACT_KEYS = {
    "ln_cat": ("category", "loan_account_type_key", "inner"),
    "loan_account_status": ("loan_state", "loan_account_status_key", "inner"),
    "dpd": ("dpd", "loan_dpd_bucket_key", "inner"),
    "das": ("status", "das_id", "left"),
    "loan_ticket_size": ("ticket_size", "loan_ticket_size_key", "inner"),
    "loan_cycle_id": ("cycle", "loan_cycle_key", "inner"),
    "loan_cycle_id_new": ("cycle_new", "loan_cycle_new_key", "left"),
    "num_instal": ("instalments", "loan_num_instal_bucket_key", "inner"),
    "new_num_instal": ("instalments", "loan_num_instal_bucket_new_key", "left"),
    "instal_freq": ("frequency", "loan_install_freq_key", "inner"),
    "borrower_income": ("income", "borrower_income_key", "inner"),
    "age": ("age", "borrower_age_key", "left"),
    "occupation": ("occupation", "borrower_occupation_key", "inner"),
    "ln_purpose": ("purpose", "borrower_loan_purpose_key", "inner"),
    "suppress_indicator": ("suppress", "suppress_ind_key", "inner"),
    "min_amt_due": ("min_due", "min_due_key", "left"),
    "min_amt_due_calc": ("min_due", "min_due_calc_key", "left"),
    "min_amt_due_both": ("min_due", "min_due_both_key", "left"),
}
FACT_METRICS = ("total_centres", "total_groups", "total_accounts", "total_consumers", "total_outstanding_amount",
                "total_disbursed_amount", "total_overdue_amount", "total_write_off_amount", "oldest_loan")


def fact_keys(rollup: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Labels replaced by surrogate keys of the (fixed, small) label dimensions."""
    out = rollup
    for label, (dim, key, how) in FACT_KEYS.items():
        lookup = dims[dim].where(F.col("active") == 1).select(F.col("label").alias(label), F.col("key").alias(key))
        out = out.join(F.broadcast(lookup), label, how)
    keys = [key for _, key, _ in FACT_KEYS.values()]
    return out.select(
        "sdp_key", "contri_key", "load_yyyymm", "disb_yyyymm", "min_disb_yyyymm", "overdue_ind", "gender", *keys,
        *FACT_METRICS,
    )


# DPD band of the report -> positions in the 30-day DPD dimension
FACT_BANDS = {
    "0": (1, 15), "1_30": (2,), "31_60": (3,), "61_90": (4,), "91_180": (5, 6, 7),
    "181_360": (8, 9, 10, 11, 12, 13), "360_plus": (14,),
}
WRITTEN_OFF_IDS = (6, 10)


def par_report_from_fact(
    fact: DataFrame, lenders: DataFrame, categories: DataFrame, load_yyyymm: int
) -> DataFrame:
    """The risk report summed from fact rows of one month, without suppressed loans."""
    rows = fact.where((F.col("load_yyyymm") == load_yyyymm) & (F.col("suppress_ind_key") != 1))
    live = "loan_account_status_key = 1"
    off = f"das_id in {WRITTEN_OFF_IDS}"
    aggs = {
        "total_loans": "total_accounts", "total_disb_amount": "total_disbursed_amount",
        "active_loans": f"if({live}, total_accounts, 0)",
        "active_disb_amount": f"if({live}, total_disbursed_amount, 0)",
        "active_outstanding": f"if({live}, total_outstanding_amount, 0)",
        "total_written_off_loans": f"if({off}, total_accounts, 0)",
        "total_written_off_amount": f"if({off}, total_write_off_amount, 0)",
    }
    for band in BANDS:
        positions = ", ".join(str(n) for n in FACT_BANDS[band])
        test = f"{live} and loan_dpd_bucket_key in ({positions})"
        if band != "0":
            test += " and overdue_ind = 1"
        aggs[f"lar_{band}"] = f"if({test}, total_accounts, 0)"
        aggs[f"par_{band}"] = f"if({test}, total_outstanding_amount, 0)"
    named = rows.join(
        F.broadcast(lenders.where(F.col("active") == 1).select("contri_key", "lender_id", "institution_name")),
        "contri_key",
    ).join(
        F.broadcast(categories.where(F.col("active") == 1).select(
            F.col("category_key").alias("loan_account_type_key"), F.col("loan_category").alias("account_type"))),
        "loan_account_type_key",
    )
    report = named.groupBy("lender_id", F.col("institution_name").alias("institution"), "account_type").agg(
        *[F.expr(f"sum({aggs[m]}) as {m}") for m in METRICS]
    )
    month = F.make_date(F.lit(load_yyyymm // 100), F.lit(load_yyyymm % 100), F.lit(1))
    return report.select(month.alias("reported_dt"), "lender_id", "institution", "account_type", *METRICS)
