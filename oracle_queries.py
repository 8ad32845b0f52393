"""DuckDB statements that compute the same results as the registered Spark queries."""

from __future__ import annotations

BINDING = """
fx_base as (
  select c_custkey as k, c_nationkey, c_acctbal, c_mktsegment, count(o_orderkey) as n_orders,
         max(cast(o_orderdate as date)) as last_order
  from customer left join orders on o_custkey = c_custkey
  group by 1, 2, 3, 4
), fx_dated as (
  select *, last_order - cast(k * 7919 % 1800 as integer) as signup_date,
         case when last_order < date '2001-08-01' - 365 then last_order + 30 end as churn_date
  from fx_base
), billing as (
  select k as customer_id,
         case when c_mktsegment in ('AUTOMOBILE', 'BUILDING') then 'Month-to-month'
              when c_mktsegment in ('FURNITURE', 'HOUSEHOLD') then 'One year'
              else 'Two year' end as contract_type,
         if(k % 2 = 0, 'Yes', 'No') as paperless_billing,
         (['Electronic check', 'Mailed check', 'Bank transfer', 'Credit card'])[c_nationkey % 4 + 1]
           as payment_method,
         20 + (c_acctbal + 1000) / 100 as monthly_charges,
         (20 + (c_acctbal + 1000) / 100) * n_orders as total_charges
  from fx_dated where k % 13 <> 0
), services as (
  select c_custkey as customer_id,
         if(c_custkey % 10 = 0, 'No', 'Yes') as phone_service,
         if(c_custkey % 3 = 0, 'Yes', 'No') as multiple_lines,
         (['DSL', 'Fiber optic', 'No'])[c_custkey % 3 + 1] as internet_service,
         if(c_custkey % 4 = 0, 'Yes', 'No') as online_security,
         if(c_custkey % 5 = 1, 'Yes', 'No') as online_backup,
         if(c_custkey % 6 = 1, 'Yes', 'No') as device_protection,
         (['No', 'Yes', 'No internet service'])[c_nationkey % 3 + 1] as tech_support,
         if(c_custkey % 7 = 1, 'Yes', 'No') as streaming_tv,
         if(c_custkey % 8 = 1, 'Yes', 'No') as streaming_movies
  from customer where c_custkey % 11 <> 0
), customers as (
  select d.k as customer_id, if(d.k % 2 = 0, 'Female', 'Male') as gender,
         if(d.k % 5 = 0, 1, 0) as senior_citizen,
         if(d.k % 3 = 1, 'Yes', 'No') as partner, if(d.k % 4 = 1, 'Yes', 'No') as dependents,
         d.signup_date,
         case when d.k % 29 = 0 then 'Suspended' when d.churn_date is null then 'Active'
              else 'Churned' end as status,
         cast(date_diff('month', d.signup_date, coalesce(d.churn_date, date '2001-08-01'))
              as integer) as tenure_months,
         b.contract_type, b.payment_method, b.monthly_charges,
         if(d.churn_date is not null, 1, 0) as churn
  from fx_dated d left join billing b on b.customer_id = d.k
), churn_events as (
  select c.customer_id, d.churn_date, c.tenure_months, c.monthly_charges
  from customers c join fx_dated d on d.k = c.customer_id
  cross join (values (1), (2)) as copies(n)
  where d.churn_date is not null and (n = 1 or c.customer_id % 17 = 0)
), customer_activity as (
  select user_id as customer_id, signup_date, churn_date, cast(ts as date) as activity_date,
         case when event_type = 'click' then cast(ts as date) end as login_date,
         value as session_duration_minutes,
         case when event_type = 'error' then event_id end as support_ticket_id,
         case when event_type = 'error' then if(event_id % 3 = 0, 'Unresolved', 'Resolved') end
           as ticket_status,
         case when event_type = 'purchase' then if(event_id % 4 = 0, 'Late', 'OnTime') end
           as payment_status,
         case when event_type = 'purchase'
              then cast(date '2024-01-31' - cast(ts as date) as integer) end
           as days_since_last_payment
  from events left join fx_dated on k = user_id
), retention_campaigns as (
  select r_regionkey as campaign_id, r_name as campaign_name,
         date '2001-01-15' + 30 * r_regionkey as campaign_start_date
  from region
), retention_targets as (
  select n_regionkey as campaign_id, c_custkey as customer_id
  from customer join nation on n_nationkey = c_nationkey where c_custkey % 3 <> 0
  union all
  select n_regionkey, c_custkey + 1000000
  from customer join nation on n_nationkey = c_nationkey where c_custkey % 50 = 0
), churn_dataset as (
  select c.customer_id, gender, senior_citizen, partner, dependents, c.tenure_months,
         s.* exclude (customer_id), b.* exclude (customer_id),
         if(e.churn_date is null, 0, 1) as churn
  from customers c
  left join services s on s.customer_id = c.customer_id
  left join billing b on b.customer_id = c.customer_id
  left join churn_events e on e.customer_id = c.customer_id
  where signup_date >= date '1997-01-01' and status <> 'Suspended'
), signals as (
  select *, coalesce(contract_type = 'Month-to-month', false)::int as month_to_month_risk,
         coalesce(tenure_months <= 6, false)::int as new_customer_risk,
         coalesce(payment_method = 'Electronic check', false)::int as payment_risk,
         coalesce(monthly_charges > 70, false)::int as high_price_risk,
         coalesce(tech_support = 'No', false)::int as no_support_risk,
         month_to_month_risk + new_customer_risk + payment_risk + high_price_risk + no_support_risk
           as risk_score
  from churn_dataset
), scored as (
  select customer_id, churn as label, risk_score / 5.0::double as p,
         (risk_score / 5.0::double > 0.5)::int as prediction
  from signals
)"""


def _with(body: str, ctes: str = "") -> str:
    return f"with {BINDING.strip()}{ctes} {body.strip()}"


def base_tables() -> dict[str, str]:
    names = (
        "customers", "services", "billing", "churn_events", "customer_activity",
        "retention_campaigns", "retention_targets",
    )
    return {f"table_{name}": _with(f"select * from {name}") for name in names}


METRICS = """, metrics as (
  select customer_id,
         cast(date_diff('month', min(signup_date), coalesce(max(churn_date), date '2024-01-31'))
              as integer) as activity_tenure_months,
         cast(coalesce(max(churn_date), date '2024-01-31') - min(signup_date) as integer)
           as tenure_days,
         count(distinct login_date) as total_logins_last_90_days,
         floor(sum(session_duration_minutes::decimal(18, 6))::double / count(session_duration_minutes)
               * 1e6 + 0.5) / 1e6 as avg_session_duration,
         count(distinct support_ticket_id) as total_support_tickets,
         cast(sum(if(ticket_status = 'Unresolved', 1, 0)) as bigint) as unresolved_tickets,
         cast(sum(if(payment_status = 'Late', 1, 0)) as bigint) as late_payments,
         max(days_since_last_payment) as days_since_last_payment
  from customer_activity where activity_date >= date '2024-01-31' - 20
  group by customer_id
)"""


def reports() -> dict[str, str]:
    return {
        "churn_dataset": _with("select * from churn_dataset"),
        "activity_metrics": _with("select * from metrics", METRICS),
        "login_days": _with(
            """
            select customer_id, count(distinct login_date) as all_days,
                   count(distinct login_date) filter (where login_date >= date '2024-01-31' - 20) as days_20,
                   count(distinct login_date) filter (where login_date >= date '2024-01-31' - 90) as days_90
            from customer_activity where login_date is not null group by customer_id"""
        ),
        "customer_behavior": _with(
            """
            select c.* replace (round(monthly_charges, 6) as monthly_charges),
                   m.* exclude (customer_id, tenure_days),
                   case when activity_tenure_months <= 6 then 'New Customer'
                        when activity_tenure_months <= 24 then 'Regular Customer'
                        else 'Loyal Customer' end as customer_segment,
                   case when total_logins_last_90_days < 5 then 'Low Engagement'
                        when total_logins_last_90_days < 20 then 'Medium Engagement'
                        else 'High Engagement' end as engagement_level
            from customers c left join metrics m on m.customer_id = c.customer_id""",
            METRICS,
        ),
        "cohort_churn": _with(
            """
            select contract_type, payment_method, count(*) as total_customers,
                   cast(sum(churn) as bigint) as churned_customers,
                   round(avg(churn) * 100, 2) as churn_rate_pct,
                   round(avg(monthly_charges), 6) as avg_monthly_charges,
                   round(avg(tenure_months), 6) as avg_tenure_months
            from churn_dataset group by all"""
        ),
        "churn_trend": _with(
            """
            select cast(date_trunc('month', churn_date) as date) as churn_month,
                   count(*) as churned_customers,
                   round(avg(tenure_months), 6) as avg_tenure_at_churn,
                   round(avg(monthly_charges), 6) as avg_monthly_charges
            from churn_events where churn_date >= date '2001-08-01' - interval 24 month
            group by 1"""
        ),
        "risk_signals": _with(
            """
            select customer_id, month_to_month_risk, new_customer_risk, payment_risk,
                   high_price_risk, no_support_risk, risk_score
            from signals where churn = 0"""
        ),
        "high_risk_customers": _with(
            """
            select c.customer_id, c.gender, c.tenure_months, c.contract_type, c.monthly_charges,
                   c.payment_method, s.risk_score,
                   case s.risk_score when 3 then 'High Risk' else 'Critical Risk' end
                     as risk_category
            from customers c join signals s on s.customer_id = c.customer_id
            where s.churn = 0 and s.risk_score >= 3
            order by s.risk_score desc, c.monthly_charges desc nulls last, c.customer_id limit 100"""
        ),
        "campaign_impact": _with(
            """
            select t.campaign_id, any_value(campaign_name) as campaign_name,
                   count(distinct t.customer_id) as customers_targeted,
                   count(*) filter (where c.churn = 1) as churned_after_campaign,
                   round(count(*) filter (where c.churn = 1) * 100.0::double / count(*), 2)
                     as churn_rate_pct,
                   round(any_value(rate), 6) as baseline_churn_rate_pct,
                   round((any_value(rate)
                          - count(*) filter (where c.churn = 1) * 100.0::double / count(*))
                         / any_value(rate) * 100, 2) as retention_improvement_pct
            from retention_targets t
            join retention_campaigns r on r.campaign_id = t.campaign_id
            left join customers c on c.customer_id = t.customer_id
            cross join (select avg(churn) * 100 as rate from churn_dataset
                        where contract_type = 'Month-to-month') baseline
            where campaign_start_date >= date '2001-08-01' - interval 6 month
            group by t.campaign_id"""
        ),
        "data_quality": _with(
            """
            select unnest(['Total Records', 'Missing Customer IDs', 'Missing Tenure',
                           'Duplicate Customer IDs', 'Churn Rate', 'Class Imbalance Ratio']) as metric,
                   unnest([count(*)::double, count(*) - count(customer_id),
                           count(*) - count(tenure_months),
                           count(*) - count(distinct customer_id),
                           round(avg(churn) * 100, 2),
                           round((count(*) - sum(churn))::double / nullif(sum(churn), 0)::double, 2)
                          ]) as value
            from churn_dataset"""
        ),
    }


STRING_COLUMNS = (
    "gender", "partner", "dependents", "phone_service", "multiple_lines", "internet_service",
    "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv",
    "streaming_movies", "contract_type", "paperless_billing", "payment_method",
)
NUMBER_COLUMNS = ("senior_citizen", "tenure_months", "monthly_charges", "total_charges")
DERIVED_COLUMNS = (
    "tenure_years", "is_new_customer", "is_loyal_customer", "total_revenue", "avg_monthly_spend",
    "is_month_to_month",
)


def _mode(column: str) -> str:
    return (
        f"(select {column} from deduped where {column} is not null "
        f"group by 1 order by count(*) desc, 1 limit 1)"
    )


CLEANED = (
    """, deduped as (
  select * exclude (place) from (
    select *, row_number() over (partition by customer_id order by tenure_months) as place
    from churn_dataset) where place = 1
), cleaned as (
  select * replace (
    """
    + ",\n    ".join(
        [f"coalesce({c}, {_mode(c)}) as {c}" for c in STRING_COLUMNS]
        + [
            f"coalesce({c}, (select median({c}) from deduped)) as {c}"
            for c in ("monthly_charges", "total_charges")
        ]
    )
    + """) from deduped
), engineered as (
  select *, tenure_months / 12 as tenure_years, (tenure_months <= 6)::int as is_new_customer,
         (tenure_months >= 24)::int as is_loyal_customer,
         monthly_charges * tenure_months as total_revenue,
         monthly_charges * tenure_months / (tenure_months + 1) as avg_monthly_spend,
         (contract_type = 'Month-to-month')::int as is_month_to_month
  from cleaned
)"""
)

ENCODED = (
    CLEANED
    + """, codes as (
  select "column", "value", cast(row_number() over (partition by "column" order by "value") - 1
                                 as integer) as code
  from ("""
    + " union ".join(f"select '{c}' as \"column\", {c} as \"value\" from engineered" for c in STRING_COLUMNS)
    + """)
), encoded as (
  select * replace ("""
    + ", ".join(
        f"(select code from codes where \"column\" = '{c}' and \"value\" = {c}) as {c}"
        for c in STRING_COLUMNS
    )
    + """) from engineered
)"""
)

SPREAD = "(customer_id % 1000003 * 7919 + customer_id // 1000003 * 104729 + 42) % 1000003"
SPLIT = (
    CLEANED
    + f""", placed as (
  select *, row_number() over (partition by churn order by {SPREAD}, customer_id) as place,
         count(*) over (partition by churn) as n
  from deduped
), split as (
  select customer_id, churn, if(place <= round(n * 0.2), 'test', 'train') as split from placed
)"""
)


def cleaning() -> dict[str, str]:
    rounded = ", ".join(f"round({c}, 6) as {c}" for c in ("monthly_charges", "total_charges"))
    counted = STRING_COLUMNS + NUMBER_COLUMNS + ("customer_id", "churn")
    texts = ", ".join(f"'{c}'" for c in STRING_COLUMNS)
    return {
        "dedupe": _with("select * from deduped", CLEANED),
        "duplicate_report": _with(
            """select count(*) as n_records, count(distinct customer_id) as n_distinct,
                      count(*) - count(distinct customer_id) as n_removed from churn_dataset"""
        ),
        "table_shape": _with(
            """select count(*) as n_records, 21 as n_columns from churn_dataset"""
        ),
        "null_counts": _with(
            "select * from ("
            + " union all ".join(
                f"select '{c}' as \"column\", count(*) - count({c}) as n_missing from churn_dataset"
                for c in counted
            )
            + ") where n_missing > 0"
        ),
        "medians": _with(
            " union all ".join(
                f"select '{c}' as \"column\", round(median({c}), 6) as median from churn_dataset"
                for c in NUMBER_COLUMNS
            )
        ),
        "modes": _with(
            f"select unnest([{texts}]) as \"column\", unnest([{', '.join(_mode(c) for c in STRING_COLUMNS)}])"
            " as mode",
            CLEANED,
        ),
        "clean": _with(f"select * replace ({rounded}) from cleaned", CLEANED),
        "class_distribution": _with("select churn, count(*) as n from churn_dataset group by 1"),
        "imbalance_ratio": _with(
            """select round(min(n) / max(n), 6) as imbalance_ratio
               from (select count(*)::double as n from churn_dataset group by churn)"""
        ),
        "tenure_by_churn": _with(
            """select churn, round(median(tenure_months), 6) as median_tenure_months
               from churn_dataset group by 1"""
        ),
        "class_weights": _with(
            """select churn, count(*) as n,
                      round((select count(*) from churn_dataset)::double
                            / ((select count(distinct churn) from churn_dataset) * count(*)), 6)
                        as weight
               from churn_dataset group by 1"""
        ),
    }


#: The training part of the split, cut into five folds.
FOLDED = (
    SPLIT
    + f""", folded as (
  select customer_id, churn, (place > n // 5)::int + (place > n * 2 // 5)::int + (place > n * 3 // 5)::int
         + (place > n * 4 // 5)::int as fold
  from (select *, row_number() over (partition by churn order by {SPREAD}, customer_id) as place,
               count(*) over (partition by churn) as n
        from split where split = 'train')
)"""
)

PREPARED = (
    ENCODED
    + ", prepared as (select customer_id, churn, "
    + ", ".join(
        f"({c} - avg({c}) over ()) / if(stddev_pop({c}) over () = 0, 1, stddev_pop({c}) over ()) as {c}"
        for c in STRING_COLUMNS + NUMBER_COLUMNS + DERIVED_COLUMNS
    )
    + " from encoded)"
)


def _smote(names: list[str], source: str, ctes: str) -> str:
    """Oversampling of the churned rows of a table on the named features, by all pairs."""
    own = ", ".join(f"{c}::double as {c}" for c in names)
    gap = " + ".join(f"(q.{c} - p.{c}) * (q.{c} - p.{c})" for c in names)
    moved = ", ".join(f"round(q.{c} + along * (near.{c} - q.{c}), 6) as {c}" for c in names)
    return _with(
        f"""
        select customer_id, churn, {", ".join(f"round({c}::double, 6) as {c}" for c in names)}, 0::bigint as copy_no
        from {source}
        union all
        select q.customer_id, 1, {moved}, copy_no
        from copies q join near on near.customer_id = q.customer_id and near.place = q.choice""",
        ctes
        + f""", minority as (
  select customer_id, {own}, {SPREAD} as h, min(customer_id) over (partition by {", ".join(names)}) as pid,
         row_number() over (order by {SPREAD}, customer_id) as turn, count(*) over () as n
  from {source} where churn = 1
), near as (
  select q.customer_id, {", ".join(f"p.{c}" for c in names)},
         row_number() over (partition by q.customer_id order by {gap}, p.pid, p.customer_id) - 1 as place
  from minority q join minority p on p.customer_id <> q.customer_id
), copies as (
  select *, (h * 31 + copy_no * 17) % least(5, n - 1) as choice,
         ((h * 131 + copy_no * 7919 + 42) % 1000003)::double / 1000003 as along
  from (select *, unnest(range(1, needed // n + (turn <= needed % n)::int + 1)) as copy_no
        from minority cross join (
          select sum(1 - churn)::bigint - sum(churn)::bigint as needed from {source}))
)""",
    )


def features() -> dict[str, str]:
    names = STRING_COLUMNS + NUMBER_COLUMNS + DERIVED_COLUMNS
    return {
        "engineer": _with(
            "select * from engineered",
            CLEANED,
        ),
        "label_codes": _with("select * from codes", ENCODED),
        "feature_moments": _with(
            " union all ".join(
                f"select '{c}' as feature, round(avg({c}), 6) as mean, round(stddev_pop({c}), 6) as sd "
                "from encoded"
                for c in names
            ),
            ENCODED,
        ),
        "prepare": _with(
            "select customer_id, churn, "
            + ", ".join(
                f"round(({c} - avg({c}) over ()) / "
                f"if(stddev_pop({c}) over () = 0, 1, stddev_pop({c}) over ()), 6) as {c}"
                for c in names
            )
            + " from encoded",
            ENCODED,
        ),
        "stratified_split": _with("select * from split", SPLIT),
        "split_profile": _with(
            """select split, count(*) as n_records, cast(sum(churn) as bigint) as n_positive,
                      round(avg(churn), 6) as positive_rate from split group by 1""",
            SPLIT,
        ),
        "stratified_folds": _with(
            """select customer_id, churn,
                      cast((place > n // 5)::int + (place > n * 2 // 5)::int
                           + (place > n * 3 // 5)::int + (place > n * 4 // 5)::int as integer) as fold
               from placed""",
            SPLIT,
        ),
        "smote": _smote(["tenure_months", "monthly_charges"], "cleaned", CLEANED),
        "smote_prepared": _smote(names, "prepared", PREPARED),
        "rebalancing_gate": _with(
            """
            select contract_type, min(n) as smallest, max(n) as largest, min(n) / max(n) < 0.5 as needed
            from (select contract_type, churn, count(*) as n from churn_dataset where churn is not null group by all)
            group by all"""
        ),
        "model_round_trip": _with("select customer_id, true as same, true as is_share from cleaned", CLEANED),
        "driver_ranks": _with(
            """
            select report, (select count(*) - 2 from (unpivot (from encoded limit 1) on columns(*)::varchar))::int as n_features,
                   true as falls, 10 as in_report, 15 as in_chart, if(report = 'feature_importance', true, null) as sums_to_one
            from (values ('coefficients'), ('feature_importance')) as reports(report)""",
            ENCODED,
        ),
        "search_folds": _with(
            """
            select fold, held_out, held_out_churned, 2 * majority as training, majority as training_churned,
                   majority - minority as synthetic
            from (
              select f.fold, coalesce(sum((t.fold = f.fold)::int), 0)::bigint as held_out,
                     coalesce(sum((t.fold = f.fold and churn = 1)::int), 0)::bigint as held_out_churned,
                     sum((t.fold <> f.fold and churn = 0)::int)::bigint as majority,
                     sum((t.fold <> f.fold and churn = 1)::int)::bigint as minority
              from folded t cross join (select unnest(range(6))::int as fold) f group by 1)""",
            FOLDED,
        ),
        "run_facts": _with(
            """
            select 'data' as stage, 'n_features' as key, 25::double as value_double
            union all select 'data', 'n_' || split, count(*) from split group by split
            union all select 'data', 'churn_rate_' || split, round(avg(churn), 6) from split group by split
            union all select 'search', unnest(['C', 'penalty', 'n_estimators', 'max_depth', 'min_samples_leaf']), 1
            union all select 'search', unnest(['class_weight', 'cv_roc_auc']), 2
            union all select 'test', unnest(['accuracy', 'roc_auc', 'f1_score', 'churn_precision', 'churn_recall', 'churn_f1']), 2
            union all select 'selection', 'best_model', 1""",
            SPLIT,
        ),
    }


def _auc(score: str) -> str:
    """Pairwise definition of the area, computed from counts per score."""
    return f"""(select sum(a.pos * (b.neg * (b.p < a.p)::int + 0.5::double * b.neg * (b.p = a.p)::int))
                       / (sum(a.pos * b.neg))
                from (select p, count(*) filter (where label = 1) as pos from {score} group by p) a
                cross join (select p, count(*) filter (where label = 0) as neg from {score} group by p) b)"""


def _metrics(score: str) -> str:
    return f"""
      round(avg((label = prediction)::int), 6) as accuracy,
      round({_auc(score)}, 6) as roc_auc,
      round(coalesce(2.0::double * sum(label * prediction) / nullif(sum(label) + sum(prediction), 0), 0), 6)
        as f1_score,
      round(coalesce(sum(label * prediction)::double / nullif(sum(prediction), 0), 0), 6)
        as churn_precision,
      round(coalesce(sum(label * prediction)::double / nullif(sum(label), 0), 0), 6) as churn_recall,
      round(coalesce(2.0::double * sum(label * prediction) / nullif(sum(label) + sum(prediction), 0), 0), 6)
        as churn_f1 from {score}"""


MODELS = """, contract_rule as (
  select churn as label, month_to_month_risk::double as p, (month_to_month_risk > 0.5)::int as prediction
  from signals
), tenure_rule as (
  select churn as label, 1.0::double / (tenure_months + 1) as p,
         (1.0::double / (tenure_months + 1) > 0.05)::int as prediction
  from signals
)"""

COMPARISON = " union all ".join(
    f"select '{model}' as model, {order} as train_order, {_metrics(table)}"
    for order, (model, table) in enumerate(
        {"risk_score": "scored", "contract": "contract_rule", "tenure": "tenure_rule"}.items()
    )
)


def _curve(scored: str, all_points: bool, digits: int = 6) -> str:
    return _with(
        f"""
        select null::double as threshold, 0.0::double as fpr, 0.0::double as tpr
        union all
        select round(p, {digits}), round(n::double / (select sum(1 - label) from {scored}), {digits}),
               round(m::double / (select sum(label) from {scored}), {digits})
        from (select *, sum(pos) over down as m, sum(neg) over down as n, row_number() over down as place,
                     lead(pos) over down as next_pos, lead(neg) over down as next_neg
              from (select p, sum(label) as pos, sum(1 - label) as neg from {scored} group by p)
              window down as (order by p desc))
        where {all_points} or place = 1 or next_pos is null or next_pos <> pos or next_neg <> neg"""
    )


#: A score between 0 and 1 with nearly as many values as customers.
FINE = """, fine as (
  select churn as label, 1000 / (coalesce(total_charges, 0) + customer_id / 1e6::double + 1000) as p from churn_dataset
)"""


def evaluation() -> dict[str, str]:
    order = "order by p desc, customer_id, label"
    return {
        "rule_scores": _with("select * from scored"),
        "confusion_matrix": _with(
            """select label, prediction, count(s.p) as n
               from (values (0), (1)) as actual(label) cross join (values (0), (1)) as said(prediction)
               left join scored s using (label, prediction) group by 1, 2"""
        ),
        "classification_report": _with(
            """
            select "class", round(p, 6) as "precision", round(r, 6) as recall, round(f, 6) as f1_score,
                   support from per_class
            union all
            select 'accuracy', round(a, 6), round(a, 6), round(a, 6), n
            from (select avg((label = prediction)::int) as a, count(*) as n from scored)
            union all
            select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
                   sum(support)::bigint from per_class
            union all
            select 'weighted avg', round(sum(p * support) / sum(support), 6),
                   round(sum(r * support) / sum(support), 6),
                   round(sum(f * support) / sum(support), 6), sum(support)::bigint from per_class""",
            """, per_class as (
  select c::varchar as "class", coalesce(tp::double / nullif(predicted, 0), 0) as p,
         coalesce(tp::double / nullif(support, 0), 0) as r,
         coalesce(2 * tp::double / nullif(predicted + support, 0), 0) as f, support
  from (select c, count(*) filter (where label = c and prediction = c) as tp,
               count(*) filter (where prediction = c) as predicted,
               count(*) filter (where label = c) as support
        from scored cross join (values (0), (1)) as classes(c) group by c)
)""",
        ),
        "roc_auc": _with(f"select round({_auc('scored')}, 6) as roc_auc"),
        "roc_curve": _curve("scored", False),
        "roc_curve_all": _curve("scored", True),
        "roc_curve_fine": _curve(
            "(select churn as label, coalesce(total_charges, 0) + customer_id / 1e6::double as p from churn_dataset)",
            False, 5,
        ),
        "auc_bounds": _with(
            " union all ".join(
                f"""
                select round(sum(pos * below) / sum(pos) / sum(neg), 6) as lower,
                       round(sum(pos * (below + neg)) / sum(pos) / sum(neg), 6) as upper, {bins} as bins,
                       round((select {_auc('fine')}), 6) as exact, true as encloses
                from (select *, coalesce(sum(neg) over (order by bin rows between unbounded preceding and 1 preceding), 0)
                        as below
                      from (select floor(p * {bins}) as bin, sum(label)::double as pos, sum(1 - label)::double as neg
                            from fine group by 1))"""
                for bins in (50, 1000)
            ),
            FINE,
        ),
        "binned_roc_curve": _with(
            """
            select bin::int as bin, round(sum(neg) over (order by bin desc) / sum(neg) over (), 6) as fpr,
                   round(sum(pos) over (order by bin desc) / sum(pos) over (), 6) as tpr
            from (select floor(p * 50) as bin, sum(label)::double as pos, sum(1 - label)::double as neg
                  from fine group by 1)""",
            FINE,
        ),
        "metric_summary": _with(f"select {_metrics('scored')}"),
        "model_comparison": _with(COMPARISON, MODELS),
        "best_model": _with(
            f"select * from ({COMPARISON}) order by roc_auc desc, train_order limit 1", MODELS
        ),
        "decile_lift": _with(
            f"""
            select tile::int as tile, count(*) as customers, sum(label)::bigint as churners,
                   round(avg(label), 6) as churn_rate,
                   round(sum(sum(label)) over (order by tile)::double / (select sum(label) from scored), 6)
                     as cumulative_capture,
                   round(avg(label) / (select avg(label) from scored), 6) as lift
            from (select label, ntile(10) over ({order}) as tile from scored) group by tile"""
        ),
        "high_risk_band": _with(
            f"""
            select fraction, count(*) as customers, sum(label)::bigint as churners,
                   round(avg(label), 6) as churn_rate,
                   round(avg(label) / (select avg(label) from scored), 6) as lift
            from (select label, row_number() over ({order}) as place, count(*) over () as n from scored)
            cross join (values (0.15::double), (0.2::double)) as bands(fraction)
            where place <= round(n * fraction) group by fraction"""
        ),
        "retention_impact": _with(
            """
            select round(base, 6) as baseline_retention_rate, round(new, 6) as new_retention_rate,
                   round((new - base) / base * 100, 6) as retention_improvement_pct,
                   targeted as customers_targeted, saved as customers_saved,
                   saved * 1200 as annual_revenue_saved
            from (select 1 - avg(label) as base, 1 - (sum(label) - saved)::double / count(*) as new,
                         targeted, saved
                  from scored cross join (
                    select count(*) filter (where p > 0.5) as targeted, targeted // 2 as saved
                    from scored)
                  group by targeted, saved)"""
        ),
        "impact_scenarios": _with(
            """
            select threshold, success_rate, count(*) filter (where p > threshold) as customers_targeted,
                   floor(count(*) filter (where p > threshold) * success_rate)::bigint
                     as customers_saved,
                   round(floor(count(*) filter (where p > threshold) * success_rate)::double
                         / sum(label), 6) as churn_reduction
            from scored
            cross join (values (0.3::double), (0.5::double), (0.7::double)) as cuts(threshold)
            cross join (values (0.45::double), (0.5::double), (0.55::double)) as rates(success_rate)
            group by 1, 2"""
        ),
    }


def sources() -> dict[str, str]:
    return {
        "csv_round_trip": _with("select * from churn_dataset"),
        "csv_texts": """
            select doc_id, 'say "hi", ok' || chr(10) || ' ' || replace(text, chr(13), '') || ' ' as note,
              (['none', 'Na', ' NA ', '1D', null, null, '-1', 'True'])[doc_id % 8 + 1] as "like"
            from documents""",
        "report_round_trip": evaluation()["retention_impact"],
        "medians_with_infinity": _with(
            """
            select 'charges' as "column", round(median(case when customer_id % 5 = 0 then 'inf'::double
              when customer_id % 7 = 0 then '-inf'::double else monthly_charges end), 6) as median
            from churn_dataset"""
        ),
        "test_part_prepared": _with(
            "select customer_id, churn, "
            + ", ".join(
                f"round(({c} - (select avg({c}) from train)) / (select if(stddev_pop({c}) = 0, 1, stddev_pop({c})) "
                f"from train), 6) as {c}"
                for c in STRING_COLUMNS + NUMBER_COLUMNS + DERIVED_COLUMNS
            )
            + " from encoded where customer_id in (select customer_id from split where split = 'test')",
            ENCODED
            + SPLIT.removeprefix(CLEANED)
            + """, train as (
  select * from encoded where customer_id in (select customer_id from split where split = 'train')
)""",
        ),
        "cohort_sql": _with(
            """
            select contract_type, payment_method, count(*) as total_customers,
                   cast(sum(churn) as bigint) as churned_customers,
                   round(avg(monthly_charges), 6) as avg_monthly_charges
            from churn_dataset group by all"""
        ),
        "date_functions": _with(
            """
            select k as customer_id,
                   cast(date_diff('month', signup_date, until) as integer) as months_crossed,
                   cast(until - signup_date as integer) as days_between,
                   signup_date - 90 as days_back,
                   cast(signup_date - interval 12 month as date) as months_back,
                   cast(date_trunc('month', signup_date) as date) as month_start, until as end_date
            from (select k, signup_date, coalesce(churn_date, date '2001-08-01') as until from fx_dated)"""
        ),
        "value_functions": _with(
            """
            select customer_id, abs(monthly_charges - 70) as charge_gap,
                   floor(monthly_charges / 7 * 100 + 0.5) / 100 as weekly_charge,
                   monthly_charges / nullif(tenure_months - 6, 0) as charge_per_month_past_six,
                   if(monthly_charges > 70, 1, 0) as is_expensive,
                   coalesce(tech_support, 'nan') as support_token,
                   floor(total_charges)::bigint as whole_charges
            from churn_dataset"""
        ),
    }


#: Queries that take another path to the same rows.
TWINS = {
    "prepare_with_extra_text": "prepare",
    "smote_boxed": "smote", "label_codes_sliced": "label_codes", "medians_narrowed": "medians",
    "churn_dataset_salted": "churn_dataset", "churn_dataset_stored": "churn_dataset",
    "activity_metrics_stored": "activity_metrics", "activity_metrics_stored_90": "activity_metrics_90",
}


def oracle_sql() -> dict[str, str]:
    found = {
        **base_tables(), **sources(), **reports(), **cleaning(), **features(), **evaluation(),
    }
    twenty, ninety = "date '2024-01-31' - 20", "date '2024-01-31' - 90"
    wide = {f"{name}_90": found[name].replace(twenty, ninety) for name in ("activity_metrics", "customer_behavior")}
    found |= wide
    return found | {twin: found[name] for twin, name in TWINS.items()}
