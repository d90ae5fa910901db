"""The operators and column builders on the given tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from pavilion.functions import (
    band, contains_label, date_parts, fill_blank, high_impact, is_true, map_codes, normalise_name,
    parse_date, standardise, whole_or_zero, year_after_days_back,
)
from pavilion.operators import (
    density, distinct_values, drop_empty_rows, group_mean, group_stats, group_sum, histogram, joined_mean,
    keep_one, lookup_codes, lookup_left, mean_of_group_sums, ranked, require_keys, running_total,
    totals_by_column, value_counts,
)
from pavilion.sources import row_counts
from testbed.registry import given, query

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def quantity():
    return F.col("l_quantity").cast("int").alias("runs")


# DuckDB has no initcap: title-case the first letter of every space-separated word. The
# title case of a sharp s is two letters.
TITLE = (
    "list_aggregate(list_transform(string_split({0}, ' '),"
    " lambda w: case w[1] when 'ß' then 'Ss' else upper(w[1]) end || w[2:]), 'string_agg', ' ')"
)


@query("""
    select l_orderkey, l_linenumber, l_suppkey from lineitem where l_returnflag = 'N' and l_linestatus = 'F'
""")
def legal_rows(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").filter((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey")


@query("""
    select l_orderkey, l_linestatus, cast(sum(cast(l_quantity as int)) as bigint) as total_runs,
           avg(cast(l_quantity as int)) as average_runs
    from lineitem where l_returnflag <> 'R' group by l_orderkey, l_linestatus
""")
def group_sum_avg(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").filter("l_returnflag <> 'R'")
    keys = ["l_orderkey", "l_linestatus"]
    stats = group_stats(rows.select(*keys, quantity()), keys, "runs", "total_runs", "average_runs")
    return ranked(stats, [F.desc("total_runs")], keys)


@query("""
    select distinct l_orderkey, l_linenumber, cast(sum(cast(l_quantity as int)) over (
        partition by l_orderkey, l_linestatus order by l_linenumber) as bigint) as running_total
    from lineitem
""")
def running_totals(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").select("l_orderkey", "l_linestatus", "l_linenumber", quantity())
    totals = running_total(rows, ["l_orderkey", "l_linestatus"], "l_linenumber", "runs", "running_total")
    return totals.drop("l_linestatus").distinct()


@query("""
    select distinct l_suppkey, cast(l_shipdate as date) as day, cast(sum(cast(l_quantity as int)) over (
        partition by l_suppkey order by cast(l_shipdate as date)) as bigint) as running_total
    from lineitem
""")
def running_totals_by_date(spark, sf_dir):
    """Blocks of 90 days, so that every group spans many blocks."""
    rows = given(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"), quantity())
    return running_total(rows, ["l_suppkey"], "day", "runs", "running_total", block=90)


@query("""
    select distinct o_custkey, o_orderkey * o_orderkey * 1000003 as place, cast(sum(cast(floor(o_totalprice) as bigint)) over (
        partition by o_custkey order by o_orderkey * o_orderkey * 1000003) as bigint) as running_total
    from orders
""")
def running_totals_sparse(spark, sf_dir):
    """Order values far apart: hardly two of them lie in one block of the lowest level.

    A long as in the SQL where all of them fit, else a decimal of 38 digits, which DuckDB's bigint has no room for.
    """
    rows = given(spark, sf_dir, "orders")
    ends = rows.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    fits = all(end is None or end * end * 1000003 < 1 << 63 for end in ends)
    key = F.col("o_orderkey") if fits else F.col("o_orderkey").cast("decimal(19,0)")
    place = (key * key * 1000003).cast("long" if fits else "decimal(38,0)")
    rows = rows.select("o_custkey", place.alias("place"), F.floor("o_totalprice").alias("price"))
    return running_total(rows, ["o_custkey"], "place", "price", "running_total")


@query("""
    select distinct event_type, epoch_us(ts) as micros, cast(sum(cast(floor(value) as bigint)) over (
        partition by event_type order by ts) as bigint) as running_total
    from events
""")
def running_totals_by_time(spark, sf_dir):
    rows = given(spark, sf_dir, "events").select("event_type", "ts", F.floor("value").alias("points"))
    totals = running_total(rows, ["event_type"], "ts", "points", "running_total", block=4096)
    return totals.select("event_type", F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', ts)").alias("micros"), "running_total")


@query("""
    select distinct o_orderpriority, o_totalprice, cast(count(*) over (partition by o_orderpriority order by o_totalprice) as bigint) as running_total
    from orders
""")
def running_totals_by_price(spark, sf_dir):
    """Ordered by a double: ranges cut at sampled values."""
    rows = given(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", F.lit(1).alias("one"))
    return running_total(rows, ["o_orderpriority"], "o_totalprice", "one", "running_total", ranges=64)


@query("""
    select distinct p_brand, p_name, cast(sum(p_size) over (partition by p_brand order by p_name) as bigint) as running_total from part
""")
def running_totals_by_name(spark, sf_dir):
    """Ordered by a string."""
    return running_total(given(spark, sf_dir, "part"), ["p_brand"], "p_name", "p_size", "running_total", ranges=8)


@query("""
    select a.l_suppkey, s.s_name, a.season, a.total_runs
    from (select l_suppkey, cast(year(l_shipdate) as int) as season,
                 cast(sum(cast(l_quantity as int)) as bigint) as total_runs
          from lineitem group by l_suppkey, cast(year(l_shipdate) as int)) a
    left join (select case when s_acctbal >= 0 then s_suppkey end as id, s_name from supplier) s on a.l_suppkey = s.id
""")
def season_scorers_named(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("season"), quantity())
    totals = group_sum(rows, ["l_suppkey", "season"], "runs", "total_runs")
    names = given(spark, sf_dir, "supplier").select(F.expr("case when s_acctbal >= 0 then s_suppkey end").alias("id"), "s_name")
    return lookup_left(totals, names, "l_suppkey", "id", ["s_name"]).select(
        "l_suppkey", "s_name", "season", "total_runs"
    )


@query("select cast(o_orderdate as date) as match_date, o_orderkey from orders order by o_orderdate, o_orderkey limit 1")
def first_event(spark, sf_dir):
    rows = given(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("match_date"), "o_orderkey")
    return ranked(rows, ["match_date"], ["o_orderkey"], 1)


@query("select strftime(o_orderdate, '%-m/%-d/%Y') as match_date, o_orderkey from orders order by 1, 2 limit 1")
def first_by_string(spark, sf_dir):
    rows = given(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "M/d/yyyy").alias("match_date"), "o_orderkey")
    return ranked(rows, ["match_date"], ["o_orderkey"], 1)


@query("""
    select l_orderkey, l_linenumber, cast(l_quantity as int) + cast(round(l_discount*100) as int) as total,
           case when cast(l_quantity as int) + cast(round(l_discount*100) as int) > 55
                  or (case l_returnflag when 'R' then 1 when 'A' then 0 end) = 0
                then true else false end as high_impact
    from lineitem
""")
def high_impact_rows(spark, sf_dir):
    total = F.col("l_quantity").cast("int") + F.round(F.col("l_discount") * 100).cast("int")
    wicket = F.expr("case l_returnflag when 'R' then 1 when 'A' then 0 end")
    return given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", total.alias("total"), high_impact(total, wicket, above=55).alias("high_impact")
    )


@query("""
    select o_orderkey, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
           cast(day(o_orderdate) as int) as day
    from orders
""")
def order_date_parts(spark, sf_dir):
    return given(spark, sf_dir, "orders").withColumns(date_parts(F.col("o_orderdate"))).select("o_orderkey", "year", "month", "day")


@query("""
    select o_orderkey, case when o_totalprice >= 400000 then 'High'
                            when o_totalprice >= 200000 and o_totalprice < 400000 then 'Medium'
                            else 'Low' end as win_margin_category
    from orders
""")
def margin_class(spark, sf_dir):
    label = band(F.col("o_totalprice"), [(200000, "Medium"), (400000, "High")], "Low")
    return given(spark, sf_dir, "orders").select("o_orderkey", label.alias("win_margin_category"))


@query("select p_partkey, lower(regexp_replace(p_brand, '[^a-zA-Z0-9]', '', 'g')) as brand from part")
def normalised_text(spark, sf_dir):
    return given(spark, sf_dir, "part").select("p_partkey", normalise_name(F.col("p_brand")).alias("brand"))


@query("select doc_id, lower(regexp_replace(text, '[^a-zA-Z0-9]', '', 'g')) as text from documents")
def normalised_documents(spark, sf_dir):
    return given(spark, sf_dir, "documents").select("doc_id", normalise_name(F.col("text")).alias("text"))


@query("""
    select p_partkey, case when p_name like '%red%' then 'Left-Handed' else 'Right-Handed' end as style from part
""")
def contains_class(spark, sf_dir):
    label = contains_label(F.col("p_name"), "red", "Left-Handed", "Right-Handed")
    return given(spark, sf_dir, "part").select("p_partkey", label.alias("style"))


DIRTY_SEGMENT = (
    "case c_mktsegment when 'BUILDING' then '  ' when 'FURNITURE' then null"
    " else '  ' || c_mktsegment || '   a-b  ' || c_name || ' ' end"
)


@query(f"""
    select c_custkey, {TITLE.format("regexp_replace(trim(lower(filled)), ' +', ' ', 'g')")} as s
    from (select c_custkey, case when raw is null or trim(raw) = '' then 'BLANK' else raw end as filled
          from (select c_custkey, {DIRTY_SEGMENT} as raw from customer) a) b
""")
def standardised_text(spark, sf_dir):
    rows = given(spark, sf_dir, "customer").select("c_custkey", F.expr(DIRTY_SEGMENT).alias("raw"))
    return rows.select("c_custkey", standardise(fill_blank(F.col("raw"))).alias("s"))


@query(f"""
    select conv_id, turn, {TITLE.format("regexp_replace(trim(lower(text)), ' +', ' ', 'g')")} as text from conversations
""")
def standardised_conversations(spark, sf_dir):
    return given(spark, sf_dir, "conversations").select("conv_id", "turn", standardise(F.col("text")).alias("text"))


@query("""
    select o_orderkey, cast(case when regexp_matches(r, '^\\d{1,2}/\\d{1,2}/\\d{4}$') then try_strptime(r, '%m/%d/%Y')
                                 when regexp_matches(r, '^\\d{2}-\\d{2}-\\d{4}$') then try_strptime(r, '%d-%m-%Y')
                            end as date) as d
    from (select o_orderkey, case o_orderkey % 5 when 0 then strftime(o_orderdate, '%-m/%-d/%Y')
                                                 when 1 then strftime(o_orderdate, '%d-%m-%Y')
                                                 when 2 then strftime(o_orderdate, '%Y-%m-%d')
                                                 when 3 then '31-02-2013' else ' ' end as r
          from orders) t
""")
def parsed_dates(spark, sf_dir):
    day = F.col("o_orderdate")
    shape = F.col("o_orderkey") % 5
    raw = (
        F.when(shape == 0, F.date_format(day, "M/d/yyyy")).when(shape == 1, F.date_format(day, "dd-MM-yyyy"))
        .when(shape == 2, F.date_format(day, "yyyy-MM-dd")).when(shape == 3, "31-02-2013").otherwise(" ")
    )
    rows = given(spark, sf_dir, "orders").select("o_orderkey", raw.alias("r"))
    return rows.select("o_orderkey", parse_date(F.col("r")).alias("d"))


@query("select l_orderkey, l_linenumber, coalesce(nullif(l_linenumber, 3), 0) as over_id from lineitem")
def filled_integers(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").withColumn("over_id", F.expr("nullif(l_linenumber, 3)"))
    return rows.select("l_orderkey", "l_linenumber", whole_or_zero(F.col("over_id"), rows.schema["over_id"].dataType).alias("over_id"))


@query("""
    select l_orderkey, l_linenumber, coalesce(case when number = floor(number) then cast(number as int) end, 0) as n
    from (select l_orderkey, l_linenumber, try_cast(case l_linenumber when 1 then ' 12 ' when 2 then '' when 3 then null
                 when 4 then 'x7' when 5 then '2.0' when 6 then '1e3' else '2.5' end as double) as number from lineitem) t
""")
def filled_integer_text(spark, sf_dir):
    raw = F.expr(
        "case l_linenumber when 1 then ' 12 ' when 2 then '' when 3 then null when 4 then 'x7'"
        " when 5 then '2.0' when 6 then '1e3' else '2.5' end"
    )
    rows = given(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return rows.select("l_orderkey", "l_linenumber", whole_or_zero(F.col("raw"), rows.schema["raw"].dataType).alias("n"))


@query("select o_orderkey from orders where nullif(o_orderstatus, 'P') is not null and nullif(o_orderpriority, '5-LOW') is not null")
def key_filter(spark, sf_dir):
    rows = given(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "nullif(o_orderstatus, 'P') as k1", "nullif(o_orderpriority, '5-LOW') as k2"
    )
    return require_keys(rows, ["k1", "k2"]).select("o_orderkey")


@query("""
    select n, f from (select nullif(l_linenumber, 3) as n, nullif(l_returnflag, 'R') as f from lineitem) t
    where n is not null or f is not null
""")
def empty_rows_dropped(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem")
    return drop_empty_rows(rows.selectExpr("nullif(l_linenumber, 3) as n", "nullif(l_returnflag, 'R') as f"))


@query("""
    select l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity
    from (select *, row_number() over (partition by l_orderkey, l_linenumber
              order by l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) as rn from lineitem) t
    where rn = 1
""")
def dedup_keep_first(spark, sf_dir):
    order = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    kept = keep_one(given(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")


@query("""
    select n_nationkey, case cast(n_regionkey as string) when '0' then 'Zero' when '1' then 'One'
                        else cast(n_regionkey as string) end as region
    from nation
""")
def code_map(spark, sf_dir):
    return given(spark, sf_dir, "nation").select(
        "n_nationkey", map_codes(F.col("n_regionkey"), {"0": "Zero", "1": "One"}).alias("region")
    )


@query("""
    select c_custkey, coalesce(r_name, cast(c_nationkey as string)) as c_nationkey
    from customer left join region on c_nationkey = r_regionkey
""")
def code_lookup(spark, sf_dir):
    coded = given(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return lookup_codes(coded, "c_nationkey", given(spark, sf_dir, "region"), "r_regionkey", "r_name")


@query("""
    select l_orderkey, l_linenumber, coalesce(cast(lower(flag) in ('true', '1') as boolean), false) as flag,
           l_linenumber = 1 as first
    from (select *, case l_returnflag when 'R' then 'TRUE' when 'A' then '0' end as flag from lineitem) t
""")
def true_flags(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").withColumn(
        "flag", F.expr("case l_returnflag when 'R' then 'TRUE' when 'A' then '0' end")
    )
    return rows.select(
        "l_orderkey", "l_linenumber", is_true(F.col("flag")).alias("flag"), is_true(F.col("l_linenumber")).alias("first")
    )


@query("""
    select l_suppkey, cast(sum(cast(l_quantity as int)) as bigint) as runs_scored
    from lineitem group by l_suppkey order by runs_scored desc, l_suppkey limit 10
""")
def top10_sum(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").select("l_suppkey", quantity())
    return ranked(group_sum(rows, ["l_suppkey"], "runs", "runs_scored"), [F.desc("runs_scored")], ["l_suppkey"], 10)


@query("select o_orderstatus as value, count(*) as count from orders where o_orderstatus is not null group by o_orderstatus")
def count_by_value(spark, sf_dir):
    return value_counts(given(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "value"), "value", by_value=True)


@query("select p_name as value, count(*) as count from part group by p_name order by count desc, value limit 10")
def top10_values(spark, sf_dir):
    return value_counts(given(spark, sf_dir, "part").withColumnRenamed("p_name", "value"), "value", 10)


@query("""
    select coalesce(nullif(source, 'src7'), 'Unknown') as source, count(*) as count from documents
    where source <> 'src1' group by 1
""")
def counts_with_unknown(spark, sf_dir):
    rows = given(spark, sf_dir, "documents").select(F.expr("nullif(source, 'src7')").alias("source"))
    return value_counts(rows.fillna("Unknown", ["source"]), "source", exclude=["src1"])


@query("""
    select user_id, count(*) as count from events where event_type = 'purchase'
    group by user_id order by count desc, user_id limit 10
""")
def filtered_top10(spark, sf_dir):
    return value_counts(given(spark, sf_dir, "events").filter("event_type = 'purchase'"), "user_id", 10)


@query("select distinct cast(year(nullif(l_shipdate, timestamp '2000-01-01')) as int) as season from lineitem where nullif(l_shipdate, timestamp '2000-01-01') is not null")
def distinct_seasons(spark, sf_dir):
    season = F.expr("year(nullif(l_shipdate, timestamp_ntz '2000-01-01'))").alias("season")
    return distinct_values(given(spark, sf_dir, "lineitem").select(season), "season")


@query("""
    select 'quantity' as name, cast(sum(cast(l_quantity as int)) as bigint) as total from lineitem
    union all select 'returned', cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) from lineitem
    union all select 'discounted', cast(sum(case when l_discount > 0 then 1 else 0 end) as bigint) from lineitem
    union all select 'never', cast(0 as bigint)
""")
def column_totals(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        (F.col("l_discount") > 0).cast("int").alias("discounted"),
        F.lit(None).cast("int").alias("never"),
    )
    return totals_by_column(rows, rows.columns)


@query("select l_linenumber, avg(cast(l_quantity as int)) as runs_scored from lineitem group by l_linenumber")
def group_means(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").select("l_linenumber", quantity())
    return group_mean(rows, ["l_linenumber"], "runs", "runs_scored")


@query("""
    select cast(year(o.o_orderdate) as int) as season, avg(cast(l_quantity as int)) as runs_scored
    from lineitem l left join orders o on l.l_orderkey = o.o_orderkey
    where o.o_orderdate is not null group by cast(year(o.o_orderdate) as int)
""")
def joined_group_mean(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").select("l_orderkey", quantity())
    seasons = given(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"))
    return joined_mean(rows, seasons, "l_orderkey", "o_orderkey", "season", "runs", "runs_scored")


@query("""
    select o.o_orderpriority, avg(t.total) as avg_runs
    from (select l_orderkey, cast(sum(cast(l_quantity as int)) as bigint) as total from lineitem group by l_orderkey) t
    left join orders o on t.l_orderkey = o.o_orderkey group by o.o_orderpriority
""")
def two_level_avg(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").select("l_orderkey", quantity())
    orders = given(spark, sf_dir, "orders")
    return mean_of_group_sums(rows, orders, "l_orderkey", "o_orderkey", "o_orderpriority", "runs", "avg_runs")


@query("""
    select o_orderkey, cast(year(date '2024-01-01' - cast(year(o_orderdate) as int)) as int) as y,
           2024 - cast(year(o_orderdate) as int) as years
    from orders
""")
def years_since(spark, sf_dir):
    season, as_of = F.year("o_orderdate"), F.lit("2024-01-01").cast("date")
    return given(spark, sf_dir, "orders").select(
        "o_orderkey", year_after_days_back(as_of, season).alias("y"), (F.year(as_of) - season).alias("years")
    )


@query("""
    select b.bin, lo + (hi - lo) / 30 * (b.bin - 1) as lo, lo + (hi - lo) / 30 * b.bin as hi,
           cast(coalesce(h.n, 0) as bigint) as count
    from (select cast(range as int) as bin from range(1, 31)) b
    cross join (select min(o_totalprice) lo, max(o_totalprice) hi from orders) e
    left join (select least(cast(floor((o_totalprice - lo) * 30 / (hi - lo)) as int) + 1, 30) as bin, count(*) as n
               from orders cross join (select min(o_totalprice) lo, max(o_totalprice) hi from orders) m group by 1) h
      on b.bin = h.bin
""")
def histogram30(spark, sf_dir):
    return histogram(given(spark, sf_dir, "orders"), "o_totalprice")


@query("""
    select cast(g.i as int) as i, s.lo + (s.hi - s.lo) * g.i / 199 as x,
           round(sum(v.n * exp(-0.5 * power((s.lo + (s.hi - s.lo) * g.i / 199.0 - v.x) / s.h, 2)))
                 / (max(s.c) * max(s.h) * sqrt(2 * pi())), 9) as density
    from (select l_quantity as x, count(*) as n from lineitem group by l_quantity) v
    cross join (select min(l_quantity) lo, max(l_quantity) hi, cast(count(*) as double) c,
                       stddev_samp(l_quantity) * power(cast(count(*) as double), -0.2) h from lineitem) s
    cross join (select range as i from range(0, 200)) g group by g.i, s.lo, s.hi
""")
def density200(spark, sf_dir):
    curve = density(given(spark, sf_dir, "lineitem"), "l_quantity")
    return curve.withColumn("density", F.round("density", 9))


@query("""
    select cast(g.i as int) as i, s.lo + (s.hi - s.lo) * g.i / 49 as x,
           round(sum(v.n * exp(-0.5 * power((s.lo + (s.hi - s.lo) * g.i / 49.0 - v.x) / s.h, 2)))
                 / (max(s.c) * max(s.h) * sqrt(2 * pi())), 12) as density
    from (select o_totalprice as x, count(*) as n from orders group by o_totalprice) v
    cross join (select min(o_totalprice) lo, max(o_totalprice) hi, cast(count(*) as double) c,
                       stddev_samp(o_totalprice) * power(cast(count(*) as double), -0.2) h from orders) s
    cross join (select range as i from range(0, 50)) g group by g.i, s.lo, s.hi
""")
def density_of_prices(spark, sf_dir):
    """Over a column in which nearly every value is its own."""
    curve = density(given(spark, sf_dir, "orders"), "o_totalprice", points=50)
    return curve.withColumn("density", F.round("density", 12))


@query(" union all ".join(f"select '{t}' as \"table\", count(*) as rows from {t}" for t in GIVEN))
def table_row_counts(spark, sf_dir):
    return row_counts({t: given(spark, sf_dir, t) for t in GIVEN})
