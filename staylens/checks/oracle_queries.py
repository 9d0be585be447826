"""Oracle SQL (DuckDB) for each registered query, keyed like
``staylens.plans.registry.QUERIES``."""

from __future__ import annotations

from staylens.checks.oracle_sql import (
    exact_avg_sql,
    pct_sql,
    ratio_sql,
    round_avg_money_sql,
    round_ratio_sql,
    with_layers,
)

ORACLE: dict[str, str] = {}

MONEY_COLS = [
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_value",
]


def d(c: str, alias: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d') AS {alias or c.split('.')[-1]}"


def big(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS BIGINT) AS {alias or c.split('.')[-1]}"


def dbl(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) AS {alias or c.split('.')[-1]}"


def sel(table: str, *cols: str) -> str:
    return with_layers(f"SELECT {', '.join(cols)} FROM {table}")


LISTING_COLS = [
    big("listing_id"), big("scrape_id"), d("scraped_date"), big("host_id"), "host_name",
    d("host_since"), "host_is_superhost", "host_neighbourhood", "listing_neighbourhood",
    "property_type", "room_type", big("accommodates"), dbl("price"), "has_availability",
    big("availability_30"), big("number_of_reviews"), *[dbl(c) for c in MONEY_COLS],
]

ORACLE["silver_listings"] = sel("listings_clean", *LISTING_COLS)
ORACLE["silver_host"] = sel(
    "host_clean", big("host_id"), "host_name", d("host_since"), "host_is_superhost", "host_neighbourhood"
)
ORACLE["silver_property"] = sel(
    "property_clean", big("listing_id"), "property_type", "room_type", big("accommodates"),
    big("number_of_reviews"), *[dbl(c) for c in MONEY_COLS],
)
ORACLE["silver_lga_code"] = sel("lga_code_clean", "lga_code", "lga_name")
ORACLE["silver_lga_suburb"] = sel(
    "lga_suburb_clean", "listing_neighbourhood", "suburb_name", "lga_name", "lga_code", "suburb_key"
)
_G01 = [
    "age_0_4", "age_5_14", "age_15_19", "age_20_24", "age_25_34", "age_35_44", "age_45_54",
    "age_55_64", "age_65_74", "age_75_84", "age_85_plus", "total_population",
    "indigenous_population", "born_overseas_population",
]
_G02 = [
    "median_age_persons", "median_mortgage_repay_monthly", "median_tot_prsnl_inc_weekly",
    "median_rent_weekly", "median_tot_fam_inc_weekly", "average_num_psns_per_bedroom",
    "median_tot_hhd_inc_weekly", "average_household_size",
]
ORACLE["silver_census_g01"] = sel("census_g01_clean", "lga_code", *[big(c) for c in _G01])
ORACLE["silver_census_g02"] = sel("census_g02_clean", "lga_code", *[dbl(c) for c in _G02])
ORACLE["gold_census_g01"] = sel("dm_census_g01", "lga_code", *[big(c) for c in _G01])
ORACLE["gold_census_g02"] = sel("dm_census_g02", "lga_code", *[dbl(c) for c in _G02])
ORACLE["gold_dm_census"] = sel("dm_census", "lga_code", *[big(c) for c in _G01], *[dbl(c) for c in _G02])
ORACLE["scd2_rebuild"] = sel(
    "host_snapshot", big("host_id"), "host_name", "host_is_superhost", "host_neighbourhood",
    d("host_since"), d("valid_from"), d("valid_to"),
)
ORACLE["gold_dm_host"] = sel(
    "dm_host", big("host_id"), "host_key", "host_name", "host_is_superhost", d("valid_from"), d("valid_to")
)
ORACLE["gold_dm_lga"] = sel("dm_lga", "lga_key", "lga_code", "lga_name")
ORACLE["gold_dm_suburb"] = sel("dm_suburb", "suburb_key", "suburb_name", "lga_code", "lga_name")
ORACLE["gold_dm_property"] = sel(
    "dm_property", "property_key", big("listing_id"), "property_type", "room_type",
    big("accommodates"), big("number_of_reviews"), *[dbl(c) for c in MONEY_COLS],
)
FACT_COLS = [
    big("listing_id"), d("scraped_date"), dbl("price"), big("number_of_reviews"),
    big("availability_30"), "host_key", "suburb_key", "lga_key", "lga_code", "property_key",
    "has_availability",
]
ORACLE["gold_fact_asis"] = sel("fact_asis", *FACT_COLS)
ORACLE["gold_fact_pit"] = sel(
    "fact_pit_host", *FACT_COLS, big("host_id"), "property_type", "room_type", big("accommodates"),
    dbl("review_scores_rating"), "host_is_superhost",
)


# --- marts -------------------------------------------------------------------
def _listing_mart(source: str, group_exprs: list[tuple[str, str]]) -> str:
    """The listing-mart measures over ``source`` per ``group_exprs``
    ((expression, alias) pairs) and month: one result over all rows, one over
    the rows with free nights, and the group's nearest earlier month by an
    as-of join on a running month number."""
    names = [a for _, a in group_exprs]
    g_sel = ", ".join(f"{e} AS {a}" for e, a in group_exprs)
    g = ", ".join(names)
    same = " AND ".join(f"now.{a} = before.{a}" for a in names)
    return with_layers(f"""
, placed AS (
    SELECT {g_sel}, 12 * year(scraped_date) + month(scraped_date) - 1 AS period,
        host_key, price, availability_30, review_scores_rating, host_is_superhost
    FROM {source}
), every_row AS (
    SELECT {g}, period, count(*) AS n, count(DISTINCT host_key) AS hosts FROM placed GROUP BY ALL
), free_row AS (
    SELECT {g}, period, count(*) AS n_free, min(price) AS low, max(price) AS high,
        median(CAST(price AS DOUBLE)) AS mid, {exact_avg_sql("price")} AS mean_price,
        {exact_avg_sql("review_scores_rating")} AS mean_review,
        count(DISTINCT host_key) FILTER (host_is_superhost) AS superhosts,
        sum(30 - availability_30) AS nights, sum((30 - availability_30) * price) AS earned
    FROM placed WHERE availability_30 > 0 GROUP BY ALL
), monthly AS (
    SELECT * REPLACE (coalesce(n_free, 0) AS n_free, coalesce(superhosts, 0) AS superhosts),
        n - coalesce(n_free, 0) AS n_full
    FROM every_row LEFT JOIN free_row USING ({g}, period)
)
SELECT {", ".join(f"now.{a}" if a != "accommodates" else big(f"now.{a}") for a in names)},
    CAST(now.period // 12 AS BIGINT) AS year, CAST(now.period % 12 + 1 AS BIGINT) AS month,
    {pct_sql("now.n_free", "now.n")} AS active_listings_rate,
    CAST(now.low AS DOUBLE) AS min_price, CAST(now.high AS DOUBLE) AS max_price,
    now.mid AS median_price, now.mean_price AS avg_price, CAST(now.hosts AS BIGINT) AS distinct_hosts,
    {pct_sql("now.superhosts", "now.hosts")} AS superhost_rate,
    now.mean_review AS avg_review_score, CAST(now.nights AS BIGINT) AS total_stays,
    {pct_sql("(now.n_free - before.n_free)", "before.n_free")} AS pct_change_active,
    {pct_sql("(now.n_full - before.n_full)", "before.n_full")} AS pct_change_inactive,
    CAST(now.earned AS DOUBLE) AS total_estimated_revenue,
    {ratio_sql("now.earned", "now.n_free")} AS avg_estimated_revenue_per_listing
FROM monthly now ASOF LEFT JOIN monthly before ON {same} AND now.period > before.period""")


_BY_LGA = [("COALESCE(lga_key, 'Unknown')", "listing_neighbourhood_lga")]
_BY_PROPERTY = [
    ("COALESCE(property_type, 'Unknown')", "property_type"),
    ("COALESCE(room_type, 'Unknown')", "room_type"),
    ("COALESCE(accommodates, 0)", "accommodates"),
]
ORACLE["mart_listing_neighbourhood"] = _listing_mart("fact_pit_host", _BY_LGA)
ORACLE["mart_listing_neighbourhood_closed"] = _listing_mart("fact_pit_host_closed", _BY_LGA)
ORACLE["mart_property_type"] = _listing_mart("fact_pit_host", _BY_PROPERTY)


def _host_mart(source: str) -> str:
    return with_layers(f"""
SELECT COALESCE(lga_key, 'Unknown') AS host_neighbourhood_lga,
    CAST(year(scraped_date) AS BIGINT) AS year, CAST(month(scraped_date) AS BIGINT) AS month,
    CAST(COUNT(DISTINCT host_key) AS BIGINT) AS distinct_hosts,
    CAST(SUM((30 - availability_30) * price) AS DOUBLE) AS total_estimated_revenue,
    {ratio_sql("SUM((30 - availability_30) * price)", "COUNT(DISTINCT host_key)")} AS estimated_revenue_per_host
FROM {source} GROUP BY 1, 2, 3""")


ORACLE["mart_host_neighbourhood"] = _host_mart("fact_pit")


# --- questions ---------------------------------------------------------------
# Each is written from its meaning over one of the two facts.
_EARNED = exact_avg_sql("(30 - availability_30) * price")


def _question_a(fact: str) -> str:
    """An LGA's standing is the number of distinct values beyond its own (a
    missing value stands above all); ages come from the census turned to one
    row per LGA and age band, told apart by the band's first year."""
    return with_layers(f"""
, lga_value AS (
    SELECT lga_code, coalesce(avg(per_host), 'infinity') AS v
    FROM (SELECT lga_code, host_key, {_EARNED} AS per_host FROM {fact}
          WHERE availability_30 < 30 AND scraped_date >= (SELECT cut FROM max_date) GROUP BY ALL)
    GROUP BY ALL
), chosen AS (
    SELECT lga_code,
        CASE WHEN (SELECT count(DISTINCT o.v) FROM lga_value o WHERE o.v > me.v) < 3 THEN 'Top 3'
             WHEN (SELECT count(DISTINCT o.v) FROM lga_value o WHERE o.v < me.v) < 3 THEN 'Bottom 3'
        END AS performance_group
    FROM lga_value me
), people AS (
    SELECT lga_code, CAST(split_part(band, '_', 2) AS INTEGER) AS from_age, n
    FROM (SELECT lga_code, COLUMNS('^age_') FROM dm_census) UNPIVOT (n FOR band IN (* EXCLUDE (lga_code)))
), ages AS (
    SELECT performance_group, sum(n) FILTER (from_age < 15) AS young,
        sum(n) FILTER (from_age BETWEEN 15 AND 64) AS working, sum(n) FILTER (from_age >= 65) AS old
    FROM chosen LEFT JOIN people ON people.lga_code = 'LGA' || chosen.lga_code
    GROUP BY performance_group
), households AS (
    SELECT performance_group, sum(total_population) AS everyone,
        {round_avg_money_sql("average_household_size")} AS avg_household_size,
        coalesce(string_agg(DISTINCT chosen.lga_code, ', ' ORDER BY chosen.lga_code), '') AS lgas_in_group
    FROM chosen LEFT JOIN dm_census ON dm_census.lga_code = 'LGA' || chosen.lga_code
    WHERE performance_group IS NOT NULL GROUP BY performance_group
)
SELECT performance_group,
    {round_ratio_sql("young", "everyone")} AS pct_age_0_14,
    {round_ratio_sql("working", "everyone")} AS pct_age_15_64,
    {round_ratio_sql("old", "everyone")} AS pct_age_65_plus,
    avg_household_size, lgas_in_group
FROM households JOIN ages USING (performance_group)""")


def _question_b(fact: str) -> str:
    return with_layers(f"""
SELECT CAST(ROUND(CAST(corr(age, earned) AS DECIMAL(38,10)), 3) AS DOUBLE) AS correlation_coefficient
FROM (SELECT CAST(median_age_persons AS DOUBLE) AS age, {_EARNED} AS earned
      FROM {fact} f JOIN dm_census_g02 c ON c.lga_code = concat('LGA', f.lga_code)
      WHERE availability_30 < 30 AND f.lga_code IS NOT NULL AND median_age_persons IS NOT NULL
      GROUP BY f.lga_code, median_age_persons)""")


def _question_c(fact: str, offer: str) -> str:
    """``offer`` has the property columns of the fact's own rows; with "NULL"
    the stays fall on every row of the property dimension and of the suburb."""
    entries = "1" if offer != "NULL" else "count(*)"
    return with_layers(f"""
, last_state AS (
    SELECT DISTINCT listing_id, property_key, availability_30, price, place, coalesce(entries, 1) AS entries, {offer}
    FROM (SELECT f.* FROM {fact} f
          QUALIFY scraped_date IS NOT DISTINCT FROM max(scraped_date) OVER (PARTITION BY listing_id)) f
    LEFT JOIN (SELECT suburb_key, min(suburb_name) AS place, {entries} AS entries FROM dm_suburb GROUP BY suburb_key) USING (suburb_key)
), best_places AS (
    SELECT place FROM last_state WHERE availability_30 < 30 GROUP BY place
    ORDER BY {_EARNED} DESC NULLS FIRST, place NULLS LAST LIMIT 5
), offered AS (
    SELECT place, p.property_type AS kind, p.room_type AS room, p.accommodates AS beds, sum(entries * (30 - availability_30)) AS nights
    FROM last_state {"p" if offer != "NULL" else "LEFT JOIN dm_property p USING (property_key)"}
    WHERE place IN (FROM best_places) GROUP BY ALL
)
SELECT place AS listing_neighbourhood, best.kind AS property_type, best.room AS room_type,
    CAST(best.beds AS BIGINT) AS accommodates, CAST(best.nights AS BIGINT) AS total_stays
FROM (SELECT place, first({{'kind': kind, 'room': room, 'beds': beds, 'nights': nights}}
             ORDER BY nights DESC NULLS FIRST, kind NULLS LAST, room NULLS LAST, beds NULLS LAST) AS best
      FROM offered GROUP BY place)""")


def _question_d(fact: str) -> str:
    """A host's listings lie in one LGA if the least and the greatest code agree."""
    return with_layers(f"""
SELECT CAST(count(*) AS BIGINT) AS total_multi_listing_hosts,
    CAST(count(*) FILTER (low = high) AS BIGINT) AS concentrated_hosts_count,
    CAST(count(*) FILTER (low < high) AS BIGINT) AS distributed_hosts_count,
    {round_ratio_sql("count(*) FILTER (low = high)", "count(*)")} AS percent_concentrated_hosts
FROM (SELECT min(lga_code) AS low, max(lga_code) AS high, count(listing_id) AS n
      FROM {fact} WHERE has_availability AND host_key IS NOT NULL AND lga_key IS NOT NULL GROUP BY host_key)
WHERE n > 1""")


def _question_e(fact: str) -> str:
    return with_layers(f"""
, only_listing AS (
    SELECT host_key, lga_code, scraped_date, 12 * (30 - availability_30) * price AS yearly
    FROM {fact} WHERE availability_30 > 0 AND host_key IS NOT NULL
    QUALIFY min(listing_id) OVER (PARTITION BY host_key) = max(listing_id) OVER (PARTITION BY host_key)
), able AS (
    SELECT o.lga_code, count(*) AS hosts, count(*) FILTER (yearly >= 12 * median_mortgage_repay_monthly) AS paying
    FROM only_listing o JOIN dm_census_g02 c ON c.lga_code = concat('LGA', o.lga_code)
    WHERE o.lga_code IS NOT NULL AND scraped_date >= (SELECT cut FROM max_date)
    GROUP BY o.lga_code HAVING count(*) > 10
)
SELECT lga_name, able.lga_code, {round_ratio_sql("paying", "hosts")} AS percent_covered,
    CAST(hosts AS BIGINT) AS total_single_hosts
FROM able LEFT JOIN dm_lga ON dm_lga.lga_code = able.lga_code
ORDER BY percent_covered DESC NULLS FIRST, hosts DESC, able.lga_code, lga_name NULLS LAST LIMIT 1""")


_OWN = "property_type, room_type, accommodates"
for _name, _fact, _offer in (("", "fact_pit", _OWN), ("_asis", "fact_asis", "NULL")):
    ORACLE[f"adhoc_a{_name}"] = _question_a(_fact)
    ORACLE[f"adhoc_b{_name}"] = _question_b(_fact)
    ORACLE[f"adhoc_c{_name}"] = _question_c(_fact, _offer)
    ORACLE[f"adhoc_d{_name}"] = _question_d(_fact)
    ORACLE[f"adhoc_e{_name}"] = _question_e(_fact)

# --- sources and sinks -------------------------------------------------------
RAW_COLS = [
    big("listing_id"), big("scrape_id"), d("scraped_date"), big("host_id"), "host_name",
    d("host_since"), "host_is_superhost", "host_neighbourhood", "listing_neighbourhood",
    "property_type", "room_type", big("accommodates"), dbl("price"), "has_availability",
    big("availability_30"), big("number_of_reviews"), *[dbl(c) for c in MONEY_COLS],
]
for _k in ("csv_roundtrip", "csv_by_name", "drop_blank_cols", "null_tokens", "normalize_date",
           "bronze_typed", "full_reload"):
    ORACLE[_k] = sel("listings_raw", *RAW_COLS)
ORACLE["monthly_append"] = sel("listings_raw", *RAW_COLS, "strftime(scraped_date, '%Y-%m') AS month")
ORACLE["dq_unique_key"] = with_layers("""
SELECT CAST(listing_id AS BIGINT) AS listing_id, strftime(scraped_date, '%Y-%m-%d') AS scraped_date,
    CAST(COUNT(*) AS BIGINT) AS n_rows
FROM listings_raw GROUP BY listing_id, scraped_date HAVING COUNT(*) > 1""")
ORACLE["dq_not_null"] = with_layers("""
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
    CAST(COUNT(CASE WHEN listing_id IS NULL THEN 1 END) AS BIGINT) AS null_listing_id,
    CAST(COUNT(CASE WHEN scraped_date IS NULL THEN 1 END) AS BIGINT) AS null_scraped_date
FROM listings_raw""")
ORACLE["sink_table"] = ORACLE["gold_dm_suburb"]
ORACLE["sink_view"] = ORACLE["mart_host_neighbourhood"]
ORACLE["fact_partitioned"] = with_layers("""
SELECT CAST(extract(year FROM scraped_date) AS BIGINT) AS year,
    CAST(extract(month FROM scraped_date) AS BIGINT) AS month, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM fact_pit GROUP BY 1, 2""")
ORACLE["fact_clustered"] = with_layers("""
SELECT key, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(30 - availability_30) AS BIGINT) AS stays
FROM (SELECT availability_30, key, value, min(value) OVER (PARTITION BY key) AS least
      FROM (SELECT availability_30, host_key, suburb_key, property_key FROM fact_pit) UNPIVOT (value FOR key IN (host_key, suburb_key, property_key)))
WHERE value = least GROUP BY key""")
ORACLE["upsert_listings"] = ORACLE["silver_listings"]
ORACLE["stream_upsert_listings"] = ORACLE["silver_listings"]
ORACLE["stream_scd2"] = ORACLE["scd2_rebuild"]
ORACLE["scd2_merge_late"] = ORACLE["scd2_rebuild"]
ORACLE["mart_listing_refreshed"] = ORACLE["mart_listing_neighbourhood"]
ORACLE["pipeline_mart_listing"] = ORACLE["mart_listing_neighbourhood"]
ORACLE["load_with_rejects"] = with_layers("""
, delivered AS (
    SELECT *, listing_id % 101 = 0 AS bad, CASE WHEN listing_id % 97 <> 0 THEN scraped_date END AS day FROM listings_raw
), told AS (
    SELECT *, CASE WHEN bad THEN 'unreadable' WHEN listing_id IS NULL OR day IS NULL THEN 'null key'
        WHEN row_number() OVER (PARTITION BY listing_id, day, bad
            ORDER BY scrape_id DESC NULLS LAST, price DESC NULLS LAST, availability_30 DESC NULLS LAST, host_id NULLS LAST,
                listing_neighbourhood NULLS LAST, number_of_reviews NULLS LAST, review_scores_rating NULLS LAST, has_availability NULLS LAST) > 1
        THEN 'duplicate key' END AS reason
    FROM delivered
)
SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS verdict, reason, CAST(listing_id AS BIGINT) AS listing_id,
    strftime(day, '%Y-%m-%d') AS scraped_date, CAST(scrape_id AS BIGINT) AS scrape_id, CASE WHEN NOT bad THEN CAST(price AS DOUBLE) END AS price
FROM told""")


# --- verbatim ("as-is") variants on the fanned-out fact ------------------------
ORACLE["mart_listing_neighbourhood_asis"] = _listing_mart("fact_asis_host_prop", _BY_LGA)
ORACLE["mart_property_type_asis"] = _listing_mart("fact_asis_host_prop", _BY_PROPERTY)
ORACLE["mart_host_neighbourhood_asis"] = _host_mart("fact_asis_host")

# The incremental merge over yearly drops, in closed form: a dated host tuple
# of a drop opens a version when its host_since is later than all of the host's
# earlier drops (or it is the host's first drop); tuples of one drop and date
# are one version; a version closes where the next opens.
ORACLE["scd2_merge"] = with_layers("""
, seen AS (
    SELECT DISTINCT host_id, year(scraped_date) AS batch, host_name,
        CASE WHEN host_is_superhost = 't' THEN TRUE WHEN host_is_superhost = 'f' THEN FALSE END AS host_is_superhost,
        host_neighbourhood, host_since
    FROM listings_raw WHERE host_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY host_id, year(scraped_date), host_since
        ORDER BY host_name ASC NULLS LAST, host_is_superhost = 't' ASC NULLS LAST, host_neighbourhood ASC NULLS LAST) = 1
), versions AS (
    SELECT s.* FROM seen s
    LEFT JOIN (SELECT host_id, min(batch) AS first_batch FROM seen GROUP BY host_id) f USING (host_id)
    WHERE (s.batch = f.first_batch AND s.host_since IS NOT NULL)
       OR s.host_since > (SELECT max(e.host_since) FROM seen e WHERE e.host_id = s.host_id AND e.batch < s.batch)
)
SELECT CAST(host_id AS BIGINT) AS host_id, host_name, host_is_superhost, host_neighbourhood,
    strftime(host_since, '%Y-%m-%d') AS host_since, strftime(host_since, '%Y-%m-%d') AS valid_from,
    strftime(lead(host_since) OVER (PARTITION BY host_id ORDER BY host_since), '%Y-%m-%d') AS valid_to
FROM versions""")
for _name, _like in (("census_g01", "silver_census_g01"), ("census_g02", "silver_census_g02")):
    ORACLE[f"csv_{_name}"] = ORACLE[_like]
ORACLE["csv_lga_code"] = sel("lga_code_raw", "lga_code", "lga_name")
ORACLE["csv_lga_suburb"] = sel("lga_suburb_raw", "lga_name", "suburb_name")
ORACLE["csv_one_folder_months"] = ORACLE["monthly_append"]
