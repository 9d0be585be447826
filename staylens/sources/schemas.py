"""Bronze table schemas (the typed landing layer).

NUMERIC without precision in the source DDL is pinned to DECIMAL(12,2): money
and review scores stay exact through sums; conversion to DOUBLE happens only
after the final division.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

LISTING_KEY = ("listing_id", "scraped_date")

# Bronze listing-snapshot columns and types, in file order.
LISTINGS_RAW = T.StructType(
    [
        T.StructField("listing_id", T.LongType()),
        T.StructField("scrape_id", T.LongType()),
        T.StructField("scraped_date", T.DateType()),
        T.StructField("host_id", T.LongType()),
        T.StructField("host_name", T.StringType()),
        T.StructField("host_since", T.DateType()),
        T.StructField("host_is_superhost", T.StringType()),
        T.StructField("host_neighbourhood", T.StringType()),
        T.StructField("listing_neighbourhood", T.StringType()),
        T.StructField("property_type", T.StringType()),
        T.StructField("room_type", T.StringType()),
        T.StructField("accommodates", T.IntegerType()),
        T.StructField("price", MONEY),
        T.StructField("has_availability", T.StringType()),
        T.StructField("availability_30", T.IntegerType()),
        T.StructField("number_of_reviews", T.IntegerType()),
        T.StructField("review_scores_rating", MONEY),
        T.StructField("review_scores_accuracy", MONEY),
        T.StructField("review_scores_cleanliness", MONEY),
        T.StructField("review_scores_checkin", MONEY),
        T.StructField("review_scores_communication", MONEY),
        T.StructField("review_scores_value", MONEY),
    ]
)

# The 36 census G01 person-count measures, in DDL order.  Each
# measure appears three times in the table, with suffix _M, _F and _P.
CENSUS_G01_MEASURES = [
    "Tot_P", "Age_0_4_yr", "Age_5_14_yr", "Age_15_19_yr", "Age_20_24_yr",
    "Age_25_34_yr", "Age_35_44_yr", "Age_45_54_yr", "Age_55_64_yr",
    "Age_65_74_yr", "Age_75_84_yr", "Age_85ov", "Counted_Census_Night_home",
    "Count_Census_Nt_Ewhere_Aust", "Indigenous_psns_Aboriginal",
    "Indig_psns_Torres_Strait_Is", "Indig_Bth_Abor_Torres_St_Is",
    "Indigenous_P_Tot", "Birthplace_Australia", "Birthplace_Elsewhere",
    "Lang_spoken_home_Eng_only", "Lang_spoken_home_Oth_Lang",
    "Australian_citizen", "Age_psns_att_educ_inst_0_4",
    "Age_psns_att_educ_inst_5_14", "Age_psns_att_edu_inst_15_19",
    "Age_psns_att_edu_inst_20_24", "Age_psns_att_edu_inst_25_ov",
    "High_yr_schl_comp_Yr_12_eq", "High_yr_schl_comp_Yr_11_eq",
    "High_yr_schl_comp_Yr_10_eq", "High_yr_schl_comp_Yr_9_eq",
    "High_yr_schl_comp_Yr_8_belw", "High_yr_schl_comp_D_n_g_sch",
    "Count_psns_occ_priv_dwgs", "Count_Persons_other_dwgs",
]
CENSUS_G01_SUFFIXES = ["M", "F", "P"]

# The eleven age bands the silver layer adds up (male + female),
# and the silver column each band becomes.
AGE_BANDS = [
    ("Age_0_4_yr", "age_0_4"),
    ("Age_5_14_yr", "age_5_14"),
    ("Age_15_19_yr", "age_15_19"),
    ("Age_20_24_yr", "age_20_24"),
    ("Age_25_34_yr", "age_25_34"),
    ("Age_35_44_yr", "age_35_44"),
    ("Age_45_54_yr", "age_45_54"),
    ("Age_55_64_yr", "age_55_64"),
    ("Age_65_74_yr", "age_65_74"),
    ("Age_75_84_yr", "age_75_84"),
    ("Age_85ov", "age_85_plus"),
]

CENSUS_G01_RAW = T.StructType(
    [T.StructField("LGA_CODE_2016", T.StringType())]
    + [
        T.StructField(f"{m}_{s}", T.IntegerType())
        for m in CENSUS_G01_MEASURES
        for s in CENSUS_G01_SUFFIXES
    ]
)

# Census G02 medians / averages, in DDL order.
CENSUS_G02_MEASURES = [
    "Median_age_persons",
    "Median_mortgage_repay_monthly",
    "Median_tot_prsnl_inc_weekly",
    "Median_rent_weekly",
    "Median_tot_fam_inc_weekly",
    "Average_num_psns_per_bedroom",
    "Median_tot_hhd_inc_weekly",
    "Average_household_size",
]

CENSUS_G02_RAW = T.StructType(
    [T.StructField("LGA_CODE_2016", T.StringType())]
    + [T.StructField(m, MONEY) for m in CENSUS_G02_MEASURES]
)

LGA_CODE = T.StructType(
    [T.StructField("lga_code", T.StringType()), T.StructField("lga_name", T.StringType())]
)

LGA_SUBURB = T.StructType(
    [T.StructField("lga_name", T.StringType()), T.StructField("suburb_name", T.StringType())]
)

BRONZE = {
    "listings_raw": LISTINGS_RAW,
    "census_g01_raw": CENSUS_G01_RAW,
    "census_g02_raw": CENSUS_G02_RAW,
    "lga_code": LGA_CODE,
    "lga_suburb": LGA_SUBURB,
}

# Keys the bronze layer declares (checked by operators.quality, not enforced
# by storage).
BRONZE_KEYS = {
    "listings_raw": list(LISTING_KEY),
    "lga_code": ["lga_code"],
}
