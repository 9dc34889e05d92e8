"""Registered queries for exploratory aggregates, missingness study and feature scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions import nulls as N
from tabforge.functions import scalars as S
from tabforge.operators import eda as E
from tabforge.operators import split as G
from tabforge.plans.catalog_quality import LEVEL_SQL, LISTING_COLS, with_split
from tabforge.plans.catalog_scalars import PRICE_DIGITS_SQL, with_listings
from tabforge.sources.fixtures import listings

Q = {}
O = {}
R6 = 6


def _r(df, cols, nd=R6):
    return df.select(*[F.round(c, nd).alias(c) if c in cols else F.col(c) for c in df.columns])


def _priced(spark, sf):
    return listings(spark, sf).withColumn("price", S.price_digits("price"))


P_CTE = f"p AS (SELECT l.*, {PRICE_DIGITS_SQL.replace('price', 'l.price')} AS price_num FROM listings l)"


def q_skewness(spark, sf):
    return _r(E.skewness(_priced(spark, sf), "price"), ["skew_raw", "skew_log1p"])


O["skewness"] = with_listings(
    "SELECT round(skewness(price_num), 6) AS skew_raw, round(skewness(CASE WHEN price_num > 0 THEN ln(1 + price_num)"
    " END), 6) AS skew_log1p FROM p", P_CTE)


def q_histogram(spark, sf):
    return _r(E.histogram(_priced(spark, sf), "price", 60), ["lower", "upper"])


O["histogram"] = with_listings(
    "SELECT CAST(b.i AS INTEGER) AS bin, round(lo + b.i * w, 6) AS lower, round(lo + (b.i + 1) * w, 6) AS upper,"
    " coalesce(c.cnt, 0) AS count FROM r, range(60) b(i) LEFT JOIN (SELECT CAST(least(floor((price_num - lo) / w), 59)"
    " AS INTEGER) AS bin, count(*) AS cnt FROM p, r WHERE price_num IS NOT NULL GROUP BY 1) c ON c.bin = b.i",
    P_CTE, "r AS (SELECT min(price_num) AS lo, max(price_num) AS hi, (max(price_num) - min(price_num)) / 60 AS w FROM p)")


def q_box_stats(spark, sf):
    return E.box_stats(_priced(spark, sf), "room_type", "price")


O["box_stats"] = with_listings(
    "SELECT p.room_type, q1, median, q3, min(CASE WHEN inside THEN price_num END) AS whisker_low,"
    " max(CASE WHEN inside THEN price_num END) AS whisker_high, count(*) FILTER (WHERE NOT inside) AS n_outliers"
    " FROM (SELECT p.room_type, price_num, q1, median, q3, price_num >= q1 - 1.5 * (q3 - q1) AND price_num <= q3 + 1.5 *"
    " (q3 - q1) AS inside FROM p JOIN q ON p.room_type = q.room_type WHERE price_num IS NOT NULL) p"
    " GROUP BY p.room_type, q1, median, q3",
    P_CTE, "q AS (SELECT room_type, quantile_cont(price_num, 0.25) AS q1, quantile_cont(price_num, 0.5) AS median,"
           " quantile_cont(price_num, 0.75) AS q3 FROM p WHERE price_num IS NOT NULL GROUP BY room_type)")


def q_price_vs_capacity(spark, sf):
    return _r(E.price_vs_capacity(_priced(spark, sf), "accommodates", "room_type", "price"), ["mean_price"])


O["price_vs_capacity"] = with_listings(
    "SELECT accommodates, room_type, count(*) AS n, median(price_num) AS median_price, round(avg(price_num), 6)"
    " AS mean_price FROM p WHERE price_num IS NOT NULL GROUP BY accommodates, room_type", P_CTE)


def q_kde_grid(spark, sf):
    return _r(E.kde_grid(listings(spark, sf), "estimated_occupancy_l365d", 200, 1024), ["g", "density"], 9)


O["kde_grid"] = with_listings(
    "SELECT round(g, 9) AS g, round(sum(c * exp(-0.5 * ((g - xc) / bw) * ((g - xc) / bw))) / (n * bw * sqrt(2 * pi())),"
    " 9) AS density FROM (SELECT lo + (b + 0.5) * w AS xc, count(*) AS c FROM (SELECT least(floor((x - lo) / w), 1023)"
    " AS b, lo, w FROM (SELECT CAST(estimated_occupancy_l365d AS DOUBLE) AS x FROM listings) d, st"
    " WHERE x IS NOT NULL) GROUP BY b, lo, w) cen, st, (SELECT lo + i * (hi - lo) / 199 AS g FROM st, range(200) r(i)) gr"
    " GROUP BY g, n, bw",
    "st AS (SELECT min(x) AS lo, max(x) AS hi, count(x) AS n, stddev_samp(x) * pow(count(x), -0.2) AS bw,"
    " (max(x) - min(x)) / 1024 AS w FROM (SELECT CAST(estimated_occupancy_l365d AS DOUBLE) AS x FROM listings))")


def q_occupancy_bands(spark, sf):
    return _r(E.occupancy_bands(listings(spark, sf), "estimated_occupancy_l365d"),
              ["pct_zero", "pct_low", "pct_mid", "pct_high", "share_top_code"])


O["occupancy_bands"] = with_listings(
    "SELECT round(avg(CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_zero,"
    " round(avg(CASE WHEN d BETWEEN 1 AND 30 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_low,"
    " round(avg(CASE WHEN d BETWEEN 31 AND 120 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_mid,"
    " round(avg(CASE WHEN d >= 121 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_high,"
    " count(*) FILTER (WHERE raw = 255) AS n_top_code,"
    " round(avg(CASE WHEN raw >= 255 THEN 1.0 ELSE 0.0 END), 6) AS share_top_code FROM (SELECT"
    " least(greatest(estimated_occupancy_l365d, 0), 365) AS d, estimated_occupancy_l365d AS raw FROM listings)")


def q_target_audit(spark, sf):
    return _r(E.target_audit(listings(spark, sf), "estimated_occupancy_l365d", "availability_365"),
              ["corr", "max_abs_diff", "mae"])


O["target_audit"] = with_listings(
    "SELECT round(corr(rate, approx), 6) AS corr, round(max(abs(rate - approx)), 6) AS max_abs_diff,"
    " round(avg(abs(rate - approx)), 6) AS mae FROM (SELECT least(greatest(estimated_occupancy_l365d / 365.0, 0), 1)"
    " AS rate, 1.0 - CAST(availability_365 AS DOUBLE) / 365.0 AS approx FROM listings)")

TC_COLS = ["number_of_reviews", "reviews_per_month", "review_scores_rating"]


def q_target_correlations(spark, sf):
    return _r(E.target_correlations(listings(spark, sf), "estimated_occupancy_l365d", TC_COLS), ["corr"])


O["target_correlations"] = with_listings(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(corr(CAST({c} AS DOUBLE), estimated_occupancy_l365d / 365.0), 6) AS corr"
    " FROM listings" for c in TC_COLS))

FT_NUM = ["accommodates", "bedrooms", "beds", "price", "host_response_rate", "instant_bookable", "host_is_superhost"]
FT_CAT = ["room_type", "property_type", "neighbourhood_cleansed", "host_response_time"]


def _ft_base(spark, sf):
    return (listings(spark, sf).withColumn("price", S.price_digits("price"))
            .withColumn("host_response_rate", S.clean_percent("host_response_rate"))
            .withColumn("instant_bookable", S.bool_to_int("instant_bookable"))
            .withColumn("host_is_superhost", S.bool_to_int("host_is_superhost")))


def q_feature_target_corr(spark, sf):
    return _r(E.feature_target_corr(_ft_base(spark, sf), "estimated_occupancy_l365d", FT_NUM, FT_CAT), ["corr"])


def _ft_sql():
    base = ("b AS (SELECT estimated_occupancy_l365d / 365.0 AS y, CAST(accommodates AS DOUBLE) AS accommodates, bedrooms,"
            f" beds, {PRICE_DIGITS_SQL} AS price, TRY_CAST(nullif(regexp_replace(host_response_rate, '[^0-9.]+', '', 'g'),"
            " '') AS DOUBLE) / 100.0 AS host_response_rate, CASE lower(trim(instant_bookable)) WHEN 't' THEN 1.0 WHEN 'f'"
            " THEN 0.0 END AS instant_bookable, CASE lower(trim(host_is_superhost)) WHEN 't' THEN 1.0 WHEN 'f' THEN 0.0"
            " END AS host_is_superhost, " + ", ".join(FT_CAT) + " FROM listings)")
    nums = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, y) AS corr FROM b" for c in FT_NUM)
    cats = " UNION ALL ".join(
        f"SELECT '{c}_' || lvl AS feature, corr(CASE WHEN {c} = lvl THEN 1.0 ELSE 0.0 END, y) AS corr FROM b,"
        f" (SELECT DISTINCT {c} AS lvl FROM b WHERE {c} IS NOT NULL AND {c} > (SELECT min({c}) FROM b)) GROUP BY lvl"
        for c in FT_CAT)
    return with_listings(f"SELECT feature, round(corr, 6) AS corr FROM ({nums} UNION ALL {cats})"
                         " WHERE corr IS NOT NULL AND NOT isnan(corr)", base)


O["feature_target_corr"] = _ft_sql()


def q_null_correlation(spark, sf):
    return _r(E.null_correlation(listings(spark, sf)), ["corr"])


def _pair_sql(expr_name, expr, filt):
    pairs = [(a, b) for i, a in enumerate(LISTING_COLS) for j, b in enumerate(LISTING_COLS) if i < j]
    body = " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, count(*) AS n, count(*) FILTER (WHERE {a} IS NULL) AS na,"
        f" count(*) FILTER (WHERE {b} IS NULL) AS nb, count(*) FILTER (WHERE {a} IS NULL AND {b} IS NULL) AS nab"
        " FROM listings" for a, b in pairs)
    return with_listings(f"SELECT col_a, col_b, round({expr}, 6) AS {expr_name} FROM ({body}) WHERE {filt}")


O["null_correlation"] = _pair_sql(
    "corr", "(n * nab - na * nb) / sqrt(CAST(na AS DOUBLE) * (n - na) * nb * (n - nb))",
    "na > 0 AND na < n AND nb > 0 AND nb < n")


def q_null_distance(spark, sf):
    return _r(E.null_distance(listings(spark, sf)), ["distance"])


O["null_distance"] = _pair_sql("distance", "sqrt(na + nb - 2 * nab)", "true")

def _price_mask():
    return N.is_missing("price", N.MASK_TOKENS)


PRICE_MASK_SQL = f"(price IS NULL OR trim(price) IN ({N.sql_token_list(N.MASK_TOKENS)}))"


def q_numeric_missing_effect(spark, sf):
    return _r(E.numeric_missing_effect(listings(spark, sf), _price_mask(), "accommodates"), ["effect"])


O["numeric_missing_effect"] = with_listings(
    f"SELECT round(CASE WHEN sd > 0 THEN abs(a - b) / sd END, 6) AS effect FROM (SELECT avg(CASE WHEN {PRICE_MASK_SQL}"
    f" THEN accommodates END) AS a, avg(CASE WHEN NOT {PRICE_MASK_SQL} THEN accommodates END) AS b,"
    " stddev_samp(accommodates) AS sd FROM listings)")


def q_categorical_missing_effect(spark, sf):
    return _r(E.categorical_missing_effect(listings(spark, sf), _price_mask(), "room_type"), ["effect"])


O["categorical_missing_effect"] = with_listings(
    "SELECT round(max(abs(a / sa - b / sb)), 6) AS effect FROM (SELECT a, b, sum(a) OVER () AS sa, sum(b) OVER () AS sb"
    f" FROM (SELECT coalesce(room_type, 'Missing') AS lvl, count(*) FILTER (WHERE {PRICE_MASK_SQL}) AS a,"
    f" count(*) FILTER (WHERE NOT {PRICE_MASK_SQL}) AS b FROM listings GROUP BY 1))")


def q_missingness_mechanism(spark, sf):
    return E.missingness_mechanism(listings(spark, sf))


def q_driver_levels(spark, sf):
    return E.driver_levels(listings(spark, sf))


def q_mechanism_top_effects(spark, sf):
    return E.top_effects(E.missingness_mechanism(listings(spark, sf)), 10)


def q_mechanism_summary(spark, sf):
    return _r(E.mechanism_summary(E.missingness_mechanism(listings(spark, sf))), ["pct"])


def _levels(spark, sf):
    return G.split_column(listings(spark, sf), "host_id", "id").withColumn(
        "occupancy_level", G.occupancy_level("estimated_occupancy_l365d"))


def q_class_weights(spark, sf):
    return _r(E.class_weights(_levels(spark, sf).filter("split = 'train'"), "occupancy_level"), ["weight"], 9)


O["class_weights"] = with_split(
    "SELECT occupancy_level, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c) * CASE occupancy_level WHEN 'high'"
    " THEN 1.8 WHEN 'mid' THEN 1.1 ELSE 1.0 END, 9) AS weight FROM (SELECT occupancy_level, count(*) AS n_c FROM"
    f" (SELECT {LEVEL_SQL.format(x='estimated_occupancy_l365d')} AS occupancy_level FROM split WHERE split = 'train')"
    " GROUP BY 1)")

SCORE_COLS = ["accommodates", "bedrooms", "beds", "price"]


def _scored(spark, sf):
    return _priced(spark, sf).withColumn("occupancy_level", G.occupancy_level("estimated_occupancy_l365d"))


SC_CTE = (f"sc AS (SELECT CAST(accommodates AS DOUBLE) AS accommodates, bedrooms, beds, {PRICE_DIGITS_SQL} AS price,"
          f" estimated_occupancy_l365d AS occ, {LEVEL_SQL.format(x='estimated_occupancy_l365d')} AS y FROM listings)")


def q_anova_f(spark, sf):
    return E.anova_f(_scored(spark, sf), "occupancy_level", SCORE_COLS).select(
        "feature", F.round("f_stat", 4).alias("f_stat"))


O["anova_f"] = with_listings(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round((ssb / (k - 1)) / (ssw / (nn - k)), 4) AS f_stat FROM (SELECT sum(n * (m - gm) *"
    f" (m - gm)) AS ssb, sum(ss) AS ssw, count(*) AS k, sum(n) AS nn FROM (SELECT y, count({c}) AS n, avg({c}) AS m,"
    f" sum(({c} - m_in) * ({c} - m_in)) AS ss FROM (SELECT y, {c}, avg({c}) OVER (PARTITION BY y) AS m_in FROM sc"
    f" WHERE {c} IS NOT NULL) GROUP BY y) t, (SELECT avg({c}) AS gm FROM sc WHERE {c} IS NOT NULL))"
    for c in SCORE_COLS), SC_CTE)


def q_mutual_information(spark, sf):
    return E.mutual_information(_scored(spark, sf), "occupancy_level", SCORE_COLS, 10).select(
        "feature", F.round("mi", 9).alias("mi"))


O["mutual_information"] = with_listings(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(sum(nxy / n * ln(nxy * n / (nx * ny))), 9) AS mi FROM (SELECT nxy, sum(nxy) OVER ()"
    f" AS n, sum(nxy) OVER (PARTITION BY bin) AS nx, sum(nxy) OVER (PARTITION BY y) AS ny FROM (SELECT CAST(least(floor(("
    f"{c} - lo) / w), 9) AS INTEGER) AS bin, y, count(*) AS nxy FROM sc, (SELECT min({c}) AS lo, CASE WHEN max({c}) >"
    f" min({c}) THEN (max({c}) - min({c})) / 10 ELSE 1.0 END AS w FROM sc) WHERE {c} IS NOT NULL GROUP BY 1, 2))"
    for c in SCORE_COLS), SC_CTE)


def q_spearman(spark, sf):
    return E.spearman(_scored(spark, sf), "estimated_occupancy_l365d", SCORE_COLS).select(
        "feature", F.round("spearman", 6).alias("spearman"))


O["spearman"] = with_listings(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(corr(rx, ry)), 6) AS spearman FROM (SELECT"
    f" rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS rx,"
    f" rank() OVER (ORDER BY occ) + (count(*) OVER (PARTITION BY occ) - 1) / 2.0 AS ry"
    f" FROM sc WHERE {c} IS NOT NULL AND occ IS NOT NULL)" for c in SCORE_COLS), SC_CTE)


for _name, _fn in list(globals().items()):
    if _name.startswith("q_") and callable(_fn):
        Q[_name[2:]] = _fn

QUERIES = Q
ORACLES = O


def _mechanism_sql():
    """DuckDB text of A22 over the listings columns (same eligibility rules, same tie order)."""
    from tabforge.plans.catalog_models import _STRING_COLS
    mask = N.sql_token_list(N.MASK_TOKENS)
    pos = {c: i for i, c in enumerate(LISTING_COLS)}
    strs = [c for c in LISTING_COLS if c in _STRING_COLS]
    m_cols = ", ".join(
        f"CAST(({c} IS NULL OR coalesce(trim(CAST({c} AS VARCHAR)) IN ({mask}), false)) AS INTEGER) AS m_{c}, "
        f"TRY_CAST(nullif(regexp_replace(CAST({c} AS VARCHAR), '[^0-9.\\-]', '', 'g'), '') AS DOUBLE) AS x_{c}"
        for c in LISTING_COLS)
    l_cols = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'Missing') AS l_{c}" for c in strs)
    tl = " UNION ALL ".join(f"SELECT id, '{c}' AS t, m_{c} AS mt FROM m" for c in LISTING_COLS)
    xl = " UNION ALL ".join(f"SELECT id, '{c}' AS d, {pos[c]} AS ord, x_{c} AS x FROM m" for c in LISTING_COLS)
    cl = " UNION ALL ".join(f"SELECT id, '{c}' AS d, {pos[c]} AS ord, l_{c} AS lvl FROM m" for c in strs)
    nd = " UNION ALL ".join(f"SELECT '{c}' AS d, count(DISTINCT {c}) AS nd FROM listings" for c in strs)
    ctes = [
        "nn AS (SELECT count(*) AS n FROM listings)",
        f"m AS (SELECT id, {m_cols}, {l_cols} FROM listings)",
        f"tl AS ({tl})", f"xl AS ({xl})", f"cl AS ({cl})", f"dn AS ({nd})",
        "miss AS (SELECT t, sum(mt) AS missing FROM tl GROUP BY t)",
        "vf AS (SELECT d, avg(CASE WHEN x IS NOT NULL THEN 1.0 ELSE 0.0 END) AS vf, stddev_samp(x) AS sd FROM xl"
        " GROUP BY d)",
        "numc AS (SELECT ne.t, ne.d AS driver, 0 AS typ, ne.ord, abs(a - b) / vf.sd AS eff FROM (SELECT tl.t, xl.d,"
        " xl.ord, avg(xl.x) FILTER (WHERE tl.mt = 1) AS a, avg(xl.x) FILTER (WHERE tl.mt = 0) AS b FROM tl JOIN xl"
        " ON tl.id = xl.id WHERE tl.t <> xl.d GROUP BY ALL) ne JOIN vf ON ne.d = vf.d WHERE vf.vf >= 0.5"
        " AND a IS NOT NULL AND b IS NOT NULL AND vf.sd > 0 AND NOT isnan(vf.sd))",
        "catc AS (SELECT cc.t, cc.d || ' (categoría)' AS driver, 1 AS typ, cc.ord, max(abs(cc.m / miss.missing -"
        " (cc.cnt - cc.m) / (nn.n - miss.missing))) AS eff FROM (SELECT tl.t, cl.d, cl.ord, cl.lvl, count(*) AS cnt,"
        " sum(tl.mt) AS m FROM tl JOIN cl ON tl.id = cl.id WHERE tl.t <> cl.d GROUP BY ALL) cc"
        " JOIN miss ON cc.t = miss.t JOIN dn ON cc.d = dn.d, nn WHERE dn.nd BETWEEN 1 AND 30 AND miss.missing > 0"
        " AND miss.missing < nn.n GROUP BY cc.t, cc.d, cc.ord)",
        "best AS (SELECT t, arg_max(driver, (eff, -typ, -ord)) AS driver, max(eff) AS eff FROM (SELECT * FROM numc"
        " UNION ALL SELECT * FROM catc) WHERE eff > 0 GROUP BY t)",
        "mech AS (SELECT miss.t AS column_name, CAST(miss.missing AS BIGINT) AS missing,"
        " round(miss.missing / nn.n * 100, 2) AS missing_pct, CASE WHEN miss.missing = nn.n THEN 'Estructural'"
        " WHEN b.driver IS NULL OR b.eff < 0.05 THEN 'MCAR' WHEN coalesce(CASE WHEN dm.missing > 0 THEN"
        " round(dm.missing / nn.n * 100, 2) END, 0) < 50 THEN 'MAR' ELSE 'MNAR' END AS category,"
        " CASE WHEN miss.missing = nn.n THEN NULL ELSE b.driver END AS driver,"
        " CASE WHEN miss.missing = nn.n OR b.driver IS NULL THEN NULL ELSE round(b.eff, 3) END AS effect_size"
        " FROM miss CROSS JOIN nn LEFT JOIN best b ON miss.t = b.t"
        " LEFT JOIN miss dm ON dm.t = replace(b.driver, ' (categoría)', '') WHERE miss.missing > 0)",
    ]
    return ctes


_MECH = _mechanism_sql()
O["missingness_mechanism"] = with_listings("SELECT * FROM mech", *_MECH)
O["mechanism_top_effects"] = with_listings(
    "SELECT * FROM mech WHERE effect_size IS NOT NULL ORDER BY effect_size DESC, column_name LIMIT 10", *_MECH)
_TEXT = ["neighbourhood_cleansed", "neighbourhood", "host_neighbourhood", "room_type", "property_type", "price", "bathrooms_text", "host_is_superhost",
         "instant_bookable", "host_response_time", "host_response_rate", "has_availability", "amenities"]
O["driver_levels"] = with_listings(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS levels, count(DISTINCT {c}) BETWEEN 1 AND 30 AS used FROM listings" for c in _TEXT))
O["mechanism_summary"] = with_listings(
    "SELECT category, count(*) AS columns, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct FROM mech"
    " GROUP BY category", *_MECH)
