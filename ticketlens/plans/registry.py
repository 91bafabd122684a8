"""Registers every implemented operator/report as a named query with its oracle SQL.

Loaders build the needed tables from the driver's Parquet files; nothing is collected. Panels read
a stored base and stored domains, which the first of them writes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlens.functions.calendar import MS_PER_DAY, calendar_alias_columns, calendar_parts, \
    month_name, parse_date_coerce, parse_date_strict
from ticketlens.functions.money import clean_price, price_text
from ticketlens.functions.timeofday import delay_minutes, hour_of_day, minutes_between_wrapped, \
    seconds_of_day
from ticketlens.operators import clean, profile
from ticketlens.operators.aggregate import category_domain, group_count, group_mean, \
    group_sum, having_count, value_counts
from ticketlens.operators.filters import PanelFilters
from ticketlens.plans import cube, increments, panels, reports, star
from ticketlens.plans.catalog import register
from ticketlens.plans.oracle import pct, r2, secs, with_ctes
from ticketlens.session import materialise, scratch_path, store_key
from ticketlens.sources import tables
from ticketlens.sources.files import reject_counts, scan_rides_checked, scan_rides_csv, scan_star, scan_table_all, trim_column_names, \
    with_epoch_dates, write_star
from ticketlens.sources.publish import input_version
from ticketlens.sources.rides import RIDES_COLUMNS, RIDE_TABLES, ride_tickets, rides


# ------------------------------------------------------------------ loaders

def _rides(s, d):
    return rides(s, d)


def _clean(s, d):
    return clean.notebook_clean(rides(s, d))


def _priced_rides(s, d):
    return clean.sql_cleandata(clean.sql_source_table(rides(s, d)))


def _star(s, d):
    return star.StarA(rides(s, d))


_STORED: dict[tuple, object] = {}


def _once(kind, s, d, build):
    """Stored tables of an input are written by the first query that needs them, and read by all, until
    the input's files change."""
    key = (kind, d, input_version(s, [f"{d.rstrip('/')}/{t}.parquet" for t in RIDE_TABLES]), *store_key(s))
    if key not in _STORED:
        _STORED[key] = build(scratch_path(s, kind))
    return _STORED[key]


def _panel_base(s, d):
    return _once("panel-base", s, d, lambda path: panels.PanelBase(
        star.flat_denormalised(rides(s, d))).stored(path))


def build_panel_cube(s, d, path):
    """Publish the cube of an input's rides under ``path``."""
    cube.build(star.flat_denormalised(rides(s, d)), path)
    return path


def _panel_cube(s, d):
    return cube.load(s, _once("panel-cube", s, d, lambda path: build_panel_cube(s, d, path)))


def _star_files(s, d):
    """The four star tables as Parquet files, written once."""
    def build(path):
        a = star.StarA(rides(s, d))
        a.location = materialise(a.location, "stations")
        write_star({"fact_transactions": a.fact, "dim_time": a.time, "dim_journey": a.journey,
                    "dim_location": a.location}, path)
        return path
    return _once("star-files", s, d, build)


def _scanned_star_base(s, d):
    """The dashboard's start: scan the stored star tables and denormalise them."""
    t = scan_star(s, _star_files(s, d))
    base = star.denormalise(t["fact_transactions"], t["dim_time"], t["dim_journey"], t["dim_location"])
    return panels.PanelBase(base, t["dim_location"], facts=t["fact_transactions"])


def _fact_measures(s, d):
    return star.fact_measures(rides(s, d))


def _tickets(s, d):
    return ride_tickets(s, d)


def _q(name, fn, sql=None):
    register(name, fn, sql)


# ------------------------------------------------------------------ base tables, cleaning

_q("rides", _rides, with_ctes(["rides"], "SELECT * FROM rides"))
_q("rides_cleaned", _clean, with_ctes(["rides_clean"], "SELECT * FROM rides_clean"))
_q("drop_any_null", lambda s, d: clean.drop_any_null(_rides(s, d)),
   with_ctes(["rides"], "SELECT * FROM rides WHERE " + " AND ".join(
       f"{c} IS NOT NULL" for c in RIDES_COLUMNS)))
_q("drop_null_subset", lambda s, d: clean.drop_null_subset(_rides(s, d), ["actual_arrival_time"]),
   with_ctes(["rides"], "SELECT * FROM rides WHERE actual_arrival_time IS NOT NULL"))
_q("drop_all_null",
   lambda s, d: clean.drop_all_null(_rides(s, d).select("railcard", "reason_for_delay")),
   with_ctes(["rides"], "SELECT railcard, reason_for_delay FROM rides "
                        "WHERE railcard IS NOT NULL OR reason_for_delay IS NOT NULL"))
_q("dedup_lineitem", lambda s, d: clean.dedup(tables.lineitem_keys(s, d)),
   "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
_q("filter_status_in",
   lambda s, d: _clean(s, d).where(F.col("journey_status").isin("Cancelled", "Delayed"))
   .select("transaction_id", "journey_status", "refund_request", "price"),
   with_ctes(["rides_clean"], "SELECT transaction_id, journey_status, refund_request, price "
                              "FROM rides_clean WHERE journey_status IN ('Cancelled', 'Delayed')"))
_q("filter_month_name",
   lambda s, d: profile.head_n(
       _rides(s, d).withColumn("month_name", month_name("date_of_purchase"))
       .where(F.col("month_name") == "January"), [F.asc(c) for c in star.ROW_ORDER], 5),
   with_ctes(["rides"], "SELECT *, strftime(date_of_purchase, '%B') AS month_name FROM rides "
                        "WHERE strftime(date_of_purchase, '%B') = 'January' "
                        "ORDER BY date_of_purchase, time_of_purchase, transaction_id LIMIT 5"))



def _text_dates(s, d):
    """Order dates as text, some of which are no dates."""
    o, k = tables.table(s, d, "orders", ["o_orderkey", "o_orderdate"]), F.col("o_orderkey")
    text = (F.when(k % 97 == 0, F.lit("unknown")).when(k % 101 == 0, F.lit("2024-02-30"))
            .otherwise(F.col("o_orderdate").cast("date").cast("string")))
    return o.select("o_orderkey", text.alias("purchase_text"))


_TEXT_DATES = """WITH src AS (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'unknown'
  WHEN o_orderkey % 101 = 0 THEN '2024-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS purchase_text
  FROM orders)
"""
_q("parse_date_coerce", lambda s, d: _text_dates(s, d).withColumn("purchase_date", parse_date_coerce("purchase_text")),
   _TEXT_DATES + "SELECT *, TRY_CAST(purchase_text AS DATE) AS purchase_date FROM src")
_q("parse_date_strict", lambda s, d: tables.table(s, d, "orders", ["o_orderkey", "o_orderdate"]).select(
       "o_orderkey", parse_date_strict(F.col("o_orderdate").cast("date").cast("string")).alias("purchase_date")),
   "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS purchase_date FROM orders")
_q("filter_invalid_dates",
   lambda s, d: profile.head_n(
       _text_dates(s, d).where(parse_date_coerce("purchase_text").isNull()), ["o_orderkey"], 5),
   _TEXT_DATES + "SELECT * FROM src WHERE TRY_CAST(purchase_text AS DATE) IS NULL ORDER BY o_orderkey LIMIT 5")


def _text_times(s, d):
    """Times of purchase as people write them: some without a leading zero, some no times."""
    o, k = tables.table(s, d, "orders", ["o_orderkey"]), F.col("o_orderkey")
    hour, rest = (k % 24).cast("string"), F.lpad((k % 60).cast("string"), 2, "0")
    padded = F.when(k % 3 == 0, hour).otherwise(F.lpad(hour, 2, "0"))
    text = F.when(k % 89 == 0, F.lit("25:00:00")).otherwise(F.concat_ws(":", padded, rest, F.lit("00")))
    return o.select("o_orderkey", text.alias("time_text"))


_TEXT_TIMES = """WITH src AS (SELECT o_orderkey, CASE WHEN o_orderkey % 89 = 0 THEN '25:00:00'
  ELSE CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 24 AS VARCHAR)
            ELSE lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') END
       || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':00' END AS time_text FROM orders)
"""
_q("parse_time_text", lambda s, d: _text_times(s, d).select(
       "o_orderkey", "time_text", seconds_of_day("time_text").alias("seconds")),
   _TEXT_TIMES + "SELECT o_orderkey, time_text, CASE WHEN o_orderkey % 89 <> 0 THEN CAST(o_orderkey % 24 * 3600 "
                 "+ o_orderkey % 60 * 60 AS INTEGER) END AS seconds FROM src")
_q("hourly_transactions_text", lambda s, d: group_count(
       _text_times(s, d).select(hour_of_day("time_text").alias("hour")), ["hour"], "number_of_transactions"),
   _TEXT_TIMES + "SELECT CAST(o_orderkey % 24 AS INTEGER) AS hour, count(*) AS number_of_transactions FROM src "
                 "WHERE o_orderkey % 89 <> 0 GROUP BY 1")

# ------------------------------------------------------------------ derived columns

_q("calendar_parts",
   lambda s, d: _rides(s, d).select("transaction_id", *[
       v.alias(k) for k, v in {**calendar_parts("date_of_purchase", "purchase"),
                               **calendar_parts("date_of_journey", "journey")}.items()]),
   with_ctes(["rides"], "SELECT transaction_id, " + ", ".join(
       f"CAST({fn}({col}) AS INTEGER) AS {p}_{part}"
       for col, p in (("date_of_purchase", "purchase"), ("date_of_journey", "journey"))
       for fn, part in (("year", "year"), ("month", "month"), ("day", "day"))) + " FROM rides"))
_q("calendar_alias_columns",
   lambda s, d: _rides(s, d).select("transaction_id", *[
       v.alias(k) for k, v in calendar_alias_columns("date_of_purchase").items()]),
   with_ctes(["rides"], "SELECT transaction_id, " + ", ".join(
       [f'CAST(year(date_of_purchase) AS INTEGER) AS "{n}"' for n in ("2023", "2024")]
       + [f'CAST(month(date_of_purchase) AS INTEGER) AS "{n}"' for n in (
           "January", "Feburary", "March", "April", "May", "June", "July", "August",
           "September", "October", "November", "December")]) + " FROM rides"))
_q("month_name",
   lambda s, d: _rides(s, d).select("transaction_id", month_name("date_of_purchase").alias("month_name")),
   with_ctes(["rides"], "SELECT transaction_id, strftime(date_of_purchase, '%B') AS month_name FROM rides"))
_q("hour_of_day",
   lambda s, d: _rides(s, d).select("transaction_id", hour_of_day("time_of_purchase").alias("hour_of_day")),
   with_ctes(["rides"], f"SELECT transaction_id, CAST({secs('time_of_purchase')} // 3600 AS INTEGER) "
                        "AS hour_of_day FROM rides"))
_q("parse_time_of_day",
   lambda s, d: _rides(s, d).select(
       "transaction_id", *[seconds_of_day(c).alias(f"{c}_seconds") for c in (
           "time_of_purchase", "departure_time", "arrival_time", "actual_arrival_time")]),
   with_ctes(["rides"], "SELECT transaction_id, " + ", ".join(
       f"{secs(c)} AS {c}_seconds" for c in (
           "time_of_purchase", "departure_time", "arrival_time", "actual_arrival_time"))
       + " FROM rides"))
_q("journey_duration_wrapped",
   lambda s, d: _rides(s, d).select(
       "transaction_id",
       minutes_between_wrapped("departure_time", "arrival_time").alias("duration_time_wrapped")),
   with_ctes(["rides"], f"""SELECT transaction_id,
       (CASE WHEN {secs('arrival_time')} - {secs('departure_time')} < 0
             THEN {secs('arrival_time')} - {secs('departure_time')} + 86400
             ELSE {secs('arrival_time')} - {secs('departure_time')} END) / 60.0::DOUBLE
       AS duration_time_wrapped FROM rides"""))
_q("clean_price",
   lambda s, d: _rides(s, d).select("transaction_id", price_text("price").alias("price_text"))
   .withColumn("price2", clean_price("price_text")),
   with_ctes(["rides"], """SELECT transaction_id, '£' || format('{:,.2f}', CAST(price AS DOUBLE)) AS price_text,
       CAST(TRY_CAST(replace(replace('£' || format('{:,.2f}', CAST(price AS DOUBLE)), '£', ''), ',', '')
            AS DECIMAL(10,0)) AS INTEGER) AS price2 FROM rides"""))
_q("sql_cleandata2", _priced_rides, with_ctes(["priced_rides"], "SELECT * FROM priced_rides"))

# ------------------------------------------------------------------ star schema

_q("station_union_distinct", lambda s, d: star.station_union_distinct(_rides(s, d)),
   with_ctes(["rides"], "SELECT station_name FROM (SELECT departure_station AS station_name FROM rides "
                        "UNION SELECT arrival_destination FROM rides) s WHERE station_name IS NOT NULL"))
_q("dim_location", lambda s, d: star.dim_location(_rides(s, d)),
   with_ctes(["dim_location"], "SELECT * FROM dim_location"))
_q("surrogate_row_id",
   lambda s, d: star.row_ids(_rides(s, d)).select("transaction_id", "row_id"),
   with_ctes(["ided"], "SELECT transaction_id, row_id FROM ided"))
_q("dim_time", lambda s, d: star.dim_time(star.row_ids(_rides(s, d), *star.TIME_SOURCE)), with_ctes(["dim_time"], "SELECT * FROM dim_time"))
_q("dim_journey", lambda s, d: star.dim_journey(star.row_ids(_rides(s, d), *star.JOURNEY_SOURCE)),
   with_ctes(["dim_journey"], "SELECT * FROM dim_journey"))
_q("fact_transactions", lambda s, d: _star(s, d).fact, with_ctes(["fact"], "SELECT * FROM fact"))
_q("star_denormalised", lambda s, d: star.star_denormalised(_rides(s, d)),
   with_ctes(["denorm"], "SELECT * FROM denorm"))
_q("dim_time_b", lambda s, d: star.dim_time_b(_tickets(s, d)),
   with_ctes(["dim_time_b"], "SELECT * FROM dim_time_b"))
_q("dim_journey_b", lambda s, d: star.dim_journey_b(_tickets(s, d)),
   with_ctes(["dim_journey_b"], "SELECT * FROM dim_journey_b"))


def _fact_b(s, d):
    return star.StarB(_tickets(s, d)).fact


_q("fact_skeleton", lambda s, d: star.fact_skeleton(_clean(s, d)),
   with_ctes(["fact"], "SELECT transaction_id, purchase_type, payment_method, railcard, ticket_class, ticket_type, "
             "price, journey_status, refund_request, CAST(NULL AS INTEGER) AS departure_station_id, "
             "CAST(NULL AS INTEGER) AS arrival_station_id, CAST(NULL AS BIGINT) AS time_id, "
             "CAST(NULL AS BIGINT) AS journey_id FROM fact"))
_q("fact_string_keys", lambda s, d: star.cast_keys_string(_star(s, d).fact, star.FK_COLUMNS),
   with_ctes(["fact"], "SELECT * REPLACE (" + ", ".join(
       f"CAST({c} AS VARCHAR) AS {c}" for c in star.FK_COLUMNS) + ") FROM fact"))
_q("fact_b", _fact_b, with_ctes(["fact_b"], "SELECT * FROM fact_b"))


def _ids_of(dim, id_col, name):
    return dim.agg(F.lit(name).alias("dimension"), F.count(F.lit(1)).alias("n"), F.countDistinct(id_col).alias("ids"),
                   F.min(id_col).alias("least"), F.max(id_col).alias("most"))


def _batches(s, d):
    """The tickets in three batches by the month of purchase, as they would arrive, one of them twice."""
    def build(path):
        t = materialise(_tickets(s, d).select(*star.TICKET_B_COLS), "tickets")  # the purchases are joined once, not for each batch
        month = F.month("date_of_purchase")
        for name, part in (("a", month <= 4), ("b", month.between(5, 8)), ("a", month <= 4), ("c", month.isNull() | (month > 8))):
            increments.load_batch(s, t.where(part), path, name, stored=True)
        return path
    return increments.tables(s, _once("batches", s, d, build))


def _fact_of_batches(s, d):
    t = _batches(s, d)
    times = t["dim_time"].select("time_id", "purchase_date", "time_of_purchase").hint("shuffle_hash")  # as in the lookups:
    journeys = t["dim_journey"].select("journey_id", *star.JOURNEY_B_COLS).hint("shuffle_hash")  # facts aren't sorted
    return t["fact"].join(times, "time_id", "left").join(journeys, "journey_id", "left").drop("time_id", "journey_id")


_q("fact_b_batches", _fact_of_batches,
   with_ctes(["fact_b", "dim_time_b", "dim_journey_b"], "SELECT f.* EXCLUDE (time_id, journey_id), t.purchase_date, t.time_of_purchase, "
             + ", ".join(f"j.{c}" for c in star.JOURNEY_B_COLS)
             + " FROM fact_b f LEFT JOIN dim_time_b t USING (time_id) LEFT JOIN dim_journey_b j USING (journey_id)"))
_q("dim_ids_batches", lambda s, d: _ids_of(_batches(s, d)["dim_time"], "time_id", "dim_time").unionByName(
    _ids_of(_batches(s, d)["dim_journey"], "journey_id", "dim_journey")),
   with_ctes(["dim_time_b", "dim_journey_b"], "SELECT 'dim_time' AS dimension, count(*) AS n, count(*) AS ids, min(time_id) AS least, "
             "max(time_id) AS most FROM dim_time_b UNION ALL SELECT 'dim_journey', count(*), count(*), min(journey_id), max(journey_id) "
             "FROM dim_journey_b"))
_q("fk_null_check", lambda s, d: star.fk_null_check(_fact_b(s, d)),
   with_ctes(["fact_b"], "SELECT count(*) - count(time_id) AS null_time_ids, "
                         "count(*) - count(journey_id) AS null_journey_ids FROM fact_b"))
_q("fk_sample",
   lambda s, d: profile.head_n(_fact_b(s, d).select("transaction_id", "time_id", "journey_id"),
                               ["transaction_id", "time_id", "journey_id"], 5),
   with_ctes(["fact_b"], "SELECT transaction_id, time_id, journey_id FROM fact_b "
                         "ORDER BY transaction_id, time_id, journey_id LIMIT 5"))

# ------------------------------------------------------------------ value counts (A1, A2)

for _c in RIDES_COLUMNS:
    _q(f"value_counts_{_c}", (lambda c: lambda s, d: value_counts(_rides(s, d), c))(_c),
       with_ctes(["rides"], f"SELECT {_c}, count(*) AS count FROM rides WHERE {_c} IS NOT NULL "
                            f"GROUP BY {_c}"))
for _c in ("reason_for_delay", "railcard"):
    _q(f"value_counts_{_c}_filled", (lambda c: lambda s, d: value_counts(_clean(s, d), c))(_c),
       with_ctes(["rides_clean"], f"SELECT {_c}, count(*) AS count FROM rides_clean GROUP BY {_c}"))
_q("value_counts_month_name", lambda s, d: reports.month_name_counts(_rides(s, d)),
   with_ctes(["rides"], "SELECT strftime(date_of_purchase, '%B') AS month_name, count(*) AS count "
                        "FROM rides GROUP BY 1"))

# ------------------------------------------------------------------ notebook reports

_q("price_totals", lambda s, d: reports.price_totals(_rides(s, d)),
   with_ctes(["rides"], "SELECT CAST(sum(price) AS DOUBLE) / CAST(count(price) AS DOUBLE) AS mean_price, "
                        "CAST(sum(price) AS DOUBLE) AS total_price, CAST(min(price) AS DOUBLE) AS min_price, "
                        "CAST(max(price) AS DOUBLE) AS max_price, count(price) AS price_count FROM rides"))
_q("daily_transactions_by_journey",
   lambda s, d: group_count(_rides(s, d), ["date_of_journey"], "number_of_transactions"),
   with_ctes(["rides"], "SELECT date_of_journey, count(*) AS number_of_transactions FROM rides "
                        "WHERE date_of_journey IS NOT NULL GROUP BY 1"))
_q("daily_transactions_by_purchase",
   lambda s, d: group_count(_rides(s, d), ["date_of_purchase"], "number_of_transactions"),
   with_ctes(["rides"], "SELECT date_of_purchase, count(*) AS number_of_transactions FROM rides "
                        "WHERE date_of_purchase IS NOT NULL GROUP BY 1"))
_q("daily_transactions_events",
   lambda s, d: group_count(tables.events(s, d).select(F.to_date("ts").alias("event_date")),
                            ["event_date"], "number_of_transactions"),
   "SELECT CAST(ts AS DATE) AS event_date, count(*) AS number_of_transactions FROM events "
   "WHERE ts IS NOT NULL GROUP BY 1")
_q("daily_revenue", lambda s, d: group_sum(_rides(s, d), ["date_of_journey"], "price", "daily_revenue"),
   with_ctes(["rides"], "SELECT date_of_journey, CAST(sum(price) AS DOUBLE) AS daily_revenue FROM rides "
                        "WHERE date_of_journey IS NOT NULL GROUP BY 1"))
_q("hourly_transactions", lambda s, d: reports.hourly_transactions(_rides(s, d)),
   with_ctes(["rides"], f"SELECT CAST({secs('time_of_purchase')} // 3600 AS INTEGER) AS hour, "
                        "count(*) AS number_of_transactions FROM rides WHERE time_of_purchase IS NOT NULL "
                        "GROUP BY 1"))
_q("hourly_transactions_events",
   lambda s, d: group_count(tables.events(s, d).select(F.hour("ts").alias("hour")), ["hour"],
                            "number_of_transactions"),
   "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS number_of_transactions FROM events "
   "WHERE ts IS NOT NULL GROUP BY 1")
_q("hour_spine",
   lambda s, d: reports.hourly_spine(s, _rides(s, d).select(hour_of_day("time_of_purchase").alias("hour"))),
   with_ctes(["rides"], f"SELECT CAST(h.hour AS INTEGER) AS hour, CAST(coalesce(c.n, 0) AS BIGINT) "
             "AS number_of_transactions FROM range(24) h(hour) LEFT JOIN (SELECT "
             f"{secs('time_of_purchase')} // 3600 AS hour, count(*) AS n FROM rides GROUP BY 1) c "
             "ON h.hour = c.hour"))
_q("hour_spine_events",
   lambda s, d: reports.hourly_spine(s, tables.events(s, d).select(F.hour("ts").alias("hour"))),
   "SELECT CAST(h.hour AS INTEGER) AS hour, CAST(coalesce(c.n, 0) AS BIGINT) AS number_of_transactions "
   "FROM range(24) h(hour) LEFT JOIN (SELECT hour(ts) AS hour, count(*) AS n FROM events "
   "GROUP BY 1) c ON h.hour = c.hour")
for _k in ("journey_status", "ticket_type", "ticket_class"):
    _q(f"revenue_by_{_k}", (lambda k: lambda s, d: group_sum(_clean(s, d), [k], "price", "revenue"))(_k),
       with_ctes(["rides_clean"], f"SELECT {_k}, CAST(sum(price) AS DOUBLE) AS revenue FROM rides_clean "
                                  f"WHERE {_k} IS NOT NULL GROUP BY 1"))
_q("avg_price_by_ticket_type",
   lambda s, d: group_mean(_clean(s, d), ["ticket_type"], "price", "avg_price"),
   with_ctes(["rides_clean"], "SELECT ticket_type, CAST(sum(price) AS DOUBLE) / CAST(count(price) AS DOUBLE) "
                              "AS avg_price FROM rides_clean WHERE ticket_type IS NOT NULL GROUP BY 1"))
_q("revenue_by_status_refund",
   lambda s, d: group_sum(_fact_measures(s, d), ["journey_status", "refund_request"], "price", "revenue"),
   with_ctes(["fact"], "SELECT journey_status, refund_request, CAST(sum(price) AS DOUBLE) AS revenue "
                       "FROM fact WHERE journey_status IS NOT NULL AND refund_request IS NOT NULL GROUP BY 1, 2"))
_q("count_by_status_refund",
   lambda s, d: group_count(_fact_measures(s, d), ["journey_status", "refund_request"], "count"),
   with_ctes(["fact"], "SELECT journey_status, refund_request, count(*) AS count FROM fact "
                       "WHERE journey_status IS NOT NULL AND refund_request IS NOT NULL GROUP BY 1, 2"))
_q("pivot_revenue_purchase_ticket", lambda s, d: reports.pivot_revenue_purchase_ticket(_clean(s, d)),
   with_ctes(["rides_clean"], "SELECT purchase_type, "
             "CAST(sum(price) FILTER (WHERE ticket_type = 'Advance') AS DOUBLE) AS advance, "
             "CAST(sum(price) FILTER (WHERE ticket_type = 'Anytime') AS DOUBLE) AS anytime, "
             "CAST(sum(price) FILTER (WHERE ticket_type = 'Off-Peak') AS DOUBLE) AS off_peak "
             "FROM rides_clean WHERE purchase_type IS NOT NULL AND ticket_type IS NOT NULL GROUP BY 1"))
_q("refund_revenue_matrix", lambda s, d: reports.refund_revenue_matrix(_fact_measures(s, d)),
   with_ctes(["fact"], "SELECT journey_status, "
             "coalesce(CAST(sum(price) FILTER (WHERE refund_request = 'No') AS DOUBLE), 0.0) AS no, "
             "coalesce(CAST(sum(price) FILTER (WHERE refund_request = 'Yes') AS DOUBLE), 0.0) AS yes "
             "FROM fact WHERE journey_status IN ('Cancelled', 'Delayed') AND refund_request IS NOT NULL "
             "GROUP BY 1"))
_q("refund_count_matrix", lambda s, d: reports.refund_count_matrix(s, _fact_measures(s, d)),
   with_ctes(["fact"], "SELECT r.row_order, r.journey_status, c.no, c.yes FROM "
             "(VALUES (0, 'Cancelled'), (1, 'Delayed'), (2, 'On Time')) r(row_order, journey_status) "
             "LEFT JOIN (SELECT journey_status, count(*) FILTER (WHERE refund_request = 'No') AS no, "
             "count(*) FILTER (WHERE refund_request = 'Yes') AS yes FROM fact "
             "WHERE refund_request IS NOT NULL GROUP BY 1) c ON r.journey_status = c.journey_status"))
for _k in ("purchase_type", "payment_method", "journey_status", "refund_request"):
    _src = "fact" if _k == "refund_request" else "rides_clean"
    _q(f"share_{_k}", (lambda k, src: lambda s, d: reports.share_of_counts(
        _fact_measures(s, d) if src == "fact" else _clean(s, d), k))(_k, _src),
       with_ctes([_src], f"SELECT {_k}, count(*) AS count, {pct('count(*)', 'sum(count(*)) OVER ()')} "
                         f"AS share_pct FROM {_src} WHERE {_k} IS NOT NULL GROUP BY 1"))
_q("share_ticket_class_revenue", lambda s, d: reports.share_of_revenue(_clean(s, d), "ticket_class"),
   with_ctes(["rides_clean"], f"SELECT ticket_class, CAST(sum(price) AS DOUBLE) AS revenue, "
                              f"{pct('sum(price)', 'sum(sum(price)) OVER ()')} AS share_pct "
                              "FROM rides_clean WHERE ticket_class IS NOT NULL GROUP BY 1"))
_q("top5_departure_stations", lambda s, d: reports.top5_departure_stations(_clean(s, d)),
   with_ctes(["rides_clean"], "SELECT departure_station, CAST(sum(price) AS DOUBLE) AS revenue "
                              "FROM rides_clean WHERE departure_station IS NOT NULL GROUP BY 1 "
                              "ORDER BY sum(price) DESC, departure_station LIMIT 5"))
_q("category_domain_ticket_type", lambda s, d: category_domain(_fact_measures(s, d), "ticket_type"),
   with_ctes(["fact"], "SELECT DISTINCT ticket_type FROM fact WHERE ticket_type IS NOT NULL"))

# ------------------------------------------------------------------ SQL script reports


def _groups_sql(keys: str, least: int = 2, top: int | None = None) -> str:
    """Groups by size, written over a grouped subquery."""
    sql = f"SELECT * FROM (SELECT {keys}, count(*) AS tickets FROM priced_rides GROUP BY ALL) g WHERE tickets >= {least}"
    names = ", ".join(k.split(" AS ")[-1] + " NULLS FIRST" for k in keys.split(", "))
    return sql + (f" ORDER BY tickets DESC, {names} LIMIT {top}" if top else "")


_CLEANED_SQL = {
    "sql_avg_price2": "SELECT sum(price2)::DOUBLE / count(price2) AS mean_price FROM priced_rides",
    "sql_class_railcard": _groups_sql("ticket_class, railcard"),
    "sql_group_count_payment_method": _groups_sql("payment_method"),
    "sql_group_count_purchase_type": _groups_sql("purchase_type"),
    "sql_group_count_railcard": _groups_sql("railcard"),
    "sql_group_count_ticket_class": _groups_sql("ticket_class"),
    "sql_group_count_ticket_type": _groups_sql("ticket_type"),
    "sql_month_journeys": _groups_sql("CAST(month(date_of_journey) AS INTEGER) AS month", least=1),
    "sql_month_purchases": _groups_sql("CAST(month(date_of_purchase) AS INTEGER) AS month", least=1),
    "sql_status_reason": _groups_sql("journey_status, reason_for_delay"),
    "sql_status_refund_top3": _groups_sql("journey_status, refund_request", top=3),
}
for _n, _report in reports.CLEANED_REPORTS.items():
    _q(_n, (lambda report: lambda s, d: report(_priced_rides(s, d)))(_report),
       with_ctes(["priced_rides"], _CLEANED_SQL[_n]))
_q("sql_having_lineitem",
   lambda s, d: having_count(tables.lineitem_keys(s, d), ["l_orderkey", "l_linenumber"], "number_"),
   "SELECT l_orderkey, l_linenumber, count(*) AS number_ FROM lineitem "
   "GROUP BY 1, 2 HAVING count(*) > 1")

# ------------------------------------------------------------------ profiling

_NUMERIC_SRC = """SELECT CAST(day(date_of_journey) AS INTEGER) AS day,
  CAST(month(date_of_journey) AS INTEGER) AS month, CAST(year(date_of_journey) AS INTEGER) AS year,
  price FROM rides_clean"""


def _numeric_frame(s, d):
    c = _clean(s, d)
    return c.select(F.dayofmonth("date_of_journey").alias("day"),
                    F.month("date_of_journey").alias("month"),
                    F.year("date_of_journey").alias("year"), "price")


def _stacked_sql(cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DECIMAL(38,6)) AS value FROM src" for c in cols)


_NUM_COLS = ["day", "month", "year", "price"]
_q("profile_describe", lambda s, d: profile.describe(_rides(s, d), ["price"]),
   with_ctes(["rides"], f"""SELECT 'price' AS column_name, count(price) AS count,
       {r2('CAST(sum(price) AS DOUBLE) / CAST(count(price) AS DOUBLE)')} AS mean,
       {r2('stddev_samp(CAST(price AS DOUBLE))')} AS std, {r2('min(price)')} AS min,
       {r2('quantile_cont(CAST(price AS DECIMAL(38,6)), 0.25)')} AS p25, {r2('quantile_cont(CAST(price AS DECIMAL(38,6)), 0.5)')} AS p50,
       {r2('quantile_cont(CAST(price AS DECIMAL(38,6)), 0.75)')} AS p75, {r2('max(price)')} AS max FROM rides"""))
_q("profile_numeric", lambda s, d: profile.numeric_profile(_numeric_frame(s, d), _NUM_COLS),
   with_ctes(["rides_clean"], f"""
, src AS ({_NUMERIC_SRC}), st AS ({_stacked_sql(_NUM_COLS)}),
modes AS (SELECT column_name, value AS mode FROM (
    SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) AS rn
    FROM st WHERE value IS NOT NULL GROUP BY 1, 2) x WHERE rn = 1),
m AS (SELECT column_name, count(*) AS count, sum(value) AS total, count(value) AS nn,
    stddev_samp(CAST(value AS DOUBLE)) AS std, min(value) AS mn, max(value) AS mx,
    quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3
  FROM st GROUP BY 1)
SELECT m.column_name, count, {r2('total')} AS total,
  {r2('CAST(total AS DOUBLE) / CAST(nn AS DOUBLE)')} AS mean, {r2('q2')} AS median, {r2('mode')} AS mode,
  {r2('q1')} AS q1, {r2('q2')} AS q2, {r2('q3')} AS q3, {r2('q3 - q1')} AS iqr, {r2('std')} AS std,
  {r2('mn')} AS min, {r2('mx')} AS max
FROM m LEFT JOIN modes USING (column_name)"""))
# Column names whose quartiles the revised notebook leaves out.
_DATE_LIKE = ["date", "day", "month", "year", "date of journey"]
_DUR_COLS = ["price", "duration_time", "delay_period", "day"]


def _durations(s, d):
    c = _clean(s, d)
    return c.select("price", minutes_between_wrapped("departure_time", "arrival_time").alias("duration_time"),
                    delay_minutes("actual_arrival_time", "arrival_time").alias("delay_period"),
                    F.dayofmonth("date_of_journey").alias("day"))


_DUR_SRC = f"""SELECT CAST(price AS DOUBLE) AS price,
  (CASE WHEN {secs('arrival_time')} < {secs('departure_time')} THEN 86400 ELSE 0 END
   + {secs('arrival_time')} - {secs('departure_time')}) / 60.0::DOUBLE AS duration_time,
  greatest(0.0::DOUBLE, ({secs('actual_arrival_time')} - {secs('arrival_time')}) / 60.0::DOUBLE) AS delay_period,
  CAST(day(date_of_journey) AS DOUBLE) AS day FROM rides_clean"""
_DUR_STACK = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value FROM src" for c in _DUR_COLS)
_q("profile_numeric_date_like", lambda s, d: profile.numeric_profile(_numeric_frame(s, d), _NUM_COLS, _DATE_LIKE),
   with_ctes(["rides_clean"], f"""
, src AS ({_NUMERIC_SRC}), st AS ({_stacked_sql(_NUM_COLS)}),
modes AS (SELECT column_name, min_by(value, (-cnt, value)) AS mode FROM (
    SELECT column_name, value, count(*) AS cnt FROM st WHERE value IS NOT NULL GROUP BY 1, 2) x GROUP BY 1),
m AS (SELECT column_name, count(*) AS count, sum(value) AS total, count(value) AS nn,
    stddev_samp(CAST(value AS DOUBLE)) AS std, min(value) AS mn, max(value) AS mx,
    quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3
  FROM st GROUP BY 1)
SELECT m.column_name, count, {r2('total')} AS total,
  {r2('CAST(total AS DOUBLE) / CAST(nn AS DOUBLE)')} AS mean, {r2('q2')} AS median, {r2('mode')} AS mode,
  CASE WHEN column_name = 'price' THEN {r2('q1')} END AS q1, CASE WHEN column_name = 'price' THEN {r2('q2')} END AS q2,
  CASE WHEN column_name = 'price' THEN {r2('q3')} END AS q3, CASE WHEN column_name = 'price' THEN {r2('q3 - q1')} END AS iqr,
  {r2('std')} AS std, {r2('mn')} AS min, {r2('mx')} AS max
FROM m JOIN modes USING (column_name)"""))


def _r6(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), 6) AS DOUBLE)"


_q("profile_describe_all", lambda s, d: profile.describe(_durations(s, d), _DUR_COLS, digits=6),
   with_ctes(["rides_clean"], f"""
, src AS ({_DUR_SRC}), st AS ({_DUR_STACK})
SELECT column_name, count(value) AS count, {_r6('avg(value)')} AS mean, {_r6('stddev_samp(value)')} AS std,
  {_r6('min(value)')} AS min, {_r6('quantile_cont(value, 0.25)')} AS p25, {_r6('quantile_cont(value, 0.5)')} AS p50,
  {_r6('quantile_cont(value, 0.75)')} AS p75, {_r6('max(value)')} AS max FROM st GROUP BY 1"""))
_q("profile_numeric_all_modes", lambda s, d: profile.all_modes(_numeric_frame(s, d), _NUM_COLS),
   with_ctes(["rides_clean"], f"""
, src AS ({_NUMERIC_SRC}), st AS ({_stacked_sql(_NUM_COLS)}),
f AS (SELECT column_name, value, count(*) AS cnt FROM st WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT column_name, {r2('value')} AS mode, cnt AS mode_count FROM f
WHERE cnt = (SELECT max(cnt) FROM f f2 WHERE f2.column_name = f.column_name)"""))
# DuckDB's own type of each derived column, spelled as Spark names it (VARCHAR → string, ...).
_SPARK_TYPE_NAME = "lower(replace(replace(min(typeof({c})), 'VARCHAR', 'string'), 'INTEGER', 'int'))"
_q("profile_schema", lambda s, d: profile.schema_profile(_rides(s, d)),
   with_ctes(["rides"], " UNION ALL ".join(
       f"SELECT {i} AS ordinal, '{c}' AS column_name, {_SPARK_TYPE_NAME.format(c=c)} AS data_type, "
       f"count({c}) AS non_null_count, count(*) AS row_count, {len(RIDES_COLUMNS)} AS column_count "
       "FROM rides" for i, c in enumerate(RIDES_COLUMNS))))
_q("profile_null_counts", lambda s, d: profile.null_counts(_rides(s, d)),
   with_ctes(["rides"], " UNION ALL ".join(
       f"SELECT {i} AS ordinal, '{c}' AS column_name, count(*) - count({c}) AS null_count FROM rides"
       for i, c in enumerate(RIDES_COLUMNS))))
_q("profile_null_percent", lambda s, d: profile.null_counts(_rides(s, d), with_percent=True),
   with_ctes(["rides"], " UNION ALL ".join(
       f"SELECT {i} AS ordinal, '{c}' AS column_name, count(*) - count({c}) AS null_count, "
       f"100.0::DOUBLE * (count(*) - count({c})) / CAST(count(*) AS DOUBLE) AS null_pct FROM rides"
       for i, c in enumerate(RIDES_COLUMNS))))
_q("profile_remaining_nulls",
   lambda s, d: _clean(s, d).agg(F.count_if(F.col("actual_arrival_time").isNull()).alias("remaining_nulls")),
   with_ctes(["rides_clean"], "SELECT count(*) - count(actual_arrival_time) AS remaining_nulls FROM rides_clean"))
_q("profile_duplicates", lambda s, d: profile.duplicate_count(_rides(s, d)),
   with_ctes(["rides"], "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM rides) x) "
                        "AS BIGINT) AS duplicate_rows FROM rides"))
_q("profile_duplicates_lineitem", lambda s, d: profile.duplicate_count(tables.lineitem_keys(s, d)),
   "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) x) "
   "AS BIGINT) AS duplicate_rows FROM lineitem")
_CAT_COLS = ["journey_status", "payment_method", "railcard", "ticket_type", "ticket_class",
             "purchase_type", "reason_for_delay", "date_of_journey"]
_CAT_STACK = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM rides_clean" for c in _CAT_COLS)
_CAT_SUMMARY = f"""st AS ({_CAT_STACK}),
f AS (SELECT column_name, value, count(*) AS cnt FROM st GROUP BY 1, 2),
pc AS (SELECT column_name, sum(cnt) AS total_count, count(value) AS unique_values,
       max(cnt) FILTER (WHERE value IS NOT NULL) AS most_common_count FROM f GROUP BY 1),
w AS (SELECT pc.column_name, total_count, unique_values, most_common_count, min(value) AS most_common
      FROM pc LEFT JOIN f ON f.column_name = pc.column_name AND f.cnt = pc.most_common_count
                          AND f.value IS NOT NULL GROUP BY 1, 2, 3, 4)"""
_q("profile_categorical", lambda s, d: profile.categorical_profile(_clean(s, d), _CAT_COLS),
   with_ctes(["rides_clean"], "") + f""", {_CAT_SUMMARY}
SELECT f.column_name, f.value, f.cnt AS count, total_count, unique_values, most_common, most_common_count
FROM f JOIN w ON f.column_name = w.column_name WHERE f.value IS NOT NULL""")
_RAW_STACK = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM rides" for c in RIDES_COLUMNS)
_q("distinct_count_per_column",
   lambda s, d: profile.distinct_count_per_column(_rides(s, d), RIDES_COLUMNS),
   with_ctes(["rides"], "") + ", " + _CAT_SUMMARY.replace(_CAT_STACK, _RAW_STACK)
   + "\nSELECT column_name, unique_values, most_common, most_common_count FROM w")
_q("most_common_values", lambda s, d: profile.most_common_values(_rides(s, d), RIDES_COLUMNS),
   with_ctes(["rides"], "") + ", " + _CAT_SUMMARY.replace(_CAT_STACK, _RAW_STACK)
   + "\nSELECT column_name, most_common, most_common_count FROM w")
_q("row_at_position",
   lambda s, d: profile.row_at_position(_rides(s, d), star.ROW_ORDER, [0, 1, 777]),
   with_ctes(["rides"], "SELECT * EXCLUDE (rn), rn - 1 AS position FROM (SELECT *, row_number() OVER "
                        "(ORDER BY date_of_purchase NULLS FIRST, time_of_purchase NULLS FIRST, "
                        "transaction_id NULLS FIRST) AS rn FROM rides) x WHERE rn IN (1, 2, 778)"))
_q("head_n", lambda s, d: profile.head_n(_rides(s, d), [F.asc(c) for c in star.ROW_ORDER], 5),
   with_ctes(["rides"], "SELECT * FROM rides ORDER BY date_of_purchase, time_of_purchase, "
                        "transaction_id LIMIT 5"))


_OPTIONS = {"month": "month", "departure_station_name": "station", "ticket_type": "ticket_type",
            "railcard": "railcard", "payment_method": "payment"}


def _filter_options(s, d):
    """Q12: the values of the five filters, from the stored domains."""
    option = F.create_map(*[F.lit(x) for pair in _OPTIONS.items() for x in pair])[F.col("column_name")]
    month = F.when(F.col("column_name") == "month", F.col("value").cast("int"))
    label = F.coalesce(F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM"), F.col("value"))
    return (_panel_base(s, d).domains.where(F.col("column_name").isin(*_OPTIONS))
            .select(option.alias("option"), "value", label.alias("label")).orderBy("option", "value"))


_q("filter_options", _filter_options, with_ctes(["denorm", "dim_location"], """
SELECT DISTINCT 'month' AS option, CAST(month AS VARCHAR) AS value,
  strftime(make_date(2000, month, 1), '%B') AS label FROM denorm WHERE month IS NOT NULL
UNION SELECT 'station', station_name, station_name FROM dim_location
UNION SELECT DISTINCT 'ticket_type', ticket_type, ticket_type FROM denorm WHERE ticket_type IS NOT NULL
UNION SELECT DISTINCT 'railcard', railcard, railcard FROM denorm WHERE railcard IS NOT NULL
UNION SELECT DISTINCT 'payment', payment_method, payment_method FROM denorm WHERE payment_method IS NOT NULL"""))

# ------------------------------------------------------------------ dashboard panels

_FULL = {  # panel → (keys, kind, value, out column)
    "panel_revenue_ticket": (["ticket_type"], "sum", "revenue"),
    "panel_status": (["journey_status"], "count", "count"),
    "panel_class_revenue": (["ticket_class"], "sum", "revenue"),
    "panel_top5_stations": (["departure_station_name"], "sum", "revenue"),
    "panel_railcard": (["railcard"], "count", "number_of_transactions"),
    "panel_avg_price": (["ticket_type"], "mean", "avg_price"),
    "panel_purchase_type": (["purchase_type"], "count", "count"),
    "panel_revenue_refund": (["journey_status", "refund_request"], "sum", "revenue"),
    "panel_refund_share": (["refund_request"], "count", "count"),
    "panel_refund_count": (["journey_status", "refund_request"], "count", "count"),
    "panel_payment": (["payment_method"], "count", "count"),
}
_SHARED = {"panel_status", "panel_class_revenue", "panel_purchase_type", "panel_refund_share",
           "panel_payment"}


def _where(f: PanelFilters | None) -> str:
    if f is None or not f.predicates():
        return ""
    conds = []
    for col, v in f.predicates():
        conds.append(f"{col} = {v}" if isinstance(v, int) else f"{col} = '{v}'")
    return " WHERE " + " AND ".join(conds)


def _panel_sql(name: str, f: PanelFilters | None) -> str:
    w = _where(f)
    if name == "panel_hourly":
        return with_ctes(["denorm"], f"SELECT hour_of_day, count(*) AS number_of_transactions FROM denorm{w}"
                                     f"{' AND' if w else ' WHERE'} hour_of_day IS NOT NULL GROUP BY 1")
    if name == "panel_daily_tx":
        return with_ctes(["denorm"], f"SELECT purchase_date, count(*) AS number_of_transactions FROM denorm{w}"
                                     f"{' AND' if w else ' WHERE'} purchase_date IS NOT NULL GROUP BY 1")
    if name == "panel_daily_revenue":
        return with_ctes(["denorm"], f"SELECT journey_date, CAST(sum(price) AS DOUBLE) AS daily_revenue "
                                     f"FROM denorm{w}{' AND' if w else ' WHERE'} journey_date IS NOT NULL GROUP BY 1")
    if name == "panel_delay_reasons":
        return with_ctes(["denorm"], f"SELECT reason_for_delay AS reason, count(*) AS count FROM denorm{w}"
                                     f"{' AND' if w else ' WHERE'} reason_for_delay <> 'No Delay' GROUP BY 1")
    keys, kind, out = _FULL[name]
    kl = ", ".join(keys)
    if keys == ["departure_station_name"]:
        dom = "SELECT station_name AS departure_station_name FROM dim_location"
    else:
        dom = "SELECT " + ", ".join(f"d{i}.{k}" for i, k in enumerate(keys)) + " FROM " + ", ".join(
            f"(SELECT DISTINCT {k} FROM denorm WHERE {k} IS NOT NULL) d{i}" for i, k in enumerate(keys))
    agg = {"count": "count(*)", "sum": "sum(price)",
           "mean": "CAST(sum(price) AS DOUBLE) / CAST(count(price) AS DOUBLE)"}[kind]
    on = " AND ".join(f"dom.{k} = agg.{k}" for k in keys)
    keysel = ", ".join(f"coalesce(dom.{k}, agg.{k}) AS {k}" for k in keys)
    fill = {"count": f"CAST(coalesce(v, 0) AS BIGINT)", "sum": "coalesce(v, 0)", "mean": "v"}[kind]
    notnull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    base = (f", dom AS ({dom}), agg AS (SELECT {kl}, {agg} AS v, count(*) AS n FROM denorm{w} GROUP BY {kl}),"
            f" j AS (SELECT {keysel}, v, sum(coalesce(n, 0)) OVER () AS sel FROM dom FULL JOIN agg ON {on}),"
            f" r AS (SELECT {kl}, {fill} AS {out} FROM j WHERE {notnull} AND sel > 0)")
    if name in _SHARED:
        body = f"SELECT {kl}, {('CAST(' + out + ' AS DOUBLE)') if kind == 'sum' else out} AS {out}, " \
               f"{pct(out, f'sum({out}) OVER ()')} AS share_pct FROM r"
    elif name == "panel_top5_stations":
        body = f"SELECT {kl}, CAST({out} AS DOUBLE) AS {out} FROM r ORDER BY {out} DESC, {kl} LIMIT 5"
    elif kind == "sum":
        body = f"SELECT {kl}, CAST({out} AS DOUBLE) AS {out} FROM r"
    else:
        body = f"SELECT {kl}, {out} FROM r"
    if name == "panel_railcard":
        body = f"SELECT railcard AS railcard_type, {out} FROM r"
    return with_ctes(["denorm", "dim_location"], base + "\n" + body)


def _panel_query(name: str, f: PanelFilters | None):
    return lambda s, d: panels.panel(_panel_cube(s, d), name, f)


_VARIANTS = {
    "": None,
    "__month": PanelFilters(month=3),
    "__all_filters": PanelFilters(month=5, station="NATION_7", ticket_type="Advance",
                                  railcard="Adult", payment="Credit Card"),
}
for _name in panels.PANELS:
    for _suffix, _f in _VARIANTS.items():
        _q(_name + _suffix, _panel_query(_name, _f), _panel_sql(_name, _f))
for _name, _f in (("panel_top5_stations__station", PanelFilters(station="NATION_3")),
                  ("panel_avg_price__ticket_type", PanelFilters(ticket_type="Anytime")),
                  ("panel_revenue_refund__railcard", PanelFilters(railcard="No Railcard")),
                  ("panel_status__empty", PanelFilters(station="NO SUCH STATION"))):
    _base = _name.split("__")[0]
    _q(_name, _panel_query(_base, _f), _panel_sql(_base, _f))

for _name in ("panel_revenue_refund", "panel_top5_stations", "panel_hourly", "panel_status", "panel_daily_revenue"):
    _f = PanelFilters(month=3) if _name != "panel_status" else PanelFilters(railcard="Senior", payment="Contactless")
    _q(_name + "__star", (lambda n, f: lambda s, d: panels.panel(_scanned_star_base(s, d), n, f))(_name, _f),
       _panel_sql(_name, _f))


def _without(name: str, *columns: str):
    """A panel over a base that lacks columns."""
    def run(s, d):
        stored = _panel_base(s, d)
        return panels.panel(panels.PanelBase(stored.base.drop(*columns), None, stored.domains), name)
    return run


def _guarded(s, d, name, column):
    """F13 on data: the rides as they are without a column, and the panel that is empty for lack of it."""
    lean = _panel_base(s, d).base.drop(column)
    empty = panels.panel(panels.PanelBase(lean), name)
    none = [F.lit(None).cast(t).alias(c) for c, t in empty.dtypes]
    total = lean.agg(F.count(F.lit(1)).alias("rides_without")).select(*none, "rides_without")
    return total.unionByName(empty.withColumn("rides_without", F.lit(None).cast("long")))


_q("panel_hourly__no_column", _without("panel_hourly", "hour_of_day"),
   "SELECT CAST(h AS INTEGER) AS hour_of_day, CAST(0 AS BIGINT) AS number_of_transactions FROM range(24) r(h)")
_q("panel_revenue_ticket__no_column", _without("panel_revenue_ticket", "price"),
   "SELECT CAST(NULL AS VARCHAR) AS ticket_type, CAST(NULL AS DOUBLE) AS revenue WHERE false")
_q("panel_daily_tx__no_column", _without("panel_daily_tx", "purchase_date"),
   "SELECT CAST(NULL AS DATE) AS purchase_date, CAST(NULL AS BIGINT) AS number_of_transactions WHERE false")
_q("panel_delay_reasons__no_column", _without("panel_delay_reasons", "reason_for_delay"),
   "SELECT CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS count WHERE false")
# the guards on the rides: the panel without its column, next to the number of rides it was left out of
for _name, _column, _fields in (
        ("panel_railcard", "railcard", "CAST(NULL AS VARCHAR) AS railcard_type, CAST(NULL AS BIGINT) AS number_of_transactions"),
        ("panel_refund_count", "refund_request",
         "CAST(NULL AS VARCHAR) AS journey_status, CAST(NULL AS VARCHAR) AS refund_request, CAST(NULL AS BIGINT) AS count")):
    _q(_name + "__guarded", (lambda n, c: lambda s, d: _guarded(s, d, n, c))(_name, _column),
       with_ctes(["denorm"], f"SELECT {_fields}, count(*) AS rides_without FROM denorm"))
_q("panel_status__month_text", _panel_query("panel_status", PanelFilters(month="March")),
   "SELECT CAST(NULL AS VARCHAR) AS journey_status, CAST(NULL AS BIGINT) AS count, "
   "CAST(NULL AS DOUBLE) AS share_pct WHERE false")

# ------------------------------------------------------------------ file sources / sinks


def _csv_round_trip(s, d):
    """S4 then S1: write the flat table as CSV (missing values as the text ``None``) into this
    application's folder under the shared checkpoint folder and scan it back with the explicit
    schema."""
    path = scratch_path(s, "rides-csv")
    _rides(s, d).write.mode("overwrite").option("header", True).option("nullValue", "None").csv(path)
    return scan_rides_csv(s, path)


_q("scan_rides_csv", _csv_round_trip, with_ctes(["rides"], "SELECT * FROM rides"))


def _faulty_rides(s, d):
    """S1 with rejects: the flat table as lines of a file some of which are faulty: dates that are none, prices
    that are no numbers, lines cut short; others hold prices with a pound sign and separators."""
    def build(path):
        k = F.substring("transaction_id", 2, 10).cast("long")
        text = {c: F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in RIDES_COLUMNS}
        text["date_of_purchase"] = F.when(k % 11 == 0, F.lit("2024-13-45")).otherwise(text["date_of_purchase"])
        text["price"] = (F.when(k % 13 == 0, F.lit("about 12"))
                         .when(k % 7 == 0, F.concat(F.lit('"£'), F.format_number("price", 2), F.lit('"')))
                         .otherwise(text["price"]))
        fields = [text[c] for c in RIDES_COLUMNS]
        line = F.when(k % 17 == 0, F.concat_ws(",", *fields[:5])).otherwise(F.concat_ws(",", *fields))
        rides(s, d).select(line.alias("line")).write.text(path)
        return path
    return scan_rides_checked(s, _once("faulty-rides", s, d, build), header=False)


def _star_csv_round_trip(s, d):
    """S4 then S2 and J5: write the four star tables of variant A as CSV (header, no index) into
    this application's scratch folder, scan them back with their schemas, and denormalise the
    scanned tables — the dashboard's start-up path."""
    a = star.StarA(_rides(s, d))
    a.location = materialise(a.location, "stations")
    folder = scratch_path(s, "star-csv")
    write_star({"fact_transactions": a.fact, "dim_time": a.time, "dim_journey": a.journey,
                "dim_location": a.location}, folder, "csv")
    t = scan_star(s, folder, "csv")
    return star.denormalise(t["fact_transactions"], t["dim_time"], t["dim_journey"],
                            t["dim_location"])


_FAULTY = with_ctes(["rides"], "") + """, marked AS (
SELECT *, CAST(substr(transaction_id, 2) AS BIGINT) % 17 = 0 AS cut, CAST(substr(transaction_id, 2) AS BIGINT) % 11 = 0 AS day,
  CAST(substr(transaction_id, 2) AS BIGINT) % 13 = 0 AS cost FROM rides),
faults AS (SELECT *, concat_ws(',', CASE WHEN cut THEN 'malformed' END, CASE WHEN day THEN 'date_of_purchase' END,
  CASE WHEN cost AND NOT cut THEN 'price' END) AS reasons FROM marked)
"""
_q("scan_rides_accepted", lambda s, d: _faulty_rides(s, d)[0],
   _FAULTY + "SELECT " + ", ".join(RIDES_COLUMNS) + " FROM faults WHERE reasons = ''")
_q("scan_rides_rejects",
   lambda s, d: _faulty_rides(s, d)[1].select("transaction_id", F.concat_ws(",", "reasons").alias("reasons"),
                                              F.col("fields.price").alias("price_text"), F.col("record").isNotNull().alias("has_record")),
   _FAULTY + "SELECT transaction_id, reasons, CASE WHEN cut THEN NULL WHEN cost THEN 'about 12' "
             "WHEN CAST(substr(transaction_id, 2) AS BIGINT) % 7 = 0 THEN '£' || printf('%,.2f', CAST(price AS DOUBLE)) "
             "ELSE CAST(price AS VARCHAR) END AS price_text, cut AS has_record FROM faults WHERE reasons <> ''")
_q("scan_rides_counts", lambda s, d: reject_counts(*_faulty_rides(s, d)),
   _FAULTY + "SELECT CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS outcome, count(*) AS n FROM faults GROUP BY 1 "
             "UNION ALL SELECT unnest(string_split(reasons, ',')) AS outcome, count(*) AS n FROM faults WHERE reasons <> '' GROUP BY 1")
_q("scan_star_denormalised", _star_csv_round_trip, with_ctes(["denorm"], "SELECT * FROM denorm"))


def _epoch_dates(s, d):
    """S3: purchase instants stored as epoch-millisecond text (the order date plus a time of day
    from the order key), read back as dates."""
    o = tables.table(s, d, "orders", ["o_orderkey", "o_orderdate"])
    ms = (F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * MS_PER_DAY
          + (F.col("o_orderkey") * 7919) % MS_PER_DAY)
    src = o.select("o_orderkey", ms.cast("string").alias("purchase_ms"))
    return with_epoch_dates(src, {"purchase_ms": "purchase_date"})


def _table_all(s, d):
    """S6, then S5: a catalog view of the flat table, whose column names came with blanks around
    them, and ``SELECT *`` from it."""
    r = _rides(s, d)
    spaced = r.toDF(*[f" {c} " for c in r.columns])
    trim_column_names(spaced).createOrReplaceTempView("ticketlens_rides")
    return scan_table_all(s, "ticketlens_rides")


def _bad_epochs(s, d):
    """S3 over epoch texts some of which are no numbers or out of range."""
    o, k = tables.table(s, d, "orders", ["o_orderkey"]), F.col("o_orderkey")
    ms = (F.when(k % 13 == 0, F.lit("n/a")).when(k % 17 == 0, F.lit("")).when(k % 19 == 0, F.lit("9" * 18))
          .otherwise(((k % 20000) * MS_PER_DAY).cast("string")))
    return with_epoch_dates(o.select("o_orderkey", ms.alias("ms")), {"ms": "purchase_date"})


_q("scan_epoch_dates_bad", _bad_epochs, """
SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 17 = 0 THEN ''
    WHEN o_orderkey % 19 = 0 THEN repeat('9', 18)
    ELSE CAST(o_orderkey % 20000 * 86400000 AS VARCHAR) END AS ms,
  CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0
    THEN DATE '1970-01-01' + CAST(o_orderkey % 20000 AS INTEGER) END AS purchase_date FROM orders""")


_q("scan_table_all", _table_all, with_ctes(["rides"], "SELECT * FROM rides"))
_q("scan_epoch_dates", _epoch_dates, """
WITH src AS (SELECT o_orderkey, CAST(CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT)
                    * 86400000 + (o_orderkey * 7919) % 86400000 AS VARCHAR) AS purchase_ms
             FROM orders),
t AS (SELECT *, TRY_CAST(purchase_ms AS BIGINT) AS ms FROM src),
u AS (SELECT *, (ms - ((ms % 86400000) + 86400000) % 86400000) // 86400000 AS dd FROM t)
SELECT o_orderkey, purchase_ms,
  CASE WHEN dd BETWEEN -719162 AND 2932896 THEN DATE '1970-01-01' + CAST(dd AS INTEGER) END
    AS purchase_date
FROM u""")
_q("profile_schema_counts", lambda s, d: profile.schema_profile(_rides(s, d)).select(
    "ordinal", "column_name", "non_null_count", "row_count", "column_count"),
   with_ctes(["rides"], " UNION ALL ".join(
       f"SELECT {i} AS ordinal, '{c}' AS column_name, count({c}) AS non_null_count, "
       f"count(*) AS row_count, {len(RIDES_COLUMNS)} AS column_count FROM rides"
       for i, c in enumerate(RIDES_COLUMNS))))
