"""Projections, filters, joins, aggregations, windows, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerleaf.functions.calendar import fiscal_year, post_period
from ledgerleaf.functions.text import SAFE_NAME, TOKEN_PATTERN, apply_rules, tokens, unfolded
from ledgerleaf.functions.words import STOP_WORDS
from ledgerleaf.operators import frame, ordered, series
from ledgerleaf.operators.search import nearest
from ledgerleaf.plans.derived import (
    SQL_BILLED_ORDERS,
    SQL_MONTHLY,
    SQL_NOTES,
    billed_months,
    fiscal_columns,
    money,
    month_totals,
    monthly_series,
    order_notes,
    revenue,
    sql_fiscal_year,
    sql_list,
    sql_post_period,
)
from ledgerleaf.plans.registry import query

ORDER_FY = sql_fiscal_year("o_orderdate")
TOKENS_SQL = f"list_filter(regexp_extract_all(lower(text), '{TOKEN_PATTERN}'), lambda w: length(w) BETWEEN 2 AND 15)"


# --- projections, filters, row addressing -----------------------------------

@query("p01_column_subset", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query("p02_drop_columns", "SELECT * EXCLUDE (o_totalprice, o_orderpriority, o_orderdate) FROM orders")
def _(t):
    return t.orders.drop("o_totalprice", "o_orderpriority", "o_orderdate")


@query("p03_rename_columns", "SELECT o_orderkey AS request_no, o_orderstatus AS service FROM orders")
def _(t):
    renamed = t.orders.withColumnsRenamed({"o_orderkey": "request_no", "o_orderstatus": "service"})
    return renamed.select("request_no", "service")


@query(
    "p04_scaled_and_constant_columns",
    "SELECT o_orderkey, o_totalprice / 1e6 AS revenue_m, 'orders' AS document_name FROM orders",
)
def _(t):
    scaled = t.orders.withColumn("revenue_m", F.col("o_totalprice") / 1e6)
    return scaled.select("o_orderkey", "revenue_m", F.lit("orders").alias("document_name"))


@query(
    "p05_equals_ignoring_case",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE lower(o_orderpriority) = '1-urgent'",
)
def _(t):
    return t.orders.where(frame.equals_ignoring_case("o_orderpriority", "1-Urgent")).select(
        "o_orderkey", "o_orderpriority"
    )


@query("p06_facet_filter", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def _(t):
    return t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query("p07_threshold_filter", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def _(t):
    return t.customer.where(F.col("c_acctbal") >= 0).select("c_custkey", "c_acctbal")


@query("p08_pattern_filter", "SELECT doc_id, source FROM documents WHERE regexp_matches(source, 'src1[0-9]')")
def _(t):
    return t.documents.where(frame.matches("source", "src1[0-9]")).select("doc_id", "source")


@query(
    "p09_drop_missing",
    "SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) "
    "WHERE quality IS NOT NULL AND toxic IS NOT NULL",
)
def _(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return joined.dropna(how="any", subset=["quality", "toxic"])


@query(
    "p10_null_audit",
    """SELECT COUNT(*) FILTER (q IS NULL) AS q_nulls, COUNT(*) FILTER (x IS NULL) AS x_nulls,
              COUNT(*) FILTER (q IS NULL OR x IS NULL) AS any_nulls
       FROM (SELECT NULLIF(quality, 0) AS q, NULLIF(toxic, 0) AS x FROM documents LEFT JOIN labels USING (doc_id))""",
)
def _(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    zero_missing = joined.select(F.nullif("quality", F.lit(0)).alias("q"), F.nullif("toxic", F.lit(0)).alias("x"))
    return frame.null_audit(zero_missing, ["q", "x"])


@query(
    "p11_conditional_update",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status "
    "FROM orders",
)
def _(t):
    return t.orders.select("o_orderkey", frame.recoded("o_orderstatus", {"F": "final", "O": "open"}).alias("status"))


@query("p12_clip_below", "SELECT c_custkey, greatest(c_acctbal, 0.0) AS c_acctbal FROM customer")
def _(t):
    return t.customer.select("c_custkey", frame.clipped_below("c_acctbal", 0.0).alias("c_acctbal"))


@query(
    "p13_positional_slice",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5 OFFSET 1",
)
def _(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return ordered.row_slice(rows, [F.col("day"), F.col("o_orderkey")], 1, 6)


@query(
    "p13_all_but_last",
    """SELECT o_orderkey, CAST(p AS BIGINT) AS position FROM (
         SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS p, COUNT(*) OVER () AS n
         FROM orders) WHERE p < n - 12""",
)
def _(t):
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    placed = ordered.with_position(t.orders.select("o_orderkey", "o_orderdate"), order)
    total = placed.agg(F.count("*").alias("n")).scalar()
    return placed.where(F.col("position") < total - 12).select("o_orderkey", F.col("position").cast("bigint"))


@query(
    "p14_table_page",
    "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'fr' ORDER BY n_chars DESC, doc_id LIMIT 6 OFFSET 12",
)
def _(t):
    view = t.documents.select("doc_id", "source", "n_chars", "lang")
    return frame.table_view(view, F.col("lang") == "fr", F.desc("n_chars"), F.col("doc_id"), page=2).drop("lang")


@query("p15_safe_names", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9]', '_', 'g') AS name FROM pages")
def _(t):
    return t.pages.select("page_id", apply_rules(F.col("url"), SAFE_NAME).alias("name"))


@query("s09_table_scan", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    return t.read("supplier")


@query(
    "s10_sql_scan",
    "SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE lower(o_orderpriority) = '2-high'",
)
def _(t):
    return t.spark.sql(
        "SELECT DISTINCT o_custkey, o_orderstatus FROM {orders} WHERE lower(o_orderpriority) = '2-high'",
        orders=t.orders,
    )


# --- joins --------------------------------------------------------------------

@query(
    "j01_left_join_dimension",
    "SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def _(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", "c_name", "n_name")


@query(
    "j02_inner_join_facts",
    "SELECT o_orderkey, c_custkey, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def _(t):
    """A customer may hold any share of the orders, so the customers are looked up."""
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    joined = frame.lookup_join(t.orders, customers, "o_custkey", F.col("o_orderkey"))
    return joined.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "c_mktsegment", "o_totalprice")


@query(
    "j03_two_grain_totals",
    """WITH fine AS (SELECT l_orderkey, l_returnflag, SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS cost
                    FROM lineitem GROUP BY ALL),
            coarse AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS total
                       FROM lineitem GROUP BY ALL)
       SELECT l_orderkey, l_returnflag, CAST(cost AS DOUBLE) AS cost, CAST(total AS DOUBLE) AS total
       FROM fine JOIN coarse USING (l_orderkey)""",
)
def _(t):
    """The coarse total comes from the fine sums, so the lines are shuffled once and pre-aggregated."""
    fine = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.sum(money(F.col("l_extendedprice"))).alias("cost"))
    total = F.sum("cost").over(Window.partitionBy("l_orderkey"))
    both = fine.withColumn("total", total)
    return both.select(
        "l_orderkey", "l_returnflag", F.col("cost").cast("double"), F.col("total").cast("double")
    )


@query(
    "j04_code_join_missing_keys",
    """WITH d AS (SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)),
            f AS (SELECT quality, MIN(doc_id) AS first FROM d GROUP BY quality),
            c AS (SELECT quality, ROW_NUMBER() OVER (ORDER BY first) AS service_num FROM f)
       SELECT doc_id, d.quality, service_num FROM d LEFT JOIN c ON d.quality IS NOT DISTINCT FROM c.quality""",
)
def _(t):
    described = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    codes = frame.first_seen_codes(described, "quality", "doc_id", "service_num")
    return frame.null_safe_left_join(described, codes, "quality", F.col("doc_id"))


@query(
    "j05_billing_by_fiscal_period",
    f"""WITH {SQL_BILLED_ORDERS}
        SELECT last_day(day) AS snapshot, {sql_fiscal_year('day')} AS fy, {sql_post_period('day')} AS post_period,
               CAST(SUM(billed) AS DOUBLE) AS billed, COUNT(*) AS n_requests, COUNT(DISTINCT c_nationkey) AS n_orgs
        FROM billed_orders GROUP BY ALL""",
)
def _(t):
    billed = fiscal_columns(billed_months(t).withColumnRenamed("ts", "snapshot"), "snapshot")
    grouped = billed.groupBy("snapshot", "fy", "post_period").agg(*month_totals("c_nationkey"))
    in_units = grouped.withColumn("billed", F.col("billed").cast("double"))
    return in_units.orderBy("snapshot")


@query(
    "j06_merge_forecasts",
    f"""WITH {SQL_MONTHLY}, b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY t DESC) AS back
                                  FROM monthly)
        SELECT series_id, last_day(ts + INTERVAL 12 MONTH) AS ts, n_requests AS requests_hat, n_orgs AS orgs_hat
        FROM b WHERE back <= 12""",
)
def _(t):
    """Two forecasts of different columns, met on series and timestamp."""
    monthly = monthly_series(t)
    last = monthly.withColumn("_back", F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("t"))))
    last = last.where("_back <= 12").withColumn("ts", F.last_day(F.add_months("ts", 12)))
    requests = last.select("series_id", "ts", F.col("n_requests").alias("requests_hat"))
    orgs = last.select("series_id", "ts", F.col("n_orgs").alias("orgs_hat"))
    return requests.join(orgs, ["series_id", "ts"])


@query(
    "j07_aligned_columns",
    """WITH p AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS purchases FROM events
                  WHERE event_type = 'purchase' GROUP BY 1),
            e AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS errors FROM events
                  WHERE event_type = 'error' GROUP BY 1)
       SELECT day, purchases, errors FROM p FULL JOIN e USING (day)""",
)
def _(t):
    dated = t.events.withColumn("day", F.to_date("ts"))
    purchases = dated.where("event_type = 'purchase'").groupBy("day").agg(F.count("*").alias("purchases"))
    errors = dated.where("event_type = 'error'").groupBy("day").agg(F.count("*").alias("errors"))
    return purchases.join(errors, "day", "full")


@query(
    "j10_groups_in_one_pass",
    """SELECT o_orderstatus, COUNT(*) AS n, COUNT(DISTINCT o_orderpriority) AS priorities,
              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total FROM orders GROUP BY o_orderstatus""",
)
def _(t):
    return t.orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"),
        F.count_distinct("o_orderpriority").alias("priorities"),
        F.sum(money(F.col("o_totalprice"))).cast("double").alias("total"),
    )


@query(
    "j09_without_stop_words",
    f"""SELECT token, COUNT(*) AS n FROM (SELECT unnest({TOKENS_SQL}) AS token FROM documents)
        WHERE token NOT IN ({sql_list(STOP_WORDS)}) GROUP BY token""",
)
def _(t):
    """Tokens are counted before the anti join, so that it sees each distinct token once."""
    stop = t.spark.createDataFrame([(w,) for w in STOP_WORDS], "token STRING")
    found = unfolded(t.texts, [], tokens(F.col("text")), "token")
    counted = found.groupBy("token").agg(F.count("*").alias("n"))
    return counted.join(F.broadcast(stop), "token", "left_anti")


@query(
    "j11_nearest_to_class_means",
    """WITH flat AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
            m AS (SELECT label, i, AVG(CAST(v AS DOUBLE)) AS c FROM flat GROUP BY label, i),
            q AS (SELECT label, list(c ORDER BY i) AS c FROM m GROUP BY label),
            d AS (SELECT q.label AS query_id, e.vec_id,
                         round(list_sum(list_transform(list_zip(q.c, e.embedding),
                               lambda z: (z[1] - CAST(z[2] AS DOUBLE)) * (z[1] - CAST(z[2] AS DOUBLE)))), 6) AS distance
                  FROM q, embeddings e)
       SELECT query_id, vec_id, distance, CAST(r AS INTEGER) AS rank FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS r FROM d) WHERE r <= 10""",
)
def _(t):
    """Each class mean is a query; the corpus is the whole table."""
    cells = t.embeddings.select("label", F.posexplode("embedding").alias("i", "v"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("c"))
    parts = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "c"))).alias("p"))
    queries = parts.select(F.col("label").alias("query_id"), F.transform("p", lambda x: x["c"]).alias("vector"))
    corpus = t.embeddings.select("vec_id", F.col("embedding").alias("vector"))
    return nearest(corpus, "vec_id", queries, "query_id", k=10)


@query(
    "j12_gazetteer_places",
    f"""WITH {SQL_NOTES}, w AS (SELECT note_id, unnest(regexp_extract_all(note, '[A-Z][A-Z_0-9]+')) AS entity FROM notes)
        SELECT note_id, entity, n_regionkey FROM w JOIN nation ON entity = nation.n_name""",
)
def _(t):
    """Candidate names of each note met with a table of places."""
    names = F.explode(F.regexp_extract_all("note", F.lit("[A-Z][A-Z_0-9]+"), F.lit(0))).alias("entity")
    candidates = order_notes(t).select("note_id", names)
    places = t.nation.select(F.col("n_name").alias("entity"), "n_regionkey")
    met = frame.lookup_join(candidates, places, "entity", F.col("note_id"))
    return met.select("note_id", "entity", "n_regionkey")


# --- aggregations --------------------------------------------------------------

@query(
    "a01_sum_by_six_keys",
    f"""WITH x AS (SELECT {ORDER_FY} AS fy, c_mktsegment, o_orderpriority, o_orderstatus, l_linestatus,
                   NULLIF(l_returnflag, 'N') AS flag,
                   CASE WHEN l_tax > 0 THEN CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) END AS cost
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
        SELECT fy, c_mktsegment, o_orderpriority, o_orderstatus, l_linestatus, flag,
               COALESCE(CAST(SUM(cost) AS DOUBLE), 0) AS cost
        FROM x WHERE flag IS NOT NULL GROUP BY ALL""",
)
def _(t):
    cost = F.when(F.col("l_tax") > 0, money(revenue()))
    lines = t.lineitem.select("l_orderkey", "l_linestatus", F.nullif("l_returnflag", F.lit("N")).alias("flag"), cost.alias("c"))
    per_order = lines.groupBy("l_orderkey", "l_linestatus", "flag").agg(F.sum("c").alias("cost"))
    orders = t.orders.withColumn("fy", fiscal_year(F.col("o_orderdate")))
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    # Summed per customer before the customer join, so that a hot customer brings few rows.
    rest = ["fy", "o_orderpriority", "o_orderstatus", "l_linestatus", "flag"]
    per_customer = joined.groupBy("o_custkey", *rest).agg(F.sum("cost").alias("cost"))
    keyed = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return frame.sum_by(keyed, ["c_mktsegment", *rest], "cost", "cost").withColumn("cost", F.col("cost").cast("double"))


@query(
    "a02_sum_by_key",
    "SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total FROM orders GROUP BY o_custkey",
)
def _(t):
    amounts = t.orders.select("o_custkey", money(F.col("o_totalprice")).alias("amount"))
    return frame.sum_by(amounts, ["o_custkey"], "amount", "total").withColumn("total", F.col("total").cast("double"))


@query(
    "a03_distinct_sum_ordered",
    f"""SELECT DISTINCT {ORDER_FY} AS fy, {sql_post_period('o_orderdate')} AS post_period,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total
        FROM orders GROUP BY 1, 2 ORDER BY 1, 2""",
)
def _(t):
    keyed = fiscal_columns(t.orders, "o_orderdate")
    total = F.sum(money(F.col("o_totalprice"))).cast("double").alias("total")
    return keyed.groupBy("fy", "post_period").agg(total).orderBy("fy", "post_period")


@query("a04_count_per_pair", "SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY ALL")
def _(t):
    return t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("a05_value_counts", "SELECT lang, COUNT(*) AS n FROM documents GROUP BY lang")
def _(t):
    return frame.frequencies(t.documents, "lang")


@query(
    "a06_share_within_group",
    """SELECT source, lang, n, n / SUM(n) OVER (PARTITION BY source) AS share
       FROM (SELECT source, lang, COUNT(*) AS n FROM documents GROUP BY ALL)""",
)
def _(t):
    return frame.share_within(t.documents, "source", "lang")


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "a07_pivot_counts",
    "SELECT user_id, "
    + ", ".join(f"COUNT(*) FILTER (event_type = '{e}') AS \"{e}\"" for e in EVENT_TYPES)
    + f", COUNT(*) FILTER (event_type IS NULL OR event_type NOT IN ({sql_list(EVENT_TYPES)})) AS other"
    + " FROM events GROUP BY user_id",
)
def _(t):
    return frame.pivot_counts(t.events, "user_id", "event_type", EVENT_TYPES)


@query(
    "a08_group_mean",
    f"SELECT {ORDER_FY} AS fy, round(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*), 6) AS mean "
    "FROM orders GROUP BY 1",
)
def _(t):
    mean = F.sum(money(F.col("o_totalprice"))).cast("double") / F.count("*")
    return t.orders.groupBy(fiscal_year(F.col("o_orderdate")).alias("fy")).agg(F.round(mean, 6).alias("mean"))


@query(
    "a09_histogram",
    "SELECT CAST(floor(value / 10.0) AS BIGINT) AS bin, CAST(floor(value / 10.0) AS BIGINT) * 10.0::DOUBLE AS low, "
    "COUNT(*) AS n FROM events GROUP BY 1, 2",
)
def _(t):
    return frame.histogram(t.events, "value", 10.0)


@query(
    "a10_distinct_per_group",
    "SELECT event_type, COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT props) AS props FROM events GROUP BY event_type",
)
def _(t):
    return t.events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("props").alias("props")
    )


@query(
    "a11_topics_per_service_line",
    """SELECT source, COUNT(*) AS n, COUNT(DISTINCT CASE WHEN n_chars >= 100 THEN lang END) AS topics,
              COUNT(*) FILTER (n_chars < 100) AS without_topic
       FROM documents GROUP BY source""",
)
def _(t):
    """Texts too short to place have no topic instead of failing their line."""
    topic = F.when(F.col("n_chars") >= 100, F.col("lang"))
    return t.documents.groupBy("source").agg(
        F.count("*").alias("n"),
        F.count_distinct(topic).alias("topics"),
        F.sum(topic.isNull().cast("bigint")).alias("without_topic"),
    )


@query(
    "a12_describe",
    """SELECT COUNT(v) AS n, round(AVG(v), 6) AS mean, round(STDDEV_SAMP(v), 6) AS std, MIN(v) AS low,
              round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
              round(quantile_cont(v, 0.75), 6) AS q75, MAX(v) AS high
       FROM (SELECT l_extendedprice AS v FROM lineitem)""",
)
def _(t):
    stats = frame.described(t.lineitem, "l_extendedprice")
    return stats.select(
        "n", "low", "high", *[F.round(c, 6).alias(c) for c in ("mean", "std", "q25", "q50", "q75")]
    )


@query("a13_drop_duplicates", "SELECT DISTINCT text, lang FROM documents")
def _(t):
    return t.documents.select("text", "lang").dropDuplicates()


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a14_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in NUMERIC for b in NUMERIC
    ),
)
def _(t):
    return frame.correlation_matrix(t.lineitem, NUMERIC).withColumn("r", F.round("r", 6))


@query("a15_round_half_even", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, "
       "round_even(l_extendedprice, 1) AS cost FROM lineitem")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.bround("l_extendedprice", 1).alias("cost")
    )


@query("a17_row_counts", "SELECT (SELECT COUNT(*) FROM documents) AS documents, (SELECT COUNT(*) FROM orders) AS orders")
def _(t):
    orders = t.orders.agg(F.count("*").alias("n")).scalar()
    return t.documents.agg(F.count("*").alias("documents")).select("documents", orders.alias("orders"))


# --- windows over ordered rows -------------------------------------------------

@query(
    "w01_first_difference",
    f"""WITH {SQL_MONTHLY}
        SELECT series_id, ts, round(d, 8) AS change FROM (
          SELECT series_id, ts, amount - LAG(amount) OVER (PARTITION BY series_id ORDER BY t) AS d FROM monthly)
        WHERE d IS NOT NULL""",
)
def _(t):
    changed = series.difference(monthly_series(t), ["series_id"], "amount", "change")
    return changed.select("series_id", "ts", F.round("change", 8).alias("change"))


SQL_TREND = """(SUM(amount) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
  + 0.5 * (LAG(amount, 6) OVER (PARTITION BY series_id ORDER BY t)
           + LEAD(amount, 6) OVER (PARTITION BY series_id ORDER BY t))) / 12"""


@query("w02_centred_average", f"WITH {SQL_MONTHLY} SELECT series_id, ts, round({SQL_TREND}, 6) AS trend FROM monthly")
def _(t):
    trend = series.centred_average("amount", ["series_id"])
    return monthly_series(t).select("series_id", "ts", F.round(trend, 6).alias("trend"))


@query("w03_position_in_period", f"WITH {SQL_MONTHLY} SELECT series_id, ts, t, t % 12 AS position FROM monthly")
def _(t):
    return monthly_series(t).select("series_id", "ts", "t", (F.col("t") % 12).alias("position"))


@query(
    "w04_last_value",
    f"""WITH {SQL_MONTHLY} SELECT series_id, ts, round(amount + LAST_VALUE(amount) OVER (
          PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 8) AS lifted
        FROM monthly""",
)
def _(t):
    monthly = monthly_series(t)
    last = series.last_values(monthly, ["series_id"], ["amount"]).withColumnRenamed("amount", "_last")
    lifted = F.round(F.col("amount") + F.col("_last"), 8).alias("lifted")
    return monthly.join(last, "series_id").select("series_id", "ts", lifted)


@query(
    "w05_cumulative_sum",
    f"""WITH {SQL_MONTHLY} SELECT series_id, ts, round(SUM(amount) OVER (
          PARTITION BY series_id ORDER BY t ROWS UNBOUNDED PRECEDING), 8) AS running FROM monthly""",
)
def _(t):
    total = monthly_series(t).withColumn("_zero", F.lit(0.0))
    running = series.undifferenced(total, ["series_id"], "amount", "_zero", "running")
    return running.select("series_id", "ts", F.round("running", 8).alias("running"))


@query(
    "w06_top_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice, CAST(r AS INTEGER) AS rank FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders)
       WHERE r <= 3""",
)
def _(t):
    by_price = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    ranked = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", F.row_number().over(by_price).alias("rank"))
    return ranked.where("rank <= 3")


@query(
    "w07_latest_per_key",
    """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
              CAST(MAX(o_orderdate) AS DATE) AS day FROM orders GROUP BY o_custkey""",
)
def _(t):
    """A partial aggregate keeps one candidate per key and task; no key is gathered whole."""
    latest = F.max(F.struct(F.to_date("o_orderdate").alias("day"), "o_orderkey")).alias("latest")
    found = t.orders.groupBy("o_custkey").agg(latest)
    return found.select("o_custkey", "latest.o_orderkey", "latest.day")


@query(
    "w08_lag_matrix",
    f"""WITH {SQL_MONTHLY} SELECT series_id, ts, """
    + ", ".join(
        f"LAG({c}, {k}) OVER (PARTITION BY series_id ORDER BY t) AS {c}_l{k}"
        for c in ("n_requests", "n_orgs") for k in (1, 2, 3)
    )
    + " FROM monthly",
)
def _(t):
    lagged = series.lag_columns(monthly_series(t), ["series_id"], ["n_requests", "n_orgs"], 3)
    return lagged.select("series_id", "ts", *[f"{c}_l{k}" for c in ("n_requests", "n_orgs") for k in (1, 2, 3)])


@query(
    "w09_first_seen_codes",
    """SELECT c_mktsegment, ROW_NUMBER() OVER (ORDER BY first) AS code FROM (
         SELECT c_mktsegment, MIN(c_custkey) AS first FROM customer GROUP BY c_mktsegment)""",
)
def _(t):
    return frame.first_seen_codes(t.customer, "c_mktsegment", "c_custkey", "code")


@query(
    "w10_fiscal_calendar",
    f"SELECT o_orderkey, {ORDER_FY} AS fy, {sql_post_period('o_orderdate')} AS post_period FROM orders",
)
def _(t):
    day = F.col("o_orderdate")
    return t.orders.select("o_orderkey", fiscal_year(day).alias("fy"), post_period(day).alias("post_period"))


SPARSE = "SELECT c_nationkey, last_day(day) AS ts, CAST(SUM(billed) AS DOUBLE) AS billed FROM billed_orders GROUP BY ALL"


@query(
    "w11_densified_calendar",
    f"""WITH {SQL_BILLED_ORDERS}, s AS ({SPARSE}),
          span AS (SELECT c_nationkey, MIN(ts) AS a, MAX(ts) AS b FROM s GROUP BY c_nationkey),
          cal AS (SELECT c_nationkey, CAST(last_day(unnest(generate_series(
                    CAST(date_trunc('month', a) AS TIMESTAMP), CAST(date_trunc('month', b) AS TIMESTAMP),
                    INTERVAL 1 MONTH))) AS DATE) AS ts FROM span)
        SELECT c_nationkey, ts, COALESCE(billed, 0) AS billed FROM cal LEFT JOIN s USING (c_nationkey, ts)""",
)
def _(t):
    sparse = billed_months(t).groupBy("c_nationkey", "ts").agg(F.sum("billed").cast("double").alias("billed"))
    return series.densified(sparse, ["c_nationkey"], "ts", "billed")


# --- sorting and limits ----------------------------------------------------------

@query("t01_sort_by_time", "SELECT event_id, ts FROM events ORDER BY ts, event_id")
def _(t):
    return t.events.select("event_id", "ts").orderBy("ts", "event_id")


@query("t02_sorted_distinct", "SELECT DISTINCT p_brand FROM part ORDER BY p_brand")
def _(t):
    return t.part.select("p_brand").distinct().orderBy("p_brand")


@query(
    "t03_head_and_tail",
    """SELECT 'head' AS part, * FROM (SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 12)
       UNION ALL SELECT 'tail' AS part, * FROM (SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 12)""",
)
def _(t):
    rows = t.events.select("event_id", "ts")
    order = [F.col("ts"), F.col("event_id")]
    head = rows.orderBy(*order).limit(12)
    last = ordered.tail(rows, order, [F.desc("ts"), F.desc("event_id")], 12)
    return head.select(F.lit("head").alias("part"), "*").unionByName(last.select(F.lit("tail").alias("part"), "*"))


@query(
    "t04_global_top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


# --- set operations ----------------------------------------------------------------

@query(
    "ua_union_all",
    "SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier",
)
def _(t):
    customers = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    suppliers = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return customers.unionByName(suppliers)


@query(
    "uc_null_in_both",
    "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE NULLIF(quality, 0) IS NULL "
    "INTERSECT SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE NULLIF(toxic, 0) IS NULL",
)
def _(t):
    """The intersection of two row sets of one table is one conjunctive predicate."""
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    q_missing = F.nullif("quality", F.lit(0)).isNull()
    x_missing = F.nullif("toxic", F.lit(0)).isNull()
    return joined.where(q_missing & x_missing).select("doc_id")


# --- scalar functions on business columns --------------------------------------------

@query(
    "f24_tolerant_number",
    "SELECT event_id, COALESCE(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS k, "
    "COALESCE(TRY_CAST(event_type AS DOUBLE), 0) AS bad FROM events",
)
def _(t):
    k = frame.tolerant_number(F.get_json_object("props", "$.k"))
    return t.events.select("event_id", k.alias("k"), frame.tolerant_number(F.col("event_type")).alias("bad"))


@query(
    "f25_log_and_exp",
    "SELECT o_orderkey, round(ln(o_totalprice), 6) AS logged, round(exp(ln(o_totalprice)), 4) AS restored FROM orders",
)
def _(t):
    logged = F.ln("o_totalprice")
    return t.orders.select("o_orderkey", F.round(logged, 6).alias("logged"), F.round(F.exp(logged), 4).alias("restored"))


FISCAL_YEARS = [f"{y}-{y + 1}" for y in range(1994, 2002)]


@query(
    "f29_one_hot",
    f"WITH x AS (SELECT o_orderkey, {ORDER_FY} AS fy FROM orders) SELECT o_orderkey, "
    + ", ".join(f"CAST(fy = '{v}' AS INTEGER) AS fy_{i}" for i, v in enumerate(FISCAL_YEARS))
    + f", CAST(fy IS NULL OR fy NOT IN ({sql_list(FISCAL_YEARS)}) AS INTEGER) AS fy_other FROM x",
)
def _(t):
    keyed = t.orders.select("o_orderkey", fiscal_year(F.col("o_orderdate")).alias("fy"))
    return frame.one_hot(keyed, "fy", FISCAL_YEARS, "fy")


@query(
    "f30_label_codes",
    "SELECT source, DENSE_RANK() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM documents)",
)
def _(t):
    return frame.label_codes(t.documents, "source", "code")


@query(
    "f31_rare_classes",
    """SELECT doc_id, CASE WHEN COUNT(*) OVER (PARTITION BY source) <= 48 OR source = 'src3' THEN 'Other'
              ELSE source END AS service FROM documents""",
)
def _(t):
    bucketed = frame.rare_bucketed(t.documents.select("doc_id", "source"), "source", 48, "service", also=["src3"])
    return bucketed.select("doc_id", "service")


@query(
    "f32_min_max_scale",
    """WITH m AS (SELECT MIN(value) AS a, MAX(value) AS b FROM events)
       SELECT event_id, round((value - a) / (b - a), 6) AS scaled,
              round((value - a) / (b - a) * (b - a) + a, 6) AS restored FROM events, m""",
)
def _(t):
    low = t.events.agg(F.min("value").alias("v")).scalar()
    high = t.events.agg(F.max("value").alias("v")).scalar()
    scaled = frame.min_max_scaled(t.events.select("event_id", "value"), "value", "scaled")
    restored = frame.min_max_restored(F.col("scaled"), low, high)
    return scaled.select("event_id", F.round("scaled", 6).alias("scaled"), F.round(restored, 6).alias("restored"))


@query(
    "f33_future_month_ends",
    """WITH last AS (SELECT c_mktsegment AS series_id, MAX(last_day(o_orderdate)) AS ts
                     FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
       SELECT series_id, CAST(h AS INTEGER) AS h, last_day(CAST(date_trunc('month', ts) AS TIMESTAMP) + to_months(CAST(h AS INTEGER))) AS ts
       FROM last, generate_series(1, 12) AS g(h)""",
)
def _(t):
    from ledgerleaf.functions.calendar import future_month_ends

    latest = t.orders.groupBy("o_custkey").agg(F.max(F.last_day("o_orderdate")).alias("ts"))
    orders = latest.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    last = orders.groupBy(F.col("c_mktsegment").alias("series_id")).agg(F.max("ts").alias("ts"))
    return future_month_ends(last, ["series_id"], "ts", 12)
