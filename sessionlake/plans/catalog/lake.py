"""File sets, the streamed dashboard, masking, policies, map cells, features and lineage, over the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionlake.contracts import GOLD, PART
from sessionlake.operators import masking
from sessionlake.operators.asof import features_asof
from sessionlake.operators.cells import cells, pyramid, with_place
from sessionlake.operators.conform import conform
from sessionlake.operators.lineage import lineage_rows, values
from sessionlake.operators.policy import Policies
from sessionlake.plans.adapt import cents, gold, table
from sessionlake.plans.catalog.registry import query
from sessionlake.plans.catalog.tiles import SESSIONS
from sessionlake.plans.catalog.zones import EVENT_SESSIONS, refined
from sessionlake.sources.filesets import FileSet, start_append
from sessionlake.streaming.dashboard import END, START, Latest, settle, start_dashboard, watermark, windowed
from sessionlake.workspace import materialize, scratch

#: Boxes of days and revenue that the clustered sessions are asked for.
BOXES = [
    ("1995-01-01", "1995-06-30", 0, 5_000_000), ("1997-03-01", "1997-09-30", 10_000_000, 20_000_000),
    ("1999-01-01", "1999-03-31", 30_000_000, 40_000_000), ("1995-01-01", "2001-12-31", 49_000_000, 60_000_000),
]
_BOX_ROWS = ", ".join(f"({i}, DATE '{a}', DATE '{b}', {x}, {y})" for i, (a, b, x, y) in enumerate(BOXES))


@query(
    "clustered_boxes",
    f"""
    SELECT box, count(d) AS sessions, CAST(coalesce(sum(cents), 0) AS BIGINT) AS revenue, TRUE AS few_files
    FROM (VALUES {_BOX_ROWS}) AS b(box, low_d, high_d, low_r, high_r)
    LEFT JOIN (SELECT d, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM ({SESSIONS})) s
        ON d BETWEEN low_d AND high_d AND cents BETWEEN low_r AND high_r
    GROUP BY box
    """,
)
def clustered_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions along a curve of day and revenue: boxes of both open few of the files."""
    sessions = gold(spark, sf_dir).where(F.col(PART) == 0)
    rows = sessions.select("fullVisitorId", "date", "totals", "geoNetwork", "trafficSource")
    ranges = {"date": F.col("date"), "revenue": F.col("totals.transactionRevenue")}
    files = FileSet(spark, scratch(spark, "clustered"), rows.schema, ranges=ranges)
    files.append(rows)
    files.cluster(["date", "revenue"], target=max(1, files.files().agg(F.sum("bytes")).first()[0] // 32))
    total, out = files.files().count(), []
    for i, (first, last, low, high) in enumerate(BOXES):
        box = {"date": (dt.date.fromisoformat(first), dt.date.fromisoformat(last)), "revenue": (low, high)}
        found = files.read(where=box).agg(
            F.count(F.lit(1)).alias("sessions"), F.coalesce(F.sum("totals.transactionRevenue"), F.lit(0)).alias("revenue")
        )
        few = len(files.chosen(where=box)) <= total / 2
        out.append(found.select(F.lit(i).alias("box"), "sessions", "revenue", F.lit(few).alias("few_files")))
    made = out[0]
    for one in out[1:]:
        made = made.unionByName(one)
    return made


def _replayed(spark: SparkSession, sf_dir: str, root: str, slices: int, late: int = 0) -> DataFrame:
    """The events as files in the order of their time, a slice each, as a stream that reads one after the other.

    Every ``late``-th event comes in a last slice, and the first slice comes twice.
    """
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", cents(F.col("value")).alias("cents"))
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    held_back = F.col("event_id") % late == 0 if late else F.lit(False)
    share = (F.unix_micros("ts") - F.unix_micros(F.lit(low))) / (F.unix_micros(F.lit(high)) - F.unix_micros(F.lit(low)) + 1)
    number = F.when(held_back, slices).otherwise(F.floor(share * slices))
    sliced = materialize(events.withColumn("slice", number.cast("int")), "slices")
    order = [0, *range(slices), slices] if late else range(slices)
    for turn, k in enumerate(order):
        sliced.where(F.col("slice") == k).drop("slice").coalesce(1).write.parquet(f"{root}/in/{turn:03}")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")


@query(
    "compacted_events",
    """
    SELECT event_type, count(*) AS n_rows, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, TRUE AS few_files
    FROM events GROUP BY 1
    """,
)
def compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed into a partitioned file set, batch by batch, and the small files compacted."""
    root = scratch(spark, "bronze")
    stream = _replayed(spark, sf_dir, root, 6)
    files = FileSet(spark, f"{root}/set", spark.read.parquet(f"{root}/in/000").schema, by=["event_type"])
    start_append(stream, files, f"{root}/checkpoint", "events", once=True).awaitTermination()
    before = files.files().groupBy("folder").agg(F.count(F.lit(1)).alias("before"))
    before = materialize(before, "before")
    files.compact()
    after = files.files().groupBy("folder").agg(F.count(F.lit(1)).alias("after"))
    few = before.join(after, "folder").select(
        F.regexp_extract("folder", "event_type=(.*)", 1).alias("event_type"), (F.col("after") * 2 <= F.col("before")).alias("few_files")
    )
    rows = files.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("cents").alias("cents"))
    return rows.join(few, "event_type")


@query(
    "stream_dashboard",
    """
    SELECT strftime(time_bucket(INTERVAL '6 hours', ts), '%Y-%m-%d %H:%M') AS starts, event_type, count(*) AS n_events,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM events GROUP BY 1, 2
    """,
)
def stream_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed aggregate of a replay with repeated and late rows, settled from what is stored."""
    root, measures = scratch(spark, "dashboard"), {"n_events": F.count(F.lit(1)), "cents": F.sum("cents")}
    stream = _replayed(spark, sf_dir, root, 6, late=97)
    stored = spark.read.schema(stream.schema).parquet(f"{root}/in/*")
    whole = windowed(stored, "ts", "6 hours", ["event_type"], measures, None, ["event_id"])
    latest = Latest(spark, f"{root}/latest", whole.schema, [START, END, "event_type"])
    live = windowed(stream, "ts", "6 hours", ["event_type"], measures, "1 day", ["event_id"])
    run = start_dashboard(live, latest, f"{root}/checkpoint", once=True)
    run.awaitTermination()
    settle(whole, latest, None, watermark(run))
    return latest.rows().select(F.date_format(START, "yyyy-MM-dd HH:mm").alias("starts"), "event_type", "n_events", "cents")


MASKING_KEY = b"pseudonyms of the test tables"


def masked_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold sessions with visitors and transactions under pseudonyms and no place finer than a country."""
    person = masking.Pseudonym(MASKING_KEY, "person")
    rules = {
        "fullVisitorId": person, "geoNetwork.city": masking.Remove(), "hits.transaction.transactionId": masking.Pseudonym(MASKING_KEY, "sale"),
        "hits.page.pageTitle": masking.Keep(4),
    }
    return masking.mask(gold(spark, sf_dir), rules)


@query(
    "mask_join",
    """
    SELECT c_nationkey, count(*) AS hits, count(DISTINCT o_orderkey) AS sessions, count(DISTINCT o_custkey) AS visitors
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
    """,
)
def mask_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked sessions against masked customers: pseudonyms join as the keys did."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), "c_nationkey")
    known = masking.mask(customers, {"id": masking.Pseudonym(MASKING_KEY, "person")})
    sessions = masked_sessions(spark, sf_dir)
    hits = sessions.select("fullVisitorId", "visitId", F.explode("hits.transaction.transactionId").alias("sale"))
    return known.join(hits, known["id"] == hits["fullVisitorId"]).groupBy("c_nationkey").agg(
        F.count("sale").alias("hits"), F.count_distinct("visitId").alias("sessions"), F.count_distinct("id").alias("visitors")
    )


@query(
    "mask_leaves",
    """
    SELECT unnest(['city', 'sale', 'title', 'visitor']) AS kind, 0::BIGINT AS raw_left,
           unnest([0, (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem), (SELECT count(*) FROM orders)]) AS masked
    """,
)
def mask_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No raw value is left in any text of the masked sessions."""
    kinds = {
        "visitor": ["fullVisitorId"], "city": ["geoNetwork.city"], "sale": ["hits.transaction.transactionId"], "title": ["hits.page.pageTitle"],
    }
    paths = {p: k for k, ps in kinds.items() for p in ps}
    named = F.create_map(*[F.lit(x) for pair in paths.items() for x in pair])
    before = masking.leaves(gold(spark, sf_dir), list(paths)).select(named[F.col("path")].alias("kind"), "value").distinct()
    after = masking.leaves(masked_sessions(spark, sf_dir), list(paths))
    in_place = after.select(named[F.col("path")].alias("kind"), "value")
    left = in_place.join(before, ["kind", "value"], "left_semi").groupBy("kind").agg(F.count(F.lit(1)).alias("raw_left"))
    held = in_place.groupBy("kind").agg(F.count(F.lit(1)).alias("masked"))
    all_kinds = spark.createDataFrame([(k,) for k in kinds], "kind string")
    return all_kinds.join(held, "kind", "left").join(left, "kind", "left").select(
        "kind", F.coalesce("raw_left", F.lit(0).cast("long")).alias("raw_left"), F.coalesce("masked", F.lit(0).cast("long")).alias("masked")
    )


@query(
    "mask_documents",
    r"""
    WITH d AS (SELECT doc_id, text, row_number() OVER () AS r FROM documents),
    c AS (
        SELECT r, x FROM (
            SELECT r, unnest(regexp_extract_all(text,
                '\b(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})\b')) AS x FROM d)
        WHERE list_sum([
            CASE WHEN i % 2 = 0 AND v > 4 THEN 2 * v - 9 WHEN i % 2 = 0 THEN 2 * v ELSE v END
            FOR v, i IN [CAST(z AS INTEGER) FOR z IN string_split(reverse(regexp_replace(x, '[ -]', '', 'g')), '')]]) % 10 = 0),
    cards AS (SELECT r, count(*) AS n_card, list(DISTINCT x) AS xs FROM c GROUP BY 1),
    without AS (
        SELECT d.r, doc_id, coalesce(n_card, 0) AS n_card, CASE WHEN xs IS NULL THEN text ELSE
            list_reduce(list_prepend(text, xs), lambda t, x: regexp_replace(t, '\b' || x || '\b', '[card]', 'g')) END AS text
        FROM d LEFT JOIN cards USING (r)),
    mails AS (SELECT *, regexp_extract_all(text, '\b[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\b') AS ms FROM without)
    SELECT doc_id, n_card, coalesce(len(ms), 0) AS n_email, sha256(coalesce(CASE WHEN len(ms) = 0 THEN text ELSE
        list_reduce(list_prepend(text, list_distinct(ms)), lambda t, x: regexp_replace(t, '\b' || regexp_escape(x) || '\b', '[email]', 'g')) END, '')) AS text_sha256
    FROM mails
    """,
)
def mask_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without card numbers and addresses, and how many of both they had."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    masked = masking.mask(docs.withColumn("masked", F.col("text")), {"masked": masking.Scrub(("card", "email"))})

    def n(kind: str):
        return F.coalesce(F.size(masking.find(F.col("text"), kind)).cast("long"), F.lit(0).cast("long"))

    return masked.select(
        "doc_id", F.greatest(n("card"), F.lit(0)).alias("n_card"), F.greatest(n("email"), F.lit(0)).alias("n_email"),
        F.sha2(F.coalesce("masked", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


@query(
    "policy_views",
    """
    SELECT r_name AS principal, count(*) AS sessions, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue,
           'date,geoNetwork.country,month,totals.transactionRevenue,year' AS seen
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE year(o_orderdate) = 1995 + r_regionkey GROUP BY 1
    """,
)
def policy_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region's principal sees the sessions of its nations in one year, and four leaves of them."""
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    by_nation = nations.select(F.col("r_name").alias("principal"), F.lit("geoNetwork.country").alias("path"), F.col("n_name").alias("value"))
    by_year = nations.select("r_name", F.lit("year"), (1995 + F.col("r_regionkey")).cast("string")).distinct()
    leaves = F.explode(F.array(*map(F.lit, ["date", "geoNetwork.country", "totals.transactionRevenue", "year", "month"])))
    policies = Policies(
        by_nation.union(by_year), table(spark, sf_dir, "region").select(F.col("r_name").alias("principal"), leaves.alias("path")),
        ("year", "geoNetwork.country"),
    )
    sessions, made = gold(spark, sf_dir).where(F.col(PART) == 0), None
    for r in table(spark, sf_dir, "region").select("r_name").collect():
        seen = policies.view(sessions, r["r_name"])
        paths = sorted(f"{f.name}.{g.name}" if isinstance(f.dataType, StructType) else f.name for f in seen.schema.fields for g in getattr(f.dataType, "fields", [f]))
        one = seen.groupBy(F.lit(r["r_name"]).alias("principal")).agg(
            F.count(F.lit(1)).alias("sessions"), F.sum("totals.transactionRevenue").alias("revenue"), F.lit(",".join(paths)).alias("seen")
        )
        made = one if made is None else made.unionByName(one)
    return made


# Places of the visitors: made up from their number, half of them in one town.
_LAT = "CASE WHEN o_custkey % 2 = 0 THEN 51.5 + (o_custkey % 100) / 1000.0 ELSE (o_custkey * 7919 % 18000) / 100.0 - 90 END"
_LON = "CASE WHEN o_custkey % 2 = 0 THEN -0.1 - (o_custkey % 70) / 1000.0 ELSE (o_custkey * 104729 % 36000) / 100.0 - 180 END"
CELL_LEVELS, CELL_ROWS = 10, 200


def _cell_sql(select: str) -> str:
    return f"""
    WITH p AS (
        SELECT least(CAST(floor((CAST({_LON} AS DOUBLE) + 180) / 360 * {1 << CELL_LEVELS}) AS BIGINT), {(1 << CELL_LEVELS) - 1}) AS x,
               least(CAST(floor((CAST({_LAT} AS DOUBLE) + 90) / 180 * {1 << CELL_LEVELS}) AS BIGINT), {(1 << CELL_LEVELS) - 1}) AS y
        FROM orders),
    c AS (
        SELECT level, x >> ({CELL_LEVELS} - level) AS x, y >> ({CELL_LEVELS} - level) AS y, count(*) AS n
        FROM p, (SELECT unnest(range({CELL_LEVELS + 1})) AS level) GROUP BY ALL)
    {select}
    """


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return with_place(orders, F.expr(_LAT).cast("double").cast("string"), F.expr(_LON).cast("double").cast("string"), CELL_LEVELS)


@query("map_pyramid", _cell_sql("SELECT CAST(level AS INTEGER) AS level, x, y, n FROM c"))
def map_pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions in every cell of every level."""
    return pyramid(_places(spark, sf_dir), CELL_LEVELS).select("level", "x", "y", "n")


@query(
    "map_cells",
    _cell_sql(
        f"""SELECT CAST(c.level AS INTEGER) AS level, c.x, c.y, c.n FROM c
        LEFT JOIN c AS u ON u.level = c.level - 1 AND u.x = c.x >> 1 AND u.y = c.y >> 1
        WHERE (c.n <= {CELL_ROWS} OR c.level = {CELL_LEVELS}) AND coalesce(u.n > {CELL_ROWS}, TRUE)"""
    ),
)
def map_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells to draw: split until none has more than 200 sessions."""
    return cells(_places(spark, sf_dir), CELL_ROWS, CELL_LEVELS).select("level", "x", "y", "n")


@query(
    "features_asof",
    """
    WITH d AS (
        SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
               CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS purchases
        FROM events GROUP BY 1, 2)
    SELECT user_id, CAST(day AS VARCHAR) AS day, CAST(day - lag(day) OVER w AS INTEGER) AS days_since,
           CAST(coalesce(sum(n) OVER week, 0) AS BIGINT) AS n_week, CAST(coalesce(sum(cents) OVER week, 0) AS BIGINT) AS cents_week,
           CAST(coalesce(sum(purchases) OVER week, 0) AS BIGINT) AS purchases_week,
           CAST(coalesce(sum(n) OVER ever, 0) AS BIGINT) AS n_ever, CAST(coalesce(sum(cents) OVER ever, 0) AS BIGINT) AS cents_ever,
           CAST(coalesce(sum(purchases) OVER ever, 0) AS BIGINT) AS purchases_ever
    FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day),
        week AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING),
        ever AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAYS PRECEDING)
    """,
)
def visitor_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known of each user at the start of each of their days."""
    measures = {"cents": cents(F.col("value")), "purchases": (F.col("event_type") == "purchase").cast("long")}
    made = features_asof(table(spark, sf_dir, "events"), ["user_id"], F.to_date("ts"), measures, {"week": 7, "ever": None})
    return made.withColumn("day", F.col("day").cast("string"))


@query(
    "lineage_values",
    f"""
    WITH s AS (
        SELECT count(*) AS n, count(*) FILTER (n_hits = 1) AS bounces, count(*) FILTER (purchases > 0) AS sales FROM ({EVENT_SESSIONS})),
    h AS (
        SELECT count(*) AS n, count(*) FILTER (event_type = 'purchase' AND value IS NOT NULL) AS sales,
               count(json_extract_string(props, '$.k')) AS paths
        FROM events)
    SELECT target, target AS source, n_values FROM (
        SELECT unnest(['visitId', 'visitNumber', 'visitStartTime', 'channelGrouping', 'date', 'fullVisitorId', 'socialEngagementType',
                       'totals.hits', 'totals.visits', 'totals.transactions']) AS target, s.n AS n_values FROM s
        UNION ALL SELECT 'totals.bounces', bounces FROM s
        UNION ALL SELECT 'totals.transactionRevenue', sales FROM s
        UNION ALL SELECT unnest(['hits.type', 'hits.time', 'hits.hitNumber', 'hits.isEntrance', 'hits.isExit', 'hits.isInteraction',
                                 'hits.page.hostname']), h.n FROM h
        UNION ALL SELECT 'hits.page.pagePath', paths FROM h
        UNION ALL SELECT 'hits.transaction.transactionRevenue', sales FROM h)
    WHERE n_values > 0
    """,
)
def lineage_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold leaves that have values, the raw leaf each comes from by the plan that made it, and how many there are."""
    zones = refined(spark, sf_dir)
    made = conform(zones.zone(spark, "bronze"), GOLD)
    counted = values(zones.zone(spark, "gold").select(*GOLD.fieldNames())).where("n > 0")
    return lineage_rows(made).join(counted.select(F.col("leaf").alias("target"), F.col("n").alias("n_values")), "target")
