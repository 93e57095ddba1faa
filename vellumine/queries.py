"""The reference queries on the driver's tables, and their SQL.

The tables hold no page records, so each query applies an operator to the
nearest table; both sides derive its input in the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumine.functions import geometry as G
from vellumine.functions import stats
from vellumine.functions import text as T
from vellumine.operators import answers, book, layout, merge, placement, ranges, reports, rules, validate
from vellumine.plans.rules import WRITER
from vellumine.sources import scans, sinks
from vellumine.sources.scans import table

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return put


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


# The engine of the SQL side has no look-behind: a digit right after a letter is dropped first.
_NUMBERS = r"""list_transform(regexp_extract_all(regexp_replace(regexp_replace({0}, '(?m)^\s*\d+\.\s+', '', 'g'), '([A-Za-z])\d', '\1', 'g'),
  '\d+(?:,\d{{3}})*(?:\.\d+)?'), lambda x: replace(x, ',', ''))"""


@_query(
    rf"""WITH t AS (SELECT lang, unnest({_NUMBERS.format('text')}) AS token FROM documents),
c AS (SELECT lang, token, count(*) AS n FROM t GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rank FROM c)
SELECT lang, token, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5"""
)
def numeric_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The five most frequent numbers of each language."""
    return reports.numbers_by_group(table(spark, sf, "documents"), "text", "lang", 5)


@_query(
    rf"""WITH d AS (SELECT doc_id, {_NUMBERS.format('text')} AS x FROM documents)
SELECT doc_id, len(x) AS n, len(list_distinct(x)) AS n_distinct,
  len(regexp_extract_all(d2.text, '(?m)^\s*\d+\.\s+')) AS items
FROM d JOIN documents d2 USING (doc_id) WHERE len(x) > 0"""
)
def numbered_items(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and list markers of the documents that hold any number."""
    found = table(spark, sf, "documents").withColumn("x", T.numbers(F.col("text"))).where(F.size("x") > 0)
    return found.select("doc_id", F.size("x").cast("long").alias("n"), F.size(F.array_distinct("x")).cast("long").alias("n_distinct"), T.numbered_items(F.col("text")).cast("long").alias("items"))


@_query(
    r"""WITH w AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(replace(lower(regexp_replace(text, '(?m)^\s*\d+\.\s+', '', 'g')), '’', ''''), '[a-z]+(?:''[a-z]+)?|\d+(?:,\d{3})*'))) AS t FROM benchmark),
d AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(replace(lower(regexp_replace(text, '(?m)^\s*\d+\.\s+', '', 'g')), '’', ''''), '[a-z]+(?:''[a-z]+)?|\d+(?:,\d{3})*'))) AS t FROM documents),
n AS (SELECT item_id, count(*) AS n FROM w GROUP BY item_id)
SELECT d.doc_id, w.item_id, round(count(*) / max(n.n), 6) AS coverage
FROM d JOIN w USING (t) JOIN n USING (item_id) GROUP BY ALL HAVING count(*) * 10 >= max(n.n) * 7"""
)
def word_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that cover 70 % or more of a benchmark item's words: an equi-join on the words."""
    words = table(spark, sf, "benchmark").select("item_id", T.word_set(F.col("text")).alias("w"))
    words = words.select("item_id", F.size("w").alias("n"), F.explode("w").alias("t"))
    docs = table(spark, sf, "documents").select("doc_id", F.explode(T.word_set(F.col("text"))).alias("t"))
    common = docs.join(words, "t").groupBy("doc_id", "item_id").agg(F.count("*").alias("c"), F.max("n").alias("n"))
    return common.where("c * 10 >= n * 7").select("doc_id", "item_id", F.round(F.col("c") / F.col("n"), 6).alias("coverage"))


@_query(
    r"""SELECT regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g') AS expression, count(*) AS n, min(doc_id) AS first_pos
FROM documents GROUP BY 1 HAVING count(*) > 1"""
)
def repeated_expressions(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that occur more than once."""
    return reports.repeated_expressions(table(spark, sf, "documents"), T.repeated_key(F.col("text")), "doc_id")


@_query(
    r"""WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'), a AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
j AS (SELECT u.conv_id, u.turn, coalesce(a.text, '') AS target, length(regexp_replace(u.text, '\s+', '', 'g')) AS n, length(regexp_replace(coalesce(a.text, ''), '\s+', '', 'g')) AS m
FROM u LEFT JOIN a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1)
SELECT conv_id, turn, n AS source_length, m AS target_length, n >= 15 AND m > greatest(n * 3, n + 80) AS suspicious_expansion FROM j"""
)
def length_expansion(spark: SparkSession, sf: str) -> DataFrame:
    """User turns with the answer that follows, and whether it is suspiciously long."""
    turns = table(spark, sf, "conversations")
    asked = turns.where("role = 'user'").select(F.col("conv_id").alias("page"), F.col("turn").alias("id"), F.col("text").alias("source_text"))
    given = turns.where("role = 'assistant'").select(F.col("conv_id").alias("page"), (F.col("turn") - 1).alias("id"), F.col("text").alias("translation"))
    out = merge.translated(asked, given)
    size = lambda c: T.non_space_length(F.col(c)).cast("long")
    return out.select(F.col("page").alias("conv_id"), F.col("id").alias("turn"), size("source_text").alias("source_length"), size("translation").alias("target_length"), "suspicious_expansion")


@_query(
    """WITH d AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE role <> 'system'),
r AS (SELECT conv_id, turn, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM d),
i AS (SELECT conv_id, g, min(turn) AS lo, max(turn) AS hi FROM r GROUP BY ALL)
SELECT conv_id, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, '_' ORDER BY lo) AS label FROM i GROUP BY conv_id"""
)
def range_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of each conversation as compact ranges."""
    return ranges.island_labels(table(spark, sf, "conversations").where("role <> 'system'"), ["conv_id"], "turn")


@_query(
    """WITH a AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0), b AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1)
SELECT count(*) FILTER (a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL) AS overlap, count(*) FILTER (b.doc_id IS NULL) AS left_only, count(*) FILTER (a.doc_id IS NULL) AS right_only
FROM a FULL JOIN b ON a.doc_id = b.doc_id"""
)
def set_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of low quality against toxic ones."""
    labels = table(spark, sf, "labels")
    return merge.set_overlap(labels.where("quality = 0"), labels.where("toxic = 1"), ["doc_id"])


@_query(
    """WITH s AS (SELECT DISTINCT event_type, user_id FROM events), n AS (SELECT event_type, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.event_type AS a, y.event_type AS b, count(*) AS overlap FROM s x JOIN s y ON x.user_id = y.user_id AND x.event_type < y.event_type GROUP BY ALL)
SELECT x.event_type AS a, y.event_type AS b, x.n AS left_n, y.n AS right_n, coalesce(c.overlap, 0) AS overlap
FROM n x JOIN n y ON x.event_type < y.event_type LEFT JOIN c ON c.a = x.event_type AND c.b = y.event_type"""
)
def pairwise_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Users that each two event types have in common."""
    return merge.pairwise_overlap(table(spark, sf, "events"), "event_type", ["user_id"])


@_query(
    """SELECT d.doc_id, CASE WHEN h.doc_id IS NOT NULL THEN 'toxic ' || d.lang WHEN r.doc_id IS NOT NULL THEN 'poor ' || d.lang ELSE d.lang END AS final_translation,
  CASE WHEN h.doc_id IS NOT NULL THEN 'human_override' WHEN r.doc_id IS NOT NULL THEN 'codex_adjudication' ELSE 'saved_page_translation' END AS translation_source
FROM documents d LEFT JOIN (SELECT doc_id FROM labels WHERE toxic = 1) h ON h.doc_id = d.doc_id LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 0) r ON r.doc_id = d.doc_id"""
)
def override_priority(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as overrides and decisions over the saved language of each document."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    none = F.lit(None).cast("string")
    key = [F.lit(1).alias("page"), F.col("doc_id").alias("id")]
    regions = docs.select(*key, F.lit("other").alias("type"), none.alias("source_text"), F.col("lang").alias("translation"), "lang")
    named = labels.join(docs.select("doc_id", "lang"), "doc_id")
    people = named.where("toxic = 1").select(*key, F.concat(F.lit("toxic "), "lang").alias("final_translation"), none.alias("reason"))
    reviews = named.where("quality = 0").select(*key, F.lit("replace").alias("decision"), F.concat(F.lit("poor "), "lang").alias("final_translation"), none.alias("reason"), none.alias("child_note"))
    return merge.locked_snapshot(regions, reviews, people).select(F.col("id").alias("doc_id"), "final_translation", "translation_source")


@_query(
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice FROM orders"""
)
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Finished orders with a new price replace the old rows."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    updates = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 100)
    return merge.upsert(orders, updates, ["o_orderkey"])


@_query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label."""
    return merge.missing(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])


@_query(
    """WITH e AS (SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt, max(event_id) OVER () AS top FROM events)
SELECT user_id, event_id, coalesce(nxt - 1, top) AS "end" FROM e"""
)
def range_lead(spark: SparkSession, sf: str) -> DataFrame:
    """Each event's range of ids, up to the user's next event."""
    events = table(spark, sf, "events").select("user_id", "event_id")
    top = events.agg(F.max("event_id")).first()[0]
    return ranges.with_ends(events, ["user_id"], "event_id", F.lit(top))


@_query(
    """WITH o AS (SELECT o_custkey, o_orderkey, datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS lo FROM orders),
r AS (SELECT *, lo + 30 AS hi, max(lo + 30) OVER (PARTITION BY o_custkey ORDER BY lo, lo + 30, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM o)
SELECT o_custkey, count(*) AS n FROM r WHERE reached >= lo GROUP BY 1"""
)
def overlap_check(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a customer within 30 days of an earlier one."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("lo"))
    found = ranges.overlaps(orders.withColumn("hi", F.col("lo") + 30), ["o_custkey"], "lo", "hi")
    return found.groupBy("o_custkey").agg(F.count("*").alias("n"))


@_query(
    """WITH s AS (SELECT user_id, event_id FROM events WHERE event_type = 'signup'), p AS (SELECT user_id, event_id FROM events WHERE event_type = 'purchase')
SELECT p.user_id, p.event_id, max(s.event_id) AS chapter FROM p LEFT JOIN s ON s.user_id = p.user_id AND s.event_id <= p.event_id GROUP BY ALL"""
)
def point_in_interval(spark: SparkSession, sf: str) -> DataFrame:
    """Each purchase with the signup whose range it lies in."""
    events = table(spark, sf, "events")
    starts = events.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("start"), F.col("event_id").alias("chapter"))
    points = events.where("event_type = 'purchase'").select("user_id", "event_id")
    return ranges.containing(points, starts, ["user_id"], "event_id", "start", "chapter")


@_query(
    """WITH s AS (SELECT user_id AS page, CASE event_type WHEN 'error' THEN 'missing' WHEN 'view' THEN 'low' WHEN 'click' THEN 'medium' ELSE 'high' END AS c FROM events),
g AS (SELECT page, sum(CASE c WHEN 'missing' THEN 8 WHEN 'low' THEN 5 WHEN 'medium' THEN 2 ELSE 0 END) AS score,
  list_sort(list_distinct(list(CASE c WHEN 'missing' THEN 'unmapped region' WHEN 'low' THEN 'low mapping confidence' WHEN 'medium' THEN 'medium mapping confidence' END) FILTER (c <> 'high'))) AS reasons FROM s GROUP BY 1)
SELECT page, CAST(score AS BIGINT) AS score, array_to_string(reasons, ', ') AS reasons FROM g ORDER BY score DESC, page LIMIT 10"""
)
def spotcheck(spark: SparkSession, sf: str) -> DataFrame:
    """The ten users with the most doubtful events."""
    kind = F.when(F.col("event_type") == "error", "missing").when(F.col("event_type") == "view", "low").when(F.col("event_type") == "click", "medium").otherwise("high")
    rows = table(spark, sf, "events").select(F.col("user_id").alias("page"), kind.alias("confidence"), F.array().cast("array<string>").alias("warnings"))
    return reports.spotcheck(rows, 10).withColumn("reasons", F.array_join("reasons", ", "))


_USAGE = """WITH e AS (SELECT user_id, event_type <> 'error' AS ok, CAST(value * 100 AS BIGINT) AS tokens, CAST(json_extract(props, '$.k') AS BIGINT) AS cached FROM events)
SELECT user_id, {0}(ok) AS available, CASE WHEN {0}(ok) THEN CAST(sum(tokens) FILTER (ok) AS BIGINT) END AS tokens, CASE WHEN {0}(ok) THEN CAST(sum(cached) FILTER (ok) AS BIGINT) END AS cached FROM e GROUP BY 1"""


def _usage(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    cached = F.from_json("props", "k long")["k"]
    return events.select("user_id", (F.col("event_type") != "error").alias("available"), F.round(F.col("value") * 100).cast("long").alias("tokens"), cached.alias("cached"))


@_query(_USAGE.format("bool_or"))
def usage_any(spark: SparkSession, sf: str) -> DataFrame:
    """Usage of each user over the events that have it."""
    return reports.usage_sums(_usage(spark, sf), ["user_id"], ["tokens", "cached"])


@_query(_USAGE.format("bool_and"))
def usage_all(spark: SparkSession, sf: str) -> DataFrame:
    """The same, only for users whose events all have it."""
    return reports.usage_sums(_usage(spark, sf), ["user_id"], ["tokens", "cached"], need_all=True)


@_query(
    """SELECT event_type, CAST(sum(greatest(0, CAST(value * 100 AS BIGINT) - CAST(json_extract(props, '$.k') AS BIGINT))) AS BIGINT) AS non_cached FROM events GROUP BY 1"""
)
def usage_rest(spark: SparkSession, sf: str) -> DataFrame:
    """What no cache answered, by event type."""
    rows = table(spark, sf, "events").select("event_type", F.round(F.col("value") * 100).cast("long").alias("tokens"), F.from_json("props", "k long")["k"].alias("cached"))
    return rows.groupBy("event_type").agg(F.sum(stats.non_negative_rest(F.col("tokens"), F.col("cached"))).alias("non_cached"))


@_query("SELECT user_id, max_by(event_type, event_id) AS last_value FROM events WHERE event_type <> 'error' GROUP BY 1")
def last_event(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's last event that is no error."""
    return reports.last_event(table(spark, sf, "events"), ["user_id"], [F.col("event_id")], F.col("event_type"), F.col("event_type") != "error")


@_query(
    """WITH m AS (SELECT user_id, quantile_cont(value, 0.5) AS m FROM events GROUP BY 1),
d AS (SELECT e.user_id, max(m) AS m, quantile_cont(abs(value - m), 0.5) AS mad FROM events e JOIN m USING (user_id) GROUP BY 1)
SELECT user_id, round(m, 6) AS median, round(mad, 6) AS mad, round(least(65.0, greatest(18.0, m + 4 * greatest(1.0, 1.4826 * mad))), 6) AS threshold FROM d"""
)
def robust_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Robust threshold of each user's values."""
    found = stats.robust_thresholds(table(spark, sf, "events"), ["user_id"], "value", 18.0)
    return found.select("user_id", *[F.round(c, 6).alias(c) for c in ("median", "mad", "threshold")])


@_query(
    """WITH m AS (SELECT user_id, quantile_cont(value, 0.5) AS m FROM events GROUP BY 1),
d AS (SELECT e.user_id, value, abs(value - m) AS d FROM events e JOIN m USING (user_id)),
c AS (SELECT user_id, quantile_cont(d, 0.7) AS c FROM d GROUP BY 1)
SELECT user_id, round(quantile_cont(value, 0.5), 6) AS fill FROM d JOIN c USING (user_id) WHERE d <= greatest(2.0, c + 1e-9) GROUP BY 1"""
)
def coherent_median(spark: SparkSession, sf: str) -> DataFrame:
    """Median of the values near each user's median."""
    events = table(spark, sf, "events")
    return stats.coherent_medians(events, ["user_id"], "value", 0.7, 2.0).select("user_id", F.round("fill", 6).alias("fill"))


_BOXES = """SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS id,
  [l_partkey * 37 % 900, l_suppkey * 91 % 900, l_partkey * 37 % 900 + 20 + CAST(l_quantity AS BIGINT) * 4, l_suppkey * 91 % 900 + 20 + l_linenumber * 12] AS box FROM lineitem"""


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    """A box for each line of an order, which is its page."""
    lines = table(spark, sf, "lineitem")
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"))
    x, y = F.col("l_partkey") * 37 % 900, F.col("l_suppkey") * 91 % 900
    box = F.array(*[c.cast("double") for c in (x, y, x + 20 + F.col("l_quantity").cast("long") * 4, y + 20 + F.col("l_linenumber") * 12)])
    return lines.select(F.col("l_orderkey").alias("page"), number.cast("long").alias("id"), box.alias("box"))


@_query(
    f"""WITH b AS ({_BOXES}), p AS (SELECT x.page, x.id AS first_id, y.id AS second_id, x.box AS a, y.box AS b,
  greatest(0, least(x.box[3], y.box[3]) - greatest(x.box[1], y.box[1])) * greatest(0, least(x.box[4], y.box[4]) - greatest(x.box[2], y.box[2])) AS common
  FROM b x JOIN b y ON x.page = y.page AND x.id < y.id),
r AS (SELECT page, first_id, second_id, common / least(greatest(1, (a[3] - a[1]) * (a[4] - a[2])), greatest(1, (b[3] - b[1]) * (b[4] - b[2]))) AS ratio FROM p)
SELECT page, first_id, second_id, round_even(ratio, 4) AS overlap_ratio FROM r WHERE ratio >= 0.35"""
)
def severe_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of a page that cover each other."""
    return validate.severe_overlaps(_boxes(spark, sf), "page", "id")


@_query(
    f"""WITH RECURSIVE b AS MATERIALIZED ({_BOXES}), g AS (SELECT x.page, x.id AS i, y.id AS j, x.box AS a, y.box AS b,
  greatest(x.box[2] - y.box[4], y.box[2] - x.box[4], 0) AS vg, greatest(x.box[1] - y.box[3], y.box[1] - x.box[3], 0) AS hg,
  greatest(least(x.box[4], y.box[4]) - greatest(x.box[2], y.box[2]), 0) AS vo, greatest(least(x.box[3], y.box[3]) - greatest(x.box[1], y.box[1]), 0) AS ho
  FROM b x JOIN b y ON x.page = y.page AND x.id <> y.id),
e AS MATERIALIZED (SELECT page, i, j FROM g WHERE (vo / greatest(1, least(a[4] - a[2], b[4] - b[2])) >= 0.5 AND hg <= 18)
  OR (vg <= 16 AND ho / greatest(1, least(a[3] - a[1], b[3] - b[1])) >= 0.3)
  OR (vg <= 10 AND abs((a[1] + a[3]) - (b[1] + b[3])) / 2 <= greatest(45, 0.65 * greatest(a[3] - a[1], b[3] - b[1])))),
r AS (SELECT page, id AS i, id AS j FROM b UNION SELECT r.page, r.i, e.j FROM r JOIN e ON e.page = r.page AND e.i = r.j)
SELECT page, i AS id, min(j) AS component FROM r GROUP BY ALL"""
)
def box_components(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of adjacent boxes of each page."""
    return layout.page_components(_boxes(spark, sf), "page", "id")


@_query(
    f"""WITH b AS ({_BOXES}) SELECT page, CAST(min(box[1]) AS DOUBLE) AS x1, CAST(min(box[2]) AS DOUBLE) AS y1, CAST(max(box[3]) AS DOUBLE) AS x2, CAST(max(box[4]) AS DOUBLE) AS y2 FROM b GROUP BY 1"""
)
def union_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Bounding box of each page's boxes."""
    whole = _boxes(spark, sf).groupBy("page").agg(G.union(F.collect_list("box")).alias("b"))
    return whole.select("page", *[F.col("b")[k].alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))])


@_query(
    f"""WITH b AS ({_BOXES}), s AS (SELECT page, id, [least(greatest(CAST(round_even(box[1] / 1000.0 * 777, 0) AS INT), 0), 776), least(greatest(CAST(round_even(box[2] / 1000.0 * 555, 0) AS INT), 0), 554)] AS lo,
  [CAST(round_even(box[3] / 1000.0 * 777, 0) AS INT), CAST(round_even(box[4] / 1000.0 * 555, 0) AS INT)] AS hi FROM b)
SELECT page, id, lo[1] AS x1, lo[2] AS y1, greatest(lo[1] + 1, least(hi[1], 777)) AS x2, greatest(lo[2] + 1, least(hi[2], 555)) AS y2 FROM s"""
)
def pixel_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Grid boxes in pixels of an image of 777 by 555."""
    px = G.to_pixels(F.col("box"), F.lit(777), F.lit(555))
    return _boxes(spark, sf).select("page", "id", *[px[k].alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))])


@_query(
    """WITH i AS (SELECT l_orderkey AS page, l_partkey % 100 AS lo, l_partkey % 100 + CAST(l_quantity AS BIGINT) AS hi FROM lineitem),
p AS (SELECT page, unnest(range(lo, least(hi, 120))) AS x FROM i), c AS (SELECT page, count(DISTINCT x) AS n FROM p GROUP BY 1)
SELECT l.page, round(coalesce(c.n, 0) / 120, 6) AS coverage FROM (SELECT DISTINCT l_orderkey AS page FROM lineitem) l LEFT JOIN c USING (page)"""
)
def interval_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Share of 120 positions that an order's intervals cover."""
    start = (F.col("l_partkey") % 100).cast("int")
    spans = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page"), F.struct(start.alias("start"), (start + F.col("l_quantity").cast("int")).alias("end")).alias("s"))
    return spans.groupBy("page").agg(F.collect_list("s").alias("s")).select("page", F.round(G.covered(F.lit(120), F.col("s")), 6).alias("coverage"))


@_query(
    """WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / 50.0 AS c, l_quantity > 1 AS ok, l_linenumber AS n, l_extendedprice FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN c >= 0.9 THEN 'high' WHEN c >= 0.65 THEN 'medium' WHEN ok THEN 'low' ELSE 'missing' END AS confidence,
  concat_ws(',', CASE WHEN NOT ok THEN 'layout_not_found' END, CASE WHEN ok AND c < 0.65 THEN 'low_match_coverage' END, CASE WHEN n > 1 AND c < 0.9 THEN 'ambiguous_layout_candidates' END) AS warnings,
  CASE WHEN NOT ok THEN 'unmatched_skipped' WHEN c < 0.65 THEN 'skipped_low_confidence' WHEN n > 1 AND c < 0.9 THEN 'skipped_ambiguous_mapping' END AS skip FROM m"""
)
def confidence_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Confidence, warnings and the writer's decision for each line."""
    rows = table(spark, sf, "lineitem").withColumn("c", F.col("l_quantity") / 50.0).withColumn("ok", F.col("l_quantity") > 1)
    warned = rules.mapping_warnings(F.col("c"), F.col("ok"), F.col("l_linenumber"))
    rows = rows.withColumn("w", warned).withColumn("confidence", rules.confidence(F.col("c"), F.col("ok")))
    skip = rules.writer_skip(F.col("c"), F.col("w"), F.col("ok"), F.lit(False), F.lit(False))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "confidence", F.array_join("w", ",").alias("warnings"), skip.alias("skip"))


@_query(
    """WITH m AS (SELECT l_orderkey AS page, l_quantity / 50.0 AS c FROM lineitem)
SELECT page, count(*) AS regions, count(*) FILTER (c >= 0.1) AS mapped, count(*) FILTER (c < 0.1) AS unmapped, count(*) FILTER (c < 0.65) AS warned FROM m GROUP BY ROLLUP (page)"""
)
def mapping_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of mappings by page, and in all."""
    c = F.col("l_quantity") / 50.0
    selected = c >= 0.1
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page"), rules.confidence(c, selected).alias("confidence"), rules.mapping_warnings(c, selected, F.lit(1)).alias("warnings"))
    return reports.mapping_summary(rows)


@_query(
    """SELECT l_orderkey AS page, l_suppkey AS item, array_to_string(list_sort(list_distinct(list(CAST(l_partkey AS VARCHAR)))), ',') AS ids FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
)
def shared_items(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers that several lines of an order share."""
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_partkey").cast("string").alias("id"), F.array("l_suppkey").alias("layout_item_indexes"))
    return reports.shared_items(rows).withColumn("ids", F.array_join("ids", ","))


@_query(
    """SELECT l_partkey, l_orderkey AS owner, l_extendedprice AS score FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey) AS r FROM lineitem) WHERE r = 1"""
)
def item_owners(spark: SparkSession, sf: str) -> DataFrame:
    """For each part the order that claims it with the highest price, the first one among equals."""
    best = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max(F.struct(F.col("l_extendedprice").alias("score"), (-F.col("l_orderkey")).alias("at"))).alias("b"))
    return best.select("l_partkey", (-F.col("b.at")).alias("owner"), F.col("b.score").alias("score"))


@_query(
    """WITH u AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'assistant')
SELECT u.conv_id, CAST(u.k AS INTEGER) AS k, u.turn AS left_pos, a.turn AS right_pos FROM u JOIN a USING (conv_id, k) WHERE a.n >= u.n"""
)
def paired_turns(spark: SparkSession, sf: str) -> DataFrame:
    """The k-th question with the k-th answer."""
    turns = table(spark, sf, "conversations")
    return merge.paired(turns.where("role = 'user'"), turns.where("role = 'assistant'"), ["conv_id"], "turn")


@_query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def dependency_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that come from more than one supplier."""
    return validate.functional_dependency(table(spark, sf, "lineitem"), ["l_partkey"], "l_suppkey")


@_query(
    rf"""WITH t AS (SELECT lang, quality, unnest({_NUMBERS.format('text')}) AS token FROM documents JOIN labels USING (doc_id)),
u AS (SELECT lang, token, count(*) AS n FROM t WHERE quality = 0 GROUP BY ALL), a AS (SELECT lang, token, count(*) AS n FROM t WHERE quality = 1 GROUP BY ALL)
SELECT lang, token, coalesce(u.n, 0) AS left_n, coalesce(a.n, 0) AS right_n FROM u FULL JOIN a USING (lang, token) WHERE coalesce(u.n, 0) <> coalesce(a.n, 0)"""
)
def number_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers that poor and good texts of a language do not hold equally often."""
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    tokens = labelled.select("lang", "quality", F.explode(T.numbers(F.col("text"))).alias("token"))
    return rules.token_differences(tokens.where("quality = 0"), tokens.where("quality = 1"), ["lang"])


@_query(
    r"""WITH f AS (SELECT doc_id, unnest(['Apache', 'Creative Commons', 'GNU']) AS name, text FROM documents),
g AS (SELECT name, doc_id, lang FROM f JOIN documents USING (doc_id) WHERE regexp_matches(f.text, '(?i)(^|[^A-Za-z])' || name || '($|[^A-Za-z])'))
SELECT name, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS locations, list_aggregate(list_distinct(list(lang)), 'count') AS n_examples FROM g GROUP BY 1"""
)
def name_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Where three names stand."""
    found = reports.name_candidates(table(spark, sf, "documents"), ["Apache", "Creative Commons", "GNU"], r"\bProfessor\s+[A-Z][A-Za-z'-]+\b", "text", ["doc_id"], "lang", examples=9)
    return found.select("name", "n", F.array_join("locations", ",").alias("locations"), F.size("examples").cast("long").alias("n_examples"))


@_query(
    r"""WITH r AS (SELECT conv_id, turn, role || CAST(turn AS VARCHAR) AS label, text FROM conversations),
j AS (SELECT a.conv_id, a.turn, a.label, string_agg(left(b.label || ': ' || coalesce(b.text, ''), 300), ' | ' ORDER BY abs(b.turn - a.turn), b.turn) AS near FROM r a JOIN r b ON a.conv_id = b.conv_id GROUP BY ALL)
SELECT conv_id, turn, left('Current region: ' || label || '. Nearby page text: ' || near, 300) AS context FROM j"""
)
def page_context(spark: SparkSession, sf: str) -> DataFrame:
    """300 characters around each turn."""
    return reports.page_context(table(spark, sf, "conversations"), "conv_id", "turn", F.concat("role", F.col("turn").cast("string")), "text")


@_query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g'), '_+', '_', 'g'), '._') AS slug FROM pages""")
def slugs(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses as file names."""
    return table(spark, sf, "pages").select("page_id", T.slug(F.col("url")).alias("slug"))


@_query(
    r"""WITH s AS (SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS slug FROM pages) SELECT slug, count(*) AS n FROM s GROUP BY 1 HAVING count(*) > 1"""
)
def repeated_slugs(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts with several pages."""
    hosts = table(spark, sf, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("slug"))
    return reports.duplicates(hosts, ["slug"])


@_query(
    r"""SELECT page_id, replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS title FROM pages"""
)
def escaped_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Page titles, escaped."""
    return table(spark, sf, "pages").select("page_id", T.html_escaped(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@_query("SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1")
def content_hashes(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of texts, how often each occurs, and first where."""
    return table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@_query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def status_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by status."""
    return reports.histogram(table(spark, sf, "orders"), "o_orderstatus")


@_query(
    r"""SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') AS match_key,
  concat_ws(',', CASE WHEN text = '' THEN 'empty' END, CASE WHEN contains(lower(text), 'license') THEN 'license' END, CASE WHEN len(regexp_extract_all(text, '(?m)^\s*\d+\.\s+')) > 0 THEN 'list' END, CASE WHEN lang <> 'en' THEN 'foreign' END) AS flags FROM documents"""
)
def rule_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Match key and flags of each document."""
    text = F.col("text")
    found = rules.flags({"empty": text == "", "license": F.contains(F.lower(text), F.lit("license")), "list": T.numbered_items(text) > 0, "foreign": F.col("lang") != "en"})
    return table(spark, sf, "documents").select("doc_id", T.match_key(text).alias("match_key"), F.array_join(found, ",").alias("flags"))


@_query(
    """WITH c AS (SELECT 'order has customer' AS name, count(*) AS failures FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'line has order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'one order a key', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'parts have one supplier', count(*) FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1))
SELECT name, failures = 0 AS passed, failures FROM c"""
)
def program_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Named checks over the orders."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return reports.checks(
        spark,
        {
            "order has customer": orders.join(table(spark, sf, "customer"), orders["o_custkey"] == F.col("c_custkey"), "left_anti"),
            "line has order": lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "left_anti"),
            "one order a key": reports.duplicates(orders, ["o_orderkey"]),
            "parts have one supplier": validate.functional_dependency(lines, ["l_partkey"], "l_suppkey"),
        },
    )


@_query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""
)
def json_properties(spark: SparkSession, sf: str) -> DataFrame:
    """A field of each event's JSON."""
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@_query()
def similarity_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Questions against the answers that follow: text similarity, numbers, and whether they need review."""
    turns = table(spark, sf, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("primary_content"))
    given = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("verifier_content"), F.lit(None).cast("string").alias("verifier_error"))
    found = rules.verifier_comparison(asked.join(given, ["conv_id", "turn"]))
    return found.select("conv_id", "turn", "text_similarity", "needs_review")


@_query()
def region_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of an order as regions, mapped onto markup made of the parts' names and the lines' boxes."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"))
    lines = table(spark, sf, "lineitem").withColumn("id", number.cast("long"))
    named = lines.join(parts, "l_partkey").select(F.col("l_orderkey").alias("page"), "id", "p_name")
    marked = named.join(_boxes(spark, sf), ["page", "id"])
    box = F.concat(F.lit("[["), F.array_join(F.transform("box", lambda x: x.cast("long").cast("string")), ","), F.lit("]]"))
    piece = F.concat(F.lit("<|ref|>"), "p_name", F.lit("<|/ref|><|det|>"), box, F.lit("<|/det|>"))
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", piece.alias("t")))), lambda x: x["t"]), "\n")
    layouts = marked.groupBy("page").agg(content.alias("content")).select(F.col("page").cast("int").alias("page"), "content")
    regions = named.select(F.col("page").cast("int").alias("page"), F.col("id").alias("pos"), F.col("id").cast("string").alias("id"), F.lit("other").alias("type"), F.col("p_name").alias("source_text"), F.col("p_name").alias("final_translation"), F.lit("saved_page_translation").alias("translation_source"))
    return placement.map_regions(regions, layouts)


# Model answers: JSON is built from the tables, read back by the operators.
# Rows are exploded with the empty ones, which go afterwards: otherwise Spark works out
# the whole answer again in the filters that it puts before, once for each of them.


def _answers(rows: DataFrame, by: str, item, field: str, more: dict | None = None) -> DataFrame:
    """An answer for each group: a JSON object between other words."""
    body = F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias(field), *[v.alias(k) for k, v in (more or {}).items()]))
    content = F.concat(F.lit("Here {it} is: "), body, F.lit(" - done"))
    return answers.with_objects(rows.groupBy(by).agg(content.alias("content")), found=F.col("content"))


@_query(
    """SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS id, lower(l_returnflag) AS type, l_linestatus AS source_text, count(*) AS n FROM lineitem GROUP BY ALL"""
)
def study_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Regions of each order's reading: numbers as texts, blanks cut, types in lower case."""
    item = F.struct(F.col("l_partkey").alias("id"), F.concat(F.lit(" "), "l_returnflag").alias("type"), F.concat("l_linestatus", F.lit("\n")).alias("source_text"))
    read = _answers(table(spark, sf, "lineitem"), "l_orderkey", item, "regions").select("l_orderkey", answers.study(F.col("found")).alias("a"))
    rows = read.select("l_orderkey", F.explode_outer("a.regions").alias("r")).where("r IS NOT NULL").select("l_orderkey", "r.id", "r.type", "r.source_text")
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@_query(
    """SELECT l_orderkey, CAST(l_linenumber % 3 AS VARCHAR) AS id, CAST(max(l_linenumber) AS VARCHAR) AS translation FROM lineitem GROUP BY l_orderkey, l_linenumber % 3"""
)
def translation_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Of several texts of an id the last one holds."""
    item = F.struct(F.col("l_linenumber").alias("at"), (F.col("l_linenumber") % 3).cast("string").alias("id"), F.col("l_linenumber").cast("string").alias("translation"))
    read = _answers(table(spark, sf, "lineitem"), "l_orderkey", item, "translations").select("l_orderkey", answers.translations(F.col("found")).alias("a"))
    return read.select("l_orderkey", F.explode_outer("a.translations").alias("id", "translation")).where("id IS NOT NULL")


_ISSUE_SQL = """WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_linenumber % 3 AS VARCHAR) AS id, CASE WHEN l_suppkey % 7 = 0 THEN 'odd' WHEN l_suppkey % 2 = 0 THEN 'name' ELSE 'number' END AS category FROM lineitem)"""


@_query(
    _ISSUE_SQL + """, e AS (SELECT l_orderkey FROM i GROUP BY 1 HAVING bool_or(category = 'odd')),
f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, id, category ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM i WHERE l_orderkey NOT IN (SELECT l_orderkey FROM e))
SELECT l_orderkey, CAST(NULL AS VARCHAR) AS error, id, category, CAST(l_partkey AS VARCHAR) AS explanation FROM f WHERE r = 1
UNION ALL SELECT l_orderkey, 'invalid_translation_verifier_json: Translation verifier returned invalid category: odd', NULL, NULL, NULL FROM e"""
)
def verifier_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Issues of each order's verifier: the first of each id and category, or why the answer is refused."""
    category = F.when(F.col("l_suppkey") % 7 == 0, "odd").when(F.col("l_suppkey") % 2 == 0, "name").otherwise("number")
    item = F.struct(F.col("l_linenumber").alias("a"), F.col("l_partkey").alias("b"), F.col("l_suppkey").alias("c"), (F.col("l_linenumber") % 3).cast("string").alias("id"), category.alias("category"), F.col("l_partkey").cast("string").alias("explanation"))
    read = _answers(table(spark, sf, "lineitem"), "l_orderkey", item, "issues")
    call = F.struct("content", F.lit(None).cast("string").alias("error"))
    read = read.select("l_orderkey", answers.translation_comparison(call, F.col("found"), F.array(*map(F.lit, "012"))).alias("a"))
    return read.select("l_orderkey", "a.error", F.explode_outer("a.issues").alias("i")).select("l_orderkey", "error", "i.id", "i.category", "i.explanation")


@_query(
    """WITH d AS (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos, source FROM documents), i AS (SELECT source, pos, doc_id FROM d WHERE pos <= 40)
SELECT source, CAST(doc_id % 10 AS INT) AS page, CAST(min(pos) AS VARCHAR) AS reason FROM i GROUP BY source, doc_id % 10"""
)
def chapter_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Issues of a source's first documents: the first of each page, id and category."""
    pos = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    rows = table(spark, sf, "documents").select("source", "doc_id", pos.alias("pos")).where("pos <= 40")
    page = F.col("doc_id") % 10
    item = F.struct("pos", page.cast("string").alias("page"), F.lit("a").alias("id"), F.lit("name").alias("category"), F.col("pos").cast("string").alias("reason"))
    read = _answers(rows, "source", item, "issues", {"global_consistency": F.array().cast("array<string>")})
    known = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda p: F.struct(p.alias("page"), F.lit("a").alias("id")))
    read = read.select("source", answers.chapter_review(F.col("found"), known).alias("a"))
    return read.select("source", F.explode_outer("a.issues").alias("i")).where("i IS NOT NULL").select("source", "i.page", "i.reason")


@_query(
    """WITH l AS (SELECT l_orderkey AS page, CAST(l_linenumber AS VARCHAR) AS id, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS r, l_returnflag AS t, l_quantity FROM lineitem)
SELECT page, id, t AS original_translation, CASE WHEN l_quantity > 40 THEN 'new ' || t ELSE t END AS translation, CASE WHEN l_quantity > 40 THEN 'replace' WHEN l_quantity > 30 THEN 'discard' END AS decision FROM l WHERE r = 1"""
)
def chapter_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a chapter's decisions: large ones replaced, middle ones kept on purpose."""
    first = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity"))
    lines = table(spark, sf, "lineitem").withColumn("r", first).where("r = 1").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("string").alias("id"), F.col("l_returnflag").alias("translation"), "l_quantity")
    large = F.col("l_quantity") > 40
    none = F.lit("").alias
    decisions = lines.where("l_quantity > 30").select("page", "id", F.when(large, "replace").otherwise("discard").alias("decision"), F.when(large, F.concat(F.lit("new "), "translation")).otherwise(F.col("translation")).alias("final_translation"), none("reason"), none("confidence"), none("child_note"))
    out, _ = book.adjudicated(lines.drop("l_quantity"), decisions, spark.createDataFrame([], "page long, id string"))
    return out.select("page", "id", "original_translation", "translation", "adjudication.decision")


@_query(
    """WITH t AS (SELECT o_custkey % 50 AS task, o_orderkey AS page, o_totalprice FROM orders), v AS (
  SELECT page, CASE WHEN page % 11 = 0 THEN 'no review' WHEN page % 13 = 0 THEN 'plan changed' WHEN page % 17 = 0 THEN 'open human review' END AS violation FROM t)
SELECT page, violation FROM v WHERE violation IS NOT NULL"""
)
def review_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as planned pages: those whose review is missing or may not be merged."""
    orders = table(spark, sf, "orders").select((F.col("o_custkey") % 50).cast("string").alias("task_id"), F.col("o_orderkey").alias("page"))
    ids = F.array(F.lit("a"))
    pages = orders.select("page", F.lit("study").alias("mode"), F.lit("h").alias("sha256"), ids.alias("region_ids"))
    human = F.when(F.col("page") % 17 == 0, F.array(F.struct(F.lit("a").alias("id")))).otherwise(F.array().cast("array<struct<id:string>>"))
    plan = F.when(F.col("page") % 13 == 0, "old").otherwise("p")
    reviews = orders.where("page % 11 <> 0").select("page", "task_id", F.lit(5).alias("schema_version"), F.col("task_id").alias("thread_id"), plan.alias("plan_sha256"), F.lit("h").alias("page_sha256"), ids.alias("region_ids"), human.alias("human_review"))
    return book.reviewed_pages(orders, pages, reviews, "p")


@_query(
    """WITH r AS (SELECT d.doc_id AS id, CASE WHEN toxic = 1 THEN 'human_override' WHEN quality = 0 THEN 'codex_adjudication' ELSE 'saved_page_translation' END AS translation_source, lang FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT translation_source, count(*) AS n FROM r GROUP BY 1"""
)
def final_sources(spark: SparkSession, sf: str) -> DataFrame:
    """How many final texts come from people, reviews and the saved pages."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    named = docs.join(labels, "doc_id", "left")
    review = F.when(F.col("quality") == 0, F.struct(F.lit("replace").alias("decision"), F.lit("r").alias("reason"), F.lit("high").alias("confidence"), F.lit("").alias("child_note")))
    regions = named.select(F.lit(1).alias("page"), F.col("doc_id").alias("id"), F.lit("other").alias("type"), F.lit("").alias("source_text"), F.col("lang").alias("translation"), review.alias("adjudication"))
    people = named.where("toxic = 1").select(F.lit(1).alias("page"), F.col("doc_id").alias("id"), F.lit("mine").alias("final_translation"), F.lit("").alias("reason"))
    _, counts = book.final_snapshot(regions, people)
    return counts.select(F.explode("translation_source_counts").alias("translation_source", "n"))


@_query(
    r"""WITH k AS (SELECT item_id % 20 AS page, item_id, regexp_replace(trim(text), '\s+', ' ', 'g') AS key FROM (SELECT item_id, text FROM benchmark UNION ALL SELECT item_id + 1000000, '  ' || replace(text, ' ', '   ') FROM benchmark WHERE item_id % 3 = 0))
SELECT count(*) AS n, arg_min(page, (page, item_id)) AS first_page FROM k GROUP BY lower(key) HAVING count(*) > 1"""
)
def repeated_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that occur again with other blanks."""
    items = table(spark, sf, "benchmark")
    again = items.where("item_id % 3 = 0").select((F.col("item_id") + 1000000).alias("item_id"), F.concat(F.lit("  "), F.replace("text", F.lit(" "), F.lit("   "))).alias("text"))
    regions = items.unionByName(again).select((F.col("item_id") % 20).alias("page"), F.col("item_id").alias("pos"), F.col("item_id").cast("string").alias("id"), F.col("text").alias("source_text"), F.lit("t").alias("translation"))
    return book.repeated_texts(regions).select("n", "first_page")


def _mappings(spark: SparkSession, sf: str) -> DataFrame:
    rows = _boxes(spark, sf).withColumnRenamed("box", "placement_box")
    coverage = (F.col("page") * 7 + F.col("id") * 13) % 101 / 100
    warned = F.when((F.col("page") + F.col("id")) % 3 == 0, F.array(F.lit("ambiguous_layout_candidates"))).otherwise(F.array().cast("array<string>"))
    placed = F.when((F.col("page") + F.col("id")) % 10 != 0, F.col("placement_box"))
    kind = F.when(F.col("id") % 2 == 0, "dialogue").otherwise("definition")
    rows = rows.select("page", F.col("id").cast("string").alias("id"), kind.alias("type"), F.lit("x").alias("final_translation"), placed.alias("placement_box"), coverage.alias("match_coverage"), warned.alias("warnings"))
    return rows.withColumn("confidence", rules.confidence(F.col("match_coverage"), F.col("placement_box").isNotNull())).withColumn("layout_item_indexes", F.array((F.length("id")).cast("int")))


_MAPPINGS = f"""b AS ({_BOXES}), m AS (SELECT page, id, box, (page * 7 + id * 13) % 101 / 100.0 AS c, (page + id) % 3 = 0 AS warned, (page + id) % 10 <> 0 AS placed, id % 2 = 0 AS speech, page % 50 = 0 AS skip, page % 50 = 1 AS force FROM b)"""


@_query(
    f"""WITH {_MAPPINGS}, w AS (SELECT *, CASE WHEN skip THEN 'skipped_by_override' WHEN NOT placed THEN 'unmatched_skipped' WHEN NOT force AND c < 0.65 THEN 'skipped_low_confidence' WHEN NOT force AND warned AND c < 0.9 THEN 'skipped_ambiguous_mapping' ELSE 'written' END AS status FROM m)
SELECT page, CAST(id AS VARCHAR) AS id, status, CASE WHEN status = 'written' THEN CAST(CASE WHEN force THEN 20 WHEN speech THEN 11 ELSE 10 END AS DOUBLE) END AS font_size, CASE WHEN status = 'written' THEN CASE WHEN speech THEN 'center' ELSE 'left' END END AS alignment,
  CASE WHEN status = 'written' THEN CAST(greatest(0, box[1] - 4) AS DOUBLE) END AS x1, CASE WHEN status = 'written' THEN CAST(least(1000, box[3] + 4) AS DOUBLE) END AS x2 FROM w"""
)
def written_regions(spark: SparkSession, sf: str) -> DataFrame:
    """What the writer does with each line, and where: overrides of some pages skip, or force at a size."""
    mappings = _mappings(spark, sf)
    none = lambda kind: F.lit(None).cast(kind)
    chosen = mappings.where("page % 50 IN (0, 1)")
    overrides = chosen.select("page", "id", (F.col("page") % 50 == 0).alias("skip"), (F.col("page") % 50 == 1).alias("force_write"), none("array<double>").alias("placement_box"), none("double").alias("offset_x"), none("double").alias("offset_y"), F.when(F.col("page") % 50 == 1, 20.0).alias("font_size"), none("string").alias("text_color"), none("string").alias("alignment"), none("string").alias("vertical_alignment"))
    out = book.written_regions(mappings, overrides, WRITER, WRITER["font_sizes"], WRITER["alignment_by_type"])
    return out.select("page", "id", "status", "font_size", "alignment", F.col("box")[0].alias("x1"), F.col("box")[2].alias("x2"))


@_query(
    f"""WITH {_MAPPINGS} SELECT page, count(*) AS region_count, count(*) FILTER (placed) AS mapped_count, CAST(sum(CASE WHEN warned THEN 1 ELSE 0 END) AS BIGINT) AS warning_count FROM m GROUP BY 1"""
)
def placement_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Lines placed and warnings, by page."""
    return book.placement_plan(_mappings(spark, sf))[0]


@_query(
    f"""WITH b AS ({_BOXES}), p AS (SELECT x.page, x.id AS first_id, y.id AS second_id, x.box AS a, y.box AS b FROM b x JOIN b y ON x.page = y.page AND y.id = x.id + 1),
g AS (SELECT *, greatest(b[2] - a[4], a[2] - b[4], 0.0) AS down, greatest(least(a[4], b[4]) - greatest(a[2], b[2]), 0.0) AS common, greatest(1, a[3] - a[1]) AS wa, greatest(1, b[3] - b[1]) AS wb, greatest(1, a[4] - a[2]) AS ha, greatest(1, b[4] - b[2]) AS hb,
  greatest(least(a[3], b[3]) - greatest(a[1], b[1]), 0.0) AS across, abs((a[1] + a[3]) - (b[1] + b[3])) / 2 AS drift FROM p)
SELECT page, first_id, second_id, CAST(down AS DOUBLE) AS down, CAST(common AS DOUBLE) AS common, down <= greatest(2, least(ha, hb) * 0.20 + 2) AND drift <= greatest(12, greatest(wa, wb) * 0.55) AND NOT (common >= 0.55 * least(ha, hb) AND across < 0.35 * least(wa, wb)) AS one_block,
  CAST(least(greatest(a[1], 0), 700) AS DOUBLE) AS clamped_x, a[1] / CAST(1000 AS DOUBLE) * 540 AS on_page_x, CAST(greatest(0, a[2] - 3) AS DOUBLE) AS padded_y FROM g"""
)
def box_measures(spark: SparkSession, sf: str) -> DataFrame:
    """Gap, common height, and one block or not, of neighbouring boxes; the first one clamped, on a page, and padded."""
    boxes = _boxes(spark, sf)
    pairs = boxes.select("page", F.col("id").alias("first_id"), F.col("box").alias("a")).join(boxes.select("page", F.col("id").alias("second_id"), (F.col("id") - 1).alias("first_id"), F.col("box").alias("b")), ["page", "first_id"])
    a, b = F.col("a"), F.col("b")
    on_page = G.to_points(a, F.lit(540.0), F.lit(700.0))
    return pairs.select("page", "first_id", "second_id", G.gap(a[1], a[3], b[1], b[3]).alias("down"), G.shared(a[1], a[3], b[1], b[3]).alias("common"), G.same_block(a, b).alias("one_block"), G.clamped(a, F.lit(700.0), F.lit(700.0))[0].alias("clamped_x"), on_page[0].alias("on_page_x"), G.padded(a, [3.0, 3.0, 3.0, 3.0])[1].alias("padded_y"))


@_query(
    """WITH c AS (SELECT p_partkey, CAST(p_partkey * 7919 % 256 AS INT) AS r, CAST(p_partkey * 104729 % 256 AS INT) AS g, CAST(p_size * 5 % 256 AS INT) AS b FROM part)
SELECT p_partkey, printf('#%02X%02X%02X', r, g, b) AS code, round(CAST(0.2126 AS DOUBLE) * r + CAST(0.7152 AS DOUBLE) * g + CAST(0.0722 AS DOUBLE) * b, 6) AS luminance FROM c"""
)
def colours(spark: SparkSession, sf: str) -> DataFrame:
    """Colour codes read, written again, and their luminance."""
    parts = [F.col("p_partkey") * 7919 % 256, F.col("p_partkey") * 104729 % 256, F.col("p_size") * 5 % 256]
    code = F.format_string("#%02x%02x%02x", *[p.cast("int") for p in parts])
    rows = table(spark, sf, "part").select("p_partkey", T.colour_parts(code).alias("c"))
    return rows.select("p_partkey", T.colour_code(F.col("c")).alias("code"), F.round(T.luminance(F.col("c")), 6).alias("luminance"))


@_query(
    """SELECT CAST(doc_id AS VARCHAR) AS name, CASE WHEN doc_id % 10 = 0 THEN 'missing' WHEN doc_id % 7 = 0 THEN 'changed' WHEN doc_id % 5 = 1 THEN 'bad digest' END AS violation FROM documents WHERE doc_id % 10 = 0 OR doc_id % 7 = 0 OR doc_id % 5 = 1"""
)
def changed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as files: listed ones that are gone, that changed, or whose digest is none."""
    docs = table(spark, sf, "documents").select(F.col("doc_id"), F.col("doc_id").cast("string").alias("name"), F.sha2(F.col("text"), 256).alias("sha256"))
    digest = F.when((F.col("doc_id") % 7 == 0) | (F.col("doc_id") % 10 == 0), F.sha2("name", 256)).when(F.col("doc_id") % 5 == 1, F.upper(F.concat(F.lit("x"), "sha256"))).otherwise(F.col("sha256"))
    return validate.changed_files(docs.where("doc_id % 10 <> 0").select("name", "sha256"), docs.select("name", digest.alias("sha256")))


@_query(
    r"""SELECT conv_id, turn, regexp_replace(text, '\r\n?', chr(10), 'g') AS text, role || ': ' || text AS said FROM conversations"""
)
def payload_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts out of the two kinds of payloads that providers send."""
    part = lambda c: F.struct(F.lit("text").alias("type"), c.alias("text"))
    said = F.concat("role", F.lit(": "), "text")
    chat = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(part(F.concat("role", F.lit(": "))), part(F.col("text"))).alias("content")).alias("message"))).alias("choices")))
    answer = F.to_json(F.struct(F.array(F.struct(F.lit("message").alias("type"), F.array(part(F.col("text"))).alias("content"))).alias("output")))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", T.unified_newlines(T.response_text(answer)).alias("text"), T.chat_text(chat).alias("said"), said.alias("want"))
    return rows.drop("want")


@_query(
    """SELECT o_orderkey AS page FROM orders WHERE o_orderkey % 4 = 1 OR o_orderkey % 9 = 0"""
)
def size_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as pages: those whose sizes differ, or that one side lacks."""
    pages = table(spark, sf, "orders").select(F.col("o_orderkey").alias("page"), F.col("o_totalprice").alias("width"), F.lit(1.0).alias("height"))
    moved = pages.where("page % 9 <> 0").withColumn("width", F.col("width") + F.when(F.col("page") % 4 == 1, 1.0).otherwise(0.001 * 0))
    return reports.size_mismatches(pages, moved)


@_query(
    """SELECT page_id % 97 AS page, '<section id="' || page_id || '">' AS opening, count(*) AS n FROM pages GROUP BY ALL"""
)
def region_cards(spark: SparkSession, sf: str) -> DataFrame:
    """Cards of pages: how each begins."""
    rows = table(spark, sf, "pages").select((F.col("page_id") % 97).alias("page"), F.col("page_id").alias("pos"), F.col("page_id").cast("string").alias("id"), F.col("url").alias("source_text"), F.lit("<b>").alias("translation"))
    issues = rows.where("pos % 2 = 0").select("page", "id", F.lit("why & what").alias("explanation"))
    cards = sinks.region_cards(rows, issues)
    opened = cards.select("page", F.explode(F.regexp_extract_all("html", F.lit('<section id="[^"]*">'), F.lit(0))).alias("opening"))
    return opened.groupBy("page", "opening").agg(F.count("*").alias("n"))


@_query(
    """WITH c AS (SELECT o_orderkey AS page, 1 + (o_orderkey % 3) AS n FROM orders)
SELECT page, n, CASE WHEN n = 0 THEN NULL ELSE 'f1' END AS path FROM c"""
)
def cleaned_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Files found for each wanted page, and the first one."""
    wanted = table(spark, sf, "orders").select(F.col("o_orderkey").cast("int").alias("page"))
    files = wanted.select("page", F.explode(F.sequence(F.lit(1), (1 + F.col("page") % 3).cast("int"))).alias("k"))
    files = files.select(F.concat(F.lit("page-"), F.lpad(F.col("page").cast("string"), 7, "0"), F.lit("-clean.png")).alias("name"), F.concat(F.lit("f"), F.col("k").cast("string")).alias("path"))
    return scans.cleaned_pages(files, wanted).select(F.col("page").cast("long").alias("page"), "n", "path")


@_query(
    """WITH r AS (SELECT c_custkey AS book, c_custkey * 100 AS first, c_custkey * 100 + 1 + c_nationkey AS last FROM customer)
SELECT CAST(book AS VARCHAR) AS task_id, unnest(range(first, last + 1)) AS page FROM r"""
)
def page_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Every page of every task."""
    first = (F.col("c_custkey") * 100).cast("long")
    tasks = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("task_id"), first.alias("pdf_start_page"), (first + 1 + F.col("c_nationkey")).alias("pdf_end_page"))
    return ranges.page_tasks(tasks)


@_query(
    """SELECT o_orderkey AS page, CASE WHEN o_orderkey % 10 = 3 THEN 'missing translations' ELSE 'not a study page' END AS violation FROM orders WHERE o_orderkey % 10 = 3 OR o_orderkey % 4 = 0"""
)
def refused_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as pages that can't be verified again."""
    text = F.when(F.col("o_orderkey") % 10 == 3, "").otherwise("t")
    study = F.struct(F.array(F.struct(F.lit("a").alias("id"), text.alias("translation"))).alias("regions"))
    mode = F.when(F.col("o_orderkey") % 4 == 0, "exact").otherwise("study")
    records = table(spark, sf, "orders").select(F.col("o_orderkey").alias("page"), mode.alias("mode"), study.alias("study"), F.struct(F.lit("{}").alias("content")).alias("primary"))
    return book.refused_again(records, True)
