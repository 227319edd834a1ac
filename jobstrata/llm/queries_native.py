"""Queries of the operators that are DataFrame operations throughout, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.catalog.registry import table
from jobstrata.llm.exact_copies import exact_copies
from jobstrata.llm.mixing import mixed, timetable, whole_parts
from jobstrata.llm.registry import corpus_query
from jobstrata.llm.url_lists import judged, url_host

# ---- op1: the pages table has no fetch times and no lists, so both are derived from it:
# a page's fetch day from its id, and dated list entries from the hash of each host.

FIRST_DAY = "2024-01-01"


def captures(pages: DataFrame) -> DataFrame:
    day = (F.col("page_id") * 37 % 366).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit(FIRST_DAY), day).alias("fetched"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Hosts blocked for a while and again later, subdomains allowed, parent domains blocked."""
    hosts = pages.select(url_host(F.col("url")).alias("host")).where("host <> ''").distinct()
    hashed = hosts.withColumn("x", F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("int"))
    parent = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)

    def record(kind: str, entry, action: str, day):
        return F.struct(
            F.lit(kind).alias("list"),
            entry.alias("entry"),
            F.lit(action).alias("action"),
            F.date_add(F.lit(FIRST_DAY), day).alias("at"),
        )

    x = F.col("x")
    start = (x % 200).cast("int")
    blocks = F.array(
        record("block", F.col("host"), "add", start),
        record("block", F.col("host"), "remove", start + 60),
        record("block", F.col("host"), "add", start + 150),
    )
    allows = F.array(record("allow", F.col("host"), "add", (x % 300).cast("int")))
    parents = F.array(
        record("block", parent, "add", F.length(parent) * 10),
        record("block", parent, "remove", F.length(parent) * 10 + 90),
    )
    none = F.filter(blocks, lambda r: F.lit(False))
    log = F.concat(
        F.when(x % 4 == 0, blocks).otherwise(none),
        F.when(x % 10 == 3, allows).otherwise(none),
        F.when((x % 7 == 0) & (parent != ""), parents).otherwise(none),
    )
    return hashed.select(F.explode(log).alias("r")).select("r.*").distinct()


OP1_SQL = """
WITH seen AS (
  SELECT DISTINCT page_id,
    lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z]+://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    CAST(DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS DATE) AS fetched
  FROM pages),
hosts AS (
  SELECT host, CAST('0x' || substr(md5(host), 1, 6) AS INTEGER) AS x,
    regexp_extract(host, '([^.]+\\.[^.]+)$', 1) AS parent
  FROM (SELECT DISTINCT host FROM seen WHERE host <> '')),
log AS (
  SELECT DISTINCT list, entry, action, CAST(DATE '2024-01-01' + CAST(d AS INTEGER) AS DATE) AS day FROM (
    SELECT 'block' AS list, host AS entry, 'add' AS action, x % 200 AS d FROM hosts WHERE x % 4 = 0
    UNION ALL SELECT 'block', host, 'remove', x % 200 + 60 FROM hosts WHERE x % 4 = 0
    UNION ALL SELECT 'block', host, 'add', x % 200 + 150 FROM hosts WHERE x % 4 = 0
    UNION ALL SELECT 'allow', host, 'add', x % 300 FROM hosts WHERE x % 10 = 3
    UNION ALL SELECT 'block', parent, 'add', length(parent) * 10 FROM hosts
      WHERE x % 7 = 0 AND parent <> ''
    UNION ALL SELECT 'block', parent, 'remove', length(parent) * 10 + 90 FROM hosts
      WHERE x % 7 = 0 AND parent <> '')),
settled AS (SELECT list, entry, day, max(action) AS action FROM log GROUP BY ALL),
spans AS (
  SELECT list, entry, action, day AS valid_from,
    lead(day) OVER (PARTITION BY list, entry ORDER BY day) AS valid_to
  FROM settled),
names AS (
  SELECT s.page_id, s.host, s.fetched, sp.list, sp.entry
  FROM seen s JOIN spans sp
    ON (s.host = sp.entry OR ends_with(s.host, '.' || sp.entry))
   AND sp.action = 'add'
   AND s.fetched >= sp.valid_from AND (sp.valid_to IS NULL OR s.fetched < sp.valid_to)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY page_id
    ORDER BY length(entry) DESC, (list = 'allow') DESC) AS r FROM names),
best AS (SELECT page_id, list, entry FROM ranked WHERE r = 1),
counts AS (
  SELECT page_id, count(*) FILTER (list = 'allow') AS n_allow,
    count(*) FILTER (list = 'block') AS n_block FROM names GROUP BY 1)
SELECT s.page_id, s.host, s.fetched, coalesce(c.n_allow, 0) AS n_allow,
  coalesce(c.n_block, 0) AS n_block, b.entry, coalesce(b.list, 'pass') AS verdict
FROM seen s LEFT JOIN counts c USING (page_id) LEFT JOIN best b USING (page_id)
"""


@corpus_query(OP1_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judged(captures(pages), list_entries(pages))


# ---- op6: target weights of the twenty sources: two that are wanted most, a middle, a tail.

TARGETS = {
    f"src{i}": 0.12 if i in (1, 2) else 0.06 if i in (0, 3, 4, 5, 6, 7) else 0.025
    for i in range(20)
}
BLOCK = 16
_parts = whole_parts(TARGETS)
_nth: dict[str, int] = {}
_rows = []
for _slot, _source in enumerate(timetable(_parts)):
    _rows.append(f"('{_source}', {_nth.get(_source, 0)}, {_slot}, {_parts[_source]})")
    _nth[_source] = _nth.get(_source, 0) + 1

OP6_SQL = f"""
WITH slots(source, nth, slot, parts) AS (VALUES {", ".join(_rows)}),
placed AS (
  SELECT doc_id, coalesce(source, '') AS source, row_number() OVER (
    PARTITION BY coalesce(source, '') ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS place
  FROM documents),
blocks AS (SELECT *, place // {BLOCK} AS mix_block, place % {BLOCK} AS mix_place FROM placed)
SELECT b.doc_id, b.source, b.mix_block, b.mix_place,
  (b.mix_block // s.parts) * {sum(_parts.values())} + s.slot AS mix_slot
FROM blocks b LEFT JOIN slots s ON s.source = b.source AND s.nth = b.mix_block % s.parts
"""


@corpus_query(OP6_SQL)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixed(docs, TARGETS, BLOCK)


# ---- op8

OP8_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (
      PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id NULLS LAST) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256, n_points FROM g
"""


@corpus_query(OP8_SQL)
def op8_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(table(spark, sf_dir, "documents"), digest_all=True)
