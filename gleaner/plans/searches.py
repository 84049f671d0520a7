"""Registered queries that look for many texts, names or items at once, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import scalars as X
from gleaner.operators import keyword_tables, names, page_search, reach
from gleaner.operators import same_items as same
from gleaner.plans.reports import SKIPPED_SQL, load, query
from gleaner.sources.tables import bounded_pages, shared_folder, snapshot

PARTS_SQL = """CASE CAST(o_orderkey % 8 AS INTEGER) WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN ' ' || upper(c_name) WHEN 2 THEN right(c_name, 5) WHEN 3 THEN 'R#' || substr(c_name, 10, 7) WHEN 4 THEN lower(substr(c_name, 1, 16)) || ' '
 WHEN 5 THEN 'er%0' || right(c_name, 3) WHEN 6 THEN right(c_name, 2) ELSE '___' || right(c_name, 4) || substr('00000000000000000000', 1, CAST(o_orderkey % 24 AS INTEGER)) END"""


@query(f"""WITH w AS (SELECT DISTINCT {PARTS_SQL} AS wanted, CASE WHEN o_orderkey % 3 = 0 THEN c_nationkey END AS site FROM orders JOIN customer ON o_custkey = c_custkey), t AS (SELECT wanted, site, trim(wanted) AS v FROM w WHERE trim(wanted) <> ''),
 m AS (SELECT wanted, site, c_custkey AS id, CASE WHEN regexp_full_match(v, '[0-9]+') THEN CASE WHEN TRY_CAST(v AS BIGINT) = c_custkey THEN 0 END WHEN site IS NOT NULL AND site <> c_nationkey THEN NULL WHEN c_name ILIKE v THEN 1 WHEN c_name ILIKE '%' || v || '%' THEN 2 END AS tier FROM t CROSS JOIN customer)
 SELECT wanted, site, CAST(min(tier) AS INTEGER) AS tier, arg_min(id, tier * 1000000000000 + id) AS id FROM m WHERE tier IS NOT NULL GROUP BY wanted, site""")
def resolve_parts(spark: SparkSession, d: str) -> DataFrame:
    """P6-P8, P10, in bulk: the customers that are meant by all orders' texts: ids, whole names, beginnings, ends and middles of
    them, with wildcards, of any site or of one."""
    o, c = load(spark, d, "orders", "customer")
    k, name = (F.col("o_orderkey") % 8).cast("int"), F.col("c_name")
    zeros = F.left(F.lit("0" * 20), (F.col("o_orderkey") % 24).cast("int"))
    forms = [F.col("o_custkey").cast("string"), F.concat(F.lit(" "), F.upper(name)), F.right(name, F.lit(5)), F.concat(F.lit("R#"), F.substring(name, 10, 7)), F.concat(F.lower(F.substring(name, 1, 16)), F.lit(" ")), F.concat(F.lit("er%0"), F.right(name, F.lit(3))), F.right(name, F.lit(2)), F.concat(F.lit("___"), F.right(name, F.lit(4)), zeros)]
    site = F.when(F.col("o_orderkey") % 3 == 0, F.col("c_nationkey"))
    wanted = o.join(c.hint("merge"), F.col("o_custkey") == F.col("c_custkey")).select(F.get(F.array(*forms), k).alias("wanted"), site.alias("site"))
    return names.resolve_many(c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("site")), wanted)


ITEM_SQL = "p_name || ' ' || p_brand || ' (' || CAST(1980 + p_partkey % 40 AS VARCHAR) || ') ' || p_type || ' ' || CAST(p_size AS VARCHAR) || CASE WHEN p_partkey % 5 = 0 THEN ' ' || split_part(p_name, ' ', 1) ELSE '' END"
WORD_SET_SQL = r"list_sort(list_distinct(list_filter(string_split(regexp_replace(regexp_replace(lower(name), '\b(19|20)\d\d\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')))"


@query(rf"""WITH RECURSIVE i AS (SELECT p_partkey AS id, {ITEM_SQL} AS name FROM part), e AS (SELECT id, {WORD_SET_SQL} AS ws FROM i), s AS (SELECT ws, min(id) AS first_id, count(*) AS n FROM e GROUP BY ALL),
 t AS (SELECT ws, unnest(ws) AS word FROM s), v AS (SELECT word, greatest(CAST(floor(1000 * ln(((SELECT count(*) FROM s) + 1)::DOUBLE / count(*)::DOUBLE)) AS BIGINT), 1) AS w FROM t GROUP BY ALL),
 x AS (SELECT ws, sum(w)::BIGINT AS weight FROM t JOIN v USING (word) GROUP BY ALL), c AS (SELECT a.ws AS a, b.ws AS b, sum(w)::BIGINT AS common FROM t a JOIN t b USING (word) JOIN v USING (word) WHERE a.ws <> b.ws GROUP BY ALL),
 l AS MATERIALIZED (SELECT p.first_id AS a, q.first_id AS b, q.n FROM c JOIN x xa ON xa.ws = a JOIN x xb ON xb.ws = b JOIN s p ON p.ws = a JOIN s q ON q.ws = b WHERE 100 * common >= 70 * (xa.weight + xb.weight - common)),
 r AS (SELECT first_id AS a, first_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), g AS (SELECT a, min(b) AS item_id FROM r GROUP BY ALL), k AS (SELECT a, sum(n) AS n FROM l GROUP BY ALL)
 SELECT id, CAST(s.n - 1 + coalesce(k.n, 0) AS BIGINT) AS n_links, item_id FROM e JOIN s USING (ws) JOIN g ON g.a = s.first_id LEFT JOIN k ON k.a = s.first_id""")
def same_items(spark: SparkSession, d: str) -> DataFrame:
    """D8r: listings of the same item: names with brand, vintage, kind and size, some in another order of words."""
    (p,) = load(spark, d, "part")
    again = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(1)))).otherwise("")
    year = F.concat(F.lit(" ("), (1980 + F.col("p_partkey") % 40).cast("string"), F.lit(") "))
    name = F.concat("p_name", F.lit(" "), "p_brand", year, "p_type", F.lit(" "), F.col("p_size").cast("string"), again)
    return same.same_items(p.select(F.col("p_partkey").alias("id"), name.alias("name")))


@query(rf"""WITH RECURSIVE p AS (SELECT page_id, html, 'https://h' || page_id // 40 || '.example.org' AS host FROM pages), a AS (SELECT page_id, host, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href FROM p),
 n AS (SELECT page_id, regexp_replace(regexp_replace(href, '[;?#].*$', ''), '(.)/$', '\1') AS path FROM a WHERE starts_with(href, '/') AND NOT regexp_matches(host || href, '{SKIPPED_SQL}')),
 l AS MATERIALIZED (SELECT DISTINCT n.page_id AS src, p.page_id AS dst FROM n JOIN p ON p.page_id = n.page_id // 40 * 40 + (7 * length(path) + 3 * instr(path, 'e') + n.page_id) % 40 WHERE p.page_id <> n.page_id),
 r AS (SELECT page_id AS site, page_id AS page, 0 AS step FROM p WHERE page_id % 10 = 0 UNION SELECT r.site, l.dst, r.step + 1 FROM r JOIN l ON r.page = l.src WHERE r.step < 4)
 SELECT site, page, CAST(min(step) AS INTEGER) AS step FROM r GROUP BY ALL""")
def reached_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages that sites reach in up to four steps; 40 pages are a host, every tenth page is where a site starts. As links
    of the fixture lead to none of its pages, a rule of both ends sends each to a page of its host."""
    bounded_pages(spark)
    (p,) = load(spark, d, "pages")
    own = p.select("page_id", "html", F.concat(F.lit("https://h"), F.floor(F.col("page_id") / 40).cast("string"), F.lit(".example.org/"), F.col("page_id").cast("string")).alias("url"))
    split = lambda c: F.regexp_extract(c, "^https://[^/]*(/.*)$", 1)
    found = reach.page_links(own).select(F.substring(split("src"), 2, 20).cast("long").alias("src"), split("dst").alias("path"))
    sent = F.floor(F.col("src") / 40) * 40 + (7 * F.length("path") + 3 * F.instr("path", "e") + F.col("src")) % 40
    links = found.select("src", sent.alias("dst")).join(p.select(F.col("page_id").alias("dst")), "dst", "left_semi")
    starts = p.where("page_id % 10 = 0").select(F.col("page_id").alias("site"), F.col("page_id").alias("page"))
    return reach.reachable(links, starts)


HUB_SQL = "CASE WHEN page_id % 3 = 0 THEN url ELSE 'https://hub.binwise.com/' || CASE WHEN page_id % 3 = 1 THEN 'list/' ELSE 'print-digital-menu/' END || page_id || '?x=1' END"


@query(rf"""WITH p AS (SELECT page_id AS page, {HUB_SQL} AS url, lower(regexp_replace(html, '<[^>]*>', ' ', 'g') || CASE WHEN page_id % 5 = 0 THEN ' pdf' ELSE '' END) AS text, regexp_replace(array_to_string(regexp_extract_all(html, '(?s)<(?:title|h1|h2)>(.*?)</(?:title|h1|h2)>', 1), ' '), '<[^>]*>', ' ', 'g') AS heads, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages),
 v AS (SELECT c_custkey AS id, CASE CAST(c_custkey % 4 AS INTEGER) WHEN 0 THEN title WHEN 1 THEN split_part(title, ' ', 1) WHEN 2 THEN split_part(title, ' ', 1) || ' & ' || split_part(title, ' ', 2) ELSE split_part(title, ' ', 2) || ' ' || split_part(title, ' ', 1) END AS name FROM customer LEFT JOIN p ON page = c_custkey),
 w AS (SELECT page, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+')) AS word FROM p), k AS (SELECT page, word, count(*) AS tf FROM w GROUP BY ALL), n AS (SELECT page, sum(tf)::BIGINT AS n FROM k GROUP BY ALL), s AS (SELECT count(*) AS pages, sum(n)::BIGINT AS total FROM n), f AS (SELECT word, count(*) AS df FROM k GROUP BY ALL),
 q AS (SELECT DISTINCT name, pass, name || CASE WHEN pass = 1 THEN ' pdf' ELSE '' END AS text FROM v, (SELECT unnest([1, 2]) AS pass) x WHERE name IS NOT NULL), t AS (SELECT DISTINCT name, pass, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS word FROM q), z AS (SELECT name, pass, count(*) AS words FROM t GROUP BY ALL),
 a AS (SELECT name, pass, page, count(*) AS held, sum(CAST(floor(1000 * ln((2 * pages + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) * ((2200000 * tf) // (1000 * tf + 300 + (900 * n * pages) // total))) AS score FROM t JOIN k USING (word) JOIN f USING (word) JOIN n USING (page), s GROUP BY ALL),
 r AS (SELECT name, pass, page, row_number() OVER (PARTITION BY name, pass ORDER BY score DESC, page) AS rank FROM a JOIN z USING (name, pass) WHERE held = words), m AS (SELECT r.*, regexp_replace(url, '\?.*$', '') AS url, trim(regexp_replace(regexp_replace(lower(heads), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS heads, trim(regexp_replace(regexp_replace(lower(name), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS whole FROM r JOIN p USING (page) WHERE rank <= 5),
 g AS (SELECT *, list_filter(string_split(whole, ' '), lambda x: x <> '' AND x NOT IN ({", ".join(f"'{x}'" for x in X.STOP_WORDS)})) AS telling, list_filter(string_split(whole, ' '), lambda x: x <> '') AS every FROM m),
 b AS (SELECT name, arg_min(url, pass * 10 + rank) AS url FROM g WHERE starts_with(url, 'https://hub.binwise.com/') AND CASE WHEN len(CASE WHEN len(telling) > 0 THEN telling ELSE every END) <= 2 THEN whole <> '' AND contains(heads, whole) ELSE len(list_filter(CASE WHEN len(telling) > 0 THEN telling ELSE every END, lambda x: NOT contains(heads, x))) = 0 END GROUP BY ALL)
 SELECT id, b.url FROM v LEFT JOIN b ON v.name = b.name""")
def found_lists(spark: SparkSession, d: str) -> DataFrame:
    """The hub's page of each customer, whose name is made of the words of a page's title; two of three pages are the hub's,
    and every fifth has a document."""
    p, c = load(spark, d, "pages", "customer")
    k = (F.col("page_id") % 3).cast("int")
    hub = F.concat(F.lit("https://hub.binwise.com/"), F.when(k == 1, "list/").otherwise("print-digital-menu/"), F.col("page_id").cast("string"), F.lit("?x=1"))
    pages = p.select(F.col("page_id").alias("page"), F.when(k == 0, F.col("url")).otherwise(hub).alias("url"), "html")
    text = F.concat(page_search.visible(F.col("html")), F.when(F.col("page") % 5 == 0, " pdf").otherwise(""))
    index = snapshot(page_search.page_index(pages.select("page", text.alias("text"))), f"{shared_folder(spark)}/page-index", "zstd")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    one, two = (F.split_part(F.col("title"), F.lit(" "), F.lit(n)) for n in (1, 2))
    names = [F.col("title"), one, F.concat(one, F.lit(" & "), two), F.concat(two, F.lit(" "), one)]
    venues = c.select(F.col("c_custkey").alias("id")).join(pages.select(F.col("page").alias("id"), title.alias("title")), "id", "left")
    return page_search.find_lists(pages, index, venues.select("id", F.get(F.array(*names), (F.col("id") % 4).cast("int")).alias("name")))


@query("""WITH w AS (SELECT string_split(lower(text), ' ') AS ws FROM benchmark UNION ALL SELECT [p_name, p_brand] FROM part), i AS (SELECT ws, unnest(generate_series(1, greatest(len(ws) - 2, 1))) AS k FROM w),
 f AS (SELECT DISTINCT array_to_string(ws[k:k + 2], ' ') AS phrase FROM i), d AS (SELECT lower(text) AS text FROM documents)
 SELECT phrase, count(text) AS texts FROM f LEFT JOIN d ON contains(text, phrase) WHERE phrase <> '' GROUP BY phrase""")
def phrase_table(spark: SparkSession, d: str) -> DataFrame:
    """Every three neighbouring words of the benchmark, and all names of parts, in all documents."""
    b, p, docs = load(spark, d, "benchmark", "part", "documents")
    words = F.split(F.lower("text"), " ")
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - 2, F.lit(1)))
    runs = b.select(F.explode(F.transform(starts, lambda k: F.array_join(F.slice(words, k, F.lit(3)), " "))).alias("phrase"))
    table = runs.unionByName(p.select(F.concat_ws(" ", "p_name", "p_brand").alias("phrase")))
    return keyword_tables.phrase_counts(docs.select(F.col("doc_id").alias("id"), F.lower("text").alias("text")), table).drop("times")
