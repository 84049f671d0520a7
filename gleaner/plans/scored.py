"""Registered queries on scored links in three languages, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.functions import scalars as X
from gleaner.operators import links
from gleaner.plans.reports import load, query
from gleaner.sources.tables import bounded_pages

#: What the fixture's links say, around them, and how their urls end.
SAID = ("Wine List", "Our Menus", "carte des vins", "Carta de Vinos", "About us", "Dégustation", "menú", "Press", "Bodega & cellar", "nothing", "Catering menu", "Visit", "La Carte", "wine", "sommelier", "private-dining")
AROUND = ("see our wine list, available here", "", "Télécharger la carte", "versión actual de la carta de vinos", "plain words", "Beverage list: download")
ENDS = ("", ".pdf", "/", ".html", ".PDF")
HOSTS = ("https://hub.binwise.com/list", "https://other.example.net", "https://cdn.example.net/files")
LANGUAGES = ("en", "fr", "es")


def picked(values: tuple[str, ...], number) -> F.Column:  # noqa: ANN001
    return F.get(F.array(*map(F.lit, values)), (number % len(values)).cast("int"))


def fixture_links(spark: SparkSession, d: str) -> DataFrame:
    """A link for each anchor of the pages, with text, context, url and language by its place."""
    bounded_pages(spark)
    (p,) = load(spark, d, "pages")
    page, pos = F.col("page_id"), F.col("pos")
    found = links.anchors(p.select("page_id", "html")).select("page_id", "pos")
    text = picked(SAID, 7 * page + 3 * pos)
    own = F.concat(F.lit("https://site"), (page % 50).cast("string"), F.lit(".example.org"))
    path = F.concat(F.lit("/"), F.replace(F.replace(F.lower(text), F.lit(" & "), F.lit("-")), F.lit(" "), F.lit("-")), picked(ENDS, page + 2 * pos))
    internal = pos % 2 == 0
    rows = found.select("page_id", "pos", picked(LANGUAGES, page).alias("lang"), text.alias("text"), F.lower(picked(AROUND, page + pos)).alias("context"), path.alias("href"), internal.alias("internal"), F.when(internal, own).otherwise(picked(HOSTS, page)).alias("root"))
    rows = rows.withColumn("abs_url", F.concat("root", "href"))
    return rows.withColumns({"link": X.normalize_url(F.col("abs_url")), "host": X.domain(F.col("abs_url"))})


def listed(values: tuple[str, ...] | list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def keyword_rows(names: tuple[str, ...]) -> str:
    rows = []
    for name in names:
        for language in LANGUAGES:
            words = links.keywords(name, language)
            rows += [f"('{name}', '{language}', '{w.replace("'", "''")}', {len(words) - r})" for r, w in enumerate(words)]
    return ", ".join(rows)


def sum_of(name: str, equal: int, within: int, in_href: int) -> str:
    return f"sum(w * (CASE WHEN t = k THEN {equal} WHEN contains(t, k) THEN {within} ELSE 0 END + CASE WHEN contains(h, replace(k, ' ', '-')) THEN {in_href} ELSE 0 END)) FILTER (name = '{name}') AS {name}"


LINK_SQL = rf"""p AS (SELECT page_id, unnest(range(len(regexp_extract_all(html, '<a href="[^"]*">')))) AS pos FROM pages),
 x AS (SELECT page_id, pos, ({listed(LANGUAGES)})[page_id % 3 + 1] AS lang, ({listed(SAID)})[(7 * page_id + 3 * pos) % {len(SAID)} + 1] AS text, lower(({listed(AROUND)})[(page_id + pos) % {len(AROUND)} + 1]) AS context, ({listed(ENDS)})[(page_id + 2 * pos) % {len(ENDS)} + 1] AS e, pos % 2 = 0 AS internal FROM p),
 y AS (SELECT *, '/' || replace(replace(lower(text), ' & ', '-'), ' ', '-') || e AS href, CASE WHEN internal THEN 'https://site' || page_id % 50 || '.example.org' ELSE ({listed(HOSTS)})[page_id % 3 + 1] END AS root FROM x),
 l AS (SELECT page_id, pos, lang, internal, root || href AS url, strip_accents(lower(text)) AS t, strip_accents(lower(href)) AS h, strip_accents(context) AS c, strip_accents(lower(regexp_replace(root || href, '^https://[^/]*', ''))) AS path, ends_with(lower(href), '.pdf') AS pdf, contains(root, 'hub.binwise') AS platform FROM y),
 kw AS (SELECT * FROM (VALUES {keyword_rows(("wine", "menu", "info", "context", "pdf"))}) v(name, lang, k, w)),
 s AS (SELECT page_id, pos, {sum_of("wine", 10, 5, 3)}, {sum_of("menu", 3, 2, 1)}, {sum_of("info", 1, 1, 1)}, count(*) FILTER (name = 'context' AND contains(c, k)) AS near,
  10 * count(*) FILTER (name = 'pdf' AND contains(path, k)) + 10 * count(*) FILTER (name = 'pdf' AND contains(t, k)) + 5 * count(*) FILTER (name = 'pdf' AND contains(c, k)) AS good FROM l JOIN kw USING (lang) GROUP BY ALL),
 b AS (SELECT page_id, pos, 20 * count(*) AS bad FROM l, (SELECT unnest({listed(links.OTHER_DOCUMENTS)}) AS o) u WHERE contains(path, o) OR contains(t, o) GROUP BY ALL),
 z AS (SELECT l.*, wine, near, good - coalesce(bad, 0) AS document, CASE WHEN wine > 0 THEN wine WHEN menu > 0 THEN menu ELSE info END + 25 * near AS inner_score FROM l JOIN s USING (page_id, pos) LEFT JOIN b USING (page_id, pos))"""


@query(f"""WITH {LINK_SQL}, o AS (SELECT *, CASE WHEN platform THEN 1000 WHEN pdf AND document > 0 THEN 500 + document WHEN pdf AND near > 0 THEN 400 WHEN pdf THEN 100 WHEN near > 0 THEN 300 + wine + 50 * near WHEN wine >= 50 THEN wine END AS outer_score FROM z)
 SELECT page_id, pos::INTEGER AS pos, 'internal' AS kind, inner_score::INTEGER AS score FROM o WHERE internal AND inner_score > 0 UNION ALL SELECT page_id, pos::INTEGER, 'external', outer_score::INTEGER FROM o WHERE NOT internal AND outer_score IS NOT NULL
 UNION ALL SELECT page_id, pos::INTEGER, 'document', document::INTEGER FROM o WHERE pdf""")
def scored_links(spark: SparkSession, d: str) -> DataFrame:
    """H3, H4, K1, K3-K5: links of English, French and Spanish pages, scored as links of the own host, as links to others and as documents."""
    found, language = fixture_links(spark, d), F.col("lang")
    kinds = {"internal": links.internal_links, "external": links.external_links, "document": links.scored_documents}
    parts = [score(found, language).select("page_id", "pos", F.lit(kind).alias("kind"), F.col("score").cast("int").alias("score")) for kind, score in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""WITH {LINK_SQL} SELECT page_id, url, document::INTEGER AS score FROM z WHERE pdf QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY document DESC, pos) = 1""")
def best_documents(spark: SparkSession, d: str) -> DataFrame:
    """The best document of each page, the first of equals, whatever its score."""
    return links.best_document(fixture_links(spark, d), "page_id", F.col("lang")).select("page_id", "url", F.col("score").cast("int").alias("score"))


@query(f"""WITH {LINK_SQL} SELECT page_id, pos::INTEGER AS pos, row_number() OVER (PARTITION BY page_id ORDER BY inner_score DESC, pos)::INTEGER AS place FROM z WHERE internal AND inner_score > 0""")
def walk_order(spark: SparkSession, d: str) -> DataFrame:
    """The order in which a walk takes a page's links: by falling score, then as they stand."""
    found = links.internal_links(fixture_links(spark, d), F.col("lang"))
    return found.select("page_id", "pos", F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("score"), "pos")).alias("place"))
