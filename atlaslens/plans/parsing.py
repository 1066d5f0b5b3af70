"""From page text to typed review rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atlaslens import config
from atlaslens.functions import bilingual, text as tx
from atlaslens.functions.age import age_text, with_review_age
from atlaslens.functions.facets import facet_columns
from atlaslens.functions.html import select_fields
from atlaslens.operators import reviews
from atlaslens.plans import tables
from atlaslens.plans.registry import query


def strip_sql(expression: str) -> str:
    return rf"regexp_replace({expression}, '^\s+|\s+$', '', 'g')"


@query("token_extract", r"""
    WITH written AS (
        SELECT page_id, html || '<div data-next-page-token="' ||
               CASE WHEN contains(url, 'page=') THEN md5(url) || '==' WHEN contains(url, '#') THEN 'a-' || md5(url)
                    WHEN contains(url, '/en/') THEN md5(url) ELSE md5(url) || '=' END || '"></div>' AS page
        FROM pages
    )
    SELECT page_id, regexp_extract(page, 'data-next-page-token="([\w]+=+)', 1) AS token FROM written""")
def token_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next-page token of each page, written into it first; some have none that counts."""
    url = F.col("url")
    token = (
        F.when(F.contains(url, F.lit("page=")), F.concat(F.md5(url), F.lit("==")))
        .when(F.contains(url, F.lit("#")), F.concat(F.lit("a-"), F.md5(url)))
        .when(F.contains(url, F.lit("/en/")), F.md5(url))
        .otherwise(F.concat(F.md5(url), F.lit("=")))
    )
    page = F.concat(F.col("html"), F.lit('<div data-next-page-token="'), token, F.lit('"></div>'))
    return tables.table(spark, sf_dir, "pages").select(
        "page_id", F.coalesce(tx.next_page_token(page), F.lit("")).alias("token")
    )


@query("link_format", r"""
    SELECT page_id, 'https://reviews.example.com/async/reviewDialog?hl=' || regexp_extract(html, 'lang="(\w+)"', 1)
           || '&async=feature_id:' || page_id || ',sort_by:newestFirst,next_page_token:'
           || regexp_extract(url, 'page=(\d+)', 1) || ',associated_topic:,_fmt:pc' AS link
    FROM pages""")
def link_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address text of each page from its language, id and token."""
    link = tx.page_link(
        F.lit("reviews.example"), F.lit("com"), F.regexp_extract("html", r'lang="(\w+)"', 1),
        F.col("page_id").cast("string"), F.regexp_extract("url", r"page=(\d+)", 1),
    )
    return tables.table(spark, sf_dir, "pages").select("page_id", link.alias("link"))


PAGE_FIELDS = {
    "hrefs": ("a", None, "attr:href"),
    "items": ("li", None, "text"),
    "leads": ("p", None, "lead"),
}


def unescape_sql(expression: str) -> str:
    for entity, character in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        expression = f"replace({expression}, '{entity}', '{character}')"
    return expression


PAGE_LISTS_SQL = r"""
    lists AS (
        SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs,
               regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS items,
               regexp_extract_all(html, '<p>([^<]*)', 1) AS leads
        FROM pages
    )"""


def page_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.table(spark, sf_dir, "pages")
    return pages.select("page_id", select_fields(F.col("html"), PAGE_FIELDS).alias("found")).select("page_id", "found.*")


@query("positional_zip", f"""
    WITH {PAGE_LISTS_SQL},
    positions AS (SELECT *, unnest(range(greatest(len(hrefs), len(items), len(leads)))) AS i FROM lists)
    SELECT page_id, CAST(i AS INTEGER) AS position, {unescape_sql("hrefs[i + 1]")} AS href,
           {unescape_sql("items[i + 1]")} AS item, {unescape_sql("leads[i + 1]")} AS lead, i < len(hrefs) AS aligned
    FROM positions""")
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, list items and paragraph openings of a page side by side, by position."""
    return reviews.zip_lists(page_lists(spark, sf_dir), {"hrefs": "href", "items": "item", "leads": "lead"})


@query("extraction_counts", f"""
    WITH {PAGE_LISTS_SQL}
    SELECT page_id, CAST(len(hrefs) AS INTEGER) AS n_links, CAST(len(items) AS INTEGER) AS n_items,
           CAST(len(leads) AS INTEGER) AS n_paragraphs FROM lists""")
def extraction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many elements of each kind were found on a page."""
    return page_lists(spark, sf_dir).select(
        "page_id", F.size("hrefs").alias("n_links"), F.size("items").alias("n_items"), F.size("leads").alias("n_paragraphs")
    )


@query("bilingual_split", rf"""
    WITH stripped AS (SELECT conv_id, turn, {strip_sql("text")} AS t FROM conversations)
    SELECT conv_id, turn,
           CASE WHEN turn = 4 THEN '' ELSE t END AS original,
           CASE WHEN turn IN (0, 1, 2, 3, 4) THEN 'tr ' || t WHEN turn = 6 THEN NULL ELSE t END AS translated
    FROM stripped""")
def bilingual_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Original and translated text of reviews in every layout; the turn decides the layout."""
    text, translated = F.col("text"), F.concat(F.lit("tr "), tx.strip(F.col("text")))
    tag, original_tag = F.lit("(Translated by Google)"), F.lit("(Original)")
    turn = F.col("turn")
    parts = (
        F.when(turn == 0, F.array(tag, translated, original_tag, text))
        .when(turn == 1, F.array(text, tag, translated))
        .when(turn == 2, F.array(F.concat_ws(" ", tag, translated), F.concat_ws(" ", original_tag, text)))
        .when(turn == 3, F.array(F.concat_ws(" ", tag, translated), F.lit("\n "), original_tag, text))
        .when(turn == 4, F.array(F.concat_ws(" ", tag, translated)))
        .when(turn == 5, F.array(text))
        .when(turn == 6, F.array(text, tag))
    )
    laid_out = tables.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", parts.alias("parts"))
    split = bilingual.with_bilingual_texts(laid_out, F.col("parts"), text, tag, original_tag)
    return split.select("conv_id", "turn", "original", "translated")


@query("clean_name", rf"""
    SELECT doc_id, {strip_sql("replace(replace(replace(text, chr(10), ' '), ',', ''), '|', '')")} AS name_text,
           trim(regexp_replace(text, '\s+', ' ', 'g')) AS time_text
    FROM documents""")
def clean_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and time cleaning over whole texts."""
    return tables.table(spark, sf_dir, "documents").select(
        "doc_id", tx.clean_name(F.col("text")).alias("name_text"), tx.collapse_whitespace(F.col("text")).alias("time_text")
    )


@query("first_digit", r"""
    SELECT p_partkey, CAST(regexp_extract(CASE WHEN p_size < 25 THEN p_brand ELSE p_name || ' ' || p_size END, '\d') AS DOUBLE) AS stars
    FROM part""")
def first_digit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star rating: from the label, and only without a digit there from the whole element."""
    label = F.when(F.col("p_size") < 25, F.col("p_brand")).otherwise(F.col("p_name"))
    outer = F.concat_ws(" ", "p_name", "p_size")
    return tables.table(spark, sf_dir, "part").select("p_partkey", tx.star_rating(label, outer).alias("stars"))


def _ages(spark: SparkSession, sf_dir: str, texts: list, language: str) -> DataFrame:
    """Events with an age text; the event's number and value choose the wording."""
    source = tables.table(spark, sf_dir, "events")
    wording = F.lit(None).cast("string")
    for index, text in enumerate(texts):
        wording = F.when(F.col("event_id") % len(texts) == index, text).otherwise(wording)
    aged = with_review_age(
        source.select(
            "event_id", F.to_date("ts").alias("scrape_ds"), wording.alias("time"), F.lit(language).alias("language")
        ),
        tables.latest(source, F.to_date("ts")),
    )
    return aged.select(
        "event_id",
        F.coalesce("days_before_scrape", F.lit(-1)).alias("days"),
        age_text(F.col("review_date")).alias("review_date"),
        F.coalesce("age_in_days", F.lit(-1)).alias("age_in_days"),
        F.coalesce("age_precision", F.lit(-1)).alias("age_precision"),
        "age_error",
    )


def _ages_sql(days: list[str]) -> str:
    cases = " ".join(f"WHEN {index} THEN {value}" for index, value in enumerate(days))
    return f"""
    WITH counted AS (
        SELECT event_id, CAST(ts AS DATE) AS d, (SELECT CAST(max(ts) AS DATE) FROM events) AS today,
               CAST(floor(value) AS INTEGER) % 50 + 2 AS n FROM events
    ), aged AS (SELECT *, CAST(CASE event_id % {len(days)} {cases} END AS INTEGER) AS days FROM counted)
    SELECT event_id, coalesce(days, -1) AS days, strftime(d - days, '%Y-%m-%d') AS review_date,
           CAST(coalesce(today - (d - days), -1) AS INTEGER) AS age_in_days,
           CASE WHEN days IS NULL THEN -1 WHEN days = 0 THEN 0 WHEN days < 7 THEN 1 WHEN days < 30 THEN 7
                WHEN days < 365 THEN 30 ELSE 365 END AS age_precision,
           CASE WHEN days IS NULL THEN 'text' END AS age_error
    FROM aged"""


def _n(text: str) -> Column:
    """Text with the event's count in place of ``#``."""
    count = (F.floor("value").cast("int") % 50 + 2).cast("string")
    return F.replace(F.lit(text), F.lit("#"), count)


@query("relative_age_en", _ages_sql(["0", "0", "1", "n", "7", "7 * n", "30", "30 * n", "365", "365 * n", "NULL"]))
def relative_age_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days, date and precision of English ages."""
    texts = ["an hour ago", "# minutes ago", "a day ago", "# days ago", "a week ago", "# weeks ago", "a month ago",
             "# Months ago", "a year ago", "# years ago", "Edited # weeks ago"]
    return _ages(spark, sf_dir, [_n(text) for text in texts], "en")


@query("relative_age_es", _ages_sql(["0", "0", "1", "n", "7", "7 * n", "30", "30 * n", "365", "365 * n", "NULL"]))
def relative_age_es(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days, date and precision of Spanish ages."""
    texts = ["Hace una hora", "Hace # minutos", "Hace un día", "Hace # días", "Hace una semana", "Hace # semanas",
             "Hace un mes", "hace # meses", "Hace un año", "Hace # años", "Editado hace # semanas"]
    return _ages(spark, sf_dir, [_n(text) for text in texts], "es")


@query("review_id", """
    SELECT conv_id, turn, sha256(conv_id || '_' || trim(replace(replace(replace(text, chr(10), ' '), ',', ''), '|', '')) || '_' || role) AS unique_review_id
    FROM conversations""")
def review_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable id of each turn, as a review by the name in its text."""
    return tables.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        tx.review_id(F.col("conv_id").cast("string"), tx.clean_name(F.col("text")), F.col("role")).alias("unique_review_id"),
    )


@query("review_facets", """
    SELECT event_id, props AS review,
           CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'f' || user_id END AS food,
           CASE WHEN event_type IN ('view', 'signup') THEN 's' || user_id END AS service,
           CASE WHEN event_type = 'signup' THEN 'a' || user_id END AS atmosphere
    FROM events""")
def review_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facet ratings of each event; the type decides which facets it has and how they are spelled."""
    kind = F.col("event_type")

    def entry(name: str, prefix: str) -> tuple[Column, Column]:
        return F.lit(name), F.array(F.concat(F.lit(prefix), F.col("user_id")), F.lit("second"))

    text = (F.lit("review"), F.array("props"))
    ratings = (
        F.when(kind == "click", F.create_map(*text, *entry("Food", "f")))
        .when(kind == "view", F.create_map(*text, *entry("FOOD", "f"), *entry("Service", "s")))
        .when(kind == "signup", F.create_map(*text, *entry("Comida", "f"), *entry("Servicio", "s"), *entry("ambiente", "a")))
        .when(kind == "purchase", F.create_map(*text, F.lit("Food"), F.expr("cast(array() as array<string>)")))
        .otherwise(F.create_map(*text))
    )
    spanish = kind == "signup"
    labels = {
        "food": F.when(spanish, "Comida").otherwise("Food"),
        "service": F.when(spanish, "Servicio").otherwise("Service"),
        "atmosphere": F.when(spanish, "Ambiente").otherwise("Atmosphere"),
    }
    columns = facet_columns(ratings, labels)
    return tables.table(spark, sf_dir, "events").select(
        "event_id", *(column.alias(name) for name, column in columns.items())
    )


def escaped(text: Column) -> Column:
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(character), F.lit(entity))
    return text


def rendered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as captured review pages: each line that is not blank is one review.

    The position of a line decides the layout of its review, as on real pages: full
    text with a translation, full text alone, or the short form.
    """
    spanish = F.col("lang") == "es"
    stars_class = F.when(spanish, F.lit(config.PARSER[1][1])).otherwise(F.lit(config.PARSER[0][1]))
    tag = F.when(spanish, F.lit("(Traducido por Google)")).otherwise(F.lit("(Translated by Google)"))
    age = F.when(spanish, F.lit("Hace 3\n semanas")).otherwise(F.lit("3  weeks ago"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(F.trim(line)) > 0)

    def block(line: Column, position: Column) -> Column:
        safe, number = escaped(line), position.cast("string")
        translated = F.concat(F.lit('<span class="review-full-text">'), tag, F.lit("<br>tr "), safe,
                              F.lit("<br><i>(Original)</i>\n"), safe, F.lit("</span>"))
        whole = F.concat(F.lit('<p><span class="x review-full-text">'), safe, F.lit("</span>"))
        short = F.concat(F.lit('<span class="f5axBf"><b></b><span>'), safe, F.lit("<b>...</b></span></span>"))
        layout = F.when(position % 3 == 0, translated).when(position % 3 == 1, whole).otherwise(short)
        return F.concat(
            F.lit('<div class="TSUbDb"><a href="#">User,\n|'), number, F.lit("</a>\n</div>"),
            F.lit('<span class="'), stars_class, F.lit('" aria-label="Rated '), (position % 5 + 1).cast("string"),
            F.lit(' out of 5"></span><div class="PuaHbe"> <span>'), age, F.lit("</span> </div>"),
            F.lit('<div class="Jtu6Td">'), layout, F.lit("</div>"),
        )

    body = F.array_join(F.transform(lines, block), "")
    return tables.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("place_id"),
        F.col("source").alias("data_id"),
        F.col("source").alias("name"),
        F.to_date(F.lit("2024-01-31")).alias("scrape_ds"),
        F.when(spanish, "es").otherwise("en").alias("scrape_language"),
        F.lit(0).alias("page_number"),
        F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("content"),
    )


@query("review_rows", rf"""
    WITH lines AS (
        SELECT doc_id, lang, source, list_filter(string_split(text, chr(10)), lambda line: length(trim(line)) > 0) AS found
        FROM documents
    ), numbered AS (SELECT *, unnest(range(len(found))) AS i FROM lines),
    blocks AS (SELECT *, {strip_sql("found[i + 1]")} AS line, CASE WHEN lang = 'es' THEN 'es' ELSE 'en' END AS language FROM numbered)
    SELECT CAST(doc_id AS VARCHAR) AS place_id, CAST(i AS INTEGER) AS position, language, source AS restaurant_name,
           line AS review_original, CASE WHEN i % 3 = 0 THEN 'tr ' || line ELSE line END AS review_target_language,
           'User ' || i AS reviewer_name, CAST(i % 5 + 1 AS DOUBLE) AS stars,
           CASE WHEN language = 'es' THEN 'Hace 3 semanas' ELSE '3 weeks ago' END AS time,
           '2024-01-10' AS review_date, 7 AS age_precision,
           sha256(doc_id || '_User ' || i || '_' || language) AS unique_review_id
    FROM blocks""")
def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed review rows of every captured page, from its HTML."""
    parsed = reviews.parse_pages(
        rendered_pages(spark, sf_dir), config.parser_table(spark), F.to_date(F.lit("2024-02-01"))
    )
    return parsed.select(
        "place_id", "position", "language", "restaurant_name", "review_original", "review_target_language",
        "reviewer_name", "stars", "time", age_text(F.col("review_date")).alias("review_date"), "age_precision",
        "unique_review_id",
    )
