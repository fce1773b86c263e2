"""Web pages: title, links and main text; hosts and canonical URLs.

Extraction is a chain of built-in regex functions over the whole page (no
HTML parser library, no Python worker).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import patterns as P
from tidewater.plans.catalog import job
from tidewater.sources.tables import Tables


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


#: Marks that stand for a block's opening and closing tags, so that "the
#: innermost block" is a pattern without look-around.
OPEN, CLOSE = "\x01", "\x02"
_MARKS, _INNERMOST = r"[\x01\x02]", r"\x01[^\x01\x02]*\x02"


def _marked(tag: str) -> list[tuple[str, str]]:
    return [(rf"(?i)<{tag}\b[^>]*>", OPEN), (rf"(?i)</{tag}\s*>", CLOSE)]


#: Steps (pattern, replacement) before and after the blocks go.
_BEFORE = [(_MARKS, " "), (P.UNREAD, " ")]
_AFTER = [(P.AD_BLOCK, " "), (P.TITLE, " "), (P.TAG, " "), *P.ENTITIES, (r"\s+", " "), (r"^ | $", "")]


def _replaced(c: F.Column, steps: list[tuple[str, str]]) -> F.Column:
    for pat, rep in steps:
        c = F.replace(c, F.lit(pat), F.lit(rep)) if pat.startswith("&") else F.regexp_replace(c, pat, rep)
    return c


def _depth(c: F.Column) -> F.Column:
    """How deep the marks of a text nest; closing marks too many don't count."""

    def step(acc: F.Column, mark: F.Column) -> F.Column:
        now = F.greatest(acc["now"] + F.when(mark == OPEN, 1).when(mark == CLOSE, -1).otherwise(0), F.lit(0))
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    marks = F.split(F.regexp_replace(c, r"[^\x01\x02]", ""), "")
    return F.aggregate(marks, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda acc: acc["most"])


def with_main_text(pages: DataFrame, html: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` with ``out``, the text of ``html`` without scripts, styles,
    comments, navigation, headers, footers and ad blocks.

    Comments and scripts go first, as a tag inside them is no tag.  Blocks of
    a kind go from the innermost outwards, as many times as they nest; tags
    without a partner are dropped alone.  Each step is a projection of its
    own, so no step's text is computed twice."""
    df = pages.withColumn(out, _replaced(F.col(html), _BEFORE))
    for tag in P.BLOCK_TAGS:
        df = df.withColumn(out, _replaced(F.col(out), _marked(tag)))
        inwards = F.aggregate(F.array_repeat(F.lit(0), _depth(F.col(out))), F.col(out), lambda text, _: F.regexp_replace(text, _INNERMOST, " "))
        df = df.withColumn(out, F.when(F.contains(F.col(out), F.lit(CLOSE)), inwards).otherwise(F.col(out)))
        df = df.withColumn(out, F.regexp_replace(out, _MARKS, " "))
    return df.withColumn(out, _replaced(F.col(out), _AFTER))


def _replaced_sql(c: str, steps: list[tuple[str, str]]) -> str:
    for pat, rep in steps:
        c = f"regexp_replace({c}, {_q(pat)}, {_q(rep)}, 'g')"
    return c


def _page_text_sql() -> str:
    """Blocks go by recursion, for as long as a page has an innermost one."""
    steps = [f"b0 AS (SELECT row_number() OVER () AS row, *, {_replaced_sql('html', _BEFORE)} AS t FROM pages)"]
    for k, tag in enumerate(P.BLOCK_TAGS):
        inner = _q(_INNERMOST)
        steps += [
            f"r{k}(row, t, round) AS (SELECT row, {_replaced_sql('t', _marked(tag))}, 0 FROM b{k} UNION ALL SELECT row, regexp_replace(t, {inner}, ' ', 'g'), round + 1 FROM r{k} WHERE regexp_matches(t, {inner}))",
            f"b{k + 1} AS (SELECT row, {_replaced_sql('arg_max(t, round)', [(_MARKS, ' ')])} AS t FROM r{k} GROUP BY row)",
        ]
    last = f"b{len(P.BLOCK_TAGS)}"
    return f"""
    WITH RECURSIVE {", ".join(steps)}
    SELECT b0.page_id AS page_id, regexp_extract(b0.html, {_q(P.TITLE)}, 1) AS title,
           CAST(len(regexp_extract_all(b0.html, {_q(P.LINK)}, 0)) AS BIGINT) AS n_links,
           {_replaced_sql(f"{last}.t", _AFTER)} AS main_text
    FROM b0 JOIN {last} ON {last}.row = b0.row
    """


@job("page_text", _page_text_sql(), group="pages")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, number of links, and the main text with navigation, headers,
    footers, scripts, styles, comments and ad blocks removed."""
    pages = Tables(spark, sf_dir).pages
    return page_text_df(pages)


def page_text_df(pages: DataFrame) -> DataFrame:
    return with_main_text(pages.select("page_id", "html")).select(
        "page_id",
        F.regexp_extract("html", P.TITLE, 1).alias("title"),
        F.size(F.regexp_extract_all("html", F.lit(P.LINK), F.lit(0))).cast("bigint").alias("n_links"),
        "main_text",
    )


@job(
    "url_hosts",
    f"""
    SELECT regexp_extract(url, {_q(P.URL_HOST)}, 1) AS host, COUNT(*) AS n_pages
    FROM pages GROUP BY 1
    """,
    group="pages",
)
def url_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        Tables(spark, sf_dir)
        .pages.groupBy(F.regexp_extract("url", P.URL_HOST, 1).alias("host"))
        .agg(F.count(F.lit(1)).alias("n_pages"))
    )


_HOST_PREFIX, _LAST_SLASH, _NO_PARAMS = r"^(www|m)\.", r"/$", r"&+"


def _canon_sql() -> str:
    part = [f"regexp_extract(url, {_q(P.URL_PARTS)}, {i})" for i in (2, 3, 5)]
    query = f"regexp_replace('&' || {part[2]}, {_q(P.TRACKING_PARAM)}, '', 'g')"
    params = f"trim(regexp_replace({query}, {_q(_NO_PARAMS)}, '&', 'g'), '&')"
    return (
        f"regexp_replace(lower({part[0]}), {_q(_HOST_PREFIX)}, '') || regexp_replace({part[1]}, {_q(_LAST_SLASH)}, '')"
        f" || CASE WHEN {params} = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split({params}, '&')), '&') END"
    )


def canonical(url: str) -> F.Column:
    """One spelling of a URL: scheme, ``www.``/``m.``, fragment, tracking
    parameters and a last slash removed, the host in lower case, parameters
    sorted.  Path and query keep their case."""
    host, path, query = (F.regexp_extract(url, P.URL_PARTS, i) for i in (2, 3, 5))
    query = F.regexp_replace(F.concat(F.lit("&"), query), P.TRACKING_PARAM, "")
    params = F.btrim(F.regexp_replace(query, _NO_PARAMS, "&"), F.lit("&"))
    tail = F.concat(F.lit("?"), F.array_join(F.array_sort(F.split(params, "&")), "&"))
    return F.concat(
        F.regexp_replace(F.lower(host), _HOST_PREFIX, ""),
        F.regexp_replace(path, _LAST_SLASH, ""),
        F.when(params == "", F.lit("")).otherwise(tail),
    )


@job(
    "canonical_urls",
    f"""
    SELECT {_canon_sql()} AS canonical_url, COUNT(*) AS n_pages, MIN(page_id) AS keep_page_id
    FROM pages GROUP BY 1
    """,
    group="pages",
)
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical URLs with the pages sharing each one."""
    return (
        Tables(spark, sf_dir)
        .pages.groupBy(canonical("url").alias("canonical_url"))
        .agg(F.count(F.lit(1)).alias("n_pages"), F.min("page_id").alias("keep_page_id"))
    )
