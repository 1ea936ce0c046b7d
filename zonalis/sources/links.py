"""Links of HTML index pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: files of the census index that are not variables, dots as in a regular expression.
SKIPPED_FILES = "HOGAR.NHOG|VIVIENDA.V00|HOGAR.H15|PERSONA.P03"
COMMENT = r"(?s)<!--.*?(-->|$)"
# an anchor's attributes; a quoted value may hold a ">"
ANCHOR = r"""(?is)<a(?=[\s/])((?:[^>"']|"[^"]*"|'[^']*')*)>"""
# one attribute: its name, and its value in double, single or no quotes
ATTRIBUTE = r"""(?s)([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
# Entities of HTML that occur in addresses; the one for & comes last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def _href(attributes: Column) -> Column:
    """Value of the first ``href`` attribute, NULL if there is none."""
    names = F.regexp_extract_all(attributes, F.lit(ATTRIBUTE), F.lit(1))
    values = F.regexp_extract_all(attributes, F.lit(ATTRIBUTE), F.lit(2))
    found = F.filter(F.arrays_zip(names.alias("name"), values.alias("value")), lambda a: (F.lower(a["name"]) == "href") & (a["value"] != ""))
    text = F.trim(F.regexp_replace(F.get(found, F.lit(0))["value"], "^[\"']|[\"']$", ""))
    for entity, letter in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(letter))
    return text


def harvest_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per link, in page order, next to the other columns of the page.

    Case, white space and kind of quotes do not matter; comments hold no links; entities are decoded.
    """
    shown = F.regexp_replace(F.col(html), COMMENT, "")
    anchors = F.regexp_extract_all(shown, F.lit(ANCHOR), F.lit(1))
    links = F.filter(F.transform(anchors, _href), lambda h: h.isNotNull())
    return pages.select(*[c for c in pages.columns if c != html], F.posexplode(links).alias("position", "href"))


def data_files(links: DataFrame, suffix: str = ".csv", skipped: str = SKIPPED_FILES) -> DataFrame:
    """Links with the suffix that match none of the skipped patterns."""
    return links.filter(F.col("href").endswith(suffix) & ~F.col("href").rlike(skipped))
