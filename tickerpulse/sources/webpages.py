"""Symbol listings and quote cells from stored HTML pages.

Regex extraction is only safe for the simple shapes used here: an anchor
``<a href="/...">text</a>`` with no nested tags, and a cell element whose
text has no nested tags. Everything runs per page row, so the work spreads
over the pages table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINK_PATTERN = '<a href="{prefix}[^"]*">([^<]*)</a>'


def page_links(pages: DataFrame, href_prefix: str = "/", every: int = 2,
               offset: int = 1) -> DataFrame:
    """Anchor texts whose href starts with ``href_prefix``; keeps positions
    ``offset, offset+every, ...`` (0-based) of each page, as the listing
    alternates name and symbol links."""
    pat = LINK_PATTERN.format(prefix=href_prefix)
    links = pages.select("page_id", F.posexplode(
        F.regexp_extract_all("html", F.lit(pat), F.lit(1))).alias("pos", "link"))
    return links.where((F.col("pos") % every) == offset) \
        .select("page_id", F.col("pos").cast("bigint").alias("pos"), "link")


def symbol_rows(pages: DataFrame, href_prefix: str = "/") -> DataFrame:
    """Upper-cased listing symbols as they stand (blank texts left out), one row per listing entry."""
    return page_links(pages, href_prefix).where(F.trim("link") != "") \
        .select(F.upper("link").alias("symbol"))


def symbol_universe(pages: DataFrame, href_prefix: str = "/") -> DataFrame:
    """Distinct upper-cased listing symbols as a one-column dimension."""
    return symbol_rows(pages, href_prefix).distinct()


def page_cells(pages: DataFrame, cell_pattern: str, sentinel: str,
               stride: int = 3, names=("price", "chg", "pct_chg")) -> DataFrame:
    """Cell texts of each page, cut before the first ``sentinel`` cell and
    de-interleaved by ``stride`` into one row per record with ``names`` columns.
    A page without the sentinel keeps all its cells."""
    cells = F.regexp_extract_all("html", F.lit(cell_pattern), F.lit(1))
    cut = F.array_position(cells, sentinel)
    kept = F.when(cut > 0, F.slice(cells, 1, cut - 1)).otherwise(cells)
    # De-interleave inside the row: no shuffle, the page's cells are already together.
    n_rec = F.ceil(F.size(kept) / stride).cast("int")
    recs = F.transform(
        F.sequence(F.lit(0), n_rec - 1),
        lambda i: F.struct(i.cast("bigint").alias("rec"),
                           *[F.get(kept, i * stride + j).alias(n) for j, n in enumerate(names)]))
    recs = F.when(n_rec > 0, recs)
    return pages.select("page_id", F.explode(recs).alias("r")).select("page_id", "r.*")
