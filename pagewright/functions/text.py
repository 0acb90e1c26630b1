"""String scalar functions as native Column expressions (SC3-SC6, RES9, SNK2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zero-width and byte-order characters stripped from sitemap locations.
ZERO_WIDTH_CLASS = "[\\x{200B}\\x{200C}\\x{200D}\\x{FEFF}\\x{2060}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(x) -> Column:
    """The text without white space of any kind at its edges."""
    return F.regexp_replace(_col(x), r"(?U)^\s+|\s+$", "")


def clean_str(x) -> Column:
    """SC4: stripped string, NULL when NULL or blank."""
    t = strip(x)
    return F.when(t == "", F.lit(None)).otherwise(t)


def collapse_ws(x) -> Column:
    """Runs of white space of any kind (no-break spaces and separators too) as one space, none at the edges."""
    return F.trim(F.regexp_replace(_col(x), r"(?U)[\s\x1C-\x1F]+", " "))


def one_line(x, limit: int = 200) -> Column:
    """RES9: collapse whitespace; longer than ``limit`` -> first limit-1 chars + ellipsis."""
    c = collapse_ws(x)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 1), F.lit("…"))) \
        .otherwise(c)


def strip_zero_width(x) -> Column:
    """SC6: trim, strip zero-width characters at both edges, trim again."""
    t = F.trim(_col(x))
    t = F.regexp_replace(t, f"^{ZERO_WIDTH_CLASS}+|{ZERO_WIDTH_CLASS}+$", "")
    return F.trim(t)


def safe_filename(url) -> Column:
    """SNK2: collision-free markdown file name for a URL.

    strip ``^https?://``; runs of non-alphanumerics -> '_'; strip '_' at the edges; first 180
    chars (or 'page' when empty); then '_' + first 8 hex chars of sha256(url) + '.md'.
    """
    u = _col(url)
    stem = F.regexp_replace(u, r"^https?://", "")
    stem = F.regexp_replace(stem, r"[^a-zA-Z0-9]+", "_")
    stem = F.regexp_replace(stem, r"^_+|_+$", "")
    stem = F.substring(stem, 1, 180)
    stem = F.when(stem == "", F.lit("page")).otherwise(stem)
    digest = F.substring(F.sha2(u, 256), 1, 8)
    return F.concat(stem, F.lit("_"), digest, F.lit(".md"))

