"""Links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------
VIDEO_MARK = "news/video"
VIDEO_PREFIX = "http://www.reuters.com/news/video"
BOILERPLATE_LINKS = ("//thomsonreuters.com/", "/info/disclaimer")
# ----------------------------------------------------------------------------


def absolutise(href: Column, base: str) -> Column:
    """Prefix a host unless the link already names one."""
    return F.when(href.rlike(r"^https?://"), href).otherwise(F.concat(F.lit(base), href))
