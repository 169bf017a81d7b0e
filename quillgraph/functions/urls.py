"""URL functions as Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import weburl
from .udf import arrow_udf


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: URLs that need no parser: lower-case host names that cannot be addresses, and plain paths.
PLAIN = r"^https?://(?:[a-z0-9-]+\.)*[a-z][a-z0-9-]*(?::[1-9][0-9]{0,3})?(?:/[A-Za-z0-9._~!$&'()*+,;=:@-]*)*(?:[?#][^\s]*)?$"


@arrow_udf("string")
def _parsed(urls: pd.Series) -> pd.Series:
    return urls.map(weburl.canonical, na_action="ignore")


def canonical_url(c: Column | str) -> Column:
    """protocol://host/path without trailing slashes, query and fragment, by the standard of the web; null for what is no URL.

    Plain URLs are cut by column expressions; only others (capitals, escapes, dot segments, other
    schemes) meet the parser, in Arrow batches.
    """
    url = F.regexp_replace(_col(c), r"(?U)^[\s\x{FEFF}]+|[\s\x{FEFF}]+$", "")
    plain = F.regexp_like(url, F.lit(PLAIN)) & ~F.contains(url, F.lit("/.")) & ~F.regexp_like(url, F.lit(r"(?i)^[^?#]*(?:xn--|%2e)"))
    cut = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", "")
    cut = F.regexp_replace(cut, r"^(http://[^/:]+):80(?=/|$)|^(https://[^/:]+):443(?=/|$)", "$1$2")
    return F.when(plain, cut).when(url != "", _parsed(F.when(~plain, url)))


def article_id(c: Column | str) -> Column:
    """Last path segment if it is all digits."""
    path = F.try_parse_url(F.trim(_col(c)), F.lit("PATH"))
    return F.nullif(F.regexp_extract(path, "/([0-9]+)/*$", 1), F.lit(""))


def source_slug(slug: Column, url: Column | str) -> Column:
    """slug-id, or slug and the first eight digits of the URL's SHA-1 (of '' for a null URL)."""
    tail = F.coalesce(article_id(url), F.substring(F.sha1(F.coalesce(_col(url), F.lit("")).cast("binary")), 1, 8))
    return F.concat_ws("-", slug, tail)
