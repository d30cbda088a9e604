"""URL column builders, written as regular expressions so they stay in codegen.

``clean_url`` keeps scheme, authority and path and drops the ``;params`` of the
last path segment, the query and the fragment; the scheme is lower-cased as a
standard URL parser does.  ``url_domain`` is the full authority (user-info and
port included, case preserved) and is empty when the URL has none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL grammar pieces (RFC 3986 scheme and authority shapes).
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def url_scheme(col: str | Column) -> Column:
    return F.lower(F.regexp_extract(_c(col), _SCHEME, 1))


def url_domain(col: str | Column) -> Column:
    return F.regexp_extract(_c(col), _AUTHORITY, 1)


def clean_url(col: str | Column) -> Column:
    url = _c(col)
    head = F.regexp_extract(url, r"^([^?#]*)", 1)
    no_params = F.regexp_replace(head, r";[^/]*$", "")
    scheme = F.regexp_extract(no_params, _SCHEME, 1)
    return F.when(scheme == "", no_params).otherwise(
        F.concat(F.lower(scheme), F.substring(no_params, F.length(scheme) + 1, 1 << 30))
    )


def resolve_src(page_url: str | Column, src: str | Column, strict: bool = False) -> Column:
    """Resolve an image ``src`` against the page URL.

    ``strict=False`` is the parity rule: anything not starting with ``data:``
    or ``http`` is prefixed with ``scheme://authority`` verbatim (no slash is
    inserted).  ``strict=True`` joins paths properly (``/`` added for relative
    paths, ``//host`` taken as protocol-relative).
    """
    s = _c(src)
    base = F.concat(url_scheme(page_url), F.lit("://"), url_domain(page_url))
    absolute = s.startswith("data:") | s.startswith("http")
    if not strict:
        return F.when(s.isNull(), None).when(absolute, s).otherwise(F.concat(base, s))
    return (
        F.when(s.isNull(), None)
        .when(absolute, s)
        .when(s.startswith("//"), F.concat(url_scheme(page_url), F.lit(":"), s))
        .when(s.startswith("/"), F.concat(base, s))
        .otherwise(F.concat(base, F.lit("/"), s))
    )
