"""URL column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import config as C


def host(url: Column) -> Column:
    """Lower-case authority, port and user info included; '' if there is none."""
    return F.lower(F.coalesce(F.nullif(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")), F.lit("")))


def with_scheme(url: Column) -> Column:
    """Trimmed, with https:// unless a scheme is there; null and '' stay."""
    u = F.trim(url)
    return F.when((u == "") | (F.instr(u, "://") > 0), u).otherwise(F.concat(F.lit("https://"), u))


def is_aggregator(host_: Column, roots: tuple[str, ...] = C.AGGREGATOR_ROOTS) -> Column:
    """Host equals a root domain or lies below one."""
    h = F.lower(F.trim(F.coalesce(host_, F.lit(""))))
    return F.exists(F.array(*[F.lit(r) for r in roots]), lambda r: (h == r) | F.endswith(h, F.concat(F.lit("."), r)))


def apply_score(url: Column, roots: tuple[str, ...] = C.AGGREGATOR_ROOTS) -> Column:
    """0 without a host, 1 aggregator, 2 plain, 3 https."""
    h = host(F.coalesce(url, F.lit("")))
    return (
        F.when(h == "", 0).when(is_aggregator(h, roots), 1).when(F.startswith(F.lower(F.trim(url)), F.lit("https://")), 3).otherwise(2)
    )


def body_redirect(html: Column, base: Column, scope: int = 32_000) -> Column:
    """The first meta-refresh or script redirect to another host in the page head, else ''."""
    head = F.substring(html, 1, scope)
    found = F.array(*[F.trim(F.regexp_extract(head, p, 1)) for p in (C.META_REFRESH, *C.SCRIPT_REDIRECTS)])
    scheme = F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1))
    whole = F.transform(found, lambda t: F.when(F.startswith(t, F.lit("//")), F.concat(scheme, t)).otherwise(t))
    elsewhere = F.filter(whole, lambda t: (host(t) != "") & (host(t) != host(base)))
    return F.coalesce(F.try_element_at(elsewhere, F.lit(1)), F.lit(""))


def careers_root(url: Column) -> Column:
    return F.concat(F.lit("https://"), host(url))


def verdict(status: Column) -> Column:
    """2xx active, 404 and 410 closed, anything else unknown."""
    return F.when(status.between(200, 299), "active").when(status.isin(404, 410), "likely_closed").otherwise("unknown")
