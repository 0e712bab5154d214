"""Domain, URL and name-rule expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (AUTHORITY_DOMAINS, CDN_ASNS, CDN_IP_PREFIXES, CDN_ORG_KEYWORDS,
                      NOISE_AUTHORS, NOISE_DOMAINS, PARENT_SECOND_LEVEL, RETRAIN_KEYWORDS,
                      SUSPICIOUS_KEYWORDS, SUSPICIOUS_TLDS)
from .text import strip_ws


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# scheme://netloc — netloc keeps user info and port, like urlparse does.
NETLOC_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def url_netloc(col) -> Column:
    return F.regexp_extract(_c(col), NETLOC_RE, 1)


def url_domain(col) -> Column:
    """Host of a URL, lower-cased, leading ``www.`` removed, null without a dot (H1)."""
    host = F.regexp_replace(F.lower(url_netloc(col)), r"^www\.", "")
    return F.when(F.locate(".", host) > 0, host)


def url_domain_any(col) -> Column:
    """Social-feed variant: every ``www.`` removed (H2)."""
    host = F.replace(F.lower(url_netloc(col)), F.lit("www."), F.lit(""))
    return F.when(F.locate(".", host) > 0, host)


def normalize_domain(col) -> Column:
    """Lower, trim, strip ``www.``, right-strip ``./``, need a dot, 4..100 chars (H3)."""
    d = strip_ws(F.lower(_c(col)))
    d = F.regexp_replace(d, r"^www\.", "")
    d = strip_ws(F.regexp_replace(d, r"[./]+$", ""))
    return F.when((F.locate(".", d) > 0) & F.length(d).between(4, 100), d)


def normalize_seed(col) -> Column:
    """Request form: strip scheme text, cut at the first slash (H4)."""
    d = F.lower(strip_ws(_c(col)))
    d = F.replace(F.replace(d, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    return strip_ws(F.substring_index(d, "/", 1))


def parent_domain(col) -> Column:
    """Last three labels when the second-last is a generic second level, else last two (H5)."""
    d = _c(col)
    parts = F.split(d, r"\.")
    n = F.size(parts)
    return (F.when((n >= 3) & F.element_at(parts, -2).isin(*PARENT_SECOND_LEVEL),
                   F.substring_index(d, ".", -3))
            .when(n >= 2, F.substring_index(d, ".", -2))
            .otherwise(d))


def hyphen_count(col) -> Column:
    d = _c(col)
    return F.length(d) - F.length(F.replace(d, F.lit("-"), F.lit("")))


def suspicious_name(col, keywords=SUSPICIOUS_KEYWORDS) -> Column:
    """Suspicious TLD, or keyword in the name, or two or more hyphens."""
    d = _c(col)
    tld = reduce(lambda a, b: a | b, [F.endswith(d, F.lit(t)) for t in SUSPICIOUS_TLDS])
    kw = reduce(lambda a, b: a | b, [F.locate(k, d) > 0 for k in keywords])
    return tld | kw | (hyphen_count(d) >= 2)


def suspicious_name_retrain(col) -> Column:
    return suspicious_name(col, RETRAIN_KEYWORDS)


def has_suspicious_tld(col) -> Column:
    d = _c(col)
    return reduce(lambda a, b: a | b, [F.endswith(d, F.lit(t)) for t in SUSPICIOUS_TLDS])


def has_promo_pattern(col) -> Column:
    d = _c(col)
    kw = reduce(lambda a, b: a | b, [F.locate(k, d) > 0 for k in SUSPICIOUS_KEYWORDS])
    return kw | (hyphen_count(d) >= 2)


def not_noise(col) -> Column:
    """Not a search, social or archive site."""
    return ~_c(col).isin(*NOISE_DOMAINS)


def is_authority(col) -> Column:
    """Listed wire service or established local outlet."""
    return _c(col).isin(*AUTHORITY_DOMAINS)


def is_cdn(ip, asn, org) -> Column:
    """CDN by ASN, IP prefix or organisation keyword."""
    ip_c, asn_c, org_l = _c(ip), _c(asn), F.lower(F.coalesce(_c(org), F.lit("")))
    by_ip = reduce(lambda a, b: a | b, [F.startswith(F.coalesce(ip_c, F.lit("")), F.lit(p))
                                        for p in CDN_IP_PREFIXES])
    by_org = reduce(lambda a, b: a | b, [F.locate(k, org_l) > 0 for k in CDN_ORG_KEYWORDS])
    return F.coalesce(asn_c.isin(*CDN_ASNS), F.lit(False)) | by_ip | by_org


def author_norm(col) -> Column:
    return strip_ws(F.lower(_c(col)))


def valid_author(col) -> Column:
    """Normalised byline of at least 5 chars that is not a desk name."""
    n = author_norm(col)
    return (F.length(n) >= 5) & ~n.isin(*NOISE_AUTHORS)


def org_name(col) -> Column:
    """Organisation part of ``"AS13335 Name, Inc."``."""
    o = F.coalesce(_c(col), F.lit(""))
    pos = F.locate(" ", o)
    return F.when(pos > 0, F.substring(o, pos + 1, 1 << 20)).otherwise(o)


def org_asn(col) -> Column:
    """ASN part of ``"AS13335 Name, Inc."``, empty when absent."""
    o = F.coalesce(_c(col), F.lit(""))
    first = F.substring_index(o, " ", 1)
    return F.when(F.startswith(first, F.lit("AS")), first).otherwise(F.lit(""))


def pair_key(a, b) -> tuple[Column, Column]:
    """Order a pair so that ``domain_a < domain_b``."""
    return F.least(_c(a), _c(b)), F.greatest(_c(a), _c(b))
