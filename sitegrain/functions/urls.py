"""URL keys and parts as Column builders. Null URLs count as empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrain.functions.text import clean, col, lower_trim

LINK = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
# What marks a page as one with places, as one to skip, and as a specialty's page.
LOCATION_HINT = r"(?i)(location|office|clinic|center|centre|contact|find-a|where|visit|direction|site)s?\b"
SKIP_HINT = r"(?i)(privacy|terms|career|job|blog|news|leadership|team|provider|doctor|staff|login|patient-portal|sitemap|cookie|accessibility)s?\b"
SPECIALTY_OF_PATH = {
    "cardiolog": "Cardiology", "dermatolog": "Dermatology", "neurolog": "Neurology", "gastro": "Gastroenterology", "endocrin": "Endocrinology", "rheumatolog": "Rheumatology", "oncolog": "Oncology", "hematolog": "Hematology", "nephrolog": "Nephrology", "pulmonolog": "Pulmonology",
    "urolog": "Urology", "ophthalmolog": "Ophthalmology", "psychiatr": "Psychiatry", "allerg": "Allergy/Immunology", "infectious": "Infectious Disease", "orthop": "Orthopedics", "fertilit": "OB-GYN/Fertility", "pain": "Pain Management", "podiatr": "Podiatry",
}


def page_key(url: Column | str) -> Column:
    """Lower-case URL without scheme, leading ``www.``, query, fragment and trailing slashes."""
    x = F.regexp_replace(F.lower(clean(url)), r"[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(x, r"^[a-z][a-z0-9+.-]*://", ""), r"^www\.|/+$", "")


def segments(url: Column | str) -> Column:
    """The non-empty path segments, lower case, in order."""
    return F.filter(F.slice(F.split(page_key(url), "/"), 2, 1_000_000), lambda s: s != "")


def norm_url(url: Column | str) -> Column:
    """Lower-case host and path without ``www.`` and trailing slashes; query and fragment go."""
    x = F.regexp_replace(F.regexp_replace(lower_trim(url), r"^https?://", ""), r"[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(x, r"^www\.", ""), r"/+$", "")


def dedup_key(url: Column | str) -> Column:
    """The URL without http scheme, ``www.`` and trailing slashes, in lower case; query and fragment stay."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(col(url), F.lit("")), r"^https?://(www\.)?", ""), r"/+$", ""))


def url_host(url: Column | str) -> Column:
    """The lower-case host without ``www.``."""
    return F.regexp_replace(F.regexp_extract(F.regexp_replace(lower_trim(url), r"^https?://", ""), r"^([^/?#]*)", 1), r"^www\.", "")


def page_url(url: Column | str) -> Column:
    """The URL without query, fragment and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(col(url), F.lit("")), r"[?#].*$", ""), r"/+$", "")


def parent_path(url: Column | str) -> Column:
    """The path of the URL without its last segment, '/' for pages at the top."""
    s = segments(url)
    return F.concat(F.lit("/"), F.array_join(F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))), "/"))


def links(html: Column | str, domain: Column | str) -> Column:
    """The link targets of a page in order, made absolute: rooted, scheme-less and relative ones stand on ``domain``.
    Anchors within the page, mail, phone and script links are left out.
    """
    found = F.regexp_extract_all(F.coalesce(col(html), F.lit("")), F.lit(LINK), 1)
    kept = F.filter(found, lambda u: ~F.lower(u).rlike(r"^(#|mailto:|tel:|javascript:)"))
    base = F.concat(F.lit("https://"), col(domain))
    return F.transform(
        kept,
        lambda u: F.when(u.rlike("(?i)^https?://"), u).when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.startswith("/"), F.concat(base, u)).otherwise(F.concat(base, F.lit("/"), u)),
    )


def is_internal(url: Column, domain: Column | str) -> Column:
    """True where the host is the domain or one below it."""
    host, own = url_host(url), F.regexp_replace(F.lower(col(domain)), r"^www\.", "")
    return (host == own) | F.endswith(host, F.concat(F.lit("."), own))


def has_location_signal(url: Column | str) -> Column:
    """True where the URL speaks of places and of nothing that is to be skipped."""
    return F.coalesce(col(url), F.lit("")).rlike(LOCATION_HINT) & ~F.coalesce(col(url), F.lit("")).rlike(SKIP_HINT)


def specialties_of(url: Column | str) -> Column:
    """The labels of the specialties named in the URL's path, sorted and distinct."""
    path = F.concat(F.lit("/"), F.array_join(segments(url), "/"))
    found = [F.when(path.contains(k), F.lit(v)) for k, v in SPECIALTY_OF_PATH.items()]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))


def humanised(domain: Column | str) -> Column:
    """The domain without its last label, dashes and underscores as blanks."""
    return F.translate(F.regexp_replace(F.coalesce(col(domain), F.lit("")), r"\.[^.]*$", ""), "-_", "  ")


def host_variants(domain: Column | str) -> Column:
    """The addresses under which a site is tried, in order."""
    return F.array(*[F.concat(F.lit(p), col(domain)) for p in ("https://", "https://www.", "http://", "http://www.")])


def query_param(url: Column | str, name: str) -> Column:
    """The decoded value of a query parameter, '' where it is missing; a malformed escape gives ''."""
    raw = F.regexp_extract(F.coalesce(col(url), F.lit("")), rf"[?&]{name}=([^&#]*)", 1)
    return F.coalesce(F.try_url_decode(raw), F.lit(""))


def cache_key(url: Column | str) -> Column:
    """A file name for the URL: its first 80 safe characters and eight of its MD5."""
    return F.concat(F.substring(F.regexp_replace(col(url), r"[^\w.-]", "_"), 1, 80), F.lit("__"), F.substring(F.md5(col(url)), 1, 8), F.lit(".html"))
