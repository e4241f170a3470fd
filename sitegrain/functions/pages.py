"""Functions of fetched pages as Column builders: fetch verdicts, content quality and the parts of a page's text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrain.functions.text import col, contains_any, squeeze

# Phrases of challenge pages, content networks, parked domains, sign-in pages and pages not ready yet.
CHALLENGE = ["just a moment", "checking your browser", "please enable cookies", "enable javascript and cookies", "ddos-guard", "perimeterx", "incapsula", "request unsuccessful"]
NETWORK = ["cloudflare", "akamai", "ray id", "enable javascript", "access denied"]
PARKED_TEXT = ["godaddy", "this domain is for sale", "buy this domain", "domain parking", "parked domain", "namecheap", "porkbun", "sedo", "afternic", "hugedomains", "domain.com is for sale", "register.com"]
PARKED_URL = ["godaddy.com/forsale", "sedoparking.com", "parkingcrew", "dan.com", "afternic.com"]
LOGIN = ["sign in to continue", "please log in", "login required", "you must be logged in"]
SOON = ["coming soon", "under construction", "launching soon", "site is under maintenance"]
DNS_ERROR = ["nodename nor servname provided", "name or service not known", "could not resolve host", "errno 8", "errno 11001", "temporary failure in name resolution"]
SSL_ERROR = ["sslv3_alert_handshake_failure", "handshake failure", "ssl handshake", "tlsv1 alert", "certificate verify failed", "ssl:", "tls connect error"]
HARD_BLOCK = r"your access to this (site|service) has been limited|wordfence|http response code 503|error 503|503 service temporarily|web server is down|cf-browser-verification|incapsula incident|request unsuccessful\. incapsula"
SOFT_BLOCK = r"just a moment\.\.\.|checking your browser before|attention required!|enable javascript and cookies to continue|please verify you are (a )?human|verify you are (a )?human|complete the captcha|are you a human\?|this process is automatic\. your browser will redirect"
SMALL, TINY, LARGE, SHELL = 5000, 500, 10_000, 300


def _html(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def is_parked(html: Column | str, final_url: Column | str, status: Column | str) -> Column:
    """True for a parked domain: by its final URL, a tiny page of status 200, or a parking phrase on a small page."""
    x, code = _html(html), F.coalesce(col(status), F.lit(0))
    seen = contains_any(final_url, PARKED_URL) | ((code == 200) & (F.length(x) < TINY)) | ((F.length(x) < SMALL) & contains_any(x, PARKED_TEXT))
    return (code != 0) & seen


def is_blocked(status: Column | str, html: Column | str) -> Column:
    """True for a refused or challenged fetch."""
    x = _html(html)
    return F.coalesce(col(status), F.lit(0)).isin(403, 429, 503) | (F.length(x) < TINY) | contains_any(x, CHALLENGE) | ((F.length(x) < SMALL) & contains_any(x, NETWORK))


def is_real_content(status: Column | str, html: Column | str) -> Column:
    """True for a page of status 200 that is not small."""
    return F.coalesce(col(status) == 200, F.lit(False)) & (F.length(_html(html)) > SMALL)


def is_block_page(text: Column | str) -> Column:
    """True where the text's beginning has a definite block phrase, or a short text any challenge phrase."""
    low = F.lower(F.substring(_html(text), 1, 6000))
    return low.rlike(HARD_BLOCK) | ((F.length(_html(text)) < 2500) & low.rlike(SOFT_BLOCK))


def error_class(message: Column | str) -> Column:
    """'dns', 'ssl' or '' for an error message."""
    return F.when(contains_any(message, DNS_ERROR), "dns").when(contains_any(message, SSL_ERROR), "ssl").otherwise("")


def visible_text(html: Column | str) -> Column:
    """The text without scripts, styles and tags, white space squeezed."""
    x = F.regexp_replace(_html(html), r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"\s+", " "))


def content_quality(html: Column | str) -> Column:
    """'challenge', 'login_wall', 'coming_soon', 'spa_shell' or 'ok', the first that holds."""
    x = _html(html)
    n = F.length(x)
    challenge = contains_any(x, CHALLENGE) | ((n < SMALL) & contains_any(x, NETWORK))
    shell = (n >= LARGE) & (F.length(visible_text(x)) < SHELL)
    kind = F.when(challenge, "challenge").when(contains_any(x, LOGIN), "login_wall").when((n < LARGE) & contains_any(x, SOON), "coming_soon").when(shell, "spa_shell").otherwise("ok")
    return F.when(n == 0, "ok").otherwise(kind)


def _inner(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"\s+", " "))


def page_title(html: Column | str) -> Column:
    """The text of the title element, '' without one."""
    return _inner(F.regexp_extract(_html(html), r"(?is)<title[^>]*>(.*?)</title>", 1))


def headings(html: Column | str, cut: int = 200) -> Column:
    """The texts of all h1, then h2, then h3 elements, none empty or longer than ``cut``."""
    found = F.concat(*[F.regexp_extract_all(_html(html), F.lit(rf"(?is)<h{i}\b[^>]*>(.*?)</h{i}>"), 1) for i in (1, 2, 3)])
    return F.filter(F.transform(found, _inner), lambda t: (t != "") & (F.length(t) <= cut))


def meta_content(html: Column | str, limit: int = 10) -> Column:
    """The contents of description and og: meta elements."""
    found = F.regexp_extract_all(_html(html), F.lit(r"""(?is)<meta\b[^>]*(?:name|property)\s*=\s*["']?(?:description|og:[^"'\s>]*)["']?[^>]*\bcontent\s*=\s*["']([^"']*)["']"""), 1)
    return F.slice(F.filter(F.transform(found, lambda t: F.trim(t)), lambda t: t != ""), 1, limit)


def footer_text(html: Column | str, cut: int = 1500) -> Column:
    """The text of the footer element, '' without one."""
    return F.substring(_inner(F.regexp_extract(_html(html), r"(?is)<footer\b[^>]*>(.*?)</footer>", 1)), 1, cut)


def contact_links(html: Column | str, limit: int = 20) -> Column:
    """The distinct phone and mail links."""
    return F.slice(F.array_distinct(F.regexp_extract_all(_html(html), F.lit(r"""(?i)href\s*=\s*["']((?:tel|mailto):[^"']+)["']"""), 1)), 1, limit)


def json_ld(html: Column | str) -> Column:
    """The bodies of ld+json scripts as they are."""
    return F.regexp_extract_all(_html(html), F.lit(r"""(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script>"""), 1)


def structured_data(html: Column | str) -> Column:
    """array of struct(type, name, telephone, address): what the page's ld+json objects say, single ones, lists and graphs
    alike. An address that is an object is its JSON text; broken scripts and objects without a type give nothing.
    """
    parts = "`@type`:string,name:string,telephone:string,address:string"
    lists = F.filter(F.transform(json_ld(html), lambda j: F.from_json(j, f"array<struct<{parts},`@graph`:array<struct<{parts}>>>>")), lambda a: a.isNotNull())

    def fields(x: Column) -> Column:
        return F.struct(x["@type"].alias("type"), x["name"].alias("name"), x["telephone"].alias("telephone"), x["address"].alias("address"))

    each = F.transform(F.flatten(lists), lambda x: F.when(x["@graph"].isNotNull(), F.transform(x["@graph"], fields)).otherwise(F.array(fields(x))))
    return F.filter(F.flatten(each), lambda x: x["type"].isNotNull())


def map_addresses(html: Column | str) -> Column:
    """The distinct place queries of embedded maps and map links, decoded."""
    found = F.regexp_extract_all(_html(html), F.lit(r"""(?i)(?:maps\.google\.[a-z.]+|google\.[a-z.]+/maps)[^"'\s>]*[?&](?:q|daddr|destination)=([^&"'\s>]+)"""), 1)
    return F.array_distinct(F.filter(F.transform(found, lambda u: F.substring(F.coalesce(F.try_url_decode(u), F.lit("")), 1, 200)), lambda t: F.length(t) > 5))


def data_addresses(html: Column | str) -> Column:
    """The distinct values of data-address and data-label attributes, line breaks as bars."""
    found = F.regexp_extract_all(_html(html), F.lit(r"""(?is)\bdata-(?:label|address|addr|street)\s*=\s*["']([^"']+)["']"""), 1)
    return F.array_distinct(F.transform(found, lambda t: F.substring(F.regexp_replace(t, r"(?i)\s*(&lt;|<)br\s*/?(&gt;|>)\s*", " | "), 1, 200)))


def microdata(html: Column | str) -> Column:
    """The distinct texts of address itemprops in the page's order."""
    found = F.regexp_extract_all(_html(html), F.lit(r"""(?is)itemprop\s*=\s*["'](?:streetAddress|addressLocality|addressRegion|postalCode)["'][^>]*>([^<]+)<"""), 1)
    return F.array_distinct(F.filter(F.transform(found, lambda t: F.trim(t)), lambda t: t != ""))


def script_addresses(html: Column | str) -> Column:
    """The distinct street values of address objects within scripts."""
    found = F.regexp_extract_all(_html(html), F.lit(r"""(?i)["'](?:street|streetAddress|address1|address_line_1|address)["']\s*:\s*["']([^"']+)["']"""), 1)
    return F.array_distinct(found)


def page_sections(html: Column | str, url: Column | str, body_cut: int = 20_000) -> Column:
    """One text of the page's parts, each under its label, empty parts left out."""
    body = F.substring(visible_text(html), 1, body_cut)
    parts = [("PAGE", F.coalesce(col(url), F.lit(""))), ("TITLE", page_title(html)), ("HEADINGS", F.array_join(headings(html), " | ")), ("META", F.array_join(meta_content(html), " | ")), ("CONTACT LINKS", F.array_join(contact_links(html), " | ")), ("FOOTER", footer_text(html)), ("BODY", body)]
    return squeeze(F.concat_ws("\n\n", *[F.when(v != "", F.concat(F.lit(f"{k}: "), v)) for k, v in parts]))


def needs_raw_text(html: Column | str, body: Column | str) -> Column:
    """True where the body is short, or misses a postal code or phone that the raw text has."""
    raw, text = visible_text(html), F.coalesce(col(body), F.lit(""))
    lost = [raw.rlike(p) & ~text.rlike(p) for p in (r"\b\d{5}(-\d{4})?\b", r"\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}")]
    return (F.length(text) < 500) | lost[0] | lost[1]


def main_text(html: Column | str) -> Column:
    """The texts of the page's paragraphs, one a line: a plain rule for the main content, without navigation and footers
    that are no paragraphs.
    """
    found = F.regexp_extract_all(_html(html), F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), 1)
    return F.array_join(F.filter(F.transform(found, _inner), lambda t: t != ""), "\n")


def heading_blocks(html: Column | str, cut: int = 100) -> Column:
    """array of struct(heading, text): each h1 to h4 of at most ``cut`` characters with the text up to the next one."""
    parts = F.split(_html(html), r"(?i)<h[1-4]\b[^>]*>")
    parts = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    blocks = F.transform(parts, lambda p: F.struct(_inner(F.regexp_extract(p, r"(?is)^(.*?)</h[1-4]", 1)).alias("heading"), visible_text(F.regexp_replace(p, r"(?is)^.*?</h[1-4][^>]*>", "")).alias("text")))
    return F.filter(blocks, lambda b: (b["heading"] != "") & (F.length(b["heading"]) <= cut))
