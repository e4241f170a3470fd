"""Problem 2: template residue and error pages.

Lines of each page are counted by host in a masked form (numbers made alike); forms that recur on a large share of a
host's pages are boilerplate and are subtracted, and so is what every site puts around its pages. A page is excluded if
what stays shows an error message, a placeholder, filler or a notice that scripts, a sign-in or time are needed, and
next to no other words.
Lines that show such evidence are never subtracted. All expressions run in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.functions.text import clean
from sitegrain.functions.urls import page_key
from sitegrain.sources.tables import materialize, table

SLOT = (
    r"\{\{[^{}]*\}\}|\$\{[^{}]*\}|<%[^%<]*%>|%%\w+%%|@@[\w.]+@@|__[A-Za-z][\w.]*__|\[\[[^\[\]]*\]\]|\{#?[A-Za-z_][\w.|]*\}|\{%[^%{]*%\}|\[[a-z]+(_[a-z]+)*\]"
)
# The phrases that stand behind the number of an HTTP error; a bare number may be that of a house.
REASON = (
    r"(bad request|unauthori[sz]ed|payment required|forbidden|(page |file )?not found|method not allowed|not acceptable|proxy auth|request time-?out|conflict|gone\b|(payload|entity|uri|url) too|unsupported media|"
    r"too many requests|unavailable for legal|(internal )?server error|not implemented|bad gateway|(service )?(temporarily )?unavailable|gateway time-?out|access denied|no encontrad)"
)
NOTICES = (
    # errors
    rf"^(http )?(error|status)( code)?[ :#-]*[45]\d\d\b.{{0,60}}$|^(http )?[45]\d\d\W*$|^(http )?[45]\d\d\b\W*(error\b|{REASON})",
    r"\b(page not found|bad gateway|gateway time-?out|internal server error|service (temporarily )?unavailable|not acceptable|too many requests)\b",
    r"^(access )?(forbidden|denied)\b|access denied|permission denied|lost that page|does not exist any more|no longer exists|page is gone|page (cannot|can't|could not) be found",
    r"\b(database connection|sqlstate|stack trace|traceback|nullreference|nullpointer|unhandled exception|uncaught \w*error|fatal error|parse error|failed to open stream|segmentation fault)",
    r"^warning: |^exception in |application error|client-side exception|something went wrong|bandwidth limit|account (has been )?suspended|quota exceeded|session (has )?expired|request timed out",
    # scripts needed, visitor checks
    r"(enable|activate|turn on|switch on|allow|activar?|active|habilite) (java ?scripts?|scripts?)\b|(java ?scripts?|scripts) (is|are|must be|has been) (disabled|blocked|off|required|needed|enabled|allowed|turned off)|requires (java ?script|scripts)|no ejecuta scripts",
    r"security check|checking your browser|check your browser|not a robot|are (you )?human|testing your connection|verify(ing)? (that )?you|captcha|ddos protection|tick the box",
    # sign-in, not ready yet
    r"(sign|log) ?in to (continue|view|proceed|see)|members only|login required|must (be logged|sign|log) in",
    r"^(site )?under construction|coming soon|check back (later|soon)|being built here|site is on its way|planned maintenance|down for maintenance|scheduled maintenance|under maintenance|launching soon|domain is (parked|for sale)",
)
FILLERS = (
    r"\blorem\b.{0,80}\bipsum\b|\bipsum\b.{0,80}\blorem\b|dolor sit amet|sample text\b|dummy (copy|text)|placeholder (paragraph|text)|^(asdf|jkl|qwer\w*|xx+|blah|test|foo|bar|text)( (asdf|jkl|qwer\w*|xx+|blah|test|foo|bar|text))*\W*$|blah blah|text text text|body copy to follow|(your|body|main) (text|copy) (here|to follow)|hello world!|first post of this theme",
    r"^(title|text|heading|headline|content|description) goes here|describe your (clinic|practice|company|business)|insert (headline|paragraph|text|title|image|your)|^your (company|practice|clinic|business) name|welcome to your (practice|clinic|company|site)\b|(text|page) (in the page builder|builder)|click to (select|edit)|edit this text|replace (it|this) before|delete or edit it",
    r"^\[[^\]]{2,80}\]$",
)
NOTICE, FILLER = ("|".join(x) for x in (NOTICES, FILLERS))
# Both are tried on lower-case lines. What sites put around their pages: consent, legal lines, teasers and ways back.
CHROME = "|".join((
    r"\b(cookies?|tracking files|store small files)\b|\b(reject|accept) all\b|^©|^\(c\) |^copyright\b|\ball rights reserved\b",
    r"^(site map|sitemap|terms of (use|service)|privacy (policy|notice))\b|\bfollows civil rights law\b|\breplaces the advice of your (own )?doctor\b|\bwork better with javascript\b",
    r"^(related|most read|latest news|upcoming|see also|read next|you may also like)\b ?:|^(subscribe to|sign up for)\b.{0,60}\b(news)?letter\b|^follow\b.{0,60}\b(networks|social media|facebook|twitter|instagram)\b|^book now\b|\b(back to|return to|visit) (the |our )?home ?page\b",
))
BLOCKS = "p|div|li|ul|ol|h[1-6]|td|th|tr|table|section|article|main|aside|header|footer|nav|dialog|button|form|title|br|body|html|noscript|dl|dt|dd|pre|blockquote"


def visible_lines(html: Column) -> Column:
    """The page's lines: one for each block element's text, white space squeezed, common entities decoded."""
    x = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|head|template)\b.*?</\1\s*>", " ")
    x = F.regexp_replace(x, r"\s+", " ")
    x = F.regexp_replace(x, rf"(?i)</?(?:{BLOCKS})\b[^>]*>", "\n")
    x = F.regexp_replace(x, r"</?[A-Za-z][^>]*>", "")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(char))
    lines = F.transform(F.split(x, "\n"), lambda v: F.trim(F.regexp_replace(v, r"[\s ]+", " ")))
    return F.filter(lines, lambda v: v != "")


def masked(line: Column) -> Column:
    """The line with numbers as #."""
    return F.regexp_replace(line, r"\d+", "#")


def page_lines(real: DataFrame, notice_words: int) -> DataFrame:
    """(ord, domain, page, shape, evidence, content) of every line; ``page`` is the hash of the URL's ``page_key``.

    ``content`` counts the words that a page's own text may consist of: those of other lines than evidence and
    ``CHROME`` that have seven words, or three and a digit (phones, hours, addresses). A notice has no more than
    ``notice_words``, what its line has beyond is content; filler and unfilled slots have none at any length.
    """
    lines = real.select("ord", F.coalesce("domain", F.lit("")).alias("domain"), F.xxhash64(page_key("url")).alias("page"), F.explode(visible_lines(F.col("html"))).alias("line"))
    low = lines.withColumns({"low": F.lower("line"), "words": F.size(F.split("line", " "))})
    tried = low.withColumns({"filler": F.col("low").rlike(FILLER) | F.col("line").rlike(SLOT), "notice": F.col("low").rlike(NOTICE)})
    words = F.col("words")
    own = ((words >= 7) | ((words >= 3) & F.col("line").rlike(r"\d"))) & ~F.col("low").rlike(CHROME)
    content = F.when(F.col("filler"), 0).when(F.col("notice"), F.greatest(words - notice_words, F.lit(0))).when(own, words).otherwise(0)
    return tried.select("ord", "domain", "page", F.xxhash64(masked(F.col("line"))).alias("shape"), (F.col("filler") | F.col("notice")).alias("evidence"), content.alias("content"))


def error_pages(pages: DataFrame, host_share: float = 0.5, host_repeats: int = 3, notice_words: int = 60, kept_words: int = 8) -> DataFrame:
    """``ord`` of the pages (``ord, domain, url, html``) that show no real page.

    A masked line is boilerplate if ``host_share`` of the host's different pages, and ``host_repeats`` at least, have it;
    other hosts' pages count for nothing. A page is reported if it has an evidence line and at most ``kept_words`` words
    of content (see ``page_lines``) that are no boilerplate. Pages of null or blank html are never reported; an empty
    table gives no row.
    """
    real = pages.where(clean("html") != "")
    lines = materialize(page_lines(real, notice_words), "p2-lines")
    n_pages = lines.groupBy("domain").agg(F.count_distinct("page").alias("n_pages"))
    by_host = lines.where("content > 0 and not evidence").groupBy("domain", "shape").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= host_repeats)
    common = by_host.join(n_pages, "domain").where(F.col("n") >= host_share * F.col("n_pages")).select("domain", "shape")
    suspects = lines.where("evidence").select("ord").distinct()
    rest = lines.join(suspects, "ord", "left_semi").where("content > 0")
    rest = rest.where("evidence").unionByName(rest.where("not evidence").join(common, ["domain", "shape"], "left_anti").select(rest.columns))
    real_text = rest.groupBy("ord").agg(F.sum("content").alias("n")).where(F.col("n") > kept_words)
    return suspects.join(real_text, "ord", "left_anti")


SLOT_VALUE = rf"{SLOT}|<[A-Za-z][\w .]*>|%[A-Za-z][\w.]*%|#[A-Za-z][\w.]*#|\[[A-Za-z][\w .]*\]|\$[A-Z_]+\b"
EMPTY_VALUE = r"^\W*(null|undefined|nan|none|n/?a|tbd|tba|unknown|nil|#ref!|#n/a|#value!|\[object object\]|tel:)(\W+(null|undefined|nan|none|unknown))*\W*$"
FILLER_VALUE = r"lorem\s+ipsum|dolor sit|ipsum dolor|\basdf\b|\bqwerty\b|\bblah\b|^(test|foo|bar)( (test|foo|bar))*\W*\d*$|^[x ]{3,}\W*\d*$|^\W*[x#n_]+(\W+[x#n_]+)+\W*$"
MESSAGE_VALUE = (
    r"java ?script|\bscripts? must\b|cannot read|\buncaught\b|typeerror|fatal error|^error\b|\berror \d+|exception|access denied|^(\d{3} )?(not found|forbidden)$|^[45]\d\d (not found|forbidden|bad gateway|internal server error|service unavailable)|timed out|unavailable|failed to load|lookup failed|^loading\b|\bloading\.\.\.|"
    r"^(enter|type|add|insert|your|please|click|see|contact|call us)\b[^0-9]*$|goes here|\bhere$|^address line|^street (name|address|no)|^phone( number)?\W*$|^(tel|fax|telephone|phone|address|street)\W*$|call us at \W*\[?phone"
)
STREET_KIND = r"(street|str|st|avenue|ave|av|road|rd|lane|ln|drive|dr|boulevard|blvd|way|court|ct|place|pl)"
DUMMY_WORD = r"(sample|example|demo|test|testing|fake|any|anywhere|your|dummy|placeholder|some|sesame|nowhere|my|our)"
DUMMY_STREET = rf"^\W*(\d+ )?{DUMMY_WORD} {STREET_KIND}\b\.?( \d+)?\W*$|^123 (main|research|study|elm|fake) {STREET_KIND}\b\.?\W*$|^0+ "


def dummy_text(c: Column | str) -> Column:
    """A non-blank value that is an unfilled slot, an empty marker, filler or a message; null gives false."""
    v = clean(c)
    low = F.lower(v)
    return (v != "") & (v.rlike(SLOT_VALUE) | low.rlike(EMPTY_VALUE) | low.rlike(FILLER_VALUE) | low.rlike(MESSAGE_VALUE))


def dummy_street(c: Column | str) -> Column:
    """A street that was never an address: ``dummy_text``, or a sample such as ``12 Example Street``."""
    return dummy_text(c) | F.lower(clean(c)).rlike(DUMMY_STREET)


def dummy_phone(c: Column | str) -> Column:
    """A phone that was never a number: ``dummy_text``, no or too few digits, one digit only, a run, or exchange 555."""
    v = clean(c)
    digits = F.regexp_replace(F.regexp_replace(F.lower(v), r"(ext|x)\.?\s*\d+$", ""), "[^0-9]", "")
    number = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    fake = number.rlike(r"^(\d)\1+$|^1234567890$|^0123456789$|^9876543210$|^1?234567$|0{7}$|^\d{3}555\d{4}$|^555\d{4}$|^555\d{7}$") | (F.length(number) < 7)
    return (v != "") & (dummy_text(c) | fake)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that show no real page, and locations whose street or phone was never data."""
    pages = error_pages(table(spark, sf_dir, "page_fetch").select("ord", "domain", "url", "html"))
    loc = table(spark, sf_dir, "locations").where(dummy_street("address_street") | dummy_phone("phone"))
    return pages.select(F.lit("page_fetch").alias("src"), F.col("ord").cast("long").alias("ord")).unionByName(loc.select(F.lit("locations").alias("src"), F.col("ord").cast("long").alias("ord")))
