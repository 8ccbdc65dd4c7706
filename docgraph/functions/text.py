"""Text, date, URL and hash expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docgraph.functions import fixed


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """One rule for the spellings of a missing value: null, ``''``, blanks and ``~``."""
    trimmed = F.trim(_col(c))
    return F.when(trimmed.isin("", "~"), None).otherwise(trimmed)


# -- document numbers -------------------------------------------------------------------

# issuer mark, year in any bracket, number; blanks may stand anywhere between the parts.
DOC_NUMBER = r"(\p{IsHan}{2,14}\s*[〔\[［(（【]\s*\d{4}\s*[〕\]］)）】]\s*第?\s*\d+\s*号)"
# Words that lead into a citation and are no part of the issuer mark.
LEAD_IN = "依据|根据|按照|遵照|参照|落实|贯彻|执行|废止|印发|转发|以及|详见|同时|文件|通知|和|及|与|的|见"


def norm_brackets(c: str | Column) -> Column:
    """Document number without blanks and with one form of brackets."""
    bare = F.regexp_replace(_col(c), r"[\s　]+", "")
    bare = F.regexp_replace(bare, r"[\[［(（【]", "〔")
    return F.regexp_replace(bare, r"[\]］)）】]", "〕")


def strip_lead_in(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), rf"^\p{{IsHan}}*(?:{LEAD_IN})(?=\p{{IsHan}}{{2,}}〔)", "")


def doc_numbers(c: str | Column, issuers: list[str] | None = None) -> Column:
    """All document numbers cited in a text, normalised and distinct.

    Han script has no blanks, so the words before an issuer mark look like part of it. With the
    known issuer marks given, a number is cut to the longest mark it ends on; otherwise the
    lead-in words are stripped, which may cost a mark that itself begins with such a word.
    """
    found = F.transform(F.regexp_extract_all(_col(c), F.lit(DOC_NUMBER), F.lit(1)),
                        lambda n: F.regexp_replace(norm_brackets(n), "〕第", "〕"))
    if issuers is None:
        return F.array_distinct(F.transform(found, strip_lead_in))
    marks_ = "|".join(r"\Q" + i + r"\E" for i in sorted(issuers, key=len, reverse=True))
    known = F.transform(found, lambda n: F.coalesce(
        F.nullif(F.regexp_extract(n, rf"((?:{marks_})〔.*)$", 1), F.lit("")), strip_lead_in(n)))
    return F.array_distinct(known)


def marks(c: str | Column, pattern: str) -> Column:
    """All matches of a caller's pattern, distinct; for corpora with other number forms."""
    return F.array_distinct(F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(0)))


# -- dates ------------------------------------------------------------------------------

def _date(text: Column, pattern: str, groups: tuple[int, ...] = (1, 2, 3)) -> Column:
    # A group the caller leaves out stands for the first month or day.
    parts = [F.nullif(F.regexp_extract(text, pattern, g), F.lit("")) for g in groups]
    while len(parts) < 3:
        parts.append(F.lit("01"))
    year, month, day = parts
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")),
                         "yyyy-MM-dd")


def extract_date(url: Column, body: Column, title: Column) -> Column:
    """Date from structured places, with the method; the first method that finds one wins."""
    full = F.coalesce(
        _date(url, r"/((?:19|20)\d\d)[-/](\d{1,2})[-/](\d{1,2})(?:\D|$)"),
        _date(url, r"[/t]((?:19|20)\d\d)(\d\d)(\d\d)(?:\D|$)"))
    month = _date(url, r"/((?:19|20)\d\d)[-/]?(0[1-9]|1[0-2])(?:/|$)", (1, 2))
    publish = _date(body, r"(?:发布时间|发布日期|published)\s*[:：]?\s*(\d{4})[-/.年](\d{1,2})[-/.月](\d{1,2})")
    chinese = _date(body, r"(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日")
    iso_title = _date(title, r"(\d{4})[-/.年](\d{1,2})[-/.月](\d{1,2})")
    year = _date(url, r"/((?:19|20)\d\d)(?:/|$)", (1,))
    found = [full, month, publish, chinese, iso_title, year]
    tried = [F.when(d.isNotNull(), F.struct(d.alias("date"), F.lit(m).alias("method")))
             for d, m in zip(found, fixed.DATE_METHODS)]
    return F.coalesce(*tried)


TIMESTAMP_FORMS = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss",
                   "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]


def timestamp(c: str | Column) -> Column:
    """Timestamp from any of the spellings in use; null if none fits."""
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(f)) for f in TIMESTAMP_FORMS])


# -- URLs, titles, links ----------------------------------------------------------------

def host(c: str | Column) -> Column:
    """Host of a URL in lower case; null where the text is no URL."""
    # regexp instead of parse_url: that one raises on malformed addresses in ANSI mode.
    found = F.regexp_extract(_col(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def norm_title(c: str | Column) -> Column:
    """Title for matching: without brackets, bracketed remarks, symbols, blanks; lower case."""
    bare = F.regexp_replace(_col(c), r"[(（〔\[【][^)）〕\]】]*[)）〕\]】]", "")
    return F.lower(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", ""))


def wiki_links(c: str | Column) -> Column:
    """Targets of ``[[stem|id]]`` (the id) or ``[[id]]``."""
    found = F.regexp_extract_all(_col(c), F.lit(r"\[\[([^\[\]]+)\]\]"), F.lit(1))
    return F.transform(found, lambda s: F.element_at(F.split(s, r"\|"), -1))


def links(c: str | Column, pattern: str = r'<a href="([^"]*)"') -> Column:
    """Link targets in a marked-up text."""
    return F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(1))


def snippet(text: Column, hit: Column, reach: int = 30) -> Column:
    """The hit with ``reach`` characters on either side; null if the hit does not occur."""
    return snippet_at(text, F.position(hit, text), F.length(hit), reach)


def snippet_at(text: Column, pos: Column, width: Column, reach: int = 30) -> Column:
    start = F.greatest(F.lit(1), pos - reach)
    return F.when(pos > 0, F.substring(text, start, pos + width + reach - start))


def location(pos: Column, length: Column, opening: int = fixed.OPENING_CHARS) -> Column:
    """Where in a text a position lies: its opening, its last tenth, or the body."""
    return (F.when(pos <= opening, "opening")
            .when(pos * 10 > length * 9, "supplementary")
            .otherwise("body"))


def headings(c: str | Column) -> Column:
    """Second-level headings of a body."""
    return F.regexp_extract_all(_col(c), F.lit(r"(?m)^##\s+(.+?)\s*$"), F.lit(1))


# -- hashes, words, style ---------------------------------------------------------------

def hash_id(prefix: str, *parts: Column, width: int = 12) -> Column:
    """``prefix`` and the first ``width`` hex digits of the parts' SHA-256."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, width))


def words(c: str | Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(_col(c)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def term_hits(c: str | Column, terms: list[str]) -> Column:
    """All occurrences of any of the terms, found in one pass over the text."""
    quoted = "|".join(r"\Q" + t + r"\E" for t in sorted(terms, key=len, reverse=True))
    return F.regexp_extract_all(_col(c), F.lit(f"({quoted})"), F.lit(1))


EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{FE0F}]"


def sanitize(c: str | Column, replace: dict[str, str] | None = None,
             drop: str = EMOJI) -> Column:
    """Replace wordings that reports must not carry and drop symbols matching ``drop``."""
    out = _col(c)
    for old, new in (fixed.SANITIZE if replace is None else replace).items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.regexp_replace(out, drop, "")
