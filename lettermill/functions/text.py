"""Text functions as Column expressions: URLs, HTML, residual markup, delivery artefacts, tokens, subjects, shingles.

Patterns follow the meaning that they have in Unicode-aware, newline-strict engines: U gives \\s, \\w and \\b their
Unicode classes, d makes \\n the only line end. White space also means the four separators \\x1c-\\x1f, which Java's
class leaves out, and word characters are letters, numbers and the underscore, without combining marks.
"""

from __future__ import annotations

import functools
import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

S = r"[\s\x1c-\x1f]"
W = r"[\p{L}\p{N}_]"
#: Word characters and the hyphen.
H = r"[\p{L}\p{N}_-]"

# URL forms, in text, spaced out, and at the start of a link. Repeats are possessive: what follows one
# never needs a character of it back, and Java's matcher then goes on without recursion, however long the text is.
URL = r"(?dUi)(?:(?:https?|ftps?|hxxps?|fxps?)://|www\d{0,3}\.)[^\s\x1c-\x1f<>\"'`)\]}]++"
SPACED_SCHEME = (
    rf"(?dUi)(?:https?|ftps?|hxxps?|fxps?){S}*+:{S}*+/{S}*+/"
    rf"(?:{S}*+{H}++(?:{S}*+\.{S}*+{H}++)*+(?:{S}*+/{S}*+[^\s\x1c-\x1f]*+)*+)?"
)
SPACED_WWW = rf"(?dUi)www\d{{0,3}}(?:{S}*+\.{S}*+{H}++)++(?:{S}*+/{S}*+[^\s\x1c-\x1f]++)*+"
WEB_LINK = r"(?dUi)^(?:https?|ftps?|hxxps?|fxps?)://|^www\d{0,3}\."

# Parts of HTML.
SCRIPT_STYLE = rf"(?dUis)<(script|style)(?!{W}).*?</\1>"
TAG = r"(?dUs)<[^>]++>"
LINK_ATTRIBUTE = rf"(?dUi)(?<!{W})(?:href|src|action){S}*+={S}*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\x1c-\x1f>]++))"

# Residual markup.
BASE64_RUN = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{50,}+={0,2}"
#: A name and its block in braces, for a reversed text: each block is found by its brace, not by every letter before.
CSS_BLOCK_REVERSED = rf"(?dU)\}}[^{{}}]{{0,600}}+\{{{S}*+{H}*[A-Za-z][.#]?"
SHORT_TAG = r"<[^<>]{0,400}+>"
#: Looked for once in each run of word characters and hyphens; what comes before the name in a run is group 1.
MARKUP_ATTRIBUTE = rf"(?dUi)(?<!{H})((?:(?:(?![a-z]){W}++)?+-)*+)[a-z]{H}*+{S}*+={S}*+\"[^\"]{{0,200}}+\""
CSS_PROPERTIES = (
    "font-size", "font-family", "line-height", "padding", "margin", "background", "border",
    "cellpadding", "cellspacing", "valign", "text-align", "font-weight", "width", "height",
)
CSS_PROPERTY = rf"(?dUi)(?=[flpmbcvtwh])(?<!{W})(?:{'|'.join(CSS_PROPERTIES)}){S}*+[:=]{S}*+[^;{{}}\n,\"]{{0,40}}+;?"

# Header names that quoted mail repeats.
QUOTED_HEADERS = (
    "from", "to", "cc", "bcc", "sent", "date", "subject", "reply-to", "return-path", "sender",
    "message-id", "in-reply-to", "references", "importance", "priority", "mime-version",
    "content-type", "content-transfer-encoding", "received", "delivered-to",
    "authentication-results", "dkim-signature", "received-spf", "organization",
)
# Lines that mail programs add. A block's quoted headers need no part here: they go line by line after it.
DELIVERY_LINES = (
    rf"(?dUim)^[ \t>|]*+-++{S}*+original message{S}*+-++.*+$",
    rf"(?dUim)^.*(?<!{W})forwarded by(?!{W}).*+$",
    rf"(?dUim)^[ \t>|]*+-++{S}*+forwarded message{S}*+-++.*+$",
    rf"(?dUim)^[ \t>|]*+on(?!{W}).{{0,200}}(?<!{W})wrote:[ \t]*+$",
    r"(?dm)^_{5,}+[ \t]*+$",
    rf"(?dUim)^[ \t>|]*+(?:{'|'.join(QUOTED_HEADERS)}|x-{H}++)[ \t]*+:.*+$",
)

# Words and domains that give a corpus away.
CORPUS_DOMAINS = ("enron.com", "lists.sourceforge.net", "sourceforge.net")
CORPUS_TOKENS = ("enron", "ect", "hou", "sourceforge", "exmh", "spamassassin", "razor", "freshrpms", "xent", "zzzteana")

# Reply and forward prefixes of subjects, and message ids.
REPLY_PREFIX = rf"(?dUi)^(?:{S}*+(?:re|fwd?|aw|wg|sv|vs|rv|rif|tr|fyi){S}*+(?:\[\d++\])?{S}*+:{S}*+)++"
MESSAGE_ID = r"<[^<>\s\x1c-\x1f]++>"


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c bound as a variable, so that it is computed once however often f names it."""
    return F.element_at(F.transform(F.array(c), f), 1)


def collapse(c: Column) -> Column:
    """White space runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"(?dU){S}++", " "))


def _unescape(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return run(c)


def unescape(c: Column, guard: Column | None = None) -> Column:
    """HTML entities to characters. Only texts with an ampersand leave the JVM.

    guard: a cheap column that has an ampersand wherever c has one, where c itself is costly: each text's c is then
    computed in one place only.
    """
    some = F.coalesce(F.contains(c if guard is None else guard, F.lit("&")), F.lit(False))
    return F.when(some, _unescape(F.when(some, c))).otherwise(c)


def strip_urls(c: Column) -> Column:
    """Without plain and spaced-out URLs, a space in place of each."""
    for pattern in (URL, SPACED_SCHEME, SPACED_WWW):
        c = F.regexp_replace(c, pattern, " ")
    return c


def find_urls(c: Column) -> Column:
    """Plain URLs, and spaced-out ones with the white space taken out; one URL may give several entries."""

    def find(t: Column) -> Column:
        spaced = F.concat(F.regexp_extract_all(t, F.lit(SPACED_SCHEME), 0), F.regexp_extract_all(t, F.lit(SPACED_WWW), 0))
        return F.concat(F.regexp_extract_all(t, F.lit(URL), 0), F.transform(spaced, lambda u: F.regexp_replace(u, rf"(?dU){S}++", "")))

    return once(c, find)


def live_url(c: Column) -> Column:
    """A defanged URL made live again."""
    u = F.regexp_replace(F.regexp_replace(strip(c), "(?i)^hxxp", "http"), "(?i)^fxp", "ftp")
    for fang in ("[.]", "(.)", "[dot]"):
        u = F.replace(u, F.lit(fang), F.lit("."))
    return u


def strip(c: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(c, rf"(?dU)^{S}++|(?<!{S}){S}++\z", "")


def untag(c: Column) -> Column:
    """Script and style blocks out, then tags, a space in place of each. What follows the last > holds no tag and is
    left alone, so that a text full of < costs no more than any other."""

    def cut(t: Column) -> Column:
        rest = F.substring_index(t, ">", -1)
        return F.concat(F.regexp_replace(F.substring(t, F.lit(1), F.length(t) - F.length(rest)), TAG, " "), rest)

    return once(F.regexp_replace(c, SCRIPT_STYLE, " "), cut)


def html_text(c: Column, entities: dict[str, str] | None = None) -> Column:
    """The visible text: script and style blocks out, tags out, entities resolved.

    entities: the only ones to resolve, in their order, each as it is spelt in full; without it all of HTML, of which
    some need no semicolon.
    """
    if entities is None:
        return unescape(untag(c), guard=c)
    return functools.reduce(lambda t, e: F.replace(t, F.lit(e), F.lit(entities[e])), entities, untag(c))


def html_links(c: Column) -> Column:
    """The values of href, src and action attributes, trimmed, in their order; empty ones are left out."""
    groups = [F.regexp_extract_all(c, F.lit(LINK_ATTRIBUTE), g) for g in (1, 2, 3)]
    first = F.transform(F.arrays_zip(*[g.alias(n) for g, n in zip(groups, "abc", strict=True)]), lambda x: F.coalesce(*[F.nullif(x[n], F.lit("")) for n in "abc"], F.lit("")))
    return F.transform(F.filter(first, lambda u: u != ""), strip)


def is_web_link(c: Column) -> Column:
    return c.rlike(WEB_LINK)


def holds_url(c: Column) -> Column:
    """Whether a code's text is a link or has a URL in it."""
    return c.rlike(WEB_LINK) | c.rlike(URL)


def _where(c: Column, marks: str, f: Callable[[Column], Column]) -> Column:
    """f of the texts that have all the marks, which f's patterns need; others are left as they are."""

    def run(t: Column) -> Column:
        has = [F.contains(t, F.lit(m)) for m in marks]
        return F.when(functools.reduce(Column.__and__, has), f(t)).otherwise(t)

    return once(c, run)


def strip_residual_markup(c: Column) -> Column:
    """Runs of base64, CSS blocks, tags (twice), attributes and CSS properties, a space in place of each."""
    c = F.regexp_replace(c, BASE64_RUN, " ")
    c = _where(c, "{}", lambda t: F.reverse(F.regexp_replace(F.reverse(t), CSS_BLOCK_REVERSED, " ")))
    c = _where(c, "<>", lambda t: F.regexp_replace(F.regexp_replace(t, SHORT_TAG, " "), SHORT_TAG, " "))
    c = _where(c, '="', lambda t: F.regexp_replace(t, MARKUP_ATTRIBUTE, "$1 "))
    return F.regexp_replace(c, CSS_PROPERTY, " ")


def strip_delivery_artifacts(c: Column) -> Column:
    for pattern in DELIVERY_LINES:
        c = F.regexp_replace(c, pattern, " ")
    return c


def scrub_tokens(c: Column) -> Column:
    """Without words and domains that give the corpus away."""
    for names in (CORPUS_DOMAINS, CORPUS_TOKENS):
        c = F.regexp_replace(c, rf"(?dUi)(?<!{W})(?:{'|'.join(n.replace('.', chr(92) + '.') for n in names)})(?!{W})", " ")
    return c


def scrub(c: Column, *, tokens: bool = True) -> Column:
    """Residual markup, delivery artefacts and, for training sets, corpus tokens."""
    c = strip_delivery_artifacts(strip_residual_markup(c))
    return scrub_tokens(c) if tokens else c


def cleaned(c: Column) -> Column:
    """What both normalisers share: URLs out, entities resolved, markup and delivery artefacts out. c is named several
    times: give a column, not a costly expression."""
    return scrub(unescape(strip_urls(c), guard=c), tokens=False)


def normalize(c: Column, *, tokens: bool = True) -> Column:
    """A body's text: URLs out, entities resolved, scrubbed, white space collapsed."""
    out = cleaned(c)
    return collapse(scrub_tokens(out) if tokens else out)


def normalize_subject(c: Column) -> Column:
    """Without reply and forward prefixes, lower-cased, white space collapsed; null is empty."""
    return F.coalesce(collapse(F.lower(F.regexp_replace(c, REPLY_PREFIX, ""))), F.lit(""))


def is_reply(c: Column) -> Column:
    return F.coalesce(c.rlike(REPLY_PREFIX), F.lit(False))


def thread_keys(message_id: Column, in_reply_to: Column, references: Column, subject: Column) -> Column:
    """`mid:` keys of all message ids in three headers, and for replies a `subj:` key of the normalised subject."""
    ids = [F.coalesce(F.regexp_extract_all(c, F.lit(MESSAGE_ID), 0), F.array().cast("array<string>")) for c in (message_id, in_reply_to, references)]
    mids = F.transform(F.concat(*ids), lambda m: F.concat(F.lit("mid:"), m))
    bare = normalize_subject(subject)
    return F.concat(mids, F.when(is_reply(subject) & (bare != ""), F.array(F.concat(F.lit("subj:"), bare))).otherwise(F.array().cast("array<string>")))


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(rf"{W}+"), 0)


def shingles(c: Column, k: int = 5) -> Column:
    """The distinct runs of k words, joined by spaces; of fewer words the words themselves; null gives none."""
    w = F.coalesce(words(c), F.array().cast("array<string>"))

    def of(ws: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - F.lit(k - 1), F.lit(1))), lambda i: F.array_join(F.slice(ws, i, k), " "))
        return F.array_distinct(F.when(F.size(ws) >= k, runs).otherwise(ws))

    return once(w, of)


def content_id(c: Column) -> Column:
    return F.sha2(c, 256)


def looks_like_email(c: Column) -> Column:
    """Two header lines at least in the first 4096 characters."""
    return F.size(F.regexp_extract_all(F.substring(c, 1, 4096), F.lit(r"(?m)^[A-Za-z][A-Za-z0-9-]{0,40}:[ \t]"), 0)) >= 2


def strip_fences(c: Column) -> Column:
    """Without a code fence's first and last line, trimmed."""
    t = strip(c)
    inner = F.regexp_replace(F.regexp_replace(t, r"^```[^\n]*(?:\n|\z)", ""), r"(?:^|\n)[ \t]*```[^\n]*\z", "")
    return F.when(F.startswith(t, F.lit("```")), strip(inner)).otherwise(t)


def error_code(c: Column) -> Column:
    """The first client or server error status in a message, or null."""
    return F.nullif(F.regexp_extract(c, rf"(?dU)(?<!{W})[45]\d{{2}}(?!{W})", 0), F.lit("")).cast("int")

