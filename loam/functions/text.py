"""Text functions as column expressions."""

from __future__ import annotations

import html.entities
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal forms that may end a company's name (dots are ignored).
LEGAL_SUFFIXES = ("incorporated", "corporation", "limited", "gmbh", "pbc", "bv", "sas", "llc", "corp", "ltd", "inc", "co")
LEGAL_SUFFIX_FORMS = LEGAL_SUFFIXES + ("p.b.c", "b.v", "s.a.s", "l.l.c")
# Words that a grounded description doesn't use.
HYPE_WORDS = ("revolutionary", "game-changing", "disruptive", "unmatched", "unparalleled", "world's best", "miracle", "unprecedented")
# Words that a written description is cleaned of.
ENRICHER_HYPE_WORDS = ("revolutionary", "cutting-edge", "world-class", "game-changing", "state-of-the-art", "ultimate", "unmatched", "unrivaled", "seamlessly empowers")
# Texts that stand for a missing value.
FORBIDDEN_LITERALS = ("none", "null", "n/a", "na", "unknown", "undefined", "nan", "nil", "not available", "not specified", "tbd", "todo")


def _plain_letters() -> tuple[str, str]:
    """Latin letters that decompose to one base letter and marks, with that letter."""
    pairs = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = [c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)]
        if len(base) == 1 and base[0] != chr(code):
            pairs[chr(code)] = base[0]
    return "".join(pairs), "".join(pairs.values())


ACCENTED, PLAIN = _plain_letters()


@F.pandas_udf(T.StringType())
def nfkd(text: pd.Series) -> pd.Series:
    """Compatibility decomposition of any script; only for texts beyond Latin letters, which plain_letters covers."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t))


def plain_letters(text: Column) -> Column:
    return F.translate(text, ACCENTED, PLAIN)


def entity_key(name: Column, decomposed: bool = False) -> Column:
    """The form in which names are compared: plain lower-case words without punctuation and without one trailing legal
    form. '' for null. Set decomposed if `name` has been through nfkd already."""
    text = F.trim(F.lower(name if decomposed else plain_letters(name)))
    text = F.regexp_replace(text, r"[\-_/]+", " ")
    text = F.regexp_replace(text, r"[^\p{L}\p{N}_\s.,]", "")
    words = F.filter(F.split(F.replace(text, F.lit(","), F.lit(" ")), r"\s+"), lambda w: w != "")
    ending = F.rtrim(F.element_at(words, -1), F.lit("."))
    cut = F.when((F.size(words) > 1) & ending.isin(*LEGAL_SUFFIX_FORMS), F.slice(words, F.lit(1), F.size(words) - 1)).otherwise(words)
    key = F.trim(F.regexp_replace(F.regexp_replace(F.array_join(cut, " "), r"[.,;:]+", ""), r"\s+", " "))
    return F.coalesce(key, F.lit(""))


def _entities() -> tuple[dict[str, str], str]:
    """Named entities by name, and a pattern for those that need no semicolon, the longest first."""
    named = {k.rstrip(";"): v for k, v in html.entities.html5.items()}
    bare = sorted((k for k in html.entities.html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
    return named, "^(?:" + "|".join(bare) + ")"


NAMED, BARE = _entities()
#: What pages mean by the numbers of control characters, from 0x80 on.
_WINDOWS = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0))


def unescaped(text: Column) -> Column:
    """A text with its HTML entities as characters, each read once."""
    # one constant, whatever the number of places that use it
    names = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")

    def character(code: Column) -> Column:
        out = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        bad = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
        return F.when(bad, "\ufffd").when(code.between(0x80, 0x9F), F.substring(F.lit(_WINDOWS), (code - 0x7F).cast("int"), F.lit(1))).otherwise(out)

    def read(part: Column, i: Column) -> Column:
        name = F.regexp_extract(part, "^(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]*)", 1)
        number = F.when(F.regexp_like(name, F.lit("^#[xX]")), F.conv(F.substring(name, 3, 8), 16, 10)).when(F.startswith(name, F.lit("#")), F.substring(name, 2, 8)).cast("long")
        rest = F.substring(part, F.length(name) + 1, F.lit(1 << 30))
        known = F.when(F.startswith(rest, F.lit(";")), F.element_at(names, name))
        bare = F.regexp_extract(part, BARE, 0)
        return (
            F.when(i == 0, part)
            .when(number.isNotNull(), F.concat(character(number), F.regexp_replace(rest, "^;", "")))
            .when(known.isNotNull(), F.concat(known, F.substring(rest, 2, 1 << 30)))
            .when(bare != "", F.concat(F.element_at(names, bare), F.substring(part, F.length(bare) + 1, F.lit(1 << 30))))
            .otherwise(F.concat(F.lit("&"), part))
        )

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&"), read), "")).otherwise(text)


def reads(named: dict[str, str]) -> Callable[[Column], Column]:
    """A plainer reader than unescaped: only these entities, only with their semicolon, one after another."""

    def read(text: Column) -> Column:
        for name, value in named.items():
            text = F.replace(text, F.lit(f"&{name};"), F.lit(value))
        return text

    return read


def html_text(page: Column, read: Callable[[Column], Column] = unescaped) -> Column:
    """A page's text: scripts, styles, drawings and noscript parts go, blocks end lines, other tags are blanks, entities are
    read (by `read`), lines are trimmed and blank ones dropped."""
    out = F.regexp_replace(page, r"(?is)<(script|style|svg|noscript)[^>]*>.*?</\1>", "")
    out = F.regexp_replace(out, r"(?i)</?(?:p|div|br|h[1-6]|li|tr|article|section)[^>]*>", "\n")
    out = read(F.regexp_replace(out, r"<[^>]+>", " "))
    lines = F.transform(F.split(out, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), lambda x: F.regexp_replace(F.regexp_replace(x, r"[ \t]+", " "), r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


# Fixed value: what stands for the middle of a text that is too long.
CUT_MARK = "\n\n[... content truncated for context limits ...]\n\n"


def _last(of: Column, needle: str, since: int) -> Column:
    """Where a needle begins for the last time, from 0, at `since` or later; null if it doesn't."""
    behind = F.substring(of, since + 1, 1 << 30)
    back = F.instr(F.reverse(behind), needle[::-1])
    return F.when(back > 0, F.lit(since - len(needle) + 1) + F.length(behind) - back)


def _first(of: Column, needle: str, before: int) -> Column:
    """Where a needle begins, from 0, if it ends before `before`; null if it doesn't."""
    return F.nullif(F.instr(F.substring(of, 1, before), needle), F.lit(0)) - 1


def head_and_tail(page: Column, max_chars: int = 12_000, head_share: float = 0.65) -> Column:
    """A page's text; if it has more than max_chars, its head and its tail with CUT_MARK between. The head ends, and the tail
    begins, at a paragraph, else a sentence, else a word, if there is one within a quarter of the part."""
    cleaned = html_text(page)
    budget = max_chars - len(CUT_MARK)
    if budget <= 100:
        return F.substring(cleaned, 1, max_chars)
    n_head = int(budget * head_share)
    n_tail = budget - n_head
    head, tail = F.substring(cleaned, 1, n_head), F.right(cleaned, F.lit(n_tail))
    since, before = int(n_head * 0.75), int(n_tail * 0.25)
    sentence = F.greatest(_last(head, ". ", since), _last(head, ".\n", since)) + 1
    cut = F.coalesce(_last(head, "\n\n", since), sentence, _last(head, " ", since), F.lit(n_head))
    sentence = F.least(_first(tail, ". ", before), _first(tail, ".\n", before)) + 2
    begin = F.coalesce(_first(tail, "\n\n", before) + 2, sentence, _first(tail, " ", before) + 1, F.lit(0))
    first = F.regexp_replace(F.substring(head, F.lit(1), cut.cast("int")), r"(?U)\s+$", "")
    last = F.regexp_replace(F.substring(tail, begin.cast("int") + 1, F.lit(1 << 30)), r"(?U)^\s+", "")
    return F.when(F.length(cleaned) <= max_chars, cleaned).otherwise(F.concat(first, F.lit(CUT_MARK), last))


def json_object(raw: Column) -> Column:
    """The outermost {...} of a reply, without code fences, as variant; null if it is no object."""
    body = F.regexp_extract(F.regexp_replace(raw, r"(?m)^\s*```(?:json)?\s*$", ""), r"(?s)\{.*\}", 0)
    return F.try_parse_json(F.nullif(body, F.lit("")))


def tidy_description(text: Column) -> Column:
    """Trimmed, without quotes around it, blanks collapsed."""
    text = F.trim(text)
    text = F.regexp_replace(text, r"""(?s)^(["'])(.*)\1$""", "$2")
    return F.trim(F.regexp_replace(text, r"[ \t]+", " "))


def hype_found(text: Column, words=HYPE_WORDS) -> Column:
    """The listed words that a text has, as whole words."""
    low = F.lower(text)
    hits = [F.when(F.regexp_like(low, F.lit(rf"\b{re.escape(w)}\b")), F.lit(w)) for w in words]
    return F.array_compact(F.array(*hits))


def without_hype(text: Column, words=ENRICHER_HYPE_WORDS) -> Column:
    """A text without the listed words; if it had any, blanks are collapsed."""
    found = r"(?i)\b(?:" + "|".join(re.escape(w) for w in words) + r")\b"
    cut = F.regexp_replace(F.trim(F.regexp_replace(text, found, "")), r"\s+", " ")
    return F.when(F.regexp_like(text, F.lit(found)), cut).otherwise(text)


_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def _long_words(text: str | None) -> list[str]:
    words = (text or "").split() if not _SEPARATORS.search(text or "") else _BLANKS.split(text)  # no blanks here, but for split()
    return [w for w in words if len(w) > 4]


def _supported(claim: str | None, source: str | None) -> float:
    words = Counter(_long_words(claim))
    if not words:
        return 1.0
    # no word has a blank, so that one of the source's own words holds what the source has
    own = dict.fromkeys(_long_words(source))
    joined = " ".join(own)
    if len(words) < 2_000:
        return sum(n for w, n in words.items() if w in own or w in joined) / words.total()
    # many words are looked for in a long text only if it has all their parts of five characters
    parts = {joined[i : i + 5] for i in range(len(joined) - 4)}
    there = lambda w: w in own or all(w[i : i + 5] in parts for i in range(len(w) - 4)) and w in joined
    return sum(n for w, n in words.items() if there(w)) / words.total()


@F.pandas_udf(T.DoubleType())
def _support(claim: pd.Series, source: pd.Series) -> pd.Series:
    return pd.Series(map(_supported, claim, source), dtype="float64")


def support_ratio(claim: Column, source: Column) -> Column:
    """The share of a claim's words of over 4 characters that its source has, whatever the case; 1 if it has no such word.

    Built-in functions compare every word with every place of a text; Python has sets to look words' parts up in."""
    return _support(F.lower(claim), F.lower(source))


def is_forbidden(value: Column) -> Column:
    return F.lower(F.trim(value)).isin(*FORBIDDEN_LITERALS)


def is_placeholder(value: Column) -> Column:
    return F.regexp_like(F.trim(value), F.lit(r"(?s)^(\[.*\]|<.*>)$"))


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "?")


def name_and_developer(title: Column) -> tuple[Column, Column]:
    """"X by Y" split at the first " by ". The developer has no pictographs and ends before an @."""
    parts = F.split(title, " by ", 2)
    developer = F.trim(F.substring_index(F.regexp_replace(F.get(parts, F.lit(1)), r"[\x{10000}-\x{10FFFF}]", ""), "@", 1))
    return F.trim(F.get(parts, F.lit(0))), F.when(F.length(developer) > 1, developer)


def title_case(text: Column) -> Column:
    """Every run of letters capitalised, whatever stands before it."""
    marked = F.regexp_replace(F.lower(text), r"(^|[^\p{L}])(\p{L})", "$1\u0000$2")
    parts = F.split(marked, "\u0000")
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))), "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def as_bool(text: Column) -> Column:
    low = F.lower(F.trim(text))
    return F.when(low.isin("true", "1", "yes", "y"), True).when(low.isin("false", "0", "no", "n"), False)


def as_bool_text(text: Column) -> Column:
    """'True', 'False' or the text itself: for columns that hold either."""
    low = F.lower(F.trim(text))
    return F.when(low.isin("true", "yes"), "True").when(low.isin("false", "no"), "False").otherwise(blank_to_null(text))


def as_list(text: Column) -> Column:
    """Comma-separated values; null is an empty list."""
    parts = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def as_price(text: Column) -> Column:
    """Numbers become dollar amounts, 0 and less 'Free'; other texts stay."""
    n = text.try_cast("double")
    return F.when(n > 0, F.format_string("$%.2f", n)).when(n <= 0, "Free").otherwise(blank_to_null(text))
