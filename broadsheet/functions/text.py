"""Text columns: Unicode trimming, case folding, slugs, HTML to text, keyword lists."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from broadsheet.functions.expr import fence, let

# Every character that counts as white space when text is stripped or split.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
    "        　"
)
_WIDE_SPACES = [c for c in WHITE_SPACE if ord(c) > 0xFF]
# Runs that are not already a single plain space, so ordinary word gaps cost nothing.
_GAP = r"\t-\r\x1c-\x1f\x85\xa0"
_SPACE_RUN = f"[{_GAP}][{_GAP} ]*| [{_GAP} ]+"
_WIDE_GAP = _GAP + "".join(_WIDE_SPACES)
_WIDE_SPACE_RUN = f"[{_WIDE_GAP}][{_WIDE_GAP} ]*| [{_WIDE_GAP} ]+"

# Entities decoded natively; any other reference goes to the exact reader.
_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\xa0"), ("&copy;", "\xa9"), ("&middot;", "\xb7"), ("&mdash;", "—"),
    ("&ndash;", "–"), ("&hellip;", "…"), ("&rsquo;", "’"), ("&lsquo;", "‘"),
    ("&rdquo;", "”"), ("&ldquo;", "“"), ("&amp;", "&"),
)
_KNOWN_ENTITY = "&(?:" + "|".join(name[1:-1] for name, _ in _ENTITIES) + ");"
_FOREIGN_ENTITY = "&(?!(?:" + "|".join(name[1:-1] for name, _ in _ENTITIES) + ");)[#A-Za-z]"
# Comments, hidden elements with their content, declarations, and tags; in document order.
_MARKUP = (
    r"(?is)<(?:!--(?!-?>).*?--"
    r"|(script|style)(?:\s[^<>]*)?(?<!/)>.*?</\1\s*"
    r"|![a-z][^<>]*"
    r"|/?(?!(?:script|style|textarea|xmp|iframe|noembed|noframes|plaintext)\b)[a-z][^<>\"']*+"
    r"(?:\"[^\"]*+\"[^<>\"']*+|'[^']*+'[^<>\"']*+)*+)>"
)
_SLUG = r"^[a-z0-9](?:[a-z0-9._-]*[a-z0-9])?\z"


def strip(c: Column) -> Column:
    """Trim Unicode white space at both ends."""
    # Text that begins and ends with a visible ASCII character stays; this test costs less than looking both up among all spaces.
    visible = (c >= "!") & (c < "\x7f") & (F.substring(c, -1, 1) >= "!") & (F.substring(c, -1, 1) <= "~")
    return F.when(visible, c).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def blank_to_null(c: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def collapse(c: Column) -> Column:
    """One space for every run of white space, none at the ends."""

    def one_space(v: Column) -> Column:
        has_wide = F.exists(F.lit(_WIDE_SPACES), lambda space: F.contains(v, space))
        pattern_free = F.regexp_replace(v, _SPACE_RUN, " ")
        return F.trim(F.when(has_wide, F.regexp_replace(v, _WIDE_SPACE_RUN, " ")).otherwise(pattern_free))

    return let(c, one_space)


def fold(c: Column) -> Column:
    """Case folding for comparisons (lower case, sharp s written as ss)."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def code(c: Column) -> Column:
    """A trimmed upper-case code, null when blank."""
    return F.upper(blank_to_null(c))


def truncate(c: Column, length: int) -> Column:
    """The first ``length`` code points."""
    return F.substring(c, 1, length)


def slug(c: Column) -> Column:
    """A safe partition value: a-z, 0-9, dot, underscore and hyphen; ``unknown`` when empty."""
    given = c.cast("string")
    trimmed = F.btrim(F.regexp_replace(fold(strip(given)), "[^a-z0-9._-]+", "-"), F.lit("-._"))
    # A value that is its own slug passes after one pattern test; others are rewritten once.
    rewritten = let(trimmed, lambda v: F.when(v != "", v))
    return F.coalesce(F.when(given.rlike(_SLUG), given).otherwise(rewritten), F.lit("unknown"))


def keyword_list(words: Column) -> Column:
    """Trimmed, non-empty keywords; the first spelling of each word (ignoring case) stays."""
    kept = F.filter(F.transform(words, strip), lambda w: w != "")
    first = lambda kept, folded: F.transform(F.array_distinct(folded), lambda f: F.get(kept, (F.array_position(folded, f) - 1).cast("int")))
    return let(kept, lambda kept: let(F.transform(kept, fold), lambda folded: first(kept, folded)))


def code_list(codes: Column) -> Column:
    """Trimmed upper-case codes, distinct, in first-seen order."""
    return F.array_distinct(F.transform(codes, lambda c: F.upper(strip(c))))


# What stands at a "<", first match first: comment, hidden element with its content, tag, marked section, declaration or end tag;
# else text. A quoted attribute value may hold ">". An unfinished construct is text up to the next ">", or else "<".
_ATTRIBUTES = r"(?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')|=(?!\s*[\"']))*+"
_SCAN = re.compile(
    r"<!--.*?--\s*>"
    rf"|<(?P<hidden>script|style)(?=[\s/>]){_ATTRIBUTES}(?<!/)>.*?(?:</\s*(?P=hidden)\s*>|\Z)"
    rf"|<[a-z]{_ATTRIBUTES}>"
    r"|<!\[(?:cdata|temp|ignore|include|rcdata)\b.*?\]\s*\]\s*>|<!\[.*?\]\s*>"
    r"|<(?:!(?!--|\[)|[/?])[^>]*>"
    r"|(?P<text><[a-z!/?](?:[^>]*>|[^<]*(?=<))|<)",
    re.IGNORECASE | re.DOTALL,
)


def visible_text(markup: str | None) -> str | None:
    """HTML to text for one value, in one pass of the scanner; used on the rows native patterns cannot prove safe."""
    words = html.unescape(html.unescape(_SCAN.sub(r" \g<text> ", markup or ""))).split()
    return " ".join(words) or None


@F.pandas_udf(StringType())
def _exact_text(markup: pd.Series) -> pd.Series:
    return markup.map(visible_text, na_action="ignore")


def _decode(c: Column) -> Column:
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(ch).alias("char")) for n, ch in _ENTITIES])
    one = lambda text, e: F.when(F.contains(text, e["name"]), F.replace(text, e["name"], e["char"])).otherwise(text)
    return F.when(c.rlike(_KNOWN_ENTITY), F.aggregate(pairs, c, one)).otherwise(c)


def native_text(c: Column) -> Column:
    """Plain text by native expressions: empty when nothing is left, null when not provably exact."""

    def entities(visible: Column) -> Column:
        twice = lambda once: F.when(~once.rlike(_FOREIGN_ENTITY), _decode(once))
        return (
            F.when(visible.contains("<"), None)
            .when(~visible.contains("&"), visible)
            .when(~visible.rlike(_FOREIGN_ENTITY), let(_decode(visible), twice))
        )

    marked = c.contains("<")
    visible = F.when(~marked, c).when(~c.contains("--!>"), F.regexp_replace(c, _MARKUP, " "))
    text = F.when(~marked & ~c.contains("&"), c).otherwise(let(visible, entities))
    return collapse(text)


def with_clean_text(df: DataFrame, texts: dict[str, Column], beside: dict[str, Column] | None = None) -> DataFrame:
    """Add cleaned text columns: hidden elements dropped, tags become breaks, entities decoded twice.

    Plain text and ordinary markup are handled by native expressions. Rows with anything else
    (broken tags, rare entities) are the only ones handed to the vectorised reader; all other
    rows cross to Python as nulls. Each native result is computed once. ``beside`` holds other columns to add; vectorised
    functions among them share the readers' Python workers instead of having their own.
    """
    raw = {name: f"_raw_{name}" for name in texts}
    native = {name: f"_native_{name}" for name in texts}
    beside = beside or {}
    step = df.select("*", *[c.alias(raw[n]) for n, c in texts.items()])
    step = step.select("*", *[native_text(F.col(raw[n])).alias(native[n]) for n in texts])
    exact = {n: _exact_text(F.when(F.col(native[n]).isNull(), F.col(raw[n]))) for n in texts}
    cleaned = [F.nullif(F.coalesce(F.col(native[n]), exact[n]), F.lit("")).alias(n) for n in texts]
    return fence(step.select(*df.columns, *cleaned, *[c.alias(n) for n, c in beside.items()]))


def clean_html_native(c: Column) -> Column:
    """The all-native form, null where the text is not ordinary markup."""
    return F.nullif(native_text(c), F.lit(""))
