"""HTTP URL columns: validation, normalisation, host and homepage."""

from __future__ import annotations

import unicodedata
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from broadsheet.fixed import MAX_URL_LENGTH
from broadsheet.functions.expr import let
from broadsheet.functions.text import WHITE_SPACE, strip

_URL = (
    r"(?is)^(https?)://(?:([^/?#\\]*)@)?(\[[0-9a-f:.]+\]|[^/?#\\:@\[\]]+)(?::(\d*))?"
    r"([/\\][^?#]*)?(\?[^#]*)?(#.*)?$"
)
_FOREIGN_HOST = r"[^\x00-\x7f]|%"
_NORMAL = r"^https?://(?:[a-z0-9_-]+\.)*[a-z][a-z0-9_-]*/[\w!$%&()*+,./:;=?@~\[\]|^-]*(?:#[\w!$%&()*+,./:;=?@~-]*)?$"
_PLAIN = _NORMAL[:-1] + r"\z"
_BAD_HOST = r"[\x00-\x20<>^|%\x7f]"
_NUMERIC_TAIL = r"(^|\.)(\d+|0[xX][0-9a-fA-F]*)\.?$"
_QUAD = r"^((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$"

# Characters percent-encoded in each part of a URL.
_ENCODE_PATH = r"""[\x00-\x20"<>`{}\x7f]|[^\x00-\x7f]"""
_ENCODE_QUERY = r"""[\x00-\x20"<>'\x7f]|[^\x00-\x7f]"""
_ENCODE_FRAGMENT = r"""[\x00-\x20"<>`\x7f]|[^\x00-\x7f]"""
_DOTS = r"(?i)(^|/)(\.|%2e)(\.|%2e)?(/|$)"


def _ascii_host(host: str) -> str | None:
    labels = []
    for label in unicodedata.normalize("NFC", unquote(host)).replace("。", ".").lower().split("."):
        label = unicodedata.normalize("NFKC", label) if not set(label) & {"ß", "ς"} else label
        labels.append(label if label.isascii() else "xn--" + label.encode("punycode").decode("ascii"))
    joined = ".".join(labels)
    return joined if joined and not set(joined) & set(' #/:<>?@[\\]^|%') else None


@F.pandas_udf(StringType())
def _idna(host: pd.Series) -> pd.Series:
    return host.map(_ascii_host, na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def _idna_in(url_lists: pd.Series) -> pd.Series:
    def rewrite(url: str | None) -> str | None:
        scheme, sep, rest = (url or "").partition("://")
        end = min([rest.find(ch) for ch in "/?#:" if ch in rest] or [len(rest)])
        return url if not sep or rest[:end].isascii() else scheme + sep + (_ascii_host(rest[:end]) or "") + rest[end:]

    return url_lists.map(lambda items: [rewrite(u) for u in items], na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def _idna_each(host_lists: pd.Series) -> pd.Series:
    return host_lists.map(lambda hosts: [h and _ascii_host(h) for h in hosts], na_action="ignore")


def foreign_hosts(url_list: Column) -> Column:
    """Per URL of an array its host in ASCII form if it is not plain, else null; null for arrays with none.

    One vectorised call for all URLs of a row, for :func:`normalize_url`: rows without such hosts cross as nulls."""
    host = lambda u: F.regexp_extract(_cleaned(u), _URL, 3)
    # A URL without such characters has no such host, and is not taken apart.
    hosts = F.transform(url_list, lambda u: F.when(u.rlike(_FOREIGN_HOST), let(host(u), lambda h: F.when(h.rlike(_FOREIGN_HOST), h))))
    return _idna_each(let(hosts, lambda found: F.when(F.exists(found, lambda h: h.isNotNull()), found)))


def ascii_hosts(url_list: Column) -> Column:
    """The URLs of an array with international hosts in ASCII form; other arrays stay native."""
    foreign = F.exists(url_list, lambda u: F.coalesce(u.rlike(r"^[^/]*://[^/?#]*[^\x00-\x7f]"), F.lit(False)))
    return F.coalesce(F.when(~foreign, url_list), _idna_in(F.when(foreign, url_list)))


def _encode(c: Column, pattern: str) -> Column:
    """Percent-encode the characters matching ``pattern``; untouched text skips the work."""
    chars = F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    one = lambda ch: F.when(
        ch.rlike(pattern), F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")
    ).otherwise(ch)
    return F.when(c.rlike(pattern), F.array_join(F.transform(chars, one), "")).otherwise(c)


def _resolve_dots(path: Column) -> Column:
    """Remove ``.`` and ``..`` segments."""
    parts = F.split(F.substr(path, F.lit(2)), "/")
    is_one = lambda s: F.lower(F.replace(F.lower(s), F.lit("%2e"), F.lit("."))) == "."
    is_two = lambda s: F.replace(F.lower(s), F.lit("%2e"), F.lit(".")) == ".."
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(is_one(s), acc)
        .when(is_two(s), F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    last = F.element_at(parts, -1)
    closed = F.when(is_one(last) | is_two(last), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(_DOTS), F.concat(F.lit("/"), F.array_join(closed, "/"))).otherwise(path)


def _rebuild(part: Column) -> Column:
    """Put the normalised parts of a matched URL together; null when a part is invalid."""
    port = part["port"].try_cast("int")
    bad_port = (part["port"] != "") & (port.isNull() | (port > 65535))
    default = ((part["scheme"] == "http") & (port == 80)) | ((part["scheme"] == "https") & (port == 443))
    bad_number = part["host"].rlike(_NUMERIC_TAIL) & ~part["host"].rlike(_QUAD)
    slashes = F.translate(F.when(part["path"] == "", F.lit("/")).otherwise(part["path"]), "\\", "/")
    built = F.concat(
        part["scheme"], F.lit("://"),
        F.when(part["user"] != "", F.concat(part["user"], F.lit("@"))).otherwise(F.lit("")),
        part["host"],
        F.when(port.isNotNull() & ~default, F.concat(F.lit(":"), port.cast("string"))).otherwise(F.lit("")),
        let(slashes, lambda p: let(_resolve_dots(p), lambda q: _encode(q, _ENCODE_PATH))),
        _encode(part["query"], _ENCODE_QUERY),
        _encode(part["fragment"], _ENCODE_FRAGMENT),
    )
    return F.when(part["host"].isNotNull() & ~bad_port & ~bad_number, built)


def _cleaned(c: Column) -> Column:
    return F.regexp_replace(strip(c), r"[\t\n\r]", "")


def normalize_url(c: Column, idna: bool = True, foreign_host: Column | None = None) -> Column:
    """A valid http(s) URL in normal form, or null.

    Scheme and host in lower case, default port dropped, empty path written as ``/``, dot
    segments resolved, other characters percent-encoded, fragment kept, length limited.
    A URL already in normal form passes after one pattern test. Everything is native except
    internationalised host names; with ``idna`` those hosts, and only those, pass through a
    vectorised function, unless ``foreign_host`` brings them (see :func:`foreign_hosts`).
    """
    cleaned, foreign = _cleaned(c), foreign_host
    if foreign is None:
        host = F.regexp_extract(cleaned, _URL, 3)
        foreign = _idna(F.when(host.rlike(_FOREIGN_HOST), host)) if idna else F.lit(None).cast("string")
    given = F.struct(cleaned.alias("url"), foreign.alias("foreign"))
    return F.when(c.isNotNull(), let(given, lambda v: _normal_form(v["url"], v["foreign"])))


def with_normal_urls(df: DataFrame, given: dict[str, Column]) -> DataFrame:
    """Add :func:`normalize_url` of several URLs under their names, with one vectorised call for the hosts of a row.

    URLs in normal form, apart from the letters of scheme and host and a bare "/", pass after one pattern test outside of any lambda;
    only the others are taken apart.
    """
    head = lambda c: F.lower(F.substring_index(c, "/", 3))
    tail = lambda c: F.substr(c, F.length(F.substring_index(c, "/", 3)) + 1)
    low = {n: F.col(f"_{n}_low") for n in given}
    plain = {n: F.col(f"_{n}_plain") for n in given}
    step = df.select("*", *[F.concat(head(c), F.coalesce(F.nullif(tail(c), F.lit("")), F.lit("/"))).alias(f"_{n}_low") for n, c in given.items()])
    fits = lambda u: ~F.contains(u, F.lit("/.")) & ~F.contains(u, F.lit("/%")) & (F.length(u) <= MAX_URL_LENGTH) & u.rlike(_PLAIN)
    step = step.select("*", *[F.when(fits(low[n]), low[n]).alias(f"_{n}_plain") for n in given])
    other = {n: F.when(plain[n].isNull(), c) for n, c in given.items()}
    step = step.select("*", foreign_hosts(F.when(F.coalesce(*other.values()).isNotNull(), F.array(*other.values()))).alias("_hosts"))
    normal = lambda n, i: F.coalesce(plain[n], normalize_url(other[n], foreign_host=F.get("_hosts", F.lit(i))))
    return step.select(*df.columns, *[normal(n, i).alias(n) for i, n in enumerate(given)])


def _normal_form(url: Column, foreign_host: Column) -> Column:
    """As :func:`normalize_url`, of a cleaned URL; ``foreign_host`` is its host in ASCII form where that is not plain."""
    host = F.regexp_extract(url, _URL, 3)
    plain_host = F.when(~host.rlike(_FOREIGN_HOST) & ~host.rlike(_BAD_HOST), F.lower(host))
    parts = F.struct(
        F.lower(F.regexp_extract(url, _URL, 1)).alias("scheme"),
        F.regexp_extract(url, _URL, 2).alias("user"),
        F.coalesce(plain_host, foreign_host).alias("host"),
        F.regexp_extract(url, _URL, 4).alias("port"),
        F.regexp_extract(url, _URL, 5).alias("path"),
        F.regexp_extract(url, _URL, 6).alias("query"),
        F.regexp_extract(url, _URL, 7).alias("fragment"),
    )
    # Most other URLs only need their scheme and host in lower case, or the bare "/" path.
    head = F.lower(F.substring_index(url, "/", 3))
    tail = F.substr(url, F.length(head) + 1)
    lowered = F.concat(head, F.when(tail == "", F.lit("/")).otherwise(tail))
    is_normal = lambda u: u.rlike(_NORMAL) & ~u.rlike(_DOTS)
    slow = F.when(url.rlike(_URL), let(parts, _rebuild))
    normal = F.coalesce(F.when(is_normal(url), url), let(lowered, lambda u: F.when(is_normal(u), u)), slow)
    return let(normal, lambda n: F.when(F.length(n) <= MAX_URL_LENGTH, n))


_ANY_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)"


def url_scheme(c: Column) -> Column:
    """Lower-case scheme, null when the text has none."""
    return F.nullif(F.lower(F.regexp_extract(c, _ANY_URL, 1)), F.lit(""))


def url_netloc(c: Column) -> Column:
    """Authority part as written, null when missing."""
    return F.nullif(
        F.coalesce(
            F.nullif(F.regexp_extract(c, _ANY_URL, 2), F.lit("")), F.regexp_extract(c, r"^//([^/?#]*)", 1)
        ),
        F.lit(""),
    )


def homepage(c: Column) -> Column:
    """``scheme://authority`` of a URL, null when either part is missing."""
    return F.concat(url_scheme(c), F.lit("://"), url_netloc(c))


def source_domain(domain: Column, url: Column) -> Column:
    """Publisher domain: the given one, else the host of the article URL."""
    return F.lower(F.coalesce(F.nullif(strip(domain), F.lit("")), url_netloc(url)))


def is_storage_uri(c: Column) -> Column:
    """Whether the text names a bucket and a key, both non-blank."""
    rest = F.regexp_extract(strip(c), r"(?s)^s3://(.*)$", 1)
    bucket = F.regexp_extract(rest, r"(?s)^([^/]*)/", 1)
    key = F.regexp_extract(rest, r"(?s)^[^/]*/(.*)$", 1)
    filled = lambda part: F.btrim(part, F.lit(WHITE_SPACE)) != ""
    # Where bucket and key begin with a visible character nothing needs to be taken apart.
    return F.when(c.rlike(r"^s3://[!-.0-~][^/]*/[!-~]"), True).otherwise(F.coalesce(filled(bucket) & filled(key), F.lit(False)))
