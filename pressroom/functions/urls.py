"""URL normalisation, identity keys and link resolution as column expressions.

Two contracts exist side by side. ``normalize_v1`` reproduces the keys of legacy
artifacts; ``normalize_v2`` is the canonical form and comes with a validity test.
Nothing here raises on bad input: an unusable URL is a null or a false.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters dropped by each contract.
TRACKING_V1 = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "fbclid", "gclid",
]
TRACKING_V2 = [
    "_ga", "dclid", "fbclid", "gclid", "igshid", "mc_cid", "mc_eid", "msclkid",
    "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term",
]

# Path fragments that mark a link as something other than an article.
NON_ARTICLE_PATHS = [
    "/tag/", "/tags/", "/category/", "/chuyen-muc/", "/login",
    "/search", "/rss", "/feed", "/contact", "/about", "/privacy",
    ".jpg", ".png", ".gif", ".css", ".js", "#",
]
# Hosts whose articles always end in .html or .chn.
SUFFIX_ONLY_HOSTS = ["vietnamnet.vn", "vnexpress.net", "cafef.vn", "dantri.com.vn"]

GENERIC_SOURCE_ID = 999
GENERIC_SOURCE_NAME = "generic"

# Generic URI shape of RFC 3986, appendix B.
_URI = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# Host between optional userinfo and optional port; brackets hold an IPv6 address.
_AUTHORITY = r"(?s)^(?:.*@)?(?:\[([^\]]*)\]|([^:\[]*))(?::(.*))?$"
_IPV6_AUTHORITY = r"^(?:[^\[\]]*@)?\[[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(?:%[^\]]*)?\](?::.*)?$"
_GAP = "\u0001"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Bind a value once, so a body that uses it many times stays a small expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _groups(text: Column, pattern: str, n: int) -> Column:
    """All groups of a whole-text pattern in one regex pass; a group that took no part is empty."""
    return F.split(F.regexp_replace(text, pattern, _GAP.join(f"${i + 1}" for i in range(n))), _GAP)


# Blanks of Unicode, and the control characters that may precede a URL.
UNICODE_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
CONTROLS = "".join(chr(i) for i in range(0x21))


def strip_blanks(text: Column | str) -> Column:
    """Strip Unicode blanks at both ends."""
    return F.btrim(col(text), F.lit(UNICODE_BLANKS))


def trimmed(url: Column | str) -> Column:
    """Strip blanks at both ends, control characters in front, and line breaks anywhere."""
    out = F.ltrim(strip_blanks(url), F.lit(CONTROLS))
    for char in "\t\r\n":
        out = F.replace(out, F.lit(char), F.lit(""))
    return out


class UrlParts:
    """Scheme (lower case), netloc, path, query and fragment of a bound parts array."""

    def __init__(self, parts: Column):
        self.scheme = F.lower(F.get(parts, 0))
        self.netloc = F.get(parts, 1)
        self.path = F.get(parts, 2)
        self.query = F.get(parts, 3)
        self.fragment = F.get(parts, 4)


def with_parts(url: Column | str, body) -> Column:
    return let(_groups(trimmed(url), _URI, 5), lambda p: body(UrlParts(p)))


def scheme(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(trimmed(url), _URI, 1))


def netloc(url: Column | str) -> Column:
    return F.regexp_extract(trimmed(url), _URI, 2)


def path(url: Column | str) -> Column:
    return F.regexp_extract(trimmed(url), _URI, 3)


def _decoded(text: Column) -> Column:
    # A '%' that starts no escape stands for itself.
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(text: Column) -> Column:
    # The form encoder keeps '*' and escapes '~'; the key contract is the other way round.
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


# A query of plain name=value pairs, which decoding and encoding would leave as it is.
_PLAIN_QUERY = r"^[A-Za-z0-9_.~-]*+=[A-Za-z0-9_.~-]*+(?:&[A-Za-z0-9_.~-]*+=[A-Za-z0-9_.~-]*+)*+$"


def _clean_plain(query: Column, dropped: list[str]) -> Column:
    tracked = "(?i)&(?:" + "|".join(dropped) + ")=[^&]*"
    return F.substr(F.regexp_replace(F.concat(F.lit("&"), query), tracked, ""), F.lit(2))


def _clean_any(query: Column, dropped: list[str]) -> Column:
    named = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            _decoded(F.substring_index(p, "=", 1)).alias("k"),
            _decoded(F.when(F.instr(p, "=") > 0, F.regexp_replace(p, r"(?s)^[^=]*=", "")).otherwise("")).alias("v"),
        ),
    )
    kept = F.filter(named, lambda kv: ~F.lower(kv["k"]).isin(dropped))
    return F.array_join(F.transform(kept, lambda kv: F.concat(_encoded(kv["k"]), F.lit("="), _encoded(kv["v"]))), "&")


def clean_query(query: Column, dropped: list[str]) -> Column:
    """Drop tracking parameters, keep order and blank values, re-encode the rest."""
    return (
        F.when(query == "", F.lit(""))
        .when(query.rlike(_PLAIN_QUERY), _clean_plain(query, dropped))
        .otherwise(_clean_any(query, dropped))
    )


def _assemble(scheme_: Column, netloc_: Column, path_: Column, query: Column) -> Column:
    return F.concat(
        F.when(scheme_ != "", F.concat(scheme_, F.lit(":"))).otherwise(""),
        F.when(netloc_ != "", F.concat(F.lit("//"), netloc_)).otherwise(""),
        F.when((netloc_ != "") & (path_ != "") & ~path_.startswith("/"), F.lit("/")).otherwise(""),
        path_,
        let(query, lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")),
    )


# Lower-case host, a path, nothing else and only printable ASCII: both contracts leave such a URL as it is.
_CANONICAL = r"^https?://[a-z0-9.-]+/[!\"$->@-~]*$"


def _unless_canonical(url: Column | str, normalized: Column) -> Column:
    return F.when(col(url).rlike(_CANONICAL), col(url)).otherwise(normalized)


def normalize_v1(url: Column | str) -> Column:
    """Legacy key form: lower-case scheme, no fragment, seven tracking parameters dropped."""
    return _unless_canonical(
        url, with_parts(url, lambda p: _assemble(p.scheme, p.netloc, p.path, clean_query(p.query, TRACKING_V1)))
    )


class _Authority:
    """Host (lower case, brackets off), port text and port number of a bound authority array."""

    def __init__(self, groups: Column):
        self.host = F.lower(F.concat(F.get(groups, 0), F.get(groups, 1)))
        self.port_text = F.get(groups, 2)
        self.port = F.when(self.port_text.rlike("^0*[0-9]{1,5}$"), self.port_text.try_cast("int"))


def _with_authority(netloc_: Column, body) -> Column:
    return let(_groups(netloc_, _AUTHORITY, 3), lambda g: body(_Authority(g)))


def _is_bare_host(p: UrlParts) -> Column:
    """No userinfo, port or brackets: nothing of the authority needs a closer look."""
    return (p.netloc != "") & ~p.netloc.rlike(r"[@:\[\]]")


def _valid(p: UrlParts) -> Column:
    bracket_free = ~p.netloc.contains("[") & ~p.netloc.contains("]")
    closer_look = (bracket_free | p.netloc.rlike(_IPV6_AUTHORITY)) & _with_authority(
        p.netloc, lambda a: (a.host != "") & ((a.port_text == "") | F.coalesce(a.port <= 65535, F.lit(False)))
    )
    return p.scheme.isin("http", "https") & (_is_bare_host(p) | closer_look)


def is_valid(url: Column | str) -> Column:
    """True when the URL is http(s), names a host and its port, if any, is a number up to 65535."""
    return F.coalesce(with_parts(url, _valid), F.lit(False))


def _authority_text(p: UrlParts) -> Column:
    def text(a: _Authority) -> Column:
        bracketed = F.when(a.host.contains(":"), F.concat(F.lit("["), a.host, F.lit("]"))).otherwise(a.host)
        default_port = ((p.scheme == "http") & (a.port == 80)) | ((p.scheme == "https") & (a.port == 443))
        return F.when(a.port.isNull() | default_port, bracketed).otherwise(F.concat_ws(":", bracketed, a.port.cast("string")))

    return F.when(_is_bare_host(p), F.lower(p.netloc)).otherwise(_with_authority(p.netloc, text))


def normalize_v2(url: Column | str) -> Column:
    """Canonical form; null when the URL is invalid."""

    def body(p: UrlParts) -> Column:
        rooted = F.when(p.path == "", F.lit("/")).otherwise(p.path)
        return F.when(_valid(p), _assemble(p.scheme, _authority_text(p), rooted, clean_query(p.query, TRACKING_V2)))

    return _unless_canonical(url, with_parts(url, body))


def short_hash(text: Column | str) -> Column:
    """First 16 hex digits of SHA-256."""
    return F.substring(F.sha2(col(text).cast("binary"), 256), 1, 16)


def url_hash_v1(url: Column | str) -> Column:
    return short_hash(normalize_v1(url))


def url_hash_v2(url: Column | str) -> Column:
    return short_hash(normalize_v2(url))


def content_hash(payload: Column | str) -> Column:
    """SHA-256 over the decompressed payload bytes."""
    return F.sha2(col(payload).cast("binary"), 256)


def host_matches(host: Column | str, domain: Column | str) -> Column:
    """Host equals the domain or is a subdomain of it. The host keeps its port and userinfo."""
    h, d = F.lower(col(host)), F.lower(col(domain))
    return (h == d) | F.endswith(h, F.concat(F.lit("."), d))


def host_suffixes(host: Column | str) -> Column:
    """Every dot-suffix of a host, longest first, so a domain lookup is an equi-join."""
    labels = F.split(F.lower(F.trim(col(host))), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def infer_source_name(url: Column | str) -> Column:
    """First label of the host without ``www.``; ``generic`` when there is none."""
    first = F.substring_index(F.replace(netloc(url), F.lit("www."), F.lit("")), ".", 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.lit(GENERIC_SOURCE_NAME))


def any_domain_matches(host: Column, domains: Column) -> Column:
    return F.exists(domains, lambda d: host_matches(host, d))


def is_article_link(url: Column | str, domains: Column) -> Column:
    """Heuristic test that a link found on a listing page leads to an article."""

    def judge(host: Column, raw_path: Column, slug: Column) -> Column:
        excluded = F.lit(False)
        for piece in NON_ARTICLE_PATHS:
            excluded = excluded | raw_path.contains(piece)
        strict = F.lit(False)
        for name in SUFFIX_ONLY_HOSTS:
            strict = strict | host.contains(name)
        page_suffix = slug.endswith(".html") | slug.endswith(".chn")
        shaped = page_suffix | (~strict & (slug.rlike(r"(?U)\d") | (F.char_length(slug) > 30)))
        return (slug != "") & ~excluded & shaped & any_domain_matches(host, domains)

    verdict = with_parts(
        url,
        lambda p: let(
            F.struct(F.lower(p.netloc).alias("host"), F.lower(p.path).alias("path"),
                     F.regexp_replace(F.lower(p.path), "^/+|/+$", "").alias("slug")),
            lambda x: judge(x["host"], x["path"], x["slug"]),
        ),
    )
    return F.coalesce(verdict, F.lit(False))


def _without_dots(segments: Column) -> Column:
    """Path text of a segment list with ``.`` and ``..`` resolved; empty inner segments collapse."""
    inner = F.filter(segments, lambda s, i: (s != "") | (i == 0) | (i == F.size(segments) - 1))
    walked = F.aggregate(
        inner,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.array_append(acc, s)),
        # A path that ends in a dot segment names a folder.
        lambda acc: F.array_join(
            F.when(F.element_at(segments, -1).isin(".", ".."), F.array_append(acc, F.lit(""))).otherwise(acc), "/"
        ),
    )
    return F.coalesce(F.nullif(walked, F.lit("")), F.lit("/"))


def url_join(base: Column | str, ref: Column | str) -> Column:
    """Resolve a link against the page it stands on."""

    def joined(b: UrlParts, r: UrlParts) -> Column:
        folder = F.split(F.regexp_replace(b.path, r"/?[^/]*$", ""), "/")
        segments = F.when(r.path.startswith("/"), F.split(r.path, "/")).otherwise(F.concat(folder, F.split(r.path, "/")))
        new_path = F.when(r.path == "", b.path).otherwise(let(segments, _without_dots))
        new_query = F.when((r.path == "") & (r.query == ""), b.query).otherwise(r.query)
        return F.when(r.netloc != "", _assemble(b.scheme, r.netloc, r.path, r.query)).otherwise(
            _assemble(b.scheme, b.netloc, new_path, new_query)
        )

    def resolve(b: UrlParts, r: UrlParts) -> Column:
        absolute = (r.scheme != "") & ((r.scheme != b.scheme) | (r.netloc != ""))
        tail = F.when(r.fragment != "", F.concat(F.lit("#"), r.fragment)).otherwise("")
        return F.when(absolute, trimmed(ref)).when(trimmed(ref) == "", trimmed(base)).otherwise(F.concat(joined(b, r), tail))

    return with_parts(base, lambda b: with_parts(ref, lambda r: resolve(b, r)))


def safe_source_name(name: Column | str) -> Column:
    """A source name usable as a folder name."""
    cleaned = F.regexp_replace(strip_blanks(name), "[^A-Za-z0-9_.-]+", "_")
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit("unknown"))


def redact_password(url: Column | str) -> Column:
    """Hide the password of ``user:password@`` in a URL; other URLs stay as they are."""
    return F.regexp_replace(col(url), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#:@]*):[^/?#]+@", "$1:****@")


def normalized_object_key(key: Column | str) -> Column:
    """A relative key with empty, ``.`` and ``..`` steps resolved, as a file listing would name the object."""
    steps = F.filter(F.split(col(key), "/"), lambda s: ~s.isin("", "."))
    none = F.array().cast("array<string>")

    def step(done: Column, s: Column) -> Column:
        return F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.array_append(done, s))

    return F.array_join(F.aggregate(steps, none, step), "/")


def is_safe_object_key(key: Column | str) -> Column:
    """True when a relative key, with ``..`` resolved, never leaves the storage root."""
    walk = F.aggregate(
        F.split(col(key), "/"),
        F.struct(F.lit(0).alias("depth"), F.lit(True).alias("inside")),
        lambda acc, s: F.struct(
            (acc["depth"] + F.when(s.isin("", "."), 0).when(s == "..", -1).otherwise(1)).alias("depth"),
            (acc["inside"] & ~((s == "..") & (acc["depth"] == 0))).alias("inside"),
        ),
    )
    return F.coalesce(~col(key).startswith("/") & walk["inside"], F.lit(False))
