"""URL normal forms on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters that only track, keys that name an article, and what single sites need of a query.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "igshid", "mibextid", "ref", "ref_src", "spm")
ID_KEYS = ("id", "no", "idx", "idxno", "arcid", "aid", "oid", "ud", "newsid", "articleid", "article_id", "seq", "sn", "docid")
COMPANIONS = ("code", "b", "board", "cid", "category", "mid")
SITE_RULES = (
    ("dcinside.com", "/board/view/", ("id", "no")), ("bobaedream.co.kr", "/board/bbs_view", ("code", "no")), ("bobaedream.co.kr", "=/view", ("code", "no")),
    ("mlbpark.donga.com", "/mp/b.php", ("b", "id", "idx")), ("theqoo.net", "", ()), ("ppomppu.co.kr", "/zboard/view.php", ("id", "no")),
    ("kmib.co.kr", "view.asp", ("arcid", "code")), ("kmib.co.kr", "view_amp.asp", ("arcid", "code")), ("moneys.mt.co.kr", "mwview.php", ("no",)), ("moneys.co.kr", "mwview.php", ("no",)),
    ("mt.co.kr", "mtview.php", ("no",)), ("mt.co.kr", "hotview.php", ("no",)), ("heraldcorp.com", "view.php", ("ud",)), ("koreaherald.com", "view.php", ("ud",)), ("news.naver.com", "", ("oid", "aid")),
)
ARTICLE_DROPPED = ("fbclid", "gclid", "mc_cid", "mc_eid")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


_SHAPE = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?]*))?([^?]*)(?:\?(.*))?$"


def parsed(url: Column, use) -> Column:
    """``use(p)`` with p the struct scheme, host (lower case, without user; other ports than 80 and 443 stay), path and query; no fragment and, as
    ``;params`` of the last segment name no page, none of these."""

    def split(bare: Column) -> Column:
        part = lambda i: F.regexp_extract(bare, _SHAPE, i)
        host = F.regexp_replace(F.regexp_replace(F.lower(part(2)), "^.*@", ""), ":(80|443)?$", "")
        path = F.regexp_replace(part(3), ";[^/]*$", "")
        return F.struct(F.lower(part(1)).alias("scheme"), host.alias("host"), path.alias("path"), part(4).alias("query"))

    return let(F.regexp_replace(F.trim(url), "#.*$", ""), lambda bare: let(split(bare), use))


def host_of(url: Column) -> Column:
    return parsed(url, lambda p: p["host"])


def pairs(query: Column) -> Column:
    """(k, v) of a query, decoded; a name without a value has an empty one."""
    items = F.filter(F.split(query, "&"), lambda x: x != "")
    decode = lambda x: F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit(" "))), x)
    value = lambda x: F.when(F.contains(x, F.lit("=")), F.regexp_replace(x, "^[^=]*=", "")).otherwise(F.lit(""))
    return F.transform(items, lambda x: F.struct(decode(F.substring_index(x, "=", 1)).alias("k"), decode(value(x)).alias("v")))


def in_(key: Column, names: tuple[str, ...]) -> Column:
    return key.isin(*names) if names else F.lit(False)


def allowed(p: Column, kv: Column) -> Column:
    """The query keys that identify a page: its site's, else article ids and their companions if there is one; null for all."""
    words = lambda names: F.array(*[F.lit(x) for x in names]).cast("array<string>")
    path = F.lower(p["path"])
    chosen = None
    for host, where, keys in SITE_RULES:
        hit = F.endswith(p["host"], F.lit(host)) & ((path == where[1:]) if where.startswith("=") else F.contains(path, F.lit(where)))
        chosen = F.when(hit, words(keys)) if chosen is None else chosen.when(hit, words(keys))
    return chosen.when(F.exists(kv, lambda x: in_(F.lower(x["k"]), ID_KEYS)), words(ID_KEYS + COMPANIONS))


def normalize(url: Column) -> Column:
    """The crawl's identity of a page: scheme (http if none) and host, a path (/ if none), the query without tracking parameters, site rules applied,
    sorted; blank values stay, fragment and ;params go."""

    def build(p: Column) -> Column:
        return let(F.filter(pairs(p["query"]), lambda x: ~in_(F.lower(x["k"]), TRACKING)), lambda kv: let(allowed(p, kv), lambda keys: let(
            F.array_join(F.transform(F.array_sort(F.filter(kv, lambda x: keys.isNull() | F.array_contains(F.coalesce(keys, F.array().cast("array<string>")), F.lower(x["k"])))), lambda x: F.concat(x["k"], F.lit("="), x["v"])), "&"),
            lambda query: F.rtrim(F.concat(F.when(p["scheme"] == "", F.lit("http")).otherwise(p["scheme"]), F.lit("://"), p["host"], F.when(F.startswith(p["path"], F.lit("/")), p["path"]).otherwise(F.concat(F.lit("/"), p["path"])), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))), F.lit("?")))))

    return parsed(url, build)


def article_key(url: Column) -> Column:
    """The article path's identity: scheme, fragment and ;params dropped, slashes at the end too, campaign parameters gone, order and blank values
    kept. A host's port and user stay."""
    encode = lambda x: F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    bare = F.regexp_replace(F.trim(url), "#.*$", "")

    def build(x: Column) -> Column:
        part = lambda i: F.regexp_extract(x, _SHAPE, i)
        path = F.regexp_replace(F.regexp_replace(part(3), ";[^/]*$", ""), "/+$", "")
        kv = F.filter(pairs(part(4)), lambda y: ~F.startswith(F.lower(y["k"]), F.lit("utm_")) & ~in_(F.lower(y["k"]), ARTICLE_DROPPED))
        query = F.array_join(F.transform(kv, lambda y: F.concat(encode(y["k"]), F.lit("="), encode(y["v"]))), "&")
        host = F.lower(part(2))
        return F.concat(F.when(host != "", F.concat(F.lit("//"), host)).otherwise(F.lit("")), path, let(query, lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit(""))))

    return let(bare, build)


def is_homepage(normalized: Column) -> Column:
    return F.endswith(normalized, F.lit("/")) | (F.length(normalized) - F.length(F.replace(normalized, F.lit("/"), F.lit(""))) <= 2)


def set_param(url: Column, key: str, value: Column) -> Column:
    """A URL with one query parameter set, the others kept in order."""
    base = F.substring_index(url, "?", 1)
    query = F.when(F.contains(url, F.lit("?")), F.regexp_replace(url, r"^[^?]*\?", "")).otherwise(F.lit(""))
    rest = F.filter(F.split(query, "&"), lambda x: (x != "") & (F.substring_index(x, "=", 1) != key))
    return F.concat(base, F.lit("?"), F.array_join(F.concat(rest, F.array(F.concat(F.lit(key + "="), value.cast("string")))), "&"))
